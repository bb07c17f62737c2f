"""Personal data: fixed patterns, and a learned tagger that adds what they miss.

The patterns find email addresses, IPv4 addresses, card numbers and phone
numbers in every whole text; their spans always stay.  A character-level
bidirectional LSTM with CRF transitions, trained in numpy from labelled spans,
then reads the text around every digit or @ that no pattern explains: every
kind holds one of these, so no other place can hold a span.  Overlapping
windows are decoded one by one, and all their spans are reconciled over the
whole text: the heaviest set of spans that don't overlap, by weighted interval
scheduling.

Labelled spans for training: windows of at most ``TRAIN_ROWS`` documents
(those with the smallest hash of id and text) with the patterns' own spans, the
clean ones as counter-examples, and as many generated ones that spell
the kinds in ways which the patterns don't cover.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tagger
from .common import steps, utf8

KINDS = ("email", "ip", "card", "phone")
SPARE = 50              # rows looked at per sampled window: most hold no digit
TRAIN_ROWS = 2000       # sampled windows; the generated ones are as many again
WINDOW, STRIDE = 96, 48
SURE = 0.9              # least mean probability of an added span
BATCH = 512             # windows decoded together

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = np.zeros(256, bool)
_TRIGGER[48:58] = True
_TRIGGER[64] = True
_PLACES = re.compile(r"[0-9@]")

Span = tuple[int, int, int]     # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def patterns(text: str) -> list[Span]:
    """The base spans of a text, by start and then kind; leftmost, not overlapping within a kind."""
    out: list[Span] = []
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, 0, m.end()))
            done = m.end()
        at = text.find("@", m.end() if m else at + 1)
    out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(map(_byte, m.groups()))]
    out += [(m.start(), 2, m.end()) for m in _CARD.finditer(text) if 14 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
    out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(out)


def plausible(kind: int, text: str) -> bool:
    """What a kind's span must hold, however it is spelled."""
    digits = _digits(text)
    if kind == 0:
        left, at, right = text.partition("@")
        return bool(at) and any(c.isalnum() for c in left) and any(c.isalpha() for c in right) and "." in right
    if kind == 1:
        parts = re.findall(r"[0-9]+", text)
        return len(parts) == 4 and all(map(_byte, parts))
    if kind == 2:
        return 14 <= len(digits) <= 19 and luhn(digits)
    return 10 <= len(digits) <= 15 and not re.search(r"[A-Za-z]", text)


# ---------------------------------------------------------------- labelled spans

def _tags(n: int, spans: list[Span]) -> np.ndarray:
    """0 outside; 1 + 2 * kind at a span's start, 2 + 2 * kind inside."""
    tags = np.zeros(n, np.int64)
    for start, kind, end in spans:
        tags[start] = 1 + 2 * kind
        tags[start + 1:end] = 2 + 2 * kind
    return tags


def generated(rng: np.random.Generator, contexts: list[str]) -> tuple[str, list[Span]]:
    """A window with a span in one of many spellings, inside some context."""
    def number(n):
        return "".join(map(str, rng.integers(0, 10, n)))

    def word(n):
        return "".join(chr(97 + c) for c in rng.integers(0, 26, n))

    def one(*choices):
        return choices[rng.integers(len(choices))]

    kind = int(rng.integers(6))
    if kind == 0:
        at = one("@", " @ ", "@ ", " @")
        text = f"{word(rng.integers(2, 9))}{one('', '.' + number(2), '_' + word(4))}{at}{word(rng.integers(3, 9))}{one('.', '.', ' . ')}{one('com', 'org', 'net', 'example.com')}"
    elif kind == 1:
        text = one(".", ".", " . ", ". ").join(str(x) for x in rng.integers(0, 256, 4))
    elif kind == 2:
        body = number(15)
        body += next(str(c) for c in range(10) if luhn(body + str(c)))
        text = one("", " ", "-", ".", "/").join(body[i:i + 4] for i in range(0, 16, 4))
    elif kind == 3:
        text = one("+", "", "00 ") + one(number(1), number(2)) + one(" ", "-", ".") + one("({})", "{}").format(number(3)) + one(" ", "-", ".") + number(3) + one(" ", "-", ".") + number(4)
    elif kind == 4:     # other numbers
        text = one(number(rng.integers(1, 9)), f"{number(1)}.{number(1)}", f"v{number(1)}.{number(2)}.{number(1)}", f"{number(4)}-{number(2)}-{number(2)}",
                   f"{number(2)}:{number(2)}", f"{number(rng.integers(20, 31))}")
    else:               # names with digits, keys, handles
        text = one(f"@{word(6)}", f"{word(3)}{number(3)}{word(4)}", "".join(one(number(1), word(1)) for _ in range(int(rng.integers(16, 41)))))
    context = contexts[rng.integers(len(contexts))] if contexts else " ".join(word(rng.integers(2, 9)) for _ in range(14))
    cut = int(rng.integers(0, len(context) + 1))
    before, after = context[:cut][-40:], context[cut:]
    before = before + one(" ", " ", "\n", ": ", " (")
    span = [(len(before), kind, min(WINDOW, len(before) + len(text)))] if kind < 4 else []
    return (before + text + one(" ", " ", ". ", "\n", ", ") + after)[:WINDOW], span


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = TRAIN_ROWS) -> tagger.Tagger:
    """The tagger, from at most ``rows`` windows of the documents and as many generated ones."""
    text = F.col(f"`{text_col}`")
    place = F.regexp_instr(text, F.lit("[0-9@]"))
    # only the few rows with the smallest hashes leave their tasks, whatever their number
    share = min(1.0, SPARE * rows / max(1, docs.count()))
    hashed = F.xxhash64(F.col(f"`{id_col}`"), text)
    sample = (docs.where((place > 0) & (hashed < int(-2**63 + share * (2**64 - 2**12))))
              .select(hashed.alias("h"), F.substring(text, F.greatest(F.lit(1), place - WINDOW // 2), WINDOW).alias("w"))
              .orderBy("h", "w").limit(rows).collect())
    rng = np.random.default_rng(7)
    windows, clean = [], []
    for r in sample:
        spans = [s for s in patterns(r["w"]) if s[0] > 0 and s[2] < len(r["w"])]
        windows.append((r["w"], spans))
        clean.append(_PLACES.sub("", r["w"]))
    windows += [generated(rng, clean) for _ in range(rows)]
    codes = np.zeros((len(windows), WINDOW), np.int64)
    tags = np.zeros_like(codes)
    for i, (w, spans) in enumerate(windows):
        codes[i, :len(w)] = tagger.classes(w)[:WINDOW]
        tags[i, :len(w)] = _tags(len(w), spans)[:WINDOW]
    return tagger.train(codes, tags, 1 + 2 * len(KINDS))


# ---------------------------------------------------------------- windows

def window_starts(text: str, base: list[Span]) -> list[int]:
    """Overlapping windows over the stretches around digits and @ that no base span holds."""
    order = sorted((s, e) for s, _, e in base)
    begins, reach, far = [s for s, _ in order], [], 0
    for _, e in order:
        far = max(far, e)
        reach.append(far)
    starts: list[int] = []
    for m in _PLACES.finditer(text):
        p = m.start()
        k = bisect_right(begins, p) - 1
        if k >= 0 and p < reach[k]:
            continue
        if not starts or p >= starts[-1] + WINDOW:          # a new stretch, this place in its middle
            starts.append(max(0, p - STRIDE))
        while p >= starts[-1] + STRIDE and starts[-1] + WINDOW < len(text):
            starts.append(starts[-1] + STRIDE)              # the same stretch goes on
    return starts


def reconcile(spans: list[tuple[float, Span]]) -> list[Span]:
    """The heaviest set of spans that don't overlap."""
    spans = sorted(set(spans), key=lambda x: (x[1][2], x[1]))
    ends = [s[2] for _, s in spans]
    best: list[float] = [0.0]
    take: list[int] = []
    for i, (weight, (start, _, _)) in enumerate(spans):
        k = bisect_right(ends, start, 0, i)
        take.append(k if best[k] + weight > best[i] else -1)
        best.append(max(best[i], best[k] + weight))
    out, i = [], len(spans)
    while i:
        if take[i - 1] >= 0:
            out.append(spans[i - 1][1])
            i = take[i - 1]
        else:
            i -= 1
    return out[::-1]


@dataclass
class Piece:
    """A decoded span as one window shows it; ``left`` and ``right``: it may go on beyond the window's border there."""
    weight: float
    start: int
    kind: int
    end: int
    left: bool
    right: bool


def _pieces(tags: np.ndarray, probability: np.ndarray, start: int, n: int, length: int) -> Iterator[Piece]:
    """The tagged runs of a decoded window, weighted by their probability and length."""
    i = 0
    while i < n:
        tag = int(tags[i])
        if tag == 0:
            i += 1
            continue
        kind, j = (tag - 1) // 2, i + 1
        while j < n and tags[j] == 2 + 2 * kind:
            j += 1
        sure = float(probability[i:j].mean())
        if sure >= SURE:
            yield Piece(sure * (j - i), start + i, kind, start + j, i == 0 and start > 0, j == n and start + n < length)
        i = j


def joined(pieces: list[Piece]) -> list[tuple[float, Span]]:
    """(weight, span) of all windows of a text, in their order.

    A piece that the right border cuts goes on in the next window's piece of
    its kind, if that overlaps or touches it; so a span may be longer than any
    window.  What no window completes is left out.
    """
    out: list[tuple[float, Span]] = []
    cut: dict[int, Piece] = {}
    for p in pieces:
        before = cut.get(p.kind)
        if not p.left and not p.right:
            out.append((p.weight, (p.start, p.kind, p.end)))
        if before and before.start <= p.start <= before.end <= p.end:
            share = (p.end - before.end) / (p.end - p.start)
            p = Piece(before.weight + p.weight * share, before.start, p.kind, p.end, before.left, p.right)
            if not p.left and not p.right:
                out.append((p.weight, (p.start, p.kind, p.end)))
        if p.right:
            cut[p.kind] = p
    return out


def find(texts: list[str], model: tagger.Tagger) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and added spans of each text."""
    base = [patterns(t) for t in texts]
    places = [(i, s) for i, t in enumerate(texts) for s in window_starts(t, base[i])]
    found: dict[int, list[Piece]] = {}
    for k in range(0, len(places), BATCH):
        part = places[k:k + BATCH]
        codes = np.zeros((WINDOW, len(part)), np.int64)
        for j, (i, s) in enumerate(part):
            c = tagger.classes(texts[i][s:s + WINDOW])
            codes[:len(c), j] = c
        tags, probability = model.decode(codes)
        for j, (i, s) in enumerate(part):
            n = min(WINDOW, len(texts[i]) - s)
            if tags[:n, j].any():
                found.setdefault(i, []).extend(_pieces(tags[:, j], probability[:, j], s, n, len(texts[i])))
    out = []
    for i, text in enumerate(texts):
        free = []
        for weight, (start, kind, end) in joined(found.get(i, [])):
            if plausible(kind, text[start:end]) and all(end <= s or start >= e for s, _, e in base[i]):
                free.append((weight, (start, kind, end)))
        out.append((base[i], sorted(reconcile(free))))
    return out


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


RESULT = ("_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")


def personal_data(docs: DataFrame, model: tagger.Tagger | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, base counts by kind, ``base_sha256``, ``spans``, ``n_added``.

    ``spans``: ``kind:start:end`` (code points, end exclusive) of all spans by
    start and then kind, comma-joined; ``base_sha256``: of the base spans alone,
    joined likewise.  Base spans of different kinds may overlap; added ones
    overlap nothing.  A null text counts as empty: no spans.  Rows that repeat
    get equal results.  Other columns are not read.  An empty table gives an
    empty result.
    """
    model = model or train(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)        # about 20 kB
    empty = hashlib.sha256(b"").hexdigest()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in steps(offsets):
                part = data[offsets[a]:offsets[b]]
                seen = np.concatenate([[0], np.cumsum(_TRIGGER[part])])[offsets[a:b + 1] - offsets[a]]
                hot = np.flatnonzero(np.diff(seen))
                texts = [data[offsets[a + i]:offsets[a + i + 1]].tobytes().decode("utf-8", "replace") for i in hot.tolist()]
                counts = np.zeros((b - a, len(KINDS) + 1), np.int64)
                hashes, spans = [empty] * (b - a), [""] * (b - a)
                for i, (base, added) in zip(hot.tolist(), find(texts, shared.value)):
                    for _, kind, _ in base:
                        counts[i, kind] += 1
                    counts[i, -1] = len(added)
                    hashes[i] = hashlib.sha256(listed(base).encode()).hexdigest()
                    spans[i] = listed(base + added)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), *[pa.array(counts[:, k]) for k in range(len(KINDS))], pa.array(hashes),
                     pa.array(spans), pa.array(counts[:, -1])], names=[x.split()[0] for x in RESULT.split(", ")])

    return (docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
            .mapInArrow(scan, RESULT).withColumnRenamed("_id", id_col))
