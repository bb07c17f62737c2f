"""Language identification of mixed-language text: script ranges, word scores, Viterbi.

A word is a run of letters.  Its script (by the range of its first character)
narrows the candidates to the languages that were seen to use it.  Each
language scores a word by its letter trigrams, word borders included.  Viterbi
over the words of a text, with a penalty for each switch, labels spans; the
text's language is the one whose spans hold the most letters.

Training counts trigrams by language in Spark; each task counts into one table
per language and passes on the cells that occur.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import steps, utf8

CELLS = 1 << 18         # 64**3 trigrams
SCRIPTS = 16
SWITCH = 12.0           # penalty of a change of language, in nats
ALPHA = 0.1             # added to each count
FOREIGN = 60.0          # penalty of a language that doesn't use the word's script
MIN_SHARE = 0.01        # of a language's words, for a script to be one of its own
STEP = 8 << 20          # bytes worked through at once: many texts side by side
TABLES = 64             # languages counted side by side in a task

# fixed: letter classes of UTF-8 bytes (a-z, then the low bits of others)
_LETTER = np.zeros(256, np.uint32)
_LETTER[65:91] = np.arange(1, 27)
_LETTER[97:123] = np.arange(1, 27)
_LETTER[128:] = 32 + (np.arange(128, 256) & 31)
_TAIL = (np.arange(256) & 0xC0) == 0x80

# fixed: scripts by the first byte of a character's UTF-8 form
_SCRIPT = np.zeros(256, np.uint8)
for _first, _last, _number in (
        (0x41, 0x5A, 1), (0x61, 0x7A, 1), (0xC2, 0xCA, 1),     # Latin (U+0041 to U+02AF)
        (0xCD, 0xCF, 2),                                       # Greek
        (0xD0, 0xD4, 3),                                       # Cyrillic
        (0xD5, 0xD5, 4),                                       # Armenian
        (0xD6, 0xD7, 5),                                       # Hebrew
        (0xD8, 0xDF, 6),                                       # Arabic and neighbours
        (0xE0, 0xE0, 7),                                       # South and Southeast Asian
        (0xE1, 0xE1, 8),                                       # Georgian, Ethiopic, Khmer, Latin with two marks
        (0xE2, 0xE2, 9),                                       # symbols and punctuation
        (0xE3, 0xE3, 10),                                      # kana
        (0xE4, 0xE9, 11),                                      # Han
        (0xEA, 0xED, 12),                                      # Hangul
        (0xEE, 0xEF, 13), (0xF0, 0xF4, 14)):                   # others
    _SCRIPT[_first:_last + 1] = _number


@dataclass
class Words:
    """The words of some texts: trigram codes of their letters, and where a word's codes, letters and texts begin."""
    codes: np.ndarray       # one for each letter byte
    first_code: np.ndarray  # of each word
    start: np.ndarray       # byte positions
    end: np.ndarray
    script: np.ndarray
    first: np.ndarray       # index of each text's first word, and the number of words at the end


def letter_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    s = _LETTER[data]
    is_letter = s > 0
    n = len(s)
    before, after = np.zeros(n, np.uint32), np.zeros(n, np.uint32)
    before[1:], after[:-1] = s[:-1], s[1:]
    starts = offsets[:-1][np.diff(offsets) > 0]
    before[starts] = 0
    after[starts[starts > 0] - 1] = 0
    at = np.flatnonzero(is_letter)
    codes = (before[at] << 12) | (s[at] << 6) | after[at]
    begins = before[at] == 0
    first_code = np.flatnonzero(begins)
    start = at[first_code]
    end = at[after[at] == 0] + 1
    return Words(codes, first_code, start, end, _SCRIPT[data[start]], np.searchsorted(start, offsets))


@dataclass
class Model:
    languages: list[str]
    logp: np.ndarray        # CELLS x languages
    scripts: np.ndarray     # SCRIPTS x languages: penalty

    def word_scores(self, w: Words) -> np.ndarray:
        if not len(w.start):
            return np.zeros((0, len(self.languages)), np.float32)
        return np.add.reduceat(self.logp[w.codes], w.first_code, axis=0) - self.scripts[w.script]


def viterbi(scores: np.ndarray, first: np.ndarray, switch: float) -> np.ndarray:
    """The best language of each word; texts go side by side, word by word."""
    n_words, n = scores.shape
    lengths = np.diff(first)
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    out = np.zeros(n_words, np.int64)
    if not len(order):
        return out
    at, lengths = first[:-1][order], lengths[order]
    back = np.zeros((n_words, n), np.int8 if n < 128 else np.int32)
    own = np.arange(n)
    best = scores[at].copy()
    active = np.searchsorted(-lengths, -np.arange(lengths[0]), "left")     # texts with a word at this place
    for t in range(1, int(lengths[0])):
        k = active[t]
        b = best[:k]
        top = b.max(axis=1, keepdims=True) - switch
        stay = b >= top
        back[at[:k] + t] = np.where(stay, own, b.argmax(axis=1)[:, None])
        best[:k] = scores[at[:k] + t] + np.where(stay, b, top)
    state = np.zeros(len(order), np.int64)
    for t in range(int(lengths[0]) - 1, -1, -1):
        k = active[t]
        ends = lengths[:k] - 1 == t
        state[:k][ends] = best[:k][ends].argmax(axis=1)
        out[at[:k] + t] = state[:k]
        state[:k] = back[at[:k] + t, state[:k]]
    return out


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """The model of the rows with a text and a language.

    The driver receives at most 64**3 + 16 counts per language.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[str, np.ndarray] = {}

        def found():
            for name, t in tables.items():
                cells = np.flatnonzero(t)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(cells)), pa.array(cells), pa.array(t[cells])],
                                                 names=["lang", "cell", "n"])

        for batch in batches:
            batch = batch.take(pa.array(np.argsort(batch.column(1).to_numpy(zero_copy_only=False), kind="stable")))
            names = np.array(batch.column(1).to_pylist())
            borders = [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1).tolist(), len(names)]
            for i, j in zip(borders[:-1], borders[1:]):
                if i == j:
                    continue
                name = str(names[i])
                if name not in tables:
                    if len(tables) >= TABLES:
                        yield from found()
                        tables.clear()
                    tables[name] = np.zeros(CELLS + SCRIPTS, np.int64)
                data, offsets = utf8(batch.column(0).slice(i, j - i))
                for a, b in steps(offsets):
                    w = letter_words(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                    tables[name][:CELLS] += np.bincount(w.codes, minlength=CELLS)
                    tables[name][CELLS:] += np.bincount(w.script, minlength=SCRIPTS)
        yield from found()

    rows = docs.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang")).dropna()
    counts = (rows.mapInArrow(count, "lang string, cell long, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
              .toArrow())
    names = counts["lang"].to_numpy()
    languages = sorted(set(names.tolist()))
    table = np.zeros((CELLS + SCRIPTS, len(languages)))
    table[counts["cell"].to_numpy(), np.searchsorted(languages, names) if languages else []] = counts["n"].to_numpy()
    cells, scripts = table[:CELLS] + ALPHA, table[CELLS:]
    share = scripts / np.maximum(scripts.sum(axis=0), 1)
    known = share >= MIN_SHARE
    known[~known.any(axis=1)] = True        # a script that nobody uses narrows nothing
    return Model(languages, np.log(cells / cells.sum(axis=0)).astype(np.float32), np.where(known, 0, FOREIGN).astype(np.float32))


RESULT = "_id long, lang_pred string, score double, spans array<struct<lang:string,start:long,end:long>>"


def detect(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", switch: float = SWITCH) -> DataFrame:
    """One row per input row: id, ``lang_pred``, ``score``, ``spans``.

    ``spans``: language, start and end (code points) of each run of words of
    one language, from its first word to its last one's end.  ``score``: the
    predicted language's share of the letters.  A null text, one without
    letters, or a model without languages gives ``und``, 0 and no spans.  Of
    languages with equally many letters the first by name is predicted.  Rows
    that repeat get equal results.  Other columns are not read.  An empty table
    gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)        # 1 MB per language

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        span = pa.struct([("lang", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            whole, all_offsets = utf8(batch.column(1))
            for a, b in steps(all_offsets, STEP):
                data, offsets = whole[all_offsets[a]:all_offsets[b]], all_offsets[a:b + 1] - all_offsets[a]
                n = b - a
                w = letter_words(data, offsets) if m.languages and len(data) else None
                names, scores = ["und"] * n, np.zeros(n)
                cuts, spans = np.zeros(n + 1, np.int32), None
                if w is not None and len(w.start):
                    state = viterbi(m.word_scores(w), w.first, switch)
                    row = np.repeat(np.arange(n), np.diff(w.first))
                    held = np.zeros((n, len(m.languages)))
                    np.add.at(held, (row, state), w.end - w.start)
                    pick, total = held.argmax(axis=1), held.sum(axis=1)
                    plain = (data >= 65) & (data <= 122) & (_LETTER[data] > 0)
                    seen = np.concatenate([[0], np.cumsum(plain)])
                    has = seen[offsets[1:]] > seen[offsets[:-1]]
                    for i in np.flatnonzero(~has & (total > 0)).tolist():       # other alphabets: ask for a letter
                        has[i] = any(c.isalpha() for c in data[offsets[i]:offsets[i + 1]].tobytes().decode("utf-8", "replace"))
                    has &= total > 0
                    names = [m.languages[k] if h else "und" for k, h in zip(pick.tolist(), has.tolist())]
                    scores = np.where(has, held[np.arange(n), pick] / np.maximum(total, 1), 0.0)
                    new = np.ones(len(state), bool)
                    new[1:] = (state[1:] != state[:-1]) | (row[1:] != row[:-1])
                    new &= has[row]
                    head = np.flatnonzero(new)
                    last = np.append(head[1:], len(state)) - 1
                    # a text without letters may lie between two heads: a span ends in its own text
                    last = np.minimum(last, w.first[row[head] + 1] - 1)
                    place = np.concatenate([[0], np.cumsum(~_TAIL[data])])
                    origin = place[offsets[row[head]]]
                    cuts = np.searchsorted(head, w.first).astype(np.int32)
                    spans = pa.StructArray.from_arrays(
                        [pa.array([m.languages[k] for k in state[head].tolist()], pa.string()),
                         pa.array(place[w.start[head]] - origin), pa.array(place[w.end[last]] - origin)], fields=list(span))
                if spans is None:
                    spans = pa.array([], span)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, n), pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                     pa.ListArray.from_arrays(pa.array(cuts), spans)], names=["_id", "lang_pred", "score", "spans"])

    return (docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
            .mapInArrow(label, RESULT).withColumnRenamed("_id", id_col))


def held_out(id_col: str = "doc_id"):
    """Whether a document is kept from training: crc32 of its id as text, mod 4, is 2 (a null id: no)."""
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")) % 4 == 2
