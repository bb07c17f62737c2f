"""SentencePiece encoding with the N best segmentations, and decoding.

The pieces of a vocabulary and their scores span a lattice over a text.
Forward Viterbi gives the best score from the start to every place; searching
backward from the end, these scores are exact heuristics, so A-star pops the
segmentations in order of their total score.

No piece goes on from another character into a space; some are runs of spaces.
The lattice therefore falls apart before each run of spaces: each chunk (a run
and what follows up to the next one) is searched by itself, equal chunks once,
all chunks of one length side by side; the N best of a text are combined from
its chunks' N best.  A text is one chunk if a vocabulary has other pieces.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, steps, utf8

N_BEST = 3
CACHE = 500_000         # chunks kept in a worker, about 180 MB; then the cache starts anew
SIDE_BY_SIDE = 48       # longer chunks are searched one by one
ROWS = 4096             # chunks searched together
NONE = -np.inf

_U64 = np.uint64
_MUL = 0xD1342543DE82EF95
_POWER = np.array([pow(_MUL, k, 2**64) for k in range(SIDE_BY_SIDE + 1)], dtype=_U64)
_BACK = np.array([pow(pow(_MUL, -1, 2**64), k, 2**64) for k in range(SIDE_BY_SIDE + 1)], dtype=_U64)
_CHUNK = re.compile(r" +[^ ]*")
_SPACE = re.compile(r" [^ ]*")
_CROSSES = re.compile(r"[^ ] ")


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class Pieces:
    """A vocabulary: pieces with scores, bytes for characters that no piece holds.

    ``runs``: with the pieces that hold a space after their first character.
    Without them, each space begins a chunk.
    """

    def __init__(self, path: str, n_best: int = N_BEST, runs: bool = False):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.n_best = n_best
        self.runs = runs
        self.text: list[bytes] = [b""] * n          # what an id decodes to
        self.byte_id = [sp.unk_id()] * 256
        self.scores: dict[str, tuple[float, int]] = {}
        lowest = 0.0
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                b = int(piece[1:-1], 16)
                self.byte_id[b], self.text[i] = i, bytes([b])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.text[i] = piece.replace("▁", " ").encode()
                if runs or "▁" not in piece[1:]:
                    self.scores[piece.replace("▁", " ")] = (sp.get_score(i), i)
                    lowest = min(lowest, sp.get_score(i))
        self.byte_score = lowest - 10.0             # of each byte that stands for itself
        self.longest = max(map(len, self.scores), default=1)
        hashes = np.array([self._hash(p) for p in self.scores], _U64)
        order = np.argsort(hashes)
        self.keys = hashes[order]
        values = list(self.scores.values())
        self.key_score = np.array([values[i][0] for i in order])
        self.key_id = np.array([values[i][1] for i in order], np.int32)
        self.size = {i: len(p) for p, (_, i) in self.scores.items()}
        self.line_alone = not any("\n" in p and len(p) > 1 for p in self.scores)     # no piece crosses a line break
        self.apart = not any(map(_CROSSES.search, self.scores))
        self.clear()

    # -- one chunk

    @staticmethod
    def _hash(piece: str) -> int:
        c = _codes(piece)
        if len(c) > SIDE_BY_SIDE:
            return 0
        return int(mix(np.array([(mix(c.astype(_U64)) * _POWER[:len(c)]).sum(dtype=_U64) + _U64(len(c))], _U64))[0])

    def _own(self, char: str) -> float:
        """The score of a character that no piece holds: its bytes."""
        return self.byte_score * len(char.encode("utf-8", "surrogatepass"))

    def _ids(self, chunk: str, cuts: list[int]) -> bytes:
        out: list[int] = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            known = self.scores.get(chunk[a:b])
            if known:
                out.append(known[1])
            else:
                out += [self.byte_id[x] for x in chunk[a:b].encode("utf-8", "surrogatepass")]
        return np.array(out, "<u4").tobytes()

    def search(self, chunk: str) -> list[tuple[float, bytes]]:
        """The N best segmentations of one chunk, by a heap."""
        n = len(chunk)
        forward = [0.0] + [NONE] * n
        edges: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        for j in range(1, n + 1):
            for i in range(max(0, j - self.longest), j):
                known = self.scores.get(chunk[i:j])
                score = known[0] if known else self._own(chunk[i]) if i == j - 1 else None
                if score is not None:
                    edges[j].append((i, score))
                    forward[j] = max(forward[j], forward[i] + score)
        # (minus the best total through here, place, order, score so far, rest of the path)
        heap = [(-forward[n], n, 0, 0.0, (n, None))]
        out, made = [], 0
        while heap and len(out) < self.n_best:
            _, p, _, done, path = heapq.heappop(heap)
            if p == 0:
                cuts = []
                while path:
                    cuts.append(path[0])
                    path = path[1]
                out.append((done, self._ids(chunk, cuts)))
                continue
            for i, score in edges[p]:
                made += 1
                heapq.heappush(heap, (-(done + score + forward[i]), i, made, done + score, (i, path)))
        return out

    # -- many chunks of one length

    def _edges(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(chunk, start, end): the piece's score and id; minus infinity and -1 where there is none."""
        rows, n = codes.shape
        prefix = np.zeros((rows, n + 1), _U64)
        np.cumsum(mix(codes.astype(_U64)) * _POWER[:n], axis=1, out=prefix[:, 1:])
        scores = np.full((rows, n, n + 1), NONE)
        ids = np.full((rows, n, n + 1), -1, np.int32)
        for d in range(1, min(n, self.longest) + 1):
            h = mix((prefix[:, d:] - prefix[:, :n + 1 - d]) * _BACK[:n + 1 - d] + _U64(d))
            at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
            i = np.arange(n + 1 - d)
            known = self.keys[at] == h
            scores[:, i, i + d] = np.where(known, self.key_score[at], NONE)
            ids[:, i, i + d] = np.where(known, self.key_id[at], -1)
        i = np.arange(n)
        size = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)
        single = scores[:, i, i + 1]
        scores[:, i, i + 1] = np.where(single == NONE, self.byte_score * size, single)
        return scores, ids

    def search_all(self, chunks: list[str]) -> tuple[np.ndarray, list[bytes]]:
        """``search`` for chunks of one length, in step: totals (chunk, rank; minus infinity: none) and all ids in that order.

        As the heuristic is exact, every waiting hypothesis stands for a path of
        just that total, and different ones for different paths: the N best of
        them are all that the queue has to hold.  All N are expanded at once.
        """
        rows, n, top = len(chunks), len(chunks[0]), self.n_best
        scores, ids = self._edges(_codes("".join(chunks)).reshape(rows, n))
        forward = np.full((rows, n + 1), NONE)
        forward[:, 0] = 0
        for j in range(1, n + 1):
            lo = max(0, j - self.longest)
            forward[:, j] = (forward[:, lo:j] + scores[:, lo:j, j]).max(axis=1)
        r = np.arange(rows)[:, None]
        total = np.full((rows, top), NONE)          # the best total through each hypothesis
        total[:, 0] = forward[:, n]
        done = np.zeros((rows, top))                # its score so far
        place = np.full((rows, top), n)
        history = []
        while ((place > 0) & (total > NONE)).any():
            step = scores[r, :, place]              # pieces that end here; none at the start
            reach = np.empty((rows, top, n + 1))
            reach[:, :, 0] = np.where(place == 0, total, NONE)      # ended: waits as it is
            reach[:, :, 1:] = np.where((total > NONE)[:, :, None], done[:, :, None] + step + forward[:, None, :n], NONE)
            flat = reach.reshape(rows, -1)
            pick = np.argpartition(flat, flat.shape[1] - top, axis=1)[:, -top:]
            total, parent, start = flat[r, pick], pick // (n + 1), pick % (n + 1) - 1
            history.append((parent, start, place[r, parent]))
            done = np.where(start < 0, done[r, parent], done[r, parent] + step[r, parent, start])
            place = np.maximum(start, 0)
        order = np.argsort(-total, axis=1, kind="stable")
        total, slot = total[r, order], order
        path, taken = [], []                        # from left to right
        lone = np.zeros((rows, top), bool)
        for parent, start, end in reversed(history):
            s = start[r, slot]
            here = s >= 0
            piece = ids[r, s, end[r, slot]]
            lone |= here & (piece < 0)
            path.append(piece)
            taken.append(here)
            slot = parent[r, slot]
        path, taken = np.stack(path, axis=2), np.stack(taken, axis=2)
        data = path[taken].astype("<u4").tobytes()
        ends = np.cumsum(taken.sum(axis=2).ravel() * 4).tolist()
        found = [data[a:b] for a, b in zip([0, *ends[:-1]], ends)]
        for k in np.flatnonzero(lone & (total > NONE)).tolist():    # characters that no piece holds
            c, k_ = divmod(k, top)
            found[k] = self._spelled(chunks[c], path[c, k_][taken[c, k_]])
        return total, found

    def _spelled(self, chunk: str, path: np.ndarray) -> bytes:
        cuts = [0]
        for i in path.tolist():
            cuts.append(cuts[-1] + (1 if i < 0 else self.size[i]))
        return self._ids(chunk, cuts)

    # -- texts

    def clear(self) -> None:
        self.index: dict[str, int] = {"": 0}
        self.best: list[bytes] = [b""]
        self.rest: list[bytes] = [b""] * (self.n_best - 1)      # the other N - 1 of each chunk
        self.sound = np.ones(1, bool)                           # the best ids spell the very chunk
        self.score = np.zeros(1)
        self.loss = np.full((1, self.n_best - 1), np.inf)       # what they give away

    def learn(self, chunks: set[str]) -> None:
        by_length: dict[int, list[str]] = {}
        for c in chunks:
            by_length.setdefault(len(c), []).append(c)
        top = self.n_best
        totals, sound = [np.zeros((0, top))], [np.zeros(0, bool)]
        for n, some in by_length.items():
            for i in range(0, len(some), ROWS):
                part = some[i:i + ROWS]
                if n <= SIDE_BY_SIDE:
                    total, found = self.search_all(part)
                else:
                    total, found = np.full((len(part), top), NONE), []
                    for row, c in zip(total, part):
                        hits = self.search(c)
                        row[:len(hits)] = [t for t, _ in hits]
                        found += [b for _, b in hits] + [b""] * (top - len(hits))
                self.index.update(zip(part, range(len(self.best), len(self.best) + len(part))))
                self.best += found[::top]
                sound.append([self.spelled(b) == c.encode("utf-8", "surrogatepass") for b, c in zip(found[::top], part)])
                del found[::top]
                self.rest += found
                totals.append(total)
        total = np.concatenate(totals)
        self.sound = np.concatenate([self.sound, *sound])
        self.score = np.concatenate([self.score, total[:, 0]])
        self.loss = np.concatenate([self.loss, total[:, :1] - total[:, 1:]])

    def n_best_of(self, at: np.ndarray) -> list[tuple[float, bytes]]:
        """The N best of a text, given as chunk numbers.

        Only the N - 1 chunks whose second best gives away least can differ
        from their best: one change in each of them already beats the rest.
        """
        top, others = float(self.score[at].sum()), self.n_best - 1
        parts = list(map(self.best.__getitem__, at.tolist()))
        out = [(top, b"".join(parts))]
        if not others or not len(at):
            return out
        loss = self.loss[at, 0]
        few = np.arange(len(at)) if len(at) <= others else np.argpartition(loss, others - 1)[:others]
        mixes: list[tuple[float, tuple]] = [(0.0, ())]
        for x in few.tolist():
            c = int(at[x])
            choices = [(0.0, None)] + [(d, c * others + k) for k, d in enumerate(self.loss[c].tolist()) if d < np.inf]
            mixes = sorted(((t + d, changes + ((x, b),) if b is not None else changes)
                            for t, changes in mixes for d, b in choices), key=lambda m: m[0])[:self.n_best]
        for t, changes in mixes[1:]:
            for x, b in changes:
                parts[x] = self.rest[b]
            out.append((top - t, b"".join(parts)))
            for x, _ in changes:
                parts[x] = self.best[int(at[x])]
        return out

    def numbers(self, texts: list[str]) -> list[np.ndarray]:
        """For each text the numbers of its chunks; new chunks are learned."""
        split = []
        for t in texts:
            if not t:
                split.append([])
            elif not self.apart:
                split.append([" " + t])
            elif "\0" in t:
                split.append((_CHUNK if self.runs else _SPACE).findall(" " + t))
            else:
                t = (" " + t).replace(" ", "\0 ")
                if self.runs:
                    t = t.replace(" \0", " ")
                if self.line_alone:
                    t = t.replace("\n", "\0\n\0").replace("\0\0", "\0")
                split.append(t.rstrip("\0").split("\0")[1:])
        missing = set().union(*split) - self.index.keys() if split else set()
        if len(self.index) + len(missing) > CACHE:
            self.clear()
            missing = set().union(*split)
        self.learn(missing)
        number = self.index.__getitem__
        return [np.fromiter(map(number, s), np.int64, len(s)) for s in split]

    def encode(self, texts: list[str]) -> list[list[tuple[float, bytes]]]:
        """For each text its N best (score, ids as little-endian unsigned 32-bit bytes); an empty text has no ids."""
        return [self.n_best_of(at) for at in self.numbers(texts)]

    def spelled(self, ids: bytes) -> bytes:
        return b"".join(map(self.text.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def decode(self, ids: bytes) -> str:
        """The text of some ids, without the space that encoding puts before it."""
        text = self.spelled(ids).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


_pieces: dict[tuple[str, int], Pieces] = {}


def pieces(path: str, n_best: int = N_BEST) -> Pieces:
    if (path, n_best) not in _pieces:
        _pieces[path, n_best] = Pieces(path, n_best, runs=True)
    return _pieces[path, n_best]


def encode(docs: DataFrame, path: str, n_best: int = N_BEST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``n_best`` (array of score and ids, the best first), ``round_trip``.

    ``ids``: little-endian unsigned 32-bit bytes.  ``round_trip``: whether the
    best ids decode to the very text.  Characters that no piece holds become
    bytes, so every text can be decoded; so does U+2581, which stands for a
    space in the vocabulary.  Fewer than ``n_best`` entries: there are no more
    segmentations.  Equal scores come in any order.  A null text counts as
    empty: one entry, score 0, no ids.  Rows that repeat get equal results.
    Other columns are not read.  An empty table gives an empty result.
    ``path``: the vocabulary's file, at the same place on all executors.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(path, n_best)
        for batch in batches:
            for a, b in steps(utf8(batch.column(1))[1]):
                texts = [t or "" for t in batch.column(1).slice(a, b - a).to_pylist()]
                chunks = vocabulary.numbers(texts)
                found = [vocabulary.n_best_of(at) for at in chunks]
                # a text is the sum of its chunks, and so are the bytes of its best ids
                spelled = [bool(vocabulary.sound[at].all()) or vocabulary.decode(f[0][1]) == t for at, f, t in zip(chunks, found, texts)]
                cuts = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
                flat = [x for f in found for x in f]
                entries = pa.StructArray.from_arrays([pa.array([s for s, _ in flat], pa.float64()), pa.array([i for _, i in flat], pa.binary())],
                                                     names=["score", "ids"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(pa.array(cuts), entries),
                     pa.array(spelled, pa.bool_())], names=["_id", "n_best", "round_trip"])

    return (docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
            .mapInArrow(run, "_id long, n_best array<struct<score:double,ids:binary>>, round_trip boolean").withColumnRenamed("_id", id_col))


def decode(rows: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, ``text``) of rows with ids as ``encode`` gives them; null ids give a null text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(path)
        for batch in batches:
            texts = [None if x is None else vocabulary.decode(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["_id", "text"])

    return (rows.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{ids_col}`").alias("_ids"))
            .mapInArrow(run, "_id long, text string").withColumnRenamed("_id", id_col))
