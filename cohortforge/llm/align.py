"""Alignment of two tokenizers' tokens of the same texts.

Both token sequences of a text are matrices over its bytes: a row per token
with a 1 in each byte that it covers.  The product of the one with the other's
transpose (``sparse``) links tokens that overlap, with the number of bytes
they share; the places where both tokens of a link end cut the text into
groups, and the product of the two token-group matrices links all tokens of a
group.  Links are counted over the whole corpus by their pair of token ids.

A space between two other characters is a boundary for both tokenizers, so a
text falls into chunks (spaces and what follows them) that have the same
tokens by themselves; equal chunks are aligned once per worker, many side by
side in one block-diagonal product.  Texts that don't fall apart so (white
space of other kinds next to a space, zero characters) are aligned whole.

Counts go through Spark by blocks of documents (``BLOCK_BYTES`` of text): a
block sends each of its id pairs once, and gets back the corpus-wide counts of
these pairs alone.  No table of pairs is broadcast or collected.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions, steps, utf8, written
from .sparse import Rows
from .tokens import Encoder

BLOCK_BYTES = 8 << 20
CACHE = 400_000         # chunks that a worker keeps from block to block
KINDS = ("end", "overlap", "group")


def spans_of(a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[tuple, np.ndarray, np.ndarray, np.ndarray]:
    """(overlap links, which of them end together, group of each A token, group of each B token) of sequences over the same bytes."""
    a, b = Rows.of_runs(a_sizes), Rows.of_runs(b_sizes)
    links = a.product(b.transposed())
    together = a.starts[1:][links[0]] == b.starts[1:][links[1]]
    ends = a.starts[1:][links[0][together]]                     # ascending: the last byte of each group, exclusive
    return links, together, np.searchsorted(ends, a.starts[1:]), np.searchsorted(ends, b.starts[1:])


class Aligner:
    """Two vocabularies: a byte-level BPE file of ``tokenizers`` (A) and a model of ``sentencepiece`` (B)."""

    def __init__(self, path_a: str, path_b: str, kind: str = "end"):
        import sentencepiece

        if kind not in KINDS:
            raise ValueError(f"kind must be one of {KINDS}")
        self.kind = kind
        self.a = Encoder(path_a)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        by_id = {i: t for t, i in self.a.tokenizer.get_vocab().items()}
        from .tokens import _bytes_of_letters
        letters = _bytes_of_letters()
        self.a_bytes = [bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t in (by_id.get(i, "") for i in range(max(by_id) + 1))]
        self.b_bytes = [bytes([int(self.b.id_to_piece(i)[3:-1], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode()
                        for i in range(self.b.get_piece_size())]
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        self.clear()

    def clear(self) -> None:
        """No chunk is known.  Entry i: ``stats[i]`` (tokens of A and B, groups, links), ``groups[i]``, its links from ``starts[i]`` on."""
        self.index: dict[str, int] = {}         # a chunk's entry; -1: it can't stand by itself
        self.groups: list[str] = []
        self._stats, self._keys, self._times = [np.zeros((0, 5), np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(``stats``, ``starts``, link keys, their multiplicities) of all entries."""
        self._stats, self._keys, self._times = ([np.concatenate(x)] if len(x) > 1 else x for x in (self._stats, self._keys, self._times))
        stats = self._stats[0]
        return stats[:, :4], np.concatenate([[0], np.cumsum(stats[:, 4])]).astype(np.int64), self._keys[0], self._times[0]

    def _tokens(self, ids: np.ndarray, table: list[bytes]) -> bytes:
        return b"".join(map(table.__getitem__, ids.tolist()))

    def add(self, chunks: list[str]) -> list[int]:
        """The entries of chunks, each a space and a text; -1 where either tokens' bytes are not the chunk's."""
        if not chunks:
            return []
        a_ids = self.a._encode(chunks) if not self.a.taken else self.a.ids(chunks)
        b_ids = self.b.encode([c[1:] for c in chunks], num_threads=1)
        a, b = np.frombuffer(b"".join(a_ids), "<u4").astype(np.int64), np.array([x for ids in b_ids for x in ids], np.int64)
        a_from, b_from = (np.concatenate([[0], np.cumsum(x)]).astype(np.int64) for x in ([len(x) // 4 for x in a_ids], list(map(len, b_ids))))
        raw = [c.encode() for c in chunks]
        ends = np.cumsum(list(map(len, raw)))
        a_end, b_end = (np.concatenate([[0], np.cumsum(size[x])])[f[1:]] for size, x, f in ((self.a_size, a, a_from), (self.b_size, b, b_from)))
        if not (np.array_equal(a_end, ends) and np.array_equal(b_end, ends) and self._tokens(a, self.a_bytes) == b"".join(raw) == self._tokens(b, self.b_bytes)):
            good = [i for i, c in enumerate(raw) if self._tokens(a[a_from[i]:a_from[i + 1]], self.a_bytes) == c == self._tokens(b[b_from[i]:b_from[i + 1]], self.b_bytes)]
            if len(good) < len(chunks):
                out = [-1] * len(chunks)
                for i, e in zip(good, self.add([chunks[i] for i in good])):
                    out[i] = e
                return out
        links, together, a_group, b_group = spans_of(self.a_size[a], self.b_size[b])
        rows, columns = links[0], links[1]
        if self.kind == "end":
            rows, columns = rows[together], columns[together]
        elif self.kind == "group":
            n = int(a_group[-1]) + 1
            rows, columns, _ = Rows.of_members(a_group, n).product(Rows.of_members(b_group, n).transposed())
        chunk = np.searchsorted(a_from, rows, "right") - 1
        keys = a[rows] << 32 | b[columns]
        order = np.lexsort((keys, chunk))
        keys, chunk = keys[order], chunk[order]
        first = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (chunk[1:] != chunk[:-1])]))
        # the groups as text, group by group
        a_cut, b_cut = (np.concatenate([np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])), [len(g)]]).tolist() for g in (a_group, b_group))
        names_a, names_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
        groups = [f"{names_a[p] if q - p == 1 else ','.join(names_a[p:q])}|{names_b[r] if t - r == 1 else ','.join(names_b[r:t])}"
                  for p, q, r, t in zip(a_cut, a_cut[1:], b_cut, b_cut[1:])]
        group_from = np.concatenate([a_group[a_from[:-1]], [len(groups)]])
        start = len(self.groups)
        cuts = group_from.tolist()
        self.groups += [";".join(groups[p:q]) for p, q in zip(cuts, cuts[1:])]
        n = len(chunks)
        self._stats.append(np.stack([np.diff(a_from), np.diff(b_from), np.diff(group_from), np.bincount(chunk, minlength=n), np.bincount(chunk[first], minlength=n)], axis=1))
        self._keys.append(keys[first])
        self._times.append(np.diff(np.concatenate([first, [len(keys)]])))
        return list(range(start, start + n))

    def learn(self, chunks: set[str]) -> None:
        alone = [c for c in chunks if c[1:2] and not c[1].isspace() and not c[-1].isspace()]
        self.index.update(dict.fromkeys(chunks, -1))
        self.index.update(zip(alone, self.add(alone)))

    def entries(self, texts: list[str]) -> list[np.ndarray]:
        """For each text the entries of its chunks; a text without tokens has none."""
        chunks = [(" " + t).replace(" ", "\0 ").split("\0")[1:] if t and "\0" not in t and not any(x in t for x in self.a.taken) else None for t in texts]
        missing = set().union(*(c for c in chunks if c)) - self.index.keys()
        if missing:
            self.learn(missing)
        number = self.index.__getitem__
        out = [np.fromiter(map(number, c), np.int64, len(c)) if c else np.zeros(0, np.int64) for c in chunks]
        whole = [i for i, (t, e) in enumerate(zip(texts, out)) if t and (not len(e) or e.min() < 0)]
        for i, e in zip(whole, self.add([" " + texts[i] for i in whole])):
            out[i] = np.array([e] if e >= 0 else [], np.int64)
        return out


_aligners: dict[tuple, Aligner] = {}


def aligner(path_a: str, path_b: str, kind: str) -> Aligner:
    if (path_a, path_b, kind) not in _aligners:
        _aligners[path_a, path_b, kind] = Aligner(path_a, path_b, kind)
    return _aligners[path_a, path_b, kind]


# Rows of the table in between.  kind 0: one of the block's id pairs, with its place among them and how many links
# hold it there; kind 1: the block's entries and their links; kind 2: a document, with its distinct entries.
_TABLE = ("block long, kind int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, "
          "at binary, times binary, starts binary, place binary, pos int, key long, n long")


class _Block:
    """Documents whose entries are numbered alike."""

    def __init__(self, number: int, both: Aligner):
        self.number, self.both, self.uses = number, both, []
        if len(both.index) > CACHE:
            both.clear()

    def documents(self, ids: list, texts: list[str], digest: bool) -> pa.RecordBatch:
        entries = self.both.entries(texts)
        stats, name = self.both.tables()[0], self.both.groups.__getitem__
        rows = []
        for doc_id, found in zip(ids, entries):
            at, times = np.unique(found, return_counts=True)
            self.uses.append((at, times))
            total = (times @ stats[at]).tolist()
            groups = ";".join(map(name, found.tolist()))
            if digest and groups:
                groups = hashlib.sha256(groups.encode()).hexdigest()
            rows.append(dict(block=self.number, kind=2, doc_id=doc_id, n_a=total[0], n_b=total[1], n_groups=total[2], n_links=total[3],
                             groups=groups, at=at.astype(np.int32).tobytes(), times=times.astype(np.int32).tobytes()))
        return _batch(rows)

    def rows(self) -> list[pa.RecordBatch]:
        stats, starts, keys, times = self.both.tables()
        uses = np.zeros(len(stats), np.int64)
        for at, n in self.uses:
            uses[at] += n
        used = np.flatnonzero(uses)
        sizes = starts[used + 1] - starts[used]
        own = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        here = np.arange(own[-1]) + np.repeat(starts[used] - own[:-1], sizes)
        distinct, place = np.unique(keys[here], return_inverse=True)
        n = np.zeros(len(distinct), np.int64)
        np.add.at(n, place, times[here] * np.repeat(uses[used], sizes))
        return [_batch([dict(block=self.number, kind=1, at=used.astype(np.int32).tobytes(), times=times[here].astype(np.int32).tobytes(),
                             starts=own.tobytes(), place=place.astype(np.int32).tobytes())]),
                _columns(len(distinct), block=np.full(len(distinct), self.number), kind=np.zeros(len(distinct), np.int32),
                         pos=np.arange(len(distinct), dtype=np.int32), key=distinct, n=n)]


_ARROW = pa.schema([(c, {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}[t])
                    for c, t in (x.split() for x in _TABLE.split(", "))])


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in rows], f.type) for f in _ARROW], schema=_ARROW)


def _columns(rows: int, **given: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(given[f.name], f.type) if f.name in given else pa.nulls(rows, f.type) for f in _ARROW], schema=_ARROW)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with ``n_best`` and ``count_sum``; of a block, the pairs come first (kind 0), then the chunks (1), then the documents (2)."""
    block, used, best, total = None, None, None, None
    pairs: list[tuple] = []
    for b in batches:
        found = []
        names = b.schema.names
        for row in zip(*(c.to_pylist() for c in b.columns)):
            r = dict(zip(names, row))
            if r["block"] != block:
                block, pairs = r["block"], []
            if r["kind"] == 0:
                pairs.append((r["pos"], r["count"], r["top"]))
            elif r["kind"] == 1:
                table = np.zeros((2, len(pairs)), np.int64)
                for pos, count, top in pairs:
                    table[:, pos] = count, top
                used, place, times, starts = (np.frombuffer(r[c], t) for c, t in (("at", np.int32), ("place", np.int32), ("times", np.int32), ("starts", np.int64)))
                sums = np.zeros((2, len(place) + 1), np.int64)
                np.cumsum(table[:, place] * times, axis=1, out=sums[:, 1:])
                total, best = sums[:, starts[1:]] - sums[:, starts[:-1]]
            else:
                at, times = np.searchsorted(used, np.frombuffer(r["at"], np.int32)), np.frombuffer(r["times"], np.int32).astype(np.int64)
                found.append([r[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")] + [int((best[at] * times).sum()), int((total[at] * times).sum()), r["groups"]])
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string() if k == 7 else pa.int64()) for k, c in enumerate(zip(*found))],
                                             names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"])


def _table(docs: DataFrame, path_a: str, path_b: str, kind: str, digest: bool, id_col: str, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(path_a, path_b, kind)
        block, size = _Block(TaskContext.get().partitionId() << 32, both), 0
        for batch in batches:
            offsets = utf8(batch.column(1))[1]
            for a, b in steps(offsets):
                ids, texts = batch.column(0).slice(a, b - a).to_pylist(), batch.column(1).slice(a, b - a).to_pylist()
                yield block.documents(ids, [t or "" for t in texts], digest)
                size += int(offsets[b] - offsets[a])
                if size >= BLOCK_BYTES:
                    yield from block.rows()
                    block, size = _Block(block.number + 1, both), 0
        yield from block.rows()

    return written(docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(run, _TABLE))


def _counts(table: DataFrame) -> DataFrame:
    """(``key``, ``count``, ``top``): corpus-wide; ``top`` is 1 where no other pair of the B id has more."""
    counts = table.where("kind = 0").groupBy("key").agg(F.sum("n").alias("count")).withColumn("b", F.col("key").bitwiseAND(0xFFFFFFFF))
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    return counts.join(most, "b").select("key", "count", (F.col("count") == F.col("most")).cast("int").alias("top"))


def pair_counts(docs: DataFrame, path_a: str, path_b: str, kind: str = "end", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``a``, ``b``, ``count``, ``top``): how many links of all texts hold each pair of token ids; ``kind`` as in ``align``."""
    return _counts(_table(docs, path_a, path_b, kind, True, id_col, text_col)).select(
        F.shiftright("key", 32).alias("a"), F.col("key").bitwiseAND(0xFFFFFFFF).alias("b"), "count", (F.col("top") == 1).alias("top"))


def align(docs: DataFrame, path_a: str, path_b: str, kind: str = "end", digest: bool = False, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups``.

    A encodes a space and the text, B the text (and puts a space before it
    itself); strings of special tokens are ordinary text.  ``groups``: the
    token ids between the places where tokens of both end, as
    ``a1,a2|b1;a3|b2,b3`` (``digest``: the SHA-256 of that in lowercase hex).
    Links by ``kind``: ``end``, tokens that end together; ``overlap``, tokens
    that share bytes; ``group``, all pairs in a group.  ``n_best``: links whose
    id pair has the B id's highest corpus-wide count (ties included);
    ``count_sum``: the sum of the links' corpus-wide counts.

    Null and empty texts, and texts whose tokens' bytes are not a space and
    the text, have zeros and empty groups.  Rows that repeat count each time
    and get equal results, rows without an id too.  Other columns are not
    read.  An empty table gives an empty result.  The files are at the same
    place on all executors.
    """
    table = _table(docs, path_a, path_b, kind, digest, id_col, text_col)
    pairs = table.where("kind = 0").select("block", "kind", "pos", "key").join(_counts(table), "key").drop("key")
    rest = table.where("kind > 0").select("block", "kind", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "at", "times", "starts", "place")
    rows = pairs.unionByName(rest, allowMissingColumns=True)
    rows = rows.repartition(partitions(docs.sparkSession), "block").sortWithinPartitions("block", "kind")
    return rows.mapInArrow(_counted, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
                           ).withColumnRenamed("doc_id", id_col)
