"""Substring deduplication: words of passages that occur earlier in the corpus are removed.

A window of ``LEAST`` words that also starts earlier (in a document with a
smaller id, or earlier in the same one) is a copy; every word that a copy
covers goes.  Copies are found by suffix automata over reference shards: the
automaton of a shard keeps for each of its states the first place where its
strings end, segments of documents are streamed through it, and their matching
statistics (the longest match that ends at each word) say where a match of the
threshold or more ends and where that match is first found.

An automaton over all text would not fit anywhere, and streaming all text past
all shards would grow with its square.  So each window names an anchor, the
smallest hash of its ``GRAM``-word runs, and windows of one anchor that follow
each other make a segment.  Equal windows have equal anchors, so only anchors
that occur more than once matter, and a segment meets those of its own anchor
alone.  A shard is a set of anchors with about ``SHARD_WORDS`` words in their
segments.  An anchor with more than ``ANCHOR_SEGMENTS`` segments (a frequent
line in ever new surroundings) is taken apart: its windows are grouped by their
words, which comes to the same for single windows.

Documents are dealt into blocks of about ``BLOCK_BYTES`` by their id; a block
sends each distinct anchor and segment once and gets back what concerns it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_KEYS, STEP_BYTES, frozen, partitions, utf8, windows, words, written

LEAST = 20              # words of a window
GRAM = 8                # words of an anchor
BLOCK_BYTES = 4 << 20
SHARD_WORDS = 60_000
ANCHOR_SEGMENTS = 1000
NO_ID = -(1 << 63)      # documents without an id come before all others


def segments(data: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """(row, first window, windows, anchor) of the segments of some texts; windows are counted over all rows' words, with the words."""
    start, end, hashes, first = words(data, offsets)
    gram = min(GRAM, least)
    n = len(hashes) - least + 1
    if n < 1:
        return start, end, first, *(np.zeros(0, np.int64),) * 3, np.zeros(0, np.uint64)
    grams = windows(hashes, gram)
    place = np.arange(n) + np.lib.stride_tricks.sliding_window_view(grams, least - gram + 1).argmin(axis=1)
    row = np.searchsorted(first, np.arange(n), "right") - 1
    inside = np.flatnonzero(np.arange(n) + least <= first[row + 1])
    if not len(inside):
        return start, end, first, *(np.zeros(0, np.int64),) * 3, np.zeros(0, np.uint64)
    place, row = place[inside], row[inside]
    # a window of the next row can't have the same place, but two rows' windows are never neighbours either
    cut = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (row[1:] != row[:-1])]))
    return start, end, first, row[cut], inside[cut], np.diff(np.concatenate([cut, [len(inside)]])), grams[place[cut]]


def _anchors(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .common import steps
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            block = batch.column(0).to_numpy()
            for a, b in steps(offsets):
                _, _, _, row, _, _, anchor = segments(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], least)
                both, n = np.unique(np.stack([block[a:b][row], anchor.view(np.int64)], axis=1), axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(n.astype(np.int64))], names=["block", "anchor", "n"])
    return run


# kind 1: a segment that may be a copy, once per block; kind 2: a document with such segments; kind 3: a document without, done
_FOUND = "block long, kind int, doc long, seg int, at long, anchor long, content binary, words binary, _id long, text string, segs binary, n_words long"
_ARROW = pa.schema([(c, {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}[t]) for c, t in (x.split() for x in _FOUND.split(", "))])


def _rows(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in rows], f.type) for f in _ARROW], schema=_ARROW)


def _kept(raw: list[bytes], digest: bool) -> str:
    text = b" ".join(raw)
    return hashlib.sha256(text).hexdigest() if digest else text.decode()


def _by_block(least: int, digest: bool):
    """Rows come block by block: the anchors that occur more than once (kind 0), then the documents by id (kind 2)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, anchors, known, made, step, size = None, [], {}, 0, [], 0

        def work() -> Iterator[pa.RecordBatch]:
            """The documents of ``step``; one whose id others share too has segments of one window, so that they order like windows."""
            nonlocal made
            hits = np.array(sorted(anchors), np.int64)
            data, offsets = utf8(pa.array([t for _, t, _ in step], pa.large_string()))
            start, end, first, row, at, count, anchor = segments(data, offsets, least)
            keep = np.isin(anchor.view(np.int64), hits)
            out, segs = [], [[] for _ in step]
            for r, i, n, x in zip(*(v[keep].tolist() for v in (row, at, count, anchor.view(np.int64)))):
                doc, _, shared = step[r]
                for p, m in ([(i + k, 1) for k in range(n)] if shared else [(i, n)]):
                    raw = b" ".join(data[start[p]:end[p + m + least - 2]].tobytes().split())
                    content = hashlib.blake2b(raw, digest_size=16).digest()
                    place = (NO_ID if doc is None else doc, p - int(first[r]))
                    seg, least_place = known.get(content, (None, place))
                    if seg is None or place < least_place:      # documents come in the order of their ids; rows of one id in any
                        seg, made = made, made + 1
                        known[content] = seg, place
                        out.append(dict(block=block, kind=1, doc=NO_ID if doc is None else doc, seg=seg, at=p - int(first[r]), anchor=x, content=content, words=raw, n_words=m + least - 1))
                    segs[r].append((seg, p - int(first[r]), m))
            for (doc, text, _), some, n in zip(step, segs, np.diff(first).tolist()):
                if some:
                    out.append(dict(block=block, kind=2, doc=NO_ID if doc is None else doc, _id=doc, text=text, n_words=n, segs=np.array(some, np.int32).tobytes()))
                else:
                    out.append(dict(block=block, kind=3, _id=doc, n_words=n, text=_kept((text or "").encode().split(), digest)))
            step.clear()
            yield _rows(out)

        for b in batches:
            for new, kind, anchor, doc, text, shared in zip(*(c.to_pylist() for c in b.columns)):
                if new != block:
                    if step:
                        yield from work()
                    block, anchors, known, made, size = new, [], {}, 0, 0
                if kind == 0:
                    anchors.append(anchor)
                    continue
                step.append((doc, text, shared))
                size += len(text or "")
                if size >= STEP_BYTES:
                    yield from work()
                    size = 0
        if step:
            yield from work()
    return run


class Automaton:
    """A suffix automaton over several word sequences: of each state the transitions, suffix link, longest length and first end."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.first = [-1], [0], [None]
        self.last = 0

    def _state(self, transitions: dict, length: int, first) -> int:
        self.next.append(transitions)
        self.link.append(0)
        self.length.append(length)
        self.first.append(first)
        return len(self.next) - 1

    def begin(self) -> None:
        """A new sequence."""
        self.last = 0

    def _split(self, p: int, q: int, word) -> int:
        """The state of p's longest string and ``word``, taken out of q."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.next[q].copy(), self.length[p] + 1, self.first[q])
        self.link[clone], self.link[q] = self.link[q], clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def extend(self, word, place) -> None:
        p = self.last
        q = self.next[p].get(word)
        if q is not None:
            self.last = self._split(p, q, word)
            return
        new = self._state({}, self.length[p] + 1, place)
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        self.link[new] = self._split(p, self.next[p][word], word) if p >= 0 else 0
        self.last = new

    def statistics(self, sequence, least: int) -> Iterator:
        """For each word the first end of the ``least`` words that end there, or None where no match is that long."""
        state, matched = 0, 0
        for word in sequence:
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if word in self.next[state]:
                state, matched = self.next[state][word], matched + 1
            while state and self.length[self.link[state]] >= least:     # the state of the last ``least`` words
                state = self.link[state]
                matched = self.length[state]
            yield self.first[state] if matched >= least else None


def _sharded(least: int):
    """Rows come shard by shard, in the order of their places; per distinct segment its first place and which windows occur earlier."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, found = None, {}

        def work() -> pa.RecordBatch:
            reference = Automaton()
            split = [(content, doc, at, raw.split()) for content, (doc, at, raw) in found.items()]
            n = 0               # words are numbered as they come, that is in the order of their places
            for *_, some in split:
                reference.begin()
                for word in some:
                    reference.extend(word, n)
                    n += 1
            masks, n = [], 0
            for *_, some in split:
                ends = list(reference.statistics(some, least))[least - 1:]
                masks.append(bytes(e < k for k, e in enumerate(ends, n + least - 1)))
                n += len(some)
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in split], pa.binary()), pa.array([x[1] for x in split], pa.int64()),
                                               pa.array([x[2] for x in split], pa.int64()), pa.array(masks, pa.binary())], names=["content", "doc", "at", "mask"])

        for b in batches:
            for new, content, doc, at, raw in zip(*(c.to_pylist() for c in b.columns)):
                if new != shard:
                    if found:
                        yield work()
                    shard, found = new, {}
                found.setdefault(content, (doc, at, raw))
        if found:
            yield work()
    return run


def _apart(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for content, doc, at, raw in zip(*(c.to_pylist() for c in b.columns)):
                some = raw.split()
                out += [(content, doc, at, k, hashlib.blake2b(b" ".join(some[k:k + least]), digest_size=16).digest()) for k in range(len(some) - least + 1)]
                if len(out) > 20_000:
                    yield _windows(out)
                    out = []
            yield _windows(out)
    return run


def _windows(rows: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
                                      names=["content", "doc", "at", "k", "window"])


def _first_places(found: DataFrame, least: int, shard_words: int, anchor_segments: int) -> DataFrame:
    """(``content``, ``doc``, ``at``, ``mask``) of each distinct segment: its first place, and which of its windows occur before that."""
    rows = found.where("kind = 1").select("anchor", "content", "doc", "at", "words")
    loads = frozen(rows.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > anchor_segments).select("anchor"))
    total = found.where("kind = 1").agg(F.sum("n_words")).first()[0] or 0
    shards = max(1, -(-total // shard_words))
    many = F.broadcast(loads) if loads.count() <= BROADCAST_KEYS else loads
    cold = rows.join(many, "anchor", "left_anti").select(F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard"), "content", "doc", "at", "words")
    cold = (cold.repartition(min(shards, 4 * partitions(found.sparkSession)) if shards > 1 else 1, "shard").sortWithinPartitions("shard", "doc", "at")
            .mapInArrow(_sharded(least), "content binary, doc long, at long, mask binary"))
    hot = (rows.join(many, "anchor", "left_semi").groupBy("content").agg(F.min(F.struct("doc", "at", "words")).alias("x"))
           .select("content", "x.doc", "x.at", "x.words").mapInArrow(_apart(least), "content binary, doc long, at long, k int, window binary"))
    hot = written(hot)
    first = hot.groupBy("window").agg(F.min(F.struct(F.col("doc"), (F.col("at") + F.col("k")).alias("at"))).alias("first"))
    earlier = F.col("first") < F.struct(F.col("doc"), (F.col("at") + F.col("k")).alias("at"))
    bits = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", earlier.cast("int").alias("e")))), lambda x: F.lpad(x["e"].cast("string"), 2, "0")), "")
    hot = hot.join(first, "window").groupBy("content", "doc", "at").agg(F.unhex(bits).alias("mask"))
    return cold.unionByName(hot)


def _removed(least: int, digest: bool):
    """Rows come block by block: the segments' first places (kind 1), then the documents (kind 2)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, places = None, {}
        for b in batches:
            out = []
            for new, kind, seg, doc, at, mask, id_, text, segs, n_words in zip(*(c.to_pylist() for c in b.columns)):
                if new != block:
                    block, places = new, {}
                if kind == 1:
                    places[seg] = (doc, at, mask)
                    continue
                change = np.zeros(n_words + 1, np.int32)
                for s, p, n in np.frombuffer(segs, np.int32).reshape(-1, 3).tolist():
                    if places[s][:2] == (doc, p):
                        copies = np.flatnonzero(np.frombuffer(places[s][2], np.uint8)) + p
                        np.add.at(change, copies, 1)
                        np.add.at(change, copies + least, -1)
                    else:               # all windows of a segment that is first found elsewhere
                        change[p] += 1
                        change[p + n + least - 1] -= 1
                gone = np.cumsum(change[:-1]) > 0
                turns = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))).tolist()
                raw, kept, last = text.encode().split(), [], 0
                for p, q in zip(turns[::2], turns[1::2]):
                    kept += raw[last:p]
                    last = q
                out.append((id_, n_words, int(gone.sum()), [{"start": p, "end": q} for p, q in zip(turns[::2], turns[1::2])], _kept(kept + raw[last:], digest)))
            columns = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (
                pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.string()))],
                names=["_id", "n_words", "n_removed", "removed", "kept"])
    return run


def drop_copied_passages(docs: DataFrame, least: int = LEAST, digest: bool = False, id_col: str = "doc_id", text_col: str = "text",
                         shard_words: int = SHARD_WORDS, anchor_segments: int = ANCHOR_SEGMENTS) -> DataFrame:
    """One row per input row: id, ``n_words``, ``n_removed``, ``removed``, ``kept``.

    Words are runs without ASCII white space, compared as they are.  A window
    is ``least`` consecutive words of one text; a word goes if a window over it
    has the same words as one that starts earlier: in a row with a smaller id,
    or at an earlier word in a row with the same id.  Rows with one id count
    as one place, so equal rows lose the same words.  A missing id comes
    before all others.  Windows are judged on the input.  ``removed``: the
    word ranges that go (end exclusive); ``kept``: the other words, joined by
    one space (``digest``: the SHA-256 of that in lowercase hex).  A null text
    counts as empty.  Other columns are not read.  An empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    ids = F.col(f"`{id_col}`").cast("long")
    docs = docs.select(ids.alias("doc"), F.col(f"`{text_col}`").cast("string").alias("text"))
    blocks = max(1, -(-(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BLOCK_BYTES))
    docs = docs.select(F.pmod(F.xxhash64("doc"), F.lit(blocks)).alias("block"), "doc", "text")
    anchors = written(docs.select("block", "text").mapInArrow(_anchors(least), "block long, anchor long, n long"))
    often = anchors.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor")
    hits = anchors.select("block", "anchor").join(often, "anchor", "left_semi").select("block", F.lit(0).alias("kind"), "anchor")
    # an id that more than one row has
    shared = docs.groupBy("doc").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select(F.pmod(F.xxhash64("doc"), F.lit(blocks)).alias("block"), "doc")
    shared = shared.select("block", F.lit(1).alias("kind"), "doc")
    rows = hits.unionByName(shared, allowMissingColumns=True).unionByName(docs.withColumn("kind", F.lit(2)), allowMissingColumns=True)
    rows = rows.select("block", "kind", "anchor", "doc", "text").repartition(partitions(spark), "block").sortWithinPartitions("block", "kind", "doc")
    found = written(rows.mapInArrow(_with_shared(_by_block(least, digest)), _FOUND))
    places = _first_places(found, least, shard_words, anchor_segments)
    places = (found.where("kind = 1").select("block", "kind", "seg", "content").join(places, "content")
              .select("block", "kind", "seg", "doc", "at", "mask"))
    rest = found.where("kind = 2").select("block", "kind", "doc", "_id", "text", "segs", "n_words")
    rows = places.unionByName(rest, allowMissingColumns=True).select("block", "kind", "seg", "doc", "at", "mask", "_id", "text", "segs", "n_words")
    rows = rows.repartition(partitions(spark), "block").sortWithinPartitions("block", "kind")
    changed = rows.mapInArrow(_removed(least, digest), "_id long, n_words long, n_removed long, removed array<struct<start:long,end:long>>, kept string")
    same = found.where("kind = 3").select("_id", "n_words", F.lit(0).cast("long").alias("n_removed"),
                                          F.array().cast("array<struct<start:long,end:long>>").alias("removed"), F.col("text").alias("kept"))
    return changed.unionByName(same).withColumnRenamed("_id", id_col)


def _with_shared(run):
    """Marks the documents whose id is listed (kind 1) before them in their block."""
    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, listed = None, set()
        for b in batches:
            flags = []
            for new, kind, doc in zip(*(b.column(i).to_pylist() for i in (0, 1, 3))):
                if new != block:
                    block, listed = new, set()
                if kind == 1:
                    listed.add(doc)
                flags.append(kind == 2 and doc in listed)
            keep = pa.array([k != 1 for k in b.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(flags, pa.bool_())], names=[*b.schema.names, "shared"]).filter(keep)

    return lambda batches: run(marked(batches))
