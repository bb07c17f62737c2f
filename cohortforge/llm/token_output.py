"""Packed token-id matrices, ready to train on.

Each task tokenizes its documents and collects them into blocks of about four
million ids.  A block is packed by best-fit decreasing: pieces from the longest
to the shortest, each into the fullest sequence that still has room, found in
a segment tree over the free capacities.  A row of the result is one sequence
of the block's matrix.  Nothing is shuffled: a block's packing needs no other
block, and loses at most part of its last sequences.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import steps, utf8
from .tokens import cuts, encoder

WIDTH = 2048
BLOCK = 1 << 22     # ids of a block, 16 MB
END_ID = 50256      # the vocabulary's end-of-text id

ROW = ("block long, row int, ids binary, cu_seqlens array<int>, position_resets array<int>, "
       "doc_ids array<long>, starts array<long>")


class CapacityTree:
    """Which free capacities occur: a segment tree that finds the smallest one that suffices."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, capacity: int, by: int) -> None:
        node = capacity + self.leaves
        while node:
            self.count[node] += by
            node >>= 1

    def smallest(self, size: int) -> int | None:
        """The smallest capacity of ``size`` or more."""
        node = size + self.leaves
        if self.count[node]:
            return size
        while node > 1 and (node & 1 or not self.count[node + 1]):     # up to a right neighbour that holds some
            node >>= 1
        if node <= 1:
            return None
        node += 1
        while node < self.leaves:
            node = 2 * node if self.count[2 * node] else 2 * node + 1
        return node - self.leaves


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """The pieces of each sequence."""
    tree = CapacityTree(capacity)
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    out: list[list[int]] = []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        size = lengths[i]
        room = tree.smallest(size)
        if room is None:
            sequence, room = len(out), capacity
            out.append([])
        else:
            sequence = free[room].pop()
            tree.add(room, -1)
        out[sequence].append(i)
        if room > size:
            free[room - size].append(sequence)
            tree.add(room - size, 1)
    return out


def packed_ids(docs: DataFrame, path: str, width: int = WIDTH, end_id: int = END_ID, block: int = BLOCK,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per packed sequence.

    ``ids``: ``width`` little-endian unsigned 32-bit ids, filled up with
    ``end_id``; ``cu_seqlens``: 0 and the end of each segment; ``position_resets``:
    where positions start again at 0, one per segment and one for the filling;
    ``doc_ids`` and ``starts``: whose ids a segment holds, and from which on.
    A document is its ids and ``end_id``; one that exceeds ``width`` is cut
    (first piece shorter) and its pieces are packed like documents, so joining
    the segments of an id by ``starts`` gives the document back.  A null text
    counts as empty (``end_id`` alone).  Rows that repeat are written as often
    as they occur; a null id stays null.  Other columns are not read.  An empty
    table gives an empty result.
    """
    end = np.array([end_id], "<u4").tobytes()

    def matrix(number: int, pieces: list[tuple]) -> pa.RecordBatch:
        sequences = best_fit_decreasing([len(p[2]) // 4 for p in pieces], width)
        ids, ends, resets, names, starts = [], [], [], [], []
        for members in sequences:
            row = b"".join(pieces[i][2] for i in members)
            cu = np.concatenate([[0], np.cumsum([len(pieces[i][2]) // 4 for i in members])]).tolist()
            ids.append(row + end * (width - cu[-1]))
            ends.append(cu)
            resets.append(cu if cu[-1] < width else cu[:-1])
            names.append([pieces[i][0] for i in members])
            starts.append([pieces[i][1] for i in members])
        return pa.RecordBatch.from_arrays(
            [pa.array([number] * len(ids), pa.int64()), pa.array(range(len(ids)), pa.int32()), pa.array(ids, pa.binary()),
             pa.array(ends, pa.list_(pa.int32())), pa.array(resets, pa.list_(pa.int32())),
             pa.array(names, pa.list_(pa.int64())), pa.array(starts, pa.list_(pa.int64()))],
            names=[x.split()[0] for x in ROW.split(", ")])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        number, size, pieces = TaskContext.get().partitionId() << 32, 0, []
        for batch in batches:
            for a, b in steps(utf8(batch.column(1))[1]):
                ids = batch.column(0).slice(a, b - a).to_pylist()
                texts = [t or "" for t in batch.column(1).slice(a, b - a).to_pylist()]
                for doc, tokens in zip(ids, encode.ids(texts)):
                    tokens += end
                    for start, n in cuts(len(tokens) // 4, width):
                        pieces.append((doc, start, tokens[4 * start:4 * (start + n)]))
                    size += len(tokens) // 4
                    if size >= block:
                        yield matrix(number, pieces)
                        number, size, pieces = number + 1, 0, []
        if pieces:
            yield matrix(number, pieces)

    return docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{text_col}`").alias("_text")).mapInArrow(write, ROW)
