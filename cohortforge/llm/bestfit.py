"""Best-fit packing by the sum-of-squares rule.

Documents are tokenized, cut only where they exceed a sequence, and packed
whole.  A piece goes where the sum of squares of the numbers of open sequences
per residual gap becomes smallest: gaps stay evenly used, so that fitting
pieces turn up for all of them.  The rule needs the counts per gap only and
places one piece at a time.

Only (id, piece, length) rows are dealt out, evenly and whatever their ids, to
groups of about 100,000 pieces; each group is packed by itself and ends within
a sequence or two of its least number.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import frozen, steps, utf8
from .tokens import cuts, encoder

CAPACITY = 2048
GROUP = 100_000     # pieces packed together
END = np.zeros(1, "<u4").tobytes()

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Packer:
    """Sum-of-squares placement into sequences of ``capacity``."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.count = np.zeros(capacity + 1, np.int64)           # open sequences by gap
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.n = 0

    def place(self, size: int) -> tuple[int, int]:
        """(sequence, offset) of a piece."""
        count, capacity = self.count, self.capacity
        # change of the sum of squares, by the gap that the piece goes to; an exact fit leaves no gap
        change = 2 - 2 * count[size:]
        change[1:] += 2 * count[1:capacity - size + 1]
        change[0] -= 1
        change[count[size:] == 0] = np.iinfo(np.int64).max
        change[-1] = 1 + 2 * count[capacity - size] if size < capacity else 0      # a new sequence
        gap = size + int(np.argmin(change))                     # ties: the smallest gap
        if gap == capacity:
            sequence, self.n = self.n, self.n + 1
        else:
            sequence = self.open[gap].pop()
            count[gap] -= 1
        if gap > size:
            self.open[gap - size].append(sequence)
            count[gap - size] += 1
        return sequence, capacity - gap


def pack(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece; no length exceeds the capacity.

    Sequences that are still open at the end are taken apart, and their pieces
    placed again, the longest first, into the smallest gaps.
    """
    packer = Packer(capacity)
    placed = np.array([packer.place(int(s)) for s in lengths], np.int64).reshape(-1, 2)
    left = np.zeros(packer.n, bool)
    for gap in range(1, capacity + 1):
        left[packer.open[gap]] = True
    again = np.flatnonzero(left[placed[:, 0]]) if len(placed) else np.zeros(0, np.int64)
    if not len(again):
        return placed[:, 0], placed[:, 1]
    numbers = iter(np.flatnonzero(left).tolist())
    count = np.zeros(capacity + 1, np.int64)
    bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    for i in again[np.argsort(-lengths[again], kind="stable")].tolist():
        size = int(lengths[i])
        fits = np.flatnonzero(count[size:])
        gap = size + int(fits[0]) if len(fits) else capacity
        if gap == capacity:
            sequence = next(numbers, None)
            if sequence is None:
                sequence, packer.n = packer.n, packer.n + 1
        else:
            sequence = bins[gap].pop()
            count[gap] -= 1
        if gap > size:
            bins[gap - size].append(sequence)
            count[gap - size] += 1
        placed[i] = sequence, capacity - gap
    return placed[:, 0], placed[:, 1]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces (``PIECE``) of all documents: ids of the text, then id 0."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            offsets = utf8(batch.column(1))[1]
            for a, b in steps(offsets):
                ids = batch.column(0).slice(a, b - a).to_pylist()
                texts = [t or "" for t in batch.column(1).slice(a, b - a).to_pylist()]
                rows = []
                for doc, tokens in zip(ids, encode.ids(texts)):
                    tokens += END
                    for k, (start, n) in enumerate(cuts(len(tokens) // 4, capacity)):
                        rows.append((doc, k, start, n, zlib.crc32(tokens[4 * start:4 * (start + n)])))
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int32() if i == 1 else pa.int64()) for i, c in enumerate(columns)],
                    names=[x.split()[0] for x in PIECE.split(", ")])

    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(cut, PIECE)


def best_fit(docs: DataFrame, path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text",
             group: int = GROUP) -> DataFrame:
    """One row per piece: ``PIECE`` and its ``sequence_id`` and ``offset``.

    ``path``: the tokenizer's JSON file, at the same place on all executors.
    A null text counts as empty; an empty one is a piece of one id (0).
    Documents longer than ``capacity`` are cut into pieces of ``capacity``
    after a shorter first one; all others stay whole.  Rows that repeat are
    packed as often as they occur.  A null id stays null.  Other columns are
    not read.  An empty table gives an empty result.
    """
    rows = frozen(pieces(docs, path, capacity, id_col, text_col))
    groups = max(1, -(-rows.count() // group))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        table = pa.Table.from_batches(batches).combine_chunks()
        sequence, offset = pack(table["length"].to_numpy(), capacity)
        first = TaskContext.get().partitionId() << 32
        table = table.append_column("sequence_id", pa.array(sequence + first)).append_column("offset", pa.array(offset))
        yield from table.to_batches(10_000)

    return rows.repartition(groups).mapInArrow(place, PIECE + ", sequence_id long, offset long")
