"""Sharding by histogram sort: equal bytes per shard, rows in key order.

The splitters between shards are found by counting, not by sorting or sampling:
candidate boundaries (probes) divide the key range into cells, one aggregate
counts the exact bytes of every cell over all partitions, and only the cells
that hold a splitter are divided again, until the bytes left undecided are
within the tolerance or the cell holds a single key.  Then the rows are
exchanged once, by range.  The driver sees cell totals only: at most
``splitters * probes`` of them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import frozen, partitions

LOW, HIGH = -(2**63), 2**63 - 1
ROW_BYTES = 16      # fixed part of a row's size


@dataclass(frozen=True, order=True)
class Cell:
    """Keys ``lo..hi`` (both included) or, if ``tied``, the tie keys ``lo..hi`` of the one key ``key``."""
    key: int
    tied: bool
    lo: int
    hi: int

    def shift(self, probes: int) -> int:
        """Sub-cells are aligned blocks of ``2**shift`` keys, about ``probes`` of them."""
        return max(0, ((self.hi - self.lo) // probes).bit_length())


def _longs(values: list[int]) -> Column:
    return F.expr(f"cast(split('{','.join(map(str, values))}', ',') as array<bigint>)")


def _search(bounds: list[tuple[int, int]], key: Column, tie: Column) -> Column:
    """How many of the sorted boundaries are at or before (key, tie): a binary search."""
    if not bounds:
        return F.lit(0)
    ks, ts = _longs([b[0] for b in bounds]), _longs([b[1] for b in bounds])
    jumps = [1 << i for i in range(len(bounds).bit_length() - 1, -1, -1)]

    def jump(at: Column, by: Column) -> Column:
        k, t = F.get(ks, at + by - 1), F.get(ts, at + by - 1)
        return F.when((k < key) | ((k == key) & (t <= tie)), at + by).otherwise(at)

    return F.aggregate(F.array(*[F.lit(j) for j in jumps]), F.lit(0), jump)


def histogram(rows: DataFrame, cells: list[Cell], probes: int) -> dict[tuple[int, int], tuple[int, int]]:
    """Exact (bytes, rows) of each sub-cell of the disjoint, sorted cells, by (cell, block number)."""
    lows = [(c.key, c.lo) if c.tied else (c.lo, LOW) for c in cells]
    n = _search(lows, F.col("_key"), F.col("_tie")) - 1
    placed = rows.withColumn("_cell", n).where("_cell >= 0")
    of = lambda values: F.get(_longs(values), F.col("_cell"))
    tied = of([int(c.tied) for c in cells]) == 1
    at = F.when(tied, F.col("_tie")).otherwise(F.col("_key"))
    inside = (at <= of([c.hi for c in cells])) & (~tied | (F.col("_key") == of([c.key for c in cells])))
    block = F.call_function("shiftright", at, of([c.shift(probes) for c in cells]).cast("int"))
    return {(r["_cell"], r["_block"]): (r["_bytes"], r["_rows"]) for r in
            placed.where(inside).groupBy("_cell", block.alias("_block"))
            .agg(F.sum("_size").alias("_bytes"), F.count(F.lit(1)).alias("_rows")).collect()}


def splitters(rows: DataFrame, targets: list[int], tolerance: int, probes: int = 64) -> list[tuple[int, int]]:
    """For each target (bytes), the boundary (key, tie) with the most bytes below it that don't exceed it.

    Within ``tolerance`` bytes, or within one row where a row is larger.
    ``rows`` has ``_key``, ``_tie`` and ``_size``.
    """
    low, high = rows.agg(F.min("_key"), F.max("_key")).first()
    if low is None:
        return [(LOW, LOW)] * len(targets)
    waiting = {i: (Cell(low, False, low, high), 0) for i in range(len(targets))}    # cell, exact bytes below it
    found: dict[int, tuple[int, int]] = {}
    while waiting:
        cells = sorted({c for c, _ in waiting.values()}, key=lambda c: (c.key, c.tied, c.lo))
        each = max(probes, 16 * len(targets) // len(cells))
        counts = histogram(rows, cells, each)
        blocks: dict[int, list[int]] = {}
        for n, block in sorted(counts):
            blocks.setdefault(n, []).append(block)
        for i, (cell, below) in list(waiting.items()):
            n, shift, hit = cells.index(cell), cell.shift(each), None
            for block in blocks.get(n, []):
                size, n_rows = counts[n, block]
                if below + size > targets[i]:
                    hit = block
                    break
                below += size
            if hit is None:         # all of the cell lies below
                found[i] = (cell.key, cell.hi) if cell.tied else (cell.hi, HIGH)
                del waiting[i]
                continue
            lo, hi = max(cell.lo, hit << shift), min(cell.hi, ((hit + 1) << shift) - 1)
            if size <= tolerance or n_rows == 1 and lo == hi or cell.tied and lo == hi:
                found[i] = (cell.key, lo) if cell.tied else (lo, LOW)
                del waiting[i]
            elif lo < hi:
                waiting[i] = (Cell(cell.key if cell.tied else lo, cell.tied, lo, hi), below)
            else:                   # one key: cut between its rows
                waiting[i] = (Cell(lo, True, LOW, HIGH), below)
    return [found[i] for i in range(len(targets))]


def shard(docs: DataFrame, n_shards: int = 40, id_col: str = "doc_id", text_col: str = "text",
          tolerance: float = 1e-4, probes: int = 64) -> DataFrame:
    """Shards ``0..n_shards-1`` of nearly equal bytes, in id order.

    Law ``bytes``: cut where the running size in id order passes each equal
    share, within ``tolerance`` of a share or one row.  Size: UTF-8 bytes of
    the text (null: none) plus 16.  Result: id, ``size``, ``text_crc32``,
    ``law``, ``shard``, ``slot`` (gapless from 0 in id order), ``grown_shard``
    (null under this law).  A null id sorts first.  Rows that share an id are
    ordered by a random tie key, so that even one id's rows can be cut.  Other
    columns are not read.  An empty table gives an empty result.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.crc32(text).alias("_crc"),
                       (F.octet_length(text) + ROW_BYTES).cast("long").alias("_size"))
    rows = rows.withColumns({"_key": F.coalesce(F.col("_id").cast("long"), F.lit(LOW)),
                             "_tie": F.xxhash64("_id", "_crc", F.monotonically_increasing_id())})
    rows = frozen(rows)         # the texts are read once; the tie keys stay as they are
    total = rows.agg(F.sum("_size")).first()[0] or 0
    pieces = max(1, -(-partitions(docs.sparkSession) // n_shards))     # ranges per shard
    n = n_shards * pieces
    bounds = splitters(rows, [total * i // n for i in range(1, n)], int(tolerance * total / n_shards), probes)
    rows = rows.withColumn("_piece", _search(bounds, F.col("_key"), F.col("_tie")))
    # one total per range, shards * pieces in all
    counts = {r["_piece"]: r["_rows"] for r in rows.groupBy("_piece").agg(F.count(F.lit(1)).alias("_rows")).collect()}
    starts = [sum(counts.get(j, 0) for j in range(i - i % pieces, i)) for i in range(n)]
    start = F.get(F.expr(f"cast(split('{','.join(map(str, starts))}', ',') as array<bigint>)"), F.col("_piece"))
    rank = F.row_number().over(Window.partitionBy("_piece").orderBy("_key", "_tie"))
    return rows.select(
        F.col("_id").alias(id_col), F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"),
        F.lit("bytes").alias("law"), F.floor(F.col("_piece") / pieces).cast("int").alias("shard"),
        (start + rank - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
