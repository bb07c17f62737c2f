"""Helpers shared by the corpus operators: frozen tables, Arrow text access, word hashes."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortforge.session import checkpoint_dir

_U64 = np.uint64
# One random 64-bit value per byte and one odd multiplier (with its inverse mod
# 2**64): a word's hash is a polynomial over the byte values, mixed at the end.
_BYTE = np.random.default_rng(20240607).integers(0, 2**64, 256, dtype=_U64)
_MUL = 0x9E3779B97F4A7C15
_INV = pow(_MUL, -1, 2**64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True

STEP_BYTES = 1 << 20    # texts are worked through in steps of about this size


def frozen(df: DataFrame, rows: int | None = None, each: int = 10_000) -> DataFrame:
    """``df`` written once to the shared checkpoint folder; later reads take those files.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation,
    and values that depend on the partitioning stay as they are.

    ``rows``: how many rows there are, about; a file for every ``each`` of them
    is then the most, however many partitions the session shuffles into.
    """
    checkpoint_dir(df.sparkSession)
    if rows is not None:
        df = df.coalesce(1 + rows // each)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """As ``frozen``, but as a Parquet table in that folder: compressed, and read by column."""
    path = f"{checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BROADCAST_KEYS = 2_000_000      # (id, hash) pairs of 16 bytes: 32 MB


def text_hash(text: Column) -> Column:
    return F.xxhash64(text.cast("string"))


def unused(docs: DataFrame, name: str) -> str:
    """``name``, with as many underscores after it as it takes to be no column of ``docs``."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(docs: DataFrame, dropped: DataFrame, id_col: str, text_col: str, rows: int | None = None) -> DataFrame:
    """``docs`` without the rows whose id and text hash are in ``dropped`` (``_id``, ``_hash``), all columns as they were.

    The texts are not shuffled while the dropped keys are few enough to be broadcast.  ``rows``: at most how many are dropped, if known.
    """
    names = unused(docs, "_dropped_id"), unused(docs, "_dropped_hash")
    dropped = frozen(dropped.select(F.col("_id").alias(names[0]), F.col("_hash").alias(names[1])).distinct(), rows, 100_000)
    if dropped.count() <= BROADCAST_KEYS:
        dropped = F.broadcast(dropped)
    same = (F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col(names[0]))
            & (text_hash(F.col(f"`{text_col}`")) == F.col(names[1])))
    return docs.join(dropped, same, "left_anti")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    h = h ^ (h >> _U64(31))
    h = h * _U64(0x7FB5D329728EA185)
    h = h ^ (h >> _U64(27))
    h = h * _U64(0x81DADEF4BC2DD44D)
    return h ^ (h >> _U64(33))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array and its row offsets (null: empty)."""
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def steps(offsets: np.ndarray, size: int = STEP_BYTES):
    """Row ranges (a, b) of about ``size`` bytes each, one row at least."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + size, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


_powers = [np.ones(1, _U64), np.ones(1, _U64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The multiplier's and its inverse's powers 0..n-1 (kept, and grown by doubling)."""
    for i, base in enumerate((_MUL, _INV)):
        while len(_powers[i]) < n:
            p = _powers[i]
            _powers[i] = np.concatenate([p, p * _U64(pow(base, len(p), 2**64))])
    return _powers[0][:n], _powers[1][:n]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, hash, first) of the words ``[^\\x20\\x09-\\x0D]+`` of the rows.

    ``first`` has the index of each row's first word, and the number of words at its end.
    """
    n = len(data)
    if not n:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, _U64), np.zeros(len(offsets), np.int64))
    inside = ~IS_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = offsets[:-1][offsets[:-1] < n]
    begins[cuts] = inside[cuts]                  # a word never goes on into the next row
    start = np.flatnonzero(begins)
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    ends[last] = inside[last]
    end = np.flatnonzero(ends) + 1
    power, inverse = _power_tables(n)
    total = np.zeros(n + 1, _U64)
    np.cumsum(_BYTE[data] * power, out=total[1:])
    return start, end, mix((total[end] - total[start]) * inverse[start] + (end - start).astype(_U64)), np.searchsorted(start, offsets)


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of ``k`` words (one for each place where a run begins)."""
    out = np.zeros(max(0, len(hashes) - k + 1), _U64)
    for i in range(k):
        out = mix(out * _U64(_MUL) + hashes[i:len(hashes) - k + 1 + i])
    return out
