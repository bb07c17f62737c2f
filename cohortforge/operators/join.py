"""Left joins onto a side that is unique on the key.

Every feature block is joined with ``how="left"`` onto a right side that
holds one row per key, so the left row count never changes.  Column-name
clashes follow the rule of the source merges: the left keeps its name, the
right column gets the suffix only when the name already exists on the left.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def suffix_names(left_cols: Sequence[str], right_cols: Sequence[str], suffix: str,
                 keep: Sequence[str] = ()) -> dict[str, str]:
    """New names for right columns: clashing ones get ``suffix``."""
    left = set(left_cols)
    return {c: (c + suffix if (c in left and c not in keep) else c) for c in right_cols}


def left_join_suffix(left: DataFrame, right: DataFrame, left_on: str, right_on: str | None = None,
                     suffix: str = "", keep_right_key: bool = False) -> DataFrame:
    """``left`` LEFT JOIN ``right`` with the clash rule above.

    The right key is dropped after the join unless ``keep_right_key``.
    When both keys have one name the key appears once.
    """
    right_on = right_on or left_on
    rk = "__rk"
    right_cols = [c for c in right.columns if c != right_on]
    names = suffix_names(left.columns, right_cols, suffix)
    r = right.select(F.col(right_on).alias(rk), *[F.col(c).alias(names[c]) for c in right_cols])
    joined = left.join(r, F.col(left_on) == F.col(rk), "left")
    if keep_right_key and right_on != left_on:
        return joined.withColumnRenamed(rk, right_on)
    return joined.drop(rk)


_kept: list[DataFrame] = []


def shared(df: DataFrame) -> DataFrame:
    """``df`` marked to be kept once computed, for a small side that several joins of one plan use.

    Runs nothing.  Whether a join broadcasts it is left to the adaptive
    planner, which knows its size in bytes by then.  ``release`` frees all.
    """
    _kept.append(df.cache())
    return _kept[-1]


BROADCAST_ROWS = 100_000        # of a value and its code: a few MB


def checked_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``shared(df)``, counted now: with a broadcast hint up to ``max_rows``, without one beyond.

    For callers that run jobs anyway and join many such tables in a row, where
    the adaptive planner would plan anew after every one of them.
    """
    kept = shared(df)
    return F.broadcast(kept) if kept.count() <= max_rows else kept


def release() -> None:
    """Free every table that ``shared`` keeps."""
    while _kept:
        _kept.pop().unpersist()


@contextmanager
def kept_tables():
    """Frees, at its end, the tables that ``shared`` has kept since its start."""
    before = len(_kept)
    try:
        yield
    finally:
        while len(_kept) > before:
            _kept.pop().unpersist()


def lookup(df: DataFrame, table: DataFrame, key: str, value: str, out: str,
           table_key: str | None = None) -> DataFrame:
    """Map ``df[key]`` through a (key -> value) table; unknown keys give NULL."""
    table_key = table_key or key
    t = table.select(F.col(table_key).alias("__lk"), F.col(value).alias(out))
    return df.join(t, F.col(key) == F.col("__lk"), "left").drop("__lk")


def chain_left_joins(base: DataFrame, blocks: Sequence[DataFrame], key: str) -> DataFrame:
    """Join each block (unique on ``key``) onto ``base`` in order."""
    out = base
    for b in blocks:
        out = out.join(b, key, "left")
    return out
