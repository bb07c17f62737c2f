"""Fold assignment for k-fold training."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortforge.operators.rank import null_safe_join, ordered_position


def hash32(id_col: str, seed: int) -> Column:
    """First 32 bits of md5('seed:id') as a non-negative bigint."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)),
                                                F.col(id_col).cast("string"))), 1, 8),
                  16, 10).cast("bigint")


def hash_fold(id_col: str, k: int = 5, seed: int = 2018) -> Column:
    """Shuffled fold with a seed: ``hash32`` mod k.

    Repeatable, needs no sort and no shuffle; fold sizes are equal only on
    average.
    """
    return (hash32(id_col, seed) % k).cast("int")


def hash_folds(df: DataFrame, id_col: str, k: int = 5, seed: int = 2018,
               out: str = "fold") -> DataFrame:
    return df.withColumn(out, hash_fold(id_col, k, seed))


def stratified_folds(df: DataFrame, label: str, order: str | Sequence[str], k: int = 5, out: str = "fold",
                     n_ranges: int | None = None) -> DataFrame:
    """Stratified folds without shuffling: within each class, rows in
    ``order`` are cut into k contiguous blocks; the first ``n mod k`` blocks
    get one row more.  A missing label is a class of its own, a missing order
    value comes first: every row gets a fold.

    The position inside the class is computed by range (see ``rank``), so a
    class holding most rows is still spread over many tasks.
    """
    pos = ordered_position(df, [label], [order] if isinstance(order, str) else order, "__pos", n_ranges)
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("__n"))
    pos = null_safe_join(pos, sizes, [label])
    n, p = F.col("__n"), F.col("__pos")
    q = F.floor(n / k)
    r = n - q * k
    big = r * (q + 1)
    fold = F.when(p < big, F.floor(p / (q + 1))).otherwise(r + F.floor((p - big) / q))
    return pos.withColumn(out, fold.cast("int")).drop("__pos", "__n")
