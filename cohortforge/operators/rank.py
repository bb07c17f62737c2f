"""Running totals and row positions in a global order, without one-task windows.

A window with ``orderBy`` and no (or a coarse) ``partitionBy`` sorts a whole
partition group in one task.  Here the order (one column, or several as a tuple) is cut into ranges at
quantiles of a sample of rows: each range is a window partition of bounded size,
per-range totals (a table of ``groups x ranges`` rows) give each range its
starting offset, and offset + position inside the range is the exact global
result.  Equal order values fall in the same range, so ties never straddle a
boundary.  There is one way for every size: the ranges are as many as the
session's shuffle partitions unless said otherwise, and the cuts are a lazy
scalar subquery, so building a plan runs no job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


SAMPLED = 8     # rows looked at per range, to place the cuts; they only balance the work


def _ranges(df: DataFrame, order: Sequence[str], n_ranges: int | None) -> DataFrame:
    """``df`` with a range number ``__r``; any types that Spark can sort, NULL first.

    Several order columns are cut as one tuple, so that a first column with
    one hot value is cut by those after it.
    """
    n = n_ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if n <= 1:
        return df.withColumn("__r", F.lit(0))
    value = F.col(order[0]) if len(order) == 1 else F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(order)])
    hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    h = F.xxhash64(*hashed)
    # about four times as many rows as are needed leave their tasks, whatever their number
    share = 4 * SAMPLED * n / df.select(F.count(F.lit(1))).scalar()
    sample = (df.where(value.isNotNull() & (F.pmod(h, F.lit(1 << 40)) <= share * (1 << 40)))
                .select(value.alias("v"), h.alias("h")).orderBy("h", "v").limit(SAMPLED * n).agg(F.array_sort(F.collect_list("v")).alias("vs")))
    cuts = F.col("__cuts")
    df = df.withColumn("__cuts", sample.select(F.filter("vs", lambda v, i: i % SAMPLED == SAMPLED - 1)).scalar())
    steps = F.array(*[F.lit(1 << i) for i in range(n.bit_length() - 1, -1, -1)])

    def step(at: Column, by: Column) -> Column:
        return F.when(F.get(cuts, at + by - 1) < value, at + by).otherwise(at)

    return df.withColumn("__r", F.aggregate(steps, F.lit(0), step)).drop("__cuts")


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join in which NULL keys match each other."""
    names = {c: f"__k_{c}" for c in on}
    right = right.withColumnsRenamed(names)
    condition = F.lit(True)
    for c in on:
        condition = condition & F.col(c).eqNullSafe(F.col(names[c]))
    return left.join(right, condition, how).drop(*names.values())


def running_totals(df: DataFrame, by: Sequence[str], order: Sequence[str],
                   values: Sequence[str], n_ranges: int | None = None, prefix: str = "cum_") -> DataFrame:
    """Add ``cum_<v>``: sum of ``v`` over the rows strictly before, in
    ``order`` (a total order), within each ``by`` group.  NULL is a group of
    its own, and comes first in the order."""
    by, order, values = list(by), list(order), list(values)
    r = _ranges(df, order, n_ranges)
    wi = (Window.partitionBy(*by, "__r").orderBy(*order)
                .rowsBetween(Window.unboundedPreceding, -1))
    totals = r.groupBy(*by, "__r").agg(*[F.sum(v).alias(f"__t_{v}") for v in values])
    wr = Window.partitionBy(*by).orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*by, "__r", *[F.coalesce(F.sum(f"__t_{v}").over(wr), F.lit(0)).alias(f"__off_{v}") for v in values])
    inside = r.withColumns({f"__in_{v}": F.coalesce(F.sum(v).over(wi), F.lit(0)) for v in values})
    out = null_safe_join(inside, offsets, [*by, "__r"])
    return out.select(*[F.col(f"`{c}`") for c in df.columns],
                      *[(F.col(f"__off_{v}") + F.col(f"__in_{v}")).alias(f"{prefix}{v}") for v in values])


def ordered_position(df: DataFrame, by: Sequence[str], order: Sequence[str],
                     out: str = "position", n_ranges: int | None = None) -> DataFrame:
    """0-based position of each row within its ``by`` group in ``order``."""
    tmp = df.withColumn("__one", F.lit(1).cast("bigint"))
    res = running_totals(tmp, by, order, ["__one"], n_ranges)
    return res.withColumnRenamed("cum___one", out).drop("__one")
