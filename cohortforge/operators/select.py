"""Exact medians by counting rounds: no global order, no shuffle of a large group's rows.

A round takes approximate quantiles of the values that are still in question as
probes, counts the rows in the cells between them, and goes on inside the cell
that holds the middle rank.  Every probe is a value of its group with a cell
of its own, so a round always leaves fewer distinct values, and normally one
in ``PROBES`` of the rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortforge.session import checkpoint_dir

PROBES = 64
SMALL = 100_000         # rows of a group that one aggregation buffer may hold


def _kept(df: DataFrame) -> DataFrame:
    path = f"{checkpoint_dir(df.sparkSession)}/select-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def median_by_rounds(df: DataFrame, key: str, value: str, out: str, small: int = SMALL, probes: int = PROBES) -> DataFrame:
    """(key, ``out``): the interpolated median of ``value`` per key; missing keys and values are skipped.

    Groups of up to ``small`` rows take ``F.median``, whose buffer they bound.
    There are at most ``rows / small`` others; their bounds are the only thing
    that is broadcast, and their rows are counted where they lie.  Runs jobs:
    two passes a round over (key, value), written once, then over what the
    round left.
    """
    rows = _kept(df.filter(F.col(key).isNotNull() & F.col(value).isNotNull()).select(F.col(key).alias("k"), F.col(value).cast("double").alias("v")))
    sizes = _kept(rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > small))
    few = rows.join(F.broadcast(sizes.select("k")), "k", "left_anti").groupBy("k").agg(F.median("v").alias("m"))
    # lo and hi are the middle ranks; `below` rows of the group lie under the bounds a..b
    state = sizes.select("k", F.floor((F.col("n") - 1) / 2).alias("lo"), F.floor(F.col("n") / 2).alias("hi"), F.lit(0).cast("bigint").alias("below"),
                         F.lit(None).cast("double").alias("a"), F.lit(None).cast("double").alias("b"))
    done = []
    while not state.isEmpty():
        bounds = state.select(F.col("k").alias("__k"), "a", "b")
        rows = _kept(rows.join(F.broadcast(bounds), (F.col("k") == F.col("__k")) & (F.col("a").isNull() | F.col("v").between(F.col("a"), F.col("b")))).select("k", "v"))
        shares = [(i + 1) / (probes + 1) for i in range(probes)]
        marks = _kept(rows.groupBy("k").agg(F.array_distinct(F.percentile_approx("v", shares, 20 * probes)).alias("p")))
        # cell 2i lies between two probes, cell 2i+1 is a probe itself
        cell = 2 * F.size(F.filter("p", lambda p: p < F.col("v"))) + F.array_contains("p", F.col("v")).cast("int")
        cells = (rows.join(F.broadcast(marks), "k").groupBy("k", cell.alias("cell"))
                     .agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("x"), F.max("v").alias("y")))
        until = Window.partitionBy("k").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        cells = cells.join(F.broadcast(state.select("k", "lo", "hi", "below")), "k")
        start = F.col("below") + F.coalesce(F.sum("c").over(until), F.lit(0))
        cells = cells.withColumn("s", start)

        def holds(rank):
            return (F.col("s") <= F.col(rank)) & (F.col(rank) < F.col("s") + F.col("c"))

        # different cells: the last value of one and the first of the next; one cell of one value: that value
        found = cells.groupBy("k").agg(
            F.max(F.when(holds("lo"), F.struct("s", "x", "y"))).alias("l"), F.max(F.when(holds("hi"), F.struct("s", "x", "y"))).alias("h"),
            F.first("lo").alias("lo"), F.first("hi").alias("hi"))
        found = _kept(found)
        clear = (F.col("l.s") != F.col("h.s")) | F.col("l.x").eqNullSafe(F.col("l.y"))
        done.append(found.filter(clear).select("k", (F.col("l.y") + (F.col("h.x") - F.col("l.y")) * 0.5).alias("m")))
        state = found.filter(~clear).select("k", "lo", "hi", F.col("l.s").alias("below"), F.col("l.x").alias("a"), F.col("l.y").alias("b"))
    medians = few
    for part in done:
        medians = medians.unionByName(part)
    return medians.select(F.col("k").alias(key), F.col("m").alias(out))
