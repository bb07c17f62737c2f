"""Connected components of a distributed edge list by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import frozen


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


EACH = 100_000          # edges of a checkpoint file


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60, rows: int | None = None) -> DataFrame:
    """(``node``, ``root``) for every node that an edge touches; ``root`` is the component's smallest node.

    Each round re-hangs every node's neighbours on its smallest neighbour (two
    shuffles on the edge list); the minimum of a hub is combined before the
    shuffle.  A round's edges are written to the checkpoint folder.  Self
    links and repeated edges don't matter.  No edges give no rows.  ``rows``:
    how many edges there are, if that is known (a round's edges are never
    more than the ones before).
    """
    u, v = F.col(f"`{a}`"), F.col(f"`{b}`")
    e = frozen(edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where("u > v").distinct(), rows, EACH)
    state = _state(e)
    for _ in range(max_rounds):
        if not state[0]:
            break
        near = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = near.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = near.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = frozen(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), state[0], EACH)
        before, state = state, _state(e)
        if before == state:
            break
    else:
        raise RuntimeError(f"components: no end after {max_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
