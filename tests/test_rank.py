"""Positions and running totals over several order columns, with a hot first one."""

import random

from pyspark.sql import functions as F

from cohortforge.operators.rank import _ranges, ordered_position, running_totals


def _rows(n):
    rnd = random.Random(5)
    return [(rnd.choice(["g", "h", None]), "hot" if i % 3 else rnd.choice(["a", "z", None]), i % 11 if i % 7 else None, i, rnd.randint(-3, 9)) for i in range(n)]


def _null_first(v):
    return (v is not None, v if v is not None else 0)


def test_positions_and_totals_by_several_columns(spark):
    rows = _rows(600)
    df = spark.createDataFrame(rows, "g string, a string, b long, c long, v long").repartition(5)
    got = running_totals(ordered_position(df, ["g"], ["a", "b", "c"], n_ranges=9), ["g"], ["a", "b", "c"], ["v"], n_ranges=6)
    found = {r.c: (r.position, r.cum_v) for r in got.collect()}
    assert len(found) == 600
    for g in ("g", "h", None):
        total = 0
        members = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is not None, r[1] or "", _null_first(r[2]), r[3]))
        for at, r in enumerate(members):
            assert found[r[3]] == (at, total)
            total += r[4]


def test_a_hot_first_value_is_cut_by_the_next_columns(spark):
    df = spark.createDataFrame([(1, i) for i in range(3000)], "a long, c long")
    sizes = [r["count"] for r in _ranges(df, ["a", "c"], 8).groupBy("__r").count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 1500 and sum(sizes) == 3000
    by_struct = ordered_position(df, [], ["a", "c"], n_ranges=8).filter(F.col("position") != F.col("c")).count()
    assert by_struct == 0
