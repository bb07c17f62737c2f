"""Bucketed tables: joins on their key without an exchange, layout found again, options of the build."""

import os
import tempfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cohortforge.operators.aggregate import agg_spec, group_by_key, group_by_spec
from cohortforge.operators.encode import one_hot, one_hot_long, one_hot_split
from cohortforge.sources.io import write_submission, write_table
from cohortforge.sources.layout import join_stored, layout_of, read_stored, store_blocks, write_bucketed


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="cf-layout-")


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_blocks_meet_without_exchange(spark, folder, no_broadcast):
    base = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("x"))
    a = spark.range(0, 50, 3).select(F.col("id").alias("k"), F.lit("a").alias("PREV APP COUNT"))
    b = spark.range(0, 60, 4).select(F.col("id").alias("k"), F.col("id").cast("double").alias("b"))
    store_blocks({"base": base, "a": a, "b": b}, folder, "k", 7)
    out = join_stored(spark, folder, "base", ["a", "b"], "k")
    assert "SortMergeJoin" in _plan(out) and "Exchange" not in _plan(out)
    got = {r.k: (r.x, r["PREV APP COUNT"], r.b) for r in out.collect()}
    assert got == {k: (2 * k, "a" if k % 3 == 0 else None, float(k) if k % 4 == 0 else None) for k in range(50)}
    per_key = out.groupBy("k").count()
    assert "Exchange" not in _plan(per_key)
    # one block replaced; the others stay
    store_blocks({"b": b.withColumn("b", F.col("b") + 1)}, folder, "k", 7)
    assert {r.k: r.b for r in join_stored(spark, folder, "base", ["b"], "k").collect()}[4] == 5.0


def test_blocks_are_written_side_by_side_and_errors_are_raised(spark, folder):
    tables = {f"t{i}": spark.range(30).select(F.col("id").alias("k"), (F.col("id") * i).alias(f"v{i}")) for i in range(5)}
    store_blocks(tables, folder, "k", 3)
    out = join_stored(spark, folder, "t0", [f"t{i}" for i in range(1, 5)], "k")
    assert sorted(map(tuple, out.collect())) == [(k, *[k * i for i in range(5)]) for k in range(30)]
    bad = spark.range(3).select(F.col("id").alias("k"), F.raise_error(F.lit("broken")).cast("int").alias("x"))
    with pytest.raises(Exception, match="broken"):
        store_blocks({**tables, "bad": bad}, folder, "k", 3)


def test_other_bucket_counts_still_join_right(spark, folder):
    left = write_bucketed(spark.range(40).withColumnRenamed("id", "k"), f"{folder}/l", "k", 4)
    right = write_bucketed(spark.range(0, 40, 2).select(F.col("id").alias("k"), F.lit(1).alias("v")), f"{folder}/r", "k", 6)
    assert left.join(right, "k", "left").filter("v = 1").count() == 20


def test_layout_survives_sessions_and_overwrites(spark, folder):
    rows = [(None, "n1"), (None, "n2"), (1, "a"), (1, "b"), (2, None)]
    df = spark.createDataFrame(rows, "key long, `odd name` string")
    out = write_bucketed(df, f"{folder}/t", "key", 3)
    assert Counter(map(tuple, out.collect())) == Counter(rows)
    assert layout_of(spark, f"{folder}/t") == ("key", 3)
    other = spark.newSession()
    assert Counter(map(tuple, read_stored(other, f"{folder}/t").collect())) == Counter(rows)
    assert spark.read.parquet(f"{folder}/t").count() == 5            # plain readers skip the layout
    # another shape in the same place, then a plain table: no old layout is left
    write_bucketed(spark.range(9).select(F.col("id").alias("z")), f"{folder}/t", "z", 2)
    assert read_stored(spark, f"{folder}/t").columns == ["z"] and layout_of(spark, f"{folder}/t") == ("z", 2)
    write_table(spark.range(3), f"{folder}/t")
    assert layout_of(spark, f"{folder}/t") is None and read_stored(spark, f"{folder}/t").count() == 3
    empty = write_bucketed(df.limit(0), f"{folder}/e", "key", 3)
    assert empty.count() == 0 and read_stored(spark, f"{folder}/e").columns == df.columns
    with pytest.raises(ValueError):
        write_bucketed(df, f"{folder}/x", "key", 0)


def test_submission_joins_without_exchange(spark, folder, no_broadcast):
    template = write_bucketed(spark.range(30).select(F.col("id").alias("k"), F.lit(0.5).alias("TARGET")), f"{folder}/template", "k", 5)
    matrix = write_bucketed(spark.range(30).select(F.col("id").alias("k"), F.col("id").cast("double").alias("x")), f"{folder}/m", "k", 5)
    sub = write_submission(template, matrix.select("k", (F.col("x") / 30).alias("TARGET")), "k", f"{folder}/s.csv")
    assert "Exchange" not in _plan(sub) and os.path.isdir(f"{folder}/s.csv")
    assert {r.k: r.TARGET for r in sub.collect()} == {k: k / 30 for k in range(30)}


def test_distinct_counts_apart_equal_those_inside(spark):
    rows = [(1, 1.0, "a", 5), (1, 1.0, "b", 6), (1, None, "b", None), (2, None, None, None), (None, 3.0, "x", 1), (3, 0.0, "q", 2), (3, -0.0, "q", 2)]
    df = spark.createDataFrame(rows, "k long, v double, s string, n long")
    spec = {"v": ["nunique", "max"], "s": ["nunique"], "n": ["mean", "nunique", "sum"]}
    rows_col = F.count(F.lit(1)).alias("rows")
    want = group_by_key(df, "k", [*agg_spec(spec, "P_"), rows_col])
    got = group_by_spec(df, "k", spec, "P_", [rows_col])
    assert got.columns == want.columns
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
    only = group_by_spec(df, "k", {"s": ["nunique"]})
    assert only.columns == ["k", "s_NUNIQUE"] and dict(map(tuple, only.collect())) == {1: 2, 2: 0, 3: 1}
    assert group_by_spec(df.limit(0), "k", spec, "P_").count() == 0


def test_one_hot_beyond_the_column_limit(spark):
    rows = [(i, f"v{i % 9}" if i % 10 else None, "xy"[i % 2]) for i in range(30)]
    df = spark.createDataFrame(rows, "id long, many string, few string")
    with pytest.raises(ValueError, match="one_hot_split"):
        one_hot(df, ["many", "few"], max_values=5)
    wide, new, long = one_hot_split(df, ["id"], ["many", "few"], max_values=5)
    assert new == ["few_x", "few_y", "few_nan"] and wide.columns == ["id", *new]
    assert {(r.id, r.column, r.feature) for r in long.collect()} == {(i, "many", f"many_{m or 'nan'}") for i, m, _ in rows}
    bare = one_hot_long(df, ["id"], ["many"], nan_as_category=False)
    assert {(r.id, r.feature) for r in bare.collect()} == {(i, f"many_{m}") for i, m, _ in rows if m}
    assert "Exchange" not in _plan(bare)
    full, names = one_hot(df, ["many"])
    ones = {(r.id, c) for r in full.collect() for c in names if r[c]}
    assert ones == {(r.id, r.feature) for r in long.collect()}
    wide, new, long = one_hot_split(df.limit(0), ["id"], ["many"], max_values=5)
    assert long is None and new == ["many_nan"] and wide.count() == 0


def test_latest_of_records(spark):
    from cohortforge.plans.features import latest_of_records
    bureau = spark.createDataFrame([(1, 10), (1, 11), (1, 11), (2, 12), (3, 13), (None, 14), (4, None)], "c long, b long")
    bb = spark.createDataFrame([(10, -3, "x", 1), (10, -1, "y", 1), (11, -1, "z", 2), (11, -1, "w", 1), (11, -1, "z", 2), (12, -5, "q", 1), (12, None, "n", 2),
                                (14, -1, "o", 1), (99, -1, "p", 1)], "b long, m long, s string, __row long")
    got = latest_of_records(bureau, bb, "c", "b", "b", "m", "__row")
    assert got.columns == ["c", "b", "m", "s"]
    assert sorted(map(tuple, got.collect())) == [(1, 11, -1, "z"), (2, 12, -5, "q")]
    total = latest_of_records(bureau, bb.drop("__row"), "c", "b", "b", "m")
    assert sorted(map(tuple, total.collect())) == [(1, 11, -1, "z"), (2, 12, -5, "q")]


def test_train_and_submit_over_bucketed_tables(spark, folder):
    from cohortforge.plans import jobs
    rows = [(i, float(i % 2) if i < 40 else None, i < 40, float(i % 7), "ab"[i % 2]) for i in range(52)]
    features = write_bucketed(spark.createDataFrame(rows, "SK_ID_CURR long, TARGET double, is_train boolean, x double, s string"), f"{folder}/features", "SK_ID_CURR", 4)
    assert features.count() == 52
    oof, _, _ = jobs.train(spark, f"{folder}/features", f"{folder}/out", k=2, kind="logistic", max_iter=3, encode=[], buckets=3)
    assert oof.count() == 40 and layout_of(spark, f"{folder}/out/test_matrix") == ("SK_ID_CURR", 3)
    template = spark.createDataFrame([(i, 0.5) for i in range(40, 52)], "SK_ID_CURR long, TARGET double")
    got = {r.SK_ID_CURR: r.TARGET for r in jobs.submit(spark, f"{folder}/out", template, k=2).collect()}
    assert sorted(got) == list(range(40, 52)) and all(0 <= v <= 1 for v in got.values())
    folds = [spark.read.option("header", True).csv(f"{folder}/out/fold_{f}_submission").count() for f in (1, 2)]
    assert folds == [12, 12]
