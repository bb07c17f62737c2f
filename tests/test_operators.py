"""Golden rows for aggregates, joins, encoders, folds, ranks and metrics."""

import re

import pytest
from pyspark.sql import functions as F

from cohortforge.operators.aggregate import (
    agg_spec, group_by_key, group_median, latest_by, mean_all, mode_value, value_counts,
    weighted_mean,
)
from cohortforge.operators.encode import (
    code_table, encode_string_or_two_valued, factorize, label_encode, mode_codes, one_hot,
    two_valued_columns,
)
from cohortforge.operators.folds import hash_folds, stratified_folds
from cohortforge.operators.join import left_join_suffix, suffix_names
from cohortforge.operators.metrics import auc_evaluator, auc_exact, losses
from cohortforge.operators import profile
from cohortforge.operators.profile import (
    cardinalities, fill_missing, null_shares, prune_null_columns, standardise,
)
from cohortforge.operators.rank import ordered_position, running_totals


def test_spec_group_rules(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 4.0), (2, 5.0), (3, None), (None, 7.0)],
                               "k long, v double")
    out = {r["k"]: r for r in group_by_key(df, "k", agg_spec(
        {"v": ["min", "max", "mean", "sum", "var", "std", "size", "count", "nunique"]}, "P_")
    ).collect()}
    assert set(out) == {1, 2, 3}                       # missing key forms no group
    assert out[1]["P_v_VAR"] == pytest.approx(2.0) and out[2]["P_v_VAR"] is None
    assert out[3]["P_v_SUM"] == 0.0 and out[3]["P_v_SIZE"] == 1 and out[3]["P_v_COUNT"] == 0
    assert out[1]["P_v_MEAN"] == 3.0 and out[1]["P_v_NUNIQUE"] == 2


def test_weighted_mean_contaminates(spark):
    df = spark.createDataFrame([(1, 10.0, -1), (1, 20.0, -2), (2, 1.0, -1), (2, None, -3),
                                (3, 4.0, 0)], "k int, x double, m long")
    got = dict(df.groupBy("k").agg(weighted_mean("x", "m").alias("w")).collect())
    assert got[1] == pytest.approx((10 * 1 + 20 * 0.5) / 1.5)
    assert got[2] is None and got[3] is None


def test_mode_ties_lowest_and_latest_ties(spark):
    df = spark.createDataFrame([(1, "b", 3, 1), (1, "a", 3, 2), (1, "c", 1, 3), (2, None, 5, 1)],
                               "k int, c string, m int, id int")
    mode = dict(df.groupBy("k").agg(mode_value(F.coalesce("c", F.lit("NULL")))).collect())
    assert mode == {1: "a", 2: "NULL"}
    latest = {r["k"]: r["c"] for r in latest_by(df, "k", "m", ["c"]).collect()}
    assert latest == {1: "b", 2: None}   # tie on m=3: largest remaining columns (c, id) win
    codes = {r["k"]: r["c"] for r in mode_codes(df, "k", ["c"]).collect()}
    assert codes == {1: "1", 2: "0"}     # sorted codes: NULL=0, a=1, b=2, c=3


def test_suffix_rule(spark):
    assert suffix_names(["k", "x"], ["x", "y"], "_S") == {"x": "x_S", "y": "y"}
    left = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k long, x double")
    right = spark.createDataFrame([(1, 9.0)], "key long, x double")
    out = left_join_suffix(left, right, "k", "key", "_S")
    assert out.columns == ["k", "x", "x_S"] and out.count() == 2


def test_label_encode_text_order(spark):
    df = spark.createDataFrame([(10.0,), (2.0,), (None,)], "v double")
    out, cols, table = label_encode(df, ["v"], missing="nan", as_string=True)
    got = {r["value"]: r["code"] for r in table.collect()}
    assert got == {"10.0": 0, "2.0": 1, "nan": 2}          # text order
    two = spark.createDataFrame([(1, "a"), (None, "b"), (1, "a")], "f int, s string")
    assert two_valued_columns(two) == ["f", "s"]
    enc, cats, _ = encode_string_or_two_valued(two)
    assert cats == ["f", "s"] and sorted(r["f"] for r in enc.collect()) == [0, 0, 1]


def test_factorize_and_one_hot(spark):
    df = spark.createDataFrame([(1, "Y"), (2, "N"), (3, None), (4, "Y")], "id int, f string")
    got = [r["f"] for r in factorize(df, ["f"], ["id"]).orderBy("id").collect()]
    assert got == [0, 1, -1, 0]
    oh, new = one_hot(df, ["f"])
    assert new == ["f_N", "f_Y", "f_nan"]
    assert [tuple(r) for r in oh.orderBy("id").select(*new).collect()] == [
        (0, 1, 0), (1, 0, 0), (0, 0, 1), (0, 1, 0)]


def test_profiles(spark):
    df = spark.createDataFrame([(1, None, 1.0), (2, None, 1.0), (3, None, 1.0), (4, 5.0, 1.0),
                                (5, None, 1.0)], "k int, x double, c double")
    shares = {r[0]: r[1] for r in null_shares(df).collect()}
    assert shares == {"k": 0.0, "x": 0.8, "c": 0.0}
    kept, dropped = prune_null_columns(df, 0.8)
    assert dropped == []                                   # strictly above the threshold
    kept, dropped = prune_null_columns(df, 0.7)
    assert dropped == ["x"]
    assert {r[0]: r[1] for r in cardinalities(df).collect()} == {"k": 5, "x": 2, "c": 1}
    st = standardise(fill_missing(df, 0), ["k", "c"]).orderBy("k").collect()
    assert [r["c"] for r in st] == [0.0] * 5
    assert st[0]["k"] == pytest.approx(-2 / (2 ** 0.5))    # population std


def test_running_totals_many_ranges_equal_window(spark):
    rows = [(i % 3, (i * 7919) % 1000, 1 + i % 5) for i in range(600)]
    df = spark.createDataFrame(rows, "g int, o int, v int")
    df = df.dropDuplicates(["g", "o"])
    multi = running_totals(df, ["g"], ["o"], ["v"], n_ranges=7).orderBy("g", "o").collect()
    from pyspark.sql import Window
    w = Window.partitionBy("g").orderBy("o").rowsBetween(Window.unboundedPreceding, -1)
    ref = (df.withColumn("ref", F.coalesce(F.sum("v").over(w), F.lit(0)))
             .orderBy("g", "o").collect())
    assert [r["cum_v"] for r in multi] == [r["ref"] for r in ref]
    pos = ordered_position(df, ["g"], ["o"], n_ranges=5)
    assert pos.groupBy("g").agg(F.max("position")).count() == 3


def test_stratified_folds_like_ntile(spark):
    rows = [(i, 1 if i % 7 == 0 else 0) for i in range(103)]
    df = spark.createDataFrame(rows, "id int, y int")
    got = stratified_folds(df, "y", "id", k=5, n_ranges=4)
    from pyspark.sql import Window
    ref = df.withColumn("ref", F.ntile(5).over(Window.partitionBy("y").orderBy("id")) - 1)
    j = got.join(ref, ["id", "y"])
    assert j.filter(F.col("fold") != F.col("ref")).count() == 0
    h = hash_folds(df, "id", 5, 2018)
    assert h.select("fold").distinct().count() == 5


def test_auc_exact_equals_evaluator(spark):
    rows = [(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.3), (1, 0.6), (0, 0.1), (0, 0.6), (1, 0.95)]
    df = spark.createDataFrame(rows, "y int, s double")
    exact = auc_exact(df, "y", "s", n_ranges=3).first()["auc"]
    ev = auc_evaluator(df.withColumn("raw", F.col("s")), "y", "raw")
    assert exact == pytest.approx(ev)
    loss = losses(df, "y", "s").first()
    assert loss["n"] == 8 and 0 < loss["log_loss"] < 2


def test_median_and_counts(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", 10.0), ("b", 2.0), ("b", 4.0),
                                (None, 100.0)], "g string, v double")
    med = dict(group_median(df, "g", "v", "m").collect())
    assert med == {"a": 3.0, "b": 3.0}
    cnt = dict(value_counts(df, "g", "n").collect())
    assert cnt == {"a": 3, "b": 2}
    assert [c for c in mean_all(df, "g")] and code_table(df, ["g"]).count() == 3


def test_one_hot_label(spark):
    from cohortforge.operators.encode import one_hot_label
    df = spark.createDataFrame([(0,), (1,)], "y int")
    assert [r[0] for r in df.select(one_hot_label("y")).collect()] == [[1, 0], [0, 1]]


def test_exact_median_methods_agree(spark):
    rows = [("a", float(v)) for v in (5, 1, 3, 3, 9, 2)] + [("b", 7.0), ("c", 1.0), ("c", 2.0)] \
        + [("d", float(i % 17)) for i in range(301)] + [("e", None), (None, 4.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    exact = dict(group_median(df, "g", "v", "m").collect())
    buf = dict(group_median(df, "g", "v", "m", method="buffer").collect())
    assert exact == buf and exact["a"] == 3.0 and exact["c"] == 1.5 and "e" not in exact


@pytest.mark.parametrize("kind", ["string", "date", "timestamp", "double", "bigint", "decimal(10,2)"])
def test_positions_do_not_depend_on_the_ranges(spark, kind):
    from cohortforge.operators.rank import ordered_position
    values = {"string": "concat('Customer#00000', v)", "date": "date_add(date'2000-01-01', cast(v as int))",
              "timestamp": "timestamp_seconds(v)"}.get(kind, f"cast(v as {kind})")
    df = spark.range(120).selectExpr("id", "id % 2 AS g", "nullif(id * 37 % 50, 3) AS v").selectExpr("id", "g", f"{values} AS o")
    a, b, c = (sorted(map(tuple, ordered_position(df, ["g"], ["o", "id"], n_ranges=n).collect()), key=str) for n in (1, 7, 64))
    assert a == b == c and all(r[-1] is not None for r in a)


def test_every_row_gets_a_fold(spark):
    from cohortforge.operators.folds import stratified_folds
    df = spark.range(40).selectExpr("nullif(id, 5) AS id", "nullif(id % 3, 2) AS y")
    for n in (1, 9):
        rows = stratified_folds(df, "y", "id", 5, n_ranges=n).collect()
        assert len(rows) == 40 and {r.fold for r in rows} == {0, 1, 2, 3, 4}


def test_latest_rows_against_the_total_order(spark):
    rows = [(k, m, None if i % 11 == 0 else i, v, f"t{i % 4}") for i, (k, m, v) in enumerate(
        (k, m, v) for k in (1, 2, 3, None) for m in (-5, -1, -1, None, -3) for v in (2.5, -1.0, None))]
    df = spark.createDataFrame(rows, "k int, m int, i long, v double, t string")
    for order in ("m", "v"):
        want = {}
        for r in rows:
            o = r[1] if order == "m" else r[3]
            if r[0] is not None and o is not None:
                rank = (o, -1 if r[2] is None else r[2])
                if r[0] not in want or rank > want[r[0]][0]:
                    want[r[0]] = rank, r[4]
        got = {r.k: r.t for r in latest_by(df, "k", order, ["t"], row_id="i").collect()}
        assert got == {k: t for k, (_, t) in want.items()}


def test_mode_codes_ties_and_missing(spark):
    df = spark.createDataFrame([(1, "b", None), (1, "a", None), (1, None, "x"), (2, None, "z"), (2, None, "z"), (2, "b", "y"), (None, "0", "0")],
                               "k int, a string, b string")
    got = {r.k: (r.a, r.b) for r in mode_codes(df, "k", ["a", "b"]).collect()}
    # sorted values: a: 0, NULL, a, b; b: 0, NULL, x, y, z
    assert got == {1: ("1", "1"), 2: ("1", "4")}


def test_cardinalities_and_merged_sketches(spark, tmp_path):
    rows = [(i, f"v{i % 700}", None if i % 3 else float(i % 50) * (-1) ** i) for i in range(20000)]
    df = spark.createDataFrame(rows, "i long, t string, x double")
    exact = {r.column_name: r.n_distinct for r in cardinalities(df).collect()}
    assert exact == {"i": 20000, "t": 700, "x": len({r[2] for r in rows})}
    assert {r.column_name: r.n_distinct for r in cardinalities(df.limit(0)).collect()} == {"i": 0, "t": 0, "x": 0}
    paths = [str(tmp_path / str(k)) for k in range(3)]
    for k, p in enumerate(paths):
        profile.cardinality_sketches(df.where(F.col("i") % 3 == k)).write.parquet(p)
    merged = profile.merge_sketches(*[spark.read.parquet(p) for p in paths])
    for r in profile.sketch_estimates(merged).collect():
        assert abs(r.n_distinct - exact[r.column_name]) <= max(1, 4 * profile.SKETCH_ERROR * exact[r.column_name])


def test_checked_codes_leave_rows_of_a_frequent_value_in_place(spark):
    from cohortforge.plans.blocks import pos_cash
    rows = [(i % 7, float(i), "hot" if i % 5 else f"w{i % 9}", None if i % 11 == 0 else f"v{i % 3}") for i in range(300)]
    df = spark.createDataFrame(rows, "k long, x double, a string, b string").repartition(3)
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out, cats = pos_cash(df, {"x": ["max"]}, "k", check_size=True)
        joins = re.findall(r"(\w+Join) \[__key", out._jdf.queryExecution().executedPlan().toString())
        assert joins == ["BroadcastHashJoin"] * 2
        got = {r.k: (r.POS_a_MEAN, r.POS_b_MEAN, r.POS_COUNT) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
    codes = [{v: i for i, v in enumerate(sorted({r[c] or "NULL" for r in rows}))} for c in (2, 3)]
    for k in range(7):
        mine = [r for r in rows if r[0] == k]
        want = [sum(codes[i][r[2 + i] or "NULL"] for r in mine) / len(mine) for i in (0, 1)]
        assert got[k][:2] == pytest.approx(want) and got[k][2] == len(mine)
    assert cats == ["a", "b"]


@pytest.mark.parametrize("bound", [0, 4, 100_000])
def test_checked_code_table_is_the_lazy_one(spark, monkeypatch, bound):
    from cohortforge.operators import encode
    monkeypatch.setattr(encode, "BROADCAST_ROWS", bound)
    df = spark.createDataFrame([(None if i % 11 == 0 else f"v{i % 7}", f"w{i % 9}") for i in range(99)], "a string, b string").repartition(5)
    lazy, checked = (sorted(map(tuple, encode.code_table(df, ["a", "b"], cut=c).collect())) for c in (False, True))
    assert checked == lazy and len(lazy) == 17
