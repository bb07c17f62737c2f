"""CSV scans bind columns by the header, whatever the file's order and extra columns."""

import os
import tempfile

import pytest

from cohortforge.plans import jobs
from cohortforge.plans.features import FeatureConfig, application_features
from cohortforge.sources import schemas
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from cohortforge.operators.aggregate import latest_by
from cohortforge.operators.encode import factorize
from cohortforge.sources import io
from cohortforge.sources.io import read_table, sample_scan


def _csv(name, text):
    path = os.path.join(tempfile.mkdtemp(prefix="cf-csv-"), name)
    with open(path, "w") as f:
        f.write(text)
    return path


def test_permuted_columns(spark):
    path = _csv("bureau_balance.csv", "MONTHS_BALANCE,STATUS,SK_ID_BUREAU\n-3,C,77\n-1.0,,78\n,X,79\n")
    got = read_table(spark, path, schemas.BUREAU_BALANCE).select("SK_ID_BUREAU", "MONTHS_BALANCE", "STATUS").collect()
    assert [tuple(r) for r in got] == [(77, -3, "C"), (78, -1, None), (79, None, "X")]


def test_text_in_a_number_column_fails(spark):
    path = _csv("bureau_balance.csv", "SK_ID_BUREAU,MONTHS_BALANCE,STATUS\n1,abc,C\n")
    with pytest.raises(Exception, match="not a whole number"):
        read_table(spark, path, schemas.BUREAU_BALANCE).collect()


APPLICATION = """NAME_CONTRACT_TYPE,{target}AMT_CREDIT,SK_ID_CURR,FLAG_DOCUMENT_3,FLAG_DOCUMENT_5,FLAG_DOCUMENT_6,FLAG_DOCUMENT_8,FLAG_DOCUMENT_14,FLAG_MOBIL,FLAG_EMAIL,DAYS_BIRTH,NEW_RATIO,FLAG_OWN_CAR
Cash loans,{one}1000.5,{id},1,0,0,0,0,1,1,-9000.0,nan,Y
Revolving loans,{two}nan,{id2},0,0,1,0,1,1,0,-8000,0.25,N
"""


def test_extra_flags_and_a_test_file_without_target(spark):
    train = _csv("application_train.csv", APPLICATION.format(target="TARGET,", one="1,", two="0,", id=5, id2=6))
    test = _csv("application_test.csv", APPLICATION.format(target="", one="", two="", id=7, id2=8))
    a, b = (read_table(spark, p, schemas.APPLICATION) for p in (train, test))
    assert dict(a.dtypes)["FLAG_DOCUMENT_3"] == "bigint" and dict(a.dtypes)["NEW_RATIO"] == "double"
    rows = {r.SK_ID_CURR: r for r in a.unionByName(b).collect()}
    assert {k: r.TARGET for k, r in rows.items()} == {5: 1, 6: 0, 7: None, 8: None}
    assert rows[5].AMT_CREDIT == 1000.5 and rows[6].AMT_CREDIT is None and rows[5].DAYS_BIRTH == -9000
    assert rows[5].NEW_RATIO is None and rows[6].NEW_RATIO == 0.25 and rows[5].NAME_CONTRACT_TYPE == "Cash loans"
    out = {r.SK_ID_CURR: r for r in application_features(a, FeatureConfig()).collect()}
    assert all(r.NEW_DOC_IND_KURT is not None for r in out.values())
    assert out[5].NEW_LIVE_IND_SUM == 2 and out[6].NEW_LIVE_IND_SUM == 1


def test_sample_is_the_same_whatever_the_partitioning(spark):
    df = spark.createDataFrame([(i % 4, i * 7 % 40) for i in range(40)], "SK_ID_BUREAU long, MONTHS_BALANCE long")
    a, b = (sorted(map(tuple, sample_scan(df.repartition(n, "MONTHS_BALANCE"), 5, "SK_ID_BUREAU").collect())) for n in (3, 11))
    assert a == b and len(a) == 5


def test_encoder_list_is_checked(spark):
    df = spark.createDataFrame([(1, 0, "a")], "SK_ID_CURR long, TARGET int, STATUS string")
    with pytest.raises(ValueError, match="ORGANIZATION_TYPE"):
        jobs.prepare(df)


def _rows(n):
    return [(i * 7919 % 1009, f"v{i % 13}", i % 5) for i in range(n)]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_file_order_does_not_depend_on_the_splits(spark, tmp_path, fmt):
    rows = _rows(3000)
    schema = StructType([StructField("k", LongType()), StructField("v", StringType()), StructField("g", LongType())])
    path = str(tmp_path / f"t.{fmt}")
    if fmt == "csv":
        with open(path, "w") as f:
            f.write("k,v,g\n" + "".join(f"{k},{v},{g}\n" for k, v, g in rows))
    else:
        import pyarrow as pa
        import pyarrow.parquet as pq
        pq.write_table(pa.table(dict(zip("kvg", map(list, zip(*rows))))), path, row_group_size=60)
    keep = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    found = []
    try:
        for size in ("128m", "600"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            t = io.read_table(spark, path, schema if fmt == "csv" else None, row="n")
            got = t.select(F.col("k").cast("int"), "v", F.col("g").cast("int"), "n").orderBy("n").collect()
            codes = factorize(t, ["v"], ["n"]).select("n", "v").collect()
            last = latest_by(t.select(F.col("g").cast("int").alias("g"), "k", (-F.col("n")).alias("first"), (F.col("n") % 3).alias("m")), "g", "m", ["k"], row_id="first")
            sample = io.sample_scan(t, 17, "n").collect()
            found.append((got, sorted(codes), sorted(last.collect()), sample))
    finally:
        for c, v in keep.items():
            spark.conf.set(c, v)
    assert found[0] == found[1]
    assert [(r.k, r.v, r.g, r.n) for r in found[0][0]] == [(*r, i) for i, r in enumerate(rows)]
    assert all(int(r.v) == r.n % 13 for r in found[0][1])
    first = {g: min((i for i, r in enumerate(rows) if r[2] == g and i % 3 == 2), default=None) for g in range(5)}
    assert {r.g: int(r.k) for r in found[0][2]} == {g: rows[i][0] for g, i in first.items()}
    assert [r.n for r in found[0][3]] == list(range(17))


def test_file_order_over_several_files(spark, tmp_path):
    path = str(tmp_path / "many.parquet")
    spark.range(0, 500, 1, 9).write.parquet(path)
    got = [r.id for r in io.read_table(spark, path, row="n").orderBy("n").collect()]
    assert got == list(range(500))
    empty = str(tmp_path / "none.parquet")
    spark.range(0).write.parquet(empty)
    assert io.read_table(spark, empty, row="n").columns == ["id", "n"] and io.read_table(spark, empty, row="n").count() == 0


def test_file_order_shuffles_no_rows(spark, tmp_path):
    """All rows of a file have one key: the counts of the splits are broadcast, whatever the planner takes their size to be."""
    path = str(tmp_path / "t.parquet")
    spark.range(0, 4000, 1, 3).selectExpr("id", "id % 7 AS g").write.parquet(path)
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        t = io.read_table(spark, path, row="n")
        plan = io.sample_scan(t, 9, "n")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_latest_in_file_order_shuffles_by_its_key_alone(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(0, 4000, 1, 1).selectExpr("id", "id % 700 AS g", "id % 3 AS m").write.parquet(path)
    t = io.read_table(spark, path, row="n").withColumn("first", -F.col("n"))
    out = latest_by(t, "g", "m", ["id"], row_id="first")
    plan = out._jdf.queryExecution().executedPlan().toString()
    by = [x for x in plan.splitlines() if "hashpartitioning(" in x and "__file" in x]
    assert len(by) <= 2             # the counts of the splits, once for each read of the table; never the rows
    assert {r.g: r.id for r in out.collect()} == {g: min(i for i in range(4000) if i % 700 == g and i % 3 == max(k % 3 for k in range(4000) if k % 700 == g)) for g in range(700)}
