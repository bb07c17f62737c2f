"""Every registered query runs on sf0.001; blocks keep the left row count and are
unique on their key; results repeat across shuffle-partition counts."""

import pytest

import __spark_entry__ as E
from cohortforge.plans.registry import QUERIES
SF001 = "/root/testdata/sf0.001"

MODELS = ("oof_scores", "oof_auc")


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() == spark.read.parquet(f"{SF001}/customer.parquet").count()
    assert df.columns[0] == "c_custkey" and len(df.columns) > 40


# queries that return one row per row of a table
ROWS_OF = {"train_test_stack": "orders", "stratified_folds": "orders", "stratified_folds_text": "orders", "hash_folds": "orders",
           "label_encode": "orders", "ensemble_mean": "orders", "oof_naive_bayes": "orders", "oof_naive_bayes_classes": "orders",
           "fit_on_train": "orders", "saved_pipeline_scores": "orders", "naive_bayes_ensemble": "orders",
           "standardise": "lineitem", "label_encode_saved": "customer", "prev_mode": "customer", "application_block": "customer"}


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in MODELS])
def test_query_runs(spark, name):
    df = QUERIES[name](spark, SF001)
    n = df.count()
    assert n > 0 and len(set(df.columns)) == len(df.columns)
    if name in ROWS_OF:
        assert n == spark.read.parquet(f"{SF001}/{ROWS_OF[name]}.parquet").count()


def test_every_query_has_oracle_or_is_model():
    assert set(QUERIES) - set(E.oracle_sql()) == set(MODELS)


@pytest.mark.parametrize("name", ["wide_features", "feature_blocks_chain", "group_median_lookup", "stratified_folds", "prev_mode"])
def test_building_runs_no_job(spark, name):
    spark.sparkContext.setJobGroup(f"build-{name}", "")
    QUERIES[name](spark, SF001)
    spark.sparkContext.setJobGroup("", "")
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s).name for j in tracker.getJobIdsForGroup(f"build-{name}") for s in tracker.getJobInfo(j).stageIds]
    assert [s for s in stages if not s.startswith(("parquet at", "load at"))] == []      # but for reading the files' schemas


def test_blocks_keep_left_rows_and_key_unique(spark):
    n = spark.read.parquet(f"{SF001}/customer.parquet").count()
    for name in ("wide_features", "feature_blocks_chain", "prev_means_suffix", "latest_on_mean_key",
                 "child_counts"):
        df = E.queries()[name](spark, SF001)
        assert df.count() == n
        assert df.select("c_custkey").distinct().count() == n


def test_repeatable_across_partitions(spark):
    q = E.queries()["wide_features"]
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    a = sorted(map(tuple, q(spark, SF001).collect()), key=str)
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    b = sorted(map(tuple, q(spark, SF001).collect()), key=str)
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert a == b


def test_oof_scores_one_per_row(spark):
    oof = E.queries()["oof_scores"](spark, SF001)
    n = spark.read.parquet(f"{SF001}/orders.parquet").count()
    assert oof.count() == n and oof.select("o_orderkey").distinct().count() == n
    auc = E.queries()["oof_auc"](spark, SF001).collect()
    assert len(auc) == 5 and all(0 <= r["auc"] <= 1 for r in auc)
