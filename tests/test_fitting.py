"""One-pass fold models, fitted stages, and medians by counting rounds, against plain Python."""

import math
import statistics

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from cohortforge.operators.bayes import class_probabilities, fold_models, out_of_fold, predicted_class
from cohortforge.operators.metrics import categorical_losses
from cohortforge.operators.model import fit_folds
from cohortforge.operators.select import median_by_rounds
from cohortforge.operators.stages import CategoryEncoder, CategoryEncoderModel, ColumnScaler


def _rows():
    return [(i, i % 3, ["a", "b", "c"][(i * 7 % 11) % 3], float(i * 37 % 23) + 1e6, float((i * i) % 17) / 8) for i in range(120)]


def _by_hand(train, x):
    classes = sorted({r[2] for r in train})
    tops = [max(statistics.pvariance([r[j] for r in train]) for j in (3, 4))] * 2
    ll = []
    for c in classes:
        own = [r for r in train if r[2] == c]
        total = math.log(len(own) / len(train))
        for j in (3, 4):
            v = statistics.pvariance([r[j] for r in own]) + 1e-9 * tops[j - 3]
            total += -0.5 * math.log(2 * math.pi * v) - (x[j] - statistics.mean([r[j] for r in own])) ** 2 / (2 * v)
        ll.append(total)
    e = [math.exp(v - max(ll)) for v in ll]
    return [v / sum(e) for v in e]


def test_folds_in_one_pass(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "id long, fold int, y string, a double, b double").repartition(7)
    oof, models = out_of_fold(df, "id", ["a", "b"], "y", k=3)
    got = {r.id: r for r in oof.collect()}
    assert len(got) == len(rows) and models.count() == 9
    for r in rows:
        want = _by_hand([t for t in rows if t[1] != r[1]], r)
        assert got[r[0]].probabilities == pytest.approx(want, abs=1e-9)


def test_two_classes_equal_the_fold_loop(spark):
    df = spark.createDataFrame([(r[0], r[1], "yes" if r[2] == "a" else "no", r[3] - 1e6, r[4]) for r in _rows()],
                               "id long, fold int, y string, a double, b double")
    one = {r.id: r.probabilities[1] for r in out_of_fold(df, "id", ["a", "b"], "y", k=3)[0].collect()}
    loop = {r.id: r.score for r in fit_folds(df, "id", ["a", "b"], [], "y", k=3, kind="gaussian_nb")[0].collect()}
    assert one == pytest.approx(loop, abs=1e-6)


def test_fit_reads_the_rows_once(spark):
    df = spark.createDataFrame(_rows(), "id long, fold int, y string, a double, b double")
    plan = fold_models(df, ["a", "b"], "y", k=3)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1 and "Join" not in plan


def test_odd_rows(spark):
    # a class that only fold 0 holds, a missing value, a constant feature, no rows, no label
    df = spark.createDataFrame([(1, 0, "z", 1.0, 5.0), (2, 0, "a", None, 5.0), (3, 1, "a", 2.0, 5.0), (4, 1, "b", 9.0, 5.0), (5, 2, "b", 8.0, 5.0), (6, 2, "a", 3.0, 5.0)],
                               "id long, fold int, y string, a double, b double")
    got = {r.id: r.probabilities for r in out_of_fold(df, "id", ["a", "b"], "y", k=3)[0].collect()}
    assert got[1][2] == 0.0 and sum(got[1]) == pytest.approx(1) and got[2] == pytest.approx([0.5, 0.5, 0.0])
    assert fold_models(df.limit(0), ["a"], "y", k=3).count() == 0
    assert class_probabilities(df, fold_models(df.limit(0), ["a"], "y", k=3), ["a"], F.col("fold")).where("probabilities IS NOT NULL").count() == 0
    with pytest.raises(Exception, match="without a fold or a label"):
        out_of_fold(df.withColumn("y", F.when(F.col("id") > 1, F.col("y"))), "id", ["a"], "y", k=3)[0].collect()


def test_three_classes_in_the_fold_loop(spark):
    df = spark.createDataFrame([(i, i % 3, 10 * (i % 5 % 3), float(i % 5 % 3), float(i % 4)) for i in range(90)], "id long, fold int, y int, a double, b double")
    oof, _ = fit_folds(df, "id", ["a", "b"], [], "y", k=3, kind="logistic")
    rows = oof.collect()
    assert len(rows) == 90 and all(10 * r.predicted == r.y and len(r.probabilities) == 3 for r in rows)
    loss = categorical_losses(oof.withColumn("class", (F.col("y") / 10).cast("int")), "class", "probabilities").first()
    assert loss.n == 90 and loss.accuracy == 1.0
    assert loss.cross_entropy == pytest.approx(sum(-math.log(min(r.probabilities[r.y // 10], 1 - 1e-7)) for r in rows) / 90)
    assert oof.select(predicted_class().alias("p")).distinct().count() == 3


def test_fitted_stages(spark, tmp_path):
    df = spark.createDataFrame([(1, "b", 1.0, 3.0, True), (2, "a", 3.0, 3.0, True), (3, None, 5.0, 3.0, True), (4, "new", 7.0, 4.0, False), (5, "a", None, 3.0, False)],
                               "id long, c string, x double, k double, is_train boolean")
    model = Pipeline(stages=[CategoryEncoder(cols=["c"], fitOn="is_train"), ColumnScaler(cols=["x", "k"], fitOn="is_train")]).fit(df)
    model.write().save(f"{tmp_path}/m")
    got = {r.id: r for r in PipelineModel.load(f"{tmp_path}/m").transform(df).collect()}
    # "NULL" < "a" < "b"; a value that was not learned comes after them
    assert [got[i].c for i in range(1, 6)] == [2, 1, 0, 3, 1]
    s = math.sqrt(8 / 3)
    assert [got[i].x for i in range(1, 5)] == pytest.approx([-2 / s, 0, 2 / s, 4 / s]) and got[5].x is None
    assert [got[i].k for i in range(1, 6)] == [0.0] * 5
    fitted = CategoryEncoder(cols=["c"], fitOn="is_train", unseen="null").fit(df)
    assert [r.c for r in fitted.transform(df).orderBy("id").collect()] == [2, 1, 0, None, 1]
    fitted.write().save(f"{tmp_path}/e")
    assert CategoryEncoderModel.load(f"{tmp_path}/e").getOrDefault("unseen") == "null"
    with pytest.raises(Exception, match="did not learn"):
        CategoryEncoder(cols=["c"], fitOn="is_train", unseen="error").fit(df).transform(df).collect()
    with pytest.raises(ValueError):
        CategoryEncoder(cols=["c"], unseen="drop").fit(df)


def test_median_by_rounds(spark):
    values = {"hot": [float(i * 7919 % 1009) for i in range(3000)], "two": [1.0] * 400 + [2.0] * 400, "one": [4.0] * 900, "even": [float(i) for i in range(500)],
              "heavy": [5.0] * 600 + [float(i) for i in range(300)], "small": [3.0, 1.0], "signs": [(-1.0) ** i * 10.0 ** (i % 200 - 100) for i in range(801)]}
    rows = [(k, v) for k, vs in values.items() for v in vs] + [("gone", None), (None, 1.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(9)
    got = dict(median_by_rounds(df, "g", "v", "m", small=100, probes=5).collect())
    assert got == pytest.approx({k: statistics.median(v) for k, v in values.items()}, rel=1e-12)
    assert dict(median_by_rounds(df, "g", "v", "m").collect()) == pytest.approx(got, rel=1e-12)
    assert median_by_rounds(df.limit(0), "g", "v", "m").count() == 0
