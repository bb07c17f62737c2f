"""Classifier training and scoring with Spark ML, k-fold.

The feature vector is the numeric columns plus a one-hot block per category
code (``VectorAssembler``).  The one-hot widths are fitted once, on all rows,
so that every fold's vectors have one length, also where a category occurs in
one fold only.  Each fold fits a **new** classifier on the other folds and
scores its own rows (out-of-fold); test rows are scored by every fold's model
and the scores are averaged per row.  Fits are distributed
Spark ML jobs; the training frame is persisted (memory and disk) before the
loop so the k fits read it once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier, NaiveBayes,
)
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.operators.bayes import class_table

# Hidden layers of the two network shapes of the source job.
HIDDEN_SIGMOID = [80, 80, 40]
HIDDEN_SOFTMAX = [160, 128, 64]


def make_classifier(kind: str, n_features: int | None = None, max_iter: int = 50,
                    seed: int = 2, hidden: Sequence[int] = HIDDEN_SIGMOID, n_classes: int = 2):
    if kind == "logistic":
        return LogisticRegression(featuresCol="features", labelCol="label", maxIter=max_iter)
    if kind == "gbt":
        return GBTClassifier(featuresCol="features", labelCol="label", maxIter=max_iter, seed=seed)
    if kind == "gaussian_nb":
        return NaiveBayes(featuresCol="features", labelCol="label", modelType="gaussian")
    if kind == "mlp":
        if n_features is None:
            raise ValueError("mlp needs n_features")
        return MultilayerPerceptronClassifier(featuresCol="features", labelCol="label",
                                              layers=[n_features, *hidden, n_classes],
                                              maxIter=max_iter, seed=seed, blockSize=256)
    raise ValueError(kind)


def feature_stages(numeric: Sequence[str], categorical: Sequence[str]):
    """One-hot for each category code, then one assembled vector."""
    oh_out = [f"{c}__oh" for c in categorical]
    stages = []
    if categorical:
        stages.append(OneHotEncoder(inputCols=list(categorical), outputCols=oh_out,
                                    dropLast=False, handleInvalid="keep"))
    stages.append(VectorAssembler(inputCols=list(numeric) + oh_out, outputCol="features",
                                  handleInvalid="keep"))
    return stages


def probability_of_one(df: DataFrame, out: str = "score") -> DataFrame:
    """Class-1 probability from the 2-class probability vector."""
    return df.withColumn(out, vector_to_array("probability")[1])


def encode_label(df: DataFrame, label: str, out: str = "label", table: DataFrame | None = None) -> DataFrame:
    """The label as class numbers 0, 1, ... in value order (``table``: from ``class_table``); a missing one stays missing."""
    table = class_table(df, label) if table is None else table
    table = table.select(F.col(label).alias("__value"), F.col("class").cast("double").alias("__class"))
    return df.join(table, F.col(label) == F.col("__value"), "left").withColumn(out, F.col("__class")).drop("__value", "__class")


def fit_folds(df: DataFrame, id_col: str, numeric: Sequence[str], categorical: Sequence[str],
              label: str, fold_col: str = "fold", k: int = 5, kind: str = "logistic",
              max_iter: int = 50, model_dir: str | None = None):
    """k-fold fit; returns ``(oof, models)`` where ``oof`` holds one
    out-of-fold score per training row: (id, fold, label, score); with more
    than two classes (id, fold, label, probabilities, predicted), by class in
    value order.

    Every model holds the shared encoder's stages and its own classifier.
    Rows without a label or a fold are an error: they would be neither
    trained on nor scored.
    """
    df = df.withColumn(fold_col, F.when(F.col(fold_col).isNull() | F.col(label).isNull(),
                                        F.raise_error(F.lit("a row without a fold or a label")).cast("int")).otherwise(F.col(fold_col)))
    classes = class_table(df, label)
    n_classes = max(2, classes.count())
    data = (encode_label(df.select(id_col, fold_col, *numeric, *categorical, label), label, "__label", classes)
              .withColumnRenamed(label, "__own").withColumnRenamed("__label", "label")
              .persist(StorageLevel.MEMORY_AND_DISK))
    encoder = Pipeline(stages=feature_stages(numeric, categorical)).fit(data)
    encoded = encoder.transform(data).select(id_col, fold_col, "__own", "label", "features")
    width = encoded.schema["features"].metadata.get("ml_attr", {}).get("num_attrs") or len(encoded.first()["features"])
    models, parts = [], []
    for f in range(k):
        classifier = make_classifier(kind, width, max_iter, n_classes=n_classes).fit(encoded.filter(F.col(fold_col) != f))
        model = PipelineModel([*encoder.stages, classifier])
        if model_dir:
            model.write().overwrite().save(f"{model_dir}/fold_{f}")
        models.append(model)
        scored = classifier.transform(encoded.filter(F.col(fold_col) == f))
        scores = [vector_to_array("probability")[1].alias("score")] if n_classes == 2 else [
            vector_to_array("probability").alias("probabilities"), F.col("prediction").cast("int").alias("predicted")]
        parts.append(scored.select(id_col, fold_col, F.col("__own").alias(label), *scores))
    oof = parts[0]
    for p in parts[1:]:
        oof = oof.unionByName(p)
    return oof, models


def load_models(model_dir: str, k: int = 5) -> list[PipelineModel]:
    return [PipelineModel.load(f"{model_dir}/fold_{f}") for f in range(k)]


def score_folds(models: Sequence[PipelineModel], df: DataFrame, id_col: str) -> DataFrame:
    """(id, fold, score) for every row and every fold model."""
    parts = []
    for f, m in enumerate(models):
        parts.append(probability_of_one(m.transform(df))
                     .select(id_col, F.lit(f).alias("fold"), "score"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def ensemble_mean(fold_scores: DataFrame, id_col: str, out: str = "TARGET") -> DataFrame:
    """Mean of the fold scores per row."""
    return fold_scores.groupBy(id_col).agg(F.avg("score").alias(out))
