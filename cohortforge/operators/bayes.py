"""Gaussian naive Bayes over k folds and any number of classes, fitted in one pass.

One aggregate over the training rows gives count, mean and variance of every
feature per (fold, class).  The model of a fold is the total of the other
folds' rows, merged from those few numbers, so k fits read the rows once.
Scoring is a map: the models, ``folds x classes x features`` numbers, are one
lazy scalar subquery, and every row picks its fold's model from them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortforge.operators.join import shared
from cohortforge.operators.rank import ordered_position

SMOOTHING = 1e-9        # of the largest variance of a feature, added to all variances
LEAST_VARIANCE = 1e-30


def class_table(df: DataFrame, label: str, out: str = "class") -> DataFrame:
    """``(label, class)``: the label's values numbered 0, 1, ... in value order; a missing label has no number."""
    values = shared(df.filter(F.col(label).isNotNull()).select(label).distinct())
    return shared(ordered_position(values, [], [label], out).withColumn(out, F.col(out).cast("int")))


def fold_models(df: DataFrame, features: Sequence[str], label: str, fold_col: str = "fold", k: int = 5,
                smoothing: float = SMOOTHING) -> DataFrame:
    """One row per (model, class): ``model``, the label's value, ``class``, ``n``, ``prior`` (a log) and ``terms``.

    Model f is that of all folds but f; a class that only occurs in fold f has
    n = 0 there.  ``terms`` holds mean, variance and log factor of each
    feature.  Missing feature values are skipped; rows without a label or a
    fold belong to no class or fold and are not learned from.
    """
    features = list(features)
    rows = df.filter(F.col(label).isNotNull() & F.col(fold_col).isNotNull())
    parts = rows.groupBy(fold_col, label).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.struct(F.count(c).cast("double").alias("c"), F.avg(c).alias("m"), F.var_pop(c).alias("v")) for c in features]).alias("s"))
    # a few rows from here on: each (fold, class) in every model, with weight 0 in its own
    parts = parts.select("*", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("model"))
    parts = parts.withColumn("takes", (F.col("model") != F.col(fold_col)).cast("double"))
    parts = parts.select("model", label, "takes", (F.col("n") * F.col("takes")).alias("n"), F.posexplode("s").alias("j", "x"))
    parts = parts.select("model", label, "j", "n", (F.col("x.c") * F.col("takes")).alias("c"), F.coalesce("x.m", F.lit(0.0)).alias("m"),
                         F.coalesce("x.v", F.lit(0.0)).alias("v"))

    def merged(by: Sequence[str], prefix: str, df: DataFrame) -> DataFrame:
        """Count, mean and variance of the union of the parts, about the union's own mean."""
        w = Window.partitionBy(*by)
        df = df.withColumn(f"{prefix}c", F.sum("c").over(w))
        df = df.withColumn(f"{prefix}m", F.try_divide(F.sum(F.col("c") * F.col("m")).over(w), F.col(f"{prefix}c")))
        apart = F.col("v") + F.pow(F.col("m") - F.col(f"{prefix}m"), 2)
        return df.withColumn(f"{prefix}v", F.try_divide(F.sum(F.col("c") * apart).over(w), F.col(f"{prefix}c")))

    parts = merged(["model", "j"], "all_", merged(["model", label, "j"], "own_", parts))
    terms = parts.groupBy("model", label, "j").agg(F.sum("n").alias("n"), F.first("own_m").alias("m"), F.first("own_v").alias("v"), F.first("all_v").alias("all_v"))
    terms = terms.withColumn("v", F.greatest(F.col("v") + smoothing * F.max("all_v").over(Window.partitionBy("model")), F.lit(LEAST_VARIANCE)))
    term = F.struct("j", "m", "v", (-0.5 * F.ln(2 * F.pi() * F.col("v"))).alias("f"))
    models = terms.groupBy("model", label).agg(F.max("n").cast("bigint").alias("n"), F.array_sort(F.collect_list(term)).alias("terms"))
    total = F.sum("n").over(Window.partitionBy("model"))
    place = F.row_number().over(Window.partitionBy("model").orderBy(label)) - 1
    return models.select("model", label, place.alias("class"), "n", F.ln(F.try_divide("n", total)).alias("prior"), "terms")


def class_probabilities(df: DataFrame, models: DataFrame, features: Sequence[str], model: Column, out: str = "probabilities") -> DataFrame:
    """Add ``out``: the probability of each class, in class order, by the model that ``model`` names.

    A missing feature value says nothing about the class.  A model that does
    not exist gives NULL.
    """
    features = list(features)
    one = (models.groupBy("model").agg(F.array_sort(F.collect_list(F.struct("class", "prior", "terms"))).alias("classes"))
                 .agg(F.map_from_entries(F.collect_list(F.struct("model", "classes")))))
    last = len(features) - 1
    x = F.array(*[F.col(f"`{c}`").cast("double") for c in features])

    def evidence(c: Column) -> Column:
        def add(total: Column, j: Column) -> Column:
            t = F.get(c["terms"], j)
            return total + F.coalesce(t["f"] - 0.5 * F.pow(F.get(F.col("__x"), j) - t["m"], 2) / t["v"], F.lit(0.0))
        return F.coalesce(F.aggregate(F.sequence(F.lit(0), F.lit(last)), c["prior"], add), F.lit(float("-inf")))

    rows = df.withColumn("__x", x).withColumn("__m", F.try_element_at(one.scalar(), model))
    rows = rows.withColumn("__e", F.transform("__m", evidence))
    rows = rows.withColumn("__e", F.transform("__e", lambda e: F.exp(e - F.array_max("__e"))))
    total = F.aggregate("__e", F.lit(0.0), lambda a, e: a + e)
    return rows.withColumn(out, F.transform("__e", lambda e: e / total)).drop("__x", "__m", "__e")


def predicted_class(probabilities: str = "probabilities") -> Column:
    """The class with the largest probability; the lowest of equal ones."""
    p = F.col(probabilities)
    return (F.array_position(p, F.array_max(p)) - 1).cast("int")


def out_of_fold(df: DataFrame, id_col: str, features: Sequence[str], label: str, fold_col: str = "fold", k: int = 5,
                smoothing: float = SMOOTHING) -> tuple[DataFrame, DataFrame]:
    """``(scores, models)``: each row scored by the model of the other folds.

    ``scores``: (id, fold, label, probabilities).  A row without a label or a
    fold is an error: it would be neither trained on nor scored.
    """
    whole = F.col(fold_col).isNull() | F.col(label).isNull()
    df = df.withColumn(fold_col, F.when(whole, F.raise_error(F.lit("a row without a fold or a label")).cast("int")).otherwise(F.col(fold_col)))
    models = fold_models(df, features, label, fold_col, k, smoothing)
    scored = class_probabilities(df, models, features, F.col(fold_col))
    return scored.select(id_col, fold_col, label, "probabilities"), models
