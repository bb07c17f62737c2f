"""Model metrics: exact ROC AUC, log loss, squared error, accuracy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.operators.rank import running_totals


def auc_exact(df: DataFrame, label: str, score: str, by: Sequence[str] = (),
              n_ranges: int | None = None) -> DataFrame:
    """Exact ROC AUC (ties count one half), per ``by`` group.

    Rows are first reduced to one row per distinct score (positives and
    negatives counted, map-side combined); AUC is
    ``sum(pos * (neg_below + neg / 2)) / (n_pos * n_neg)`` where ``neg_below``
    is a running total in score order.
    """
    by = list(by)
    per_score = (df.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
                   .groupBy(*by, score)
                   .agg(F.sum((F.col(label) == 1).cast("bigint")).alias("pos"),
                        F.sum((F.col(label) != 1).cast("bigint")).alias("neg")))
    cum = running_totals(per_score, by, [score], ["neg"], n_ranges)
    agg = cum.groupBy(*by).agg(
        F.sum(F.col("pos") * (F.col("cum_neg") + F.col("neg") / 2.0)).alias("__u"),
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    return agg.select(*by, F.try_divide(F.col("__u"), F.col("n_pos") * F.col("n_neg"))
                      .alias("auc"), "n_pos", "n_neg")


def auc_evaluator(df: DataFrame, label: str, raw: str = "rawPrediction") -> float:
    """Area under ROC by Spark ML's evaluator (exact: numBins=0)."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=raw,
                                       metricName="areaUnderROC", numBins=0)
    return ev.evaluate(df.withColumn(label, F.col(label).cast("double")))


def losses(df: DataFrame, label: str, prob: str, by: Sequence[str] = (),
           eps: float = 1e-7) -> DataFrame:
    """Binary cross-entropy, squared error and accuracy of probabilities."""
    y = F.col(label).cast("double")
    p = F.least(F.greatest(F.col(prob).cast("double"), F.lit(eps)), F.lit(1 - eps))
    return df.groupBy(*by).agg(
        F.avg(-(y * F.ln(p) + (1 - y) * F.ln(1 - p))).alias("log_loss"),
        F.avg(F.pow(y - F.col(prob), 2)).alias("mse"),
        F.avg((y == F.round(F.col(prob))).cast("double")).alias("accuracy"),
        F.count(F.lit(1)).alias("n"))


def categorical_losses(df: DataFrame, label_class: str, probabilities: str, by: Sequence[str] = (),
                       eps: float = 1e-7) -> DataFrame:
    """Categorical cross-entropy and accuracy of class probability arrays; rows without a class are skipped."""
    p = F.col(probabilities)
    own = F.least(F.greatest(F.get(p, F.col(label_class)), F.lit(eps)), F.lit(1 - eps))
    right = F.array_position(p, F.array_max(p)) - 1 == F.col(label_class)
    return (df.filter(F.col(label_class).isNotNull()).groupBy(*by)
              .agg(F.avg(-F.ln(own)).alias("cross_entropy"), F.avg(right.cast("double")).alias("accuracy"), F.count(F.lit(1)).alias("n")))
