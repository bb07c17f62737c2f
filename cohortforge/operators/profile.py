"""Column profiles (null share, cardinality) and the steps that use them.

A profile is one aggregate over all columns: its single result row has one
field per column, so what reaches the driver grows with the column count,
never with the row count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from cohortforge.functions.semantics import replace_inf


def _long_form(row_df: DataFrame, cols: Sequence[str], value_name: str) -> DataFrame:
    """Turn a one-row, one-field-per-column frame into (column_name, value) rows."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"),
                               F.col(f"`{c}`").cast("double").alias(value_name)) for c in cols])
    return row_df.select(F.inline(pairs))


def null_shares(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column_name, null_share): share of missing values per column."""
    cols = list(cols or df.columns)
    row = df.agg(*[F.avg(F.col(f"`{c}`").isNull().cast("double")).alias(c) for c in cols])
    return _long_form(row, cols, "null_share")


def prune_null_columns(df: DataFrame, threshold: float = 0.8,
                       protect: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """Drop columns whose null share is strictly above ``threshold``."""
    cols = [c for c in df.columns if c not in set(protect)]
    shares = {r["column_name"]: r["null_share"] for r in null_shares(df, cols).collect()}
    dropped = [c for c in cols if shares[c] is not None and shares[c] > threshold]
    return df.drop(*dropped), dropped


def fill_missing(df: DataFrame, value=0, cols: Sequence[str] | None = None) -> DataFrame:
    """Fill missing values of numeric columns with a constant."""
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    return df.na.fill(value, subset=list(cols))


def replace_inf_all(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """+-inf -> +-999 in every floating column."""
    cols = set(cols or [f.name for f in df.schema.fields
                        if f.dataType.typeName() in ("double", "float")])
    return df.select(*[replace_inf(F.col(f"`{c}`")).alias(c) if c in cols else F.col(f"`{c}`")
                       for c in df.columns])


def _as_key(df: DataFrame, c: str) -> Column:
    """A column's value as text, equal exactly where the values are (negative zero is zero)."""
    col = F.col(f"`{c}`")
    return (col + F.lit(0.0).cast(df.schema[c].dataType) if df.schema[c].dataType.typeName() in ("double", "float") else col).cast("string")


def cardinalities(df: DataFrame, cols: Sequence[str] | None = None,
                  approximate: bool = False) -> DataFrame:
    """(column_name, n_distinct) for each column, missing counted as a value.

    Exact: every (column, value) once by a hash aggregate, then the pairs of
    each column counted by another; both combine before their shuffle, so a
    frequent value is one row per task.  ``approximate=True`` merges sketches
    (see ``cardinality_sketches``) of bounded size instead.
    """
    cols = list(cols or df.columns)
    if approximate:
        return sketch_estimates(cardinality_sketches(df, cols))
    pairs = F.array(*[F.struct(F.lit(i).alias("__c"), _as_key(df, c).alias("__v")) for i, c in enumerate(cols)])
    counts = df.select(F.inline(pairs)).distinct().groupBy("__c").agg(F.count(F.lit(1)).alias("n_distinct"))
    names = df.sparkSession.range(1).select(F.inline(F.array(*[F.struct(F.lit(i).alias("__i"), F.lit(c).alias("column_name")) for i, c in enumerate(cols)])))
    return names.join(counts, F.col("__i") == F.col("__c"), "left").select("column_name", F.coalesce("n_distinct", F.lit(0)).cast("bigint").alias("n_distinct"))


SKETCH_LOG_SIZE = 14                    # 2**14 registers per column
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_LOG_SIZE / 2)        # relative standard error of an estimate


def cardinality_sketches(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column_name, sketch, has_missing): one row per column, of bounded size, to be saved and merged with other runs' rows."""
    cols = list(cols or df.columns)
    row = df.agg(*[F.struct(F.hll_sketch_agg(_as_key(df, c), F.lit(SKETCH_LOG_SIZE)).alias("sketch"),
                            F.coalesce(F.max(F.col(f"`{c}`").isNull().cast("int")), F.lit(0)).alias("has_missing")).alias(f"s{i}") for i, c in enumerate(cols)])
    return row.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"s{i}.sketch").alias("sketch"), F.col(f"s{i}.has_missing").alias("has_missing"))
                                         for i, c in enumerate(cols)])))


def merge_sketches(*runs: DataFrame) -> DataFrame:
    """The sketches of several runs' rows together."""
    out = runs[0]
    for r in runs[1:]:
        out = out.unionByName(r)
    return out.groupBy("column_name").agg(F.hll_union_agg("sketch").alias("sketch"), F.max("has_missing").alias("has_missing"))


def sketch_estimates(sketches: DataFrame) -> DataFrame:
    """(column_name, n_distinct) of sketches; a relative standard error of ``SKETCH_ERROR``, missing counted as a value."""
    return sketches.select("column_name", (F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0)) + F.col("has_missing")).cast("bigint").alias("n_distinct"))


def embedding_width(n: Column, cap: int = 100) -> Column:
    """Width of a category's input block: 5 below 8 values, else n//2 + 1, capped."""
    return F.least(F.when(n < 8, F.lit(5)).otherwise(F.floor(n / 2) + 1),
                   F.lit(cap)).cast("bigint")


def feature_catalogue(df: DataFrame, categorical: Sequence[str], small_below: int = 5,
                      cap: int = 100) -> DataFrame:
    """One row per column: position, kind, cardinality, small flag, width."""
    cats = set(categorical)
    prof = cardinalities(df)
    pos = F.array(*[F.struct(F.lit(c).alias("c"), F.lit(i).cast("bigint").alias("p"),
                             F.lit("categorical" if c in cats else "continuous").alias("k"))
                    for i, c in enumerate(df.columns)])
    meta = df.sparkSession.range(1).select(F.inline(pos)).select(
        F.col("c").alias("column_name"), F.col("p").alias("position"), F.col("k").alias("kind"))
    return (prof.join(F.broadcast(meta), "column_name")
                .withColumn("is_small", (F.col("n_distinct") < small_below).cast("int"))
                .withColumn("width", F.when(F.col("kind") == "categorical",
                                            embedding_width(F.col("n_distinct"), cap))))


def standardise_fit(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population std of each column (one aggregate, one row)."""
    row = df.agg(*[x for c in cols for x in (F.avg(c).alias(f"m_{c}"),
                                             F.stddev_pop(c).alias(f"s_{c}"))]).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in cols}


def standardise_apply(df: DataFrame, moments: dict[str, tuple[float, float]]) -> DataFrame:
    """(x - mean) / std; a constant column (std 0) becomes 0."""
    out = []
    for c in df.columns:
        if c in moments:
            m, s = moments[c]
            if s is None or s == 0:
                out.append(F.when(F.col(c).isNotNull(), F.lit(0.0)).alias(c))
            else:
                out.append(((F.col(c) - F.lit(m)) / F.lit(s)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def standardise(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Population-std scaler fitted and applied on ``df``."""
    return standardise_apply(df, standardise_fit(df, cols))


def fill_with_mean(df: DataFrame, col: str) -> DataFrame:
    """Fill a column's missing values with its own mean (lazy scalar subquery)."""
    mean = df.select(F.avg(col)).scalar()
    return df.withColumn(col, F.coalesce(F.col(col), mean))
