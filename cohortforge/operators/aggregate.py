"""Group-to-one-row aggregates.

Every child table is reduced with **one** ``groupBy(key).agg(...)`` that holds
all of its feature blocks, so each table is shuffled once.  The aggregates
are built-in and algebraic (partial aggregation on the map side), so a key
that holds a third of all rows is pre-combined in every task before the
shuffle and never gathered whole in one place.

Group rules (those of the source tables' engine):
* missing values are skipped; rows whose key is missing form no group;
* ``sum`` of a group without values is 0, ``size`` counts rows;
* ``var``/``std`` use n-1 and are missing for one row;
* NaN results (from +inf and -inf in one group) become missing.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from cohortforge.functions.semantics import nan_to_null, psum


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _size(_c_) -> Column:
    return F.count(F.lit(1))


# Aggregate names accepted by specs, as written in the source specs.
AGGREGATES = {
    "min": lambda c: F.min(c),
    "max": lambda c: F.max(c),
    "mean": lambda c: nan_to_null(F.avg(c)),
    "sum": lambda c: psum(c),
    "var": lambda c: nan_to_null(F.var_samp(c)),
    "std": lambda c: nan_to_null(F.stddev_samp(c)),
    "size": _size,
    "count": lambda c: F.count(c),
    "nunique": lambda c: F.count_distinct(c),
    "median": lambda c: F.median(c),
}


def agg_name(prefix: str, col: str, agg: str) -> str:
    """Name of an aggregate column: ``PREFIX + column + "_" + AGG``."""
    return f"{prefix}{col}_{agg.upper()}"


def agg_spec(spec: Mapping[str, Sequence[str]], prefix: str = "",
             columns: Mapping[str, Column] | None = None) -> list[Column]:
    """Aggregate columns for a spec ``{column: [aggregate names]}``.

    ``columns`` may map a spec name to a derived expression (the name is then
    only used for the output).  Order follows the spec.
    """
    out = []
    for col, aggs in spec.items():
        src = (columns or {}).get(col, F.col(col))
        for a in aggs:
            if a not in AGGREGATES:
                raise ValueError(f"unknown aggregate {a!r} for column {col!r}")
            out.append(AGGREGATES[a](src).alias(agg_name(prefix, col, a)))
    return out


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric columns in schema order (strings and dates are left out)."""
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in ex]


def string_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if f.dataType.typeName() == "string" and f.name not in ex]


def mean_all(df: DataFrame, key: str, names: Mapping[str, str] | None = None) -> list[Column]:
    """Mean of every numeric non-key column (ids included)."""
    return [AGGREGATES["mean"](F.col(c)).alias((names or {}).get(c, c))
            for c in numeric_columns(df, exclude=[key])]


def recency_weight(month) -> Column:
    """Weight -1/month: recent (small negative) months weigh most."""
    return F.try_divide(F.lit(-1.0), _c(month).cast("double"))


def weighted_mean(x, month) -> Column:
    """Recency-weighted mean ``sum(x*w)/sum(w)``, ``w = -1/month``.

    Missing when any value or any month of the group is missing, when a
    month is 0, or when the weights sum to 0.
    """
    x = _c(x).cast("double")
    m = _c(month)
    w = recency_weight(m)
    complete = ((F.count(x) == F.count(F.lit(1)))
                & (F.count(m) == F.count(F.lit(1)))
                & (F.min(F.abs(m)) > 0))
    return F.when(complete, F.try_divide(F.sum(x * w), F.sum(w)))


def mode_value(c) -> Column:
    """Most frequent value of the group; ties go to the lowest value."""
    return F.mode(_c(c), True)


def latest_struct(order_col, value_cols: Sequence[str], tiebreak: Sequence[str]) -> Column:
    """Aggregate: the values of the row with the largest ``order_col``.

    Ties are broken by the ``tiebreak`` columns, largest first (missing
    last), which makes the choice a total order over distinct rows.
    Rows without an order value are skipped (their ordering struct is NULL).
    """
    o = _c(order_col)
    ordering = F.when(o.isNotNull(), F.struct(o.alias("_o"), *[F.col(t) for t in tiebreak]))
    return F.max_by(F.struct(*[F.col(v) for v in value_cols]), ordering)


def latest_by(df: DataFrame, key: str, order_col: str, value_cols: Sequence[str],
              tiebreak: Sequence[str] | None = None, row_id: str | None = None) -> DataFrame:
    """One row per key: the row with the latest ``order_col`` (top-1 per group).

    With a ``row_id`` (see ``latest_rows``) hash aggregates and a join back.
    Without one, ties need a total order over the ``tiebreak`` columns, which
    takes a ``max_by`` aggregate over structs: partially aggregated on the map
    side, but by sorting.
    """
    if row_id is not None:
        return latest_rows(df, key, order_col, value_cols, row_id)
    if tiebreak is None:
        tiebreak = [c for c in df.columns if c not in (key, order_col)]
    return (df.filter(F.col(key).isNotNull() & F.col(order_col).isNotNull())
              .groupBy(key)
              .agg(latest_struct(order_col, value_cols, tiebreak).alias("_latest"))
              .select(key, *[F.col(f"_latest.{v}").alias(v) for v in value_cols]))


_INTEGRAL = ("byte", "short", "integer", "long")


def packed_order(order_col: str, row_id: str) -> Column:
    """An integral order column and an integral row id in one decimal that sorts like the pair: ``max`` of it has a fixed-width buffer."""
    half = F.lit(Decimal(1 << 63))
    low = F.coalesce(F.col(row_id).cast("decimal(20,0)"), -half) + half
    return (F.col(order_col).cast("decimal(18,0)") * F.lit(Decimal(1 << 64))).cast("decimal(38,0)") + low


def is_integral(df: DataFrame, *cols: str) -> bool:
    return all(df.schema[c].dataType.typeName() in _INTEGRAL for c in cols)


def latest_rows(df: DataFrame, key: str, order_col: str, value_cols: Sequence[str], row_id: str) -> DataFrame:
    """One row per key: the row with the latest ``order_col`` and, among those, the largest ``row_id``.

    ``row_id`` must tell the rows of a key with one order value apart (a place
    in file order does, negated for "first").  Hash aggregates over fixed-width
    buffers find the winners, and a join back reads their values, so that no
    text is aggregated or sorted.  Integral columns take one aggregate over
    both in one decimal; others take one for the order column and one over
    what it leaves.  Rows without a key or an order value are skipped; a
    missing row id comes last; rows of a key that are equal in ``value_cols``
    count once.
    """
    wanted = list(dict.fromkeys(value_cols))
    rows = df.filter(F.col(key).isNotNull() & F.col(order_col).isNotNull())
    if is_integral(df, order_col, row_id):
        rows = rows.select(F.col(key), packed_order(order_col, row_id).alias("__o"), *[F.col(c).alias(f"__v_{c}") for c in wanted])
        steps = ["__o"]
    else:
        rows = rows.select(F.col(key), F.col(order_col).alias("__o"), F.col(row_id).alias("__i"), *[F.col(c).alias(f"__v_{c}") for c in wanted])
        steps = ["__o", "__i"]
    for c in steps:
        best = rows.groupBy(key).agg(F.max(c).alias("__best")).withColumnRenamed(key, "__k")
        rows = rows.join(best, (F.col(key) == F.col("__k")) & F.col(c).eqNullSafe(F.col("__best")), "inner").drop("__k", "__best")
    return rows.select(key, *[F.col(f"__v_{c}").alias(c) for c in value_cols]).distinct()


def group_by_key(df: DataFrame, key: str, exprs: Sequence[Column]) -> DataFrame:
    """``groupBy(key).agg(exprs)`` over rows whose key is present."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(*exprs)


def group_by_spec(df: DataFrame, key: str, spec: Mapping[str, Sequence[str]], prefix: str = "",
                  extra: Sequence[Column] = ()) -> DataFrame:
    """One row per present key with the aggregates of ``spec`` and then ``extra``, in that order.

    Distinct counts go their own narrow way: (key, value) pairs are made
    distinct, then counted per key.  Inside one aggregate they would split the
    buffers of all other columns by the distinct values.  Both sides come out
    partitioned by the key, so that they meet without a further exchange.
    """
    distinct = {c: agg_name(prefix, c, "nunique") for c, aggs in spec.items() if "nunique" in aggs}
    wide = {c: [a for a in aggs if a != "nunique"] for c, aggs in spec.items()}
    out = group_by_key(df, key, [*agg_spec(wide, prefix), *(extra or ([] if any(wide.values()) else [F.count(F.lit(1)).alias("__rows")]))])
    for c, name in distinct.items():
        pairs = df.filter(F.col(key).isNotNull() & F.col(c).isNotNull()).select(F.col(key).alias("__dk"), F.col(c).alias("__dv")).distinct()
        counts = pairs.groupBy("__dk").agg(F.count(F.lit(1)).alias("__dn"))
        out = (out.join(counts, F.col(key) == F.col("__dk"), "left")
                  .withColumn(name, F.coalesce(F.col("__dn"), F.lit(0))).drop("__dk", "__dn"))
    order = [agg_name(prefix, c, a) for c, aggs in spec.items() for a in aggs]
    return out.select(key, *order, *[c for c in out.columns if c not in {key, "__rows", *order}])


def group_median(df: DataFrame, key: str, value: str, out: str, method: str = "exact",
                 accuracy: int = 10000) -> DataFrame:
    """Interpolated median of ``value`` per ``key`` (missing keys/values skipped).

    ``method``:
    * ``"exact"`` (default): distributed and exact.  Rows are counted per
      (key, value) (map-side combined), a running count in value order is
      computed per key by value range (``rank.running_totals``: no task
      holds a whole group), and the values at the two middle ranks are
      picked: ``lo + (hi - lo) * 0.5``.
    * ``"buffer"``: ``F.median``, which keeps a group's distinct values in one
      aggregation buffer (fine for small groups).
    * ``"sketch"``: ``percentile_approx`` with bounded memory (approximate).
    """
    rows = df.filter(F.col(key).isNotNull() & F.col(value).isNotNull())
    if method == "buffer":
        return rows.groupBy(key).agg(F.median(value).alias(out))
    if method == "sketch":
        return rows.groupBy(key).agg(
            F.percentile_approx(value, 0.5, accuracy).cast("double").alias(out))
    from cohortforge.operators.join import shared
    from cohortforge.operators.rank import running_totals
    counts = shared(rows.groupBy(key, value).agg(F.count(F.lit(1)).alias("__c")))
    cum = running_totals(counts, [key], [value], ["__c"])
    sizes = counts.groupBy(key).agg(F.sum("__c").alias("__n"))
    j = cum.join(sizes, key)
    lo = F.floor((F.col("__n") - 1) / 2)
    hi = F.ceil((F.col("__n") - 1) / 2)
    start, end = F.col("cum___c"), F.col("cum___c") + F.col("__c")
    j = j.filter(((start <= lo) & (lo < end)) | ((start <= hi) & (hi < end)))
    v = F.col(value).cast("double")
    picked = j.groupBy(key).agg(F.max(F.when((start <= lo) & (lo < end), v)).alias("__lo"),
                                F.max(F.when((start <= hi) & (hi < end), v)).alias("__hi"))
    return shared(picked.select(key, (F.col("__lo") + (F.col("__hi") - F.col("__lo")) * 0.5).alias(out)))


def value_counts(df: DataFrame, key: str, out: str) -> DataFrame:
    """Rows per key (key kept as a column, missing keys dropped)."""
    return group_by_key(df, key, [F.count(F.lit(1)).alias(out)])
