"""Row-wise statistics over a list of columns, skipping missing values.

Written out as plain arithmetic over the columns (no arrays, no lambdas)
so the whole expression compiles into the generated code of its stage.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def _cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _present(c: Column) -> Column:
    return F.when(c.isNotNull(), F.lit(1.0)).otherwise(F.lit(0.0))


def _n(cols) -> Column:
    return reduce(add, [_present(c) for c in cols], F.lit(0.0))


def _sum(cols) -> Column:
    return reduce(add, [F.coalesce(c.cast("double"), F.lit(0.0)) for c in cols], F.lit(0.0))


def row_sum(cols) -> Column:
    """Sum across columns; missing counts as 0, so a row of missing sums to 0."""
    return _sum(_cols(cols))


def row_mean(cols) -> Column:
    """Mean of the present values; NULL when none is present."""
    cs = _cols(cols)
    n = _n(cs)
    return F.when(n > 0, _sum(cs) / n)


def _central_sum(cs, mean: Column, power: int) -> Column:
    def term(c):
        d = c.cast("double") - mean
        p = d * d if power == 2 else (d * d) * (d * d)
        return F.coalesce(p, F.lit(0.0))
    return reduce(add, [term(c) for c in cs], F.lit(0.0))


def row_std(cols) -> Column:
    """Sample standard deviation (n-1) of the present values; NULL below 2 values."""
    cs = _cols(cols)
    n = _n(cs)
    mean = _sum(cs) / n
    return F.when(n >= 2, F.sqrt(_central_sum(cs, mean, 2) / (n - 1)))


def _zero_small(x: Column) -> Column:
    # Round-off guard: magnitudes below 1e-14 count as exactly zero.
    return F.when(F.abs(x) < 1e-14, F.lit(0.0)).otherwise(x)


def row_kurtosis(cols) -> Column:
    """Bias-corrected excess kurtosis (G2) of the present values.

    NULL below 4 values; 0 when all present values are equal.
    G2 = n(n+1)(n-1) m4 / ((n-2)(n-3) m2^2) - 3(n-1)^2 / ((n-2)(n-3)),
    with m2, m4 the central sums of squares and fourth powers.
    """
    cs = _cols(cols)
    n = _n(cs)
    mean = _sum(cs) / n
    m2 = _central_sum(cs, mean, 2)
    m4 = _central_sum(cs, mean, 4)
    num = _zero_small(n * (n + 1) * (n - 1) * m4)
    den = _zero_small((n - 2) * (n - 3) * m2 * m2)
    adj = 3 * (n - 1) * (n - 1) / ((n - 2) * (n - 3))
    return (F.when(n < 4, F.lit(None).cast("double"))
            .when(den == 0, F.lit(0.0))
            .otherwise(num / den - adj))


def _stage(df, cols, tag):
    """Add the count and mean of the present values as their own columns.

    Separate projections keep the mean from being re-expanded inside every
    central-moment term (the optimizer does not inline a non-trivial
    expression that is referenced many times).
    """
    cs = _cols(cols)
    n, m = f"__{tag}_n", f"__{tag}_m"
    df = df.withColumn(n, _n(cs))
    df = df.withColumn(m, F.when(F.col(n) > 0, _sum(cs) / F.col(n)))
    return df, cs, F.col(n), F.col(m)


def with_row_std(df, cols, out: str):
    """``df`` plus ``out`` = row-wise sample std (n-1) of ``cols`` (staged)."""
    df, cs, n, m = _stage(df, cols, out)
    df = df.withColumn(out, F.when(n >= 2, F.sqrt(_central_sum(cs, m, 2) / (n - 1))))
    return df.drop(f"__{out}_n", f"__{out}_m")


def with_row_kurtosis(df, cols, out: str):
    """``df`` plus ``out`` = row-wise bias-corrected excess kurtosis (staged)."""
    df, cs, n, m = _stage(df, cols, out)
    m2c, m4c = f"__{out}_m2", f"__{out}_m4"
    df = (df.withColumn(m2c, _central_sum(cs, m, 2))
            .withColumn(m4c, _central_sum(cs, m, 4)))
    m2, m4 = F.col(m2c), F.col(m4c)
    num = _zero_small(n * (n + 1) * (n - 1) * m4)
    den = _zero_small((n - 2) * (n - 3) * m2 * m2)
    adj = 3 * (n - 1) * (n - 1) / ((n - 2) * (n - 3))
    df = df.withColumn(out, F.when(n < 4, F.lit(None).cast("double"))
                              .when(den == 0, F.lit(0.0))
                              .otherwise(num / den - adj))
    return df.drop(f"__{out}_n", f"__{out}_m", m2c, m4c)
