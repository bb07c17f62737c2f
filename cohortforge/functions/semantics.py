"""Missing-value and arithmetic rules of the feature tables.

The tables use SQL NULL as the one missing marker.  NaN never enters a
table: it is turned into NULL at ingest (``nan_to_null``), because Spark
aggregates treat NaN as a value.  Division keeps the sign of infinity for
``x / 0`` and gives NULL for ``0 / 0`` so that later steps can map the
infinities to fixed numbers (``replace_inf``).  All helpers are built-in
expressions, so they stay inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the source data: the "no date" marker of the relative-day
# columns, and the numbers that stand in for +inf / -inf.
NO_DATE_SENTINEL = 365243
POS_INF_FILL = 999
NEG_INF_FILL = -999


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(a, b) -> Column:
    """a / b as a double; x/0 is +inf or -inf by the sign of x, 0/0 is NULL."""
    a = _c(a).cast("double")
    b = _c(b).cast("double")
    signed_inf = (F.when(a > 0, F.lit(float("inf")))
                  .when(a < 0, F.lit(float("-inf"))))
    return F.when(b == 0, signed_inf).otherwise(F.try_divide(a, b))


def psum(c) -> Column:
    """Group sum where a group without values sums to 0 (not NULL)."""
    return F.coalesce(F.sum(_c(c)), F.lit(0))


def nan_to_null(c) -> Column:
    """NaN becomes NULL; other values pass through."""
    c = _c(c)
    return F.when(~F.isnan(c), c)


def replace_inf(c, pos=POS_INF_FILL, neg=NEG_INF_FILL) -> Column:
    """+inf and -inf become fixed finite numbers."""
    c = _c(c)
    return (F.when(c == float("inf"), F.lit(pos).cast("double"))
            .when(c == float("-inf"), F.lit(neg).cast("double"))
            .otherwise(c))


def clip_positive(c) -> Column:
    """Keep positive values, everything else (NULL included) becomes 0."""
    c = _c(c)
    return F.when(c > 0, c).otherwise(F.lit(0)).cast("double")


def sentinel_to_null(c, sentinel=NO_DATE_SENTINEL) -> Column:
    """A marker value becomes NULL."""
    return F.nullif(_c(c), F.lit(sentinel))


def as_text(c, missing: str = "nan") -> Column:
    """Cast any value to text; a missing value becomes the text ``missing``."""
    return F.coalesce(_c(c).cast("string"), F.lit(missing))
