"""Registry of the queries run over the driver's tables (name -> Spark, oracle SQL)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}

DIGITS = 4   # compare hygiene: doubles are rounded to 4 places on both sides


SNAP = 8     # noise below 1e-8 is removed before the final rounding


def _two_stage(sql: str, digits: int = DIGITS) -> str:
    """Rewrite every ``round(expr, 4)`` as the two-stage rounding of ``rounded``."""
    out, i, pat = [], 0, "round("
    while True:
        j = sql.find(pat, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k, comma = 1, j + len(pat), -1
        while depth:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                comma = k
            k += 1
        arg = sql[comma + 1:k - 1].strip() if comma >= 0 else ""
        if arg == str(digits):
            inner = _two_stage(sql[j + len(pat):comma], digits)
            out.append(sql[i:j])
            out.append(f"(round(round(({inner}) * 1e{SNAP}) / 1e{SNAP} * 1e{digits}) / 1e{digits})")
        else:
            out.append(sql[i:k])
        i = k


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = _two_stage(sql.strip())
        return fn
    return deco


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double column (for engine-independent comparison).

    Two stages on the binary value: snap to ``SNAP`` decimals (removes the
    last-bit noise of different summation orders), then round to ``digits``.
    Exact halves of the true value (means of small integers) then resolve
    the same way in every engine.  Spark's ``round(x, d)`` rounds the
    decimal text instead, so the integer form ``round(x * 10^d) / 10^d`` is used.
    """
    snap, scale = float(10 ** SNAP), float(10 ** digits)

    def r(c):
        return F.round(F.round(c * snap) / snap * scale) / scale

    return df.select(*[r(F.col(f"`{f.name}`")).alias(f.name)
                       if isinstance(f.dataType, DoubleType) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])
