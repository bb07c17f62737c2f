"""Oracle SQL text helpers (DuckDB dialect) for aggregate specs and codes."""

from __future__ import annotations


def sql_agg(col: str, agg: str, integer: bool = False) -> str:
    """SQL form of one spec aggregate, with the group rules of the library."""
    if agg == "min":
        return f"min({col})"
    if agg == "max":
        return f"max({col})"
    if agg == "mean":
        return f"avg({col})"
    if agg == "sum":
        return f"CAST(coalesce(sum({col}), 0) AS BIGINT)" if integer else f"coalesce(sum({col}), 0)"
    if agg == "var":
        return f"var_samp({col})"
    if agg == "std":
        return f"stddev_samp({col})"
    if agg == "size":
        return "count(*)"
    if agg == "nunique":
        return f"count(DISTINCT {col})"
    raise ValueError(agg)


def spec_select(spec: dict, prefix: str = "", integer_cols=(), digits: int | None = 4) -> str:
    """``agg(col) AS PREFIXcol_AGG`` items for a spec; doubles rounded."""
    items = []
    for col, aggs in spec.items():
        for a in aggs:
            integer = col in integer_cols and a in ("min", "max", "sum")
            e = sql_agg(col, a, integer)
            name = f"{prefix}{col}_{a.upper()}"
            if digits is not None and not (integer or a in ("size", "nunique")):
                e = f"round({e}, {digits})"
            items.append(f"{e} AS {name}")
    return ",\n       ".join(items)


def codes_cte(name: str, col: str, source: str, missing: str = "NULL") -> str:
    """``name(v, code)``: 0-based sorted code of each distinct category text."""
    return (f"{name} AS (SELECT v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS INTEGER) AS code "
            f"FROM (SELECT DISTINCT coalesce({col}, '{missing}') AS v FROM {source}))")
