"""Registered queries: row-wise features and the group-median lookup."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortforge.functions.rowwise import row_mean, row_sum, with_row_kurtosis, with_row_std
from cohortforge.functions.semantics import ratio, replace_inf, sentinel_to_null
from cohortforge.operators.aggregate import group_median
from cohortforge.operators.select import median_by_rounds
from cohortforge.operators.join import lookup
from cohortforge.operators.profile import fill_with_mean
from cohortforge.plans import standins as S
from cohortforge.plans.registry import register, rounded


def _sql_ratio(a, b):
    return (f"CASE WHEN ({b}) = 0 THEN CASE WHEN ({a}) > 0 THEN 999.0 WHEN ({a}) < 0 THEN -999.0 "
            f"END ELSE ({a}) / ({b}) END")


# --- M1 M4 F1 F2 --------------------------------------------------------------
@register("app_ratios", f"""
SELECT l_orderkey, l_linenumber,
  round({_sql_ratio('l_extendedprice', 'l_discount')}, 4) AS r_price_disc,
  round({_sql_ratio('l_discount', 'l_tax')}, 4) AS r_disc_tax,
  round({_sql_ratio('l_discount - 0.05', 'l_tax')}, 4) AS r_shift_tax,
  round({_sql_ratio('l_quantity', '1 + l_tax')}, 4) AS r_qty_per_tax1,
  round({_sql_ratio('l_quantity', 'nullif(l_linenumber, 7)')}, 4) AS r_qty_by_line,
  round(l_discount * l_tax * l_quantity, 4) AS prod3
FROM lineitem
""")
def app_ratios(spark, d):
    li = S.table(spark, d, "lineitem")
    return rounded(li.select(
        "l_orderkey", "l_linenumber",
        replace_inf(ratio("l_extendedprice", "l_discount")).alias("r_price_disc"),
        replace_inf(ratio("l_discount", "l_tax")).alias("r_disc_tax"),
        replace_inf(ratio(F.col("l_discount") - 0.05, "l_tax")).alias("r_shift_tax"),
        replace_inf(ratio("l_quantity", F.lit(1) + F.col("l_tax"))).alias("r_qty_per_tax1"),
        replace_inf(ratio("l_quantity", sentinel_to_null("l_linenumber", 7))).alias("r_qty_by_line"),
        (F.col("l_discount") * F.col("l_tax") * F.col("l_quantity")).alias("prod3")))


# --- M5 M6 M7 F4 --------------------------------------------------------------
_X = ["nullif(l_discount, 0)", "nullif(l_tax, 0)", "l_quantity / 50"]
_N = " + ".join(f"CAST(({x}) IS NOT NULL AS DOUBLE)" for x in _X)
_S = " + ".join(f"coalesce({x}, 0)" for x in _X)


def _central(power, mean):
    return " + ".join(f"coalesce(pow(({x}) - ({mean}), {power}), 0)" for x in _X)


@register("row_stats", f"""
WITH r AS (
  SELECT l_orderkey, l_linenumber,
         CASE WHEN ({_N}) > 0 THEN ({_S}) / ({_N}) END AS row_mean,
         CASE WHEN ({_N}) >= 2 THEN sqrt(({_central(2, f'({_S}) / ({_N})')}) / (({_N}) - 1)) END
           AS std0,
         {_S} AS row_sum
  FROM lineitem)
SELECT l_orderkey, l_linenumber, round(row_mean, 4) AS row_mean,
       round(coalesce(std0, avg(std0) OVER ()), 4) AS row_std, round(row_sum, 4) AS row_sum
FROM r
""")
def row_stats(spark, d):
    li = S.table(spark, d, "lineitem")
    xs = [F.nullif(F.col("l_discount"), F.lit(0)), F.nullif(F.col("l_tax"), F.lit(0)),
          F.col("l_quantity") / 50]
    base = li.select("l_orderkey", "l_linenumber", *[x.alias(f"x{i}") for i, x in enumerate(xs)])
    names = [f"x{i}" for i in range(len(xs))]
    out = with_row_std(base, names, "row_std")
    out = out.select("l_orderkey", "l_linenumber", row_mean(names).alias("row_mean"), "row_std",
                     row_sum(names).alias("row_sum"))
    return rounded(fill_with_mean(out, "row_std"))


# --- M8 -----------------------------------------------------------------------
_FLAGS = ["CAST(l_returnflag = 'R' AS INT)", "CAST(l_linestatus = 'O' AS INT)",
          "CAST(l_discount = 0 AS INT)",
          "CASE WHEN l_tax = 0 THEN NULL ELSE CAST(l_tax > 0.04 AS INT) END",
          "CAST(l_quantity > 25 AS INT)"]


def _kurt_sql(xs):
    n = " + ".join(f"CAST(({x}) IS NOT NULL AS DOUBLE)" for x in xs)
    s = " + ".join(f"coalesce({x}, 0)" for x in xs)
    m = f"(({s}) / ({n}))"
    m2 = " + ".join(f"coalesce(pow(({x}) - {m}, 2), 0)" for x in xs)
    m4 = " + ".join(f"coalesce(pow(({x}) - {m}, 4), 0)" for x in xs)
    num = f"(({n}) * (({n}) + 1) * (({n}) - 1) * ({m4}))"
    den = f"((({n}) - 2) * (({n}) - 3) * ({m2}) * ({m2}))"
    z = "CASE WHEN abs({0}) < 1e-14 THEN 0.0 ELSE {0} END"
    adj = f"(3 * (({n}) - 1) * (({n}) - 1) / ((({n}) - 2) * (({n}) - 3)))"
    return (f"CASE WHEN ({n}) < 4 THEN NULL WHEN {z.format(den)} = 0 THEN 0.0 "
            f"ELSE {z.format(num)} / {z.format(den)} - {adj} END")


@register("row_kurtosis", f"""
SELECT l_orderkey, l_linenumber, round({_kurt_sql(_FLAGS)}, 4) AS kurt FROM lineitem
""")
def row_kurtosis_q(spark, d):
    li = S.table(spark, d, "lineitem")
    c = F.col
    flags = [(c("l_returnflag") == "R").cast("int"), (c("l_linestatus") == "O").cast("int"),
             (c("l_discount") == 0).cast("int"),
             F.when(c("l_tax") != 0, (c("l_tax") > 0.04).cast("int")),
             (c("l_quantity") > 25).cast("int")]
    base = li.select("l_orderkey", "l_linenumber", *[f.alias(f"f{i}") for i, f in enumerate(flags)])
    out = with_row_kurtosis(base, [f"f{i}" for i in range(len(flags))], "kurt")
    return rounded(out.select("l_orderkey", "l_linenumber", "kurt"))


# --- A14 J16 ------------------------------------------------------------------
@register("group_median_lookup", """
SELECT c.c_custkey, c.c_mktsegment, round(m.med, 4) AS NEW_BAL_BY_SEGMENT
FROM customer c LEFT JOIN (SELECT c_mktsegment, median(c_acctbal) AS med FROM customer
                           WHERE c_mktsegment IS NOT NULL GROUP BY 1) m
  ON c.c_mktsegment = m.c_mktsegment
""")
def group_median_lookup(spark, d):
    c = S.table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    med = group_median(c, "c_mktsegment", "c_acctbal", "med")
    out = lookup(c, med, "c_mktsegment", "med", "NEW_BAL_BY_SEGMENT")
    return rounded(out.select("c_custkey", "c_mktsegment", "NEW_BAL_BY_SEGMENT"))


@register("group_median_rounds", """
SELECT o_orderstatus, round(median(l_extendedprice), 4) AS med, 'status' AS kind
FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderstatus IS NOT NULL GROUP BY 1
UNION ALL SELECT CAST(l_suppkey AS VARCHAR), round(median(l_extendedprice), 4), 'supplier' FROM lineitem WHERE l_suppkey IS NOT NULL GROUP BY 1
""")
def group_median_rounds(spark, d):
    """Medians of three large groups and of many small ones, by counting rounds."""
    li = S.table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_extendedprice")
    o = S.table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    large = median_by_rounds(o.join(li, F.col("o_orderkey") == F.col("l_orderkey")), "o_orderstatus", "l_extendedprice", "med", small=1000)
    many = median_by_rounds(li.withColumn("o_orderstatus", F.col("l_suppkey").cast("string")), "o_orderstatus", "l_extendedprice", "med")
    return rounded(large.withColumn("kind", F.lit("status")).unionByName(many.withColumn("kind", F.lit("supplier"))))
