"""Registered queries: the wide feature table (flagship) on the stand-in tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from cohortforge.functions.semantics import NO_DATE_SENTINEL
from cohortforge.plans import standins as S
from cohortforge.plans.features import FeatureConfig, feature_engineering
from cohortforge.plans.registry import register, rounded

# The feature build of the source job, re-aimed at the stand-in columns.
STANDIN_CONFIG = FeatureConfig(
    key="c_custkey",
    app_features=[
        ("ratio", "NEW_BAL_TO_NATION_RATIO", "c_acctbal", "c_nationkey"),
        ("ratio_plus_one", "NEW_BAL_PER_NATION", "c_acctbal", "c_nationkey"),
        ("group_median", "NEW_BAL_BY_SEGMENT", "c_acctbal", "c_mktsegment"),
        ("product", "NEW_SOURCES_PROD", "scores"),
        ("row_mean", "NEW_SOURCES_MEAN", "scores"),
        ("row_std_filled", "NEW_SOURCES_STD", "scores"),
    ],
    score_cols=["c_acctbal", "c_nationkey"], doc_cols=[], live_cols=[],
    prev_key="o_custkey",
    prev_totals=[("PREV_APP_COUNT", "c_custkey", "count"),
                 ("TOTAL_PREV_LOAN_AMT", "o_totalprice", "sum")],
    cc_key="user_id", cc_mean_sum=["value"],
    bureau_key="o_custkey", bureau_id="o_orderkey", bureau_std=["o_totalprice"],
    bb_id="l_orderkey",
    pos_key="user_id", pos_wm=["value"],
    ins_key="o_custkey", ins_std=["AMT_INSTALMENT", "AMT_PAYMENT"],
    cc_row_id="event_id", pos_row_id="event_id", bb_row_id="__row",
)


def wide_features_df(spark, d):
    bal = S.balance(spark, d)
    return feature_engineering(S.app(spark, d), S.bureau(spark, d), S.bureau_balance_rows(spark, d),
                               bal, bal, S.prev(spark, d), S.instalments(spark, d),
                               STANDIN_CONFIG)


def _ratio(a, b):
    return (f"CASE WHEN ({b}) = 0 THEN CASE WHEN {a} > 0 THEN CAST('inf' AS DOUBLE) "
            f"WHEN {a} < 0 THEN CAST('-inf' AS DOUBLE) END ELSE {a} / ({b}) END")


_WM = ("CASE WHEN count({x}) = count(*) AND count(MONTHS_BALANCE) = count(*) "
       "AND min(abs(MONTHS_BALANCE)) > 0 THEN sum({x} * (-1.0 / MONTHS_BALANCE)) "
       "/ sum(-1.0 / MONTHS_BALANCE) END")

_MODE = """
{n}_codes AS (SELECT v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS VARCHAR) AS code
              FROM (SELECT DISTINCT coalesce({n}, 'NULL') AS v FROM p)),
{n}_mode AS (SELECT o_custkey, code FROM (
    SELECT o_custkey, v, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, v) AS rn
    FROM (SELECT o_custkey, coalesce({n}, 'NULL') AS v, count(*) AS n FROM p GROUP BY 1, 2))
  JOIN {n}_codes USING (v) WHERE rn = 1)"""

_N = "(CAST(c_acctbal IS NOT NULL AS INT) + CAST(c_nationkey IS NOT NULL AS INT))"
_MEAN = f"(coalesce(c_acctbal, 0) + coalesce(c_nationkey, 0)) / {_N}"

WIDE_SQL = f"""
WITH a AS {S.SQL_APP}, p AS {S.SQL_PREV}, b AS {S.SQL_BUREAU}, bb AS {S.SQL_BB},
e AS {S.SQL_BALANCE}, i AS {S.SQL_INS},
med AS (SELECT c_mktsegment, median(c_acctbal) AS med FROM a
        WHERE c_mktsegment IS NOT NULL GROUP BY 1),
app0 AS (
  SELECT a.*, {_ratio('c_acctbal', 'c_nationkey')} AS NEW_BAL_TO_NATION_RATIO,
         {_ratio('c_acctbal', '1 + c_nationkey')} AS NEW_BAL_PER_NATION,
         med.med AS NEW_BAL_BY_SEGMENT,
         c_acctbal * c_nationkey AS NEW_SOURCES_PROD,
         CASE WHEN {_N} > 0 THEN {_MEAN} END AS NEW_SOURCES_MEAN,
         CASE WHEN {_N} >= 2 THEN sqrt((coalesce(pow(c_acctbal - {_MEAN}, 2), 0)
              + coalesce(pow(c_nationkey - {_MEAN}, 2), 0)) / ({_N} - 1)) END AS std0
  FROM a LEFT JOIN med ON a.c_mktsegment = med.c_mktsegment),
app AS (SELECT * EXCLUDE (std0), coalesce(std0, avg(std0) OVER ()) AS NEW_SOURCES_STD FROM app0),
{_MODE.format(n='o_orderstatus')},
{_MODE.format(n='o_orderpriority')},
pa AS (SELECT o_custkey, count(o_custkey) AS PREV_APP_COUNT,
              coalesce(sum(o_totalprice), 0) AS TOTAL_PREV_LOAN_AMT,
              avg(o_orderkey) AS o_orderkey, avg(o_totalprice) AS o_totalprice
       FROM p GROUP BY 1),
cl AS (SELECT user_id, event_type FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY MONTHS_BALANCE DESC,
           event_id DESC NULLS LAST, event_type DESC NULLS LAST, value DESC NULLS LAST) AS rn
         FROM e) WHERE rn = 1),
ca AS (SELECT user_id, {_WM.format(x='event_id')} AS event_id, {_WM.format(x='value')} AS value,
              {_WM.format(x='MONTHS_BALANCE')} AS MONTHS_BALANCE,
              avg(value) AS BUREAU_value_MEAN, coalesce(sum(value), 0) AS BUREAU_value_SUM,
              count(*) AS n_events
       FROM e GROUP BY 1),
bl AS (SELECT * EXCLUDE (rn) FROM (
         SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY MONTHS_BALANCE DESC,
           l_linenumber DESC NULLS LAST, l_quantity DESC NULLS LAST, l_returnflag DESC NULLS LAST,
           l_linestatus DESC NULLS LAST, MONTHS_BALANCE DESC NULLS LAST) AS rn
         FROM bb) WHERE rn = 1),
ba AS (SELECT o_custkey, avg(o_orderkey) AS mk, avg(o_totalprice) AS mp,
              stddev_samp(o_totalprice) AS sp, coalesce(sum(o_totalprice), 0) AS tp,
              count(*) AS n_bureau
       FROM b GROUP BY 1),
ia AS (SELECT o_custkey, avg(o_orderkey) AS o_orderkey_IAVG,
              avg(DAYS_INSTALMENT) AS DAYS_INSTALMENT, avg(DAYS_ENTRY_PAYMENT) AS DAYS_ENTRY_PAYMENT,
              avg(AMT_INSTALMENT) AS AMT_INSTALMENT, avg(AMT_PAYMENT) AS AMT_PAYMENT,
              stddev_samp(AMT_INSTALMENT) AS INS_AMT_INSTALMENT_STD,
              avg(AMT_INSTALMENT) AS INS_AMT_INSTALMENT_MEAN,
              coalesce(sum(AMT_INSTALMENT), 0) AS INS_AMT_INSTALMENT_SUM,
              stddev_samp(AMT_PAYMENT) AS INS_AMT_PAYMENT_STD,
              avg(AMT_PAYMENT) AS INS_AMT_PAYMENT_MEAN,
              coalesce(sum(AMT_PAYMENT), 0) AS INS_AMT_PAYMENT_SUM,
              count(*) AS n_ins
       FROM i GROUP BY 1)
SELECT app.c_custkey, app.c_name, app.c_nationkey, round(app.c_acctbal, 4) AS c_acctbal,
       app.c_mktsegment,
       round(NEW_BAL_TO_NATION_RATIO, 4) AS NEW_BAL_TO_NATION_RATIO,
       round(NEW_BAL_PER_NATION, 4) AS NEW_BAL_PER_NATION,
       round(NEW_BAL_BY_SEGMENT, 4) AS NEW_BAL_BY_SEGMENT,
       round(NEW_SOURCES_PROD, 4) AS NEW_SOURCES_PROD,
       round(NEW_SOURCES_MEAN, 4) AS NEW_SOURCES_MEAN,
       round(NEW_SOURCES_STD, 4) AS NEW_SOURCES_STD,
       pa.PREV_APP_COUNT, round(pa.TOTAL_PREV_LOAN_AMT, 4) AS TOTAL_PREV_LOAN_AMT,
       round(pa.o_orderkey, 4) AS o_orderkey, round(pa.o_totalprice, 4) AS o_totalprice,
       sm.code AS o_orderstatus, pm.code AS o_orderpriority,
       round(ca.event_id, 4) AS event_id, round(ca.value, 4) AS value,
       round(ca.MONTHS_BALANCE, 4) AS MONTHS_BALANCE,
       round(ca.BUREAU_value_MEAN, 4) AS BUREAU_value_MEAN,
       round(ca.BUREAU_value_SUM, 4) AS BUREAU_value_SUM,
       cl.event_type,
       round(ba.mk, 4) AS o_orderkey_BAVG, round(ba.mp, 4) AS o_totalprice_BAVG,
       round(ba.sp, 4) AS BUREAU_o_totalprice_STD, round(ba.mp, 4) AS BUREAU_o_totalprice_MEAN,
       round(ba.tp, 4) AS BUREAU_o_totalprice_SUM,
       bl.l_orderkey, bl.l_linenumber, round(bl.l_quantity, 4) AS l_quantity, bl.l_returnflag,
       bl.l_linestatus, bl.MONTHS_BALANCE AS MONTHS_BALANCE_B_B,
       round(ca.value, 4) AS value_CAVG, cl.event_type AS event_type_CAVG,
       round(ia.o_orderkey_IAVG, 4) AS o_orderkey_IAVG,
       round(ia.DAYS_INSTALMENT, 4) AS DAYS_INSTALMENT,
       round(ia.DAYS_ENTRY_PAYMENT, 4) AS DAYS_ENTRY_PAYMENT,
       round(ia.AMT_INSTALMENT, 4) AS AMT_INSTALMENT, round(ia.AMT_PAYMENT, 4) AS AMT_PAYMENT,
       round(INS_AMT_INSTALMENT_STD, 4) AS INS_AMT_INSTALMENT_STD,
       round(INS_AMT_INSTALMENT_MEAN, 4) AS INS_AMT_INSTALMENT_MEAN,
       round(INS_AMT_INSTALMENT_SUM, 4) AS INS_AMT_INSTALMENT_SUM,
       round(INS_AMT_PAYMENT_STD, 4) AS INS_AMT_PAYMENT_STD,
       round(INS_AMT_PAYMENT_MEAN, 4) AS INS_AMT_PAYMENT_MEAN,
       round(INS_AMT_PAYMENT_SUM, 4) AS INS_AMT_PAYMENT_SUM,
       ba.n_bureau AS c_custkey_CNT_BUREAU, ca.n_events AS c_custkey_CNT_CRED_CARD,
       ca.n_events AS c_custkey_CNT_POS_CASH, ia.n_ins AS c_custkey_CNT_INSTALL
FROM app
LEFT JOIN pa ON app.c_custkey = pa.o_custkey
LEFT JOIN o_orderstatus_mode sm ON app.c_custkey = sm.o_custkey
LEFT JOIN o_orderpriority_mode pm ON app.c_custkey = pm.o_custkey
LEFT JOIN ca ON app.c_custkey = ca.user_id
LEFT JOIN cl ON app.c_custkey = cl.user_id
LEFT JOIN ba ON app.c_custkey = ba.o_custkey
LEFT JOIN bl ON ba.mk = CAST(bl.l_orderkey AS DOUBLE)
LEFT JOIN ia ON app.c_custkey = ia.o_custkey
"""


@register("wide_features", WIDE_SQL)
def wide_features(spark, d):
    return rounded(wide_features_df(spark, d))


# --- options of the wide build: latest balance per record, sentinel days cleaned first ----
@register("wide_options", f"""
WITH bb AS {S.SQL_BB}, p AS {S.SQL_PREV_CREDIT},
l AS (SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY MONTHS_BALANCE DESC, l_linenumber DESC,
          l_quantity DESC, l_returnflag DESC, l_linestatus DESC) AS rn FROM bb) WHERE rn = 1),
r AS (SELECT o_custkey, l.*, row_number() OVER (PARTITION BY o_custkey ORDER BY MONTHS_BALANCE DESC, l_orderkey DESC) AS rn
      FROM (SELECT DISTINCT o_custkey, o_orderkey FROM orders) JOIN l ON o_orderkey = l_orderkey),
pa AS (SELECT o_custkey, count(o_custkey) AS PREV_APP_COUNT, avg(DAYS_DECISION) AS DAYS_DECISION,
              avg(nullif(DAYS_FIRST_DUE, 365243)) AS DAYS_FIRST_DUE, avg(AMT_CREDIT) AS AMT_CREDIT FROM p GROUP BY 1),
ba AS (SELECT o_custkey, avg(o_orderkey) AS mk FROM orders GROUP BY 1)
SELECT c.c_custkey, nullif(c.c_nationkey, 24) AS c_nationkey, pa.PREV_APP_COUNT, round(pa.DAYS_DECISION, 4) AS DAYS_DECISION,
       round(pa.DAYS_FIRST_DUE, 4) AS DAYS_FIRST_DUE, round(pa.AMT_CREDIT, 4) AS AMT_CREDIT,
       round(ba.mk, 4) AS o_orderkey_BAVG, r.l_orderkey, r.l_linenumber, r.l_returnflag, r.MONTHS_BALANCE AS MONTHS_BALANCE_B_B
FROM customer c LEFT JOIN pa ON c.c_custkey = pa.o_custkey LEFT JOIN ba ON c.c_custkey = ba.o_custkey
LEFT JOIN r ON c.c_custkey = r.o_custkey AND r.rn = 1
""")
def wide_options(spark, d):
    """The wide build with ``bb_by_record`` and sentinels cleaned in both tables (the stand-in's application marker is nation 24, moved to the sentinel)."""
    app = S.app(spark, d).withColumn("c_nationkey", F.when(F.col("c_nationkey") == 24, F.lit(NO_DATE_SENTINEL)).otherwise(F.col("c_nationkey")))
    cfg = replace(STANDIN_CONFIG, bb_by_record=True, app_sentinels=["c_nationkey"], prev_sentinels=["DAYS_FIRST_DUE"],
                  prev_totals=STANDIN_CONFIG.prev_totals[:1])
    bal = S.balance(spark, d)
    wide = feature_engineering(app, S.bureau(spark, d), S.bureau_balance_rows(spark, d), bal, bal,
                               S.prev_with_credit(spark, d), S.instalments(spark, d), cfg)
    return rounded(wide.select("c_custkey", F.col("c_nationkey").cast("int").alias("c_nationkey"), "PREV_APP_COUNT", "DAYS_DECISION", "DAYS_FIRST_DUE",
                               "AMT_CREDIT", "o_orderkey_BAVG", "l_orderkey", "l_linenumber", "l_returnflag", "MONTHS_BALANCE_B_B"))
