"""Registered queries: aggregate blocks and their joins, on the stand-in tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortforge.functions.semantics import psum
from cohortforge.operators.aggregate import (
    agg_spec, group_by_key, latest_by, mean_all, value_counts, weighted_mean,
)
from cohortforge.operators.encode import mode_codes
from cohortforge.operators.join import left_join_suffix
from cohortforge.plans import standins as S
from cohortforge.plans.features import latest_of_records
from cohortforge.plans.registry import register, rounded

R = "round({0}, 4) AS {0}"


def _r(*cols):
    return ", ".join(R.format(c) for c in cols)


# --- A7 J2 P8 ---------------------------------------------------------------
@register("prev_totals", f"""
SELECT c.c_custkey, {_r('c.c_acctbal')}, t.PREV_APP_COUNT,
       round(t.TOTAL_PREV_LOAN_AMT, 4) AS TOTAL_PREV_LOAN_AMT,
       round(t.TOTAL_PREV_F_AMT, 4) AS TOTAL_PREV_F_AMT
FROM customer c LEFT JOIN (
  SELECT o_custkey, count(o_custkey) AS PREV_APP_COUNT,
         coalesce(sum(o_totalprice), 0) AS TOTAL_PREV_LOAN_AMT,
         coalesce(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END), 0) AS TOTAL_PREV_F_AMT
  FROM orders GROUP BY o_custkey) t ON c.c_custkey = t.o_custkey
""".replace("round(c.c_acctbal, 4) AS c.c_acctbal", "round(c.c_acctbal, 4) AS c_acctbal"))
def prev_totals(spark, d):
    a = S.app(spark, d).select("c_custkey", "c_acctbal")
    p = S.prev(spark, d)
    tot = group_by_key(p, "o_custkey", [
        F.count("o_custkey").alias("PREV_APP_COUNT"),
        psum("o_totalprice").alias("TOTAL_PREV_LOAN_AMT"),
        psum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))).alias("TOTAL_PREV_F_AMT"),
    ])
    return rounded(left_join_suffix(a, tot, "c_custkey", "o_custkey"))


# --- A8 J3 P9 ---------------------------------------------------------------
@register("prev_means_suffix", f"""
WITH p AS {S.SQL_PREV},
f AS (SELECT o_custkey, avg(o_orderkey) AS mk, avg(o_totalprice) AS mp FROM p GROUP BY o_custkey),
o AS (SELECT o_custkey, avg(o_orderkey) AS mk, avg(o_totalprice) AS mp FROM orders GROUP BY o_custkey)
SELECT c.c_custkey, c.c_name, c.c_nationkey, round(c.c_acctbal, 4) AS c_acctbal, c.c_mktsegment,
       round(f.mk, 4) AS o_orderkey, round(f.mp, 4) AS o_totalprice,
       round(o.mk, 4) AS o_orderkey_BAVG, round(o.mp, 4) AS o_totalprice_BAVG
FROM customer c LEFT JOIN f ON c.c_custkey = f.o_custkey LEFT JOIN o ON c.c_custkey = o.o_custkey
""")
def prev_means_suffix(spark, d):
    a = S.app(spark, d)
    p = S.prev(spark, d)
    b = S.bureau(spark, d)
    f = group_by_key(p, "o_custkey", mean_all(p, "o_custkey"))
    o = group_by_key(b, "o_custkey", mean_all(b, "o_custkey"))
    out = left_join_suffix(a, f, "c_custkey", "o_custkey", "_PAVG")
    out = left_join_suffix(out, o, "c_custkey", "o_custkey", "_BAVG")
    return rounded(out)


# --- A9 J4 E1 ---------------------------------------------------------------
_MODE_SQL = """
{name}_codes AS (
  SELECT v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS VARCHAR) AS code
  FROM (SELECT DISTINCT coalesce({name}, 'NULL') AS v FROM p)),
{name}_mode AS (
  SELECT o_custkey, v FROM (
    SELECT o_custkey, v, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, v ASC) AS rn
    FROM (SELECT o_custkey, coalesce({name}, 'NULL') AS v, count(*) AS n FROM p GROUP BY 1, 2))
  WHERE rn = 1)"""


@register("prev_mode", f"""
WITH p AS {S.SQL_PREV},
{_MODE_SQL.format(name='o_orderstatus')},
{_MODE_SQL.format(name='o_orderpriority')}
SELECT c.c_custkey, round(c.c_acctbal, 4) AS c_acctbal,
       sc.code AS o_orderstatus, pc.code AS o_orderpriority
FROM customer c
LEFT JOIN o_orderstatus_mode sm ON c.c_custkey = sm.o_custkey
LEFT JOIN o_orderstatus_codes sc ON sm.v = sc.v
LEFT JOIN o_orderpriority_mode pm ON c.c_custkey = pm.o_custkey
LEFT JOIN o_orderpriority_codes pc ON pm.v = pc.v
""")
def prev_mode(spark, d):
    a = S.app(spark, d).select("c_custkey", "c_acctbal")
    m = mode_codes(S.prev(spark, d), "o_custkey", ["o_orderstatus", "o_orderpriority"])
    return rounded(left_join_suffix(a, m, "c_custkey", "o_custkey", "_BAVG"))


# --- A10 M10 J5 J11 -----------------------------------------------------------
_WM = ("CASE WHEN count({x}) = count(*) AND count(MONTHS_BALANCE) = count(*) "
       "AND min(abs(MONTHS_BALANCE)) > 0 THEN sum({x} * (-1.0 / MONTHS_BALANCE)) "
       "/ sum(-1.0 / MONTHS_BALANCE) END")


@register("weighted_recency", f"""
WITH e AS (SELECT *, CASE WHEN event_type <> 'error' THEN value END AS value_ok
           FROM {S.SQL_BALANCE}),
cc AS (SELECT user_id, {_WM.format(x='event_id')} AS event_id, {_WM.format(x='value')} AS value,
              {_WM.format(x='MONTHS_BALANCE')} AS MONTHS_BALANCE,
              {_WM.format(x='value_ok')} AS value_ok
       FROM e GROUP BY user_id),
pos AS (SELECT user_id, {_WM.format(x='value')} AS value FROM e GROUP BY user_id)
SELECT c.c_custkey, round(c.c_acctbal, 4) AS c_acctbal,
       round(cc.event_id, 4) AS event_id, round(cc.value, 4) AS value,
       round(cc.MONTHS_BALANCE, 4) AS MONTHS_BALANCE, round(cc.value_ok, 4) AS value_ok,
       round(pos.value, 4) AS value_CAVG
FROM customer c LEFT JOIN cc ON c.c_custkey = cc.user_id LEFT JOIN pos ON c.c_custkey = pos.user_id
""")
def weighted_recency(spark, d):
    a = S.app(spark, d).select("c_custkey", "c_acctbal")
    e = S.balance(spark, d).withColumn(
        "value_ok", F.when(F.col("event_type") != "error", F.col("value")))
    cc = group_by_key(e, "user_id", [weighted_mean(x, "MONTHS_BALANCE").alias(x)
                                     for x in ("event_id", "value", "MONTHS_BALANCE", "value_ok")])
    pos = group_by_key(e, "user_id", [weighted_mean("value", "MONTHS_BALANCE").alias("value")])
    out = left_join_suffix(a, cc, "c_custkey", "user_id", "_CCAVG")
    out = left_join_suffix(out, pos, "c_custkey", "user_id", "_CAVG")
    return rounded(out)


# --- A11 J6 -------------------------------------------------------------------
@register("card_mean_sum", f"""
SELECT c.c_custkey, round(c.c_acctbal, 4) AS c_acctbal,
       round(b.BUREAU_value_MEAN, 4) AS BUREAU_value_MEAN,
       round(b.BUREAU_value_SUM, 4) AS BUREAU_value_SUM,
       round(b.BUREAU_event_id_MEAN, 4) AS BUREAU_event_id_MEAN, b.BUREAU_event_id_SUM
FROM customer c LEFT JOIN (
  SELECT user_id, avg(value) AS BUREAU_value_MEAN, coalesce(sum(value), 0) AS BUREAU_value_SUM,
         avg(event_id) AS BUREAU_event_id_MEAN,
         CAST(coalesce(sum(event_id), 0) AS BIGINT) AS BUREAU_event_id_SUM
  FROM events GROUP BY user_id) b ON c.c_custkey = b.user_id
""")
def card_mean_sum(spark, d):
    a = S.app(spark, d).select("c_custkey", "c_acctbal")
    e = S.balance(spark, d)
    b = group_by_key(e, "user_id", agg_spec({"value": ["mean", "sum"],
                                             "event_id": ["mean", "sum"]}, "BUREAU_"))
    return rounded(left_join_suffix(a, b, "c_custkey", "user_id"))


# --- A12 J8 J9 ----------------------------------------------------------------
@register("bureau_std_block", f"""
WITH b AS {S.SQL_BUREAU},
m AS (SELECT o_custkey, avg(o_orderkey) AS o_orderkey, avg(o_totalprice) AS o_totalprice,
             stddev_samp(o_totalprice) AS sp, avg(o_totalprice) AS mp,
             coalesce(sum(o_totalprice), 0) AS tp,
             stddev_samp(o_orderkey) AS sk, avg(o_orderkey) AS mk,
             CAST(coalesce(sum(o_orderkey), 0) AS BIGINT) AS tk
      FROM b GROUP BY o_custkey)
SELECT c.c_custkey, round(c.c_acctbal, 4) AS c_acctbal,
       round(m.o_orderkey, 4) AS o_orderkey, round(m.o_totalprice, 4) AS o_totalprice,
       round(m.sp, 4) AS BUREAU_o_totalprice_STD, round(m.mp, 4) AS BUREAU_o_totalprice_MEAN,
       round(m.tp, 4) AS BUREAU_o_totalprice_SUM, round(m.sk, 4) AS BUREAU_o_orderkey_STD,
       round(m.mk, 4) AS BUREAU_o_orderkey_MEAN, m.tk AS BUREAU_o_orderkey_SUM
FROM customer c LEFT JOIN m ON c.c_custkey = m.o_custkey
""")
def bureau_std_block(spark, d):
    a = S.app(spark, d).select("c_custkey", "c_acctbal")
    b = S.bureau(spark, d)
    means = group_by_key(b, "o_custkey", mean_all(b, "o_custkey"))
    std = group_by_key(b, "o_custkey", agg_spec({"o_totalprice": ["std", "mean", "sum"],
                                                 "o_orderkey": ["std", "mean", "sum"]}, "BUREAU_"))
    out = left_join_suffix(a, means, "c_custkey", "o_custkey", "_BAVG")
    return rounded(left_join_suffix(out, std, "c_custkey", "o_custkey"))


# --- A13 J13 J14 --------------------------------------------------------------
_INS_STD = ["DAYS_INSTALMENT", "DAYS_ENTRY_PAYMENT", "AMT_INSTALMENT", "AMT_PAYMENT"]


def _ins_std_sql():
    parts = []
    for c in _INS_STD:
        parts += [f"stddev_samp({c}) AS INS_{c}_STD", f"avg({c}) AS INS_{c}_MEAN",
                  f"coalesce(sum({c}), 0) AS INS_{c}_SUM"]
    return ", ".join(parts)


_INS_STD_OUT = [f"INS_{c}_{a}" for c in _INS_STD for a in ("STD", "MEAN", "SUM")]


@register("instalment_std_block", f"""
WITH i AS {S.SQL_INS},
m AS (SELECT o_custkey, avg(o_orderkey) AS o_orderkey, {', '.join(f'avg({c}) AS {c}' for c in _INS_STD)},
             {_ins_std_sql()}
      FROM i GROUP BY o_custkey)
SELECT c.c_custkey, round(c.c_acctbal, 4) AS c_acctbal,
       {_r(*(['o_orderkey'] + _INS_STD + _INS_STD_OUT))}
FROM customer c LEFT JOIN m ON c.c_custkey = m.o_custkey
""")
def instalment_std_block(spark, d):
    a = S.app(spark, d).select("c_custkey", "c_acctbal")
    i = S.instalments(spark, d)
    means = group_by_key(i, "o_custkey", mean_all(i, "o_custkey"))
    std = group_by_key(i, "o_custkey", agg_spec({c: ["std", "mean", "sum"] for c in _INS_STD}, "INS_"))
    out = left_join_suffix(a, means, "c_custkey", "o_custkey", "_IAVG")
    return rounded(left_join_suffix(out, std, "c_custkey", "o_custkey"))


# --- W1 J7 J12 ----------------------------------------------------------------
@register("latest_category", f"""
WITH e AS {S.SQL_BALANCE},
l AS (SELECT user_id, event_type FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY MONTHS_BALANCE DESC,
               event_id DESC NULLS LAST, event_type DESC NULLS LAST, value DESC NULLS LAST) AS rn
        FROM e) WHERE rn = 1),
v AS (SELECT user_id, event_type FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC,
               event_id DESC NULLS LAST, event_type DESC NULLS LAST,
               MONTHS_BALANCE DESC NULLS LAST) AS rn
        FROM e) WHERE rn = 1)
SELECT c.c_custkey, round(c.c_acctbal, 4) AS c_acctbal, l.event_type, v.event_type AS event_type_CAVG
FROM customer c LEFT JOIN l ON c.c_custkey = l.user_id LEFT JOIN v ON c.c_custkey = v.user_id
""")
def latest_category(spark, d):
    a = S.app(spark, d).select("c_custkey", "c_acctbal")
    e = S.balance(spark, d)
    by_month = latest_by(e, "user_id", "MONTHS_BALANCE", ["event_type"], row_id="event_id")
    by_value = latest_by(e, "user_id", "value", ["event_type"], row_id="event_id")
    out = left_join_suffix(a, by_month, "c_custkey", "user_id", "_CCAVG")
    return rounded(left_join_suffix(out, by_value, "c_custkey", "user_id", "_CAVG"))


# --- J10 ----------------------------------------------------------------------
_BB_COLS = ["l_linenumber", "l_quantity", "l_returnflag", "l_linestatus", "MONTHS_BALANCE"]


@register("latest_on_mean_key", f"""
WITH bb AS {S.SQL_BB},
m AS (SELECT o_custkey, avg(o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey),
l AS (SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY MONTHS_BALANCE DESC,
          {', '.join(c + ' DESC NULLS LAST' for c in _BB_COLS)}) AS rn FROM bb) WHERE rn = 1)
SELECT c.c_custkey, round(m.o_orderkey, 4) AS o_orderkey, l.l_orderkey, l.l_linenumber,
       round(l.l_quantity, 4) AS l_quantity, l.l_returnflag, l.l_linestatus, l.MONTHS_BALANCE
FROM customer c LEFT JOIN m ON c.c_custkey = m.o_custkey
LEFT JOIN l ON m.o_orderkey = CAST(l.l_orderkey AS DOUBLE)
""")
def latest_on_mean_key(spark, d):
    a = S.app(spark, d).select("c_custkey")
    o = S.bureau(spark, d)
    m = group_by_key(o, "o_custkey", [F.avg("o_orderkey").alias("o_orderkey")])
    bb = S.bureau_balance_rows(spark, d)
    ids = m.filter("o_orderkey = floor(o_orderkey)").select(F.col("o_orderkey").cast("long").alias("__id")).distinct()
    bb = bb.join(ids, F.col("l_orderkey") == F.col("__id"), "left_semi")
    latest = latest_by(bb, "l_orderkey", "MONTHS_BALANCE", _BB_COLS, row_id="__row")
    latest = latest.withColumn("__k", F.col("l_orderkey").cast("double"))
    m = left_join_suffix(m, latest, "o_orderkey", "__k", "_B_B")
    return rounded(left_join_suffix(a, m, "c_custkey", "o_custkey"))


# --- J10 per record -----------------------------------------------------------
@register("latest_of_records", f"""
WITH bb AS {S.SQL_BB},
l AS (SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY MONTHS_BALANCE DESC, l_linenumber DESC,
          l_quantity DESC, l_returnflag DESC, l_linestatus DESC) AS rn FROM bb) WHERE rn = 1),
r AS (SELECT o_custkey, l.*, row_number() OVER (PARTITION BY o_custkey ORDER BY MONTHS_BALANCE DESC, l_orderkey DESC) AS rn
      FROM (SELECT DISTINCT o_custkey, o_orderkey FROM orders) JOIN l ON o_orderkey = l_orderkey)
SELECT c.c_custkey, r.l_orderkey, r.l_linenumber, round(r.l_quantity, 4) AS l_quantity, r.l_returnflag, r.l_linestatus, r.MONTHS_BALANCE
FROM customer c LEFT JOIN r ON c.c_custkey = r.o_custkey AND r.rn = 1
""")
def latest_of_records_q(spark, d):
    latest = latest_of_records(S.bureau(spark, d), S.bureau_balance_rows(spark, d), "o_custkey", "o_orderkey", "l_orderkey",
                               "MONTHS_BALANCE", "__row")
    return rounded(left_join_suffix(S.app(spark, d).select("c_custkey"), latest, "c_custkey", "o_custkey"))


# --- A15 J15 ------------------------------------------------------------------
@register("child_counts", f"""
SELECT c.c_custkey, b.n AS c_custkey_CNT_BUREAU, e.n AS c_custkey_CNT_CRED_CARD,
       e.n AS c_custkey_CNT_POS_CASH, i.n AS c_custkey_CNT_INSTALL
FROM customer c
LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) b ON c.c_custkey = b.o_custkey
LEFT JOIN (SELECT user_id, count(*) AS n FROM events GROUP BY 1) e ON c.c_custkey = e.user_id
LEFT JOIN (SELECT o_custkey, count(*) AS n FROM {S.SQL_INS} GROUP BY 1) i
  ON c.c_custkey = i.o_custkey
""")
def child_counts(spark, d):
    out = S.app(spark, d).select("c_custkey")
    for child, key, suffix in ((S.bureau(spark, d), "o_custkey", "_CNT_BUREAU"),
                               (S.balance(spark, d), "user_id", "_CNT_CRED_CARD"),
                               (S.balance(spark, d), "user_id", "_CNT_POS_CASH"),
                               (S.instalments(spark, d), "o_custkey", "_CNT_INSTALL")):
        out = left_join_suffix(out, value_counts(child, key, "c_custkey"), "c_custkey", key, suffix)
    return out
