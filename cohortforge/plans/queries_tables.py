"""Registered queries: the per-table blocks of the source job and their chain."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cohortforge.operators.join import chain_left_joins
from cohortforge.plans import blocks as B
from cohortforge.plans import standins as S
from cohortforge.plans.registry import register, rounded
from cohortforge.plans.sqlgen import codes_cte, spec_select
from cohortforge.session import checkpoint_dir
from cohortforge.sources.layout import join_stored, store_blocks

# --- A1 J1 A2 -----------------------------------------------------------------
ROLLUP_SPEC = {
    "o_totalprice": ["min", "max", "mean", "var", "sum"],
    "MONTHS_BALANCE_MIN": ["min"],
    "MONTHS_BALANCE_MAX": ["max"],
    "MONTHS_BALANCE_SIZE": ["mean", "sum"],
}
_ROLLUP_FULL = {**ROLLUP_SPEC, "o_orderstatus": ["mean"], "l_returnflag_MEAN": ["mean"],
                "l_linestatus_MEAN": ["mean"]}

ROLLUP_SQL = f"""
WITH bb AS {S.SQL_BB},
b AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders),
{codes_cte('rf', 'l_returnflag', 'bb')},
{codes_cte('ls', 'l_linestatus', 'bb')},
{codes_cte('os', 'o_orderstatus', 'b')},
bba AS (SELECT l_orderkey, min(MONTHS_BALANCE) AS MONTHS_BALANCE_MIN,
               max(MONTHS_BALANCE) AS MONTHS_BALANCE_MAX, count(*) AS MONTHS_BALANCE_SIZE,
               avg(rf.code) AS l_returnflag_MEAN, avg(ls.code) AS l_linestatus_MEAN
        FROM bb JOIN rf ON coalesce(bb.l_returnflag, 'NULL') = rf.v
                JOIN ls ON coalesce(bb.l_linestatus, 'NULL') = ls.v
        WHERE l_orderkey IS NOT NULL GROUP BY l_orderkey),
bj AS (SELECT b.o_custkey, b.o_totalprice, os.code AS o_orderstatus,
              bba.MONTHS_BALANCE_MIN, bba.MONTHS_BALANCE_MAX, bba.MONTHS_BALANCE_SIZE,
              bba.l_returnflag_MEAN, bba.l_linestatus_MEAN
       FROM b JOIN os ON coalesce(b.o_orderstatus, 'NULL') = os.v
       LEFT JOIN bba ON b.o_orderkey = bba.l_orderkey)
SELECT o_custkey,
       {spec_select(_ROLLUP_FULL, 'BURO_', integer_cols=('MONTHS_BALANCE_MIN', 'MONTHS_BALANCE_MAX', 'MONTHS_BALANCE_SIZE'))}
FROM bj WHERE o_custkey IS NOT NULL GROUP BY o_custkey
"""


def two_level_rollup_df(spark, d, check_size=False):
    bureau = S.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice",
                                                "o_orderstatus")
    agg, _ = B.bureau_and_balance(bureau, S.bureau_balance(spark, d), ROLLUP_SPEC,
                                  key="o_custkey", bureau_id="o_orderkey", prefix="BURO_",
                                  bb_id="l_orderkey", check_size=check_size)
    return agg


@register("two_level_rollup", ROLLUP_SQL)
def two_level_rollup(spark, d):
    return rounded(two_level_rollup_df(spark, d, check_size=True))


# --- A3 M2 F1 -----------------------------------------------------------------
PREV_SPEC = {
    "AMT_APPLICATION": ["min", "max", "mean"],
    "AMT_CREDIT": ["min", "max", "mean"],
    "APP_CREDIT_PERC": ["min", "max", "mean", "var"],
    "DAYS_DECISION": ["min", "max", "mean"],
    "DAYS_FIRST_DUE": ["min", "max", "mean"],
}
_PREV_FULL = {**PREV_SPEC, "o_orderstatus": ["mean"], "o_orderpriority": ["mean"]}

PREV_SQL = f"""
WITH p0 AS {S.SQL_PREV_CREDIT},
{codes_cte('os', 'o_orderstatus', 'p0')},
{codes_cte('op', 'o_orderpriority', 'p0')},
p AS (SELECT o_custkey, AMT_APPLICATION, AMT_CREDIT,
             CASE WHEN AMT_CREDIT = 0 THEN CASE WHEN AMT_APPLICATION > 0 THEN CAST('inf' AS DOUBLE)
                  WHEN AMT_APPLICATION < 0 THEN CAST('-inf' AS DOUBLE) END
                  ELSE AMT_APPLICATION / AMT_CREDIT END AS APP_CREDIT_PERC,
             DAYS_DECISION, nullif(DAYS_FIRST_DUE, 365243) AS DAYS_FIRST_DUE,
             os.code AS o_orderstatus, op.code AS o_orderpriority
      FROM p0 JOIN os ON coalesce(p0.o_orderstatus, 'NULL') = os.v
              JOIN op ON coalesce(p0.o_orderpriority, 'NULL') = op.v)
SELECT o_custkey,
       {spec_select(_PREV_FULL, 'PREV_', integer_cols=('DAYS_DECISION', 'DAYS_FIRST_DUE'))}
FROM p WHERE o_custkey IS NOT NULL GROUP BY o_custkey
"""


def previous_block_df(spark, d, check_size=False):
    agg, _ = B.previous_applications(S.prev_with_credit(spark, d), PREV_SPEC, key="o_custkey",
                                     sentinel_cols=["DAYS_FIRST_DUE"], check_size=check_size)
    return agg


@register("previous_block", PREV_SQL)
def previous_block(spark, d):
    return rounded(previous_block_df(spark, d, check_size=True))


# --- A4 J17 -------------------------------------------------------------------
POS_SPEC = {"MONTHS_BALANCE": ["max", "mean", "size"], "value": ["max", "mean"],
            "event_id": ["max", "mean"]}
_POS_FULL = {**POS_SPEC, "event_type": ["mean"]}

POS_SQL = f"""
WITH e AS {S.SQL_BALANCE},
{codes_cte('et', 'event_type', 'e')},
p AS (SELECT e.* EXCLUDE (event_type), et.code AS event_type
      FROM e JOIN et ON coalesce(e.event_type, 'NULL') = et.v)
SELECT user_id, {spec_select(_POS_FULL, 'POS_', integer_cols=('MONTHS_BALANCE', 'event_id'))},
       count(*) AS POS_COUNT
FROM p WHERE user_id IS NOT NULL GROUP BY user_id
"""


def pos_block_df(spark, d, check_size=False):
    agg, _ = B.pos_cash(S.balance(spark, d), POS_SPEC, key="user_id", check_size=check_size)
    return agg


@register("pos_block", POS_SQL)
def pos_block(spark, d):
    return rounded(pos_block_df(spark, d, check_size=True))


# --- A5 M3 F7 -----------------------------------------------------------------
_CLIP = "CASE WHEN ({0}) > 0 THEN ({0}) ELSE 0 END"
INS_SQL = f"""
WITH i0 AS {S.SQL_INS_V},
i AS (SELECT *, CASE WHEN AMT_INSTALMENT = 0 THEN CASE WHEN AMT_PAYMENT > 0 THEN CAST('inf' AS DOUBLE)
                     WHEN AMT_PAYMENT < 0 THEN CAST('-inf' AS DOUBLE) END
                     ELSE AMT_PAYMENT / AMT_INSTALMENT END AS PAYMENT_PERC,
             AMT_INSTALMENT - AMT_PAYMENT AS PAYMENT_DIFF,
             CAST({_CLIP.format('DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT')} AS DOUBLE) AS DPD,
             CAST({_CLIP.format('DAYS_INSTALMENT - DAYS_ENTRY_PAYMENT')} AS DOUBLE) AS DBD
      FROM i0)
SELECT o_custkey, {spec_select(B.INS_SPEC, 'INSTAL_')}, count(*) AS INSTAL_COUNT
FROM i WHERE o_custkey IS NOT NULL GROUP BY o_custkey
"""


def instalment_block_df(spark, d, check_size=False):
    agg, _ = B.installments_payments(S.instalments(spark, d, with_version=True), key="o_custkey", check_size=check_size)
    return agg


@register("instalment_block", INS_SQL)
def instalment_block(spark, d):
    return rounded(instalment_block_df(spark, d, check_size=True))


# --- A6 -----------------------------------------------------------------------
_CC_SPEC = {c: B.CC_AGGS for c in ("event_type", "value", "MONTHS_BALANCE")}
CC_SQL = f"""
WITH e AS {S.SQL_BALANCE},
{codes_cte('et', 'event_type', 'e')},
c AS (SELECT e.user_id, et.code AS event_type, e.value, e.MONTHS_BALANCE
      FROM e JOIN et ON coalesce(e.event_type, 'NULL') = et.v)
SELECT user_id, {spec_select(_CC_SPEC, 'CC_', integer_cols=('event_type', 'MONTHS_BALANCE'))},
       count(*) AS CC_COUNT
FROM c WHERE user_id IS NOT NULL GROUP BY user_id
"""


def card_block_df(spark, d, check_size=False):
    agg, _ = B.credit_card_balance(S.balance(spark, d), key="user_id", drop=("event_id",), check_size=check_size)
    return agg


@register("card_block_all", CC_SQL)
def card_block_all(spark, d):
    return rounded(card_block_df(spark, d, check_size=True))


# --- J18 ----------------------------------------------------------------------
def _strip_key(sql: str, key: str, alias: str) -> str:
    return f"(SELECT * EXCLUDE ({key}), {key} AS __k_{alias} FROM ({sql.strip()}))"


CHAIN_SQL = f"""
SELECT c.c_custkey, round(c.c_acctbal, 4) AS c_acctbal,
       b1.* EXCLUDE (__k_b1), b2.* EXCLUDE (__k_b2), b3.* EXCLUDE (__k_b3),
       b4.* EXCLUDE (__k_b4), b5.* EXCLUDE (__k_b5)
FROM customer c
LEFT JOIN {_strip_key(ROLLUP_SQL, 'o_custkey', 'b1')} b1 ON c.c_custkey = b1.__k_b1
LEFT JOIN {_strip_key(PREV_SQL, 'o_custkey', 'b2')} b2 ON c.c_custkey = b2.__k_b2
LEFT JOIN {_strip_key(POS_SQL, 'user_id', 'b3')} b3 ON c.c_custkey = b3.__k_b3
LEFT JOIN {_strip_key(INS_SQL, 'o_custkey', 'b4')} b4 ON c.c_custkey = b4.__k_b4
LEFT JOIN {_strip_key(CC_SQL, 'user_id', 'b5')} b5 ON c.c_custkey = b5.__k_b5
"""


def _chain_tables(spark, d, check_size=False):
    base = S.app(spark, d).select("c_custkey", "c_acctbal")
    blocks = [two_level_rollup_df(spark, d, check_size).withColumnRenamed("o_custkey", "c_custkey"),
              previous_block_df(spark, d, check_size).withColumnRenamed("o_custkey", "c_custkey"),
              pos_block_df(spark, d, check_size).withColumnRenamed("user_id", "c_custkey"),
              instalment_block_df(spark, d, check_size).withColumnRenamed("o_custkey", "c_custkey"),
              card_block_df(spark, d, check_size).withColumnRenamed("user_id", "c_custkey")]
    return base, blocks


@register("feature_blocks_chain", CHAIN_SQL)
def feature_blocks_chain(spark, d):
    return rounded(chain_left_joins(*_chain_tables(spark, d), "c_custkey"))


# --- S3 S4 J18, co-partitioned -----------------------------------------------------
@register("stored_blocks_chain", CHAIN_SQL)
def stored_blocks_chain(spark, d):
    """The application table and its blocks stored in buckets on the key, read back and joined without an exchange."""
    base, blocks = _chain_tables(spark, d, check_size=True)
    folder = f"{checkpoint_dir(spark)}/blocks-{uuid.uuid4().hex}"
    names = ["bureau", "previous", "pos", "instalments", "card"]
    store_blocks({"application": base, **dict(zip(names, blocks))}, folder, "c_custkey", int(spark.conf.get("spark.sql.shuffle.partitions")))
    return rounded(join_stored(spark, folder, "application", names, "c_custkey"))


# --- E10 (U1 F1 M1-M8 J16 W3 P2 E4) ---------------------------------------------
def _application_standin(spark, d):
    c = S.table(spark, d, "customer")
    col = F.col
    base = c.select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment",
        F.when(col("c_acctbal") > 0, "Y").otherwise("N").alias("FLAG_OWN_CAR"),
        (col("c_nationkey") < 10).cast("int").alias("FLAG_DOC_A"),
        (col("c_acctbal") < 0).cast("int").alias("FLAG_DOC_B"),
        (col("c_mktsegment") == "BUILDING").cast("int").alias("FLAG_DOC_C"),
        (col("c_acctbal") > 5000).cast("int").alias("FLAG_DOC_D"),
        (col("c_nationkey") > 20).cast("int").alias("FLAG_PHONE"))
    train = (base.filter(col("c_mktsegment") != "MACHINERY")
                 .withColumn("TARGET", (col("c_acctbal") > 5000).cast("int")))
    test = base.filter(col("c_mktsegment") == "MACHINERY")
    return train, test


APP_CONFIG_FEATURES = [
    ("ratio", "NEW_BAL_TO_NATION_RATIO", "c_acctbal", "c_nationkey"),
    ("kurtosis", "NEW_DOC_IND_KURT", "docs"),
    ("sum", "NEW_LIVE_IND_SUM", "live"),
    ("group_median", "NEW_BAL_BY_SEGMENT", "c_acctbal", "c_mktsegment"),
]


def application_block_df(spark, d):
    from cohortforge.plans.features import FeatureConfig
    train, test = _application_standin(spark, d)
    cfg = FeatureConfig(key="c_custkey", app_features=APP_CONFIG_FEATURES, score_cols=[])
    df, cats = B.application_train_test(train, test, cfg, key="c_custkey", sentinel_col=None,
                                        binary=["FLAG_OWN_CAR"], drop=["FLAG_DOC_A"])
    return df, cats


def _app_sql():
    from cohortforge.plans.queries_rows import _kurt_sql
    flags = ["FLAG_DOC_A", "FLAG_DOC_B", "FLAG_DOC_C", "FLAG_DOC_D"]
    cats = ["c_name", "c_mktsegment", "FLAG_OWN_CAR", "FLAG_DOC_B", "FLAG_DOC_C", "FLAG_DOC_D",
            "FLAG_PHONE", "NEW_LIVE_IND_SUM"]
    codes = ",\n".join(
        f"k_{c} AS (SELECT v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS INTEGER) AS code "
        f"FROM (SELECT DISTINCT coalesce(CAST({c} AS VARCHAR), 'nan') AS v FROM fz))" for c in cats)
    joins = "\n".join(f"JOIN k_{c} ON coalesce(CAST(fz.{c} AS VARCHAR), 'nan') = k_{c}.v"
                      for c in cats)
    return f"""
WITH a AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
         CASE WHEN c_acctbal > 0 THEN 'Y' ELSE 'N' END AS FLAG_OWN_CAR,
         CAST(c_nationkey < 10 AS INTEGER) AS FLAG_DOC_A, CAST(c_acctbal < 0 AS INTEGER) AS FLAG_DOC_B,
         CAST(c_mktsegment = 'BUILDING' AS INTEGER) AS FLAG_DOC_C,
         CAST(c_acctbal > 5000 AS INTEGER) AS FLAG_DOC_D, CAST(c_nationkey > 20 AS INTEGER) AS FLAG_PHONE,
         CASE WHEN c_mktsegment <> 'MACHINERY' THEN CAST(c_acctbal > 5000 AS INTEGER) END AS TARGET,
         c_mktsegment <> 'MACHINERY' AS is_train
  FROM customer),
med AS (SELECT c_mktsegment, median(c_acctbal) AS med FROM a WHERE c_mktsegment IS NOT NULL GROUP BY 1),
f AS (SELECT a.*,
        CASE WHEN c_nationkey = 0 THEN CASE WHEN c_acctbal > 0 THEN CAST('inf' AS DOUBLE)
             WHEN c_acctbal < 0 THEN CAST('-inf' AS DOUBLE) END
             ELSE c_acctbal / c_nationkey END AS NEW_BAL_TO_NATION_RATIO,
        {_kurt_sql(flags)} AS NEW_DOC_IND_KURT,
        CAST(coalesce(FLAG_PHONE, 0) AS DOUBLE) AS NEW_LIVE_IND_SUM,
        med.med AS NEW_BAL_BY_SEGMENT
      FROM a LEFT JOIN med ON a.c_mktsegment = med.c_mktsegment),
fc AS (SELECT v, CAST(dense_rank() OVER (ORDER BY o, k, v) - 1 AS INTEGER) AS code FROM (
         SELECT FLAG_OWN_CAR AS v, min(struct_pack(o := CASE WHEN is_train THEN 0 ELSE 1 END,
                                                   k := c_custkey)) AS s
         FROM f WHERE FLAG_OWN_CAR IS NOT NULL GROUP BY 1), LATERAL (SELECT s.o AS o, s.k AS k)),
fz AS (SELECT f.* EXCLUDE (FLAG_OWN_CAR, FLAG_DOC_A), coalesce(fc.code, -1) AS FLAG_OWN_CAR
       FROM f LEFT JOIN fc ON f.FLAG_OWN_CAR = fc.v),
{codes}
SELECT fz.c_custkey, fz.c_nationkey, round(fz.c_acctbal, 4) AS c_acctbal, fz.TARGET, fz.is_train,
       round(fz.NEW_BAL_TO_NATION_RATIO, 4) AS NEW_BAL_TO_NATION_RATIO,
       round(fz.NEW_DOC_IND_KURT, 4) AS NEW_DOC_IND_KURT,
       round(fz.NEW_BAL_BY_SEGMENT, 4) AS NEW_BAL_BY_SEGMENT,
       {', '.join(f'k_{c}.code AS {c}' for c in cats)}
FROM fz
{joins}
"""


@register("application_block", _app_sql())
def application_block(spark, d):
    df, _ = application_block_df(spark, d)
    return rounded(df)
