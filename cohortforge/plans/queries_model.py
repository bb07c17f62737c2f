"""Registered queries: encoders, profiles, splits, folds, metrics and scoring."""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cohortforge.operators import encode as E
from cohortforge.operators import profile as P
from cohortforge.operators.folds import hash32, hash_folds, stratified_folds
from cohortforge.operators.bayes import out_of_fold, predicted_class
from cohortforge.operators.metrics import auc_exact, categorical_losses, losses
from cohortforge.operators.aggregate import latest_by
from cohortforge.operators.model import ensemble_mean, feature_stages, fit_folds, make_classifier, probability_of_one, score_folds
from cohortforge.operators.stages import CategoryEncoder, ColumnScaler
from cohortforge.plans import standins as S
from cohortforge.session import checkpoint_dir
from cohortforge.plans.registry import ORACLE, register, rounded
from cohortforge.sources.io import output_dir, read_table, sample_scan, write_submission, write_table
from cohortforge.sources.layout import write_bucketed

# --- E1 F5 J19 E6 -------------------------------------------------------------
@register("label_encode", f"""
WITH p AS {S.SQL_PREV},
s AS (SELECT v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS INTEGER) AS code
      FROM (SELECT DISTINCT coalesce(o_orderstatus, 'NULL') AS v FROM p)),
q AS (SELECT v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS INTEGER) AS code
      FROM (SELECT DISTINCT coalesce(o_orderpriority, 'NULL') AS v FROM p))
SELECT p.o_orderkey, p.o_custkey, s.code AS o_orderstatus, round(p.o_totalprice, 4) AS o_totalprice,
       q.code AS o_orderpriority
FROM p JOIN s ON coalesce(p.o_orderstatus, 'NULL') = s.v
       JOIN q ON coalesce(p.o_orderpriority, 'NULL') = q.v
""")
def label_encode_q(spark, d):
    out, _, _ = E.label_encode(S.prev(spark, d))
    return rounded(out)


# --- E2 E3 M9 -----------------------------------------------------------------
_TEXT_COLS = ["l_quantity", "l_linenumber", "l_returnflag"]


@register("label_encode_text", """
WITH li AS (SELECT l_orderkey, l_quantity, l_linenumber, nullif(l_returnflag, 'N') AS l_returnflag
            FROM lineitem),
a AS (SELECT v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS INTEGER) AS code
      FROM (SELECT DISTINCT coalesce(CAST(l_quantity AS VARCHAR), 'nan') AS v FROM li)),
b AS (SELECT v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS INTEGER) AS code
      FROM (SELECT DISTINCT coalesce(CAST(l_linenumber AS VARCHAR), 'nan') AS v FROM li)),
c AS (SELECT v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS INTEGER) AS code
      FROM (SELECT DISTINCT coalesce(l_returnflag, 'nan') AS v FROM li))
SELECT li.l_orderkey, a.code AS l_quantity, b.code AS l_linenumber, c.code AS l_returnflag
FROM li JOIN a ON coalesce(CAST(li.l_quantity AS VARCHAR), 'nan') = a.v
        JOIN b ON coalesce(CAST(li.l_linenumber AS VARCHAR), 'nan') = b.v
        JOIN c ON coalesce(li.l_returnflag, 'nan') = c.v
""")
def label_encode_text(spark, d):
    li = S.table(spark, d, "lineitem").select(
        "l_orderkey", "l_quantity", "l_linenumber",
        F.nullif(F.col("l_returnflag"), F.lit("N")).alias("l_returnflag"))
    out, _, _ = E.label_encode(li, _TEXT_COLS, missing=E.NAN_TOKEN, as_string=True)
    return out


# --- E4 P5 --------------------------------------------------------------------
@register("label_encode_two_valued", """
WITH li AS (SELECT l_orderkey, l_returnflag, l_linestatus,
                   CAST(l_discount > 0.05 AS INTEGER) AS is_disc,
                   CAST(nullif(l_tax, 0) > 0.04 AS INTEGER) AS tax_hi
            FROM lineitem),
a AS (SELECT v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS INTEGER) AS code
      FROM (SELECT DISTINCT coalesce(l_returnflag, 'nan') AS v FROM li)),
b AS (SELECT v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS INTEGER) AS code
      FROM (SELECT DISTINCT coalesce(l_linestatus, 'nan') AS v FROM li)),
c AS (SELECT v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS INTEGER) AS code
      FROM (SELECT DISTINCT coalesce(CAST(is_disc AS VARCHAR), 'nan') AS v FROM li))
SELECT li.l_orderkey, a.code AS l_returnflag, b.code AS l_linestatus, c.code AS is_disc, li.tax_hi
FROM li JOIN a ON coalesce(li.l_returnflag, 'nan') = a.v
        JOIN b ON coalesce(li.l_linestatus, 'nan') = b.v
        JOIN c ON coalesce(CAST(li.is_disc AS VARCHAR), 'nan') = c.v
""")
def label_encode_two_valued(spark, d):
    c = F.col
    li = S.table(spark, d, "lineitem").select(
        "l_orderkey", "l_returnflag", "l_linestatus",
        (c("l_discount") > 0.05).cast("int").alias("is_disc"),
        (F.nullif(c("l_tax"), F.lit(0)) > 0.04).cast("int").alias("tax_hi"))
    out, _, _ = E.encode_string_or_two_valued(li)
    return out


# --- W3 -----------------------------------------------------------------------
@register("label_encode_saved", """
WITH codes AS (SELECT c_name AS v, CAST(row_number() OVER (ORDER BY c_name) - 1 AS INTEGER) AS code
               FROM (SELECT DISTINCT c_name FROM customer WHERE c_custkey % 3 <> 0))
SELECT c.c_custkey, codes.code AS c_name FROM customer c LEFT JOIN codes ON c.c_name = codes.v
""")
def label_encode_saved(spark, d):
    """A dictionary of one value per row, saved, read back and applied to rows with values that it never saw."""
    c = S.app(spark, d).select("c_custkey", "c_name")
    path = f"{checkpoint_dir(spark)}/codes-{uuid.uuid4().hex}"
    E.save_codes(E.code_table(c.filter(F.col("c_custkey") % 3 != 0), ["c_name"]), path)
    return E.apply_codes(c, E.load_codes(spark, path), ["c_name"])


def _first_seen_sql(col):
    return (f"(SELECT v, CAST(dense_rank() OVER (ORDER BY first_key, v) - 1 AS INTEGER) AS code "
            f"FROM (SELECT {col} AS v, min(o_orderkey) AS first_key FROM p "
            f"WHERE {col} IS NOT NULL GROUP BY 1))")


@register("factorize_first_seen", f"""
WITH p AS {S.SQL_PREV}
SELECT p.o_orderkey, p.o_custkey, coalesce(s.code, -1) AS o_orderstatus,
       round(p.o_totalprice, 4) AS o_totalprice, coalesce(q.code, -1) AS o_orderpriority
FROM p LEFT JOIN {_first_seen_sql('o_orderstatus')} s ON p.o_orderstatus = s.v
       LEFT JOIN {_first_seen_sql('o_orderpriority')} q ON p.o_orderpriority = q.v
""")
def factorize_first_seen(spark, d):
    out = E.factorize(S.prev(spark, d), ["o_orderstatus", "o_orderpriority"], ["o_orderkey"])
    return rounded(out)


# --- E5 E8 --------------------------------------------------------------------
_PRI = ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]


@register("one_hot", f"""
WITH p AS {S.SQL_PREV}
SELECT o_orderkey, o_custkey, round(o_totalprice, 4) AS o_totalprice,
       {', '.join(f'CAST(o_orderstatus = {v!r} AS INTEGER) AS "o_orderstatus_{v}"' for v in 'FOP')},
       CAST(o_orderstatus IS NULL AS INTEGER) AS o_orderstatus_nan,
       {', '.join(f'CAST(coalesce(o_orderpriority = {v!r}, false) AS INTEGER) AS "o_orderpriority_{v}"' for v in _PRI)},
       CAST(o_orderpriority IS NULL AS INTEGER) AS o_orderpriority_nan
FROM p
""")
def one_hot_q(spark, d):
    out, _ = E.one_hot(S.prev(spark, d), ["o_orderstatus", "o_orderpriority"])
    return rounded(out)


@register("one_hot_long", f"""
WITH p AS {S.SQL_PREV},
w AS (SELECT o_orderkey, 'day' AS "column", 'day_' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS feature FROM orders)
SELECT w.o_orderkey, w."column", w.feature, CAST(coalesce(o_orderpriority = '1-URGENT', false) AS INTEGER) AS urgent,
       CAST(o_orderpriority IS NULL AS INTEGER) AS missing
FROM w JOIN p ON w.o_orderkey = p.o_orderkey
""")
def one_hot_long_q(spark, d):
    """Priorities as columns, days (more values than the limit) as long rows, met on the key again."""
    days = S.table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").cast("string").alias("day"),
                                              F.nullif("o_orderpriority", F.lit(S.MISSING_PRIORITY)).alias("o_orderpriority"))
    wide, _, long = E.one_hot_split(days, ["o_orderkey"], max_values=5)
    return long.join(wide, "o_orderkey").select("o_orderkey", "column", "feature", F.col("o_orderpriority_1-URGENT").alias("urgent"),
                                                F.col("o_orderpriority_nan").alias("missing"))


# --- F8 F9 F3 F2 --------------------------------------------------------------
def _profile_frame(spark, d):
    """customer with card and order blocks joined on: many missing values."""
    from cohortforge.operators.aggregate import agg_spec, group_by_key
    from cohortforge.operators.join import left_join_suffix
    from cohortforge.functions.semantics import ratio
    a = S.app(spark, d).select("c_custkey", "c_nationkey", "c_acctbal")
    a = a.withColumn("bal_per_nation", ratio("c_acctbal", "c_nationkey"))
    ev = group_by_key(S.balance(spark, d), "user_id",
                      agg_spec({"value": ["mean", "sum", "var"]}, "BUREAU_"))
    od = group_by_key(S.prev(spark, d), "o_custkey",
                      agg_spec({"o_totalprice": ["mean", "var"]}, "PREV_"))
    out = left_join_suffix(a, ev, "c_custkey", "user_id")
    return left_join_suffix(out, od, "c_custkey", "o_custkey")


_PROFILE_CTE = f"""
WITH a AS (SELECT c_custkey, c_nationkey, c_acctbal,
                  CASE WHEN c_nationkey = 0 THEN CASE WHEN c_acctbal > 0 THEN CAST('inf' AS DOUBLE)
                       WHEN c_acctbal < 0 THEN CAST('-inf' AS DOUBLE) END
                       ELSE c_acctbal / c_nationkey END AS bal_per_nation FROM customer),
ev AS (SELECT user_id, avg(value) AS BUREAU_value_MEAN, coalesce(sum(value), 0) AS BUREAU_value_SUM,
              var_samp(value) AS BUREAU_value_VAR FROM events GROUP BY 1),
od AS (SELECT o_custkey, avg(o_totalprice) AS PREV_o_totalprice_MEAN,
              var_samp(o_totalprice) AS PREV_o_totalprice_VAR FROM {S.SQL_PREV} GROUP BY 1),
f AS (SELECT a.*, ev.BUREAU_value_MEAN, ev.BUREAU_value_SUM, ev.BUREAU_value_VAR,
             od.PREV_o_totalprice_MEAN, od.PREV_o_totalprice_VAR
      FROM a LEFT JOIN ev ON a.c_custkey = ev.user_id LEFT JOIN od ON a.c_custkey = od.o_custkey)
"""
_PROFILE_COLS = ["c_custkey", "c_nationkey", "c_acctbal", "bal_per_nation", "BUREAU_value_MEAN",
                 "BUREAU_value_SUM", "BUREAU_value_VAR", "PREV_o_totalprice_MEAN",
                 "PREV_o_totalprice_VAR"]


@register("null_profile", _PROFILE_CTE + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(avg(CAST({c} IS NULL AS DOUBLE)), 4) AS null_share FROM f"
    for c in _PROFILE_COLS))
def null_profile(spark, d):
    return rounded(P.null_shares(_profile_frame(spark, d)))


@register("null_prune_fill", _PROFILE_CTE + """
SELECT c_custkey, c_nationkey, round(c_acctbal, 4) AS c_acctbal,
       round(CASE WHEN bal_per_nation = CAST('inf' AS DOUBLE) THEN 999.0
                  WHEN bal_per_nation = CAST('-inf' AS DOUBLE) THEN -999.0
                  ELSE coalesce(bal_per_nation, 0) END, 4) AS bal_per_nation,
       round(coalesce(PREV_o_totalprice_MEAN, 0), 4) AS PREV_o_totalprice_MEAN,
       round(coalesce(PREV_o_totalprice_VAR, 0), 4) AS PREV_o_totalprice_VAR
FROM f
""")
def null_prune_fill(spark, d):
    pruned, _ = P.prune_null_columns(_profile_frame(spark, d), 0.8)
    return rounded(P.replace_inf_all(P.fill_missing(pruned, 0)))


# --- A16 A17 E12 P11 ----------------------------------------------------------
_CARD_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
_CATS = ["o_orderstatus", "o_orderpriority"]


@register("cardinality_profile", f"""
WITH p AS {S.SQL_PREV},
c AS ({' UNION ALL '.join(
    f"SELECT '{c}' AS column_name, CAST(count(DISTINCT {c}) + max(CAST({c} IS NULL AS INTEGER)) AS BIGINT) AS n_distinct, {i} AS position, '{'categorical' if c in _CATS else 'continuous'}' AS kind FROM p"
    for i, c in enumerate(_CARD_COLS))})
SELECT column_name, n_distinct, CAST(position AS BIGINT) AS position, kind,
       CAST(n_distinct < 5 AS INTEGER) AS is_small,
       CASE WHEN kind = 'categorical' THEN
         CAST(least(CASE WHEN n_distinct < 8 THEN 5 ELSE n_distinct // 2 + 1 END, 100) AS BIGINT)
       END AS width
FROM c
""")
def cardinality_profile(spark, d):
    return P.feature_catalogue(S.prev(spark, d), _CATS).select(
        "column_name", "n_distinct", "position", "kind", "is_small", "width")


# --- P11 A16 A17: sketches of two runs, merged; the exact count lies within four standard errors
@register("cardinality_sketch", f"""
WITH p AS {S.SQL_PREV}
{' UNION ALL '.join(f"SELECT '{c}' AS column_name, CAST(count(DISTINCT {c}) + max(CAST({c} IS NULL AS INTEGER)) AS BIGINT) AS n_distinct, TRUE AS within_bound FROM p" for c in _CARD_COLS)}
""")
def cardinality_sketch(spark, d):
    p = S.prev(spark, d)
    runs = [P.cardinality_sketches(p.where(F.col("o_orderkey") % 2 == r)) for r in (0, 1)]
    estimate = P.sketch_estimates(P.merge_sketches(*runs)).withColumnRenamed("n_distinct", "e")
    off = F.abs(F.col("e") - F.col("n_distinct")) <= F.greatest(F.lit(1.0), 4 * P.SKETCH_ERROR * F.col("n_distinct"))
    return P.cardinalities(p).join(estimate, "column_name").select("column_name", "n_distinct", off.alias("within_bound"))


# --- U1 U2 F10 F13 A18 A19 ----------------------------------------------------
def _train_test(spark, d):
    o = S.table(spark, d, "orders")
    train = (o.filter(F.col("o_orderstatus") == "F")
              .select("o_orderkey", "o_custkey", "o_totalprice",
                      F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").cast("int").alias("TARGET")))
    test = (o.filter(F.col("o_orderstatus") != "F")
             .select("o_orderkey", "o_custkey", "o_totalprice"))
    return (train.withColumn("is_train", F.lit(True))
                 .unionByName(test.withColumn("is_train", F.lit(False)), allowMissingColumns=True))


_TT_SQL = """
(SELECT o_orderkey, o_custkey, o_totalprice,
        CAST(o_orderpriority IN ('1-URGENT', '2-HIGH') AS INTEGER) AS TARGET, true AS is_train
 FROM orders WHERE o_orderstatus = 'F'
 UNION ALL
 SELECT o_orderkey, o_custkey, o_totalprice, CAST(NULL AS INTEGER) AS TARGET, false AS is_train
 FROM orders WHERE o_orderstatus <> 'F')"""


@register("train_test_stack", f"""
SELECT o_orderkey, o_custkey, round(o_totalprice, 4) AS o_totalprice, TARGET, is_train
FROM {_TT_SQL}
""")
def train_test_stack(spark, d):
    return rounded(_train_test(spark, d))


@register("target_rate", f"""
SELECT count(*) FILTER (WHERE is_train) AS n_train, count(*) FILTER (WHERE NOT is_train) AS n_test,
       count(*) AS n_rows, CAST(5 AS BIGINT) AS n_cols,
       round(avg(TARGET) FILTER (WHERE is_train), 4) AS target_rate
FROM {_TT_SQL}
""")
def target_rate(spark, d):
    s = _train_test(spark, d)
    return rounded(s.agg(
        F.count(F.when(F.col("is_train"), 1)).alias("n_train"),
        F.count(F.when(~F.col("is_train"), 1)).alias("n_test"),
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(s.columns)).cast("bigint").alias("n_cols"),
        F.avg(F.when(F.col("is_train"), F.col("TARGET"))).alias("target_rate")))


@register("distinct_values", f"""
SELECT DISTINCT o_orderpriority FROM {S.SQL_PREV}
""")
def distinct_values(spark, d):
    return S.prev(spark, d).select("o_orderpriority").distinct()


# --- E9 -----------------------------------------------------------------------
_STD_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "one"]


@register("standardise", """
WITH li AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
                   1.0 AS one FROM lineitem)
SELECT l_orderkey, l_linenumber, """ + ", ".join(
    f"round(CASE WHEN stddev_pop({c}) OVER () = 0 THEN 0.0 ELSE ({c} - avg({c}) OVER ()) / "
    f"stddev_pop({c}) OVER () END, 4) AS {c}" for c in _STD_COLS) + " FROM li")
def standardise(spark, d):
    li = S.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        F.lit(1.0).alias("one"))
    return rounded(P.standardise(li, _STD_COLS))


# --- W4 W5 F11 ----------------------------------------------------------------
@register("stratified_folds", """
SELECT o_orderkey, CAST(o_orderpriority IN ('1-URGENT', '2-HIGH') AS INTEGER) AS label,
       CAST(ntile(5) OVER (PARTITION BY o_orderpriority IN ('1-URGENT', '2-HIGH')
                           ORDER BY o_orderkey) - 1 AS INTEGER) AS fold
FROM orders
""")
def stratified_folds_q(spark, d):
    o = S.table(spark, d, "orders").select(
        "o_orderkey",
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").cast("int").alias("label"))
    return stratified_folds(o, "label", "o_orderkey", k=5)


@register("stratified_folds_text", """
SELECT o_orderkey, CAST(nullif(o_orderpriority = '1-URGENT', false) AS INTEGER) AS label,
       CAST(ntile(5) OVER (PARTITION BY nullif(o_orderpriority = '1-URGENT', false)
                           ORDER BY nullif('k' || o_orderkey % 1000, 'k7') NULLS FIRST, o_orderkey) - 1 AS INTEGER) AS fold
FROM orders
""")
def stratified_folds_text(spark, d):
    """Many ranges over a text key with ties and missing values; the missing label is a class."""
    o = S.table(spark, d, "orders").select(
        "o_orderkey", F.nullif(F.col("o_orderpriority") == "1-URGENT", F.lit(False)).cast("int").alias("label"),
        F.nullif(F.concat(F.lit("k"), F.col("o_orderkey") % 1000), F.lit("k7")).alias("key"))
    return stratified_folds(o, "label", ["key", "o_orderkey"], k=5, n_ranges=37).drop("key")


@register("hash_folds", """
SELECT o_orderkey,
       CAST(CAST('0x' || substr(md5('2018:' || CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 5
            AS INTEGER) AS fold
FROM orders
""")
def hash_folds_q(spark, d):
    return hash_folds(S.table(spark, d, "orders").select("o_orderkey"), "o_orderkey", 5, 2018)


# --- E16 E17 ------------------------------------------------------------------
_DOC_SQL = """
(SELECT l.doc_id, l.quality AS y, l.toxic, d.n_chars AS score,
        1.0 / (1.0 + exp(-(ln(d.n_chars + 1) - 8))) AS p
 FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


def _docs(spark, d):
    lab = S.table(spark, d, "labels")
    doc = S.table(spark, d, "documents").select("doc_id", "n_chars")
    return lab.join(doc, "doc_id").select(
        "doc_id", F.col("quality").alias("y"), "toxic", F.col("n_chars").alias("score"),
        (1.0 / (1.0 + F.exp(-(F.ln(F.col("n_chars") + 1) - 8)))).alias("p"))


@register("auc_exact", f"""
WITH s AS (SELECT toxic, score, sum(CAST(y = 1 AS BIGINT)) AS pos, sum(CAST(y <> 1 AS BIGINT)) AS neg
           FROM {_DOC_SQL} WHERE y IS NOT NULL AND score IS NOT NULL GROUP BY 1, 2),
c AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY toxic ORDER BY score
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cum_neg FROM s)
SELECT toxic, round(sum(pos * (cum_neg + neg / 2.0)) / (sum(pos) * sum(neg)), 4) AS auc,
       CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg
FROM c GROUP BY toxic
""")
def auc_exact_q(spark, d):
    return rounded(auc_exact(_docs(spark, d), "y", "score", by=["toxic"]))


@register("losses", f"""
SELECT toxic,
  round(avg(-(y * ln(greatest(least(p, 1 - 1e-7), 1e-7))
            + (1 - y) * ln(1 - greatest(least(p, 1 - 1e-7), 1e-7)))), 4) AS log_loss,
  round(avg(pow(y - p, 2)), 4) AS mse,
  round(avg(CAST(y = round(p) AS DOUBLE)), 4) AS accuracy, count(*) AS n
FROM {_DOC_SQL} GROUP BY toxic
""")
def losses_q(spark, d):
    return rounded(losses(_docs(spark, d), "y", "p", by=["toxic"]))


# --- E19 S6 -------------------------------------------------------------------
@register("ensemble_mean", """
WITH s AS (""" + " UNION ALL ".join(
    f"SELECT o_orderkey, {f} AS f, CAST(CAST('0x' || substr(md5('{f}:' || CAST(o_orderkey AS VARCHAR)),"
    f" 1, 8) AS BIGINT) AS DOUBLE) / 4294967295.0 AS score FROM orders"
    for f in range(5)) + """)
SELECT o.o_orderkey, round(m.TARGET, 4) AS TARGET
FROM orders o LEFT JOIN (SELECT o_orderkey, avg(score) AS TARGET FROM s GROUP BY 1) m
  ON o.o_orderkey = m.o_orderkey
""")
def ensemble_mean_q(spark, d):
    o = S.table(spark, d, "orders")
    test = o.select("o_orderkey")
    parts = [test.select("o_orderkey", F.lit(f).alias("fold"),
                         (hash32("o_orderkey", f).cast("double") / 4294967295.0)
                         .alias("score")) for f in range(5)]
    scores = parts[0]
    for p in parts[1:]:
        scores = scores.unionByName(p)
    sub = o.select("o_orderkey").join(ensemble_mean(scores, "o_orderkey"), "o_orderkey", "left")
    return rounded(sub)


# --- S2 W6 --------------------------------------------------------------------
@register("sample_scan", """
SELECT o_orderkey, o_custkey, round(o_totalprice, 4) AS o_totalprice
FROM orders ORDER BY o_orderkey LIMIT 1000
""")
def sample_scan_q(spark, d):
    o = S.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return rounded(sample_scan(o, 1000, "o_orderkey"))


# --- S2 W1 W3 P10 in file order ---------------------------------------------------
def _first_row_sql(col: str, table: str) -> str:
    return (f"(SELECT v, CAST(row_number() OVER (ORDER BY f) - 1 AS INTEGER) AS code FROM "
            f"(SELECT {col} AS v, min(r) AS f FROM {table} WHERE {col} IS NOT NULL GROUP BY 1))")


@register("file_order_codes", f"""
WITH e AS (SELECT row_number() OVER () - 1 AS r, * FROM events)
SELECT e.event_id, e.r AS file_row, t.code AS event_type, u.code AS user_id
FROM e LEFT JOIN {_first_row_sql('event_type', 'e')} t ON e.event_type = t.v
       LEFT JOIN {_first_row_sql('user_id', 'e')} u ON e.user_id = u.v
""")
def file_order_codes(spark, d):
    e = S.table(spark, d, "events", row="file_row").select("event_id", "file_row", "event_type", "user_id")
    return E.factorize(e, ["event_type", "user_id"], ["file_row"])


@register("file_order_sample", """
SELECT event_id, user_id, event_type, round(value, 4) AS value
FROM (SELECT row_number() OVER () - 1 AS r, * FROM events) WHERE r < 500
""")
def file_order_sample(spark, d):
    e = S.table(spark, d, "events", row="file_row")
    return rounded(sample_scan(e, 500, "file_row").select("event_id", "user_id", "event_type", "value"))


@register("file_order_latest", f"""
WITH e AS (SELECT row_number() OVER () - 1 AS r, * FROM events),
b AS (SELECT r, user_id, event_type, value,
             CAST(-(date_diff('day', CAST(ts AS DATE), DATE '{S.EVENTS_END}') // 7 + 1) AS BIGINT) AS m FROM e)
SELECT user_id, event_type, round(value, 4) AS value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY m DESC, r) AS k FROM b WHERE user_id IS NOT NULL AND m IS NOT NULL) WHERE k = 1
""")
def file_order_latest(spark, d):
    e = S.table(spark, d, "events", row="file_row").select(
        "user_id", "event_type", "value", (-F.col("file_row")).alias("first"), S.month_offset("ts", S.EVENTS_END, 7).alias("m"))
    return rounded(latest_by(e, "user_id", "m", ["event_type", "value"], row_id="first"))


# --- E7 E13 E14 E15 E18 E19 E20 F11 M11 -----------------------------------------
_NB_FEATURES = ["amount", "days"]


def _nb_frame(spark, d):
    p = S.prev_with_credit(spark, d).select(
        "o_orderkey", (F.col("AMT_APPLICATION") / 100000).alias("amount"), (F.col("DAYS_DECISION") / 1000).alias("days"),
        F.when(F.col("o_orderstatus") == "F", "yes").otherwise("no").alias("answer"))
    return hash_folds(p, "o_orderkey", 5, 2018)


# Gaussian naive Bayes in closed form: a prior, and a mean and population variance per class and feature.
_NB_SQL = f"""
WITH x AS (SELECT o_orderkey, AMT_APPLICATION / 100000 AS amount, DAYS_DECISION / 1000 AS days,
                  CASE WHEN o_orderstatus = 'F' THEN 'yes' ELSE 'no' END AS answer,
                  CAST(CAST('0x' || substr(md5('2018:' || CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 5 AS INTEGER) AS fold
           FROM {S.SQL_PREV_CREDIT}),
f AS (SELECT unnest(range(5)) AS model),
m AS (SELECT model, answer, count(*) AS n, avg(amount) AS ma, avg(days) AS md,
             var_pop(amount) AS va, var_pop(days) AS vd
      FROM x JOIN f ON x.fold <> f.model GROUP BY 1, 2),
l AS (SELECT x.o_orderkey, x.fold, x.answer AS truth, m.model, m.answer,
             ln(m.n) - 0.5 * (ln(2 * pi() * va) + pow(amount - ma, 2) / va)
                     - 0.5 * (ln(2 * pi() * vd) + pow(days - md, 2) / vd) AS ll
      FROM x CROSS JOIN m),
p AS (SELECT o_orderkey, fold, truth, model,
             1 / (1 + exp(max(ll) FILTER (WHERE answer = 'no') - max(ll) FILTER (WHERE answer = 'yes'))) AS score
      FROM l GROUP BY 1, 2, 3, 4)
"""


@register("oof_naive_bayes", _NB_SQL + """
SELECT o_orderkey, fold, truth AS answer, round(score, 4) AS score FROM p WHERE model = fold
""")
def oof_naive_bayes(spark, d):
    """All folds fitted from one aggregate; out-of-fold class-1 probability of a text label."""
    oof, _ = out_of_fold(_nb_frame(spark, d), "o_orderkey", _NB_FEATURES, "answer", "fold", 5)
    return rounded(oof.select("o_orderkey", "fold", "answer", F.get("probabilities", F.lit(1)).alias("score")))


# three classes: the order status
_NB3_SQL = _NB_SQL.replace("CASE WHEN o_orderstatus = 'F' THEN 'yes' ELSE 'no' END", "o_orderstatus").split("p AS (")[0].rstrip().rstrip(",") + """,
e AS (SELECT o_orderkey, fold, truth, answer, exp(ll - max(ll) OVER (PARTITION BY o_orderkey)) AS e FROM l WHERE model = fold),
q AS (SELECT o_orderkey, fold, truth AS answer, coalesce(sum(e) FILTER (WHERE answer = 'F'), 0) / sum(e) AS f,
             coalesce(sum(e) FILTER (WHERE answer = 'O'), 0) / sum(e) AS o, coalesce(sum(e) FILTER (WHERE answer = 'P'), 0) / sum(e) AS p
      FROM e GROUP BY 1, 2, 3)
"""


def _three_classes(spark, d):
    frame = _nb_frame(spark, d).drop("answer").join(
        S.table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("answer")), F.col("o_orderkey") == F.col("k")).drop("k")
    return out_of_fold(frame, "o_orderkey", _NB_FEATURES, "answer", "fold", 5)


@register("oof_naive_bayes_classes", _NB3_SQL + """
SELECT o_orderkey, fold, answer, round(f, 4) AS p_f, round(o, 4) AS p_o, round(p, 4) AS p_p FROM q
""")
def oof_naive_bayes_classes(spark, d):
    """Out-of-fold probabilities of a label with three values."""
    p = F.col("probabilities")
    return rounded(_three_classes(spark, d)[0].select("o_orderkey", "fold", "answer", *[F.get(p, F.lit(i)).alias(n) for i, n in enumerate(("p_f", "p_o", "p_p"))]))


@register("categorical_losses", _NB3_SQL + """
SELECT fold, round(avg(-ln(least(greatest(CASE answer WHEN 'F' THEN f WHEN 'O' THEN o ELSE p END, 1e-7), 1 - 1e-7))), 4) AS cross_entropy,
       round(avg(CAST(CASE WHEN f >= o AND f >= p THEN 'F' WHEN o >= p THEN 'O' ELSE 'P' END = answer AS DOUBLE)), 4) AS accuracy, count(*) AS n
FROM q GROUP BY 1
""")
def categorical_losses_q(spark, d):
    """Categorical cross-entropy and accuracy per fold; the class numbers come from the fold's model."""
    oof, models = _three_classes(spark, d)
    own = models.select(F.col("model").alias("__m"), F.col("answer").alias("__a"), "class")
    oof = oof.join(own, (F.col("fold") == F.col("__m")) & (F.col("answer") == F.col("__a")), "left")
    return rounded(categorical_losses(oof, "class", "probabilities", ["fold"]))


@register("naive_bayes_ensemble", _NB_SQL + """
SELECT o_orderkey, round(avg(score), 4) AS TARGET FROM p GROUP BY 1
""")
def naive_bayes_ensemble(spark, d):
    """Every row scored by every fold's model, and their mean."""
    data = _nb_frame(spark, d)
    models = fit_folds(data, "o_orderkey", _NB_FEATURES, [], "answer", "fold", 5, kind="gaussian_nb")[1]
    return rounded(ensemble_mean(score_folds(models, data, "o_orderkey"), "o_orderkey"))


# --- S7 E1 E6 E9 F6: fitted stages, saved and loaded -------------------------------
_FIT_SQL = """
WITH x AS (SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, o_totalprice AS price, o_orderkey % 3 = 0 AS is_train,
                  o_orderstatus = 'F' AS y FROM orders),
v AS (SELECT day, CAST(row_number() OVER (ORDER BY day) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT day FROM x WHERE is_train)),
m AS (SELECT avg(price) AS a, stddev_pop(price) AS s FROM x WHERE is_train),
t AS (SELECT o_orderkey, is_train, y, coalesce(v.code, (SELECT CAST(count(*) AS INTEGER) FROM v)) AS day, (price - m.a) / m.s AS price
      FROM x LEFT JOIN v ON x.day = v.day CROSS JOIN m)
"""


def _fit_frame(spark, d):
    return S.table(spark, d, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").cast("string").alias("day"), F.col("o_totalprice").alias("price"),
        (F.col("o_orderkey") % 3 == 0).alias("is_train"), (F.col("o_orderstatus") == "F").cast("double").alias("label"))


def _fitted(spark, stages, rows):
    """A pipeline fitted, saved to the shared folder and loaded again."""
    path = f"{checkpoint_dir(spark)}/fitted-{uuid.uuid4().hex}"
    Pipeline(stages=stages).fit(rows).write().save(path)
    return PipelineModel.load(path)


@register("fit_on_train", _FIT_SQL + "SELECT o_orderkey, is_train, day, round(price, 4) AS price FROM t")
def fit_on_train(spark, d):
    """Encoder and scaler fitted on the training rows alone, saved, loaded and applied to all; unseen days get the next code."""
    rows = _fit_frame(spark, d)
    stages = [CategoryEncoder(cols=["day"], fitOn="is_train"), ColumnScaler(cols=["price"], fitOn="is_train")]
    return rounded(_fitted(spark, stages, rows).transform(rows).drop("label"))


@register("saved_pipeline_scores", _FIT_SQL.replace("t AS", "raw AS") + """,
t AS (SELECT o_orderkey, is_train, y, price, (day - avg(day) FILTER (WHERE is_train) OVER ()) / stddev_pop(day) FILTER (WHERE is_train) OVER () AS day FROM raw),
g AS (SELECT y, count(*) AS n, avg(day) AS md, var_pop(day) AS vd, avg(price) AS mp, var_pop(price) AS vp FROM t WHERE is_train GROUP BY 1),
l AS (SELECT o_orderkey, g.y, ln(n) - 0.5 * (ln(2 * pi() * vd) + pow(day - md, 2) / vd) - 0.5 * (ln(2 * pi() * vp) + pow(price - mp, 2) / vp) AS ll FROM t CROSS JOIN g)
SELECT o_orderkey, round(1 / (1 + exp(max(ll) FILTER (WHERE NOT y) - max(ll) FILTER (WHERE y))), 4) AS score FROM l GROUP BY 1
""")
def saved_pipeline_scores(spark, d):
    """One saved pipeline encodes, scales and scores raw rows."""
    rows = _fit_frame(spark, d)
    stages = [CategoryEncoder(cols=["day"]), ColumnScaler(cols=["day", "price"]), *feature_stages(["day", "price"], []), make_classifier("gaussian_nb")]
    return rounded(probability_of_one(_fitted(spark, stages, rows.filter("is_train")).transform(rows)).select("o_orderkey", "score"))


# --- S1 S3 S5 S6 S7 S8: every file of the chain ------------------------------------
@register("submission_files", ORACLE["saved_pipeline_scores"].replace("AS score FROM l GROUP BY 1", 'AS "TARGET" FROM l WHERE o_orderkey % 3 <> 0 GROUP BY 1'))
def submission_files(spark, d):
    """Features to CSV and back, a saved pipeline, the test matrix and the template in buckets, the submission file read back."""
    folder = f"{output_dir(checkpoint_dir(spark), None)}/chain-{uuid.uuid4().hex}"
    write_table(_fit_frame(spark, d), f"{folder}/features.csv", "csv")
    schema = StructType.fromDDL("o_orderkey long, day string, price double, is_train boolean, label double")
    rows = read_table(spark, f"{folder}/features.csv", schema)
    stages = [CategoryEncoder(cols=["day"]), ColumnScaler(cols=["day", "price"]), *feature_stages(["day", "price"], []), make_classifier("gaussian_nb")]
    model = _fitted(spark, stages, rows.filter("is_train"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    matrix = write_bucketed(rows.filter("NOT is_train").drop("label"), f"{folder}/test_matrix", "o_orderkey", buckets)
    template = write_bucketed(rows.filter("NOT is_train").select("o_orderkey", F.lit(0.5).alias("TARGET")), f"{folder}/template", "o_orderkey", buckets)
    scores = probability_of_one(model.transform(matrix)).select("o_orderkey", F.col("score").alias("TARGET"))
    write_submission(template, scores, "o_orderkey", f"{folder}/submission.csv")
    return rounded(read_table(spark, f"{folder}/submission.csv", StructType.fromDDL("o_orderkey long, TARGET double")))


# --- with a classifier that has no closed form ----------------------------------
def _oof_frame(spark, d):
    p = S.prev_with_credit(spark, d)
    enc, _, _ = E.label_encode(p.select("o_orderkey", "o_orderpriority", "AMT_APPLICATION",
                                        "DAYS_DECISION", "o_orderstatus"),
                               ["o_orderpriority"])
    enc = enc.withColumn("label", (F.col("o_orderstatus") == "F").cast("int"))
    num = ["AMT_APPLICATION", "DAYS_DECISION"]
    scaled = P.standardise(enc, num)
    return hash_folds(scaled, "o_orderkey", 5, 2018), num


@register("oof_scores")
def oof_scores(spark, d):
    data, num = _oof_frame(spark, d)
    oof, _ = fit_folds(data, "o_orderkey", num, ["o_orderpriority"], "label", "fold", 5,
                       kind="logistic", max_iter=30)
    return oof


@register("oof_auc")
def oof_auc(spark, d):
    return rounded(auc_exact(oof_scores(spark, d), "label", "score", by=["fold"]))
