"""Stand-ins: the driver's tables in the roles of the source job's tables.

    application               <- customer        (key c_custkey)
    previous applications,
    bureau                    <- orders          (key o_custkey, bureau id o_orderkey)
    bureau balance            <- lineitem        (bureau id l_orderkey, 30-day month offset)
    card / POS balance        <- events          (key user_id, 7-day month offset)
    instalments               <- orders x lineitem (due = order date / price,
                                                  paid = ship date / discounted price
                                                  in whole cents)

Month offsets are negative and never 0: ``-(days before a fixed date div N + 1)``.
Each stand-in has a Spark form and the same derivation as SQL text for the
DuckDB oracle.  Missing values are made with ``nullif`` (the raw tables
hold none) and by left joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortforge.sources.io import read_table

# Fixed values of the stand-in mapping.
EVENTS_END = "2024-01-31"
ORDERS_END = "2001-12-01"
MISSING_PRIORITY = "4-NOT SPECIFIED"


def table(spark: SparkSession, sf_dir: str, name: str, row: str | None = None) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet", row=row)


def month_offset(ts: str, end: str, days: int):
    d = F.datediff(F.lit(end).cast("date"), F.col(ts).cast("date"))
    return (-(F.floor(d / days) + 1)).cast("bigint")


def app(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


def prev(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.nullif(F.col("o_orderpriority"), F.lit(MISSING_PRIORITY)).alias("o_orderpriority"))


def bureau(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")


def bureau_balance(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus",
        month_offset("l_shipdate", ORDERS_END, 30).alias("MONTHS_BALANCE"))


def bureau_balance_rows(spark, sf_dir) -> DataFrame:
    """Bureau balance with ``__row``, the order of a month's rows by line number, quantity, flag and status in one number.

    The line number alone does not tell the rows of an order apart.
    """
    by_line = F.col("l_linenumber").cast("long") * 1_000_000 + (F.col("l_quantity") * 100).cast("long")
    return bureau_balance(spark, sf_dir).withColumn("__row", (by_line * 256 + F.ascii("l_returnflag")) * 256 + F.ascii("l_linestatus"))


def balance(spark, sf_dir) -> DataFrame:
    """Card and POS balance rows."""
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value",
        month_offset("ts", EVENTS_END, 7).alias("MONTHS_BALANCE"))


def instalments(spark, sf_dir, with_version: bool = False) -> DataFrame:
    """Instalment rows; ``with_version`` adds the line number as the version."""
    end = F.lit(ORDERS_END).cast("date")
    # days are counted before the join: small whole numbers shuffle in fewer bytes than points in time
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.datediff(F.col("o_orderdate").cast("date"), end).alias("__due"))
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", *(["l_linenumber"] if with_version else []), "l_extendedprice", "l_discount",
                                                 F.datediff(F.col("l_shipdate").cast("date"), end).alias("__paid"))
    version = ([F.col("l_linenumber").cast("double").alias("NUM_INSTALMENT_VERSION")]
               if with_version else [])
    return o.join(li, o.o_orderkey == li.l_orderkey).select(
        "o_custkey", "o_orderkey", *version,
        F.col("__due").cast("double").alias("DAYS_INSTALMENT"),
        F.col("__paid").cast("double").alias("DAYS_ENTRY_PAYMENT"),
        F.col("l_extendedprice").alias("AMT_INSTALMENT"),
        (F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")) * 100) / 100)
        .alias("AMT_PAYMENT"))


# The same stand-ins as SQL (DuckDB dialect), for oracle queries.
SQL_APP = "(SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer)"
SQL_PREV = ("(SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
            f"nullif(o_orderpriority, '{MISSING_PRIORITY}') AS o_orderpriority FROM orders)")
SQL_BUREAU = "(SELECT o_orderkey, o_custkey, o_totalprice FROM orders)"
SQL_BB = ("(SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, l_linestatus, "
          f"CAST(-(date_diff('day', CAST(l_shipdate AS DATE), DATE '{ORDERS_END}') // 30 + 1) "
          "AS BIGINT) AS MONTHS_BALANCE FROM lineitem)")
SQL_BALANCE = ("(SELECT event_id, user_id, event_type, value, "
               f"CAST(-(date_diff('day', CAST(ts AS DATE), DATE '{EVENTS_END}') // 7 + 1) "
               "AS BIGINT) AS MONTHS_BALANCE FROM events)")
SQL_INS = ("(SELECT o_custkey, o_orderkey, "
           f"CAST(date_diff('day', DATE '{ORDERS_END}', CAST(o_orderdate AS DATE)) AS DOUBLE) "
           "AS DAYS_INSTALMENT, "
           f"CAST(date_diff('day', DATE '{ORDERS_END}', CAST(l_shipdate AS DATE)) AS DOUBLE) "
           "AS DAYS_ENTRY_PAYMENT, l_extendedprice AS AMT_INSTALMENT, "
           "round(l_extendedprice * (1 - l_discount) * 100) / 100 AS AMT_PAYMENT "
           "FROM orders JOIN lineitem ON o_orderkey = l_orderkey)")

SQL_INS_V = SQL_INS.replace("SELECT o_custkey, o_orderkey, ",
                            "SELECT o_custkey, o_orderkey, "
                            "CAST(l_linenumber AS DOUBLE) AS NUM_INSTALMENT_VERSION, ")


def prev_with_credit(spark, sf_dir) -> DataFrame:
    """Previous applications with amounts asked (order price) and received
    (discounted line total; missing for an order without lines) and days."""
    o = table(spark, sf_dir, "orders")
    li = (table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
          .agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("AMT_CREDIT")))
    days = F.datediff(F.col("o_orderdate").cast("date"), F.lit(ORDERS_END).cast("date"))
    return o.join(li, o.o_orderkey == li.l_orderkey, "left").select(
        "o_orderkey", "o_custkey", "o_orderstatus",
        F.nullif(F.col("o_orderpriority"), F.lit(MISSING_PRIORITY)).alias("o_orderpriority"),
        F.col("o_totalprice").alias("AMT_APPLICATION"), "AMT_CREDIT",
        days.cast("bigint").alias("DAYS_DECISION"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(365243).cast("bigint"))
         .otherwise(days + 30).cast("bigint").alias("DAYS_FIRST_DUE"))


SQL_PREV_CREDIT = (
    "(SELECT o_orderkey, o_custkey, o_orderstatus, "
    f"nullif(o_orderpriority, '{MISSING_PRIORITY}') AS o_orderpriority, "
    "o_totalprice AS AMT_APPLICATION, li.AMT_CREDIT, "
    f"CAST(date_diff('day', DATE '{ORDERS_END}', CAST(o_orderdate AS DATE)) AS BIGINT) AS DAYS_DECISION, "
    "CAST(CASE WHEN o_orderpriority = '5-LOW' THEN 365243 ELSE "
    f"date_diff('day', DATE '{ORDERS_END}', CAST(o_orderdate AS DATE)) + 30 END AS BIGINT) "
    "AS DAYS_FIRST_DUE "
    "FROM orders LEFT JOIN (SELECT l_orderkey, sum(l_extendedprice * (1 - l_discount)) AS AMT_CREDIT "
    "FROM lineitem GROUP BY 1) li ON o_orderkey = li.l_orderkey)")
