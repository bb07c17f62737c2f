"""Tables bucketed on a key, so that they meet on it without an exchange.

Feature blocks, the test matrix and the submission template hold one row per
customer and are joined on the customer again and again.  Written with the
same number of buckets on that key, they are shuffled once, when written, and
every later join on the key or aggregate by it reads matching buckets.

A bucket is read by one task, so this layout is for tables with one row per
key (or few).  A history in which one key may hold a large share of the rows
stays in ``write_table``: its aggregates combine before they shuffle.

A table is a folder of Parquet files with key, bucket count and schema beside
them in a subfolder that plain scans skip, so ``spark.read.parquet`` reads it too, and
a later session finds the layout again.  It is known to the session's catalog
as an external table, named after its path.
"""

from __future__ import annotations

import hashlib
import json
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cohortforge.sources.io import read_table, there

LAYOUT = "_layout"
AT_ONCE = 3     # tables that are written side by side


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _known(spark: SparkSession, path: str, schema: StructType, key: str, buckets: int) -> str:
    """The catalog's name of the bucketed table at ``path``, entered anew (files stay as they are)."""
    name = "bucketed_" + hashlib.sha256(path.rstrip("/").encode()).hexdigest()[:24]
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({_quoted(key)}) SORTED BY ({_quoted(key)}) "
              f"INTO {buckets} BUCKETS LOCATION '{location}'")
    return name


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """Overwrite the table at ``path`` with the rows of ``df`` in ``buckets`` buckets by hash of ``key``; returns it read back.

    One shuffle and one file a bucket.  Rows with a missing key share a bucket.
    The overwrite removes the old layout with the old files, and the new one
    is written last: a write that breaks off leaves no layout that its files don't have.
    """
    if buckets < 1:
        raise ValueError("a table has at least one bucket")
    spark = df.sparkSession
    name = _known(spark, path, df.schema, key, buckets)
    df.repartition(buckets, F.col(_quoted(key))).write.insertInto(name, overwrite=True)
    layout = spark.range(1).select(F.lit(key).alias("key"), F.lit(buckets).alias("buckets"), F.lit(df.schema.json()).alias("schema"))
    layout.coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{LAYOUT}")
    return spark.table(name)


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    """A table that a job has stored: by its buckets if it was written by ``write_bucketed``, else as ``read_table`` does."""
    found = _layout(spark, path)
    if not found:
        return read_table(spark, path)
    return spark.table(_known(spark, path, StructType.fromJson(json.loads(found.schema)), found.key, found.buckets))


def _layout(spark: SparkSession, path: str) -> Row | None:
    at = f"{path.rstrip('/')}/{LAYOUT}"
    return spark.read.parquet(at).first() if there(spark, f"{at}/_SUCCESS") else None


def layout_of(spark: SparkSession, path: str) -> tuple[str, int] | None:
    """Key and bucket count of the table at ``path``; None for a plain one."""
    found = _layout(spark, path)
    return (found.key, found.buckets) if found else None


def store_blocks(tables: dict[str, DataFrame], folder: str, key: str, buckets: int) -> None:
    """Write each table (one row per ``key``) under its name, all in the same buckets.  A later call may replace some of them.

    The writes are jobs of their own and run side by side, ``AT_ONCE`` of them:
    where one has few tasks left, or plans, the tasks of others fill the cores.
    """
    with ThreadPoolExecutor(AT_ONCE) as pool:
        for write in [pool.submit(write_bucketed, df, f"{folder.rstrip('/')}/{name}", key, buckets) for name, df in tables.items()]:
            write.result()


def join_stored(spark: SparkSession, folder: str, base: str, blocks: list[str], key: str) -> DataFrame:
    """The stored ``base`` with the stored ``blocks`` left-joined in order: no exchange if all have the same buckets."""
    out = read_stored(spark, f"{folder.rstrip('/')}/{base}")
    for name in blocks:
        out = out.join(read_stored(spark, f"{folder.rstrip('/')}/{name}"), key, "left")
    return out
