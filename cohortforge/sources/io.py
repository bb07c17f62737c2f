"""Scans and sinks.

* CSV scans bind columns by the file's header: one line is read, every
  column is kept, known names get their declared type and others one by rule
  (no inference pass over the data).  NaN becomes NULL at ingest, so
  aggregates never see NaN.
* The sample scan takes the first ``n`` rows in the order of the key and then
  of all other columns: the same rows whatever the partitioning, and a top-k
  (``TakeOrderedAndProject``) rather than a full sort.
* With ``row``, a scan numbers its rows in file order, for rules that take the
  first row or the first value that a file holds.
* Sinks write Parquet/CSV with overwrite; the submission sink joins scores
  onto the template by key (never by row position).
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cohortforge.functions.semantics import nan_to_null
from cohortforge.sources import schemas


def clean_nan(df: DataFrame) -> DataFrame:
    """NaN -> NULL in every floating column."""
    return df.select(*[nan_to_null(F.col(f"`{f.name}`")).alias(f.name)
                       if f.dataType.typeName() in ("double", "float") else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


def header(spark: SparkSession, path: str) -> list[str]:
    """The column names in a CSV file's first line (read through Spark, so from any of its stores)."""
    return spark.read.option("header", True).csv(path).columns


def whole_number(c: Column) -> Column:
    """Text as a whole number, also when it is spelled ``-12.0``; NaN and nothing are NULL, other text is an error."""
    text = F.trim(c)
    number = F.coalesce(text.try_cast("bigint"), F.nullif(text.try_cast("double"), F.lit(float("nan"))).try_cast("bigint"))
    blank = text.isNull() | F.lower(text).isin("", "nan")
    return F.when(blank, F.lit(None).cast("bigint")).when(
        number.isNull(), F.raise_error(F.concat(F.lit("not a whole number: "), text)).cast("bigint")).otherwise(number)


def bound_schema(names: Sequence[str], schema: StructType | None) -> StructType:
    """The types of a file's columns, in the file's order: declared ones, else by ``schemas.other_type``."""
    declared = {f.name: f.dataType for f in (schema.fields if schema else [])}
    return StructType([StructField(n, declared.get(n, schemas.other_type(n))) for n in names])


_FILE, _BLOCK, _AT = "__file", "__block", "__at"


def _numbered(df: DataFrame, row: str) -> DataFrame:
    """``df`` with its ``_FILE``, ``_BLOCK`` and ``_AT`` turned into ``row``, 0-based: files by path, their splits by start, rows as they stand.

    The rows of each split are counted (a pass that reads no column), the
    counts before it added up, and the place inside the split is added.  The
    counts, one row per split, are broadcast: all rows of a file share their
    key, and a shuffle by it would send them to one task.
    """
    splits = df.groupBy(_FILE, _BLOCK).agg(F.count(F.lit(1)).alias("__n"), F.min(_AT).alias("__from"))
    earlier = Window.orderBy(_FILE, _BLOCK).rowsBetween(Window.unboundedPreceding, -1)       # one row per split, in one task
    before = splits.select(F.col(_FILE).alias("__f"), F.col(_BLOCK).alias("__b"), "__from", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    out = df.join(F.broadcast(before), (F.col(_FILE) == F.col("__f")) & (F.col(_BLOCK) == F.col("__b")), "left")
    return out.withColumn(row, F.col("__before") + F.col(_AT) - F.col("__from")).drop(_FILE, _BLOCK, _AT, "__f", "__b", "__from", "__before")


def read_table(spark: SparkSession, path: str, schema: StructType | None = None,
               fmt: str | None = None, row: str | None = None) -> DataFrame:
    """Scan one table.  CSV (plain or .gz) needs a header row; Parquet carries
    its own schema.  Without ``fmt``, names ending in .csv / .csv.gz are CSV,
    everything else (files or folders written by Spark) is Parquet.

    CSV columns are bound by name: the file may hold them in any order, and
    more of them than ``schema`` declares.  Declared columns that it lacks
    follow as NULL.

    ``row`` adds a column of that name with each row's place in file order
    (0-based, files by path): the same numbers however the files are split.
    Parquet keeps a row's place in its file; in CSV a split's rows come in
    order within one task, so the splits are counted and their counts added.
    """
    if fmt is None:
        p = path.rstrip("/").lower()
        fmt = "csv" if (p.endswith(".csv") or p.endswith(".csv.gz")) else "parquet"
    if fmt == "csv":
        names = header(spark, path)
        types = bound_schema(names, schema)
        longs = {f.name for f in types if f.dataType.typeName() == "long"}
        text = StructType([StructField(f.name, StringType()) if f.name in longs else f for f in types])
        df = (spark.read.option("header", True).option("mode", "FAILFAST").option("enforceSchema", False).option("nanValue", "nan")
              .schema(text).csv(path))
        place = [F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.file_block_start").alias(_BLOCK), F.monotonically_increasing_id().alias(_AT)]
        df = df.select(*[whole_number(F.col(f"`{n}`")).alias(n) if n in longs else F.col(f"`{n}`") for n in names], *(place if row else []))
        missing = [f for f in (schema.fields if schema else []) if f.name not in set(names)]
        df = df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})
    else:
        df = spark.read.format(fmt).load(path)
        if row and fmt != "parquet":
            raise ValueError(f"no file order for {fmt}")
        if row:
            df = df.select("*", F.col("_metadata.file_path").alias(_FILE), F.lit(0).alias(_BLOCK), F.col("_metadata.row_index").alias(_AT))
    return clean_nan(_numbered(df, row) if row else df)


def there(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, in whatever file system Spark reads it from."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_inputs(spark: SparkSession, input_dir: str, fmt: str = "csv",
                names: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """The source tables of a feature build, by name, from one folder."""
    out = {}
    for name in names or schemas.TABLES:
        ext = ".parquet" if fmt == "parquet" else ".csv"
        path = f"{input_dir.rstrip('/')}/{name}{ext}"
        if fmt == "csv" and not there(spark, path) and there(spark, path + ".gz"):
            path += ".gz"
        out[name] = read_table(spark, path, schemas.TABLES.get(name) if fmt == "csv" else None,
                               fmt)
    return out


def sample_scan(df: DataFrame, n: int | None, key: str | Sequence[str]) -> DataFrame:
    """First ``n`` rows in the order of the key and then all other columns (all rows when ``n`` is None)."""
    if n is None:
        return df
    keys = [key] if isinstance(key, str) else list(key)
    keys += [f.name for f in df.schema.fields if f.name not in keys and f.dataType.typeName() not in ("map", "variant")]
    return df.orderBy(*[F.col(f"`{c}`") for c in keys]).limit(n)


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: Sequence[str] = ()) -> None:
    """Overwrite a table (Parquet by default, CSV with a header)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def write_submission(template: DataFrame, scores: DataFrame, key: str, path: str,
                     score_col: str = "TARGET", fmt: str = "csv") -> DataFrame:
    """Template rows with ``score_col`` replaced by the scores matched on key."""
    sub = (template.drop(score_col)
                   .join(scores.select(key, F.col(score_col)), key, "left"))
    write_table(sub, path, fmt)
    return sub


def output_dir(base: str, sample_size: int | None) -> str:
    """Sample runs write under a separate ``rubbish`` subfolder."""
    return os.path.join(base, "rubbish") if sample_size is not None else base
