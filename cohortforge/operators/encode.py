"""Category encoders.

Codes come from a *code table* ``(column, value, code)`` built in one pass
over the data: the distinct (column, value) pairs are found with a hash
aggregate (map-side combined, so a hot value is not a hot task) and numbered
with ``dense_rank`` per column.  The code table is the saved encoder; it is
applied with a join that is broadcast only when its row count is checked to
be small.  Values are sorted by code point, as text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortforge.functions.semantics import as_text
from cohortforge.operators.join import BROADCAST_ROWS, checked_broadcast, shared
from cohortforge.operators.rank import ordered_position
from cohortforge.session import checkpoint_dir

NULL_TOKEN = "NULL"   # missing category token of the plain label encoder
NAN_TOKEN = "nan"     # missing category token after a cast to text


def category_value(c: str, missing: str = NULL_TOKEN, as_string: bool = False) -> Column:
    """The category text of a column: cast if asked, missing -> token."""
    col = F.col(c)
    if as_string:
        return as_text(col, missing)
    return F.coalesce(col, F.lit(missing))


def code_table(df: DataFrame, cols: Sequence[str], missing: str = NULL_TOKEN,
               as_string: bool = False, cut: bool = False) -> DataFrame:
    """``(column, value, code)``: 0-based sorted code of every distinct value.

    ``cut`` writes the distinct values to the checkpoint folder now, for a
    ``df`` whose plan is long: the ranges read them several times.  They are
    counted, and up to ``BROADCAST_ROWS`` of them are numbered in one task.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"),
                               category_value(c, missing, as_string).cast("string").alias("value"))
                      for c in cols])
    distinct = df.select(F.inline(pairs)).distinct()
    distinct = _cut(distinct) if cut else shared(distinct)
    few = cut and distinct.count() <= BROADCAST_ROWS
    codes = ordered_position(distinct.coalesce(1) if few else distinct, ["column"], ["value"], "code", 1 if few else None)
    return codes.withColumn("code", F.col("code").cast("int"))


def _cut(df: DataFrame) -> DataFrame:
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def apply_codes(df: DataFrame, table: DataFrame, cols: Sequence[str], missing: str = NULL_TOKEN,
                as_string: bool = False,
                suffix: str = "", check_size: bool = False) -> DataFrame:
    """Replace each column by its code (or add ``col+suffix`` when ``suffix``)."""
    small = checked_broadcast(table) if check_size else shared(table)
    out = df
    for c in cols:
        t = (small.filter(F.col("column") == c)
                  .select(F.col("value").alias("__v"), F.col("code").alias("__code")))
        out = (out.withColumn("__key", category_value(c, missing, as_string).cast("string"))
                  .join(t, F.col("__key") == F.col("__v"), "left")
                  .withColumn(c + suffix, F.col("__code"))
                  .drop("__key", "__v", "__code"))
    if suffix == "":
        out = out.select(*df.columns)
    return out


def label_encode(df: DataFrame, cols: Sequence[str] | None = None, missing: str = NULL_TOKEN,
                 as_string: bool = False, check_size: bool = False):
    """Sorted label encoding of ``cols`` (default: all string columns).

    Returns ``(encoded_df, cols, code_table)``.
    """
    if cols is None:
        cols = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    cols = list(cols)
    if not cols:
        return df, cols, None
    table = code_table(df, cols, missing, as_string, cut=check_size)
    return apply_codes(df, table, cols, missing, as_string, check_size=check_size), cols, table


def two_valued_columns(df: DataFrame, cols: Sequence[str] | None = None) -> list[str]:
    """Columns with exactly two distinct values, a missing value counting as one.

    Least and greatest value first, then one pass that asks whether any value
    lies between them: no distinct count of identifiers or amounts.  Each
    pass leaves one row for the driver.
    """
    cols = list(cols or df.columns)
    if not cols:
        return []
    q = {c: F.col(f"`{c}`") for c in cols}
    row = df.agg(*[F.struct(F.min(q[c]), F.max(q[c]), F.max(q[c].isNull().cast("int"))) for c in cols]).first()
    ends = {c: row[i] for i, c in enumerate(cols)}
    one = [c for c in cols if ends[c][0] is not None and ends[c][0] == ends[c][1] and ends[c][2] == 1]
    two = [c for c in cols if ends[c][0] is not None and ends[c][0] != ends[c][1] and ends[c][2] == 0]
    if two:
        between = df.agg(*[F.max(((q[c] != F.lit(ends[c][0])) & (q[c] != F.lit(ends[c][1]))).cast("int")) for c in two]).first()
        two = [c for i, c in enumerate(two) if not between[i]]
    return [c for c in cols if c in one or c in two]


def encode_string_or_two_valued(df: DataFrame):
    """Label-encode, as text, the string columns and the two-valued columns."""
    strings = {f.name for f in df.schema.fields if f.dataType.typeName() == "string"}
    two = set(two_valued_columns(df, [c for c in df.columns if c not in strings]))
    cols = [c for c in df.columns if c in strings or c in two]
    out, cols, table = label_encode(df, cols, NAN_TOKEN, True, check_size=True)
    return out, cols, table


def factorize(df: DataFrame, cols: Sequence[str], order_cols: Sequence[str],
              check_size: bool = False) -> DataFrame:
    """Code by first appearance in ``order_cols`` order; missing -> -1.

    The first appearance of a value is ``min(struct(order_cols))`` over its
    rows; values are numbered by it (value itself breaks exact ties).
    """
    out = df
    for c in cols:
        first = (df.filter(F.col(c).isNotNull())
                   .groupBy(F.col(c).alias("__v"))
                   .agg(F.min(F.struct(*[F.col(o) for o in order_cols])).alias("__first")))
        first = first.withColumn("__o", F.col("__first")[order_cols[0]])
        first = _cut(first) if check_size else shared(first)
        codes = ordered_position(first, [], ["__o", "__first", "__v"], "__code").select("__v", F.col("__code").cast("int"))
        codes = checked_broadcast(codes) if check_size else shared(codes)
        out = (out.join(codes, F.col(c) == F.col("__v"), "left")
                  .withColumn(c, F.coalesce(F.col("__code"), F.lit(-1)))
                  .drop("__v", "__code"))
    return out.select(*df.columns)


def _indicators(c: str, values: Sequence, nan_as_category: bool) -> dict[str, Column]:
    """0/1 expressions of one column by their names: its values as sorted text, then the missing one."""
    q = F.col(f"`{c}`")
    out = {f"{c}_{v}": F.when(q == F.lit(v), 1).otherwise(0) for v in sorted(values, key=str)}
    if nan_as_category:
        out[f"{c}_nan"] = F.when(q.isNull(), 1).otherwise(0)
    return out


def _value_lists(df: DataFrame, cols: Sequence[str], max_values: int) -> dict[str, list | None]:
    """The distinct values of each column, or None for a column with more than ``max_values`` of them.

    One aggregate counts the distinct values of all columns as text, one row a
    column; the lists that are read on the driver are bounded by ``max_values``.
    """
    pairs = F.array(*[F.struct(F.lit(i).alias("c"), F.col(f"`{c}`").cast("string").alias("v")) for i, c in enumerate(cols)])
    distinct = df.select(F.inline(pairs)).filter("v IS NOT NULL").distinct()
    sizes = dict(distinct.groupBy("c").count().collect())
    small = [i for i in range(len(cols)) if sizes.get(i, 0) <= max_values]
    return {c: [r[0] for r in df.select(f"`{c}`").filter(F.col(f"`{c}`").isNotNull()).distinct().collect()] if i in small else None
            for i, c in enumerate(cols)}


def _text_columns(df: DataFrame, cols: Sequence[str] | None) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.typeName() == "string"] if cols is None else list(cols)


def one_hot(df: DataFrame, cols: Sequence[str] | None = None, nan_as_category: bool = True,
            max_values: int = 10_000):
    """One 0/1 column ``{col}_{value}`` per distinct value (sorted), plus
    ``{col}_nan`` when ``nan_as_category``.  The encoded columns are
    removed; new columns follow the kept ones.  Returns ``(df, new_cols)``.

    The value lists decide the output schema, so they are read on the
    driver; a column with more than ``max_values`` can't become columns and is
    an error here: ``one_hot_split`` takes it, in long form.
    """
    cols = _text_columns(df, cols)
    lists = _value_lists(df, cols, max_values) if cols else {}
    for c in cols:
        if lists[c] is None:
            raise ValueError(f"column {c} has more than {max_values} values: use one_hot_split")
    new = {n: e for c in cols for n, e in _indicators(c, lists[c], nan_as_category).items()}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in cols], *[e.alias(n) for n, e in new.items()]), list(new)


def one_hot_long(df: DataFrame, key: Sequence[str], cols: Sequence[str] | None = None, nan_as_category: bool = True) -> DataFrame:
    """The ones of a one-hot encoding as rows ``(key..., column, feature)``, for any number of values.

    ``feature`` is the name that the column would have.  A row with a missing
    value has the feature ``{col}_nan``, or none without ``nan_as_category``.
    Narrow: no value list, no shuffle.
    """
    key = list(key)
    cols = [c for c in _text_columns(df, cols) if c not in key]
    ones = F.array(*[F.struct(F.lit(c).alias("column"), F.concat(F.lit(f"{c}_"), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("nan") if nan_as_category else F.lit(None))).alias("feature"))
                     for c in cols])
    return df.select(*key, F.inline(ones)).filter(F.col("feature").isNotNull())


def one_hot_split(df: DataFrame, key: Sequence[str], cols: Sequence[str] | None = None, nan_as_category: bool = True,
                  max_values: int = 10_000):
    """``one_hot`` for the columns with up to ``max_values`` values, ``one_hot_long`` for the others.

    Returns ``(wide, new_cols, long)``; ``wide`` lacks the long columns, and
    ``long`` (None if no column is beyond the limit) meets it on ``key``.
    """
    cols = _text_columns(df, cols)
    lists = _value_lists(df, cols, max_values) if cols else {}
    beyond = [c for c in cols if lists[c] is None]
    new = {n: e for c in cols if c not in beyond for n, e in _indicators(c, lists[c], nan_as_category).items()}
    wide = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in cols], *[e.alias(n) for n, e in new.items()])
    return wide, list(new), one_hot_long(df, key, beyond, nan_as_category) if beyond else None


def save_codes(table: DataFrame, path: str) -> None:
    """Write an encoder's dictionary: one row per (column, value)."""
    table.select("column", "value", "code").write.mode("overwrite").parquet(path)


def load_codes(spark: SparkSession, path: str) -> DataFrame:
    """A saved dictionary; ``apply_codes`` gives NULL to values that it doesn't hold."""
    return spark.read.parquet(path)


def mode_codes(df: DataFrame, key: str, cols: Sequence[str], missing: str = NULL_TOKEN) -> DataFrame:
    """Per key, the sorted code of the modal category of each column, as text.

    Missing is the category ``missing``; ties go to the lowest code.  Rows are
    counted per (key, column, value), the codes come from the values of those
    counts, and the mode is the ``max`` of count and mirrored code in one
    long: hash aggregates with fixed-width buffers throughout.  A value that
    a third of all rows hold is combined before each shuffle, and the code
    table is joined to the counts, not to the rows.
    """
    cols = list(cols)
    pairs = F.array(*[F.struct(F.lit(i).alias("__c"), category_value(c, missing).cast("string").alias("__v")) for i, c in enumerate(cols)])
    counts = df.select(F.col(key), F.inline(pairs)).groupBy(key, "__c", "__v").agg(F.count(F.lit(1)).alias("__n"))
    table = shared(ordered_position(shared(counts.select("__c", "__v").distinct()), ["__c"], ["__v"], "__code"))
    mask = (1 << 31) - 1
    table = table.select(F.col("__c").alias("__tc"), F.col("__v").alias("__tv"), (F.lit(mask) - F.col("__code")).alias("__m"))
    joined = counts.filter(F.col(key).isNotNull()).join(table, (F.col("__c") == F.col("__tc")) & (F.col("__v") == F.col("__tv")))
    packed = F.col("__n") * (mask + 1) + F.col("__m")
    best = joined.groupBy(key).agg(*[F.max(F.when(F.col("__c") == i, packed)).alias(c) for i, c in enumerate(cols)])
    return best.select(key, *[(F.lit(mask) - F.col(c) % (mask + 1)).cast("string").alias(c) for c in cols])


def one_hot_label(label: str, n_classes: int = 2) -> Column:
    """Class label as a 0/1 array of length ``n_classes`` (for 2-way outputs)."""
    return F.array(*[F.when(F.col(label) == k, 1).otherwise(0) for k in range(n_classes)])
