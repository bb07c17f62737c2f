"""Exact deduplication as a tree merge of digest runs.

Every row becomes (digest, id).  Rows are dealt into ``radix**levels`` runs by
a hash of their id; each run keeps one entry per digest.  Runs then meet in
groups of ``radix`` per round: one shuffle brings the runs of a group together,
split by digest, and merges their entries, so that a digest that a third of
all rows share shrinks to one entry per run before anything is exchanged and
to ``radix`` entries per merge after that.  The winners travel back down the
same tree; a run's rows look only at their own run's entry, which spreads the
rows of a hot digest over all runs.

An entry is keyed by SHA-256, an independent 64-bit hash and the byte length:
all three must agree for two texts to count as equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import frozen, partitions, text_hash, unused, without

RADIX = 16
KEY = ("_sha", "_hash", "_len")


def digest_columns(text: Column) -> dict[str, Column]:
    raw = F.coalesce(text, F.lit("")).cast("binary")
    return {"_sha": F.unhex(F.sha2(raw, 256)), "_hash": F.xxhash64(raw), "_len": F.octet_length(raw)}


def levels_for(n_runs: int, radix: int = RADIX) -> int:
    n, levels = radix, 1
    while n < n_runs:
        n, levels = n * radix, levels + 1
    return levels


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
                n_runs: int | None = None, radix: int = RADIX) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when identical; a null text counts as empty.  ``keep`` says
    whether the smallest or the largest id of a group stays.  Null ids lose
    against others.  When rows repeat with the same id and the same text, all
    count in ``group_size`` and exactly one of them is kept.  Other columns of
    ``docs`` are not read, whatever their names.  An empty table gives an empty
    result.
    """
    return _winners(docs, id_col, text_col, keep, n_runs, radix).drop("_hash_of_text")


def _winners(docs: DataFrame, id_col: str, text_col: str, keep: str, n_runs: int | None = None, radix: int = RADIX) -> DataFrame:
    """``exact_dedup`` with ``text_hash`` of the text as it is."""
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep must be 'smallest' or 'largest', not {keep!r}")
    best = F.min if keep == "smallest" else F.max
    levels = levels_for(n_runs or partitions(docs.sparkSession), radix)
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), text_hash(text).alias("_hash_of_text"),
                       *[c.alias(n) for n, c in digest_columns(text).items()])
    # the texts are read and hashed once; all rounds work on the digests
    rows = frozen(rows.withColumn("_run", F.pmod(F.xxhash64("_id", F.lit("run")), F.lit(radix ** levels))))

    up = [rows.groupBy("_run", *KEY).agg(best("_id").alias("_keep"), F.count(F.lit(1)).alias("_n"))]
    for _ in range(levels):
        up.append(up[-1].withColumn("_run", F.floor(F.col("_run") / radix))
                  .groupBy("_run", *KEY).agg(best("_keep").alias("_keep"), F.sum("_n").alias("_n")))

    down = up[-1]
    for level in range(levels - 1, -1, -1):
        children = up[level].select("_run", *KEY, F.floor(F.col("_run") / radix).alias("_parent"))
        winners = down.select(F.col("_run").alias("_parent"), *KEY, "_keep", "_n")
        down = children.join(winners, ["_parent", *KEY]).select("_run", *KEY, "_keep", "_n")

    out = rows.join(down, ["_run", *KEY])
    # rows of one id lie in one run, so this window needs no further shuffle
    place = F.row_number().over(Window.partitionBy("_run", *KEY, "_id").orderBy(F.lit(1)))
    return out.select(
        F.col("_id").alias(id_col), F.col("_keep").alias("keep_id"), F.col("_n").alias("group_size"),
        (F.col("_id").eqNullSafe(F.col("_keep")) & (place == 1)).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"), "_hash_of_text")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they were.

    Rows that repeat an id with the same text are gathered by themselves, and
    one of them stays.  A null and an empty text are equal.
    """
    found = _winners(docs, id_col, text_col, keep).select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.col("_hash_of_text").alias("_hash"), "kept")
    keys = frozen(found.groupBy("_id", "_hash").agg(F.count(F.lit(1)).alias("n"), F.max("kept").alias("kept")))
    once = without(docs, keys.where("not kept or n > 1"), id_col, text_col)
    if keys.where("kept and n > 1").isEmpty():
        return once
    hashed, number = unused(docs, "_hash_"), unused(docs, "_place_")
    repeated = without(docs, keys.where("not kept or n = 1"), id_col, text_col).withColumn(hashed, text_hash(F.col(f"`{text_col}`")))
    place = F.row_number().over(Window.partitionBy(f"`{id_col}`", hashed).orderBy(F.lit(1)))
    return once.unionByName(repeated.withColumn(number, place).where(F.col(number) == 1).drop(number, hashed))
