"""The corpus pipeline: quality rules, exact and near deduplication, secrets, packing.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before
it kept; its result is written as Parquet and read back as the next one's
documents.  All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortforge.llm.bestfit import best_fit
from cohortforge.llm.common import unused
from cohortforge.llm.exact_dedup import drop_copies
from cohortforge.llm.minhash_dedup import drop_near_duplicates
from cohortforge.llm.quality import filter_quality
from cohortforge.llm.queries import vocabulary
from cohortforge.llm.secret_scan import redact
from cohortforge.session import checkpoint_dir


SIMILAR = 80            # per cent of the shingles, for the near copies


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the surface rules or the perplexity bands reject go."""
    return filter_quality(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the largest id stays."""
    return drop_copies(docs, keep="largest")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents, the smallest id stays."""
    return drop_near_duplicates(docs, percent=SIMILAR)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by a mark; ``n_chars`` follows the text."""
    old = unused(docs, "_old")
    after = redact(docs.withColumn(old, F.col("text")))
    changed = ~F.col("text").eqNullSafe(F.col(old))
    return after.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*[F.col(f"`{c}`") for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of 2048: one row per piece."""
    return best_fit(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [("quality rules", quality_rules), ("exact dedup", exact_copies), ("near dedup", near_copies),
          ("secret scan", secrets), ("best-fit packing", packing)]

# perplexity, links, votes and packing are beyond SQL: the tests hold each stage against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``; between them, Parquet in the shared checkpoint folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for n, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{n}")
        docs = spark.read.parquet(f"{folder}/{n}")
    return docs
