"""Queries over the corpus tables, one per operator, with SQL where it can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .align import align
from .bestfit import best_fit
from .exact_dedup import exact_dedup
from .language import detect, held_out, train
from .minhash_dedup import near_duplicates
from .pii import personal_data
from .quality import quality
from .secret_scan import findings
from .sharding import shard
from .spm import encode
from .substrings import drop_copied_passages
from .token_output import packed_ids
from .variants import spelling_variants, word_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql.strip()
        return fn
    return register


def vocabulary(name: str) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query("op1_bilstm_crf_pii")
def op1(spark, sf_dir):
    return personal_data(documents(spark, sf_dir))


@query("op2_script_viterbi_language")
def op2(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return detect(docs, train(docs.where(~held_out()))).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


@query("op3_packed_token_ids")
def op3(spark, sf_dir):
    return packed_ids(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"))


@query("op4_odd_sketch_dedup")
def op4(spark, sf_dir):
    return near_duplicates(documents(spark, sf_dir))


@query("op5_sum_of_squares_packing")
def op5(spark, sf_dir):
    return best_fit(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"))


@query("op6_n_best_sentencepiece")
def op6(spark, sf_dir):
    return encode(documents(spark, sf_dir), vocabulary("piece_bpe_32k.model")).select(
        "doc_id", F.transform("n_best", lambda x: x["score"]).alias("scores"),
        F.transform("n_best", lambda x: (F.octet_length(x["ids"]) / 4).cast("long")).alias("n_ids"),
        F.transform("n_best", lambda x: F.crc32(x["ids"])).alias("ids_crc32"), "round_trip")


@query("op7_histogram_sharding")
def op7(spark, sf_dir):
    return shard(documents(spark, sf_dir), n_shards=40)


@query("op8_exact_dedup", """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
""")
def op8(spark, sf_dir):
    return exact_dedup(documents(spark, sf_dir), keep="largest")


@query("op9_forest_secret_scan")
def op9(spark, sf_dir):
    spans = F.transform("secrets", lambda s: F.concat_ws(":", s["start"], s["end"]))
    return findings(documents(spark, sf_dir)).select(
        "doc_id", "n_candidates", F.size("secrets").cast("long").alias("n_secrets"), F.array_join(spans, ",").alias("spans"))


@query("op10_perplexity_bands")
def op10(spark, sf_dir):
    return quality(documents(spark, sf_dir))


@query("op11_frequency_vector_trie")
def op11(spark, sf_dir):
    return spelling_variants(word_counts(documents(spark, sf_dir)))


@query("op12_incidence_alignment")
def op12(spark, sf_dir):
    return align(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"), digest=True).withColumnRenamed("groups", "groups_sha256")


@query("op13_suffix_automata_dedup")
def op13(spark, sf_dir):
    return drop_copied_passages(documents(spark, sf_dir), digest=True).select("doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))
