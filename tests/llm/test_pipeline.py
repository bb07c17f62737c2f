"""The corpus pipeline: each stage against brute force on its own input."""

import re

import corpus_pipeline
import __spark_entry__ as E
from cohortforge.llm import minhash_dedup, quality

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "exact dedup", "near dedup", "secret scan", "best-fit packing"]
    seen = {r.doc_id: r for r in docs.collect()}
    want = {r.doc_id for r in quality.quality(docs).where("kept").collect()}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF).cache()
        if name == "quality rules":
            assert {r.doc_id for r in docs.collect()} == want
        elif name == "exact dedup":
            best = {}
            for r in before.collect():
                best[r.text or ""] = max(best.get(r.text or "", -1), r.doc_id)
            assert sorted(r.doc_id for r in docs.collect()) == sorted(best.values())
        elif name == "near dedup":
            kept = minhash_dedup.near_duplicates(before, percent=corpus_pipeline.SIMILAR).where("kept").collect()
            assert sorted(r.doc_id for r in docs.collect()) == sorted(r.doc_id for r in kept)
        elif name == "secret scan":
            for r in docs.collect():
                old = seen[r.doc_id]
                text = re.sub(r'(?i)(token = ")[0-9a-f]{40}"', r'\1[SECRET]"', old.text)
                assert r.text == text and (r.n_chars == old.n_chars if text == old.text else r.n_chars == len(text))
        if name != "best-fit packing":
            assert docs.columns == before.columns
    assert docs.select("doc_id").distinct().count() == before.count()
    assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(docs.columns)


def test_registered():
    names = E.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert "op8_exact_dedup" in E.oracle_sql() and corpus_pipeline.ORACLE_SQL is None
