"""Copied passages against a brute force over all windows."""

import hashlib
import random
import re
from collections import Counter

from cohortforge.llm import queries, substrings

SF = "/root/testdata/sf0.001"


def brute(rows, least=20):
    split = [(-1 if i is None else i, re.findall("[^\x20\x09-\x0d]+", t or "")) for i, t in rows]
    first = {}
    for i, w in split:
        for k in range(len(w) - least + 1):
            key = tuple(w[k:k + least])
            first[key] = min(first.get(key, (i, k)), (i, k))
    out = []
    for (i, w), (own, _) in zip(split, rows):
        gone = [False] * len(w)
        for k in range(len(w) - least + 1):
            if first[tuple(w[k:k + least])] < (i, k):
                gone[k:k + least] = [True] * least
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((own, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


def got(df):
    return Counter(tuple(r) for r in df.select("doc_id", "n_words", "n_removed", df.columns[-1]).collect())


def test_corpus(spark):
    rows = [(r.doc_id, r.text) for r in queries.documents(spark, SF).collect()]
    df = queries.QUERIES["op13_suffix_automata_dedup"](spark, SF)
    assert df.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    want = brute(rows)
    assert got(df) == want and sum(r[2] > 0 for r in want) > 5


def planted():
    pick = random.Random(4)
    vocabulary = [f"w{k}" for k in range(60)]
    text = lambda n: [pick.choice(vocabulary) for _ in range(n)]
    line, passage, exact = text(12), text(60), text(20)
    rows = []
    for i in range(120):
        w = text(pick.randint(0, 120))
        if i % 2:
            k = pick.randint(0, len(w))
            w[k:k] = line                           # a frequent line, shorter than a window
        if i % 5 == 0:
            k = pick.randint(0, len(w))
            w[k:k] = passage[pick.randint(0, 30):pick.randint(35, 60)]
        if i % 7 == 0:
            w += exact
        if i % 11 == 0:
            w += ["x"] * 50                         # repeats itself
        rows.append((i, pick.choice([" ", "\n", "\t "]).join(w)))
    return rows + [(200 + k, rows[k][1]) for k in range(0, 60, 3)] + [(3, rows[5][1]), (3, rows[5][1]), (None, rows[7][1]), (None, rows[8][1] + " " + rows[7][1])]


def test_planted(docs_of, edge_rows, monkeypatch):
    rows = planted() + edge_rows
    pick = random.Random(1)
    pick.shuffle(rows)
    docs = docs_of(rows, extra=True).selectExpr("*", "1 AS `block`", "2 AS anchor", "3 AS doc", "4 AS content", "5 AS words")
    want = brute(rows)
    monkeypatch.setattr(substrings, "BLOCK_BYTES", 20_000)
    assert got(substrings.drop_copied_passages(docs, digest=True)) == want
    # anchors taken apart, and shards of a few segments
    assert got(substrings.drop_copied_passages(docs, digest=True, shard_words=500, anchor_segments=3)) == want


def test_output_and_other_lengths(docs_of):
    rows = planted()
    for least in (3, 11):
        out = substrings.drop_copied_passages(docs_of(rows), least=least).collect()
        texts = Counter((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in out)
        assert texts == brute(rows, least) and all(r.n_removed == sum(s.end - s.start for s in r.removed) for r in out)
    empty = substrings.drop_copied_passages(docs_of([]))
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_words", "n_removed", "removed", "kept"]


def test_automaton():
    pick = random.Random(2)
    for _ in range(50):
        texts = [[pick.choice("abc") for _ in range(pick.randint(0, 30))] for _ in range(5)]
        a = substrings.Automaton()
        for d, t in enumerate(texts):
            a.begin()
            for k, w in enumerate(t):
                a.extend(w, (d, k))
        for t in texts + [[pick.choice("abc") for _ in range(30)]]:
            for least in (1, 3, 5):
                for k, e in enumerate(a.statistics(t, least)):
                    key = t[max(0, k + 1 - least):k + 1]
                    places = [(d, j) for d, s in enumerate(texts) for j in range(least - 1, len(s)) if s[j + 1 - least:j + 1] == key]
                    assert e == (min(places) if len(key) == least and places else None)


def test_written_tables_hold_passages_in_few_bytes(spark, tmp_path):
    """Texts and passages are most of what op13 keeps on disk."""
    import glob
    import os
    import random
    from cohortforge.llm.common import written
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("etaoinshr") for _ in range(rng.randrange(2, 9))) for _ in range(3000)]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(400))) for i in range(300)]
    df = spark.createDataFrame(rows, "k long, text string").coalesce(1)
    df.write.option("compression", "snappy").parquet(plain := str(tmp_path / "plain"))
    kept = written(df)
    size = lambda files: sum(os.path.getsize(f.replace("file://", "").replace("file:", "")) for f in files)
    assert size(kept.inputFiles()) < 0.8 * size(glob.glob(f"{plain}/*.parquet"))
    assert sorted(map(tuple, kept.collect())) == rows
