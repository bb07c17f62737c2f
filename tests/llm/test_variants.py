"""Spelling variants against a brute force over all pairs of words."""

import re
import zlib
from collections import Counter

from cohortforge.llm import queries, variants

SF = "/root/testdata/sf0.001"


def brute_counts(rows):
    found = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def brute(words):
    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        if len(a) < len(b):
            a, b = b, a
        return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))

    out, form = {}, {}
    for w, n in words.items():
        close = [(-m, v) for v, m in words.items() if abs(len(v) - len(w)) < 2 and near(w, v)]
        best = min(close, default=None)
        form[w] = best[1] if best and -best[0] >= 5 * n else None
        out[w] = (n, len(close), form[w], words[form[w]] if form[w] else None)
    for w in out:
        root = w
        while form[root]:
            root = form[root]
        out[w] += (root,)
    return out


def got(df):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


def test_corpus(spark):
    rows = [(r.doc_id, r.text) for r in queries.documents(spark, SF).collect()]
    df = queries.QUERIES["op11_frequency_vector_trie"](spark, SF)
    assert dict(df.dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}
    found = got(df)
    assert found == brute(brute_counts(rows)) and df.count() == len(found)
    assert sum(v[2] is not None for v in found.values()) > 3


def test_chains_ties_and_hot_nodes(spark):
    words = {"abcdef": 5, "abcdeg": 25, "abcdeh": 25, "abcdefg": 125, "abcdefgh": 625, "zzzzzz": 9, "zzzzzzz": 9, "éàèùçâ": 7, "éàèùçä": 40, "abcdf": 300}
    words |= {"".join(p): 6 for p in __import__("itertools").permutations("opqrst")}        # one vector
    words |= {"opqrs" + c: 31 for c in "ab"}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    want = brute(words)
    assert got(variants.spelling_variants(df)) == want
    pairs = {(w, v) for w in words for v in words if variants.one_edit(w, v)}
    for nodes, searches in ((7, 5), (1, 1), (10_000, 10_000)):
        rows = variants.near_pairs(df, node_words=nodes, node_searches=searches).collect()
        assert len(rows) == len(pairs) and {(r.word, r.near) for r in rows} == pairs


def test_edges(spark, docs_of, edge_rows):
    rows = [r for r in edge_rows] + [(None, "Straßen "), (70, "Wörter×÷x " * 7), (71, "WÖRTER×÷X " * 9), (72, "worter " * 3 + "a" * 300_000)] + [(73, "Worter")] * 3
    docs = docs_of(rows, extra=True).selectExpr("*", "'x' AS word", "1 AS run", "2 AS node", "3 AS best", "4 AS h")
    counts = variants.word_counts(docs)
    assert {r.word: r.n for r in counts.collect()} == brute_counts(rows)
    assert got(variants.spelling_variants(counts)) == brute(brute_counts(rows))
    empty = variants.spelling_variants(variants.word_counts(docs_of([])))
    assert empty.count() == 0 and empty.columns == ["word", "form", "root", "n", "n_near", "form_n"]
