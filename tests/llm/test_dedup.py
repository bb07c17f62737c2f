"""Exact and near deduplication against brute force."""

import hashlib
import random
from collections import Counter
from collections import defaultdict

import pytest

from cohortforge.llm import minhash_dedup
from cohortforge.llm.components import components
from cohortforge.llm.exact_dedup import drop_copies, exact_dedup
from cohortforge.llm.minhash_dedup import drop_near_duplicates, near_duplicates


@pytest.mark.parametrize("keep,runs,radix", [("largest", 64, 4), ("smallest", 1, 16)])
def test_exact_dedup(spark, docs_of, edge_rows, keep, runs, radix):
    rows = edge_rows + [(100 + i, f"text {i % 7}") for i in range(60)] + [(200 + i, "hot") for i in range(80)]
    got = exact_dedup(docs_of(rows, extra=True), keep=keep, n_runs=runs, radix=radix).collect()
    assert len(got) == len(rows)
    groups = defaultdict(list)
    for i, t in rows:
        groups[hashlib.sha256((t or "").encode()).hexdigest()].append(i)
    for r in got:
        ids = [i for i in groups[r.text_sha256] if i is not None]
        assert r.keep_id == (max(ids) if keep == "largest" else min(ids)) and r.group_size == len(groups[r.text_sha256])
    kept = [(r.doc_id, r.text_sha256) for r in got if r.kept]
    assert len(kept) == len(groups) == len(set(kept)) and all(r.doc_id == r.keep_id for r in got if r.kept)


def test_drop_copies_keeps_rows_as_they_were(docs_of, edge_rows):
    docs = docs_of(edge_rows, extra=True)
    out = drop_copies(docs, keep="largest")
    assert out.columns == docs.columns
    rows = out.collect()
    assert len(rows) == len({t or "" for _, t in edge_rows})
    assert sorted(r.doc_id for r in rows) == [2, 3, 5, 6, 7, 8, 9]


def test_empty_tables(docs_of):
    none = docs_of([])
    assert exact_dedup(none).count() == 0 and near_duplicates(none).count() == 0
    assert drop_copies(none).count() == 0 and drop_near_duplicates(none).count() == 0


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    assert got == {x: find(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute(rows, percent=85):
    sets = []
    for _, t in rows:
        w = (t or "").translate({c: c + 32 for c in range(65, 91)})
        for c in "\t\n\x0b\x0c\r":
            w = w.replace(c, " ")
        w = [x for x in w.split(" ") if x]
        sets.append(frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)]) if w else frozenset())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [(d, len(sets[i]), low.get(find(i), d)) for i, (d, _) in enumerate(rows)]


@pytest.mark.parametrize("small", [32, 3])
def test_near_duplicates_of_a_large_family(docs_of, edge_rows, monkeypatch, small):
    monkeypatch.setattr(minhash_dedup, "SMALL", small)      # 3: nearly all buckets go the exact way
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(400)]
    rows = list(edge_rows)
    n = 1000
    for family, size, edits in ((120, 160, 6), (60, 40, 3), (200, 12, 10)):
        base = [rng.choice(vocabulary) for _ in range(family)]
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randrange(edits)):
                k = rng.randrange(len(w))
                w[k:k + 1] = rng.choice([[], [rng.choice(vocabulary)], [w[k], rng.choice(vocabulary)], [w[k].upper()]])
            rows.append((n, " ".join(w)))
            n += 1
    for i in range(40):
        rows.append((n + i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 60)))))
    got = [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs_of(rows, extra=True)).collect()]
    want = [(d, k, c, c == d) for d, k, c in brute(rows)]
    order = lambda x: tuple(-1 if v is None else v for v in x)
    assert sorted(got, key=order) == sorted([w if w[0] is not None else (*w[:3], False) for w in want], key=order)


def near_pairs():
    """Pairs of texts that share 4 of 5, 5 of 6 and 8 of 10 shingles, and pairs just below 0.8."""
    rows, n = [], 10
    for size, shared in ((8, 8), (9, 9), (7, 7), (12, 12), (52, 52), (52, 47), (30, 27)):
        for k in range(12):
            w = [f"p{size}x{shared}x{k}x{i}" for i in range(size)]
            rows += [(n, " ".join(w)), (n + 1, " ".join(w[:shared] + [f"q{n}x{i}" for i in range(max(1, size - shared))]))]
            n += 2
    return rows


def test_near_duplicates_at_80_per_cent(docs_of, edge_rows):
    rows = edge_rows + near_pairs()
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in near_duplicates(docs_of(rows), percent=80).collect())
    assert got == Counter(brute(rows, 80)) and brute(rows, 80) != brute(rows, 85)
    assert minhash_dedup.banding(85) == (28, 6) and minhash_dedup.least_size(85) == 6
    assert minhash_dedup.banding(80) == (33, 5) and minhash_dedup.least_size(80) == 4


def test_near_copies_of_the_pipeline(spark, docs_of):
    import corpus_pipeline
    rows = near_pairs()
    out = corpus_pipeline.near_copies(spark, docs_of(rows), "")
    assert sorted(r.doc_id for r in out.collect()) == sorted(d for d, _, c in brute(rows, 80) if d == c)


def test_drop_near_duplicates(docs_of):
    base = " ".join(f"w{i}" for i in range(100))
    docs = docs_of([(3, base), (4, base + " more"), (5, "other " * 30), (6, None)], extra=True)
    out = drop_near_duplicates(docs)
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == [3, 5, 6]


def test_sketch_estimates():
    import numpy as np
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 2**63, 4000, dtype=np.uint64)
    for same in (3000, 2000, 3800):
        x, y = np.unique(pool[:same + (4000 - same) // 2]), np.unique(np.concatenate([pool[:same], pool[same + (4000 - same) // 2:]]))
        a, b = (np.unpackbits(minhash_dedup.odd_sketch(minhash_dedup.minhash(s)).view(np.uint8)) for s in (x, y))
        differ = int((a ^ b).sum())
        estimate = 1 + minhash_dedup.BITS / (4 * minhash_dedup.SAMPLES) * np.log(1 - 2 * differ / minhash_dedup.BITS)
        true = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
        assert abs(estimate - true) < 0.15
