"""Alignment of two tokenizers against a direct computation over whole texts."""

import base64
import hashlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
import tiktoken

from cohortforge.llm import align, queries
from cohortforge.llm.sparse import Rows

SF = "/root/testdata/sf0.001"
PATHS = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def brute(rows, kind="end"):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    a_of = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    b_of = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    names = {i: t for t, i in ranks.items()}
    done, count = [], Counter()
    for i, text in rows:
        want = (" " + (text or "")).encode()
        a, b = a_of.encode_ordinary(" " + text) if text else [], b_of.encode(text or "")
        bb = [bytes([int(p[3:-1], 16)]) if b_of.is_byte(x) else p.replace("▁", " ").encode() for x, p in ((x, b_of.id_to_piece(x)) for x in b)]
        aa = [names[x] for x in a]
        if not text or b"".join(aa) != want or b"".join(bb) != want:
            done.append((i, 0, 0, [], []))
            continue
        a_end, b_end = np.cumsum([len(x) for x in aa]).tolist(), np.cumsum([len(x) for x in bb]).tolist()
        shared = sorted(set(a_end) & set(b_end))
        groups, p, q = [], 0, 0
        links = []
        for e in shared:
            r, s = a_end.index(e, p) + 1, b_end.index(e, q) + 1
            groups.append((a[p:r], b[q:s]))
            if kind == "end":
                links.append((a[r - 1], b[s - 1]))
            for x in range(p, r):
                for y in range(q, s):
                    touch = min(a_end[x], b_end[y]) > max(a_end[x] - len(aa[x]), b_end[y] - len(bb[y]))
                    if kind == "group" or kind == "overlap" and touch:
                        links.append((a[x], b[y]))
            p, q = r, s
        count.update(links)
        done.append((i, len(a), len(b), groups, links))
    best = Counter()
    for (_, y), n in count.items():
        best[y] = max(best[y], n)
    out = []
    for i, na, nb, groups, links in done:
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out.append((i, na, nb, len(groups), len(links), sum(count[z] == best[z[1]] for z in links), sum(count[z] for z in links),
                    hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return Counter(out), count


def got(df):
    return Counter(tuple(r) for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", df.columns[-1]).collect())


def test_corpus(spark):
    rows = [(r.doc_id, r.text) for r in queries.documents(spark, SF).collect()]
    df = queries.QUERIES["op12_incidence_alignment"](spark, SF)
    assert df.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert got(df) == brute(rows)[0]


ODD = [(20, "a  b"), (21, " lead"), (22, "tail "), (23, "x\n\n y\t z"), (24, "▁ mark"), (25, "<s> </s> <unk> <0x41> <|endoftext|>"), (26, "ﬁ Ⅷ é 你好 😀 \x00 a"),
       (27, "it's we'll   don't"), (28, "one　two three "), (29, " "), (30, "   "), (31, "a\nb c\r\nd"), (32, "1234567 89"), (33, "﻿x é")]


@pytest.mark.parametrize("kind", align.KINDS)
def test_edges_and_blocks(docs_of, edge_rows, monkeypatch, kind):
    monkeypatch.setattr(align, "BLOCK_BYTES", 40)
    rows = edge_rows + ODD + ODD[:3] + [(40, "aaaa bbbb " * 2000)]
    docs = docs_of(rows, extra=True).selectExpr("*", "'x' AS `block`", "1 AS kind", "2 AS key", "3 AS at", "4 AS groups")
    want, count = brute(rows, kind)
    assert got(align.align(docs, *PATHS, kind=kind, digest=True)) == want
    pairs = align.pair_counts(docs, *PATHS, kind=kind).collect()
    assert {(r.a, r.b): r["count"] for r in pairs} == dict(count)
    empty = align.align(docs_of([]), *PATHS)
    assert empty.count() == 0 and empty.columns[-1] == "groups"


def test_products():
    rng = np.random.default_rng(3)
    for n, m, k in ((5, 7, 6), (40, 30, 50), (3, 1, 2)):
        x, y = rng.integers(0, 3, (n, m)) * (rng.random((n, m)) < .4), rng.integers(0, 3, (m, k)) * (rng.random((m, k)) < .4)
        def rows(z):
            i, j = np.nonzero(z)
            return Rows(np.concatenate([[0], np.cumsum(np.bincount(i, minlength=len(z)))]), j, z[i, j], z.shape[1])
        out = np.zeros((n, k), int)
        i, j, v = rows(x).product(rows(y))
        out[i, j] = v
        assert (out == x @ y).all()
        i, j, v = rows(y).transposed().product(rows(x).transposed())
        out = np.zeros((k, n), int)
        out[i, j] = v
        assert (out == (x @ y).T).all()
