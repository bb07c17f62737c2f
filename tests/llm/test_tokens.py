"""Tokens, packing, segmentation and sharding: exact round trips and brute force."""

import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cohortforge.llm import bestfit, token_output, tokens
from cohortforge.llm.sharding import shard
from cohortforge.llm.spm import Pieces, decode, encode
from cohortforge.llm.tokens import Encoder, cuts

BPE = public_tokenizers.path("byte_bpe_50k.json")
SPM = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def rows(edge_rows):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghé") for _ in range(rng.randrange(1, 9)))
    return edge_rows + [(1000 + i, " ".join(word() for _ in range(rng.choice([3, 30, 300, 900])))) for i in range(60)]


def reference_ids(texts):
    t = Tokenizer.from_file(BPE)
    t.encode_special_tokens = True
    return [np.array(e.ids, "<u4").tobytes() for e in t.encode_batch(texts, add_special_tokens=False)]


def test_encoder_equals_the_tokenizer():
    rng = random.Random(2)
    texts = ["", "  ", " a", "a ", "a  b\n\n c", "<|endoftext|> hi", "a\0b c", "it's  they'll\r\n ok", "漢字 かな", "x y z", "1234 ٣٤"]
    texts += ["".join(rng.choice("ab \n\t'.s1é!漢 ") for _ in range(rng.randrange(60))) for _ in range(2000)]
    encoder = Encoder(BPE)
    assert encoder.chunked and encoder.fast
    assert encoder.ids(texts) == encoder.ids(texts) == reference_ids(texts)
    encoder.fast = None
    encoder.cache.clear()
    assert encoder.ids(texts) == reference_ids(texts)


def test_operators_give_the_ids_of_an_untouched_tokenizer(docs_of):
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>y", " it's  <|endoftext|>\n ok", "a\0<|endoftext|>", "<|endoftext|", "plain text"]
    want = [np.array(e.ids, "<u4").tobytes() for e in Tokenizer.from_file(BPE).encode_batch(texts, add_special_tokens=False)]
    assert np.frombuffer(want[0], "<u4").tolist() == [64, 220, 50256, 275]
    assert tokens.encoder(BPE).ids(texts * 2) == want * 2
    docs = docs_of(list(enumerate(texts)))
    for r in bestfit.best_fit(docs, BPE).collect():
        ids = want[r.doc_id] + b"\0\0\0\0"        # the end of a document
        assert (r.start, 4 * r.length, r.ids_crc32) == (0, len(ids), zlib.crc32(ids))
    for r in token_output.packed_ids(docs, BPE, width=512).collect():
        row = np.frombuffer(bytes(r.ids), "<u4")
        for k, d in enumerate(r.doc_ids):
            assert row[r.cu_seqlens[k]:r.cu_seqlens[k + 1]].tobytes() == want[d] + np.array([token_output.END_ID], "<u4").tobytes()


def test_cuts():
    assert cuts(5, 5) == [(0, 5)] and cuts(0, 5) == [] and cuts(12, 5) == [(0, 2), (2, 5), (7, 5)] and cuts(10, 5) == [(0, 5), (5, 5)]


def test_sum_of_squares_rule():
    rng = np.random.default_rng(4)
    capacity = 24
    packer = bestfit.Packer(capacity)
    gaps = []
    for size in rng.integers(1, capacity + 1, 400).tolist():
        def squares(g):
            return sum(c * c for c in np.bincount(g, minlength=1)[1:].tolist()) if g else 0
        best = min([squares([x for j, x in enumerate(gaps) if j != i] + [g - size]) for i, g in enumerate(gaps) if g >= size] + [squares(gaps + [capacity - size])])
        sequence, offset = packer.place(size)
        if sequence == len(gaps):
            gaps.append(capacity)
        assert gaps[sequence] == capacity - offset >= size
        gaps[sequence] -= size
        assert squares(gaps) == best


def test_best_fit(docs_of, rows):
    got = bestfit.best_fit(docs_of(rows, extra=True), BPE, group=40).collect()
    ids = defaultdict(list)
    for (i, _), x in zip(rows, reference_ids([t or "" for _, t in rows])):
        ids[i].append(x + b"\0\0\0\0")
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 2048
    assert set(pieces) == set(ids)
    for i, copies in ids.items():
        x = copies[0]
        assert len(pieces[i]) == len(copies) * len(cuts(len(x) // 4, 2048))
        for r in pieces[i]:
            assert (r.start, r.length) == cuts(len(x) // 4, 2048)[r.piece]
            assert r.ids_crc32 in {zlib.crc32(c[4 * r.start:4 * (r.start + r.length)]) for c in copies}
    least = -(-sum(r.length for r in got) // 2048)
    assert len(sequences) <= least + 4 * 2       # two more per group at most
    assert bestfit.best_fit(docs_of([]), BPE).count() == 0


def test_capacity_tree_is_best_fit_decreasing():
    rng = random.Random(1)
    lengths = [rng.randrange(1, 33) for _ in range(300)]
    free = []
    for n in sorted(lengths, reverse=True):
        fits = [f for f in free if f >= n]
        if fits:
            free.remove(min(fits))
            free.append(min(fits) - n)
        else:
            free.append(32 - n)
    got = token_output.best_fit_decreasing(lengths, 32)
    assert sorted(i for s in got for i in s) == list(range(300))
    assert sorted(32 - sum(lengths[i] for i in s) for s in got) == sorted(free)


def test_packed_ids_give_the_documents_back(docs_of, rows):
    docs = docs_of([r for r in rows if r[0] is not None and r[0] != 5], extra=True)
    got = token_output.packed_ids(docs, BPE, width=512, block=5000).collect()
    parts = defaultdict(list)
    for r in got:
        row = np.frombuffer(bytes(r.ids), "<u4")
        assert len(row) == 512 and r.cu_seqlens[0] == 0 and len(r.doc_ids) == len(r.starts) == len(r.cu_seqlens) - 1
        assert r.position_resets == (r.cu_seqlens if r.cu_seqlens[-1] < 512 else r.cu_seqlens[:-1])
        assert (row[r.cu_seqlens[-1]:] == token_output.END_ID).all()
        for k, (d, s) in enumerate(zip(r.doc_ids, r.starts)):
            parts[d].append((s, row[r.cu_seqlens[k]:r.cu_seqlens[k + 1]].tobytes()))
    assert len({(r.block, r.row) for r in got}) == len(got)
    some = [r for r in rows if r[0] is not None and r[0] != 5]
    for (i, _), x in zip(some, reference_ids([t or "" for _, t in some])):
        assert b"".join(b for _, b in sorted(parts.pop(i))) == x + np.array([token_output.END_ID], "<u4").tobytes()
    assert not parts and token_output.packed_ids(docs_of([]), BPE).count() == 0


def brute_segmentations(v, chunk):
    out = []

    def go(i, score):
        if i == len(chunk):
            out.append(score)
            return
        for j in range(i + 1, len(chunk) + 1):
            known = v.scores.get(chunk[i:j])
            if known or j == i + 1:
                go(j, score + (known[0] if known else v._own(chunk[i])))
    go(0, 0.0)
    return sorted(out, reverse=True)


def test_n_best_segmentations():
    v = Pieces(SPM, 3)
    chunks = [" the", " token", " éàü", " a.b,c", " ▁x", " \U0001f600b", " aaaaaa", " 漢字", "\n", " of\tit", " streets"]
    for c in chunks:
        want = brute_segmentations(v, c)[:3]
        total, ids = v.search_all([c])
        assert [s for s, _ in v.search(c)] == want == [t for t in total[0].tolist() if t > -np.inf]
        assert len(set(ids[:len(want)])) == len(want) and all(v.decode(b) == c[1:] or c == "\n" for b in ids[:len(want)])
    for text in ["ab cd ef", "the of to", "a  b", " x ", "one\ntwo", "x"]:
        parts = [p for p in " ".join([""] + [text]).replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0") if p]
        every = sorted((sum(x) for x in itertools.product(*[brute_segmentations(v, p) for p in parts])), reverse=True)
        got = v.encode([text])[0]
        assert [s for s, _ in got] == every[:3] and all(v.decode(b) == text for _, b in got)


def test_encode_round_trips(docs_of, rows):
    out = encode(docs_of(rows, extra=True), SPM).cache()
    assert out.count() == len(rows) and out.where("not round_trip").count() == 0
    scores = [[x.score for x in r.n_best] for r in out.collect()]
    assert all(s == sorted(s, reverse=True) for s in scores)
    texts = {r.doc_id: r.text for r in decode(out.selectExpr("doc_id", "n_best[size(n_best) - 1].ids AS ids"), SPM).collect()}
    assert all(texts[i] == (t or "") for i, t in rows)
    assert encode(docs_of([]), SPM).count() == 0


def test_runs_of_spaces_against_all_segmentations_of_the_file(docs_of):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=SPM)
    normal = [i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    score = {sp.id_to_piece(i).replace("▁", " "): (sp.get_score(i), i) for i in normal}
    own = min(s for s, _ in score.values()) - 10.0

    def best(text):
        """The three best over the whole text, by dynamic programming over all pieces of the file."""
        ways = [[(0.0, ())]]
        for j in range(1, len(text) + 1):
            found = []
            for i in range(j):
                known = score.get(text[i:j])
                if known:
                    found += [(s + known[0], ids + (known[1],)) for s, ids in ways[i]]
                elif i == j - 1:
                    raw = text[i].encode()
                    found += [(s + own * len(raw), ids + tuple(sp.piece_to_id(f"<0x{b:02X}>") for b in raw)) for s, ids in ways[i]]
            ways.append(sorted(found, reverse=True)[:3])
        return ways[-1]

    texts = ["a b", "a  b", "a   b", "a" + " " * 8 + "b c", " " * 8 + "return x", "a   ", "   ", " x ", "a  \n    b\n", "a\0   b", " " * 37 + "end", "no run here",
             "x" + " " * 60 + "y", "word      é!  漢"]
    rows = {r.doc_id: r.n_best for r in encode(docs_of(list(enumerate(texts))), SPM).collect()}
    for i, t in enumerate(texts):
        want = best(" " + t)
        assert [x.score for x in rows[i]] == [s for s, _ in want], t
        got = [tuple(np.frombuffer(bytes(x.ids), "<u4").tolist()) for x in rows[i]]
        assert len(set(got)) == len(got), t
        assert all(sum(score[p][0] if (p := sp.id_to_piece(k).replace("▁", " ")) in score else own for k in ids) == x.score for ids, x in zip(got, rows[i])), t
        if [s for s, _ in want].count(want[0][0]) == 1:
            assert got[0] == want[0][1], t


@pytest.mark.parametrize("hot", [False, True])
def test_shards(docs_of, rows, hot):
    rng = random.Random(9)
    rows = rows + [(rng.randrange(-2**62, 2**62), "z" * rng.randrange(300)) for _ in range(400)]
    if hot:
        rows = rows + [(77, "same id " + str(i % 3)) for i in range(900)]
    got = shard(docs_of(rows, extra=True), n_shards=8).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.size, r.text_crc32) for r in got) == sorted(
        (-1 if i is None else i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    sizes, slots = defaultdict(int), defaultdict(list)
    for r in got:
        sizes[r.shard] += r.size
        slots[r.shard].append((r.slot, -2**63 if r.doc_id is None else r.doc_id))
    largest = max(r.size for r in got)
    mean = sum(sizes.values()) / 8
    assert all(abs(s - mean) <= largest + mean / 1000 for s in sizes.values()) and set(sizes) <= set(range(8))
    for s in slots.values():
        assert sorted(x for x, _ in s) == list(range(len(s))) and [i for _, i in sorted(s)] == sorted(i for _, i in s)
    assert shard(docs_of([])).count() == 0
