"""Spelling variants: words of a vocabulary that differ by one code point, and the usual form of each.

A word's letters fall into groups by their code points, first into ``COARSE``
groups and then, within those, into ``FINE`` ones, and a word is written as
the vector of its counts per group.  One inserted, deleted or replaced code
point changes the coarse counts, and likewise the fine ones, by one surplus
letter, one missing letter, or one of each.  A trie holds the words by the
successive counts of their vectors; a depth-first search from a word may take
one branch with a surplus and one with a deficit among the coarse counts and
as much among the fine ones, and every word of a leaf that it reaches is
verified letter by letter.

The trie is spread over the tasks.  Its upper levels are the key by which
words and searches meet: as many levels as leave ``NODE_WORDS`` words or fewer
below each node.  A search goes to its own node and to those that its budget
can reach upwards (the pairs downwards are found from the other word), and
takes what is left of the budget along.  A node with more words than that
(equal in all counts) is cut into blocks that every search of it visits, and a
node with more than ``NODE_SEARCHES`` searches is repeated for blocks of them,
so that a task's memory and its share of a hot node are bounded.  No task and
no driver holds the vocabulary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import frozen, partitions

COARSE, FINE = 4, 12    # a letter's group is its code point modulo these; a fine group lies in one coarse group
NODE_WORDS = 16384
NODE_SEARCHES = 1 << 16
RATIO = 5               # a form is at least this many times as frequent
LEAST, OFTEN = 6, 5     # code points and occurrences of a word
DAMAGE = 199

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, often: int = OFTEN,
                damage: int | None = DAMAGE) -> DataFrame:
    """(``word``, ``n``): runs of Latin letters of at least ``least`` code points, A-Z lower-cased, with ``often`` occurrences or more.

    ``damage``: a run loses one code point where the CRC-32 of its document's
    id, a colon and itself is a multiple of this (null: never); the CRC-32
    modulo the run's length says which.  A null id counts as an empty one.
    Runs are counted after that.  Null and empty texts have no runs.
    """
    run = F.col("run")
    # greedy from its first letter on, a match of the least length or more is a maximal run
    runs = docs.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.explode(F.regexp_extract_all(
        F.col(f"`{text_col}`").cast("string"), F.lit(f"[A-Za-zÀ-ÿ]{{{least},}}"), F.lit(0))).alias("run"))
    runs = runs.select("id", F.when(run.rlike("[A-Z]"), F.translate(run, _UPPER, _LOWER)).otherwise(run).alias("run"))
    if damage:
        h = F.crc32(F.concat(F.coalesce("id", F.lit("")), F.lit(":"), run))
        at = (F.col("h") % F.length(run)).cast("int")
        lost = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
        runs = runs.withColumn("h", h).select(F.when(F.col("h") % damage == 0, lost).otherwise(run).alias("run"))
    return (runs.groupBy(run.alias("word")).agg(F.count(F.lit(1)).alias("n"))
            .where((F.col("n") >= often) & (F.length("word") >= least)))


LEVELS = FINE           # the fine counts of the last groups follow from the coarse ones


def group_counts(word: str) -> list[int]:
    """How many letters of each coarse group a word has, then of each fine group but those that follow from them."""
    coarse, fine = [0] * COARSE, [0] * FINE
    for c in map(ord, word):
        coarse[c % COARSE] += 1
        fine[c % FINE] += 1
    return coarse + fine[:FINE - COARSE]


def parities(word: str) -> tuple[int, int]:
    """One bit per letter (code point modulo 61), and one per pair of neighbours, set if the word has it an odd number of times.

    One edit turns at most two of the letters' bits and four of the pairs'.
    """
    letters = pairs = before = 0
    for c in map(ord, word):
        letters ^= 1 << c % 61
        if before:
            pairs ^= 1 << (before * 31 + c) % 61
        before = c
    return letters, pairs


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        words = b.column(0).to_pylist()
        both = [parities(w) for w in words]
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array([group_counts(w) for w in words], pa.list_(pa.int32())),
                                          pa.array([x for x, _ in both], pa.int64()), pa.array([x for _, x in both], pa.int64())],
                                         names=["word", "n", "vec", "letters", "pairs"])


def _changes(depth: int) -> list[tuple[list[int], int, int]]:
    """(change of the upper counts, surplus and deficit that are left) of all ways through them, in order of the changes."""
    def layer(n: int) -> list[tuple[list[int], int, int]]:
        return [([(i == up) - (i == down) for i in range(n)], int(up < 0), int(down < 0))
                for up in range(-1, n) for down in range(-1, n) if up < 0 or up != down]

    if depth < COARSE:
        return sorted(layer(depth))
    return sorted((a + b, more, less) for a, _, _ in layer(COARSE) for b, more, less in layer(depth - COARSE))


def one_edit(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced code point makes ``a`` into ``b``."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) < len(b):
        a, b = b, a
    for i, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return a[i + 1:] == b[i + (len(a) == len(b)):]
    return True


class Leaf:
    """Words with equal counts."""

    def __init__(self):
        self.words, self.n, self.letters, self.pairs, self.arrays = [], [], [], [], None

    def add(self, word: str, n: int, letters: int, pairs: int) -> None:
        self.words.append(word)
        self.n.append(n)
        self.letters.append(letters)
        self.pairs.append(pairs)

    def packed(self) -> tuple[np.ndarray, np.ndarray]:
        if self.arrays is None:
            self.arrays = np.array(self.letters), np.array(self.pairs)
        return self.arrays


def _leaves(trie, rest: list[int], surplus: int, deficit: int) -> list[Leaf]:
    """Depth-first, all leaves within the budget; the fine counts begin with a new one."""
    levels, fine, found = len(rest), len(rest) - (LEVELS - COARSE), []
    stack = [(trie, 0, surplus, deficit)]
    while stack:
        node, level, more, less = stack.pop()
        if level == levels:
            found.append(node)
            continue
        if level == fine:
            more = less = 1
        c = rest[level]
        if c in node:
            stack.append((node[c], level + 1, more, less))
        if more and c + 1 in node:
            stack.append((node[c + 1], level + 1, 0, less))
        if less and c - 1 in node:
            stack.append((node[c - 1], level + 1, more, 0))
    return found


def _verified(searching: Leaf, leaves: list[Leaf]) -> Iterator[tuple[str, int, str, int]]:
    """(word, n, near, near_n): the pairs of a searching word and a leaf's word that are one edit apart."""
    words, n = [w for x in leaves for w in x.words], [m for x in leaves for m in x.n]
    letters, pairs = (np.concatenate(x) for x in zip(*(x.packed() for x in leaves)))
    own_letters, own_pairs = searching.packed()
    step = max(1, 1_000_000 // len(words))
    for a in range(0, len(own_letters), step):
        near = np.bitwise_count(own_letters[a:a + step, None] ^ letters) < 3
        near &= np.bitwise_count(own_pairs[a:a + step, None] ^ pairs) < 5
        for i, j in zip(*(x.tolist() for x in np.nonzero(near))):
            if one_edit(searching.words[a + i], words[j]):
                yield searching.words[a + i], searching.n[a + i], words[j], n[j]


SEARCHED_AT_ONCE = 1024


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come cell by cell, a cell's words before its searches, and words with equal counts side by side.

    One search serves up to ``SEARCHED_AT_ONCE`` words with equal counts.  Pairs leave in both orders.
    """
    cell = trie = place = None
    waiting = Leaf()
    out: list[tuple] = []

    def batch() -> pa.RecordBatch:
        columns = [list(c) for c in zip(*out)] or [[], [], []]
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int64())],
                                          names=["word", "near", "near_n"])

    def search() -> None:
        own, surplus, deficit = map(int, place[1:4])
        leaves = [x for x in _leaves(trie, [int(x) for x in place[4:].split(",") if x], surplus, deficit) if x.words]
        if leaves:
            for word, n, w, m in _verified(waiting, leaves):
                if not own or w < word:         # within a node both words search
                    out.extend([(word, w, m), (w, word, n)])

    def add_to_trie(*row) -> None:
        rest = place[4:].split(",") if place[4:] else []
        at = trie
        for level, c in enumerate(rest):
            at = at.setdefault(int(c), {} if level + 1 < len(rest) else Leaf())
        at.add(*row)

    for b in batches:
        for here, spot, *row in zip(*(c.to_pylist() for c in b.columns)):
            if waiting.words and (here != cell or spot != place or len(waiting.words) == SEARCHED_AT_ONCE):
                search()
                waiting = Leaf()
            if here != cell:
                cell, trie = here, ({} if spot[4:] else Leaf())
            place = spot
            if spot[0] == "0":
                add_to_trie(*row)
            else:
                waiting.add(*row)
        if len(out) >= 10_000:
            yield batch()
    if waiting.words:
        search()
    yield batch()


def near_pairs(words: DataFrame, node_words: int = NODE_WORDS, node_searches: int = NODE_SEARCHES) -> DataFrame:
    """(``word``, ``near``, ``near_n``) for every ordered pair of different words one edit apart; ``words``: distinct ``word`` with ``n``."""
    words = frozen(words.select("word", F.col("n").cast("long")).mapInArrow(_signed, "word string, n long, vec array<int>, letters long, pairs long"))
    leaves = frozen(words.groupBy("vec").agg(F.count(F.lit(1)).alias("c")))
    depth = 1
    while depth < LEVELS and (leaves.groupBy(F.slice("vec", 1, depth)).agg(F.sum("c").alias("c")).agg(F.max("c")).first()[0] or 0) > node_words:
        depth += 1
    upper, rest = F.slice("vec", 1, depth), F.slice("vec", depth + 1, LEVELS).alias("rest")
    changes = [c for c in _changes(depth) if c[0] >= [0] * depth]
    literal = F.explode(F.expr("array(" + ", ".join(
        f"named_struct('d', array({', '.join(map(str, d))}), 'own', {int(not any(d))}, 'surplus', {more}, 'deficit', {less})" for d, more, less in changes) + ")"))
    moved = F.zip_with("node", F.col("c.d"), lambda x, y: x + y).alias("node")
    nodes = leaves.groupBy(upper.alias("node")).agg(F.sum("c").alias("c"))
    visits = nodes.select("node", F.col("c").alias("w"), literal.alias("c")).select(moved, "w").groupBy("node").agg(F.sum("w").alias("q"))
    load = frozen(nodes.join(visits, "node").select("node", F.ceil(F.col("c") / node_words).cast("int").alias("w"),
                                                    F.ceil(F.col("q") / node_searches).cast("int").alias("q")))
    own, signs = F.xxhash64("word"), ["word", "n", "letters", "pairs"]

    def text(array: Column) -> Column:
        return F.concat_ws(",", array.cast("array<string>"))

    index = words.select(upper.alias("node"), rest, *signs).join(load, "node").select(
        "node", F.pmod(own, F.col("w")).alias("wb"), F.explode(F.sequence(F.lit(0), F.col("q") - 1)).alias("qb"),
        F.concat(F.lit("0000"), text(F.col("rest"))).alias("place"), *signs)
    searches = words.select(upper.alias("node"), rest, *signs, literal.alias("c")).select(moved, "rest", "c", *signs)
    searches = searches.join(load, "node").select(
        "node", F.explode(F.sequence(F.lit(0), F.col("w") - 1)).alias("wb"), F.pmod(own, F.col("q")).alias("qb"),
        F.concat(F.lit("1"), F.col("c.own"), F.col("c.surplus"), F.col("c.deficit"), text(F.col("rest"))).alias("place"), *signs)
    cells = index.unionByName(searches).select(F.concat_ws(" ", text(F.col("node")), F.col("wb").cast("string"), F.col("qb").cast("string")).alias("cell"), "place", *signs)
    cells = cells.repartition(partitions(words.sparkSession), "cell").sortWithinPartitions("cell", "place")
    return cells.mapInArrow(_meet, "word string, near string, near_n long")


def roots(links: DataFrame) -> DataFrame:
    """(``word``, ``root``) from (``word``, ``form``): the last word of each chain, by doubling the steps.

    A form is more frequent than its word, so there are no cycles, and with
    ``RATIO`` a chain is no longer than the logarithm of the largest count.
    """
    links = frozen(links.select("word", F.col("form").alias("root")))
    while True:
        hop = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = frozen(links.join(hop, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("went")))
        if not links.where("went").limit(1).count():
            return links.select("word", "root")
        links = links.drop("went")


def spelling_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """One row per word of ``words`` (distinct ``word``, count ``n``): ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    Near words differ by exactly one inserted, deleted or replaced code point;
    ``n_near`` counts them.  ``form`` is the most frequent one (ties: the
    smallest in code-point order) if it occurs at least ``ratio`` times as
    often as the word, else null, and ``form_n`` its count.  ``root`` follows
    the forms to the last; a word without a form is its own root.  Columns
    other than ``word`` and ``n`` are not read.  An empty table gives an empty
    result.
    """
    words = frozen(words.select("word", "n"))
    best = near_pairs(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("w"))).alias("best"))
    usual = -F.col("best.n") >= ratio * F.col("n")
    found = frozen(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(usual, F.col("best.w")).alias("form"), F.when(usual, -F.col("best.n")).alias("form_n")))
    ends = roots(found.where("form is not null"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), F.col("n").cast("long").alias("n"), "n_near", "form_n")
