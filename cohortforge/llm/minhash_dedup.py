"""Near-duplicate groups: banded MinHash candidates, odd-sketch estimates, exact confirmation.

A text is the set of its distinct 5-word shingles.  Rows with the same set form
one class; all later work is on classes.

1. Each set gets 168 MinHash samples.  Bands of samples give candidate buckets,
   as many as it takes for a pair at the threshold to share none with
   probability 2e-6: 28 of 6 samples for 0.85, 33 of 5 for 0.80.
2. The samples are folded into an odd sketch: every (position, sample) flips
   one of 1024 bits.  The population count of the XOR of two sketches gives
   the number of differing samples, precisely so for high similarities; pairs
   far below the threshold (over 5 standard deviations) are dropped.  A second
   bitmap of the whole set bounds the number of differing shingles from below,
   which rules out nearly all others of short texts, for certain.
3. The rest is confirmed on the full shingle sets, and only that decides.

No bucket's pairs are enumerated.  First every member is compared with one
member of each of its buckets (another one in each band), at most one pair a
band per class whatever the bucket's size.  Their confirmed links give components.
What is left are buckets that still hold several components.  In one of up to
32 members, whatever is outside the largest component is compared with all
others.  The members of larger ones are joined by their rarest shingles: two
linked sets share one among the rarest 15 % of each, early enough to leave room
for the overlap that a link needs.  This is exact, and members with shingles of
their own meet nobody.  Both ways cover every candidate pair that could still
join two components, so no connection is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, frozen, mix, steps, text_hash, utf8, windows, without, words
from .components import components

SHINGLE = 5
SAMPLES = 168
MISS = 2.5e-6           # most probability that a pair at the threshold shares no bucket
BITS = 1024
DEVIATIONS = 5.45       # of the estimate at the threshold: 0.15 for 0.85
NO_ID = 2**63 - 1       # a null id: after all others
SMALL = 32              # members of a bucket that are compared one by one
BROADCAST_IDS = 2_000_000   # at most 32 MB
NARROW = 100_000        # rows of a checkpoint file: of a few numbers each,
SETS = 2_000            # or of a set each

_rng = np.random.default_rng(168)
_XOR = _rng.integers(0, 2**32, (SAMPLES, 1), dtype=np.uint32)
_ODD = _rng.integers(0, 2**32, (SAMPLES, 1), dtype=np.uint32) | np.uint32(1)
_SLOT = _rng.integers(0, 2**64, SAMPLES, dtype=np.uint64)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """For each row the sorted hashes of its distinct shingles (A-Z lower-cased)."""
    _, _, hashes, first = words(LOWER[data], offsets)
    runs = windows(hashes, SHINGLE)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= SHINGLE:
            yield np.unique(runs[a:b - SHINGLE + 1])
        elif b > a:
            yield windows(hashes[a:b], b - a) + np.uint64(b - a)
        else:
            yield np.zeros(0, np.uint64)


def minhash(shingles: np.ndarray) -> np.ndarray:
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    best = np.full(SAMPLES, 2**32 - 1, np.uint32)
    for i in range(0, len(low), 1024):
        np.minimum(best, ((low[None, i:i + 1024] ^ _XOR) * _ODD).min(axis=1), out=best)
    return best


def banding(percent: int) -> tuple[int, int]:
    """(bands, samples in each): the longest bands that miss a pair at the threshold with probability ``MISS`` at most."""
    for rows in range(SAMPLES, 1, -1):
        if (1 - (percent / 100) ** rows) ** (SAMPLES // rows) <= MISS:
            return SAMPLES // rows, rows
    return SAMPLES, 1


def least_size(percent: int) -> int:
    """The size of the smallest set that can be similar enough to a different one: n of n + 1 shingles."""
    return -(-100 // (100 - percent)) - 1 if percent < 100 else NO_ID


def band_keys(sample: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = sample[:bands * rows].astype(np.uint64).reshape(bands, rows)
    key = np.arange(bands, dtype=np.uint64) + np.uint64(1)
    for i in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, i])
    return key.view(np.int64)


def parity(hashes: np.ndarray) -> np.ndarray:
    """The parity bitmap of some hashes, as 64-bit words."""
    odd = (np.bincount((hashes % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def odd_sketch(sample: np.ndarray) -> np.ndarray:
    """The parity bitmap of the samples with their positions."""
    return parity(mix(sample.astype(np.uint64) ^ _SLOT))


def identity(shingles: np.ndarray) -> tuple[int, int]:
    """Two order-free 64-bit hashes of a set."""
    one = mix(shingles)
    return int(one.sum(dtype=np.uint64).view(np.int64)), int(np.bitwise_xor.reduce(mix(one + np.uint64(1))).view(np.int64)) if len(one) else 0


def _identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)).alias("_id"),
                       F.col(f"`{text_col}`").cast("string").alias("_text"), text_hash(F.col(f"`{text_col}`")).alias("_hash"))


def _lists(rows: list[np.ndarray]) -> pa.Array:
    cuts = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64)))


def signatures(rows: DataFrame, percent: int) -> DataFrame:
    """(``_id``, ``_hash``, ``n``, ``s1``, ``s2``, ``bands``, ``sketch``, ``whole``) of rows (``_id``, ``_text``, ``_hash``).

    ``sketch``: of the samples; ``whole``: of all shingles.

    Sets below ``least_size`` can't be similar enough to a different set: no bands.
    """
    layout, least = banding(percent), least_size(percent)
    none = np.zeros(0, np.int64)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in steps(offsets):
                n, ids, keys, sketches, wholes = [], [], [], [], []
                for s in shingle_sets(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]):
                    n.append(len(s))
                    ids.append(identity(s))
                    sample = minhash(s) if len(s) >= least else None
                    keys.append(none if sample is None else band_keys(sample, *layout))
                    sketches.append(none if sample is None else odd_sketch(sample))
                    wholes.append(none if sample is None else parity(mix(s)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array(n, pa.int64()), pa.array([x[0] for x in ids], pa.int64()),
                     pa.array([x[1] for x in ids], pa.int64()), _lists(keys), _lists(sketches), _lists(wholes)],
                    names=["_id", "_hash", "n", "s1", "s2", "bands", "sketch", "whole"])

    return rows.mapInArrow(sign, "_id long, _hash long, n long, s1 long, s2 long, bands array<long>, sketch array<long>, whole array<long>")


def full_sets(rows: DataFrame) -> DataFrame:
    """(``s1``, ``s2``, ``n``, ``members``) of rows (``_id``, ``_text``)."""
    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in steps(offsets):
                sets = list(shingle_sets(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]))
                ids = [identity(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[0] for x in ids], pa.int64()), pa.array([x[1] for x in ids], pa.int64()),
                     pa.array([len(s) for s in sets], pa.int64()), _lists([s.view(np.int64) for s in sets])],
                    names=["s1", "s2", "n", "members"])

    return rows.mapInArrow(expand, "s1 long, s2 long, n long, members array<long>")


def differing(x: Column, y: Column) -> Column:
    """The population count of the XOR of two sketches."""
    return F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda t, d: t + d)


def estimate(x: Column, y: Column) -> Column:
    """The similarity of two sets from their odd sketches."""
    return 1 + (BITS / (4 * SAMPLES)) * F.log(F.greatest(F.lit(1e-9), 1 - 2 * differing(x, y) / BITS))


def margin(percent: int) -> float:
    return DEVIATIONS * (percent / 100 * (1 - percent / 100) / SAMPLES) ** 0.5


def _few_differ(percent: int) -> Column:
    """Whether x and y may differ in as few shingles as a link allows.

    Exact: no bit differs without a shingle that does.
    """
    return differing(F.col("x.whole"), F.col("y.whole")) * (100 + percent) <= (100 - percent) * (F.col("x.n") + F.col("y.n"))


def _likely(percent: int) -> Column:
    """Whether classes x and y may be similar enough: by their sizes and whole sketches (exact), then by their samples'."""
    return ((100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n")) & _few_differ(percent)
            & (estimate(F.col("x.sketch"), F.col("y.sketch")) >= percent / 100 - margin(percent)))


def sets_of(some: DataFrame, most: int, classes: DataFrame, rows: DataFrame) -> DataFrame:
    """(``class``, ``members``): the full sets of the classes in ``some`` (``class``, distinct, ``most`` at most)."""
    some = frozen(some, most, NARROW)
    wanted = frozen(classes.select("class", "label", "s1", "s2", "n").join(some, "class"), some.count(), NARROW)
    ids, n = wanted.select(F.col("label").alias("_id")).distinct(), wanted.count()
    if n <= BROADCAST_IDS:     # 16 bytes each; beyond that, a shuffled join
        ids = F.broadcast(ids)
    return frozen(full_sets(rows.join(ids, "_id", "left_semi")).join(wanted.select("class", "s1", "s2", "n"), ["s1", "s2", "n"])
                  .groupBy("class").agg(F.first("members").alias("members")), n, SETS)


def confirm(pairs: DataFrame, classes: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``; frozen) of classes whose full sets are similar enough."""
    n = pairs.count()
    ends = pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class"))).distinct()
    sets = sets_of(ends, 2 * n, classes, rows)
    both = (pairs.join(sets.select(F.col("class").alias("a"), F.col("members").alias("_x")), "a")
            .join(sets.select(F.col("class").alias("b"), F.col("members").alias("_y")), "b"))
    common = F.size(F.array_intersect("_x", "_y"))
    return frozen(both.where(100 * common >= percent * (F.size("_x") + F.size("_y") - common)).select("a", "b"), n)


def rare_prefix_pairs(sets: DataFrame, percent: int) -> tuple[DataFrame, int]:
    """All pairs (``a``, ``b``) of different roots that may be similar enough; ``sets``: ``class``, ``root``, ``members``, ``whole``.

    In the order of frequency, rarest first, two sets that are similar enough
    share a shingle within the first n - ceil(percent * n / 100) + 1 of each,
    and what follows their first common one leaves room for the overlap needed.
    The number: of (class, shingle) rows that are joined.
    """
    total = sets.agg(F.sum(F.size("members"))).first()[0] or 0
    shingles = sets.select("class", "root", F.size("members").alias("n"), F.explode("members").alias("t"))
    often = shingles.groupBy("t").agg(F.count(F.lit(1)).alias("f"))
    place = F.row_number().over(Window.partitionBy("class").orderBy("f", "t"))
    prefix = frozen(shingles.join(often, "t").withColumn("i", place)
                    .where((F.col("i") <= F.col("n") - F.ceil(percent * F.col("n") / 100) + 1) & (F.col("f") > 1)).drop("f"), total, NARROW)
    n = prefix.count()
    mixed = prefix.groupBy("t").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("t")
    prefix = prefix.join(mixed, "t").join(sets.select("class", "whole"), "class")
    room = 1 + F.least(F.col("x.n") - F.col("x.i"), F.col("y.n") - F.col("y.i"))
    pairs = (prefix.alias("x").join(prefix.alias("y"), (F.col("x.t") == F.col("y.t")) & (F.col("x.class") < F.col("y.class"))
                                    & (F.col("x.root") != F.col("y.root"))
                                    & (100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n"))
                                    & (room * (100 + percent) >= percent * (F.col("x.n") + F.col("y.n"))) & _few_differ(percent))
             .select(F.col("x.class").alias("a"), F.col("y.class").alias("b")).distinct())
    return pairs, n


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85) -> DataFrame:
    """One row per input row: id, ``n_shingles``, ``component_id``, ``kept``.

    Two rows are linked when 100 * |intersection| >= ``percent`` * |union| of
    their sets of distinct 5-word shingles (ASCII case folded; fewer than five
    words: the whole sequence as one).  ``component_id`` is the smallest id
    reachable over links, ``kept`` whether that is the row's own.  A null or
    empty text has no shingles and is linked with nothing.  A null id comes
    after all others; a component of null ids has a null ``component_id``.
    Rows that repeat are of one class and get the same result.  Other columns
    are not read.  An empty table gives an empty result.
    """
    return _grouped(docs, id_col, text_col, percent)[0].drop("_hash")


def _grouped(docs: DataFrame, id_col: str, text_col: str, percent: int) -> tuple[DataFrame, int]:
    """``near_duplicates`` with the text's hash, and the number of rows."""
    rows = _identified(docs, id_col, text_col)
    signed = frozen(signatures(rows, percent))
    n_rows = signed.count()
    classes = frozen(signed.where("n > 0").groupBy("s1", "s2", "n").agg(
        F.min("_id").alias("label"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"),
        F.first("whole").alias("whole"))
        .withColumn("class", F.monotonically_increasing_id()), n_rows)
    of_class = classes.select("class", "n", "sketch", "whole")

    def matched(pairs: DataFrame) -> DataFrame:
        return (pairs.join(of_class.select(F.struct("class", "n", "sketch", "whole").alias("x")), F.col("a") == F.col("x.class"))
                .join(of_class.select(F.struct("class", "n", "sketch", "whole").alias("y")), F.col("b") == F.col("y.class"))
                .where(_likely(percent)).select("a", "b"))

    def joined_with(links: DataFrame, roots: DataFrame) -> DataFrame:
        if links.isEmpty():
            return roots
        edges = links.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))     # stars already
        return components(edges, rows=edges.count())

    entries = classes.select("class", F.explode("bands").alias("key"))
    # one member per bucket, another one in each band: the smallest class number XOR key
    buckets = (entries.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min(F.col("class").bitwiseXOR(F.col("key"))).alias("p"))
               .where("m > 1").select("key", "m", F.col("p").bitwiseXOR(F.col("key")).alias("pivot")))
    shared = frozen(entries.join(buckets, "key"), banding(percent)[0] * n_rows, NARROW)
    n_shared = shared.count()
    star = (shared.where("class != pivot")
            .select(F.least("class", "pivot").alias("a"), F.greatest("class", "pivot").alias("b")).distinct())
    tried = frozen(matched(star), n_shared)
    links = confirm(tried, classes, rows, percent)
    roots = components(links, rows=links.count())

    # buckets of three or more that still hold several components
    member = (shared.where("m > 2").select("key", "m", "class")
              .join(roots.select(F.col("node").alias("class"), "root"), "class", "left")
              .withColumn("root", F.coalesce("root", "class")))
    sizes = member.groupBy("key", "root").agg(F.count(F.lit(1)).alias("c"))
    open_buckets = sizes.groupBy("key").agg(F.count(F.lit(1)).alias("k"), F.max_by("root", F.struct("c", "root")).alias("largest")).where("k > 1")
    member = frozen(member.join(open_buckets.select("key", "largest"), "key"), n_shared, NARROW)
    small = member.where(F.col("m") <= SMALL).join(of_class, "class")
    x = small.where("root != largest").alias("x")
    near = (x.join(small.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.root") != F.col("y.root")) & _likely(percent))
            .select(F.least("x.class", "y.class").alias("a"), F.greatest("x.class", "y.class").alias("b")))
    size = member.count()
    large = member.where(F.col("m") > SMALL)
    if not large.isEmpty():
        large = frozen(large.select("class", "root").distinct(), n_shared, NARROW)
        sets = sets_of(large.select("class"), large.count(), classes, rows).join(large, "class").join(of_class.select("class", "whole"), "class")
        pairs, n = rare_prefix_pairs(frozen(sets, large.count(), SETS), percent)
        near, size = near.unionByName(pairs), size + n
    rest = frozen(near.distinct().join(tried, ["a", "b"], "left_anti"), size)
    joined = joined_with(confirm(rest, classes, rows, percent), roots)

    labels = (classes.select("class", "s1", "s2", "n", "label")
              .join(joined.select(F.col("node").alias("class"), "root"), "class", "left")
              .withColumn("root", F.coalesce("root", "class")))
    lowest = labels.groupBy("root").agg(F.min("label").alias("component_id"))
    found = labels.join(lowest, "root").select("s1", "s2", "n", "component_id")
    out = signed.select("_id", "_hash", "s1", "s2", "n").join(found, ["s1", "s2", "n"], "left")
    component = F.coalesce("component_id", "_id")
    return out.coalesce(1 + n_rows // 10_000).select(F.nullif(F.col("_id"), F.lit(NO_ID)).alias(id_col), F.col("n").alias("n_shingles"),
                      F.nullif(component, F.lit(NO_ID)).alias("component_id"), (component == F.col("_id")).alias("kept"), "_hash"), n_rows


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85) -> DataFrame:
    """``docs`` without the rows that are linked to a smaller id, all columns as they were."""
    found, n = _grouped(docs, id_col, text_col, percent)
    return without(docs, found.where("not kept").select(F.col(f"`{id_col}`").alias("_id"), "_hash"), id_col, text_col, n)
