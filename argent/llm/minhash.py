"""Near-duplicate documents by b-bit MinHash."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from argent.llm.common import Hashes, add_columns, block_pairs, column, components, fixed_rows, map_groups
from argent.session import stored

#: Bits kept of each minimum, and standard deviations of the estimate by which
#: a candidate may fall short before it is dropped (the chance to lose a pair
#: at the threshold is a few in a million).
BITS, SLACK = 4, 4.5
#: Minima of the longer signatures of documents that share a bucket, and their bits.
LONG, LONG_BITS = 1024, 2
#: Rows of a block, and shingles of all its sets together.
BLOCK, SETS = 2048, 4_000_000


def shingle_set(text: str | None, words: int, hashes: Hashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams of a text; a shorter
    text is one shingle, one without words has none."""
    found = text.encode().lower().split() if text else []  # bytes.lower and split know ASCII only
    if not found:
        return np.zeros(0, np.uint64)
    x = hashes.of(found)
    n = max(1, len(x) - words + 1)
    h = np.full(n, min(len(x), words), np.uint64)
    for i in range(min(len(x), words)):
        h = (h ^ x[i:i + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return np.unique(h)


class Signer:
    """Minima of a set under ``rows * bands`` hash functions."""

    def __init__(self, bands: int, rows: int, seed: int):
        rng = np.random.default_rng(seed)
        k = bands * rows
        self.bands, self.rows = bands, rows
        self.a = rng.integers(0, 2**63, k, np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 2**63, k, np.uint64)
        self.hashes = Hashes()

    def minima(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(self.a), np.iinfo(np.uint64).max, np.uint64)
        for i in range(0, len(x), 1024):
            np.minimum(out, (x[i:i + 1024, None] * self.a + self.b).min(axis=0), out=out)
        return out

    def sign(self, x: np.ndarray) -> tuple[list[int], list[int]]:
        """(band hashes, packed low bits of the minima)."""
        m = self.minima(x)
        bands = [xxhash.xxh64_intdigest(row.tobytes(), i) for i, row in enumerate(m.reshape(self.bands, self.rows))]
        return np.array(bands, np.uint64).view(np.int64).tolist(), pack(m, BITS).tolist()


def pack(minima: np.ndarray, bits: int) -> np.ndarray:
    """The low ``bits`` bits of the (mixed) minima, packed in 64-bit words."""
    m = (minima ^ (minima >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    low = (m >> np.uint64(64 - bits)).reshape(-1, 64 // bits) << (np.arange(64 // bits, dtype=np.uint64) * np.uint64(bits))
    return np.bitwise_or.reduce(low, axis=1).view(np.int64)


def least_estimate(similarity: float, minima: int, bits: int) -> float:
    """The estimate that a pair of this similarity falls short of by SLACK
    standard deviations."""
    chance = 2.0 ** -bits
    agree = similarity * (1 - chance) + chance
    return similarity - SLACK * (agree * (1 - agree) / minima) ** 0.5 / (1 - chance)


def signatures(docs: DataFrame, id: str, text: str, words: int, bands: int, rows: int, seed: int) -> DataFrame:
    """(id, n, s1, s2: 128 hashed bits of the set, bands, sig) of every row."""
    def run(batch, s):
        out = []
        for t in column(batch, text):
            x = shingle_set(t, words, s.hashes)
            d = xxhash.xxh128_digest(x.tobytes())
            out.append((len(x), int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True),
                        *(s.sign(x) if len(x) else (None, None))))
        return [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())))]
    fields = [("n", "bigint"), ("s1", "bigint"), ("s2", "bigint"), ("bands", "array<bigint>"), ("sig", "array<bigint>")]
    return add_columns(docs.select(F.col(id).alias("id"), text), run, fields, lambda: Signer(bands, rows, seed)).drop(text)


def estimate(a: Column, b: Column, hashes: int) -> Column:
    """Similarity of two packed signatures by bit counts: a group of BITS bits
    differs if any of its bits does; equal ones count less the share of
    2**-BITS that agrees by chance."""
    def unequal(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        folded = reduce(lambda p, q: p.bitwiseOR(q), [F.shiftrightunsigned(d, i) for i in range(1, BITS)], d)
        return F.bit_count(folded.bitwiseAND(F.lit(int("1" * (64 // BITS), 1 << BITS))))
    same = 1 - F.aggregate(F.zip_with(a, b, unequal), F.lit(0), lambda acc, x: acc + x) / F.lit(float(hashes))
    return (same - 2.0 ** -BITS) / (1 - 2.0 ** -BITS)


def _across(rows: pa.Table, percent: int) -> pa.RecordBatch | None:
    """Links (a, b) between components, of two blocks of a bucket: a spanning
    forest of the pairs of near enough size and estimate that did not meet in
    an earlier band, each confirmed on the full sets.

    A pair is left out only while its ends are joined by links found already,
    so nothing is lost and there are fewer links than rows.
    """
    c = rows.column("c").to_numpy().copy()
    if (c == c[0]).all():
        return None
    s, i, j, n, ids = (rows.column(x).to_numpy() for x in ("_s", "_i", "_j", "n", "id"))
    left, right = np.flatnonzero(s == i[0]), np.flatnonzero(s == j[0])
    sig, bands, t = fixed_rows(rows, "long", np.int64).view(np.uint64), fixed_rows(rows, "bands", np.int64), int(rows.column("t")[0].as_py())
    least, ones = least_estimate(0.01 * percent, LONG, LONG_BITS), np.uint64(int("1" * (64 // LONG_BITS), 1 << LONG_BITS))
    sets = rows.column("x").combine_chunks()
    ends, flat = sets.offsets.to_numpy(), sets.values.to_numpy(zero_copy_only=False).view(np.uint64)
    found: list[tuple[int, int]] = []
    for a in left:
        b = right[(c[right] != c[a]) & (100 * np.minimum(n[right], n[a]) >= percent * np.maximum(n[right], n[a]))]
        if i[0] == j[0]:
            b = b[ids[b] > ids[a]]
        if not len(b):
            continue
        d = sig[b] ^ sig[a]
        for x in range(1, LONG_BITS):
            d |= d >> np.uint64(x)
        same = 1 - np.bitwise_count(d & ones).sum(axis=1) / LONG
        b = b[(same - 2.0 ** -LONG_BITS) / (1 - 2.0 ** -LONG_BITS) >= least]
        b = b[~(bands[b, :t] == bands[a, :t]).any(axis=1)]
        own = flat[ends[a]:ends[a + 1]]
        for k in b:
            if c[k] == c[a]:
                continue
            other = flat[ends[k]:ends[k + 1]]
            at = np.searchsorted(own, other)
            shared = int((own[np.minimum(at, len(own) - 1)] == other).sum())
            if 100 * shared >= percent * (len(own) + len(other) - shared):
                found.append((int(ids[a]), int(ids[k])))
                c[c == c[k]] = c[a]
    if not found:
        return None
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], names=["a", "b"])


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80,
                    bands: int = 32, rows: int = 4, star_rounds: int = 3, seed: int = 7) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row of ``docs``.

    Two documents are linked when their sets of ``words``-word shingles have
    100 * intersection >= ``percent`` * union; component_id is the smallest id
    reachable over links, itself included, and kept marks the one document of
    each component that stays. Texts without words are linked with nothing; a
    null id is linked with nothing and kept. Rows with one id are one document;
    if their texts differ, the one whose set has the smallest hash stands for
    them, in any order of rows, and n_shingles is each row's own. Texts are
    taken whole, of any length; the other columns of ``docs`` are not read, and
    an empty table gives an empty result.

    Equal sets are collapsed first, by a map-side combined minimum, so a group
    of copies is one member of its buckets. The minima of one document in each
    band make a bucket. Rounds of stars follow: within a bucket that holds more
    than one component, each member is paired with one member picked by hash,
    and goes on with the best of its pairs by the b-bit estimate; the pair is
    confirmed on the full sets, components are merged. Then all pairs that
    share a bucket and are still in different components are estimated, in
    pairs of blocks and by longer signatures (LONG minima, LONG_BITS bits each),
    in the first bucket that they share, and those near the threshold confirmed
    there; a task gives a spanning forest of the links it confirmed. So a large
    group of near copies is not expanded into its pairs, and no link between
    components stays untried.
    """
    k = bands * rows
    least = least_estimate(0.01 * percent, k, BITS)
    base = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    sign = stored(signatures(base, "id", "text", words, bands, rows, seed), "signatures")
    filled = sign.where("n > 0 and id is not null")
    first = filled.groupBy("id").agg(F.min("s1").alias("s1"), F.min_by("s2", "s1").alias("s2"))
    filled = filled.join(stored(first, "texts"), ["id", "s1", "s2"], "left_semi")
    classes = stored(filled.groupBy("s1", "s2").agg(F.min("id").alias("rep")), "classes")
    member = stored(filled.select("id", "s1", "s2").join(classes, ["s1", "s2"]).select("id", "rep").distinct(), "members")
    one = filled.join(classes.withColumnRenamed("rep", "id"), ["s1", "s2", "id"], "left_semi").dropDuplicates(["id"])

    shelf = one.select("id", F.posexplode("bands").alias("t", "bucket"))
    shared = stored(shelf.groupBy("bucket").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("bucket"), "buckets")
    rows_ = stored(shelf.join(shared, "bucket"), "shelves")
    ids = stored(rows_.select("id").distinct(), "candidates")
    signs = stored(one.join(ids, "id", "left_semi").select("id", "n", "s1", "s2", "sig", "bands"), "candidate-signatures")

    def sets(batch, s):
        x = [shingle_set(t, words, s.hashes) for t in column(batch, "text")]
        d = [xxhash.xxh128_digest(a.tobytes()) for a in x]
        return [pa.array([a.view(np.int64) for a in x], pa.list_(pa.int64())),
                pa.array([pack(s.minima(a), LONG_BITS) for a in x], pa.list_(pa.int64())),
                *[pa.array([int.from_bytes(b[k:k + 8], "big", signed=True) for b in d], pa.int64()) for k in (0, 8)]]
    full = add_columns(base.join(ids, "id", "left_semi"), sets, [("x", "array<bigint>"), ("long", "array<bigint>"), ("s1", "bigint"), ("s2", "bigint")],
                       lambda: Signer(1, LONG, seed + 1)).drop("text")
    full = stored(full.join(signs.select("id", "s1", "s2"), ["id", "s1", "s2"], "left_semi").select("id", "x", "long").dropDuplicates(["id"]), "sets")

    def side(df: DataFrame, name: str, *cols: str) -> DataFrame:
        return df.select(F.col("id").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in cols])

    def likely(pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) whose sizes allow the link and whose estimate is near it."""
        both = pairs.join(side(signs, "a", "n", "sig"), "a").join(side(signs, "b", "n", "sig"), "b")
        near = estimate(F.col("sig_a"), F.col("sig_b"), k)
        return (both.where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
                .select("a", "b", near.alias("near")).where(F.col("near") >= least))

    def confirmed(pairs: DataFrame) -> DataFrame:
        both = pairs.select("a", "b").join(side(full, "a", "x"), "a").join(side(full, "b", "x"), "b")
        shared_ = F.size(F.array_intersect("x_a", "x_b"))
        return both.where(100 * shared_ >= percent * (F.size("x_a") + F.size("x_b") - shared_)).select("a", "b")

    links, labels = None, None
    for r in range(star_rounds + 1):
        placed = rows_ if labels is None else rows_.join(side(labels, "id", "c").withColumnRenamed("c_id", "c"), "id", "left")
        placed = placed.select("bucket", "t", "id", F.coalesce(F.col("c"), F.col("id")).alias("c") if labels is not None else F.col("id").alias("c"))
        placed = stored(placed, "placed")
        mixed = stored(placed.groupBy("bucket").agg(F.min("c").alias("lo"), F.max("c").alias("hi"),
                                                    F.min_by("id", F.xxhash64("id", F.lit(r))).alias("b"),
                                                    F.min_by("c", F.xxhash64("id", F.lit(r))).alias("cb")).where("lo < hi"), "mixed")
        if mixed.isEmpty():
            break
        if r < star_rounds:
            pairs = placed.join(mixed, "bucket").where("c <> cb").select(F.col("id").alias("a"), "b").distinct()
            pairs = likely(pairs).groupBy("a").agg(F.max_by("b", F.struct("near", "b")).alias("b"))
            new = stored(confirmed(pairs), "links")
        else:
            open_ = stored(placed.join(mixed.select("bucket"), "bucket").join(signs.select("id", "n"), "id"), "open")
            # a block has at most BLOCK rows and SETS shingles, on average of its bucket
            size = F.ceil(F.greatest(F.count("*"), F.sum("n") * F.lit(BLOCK / SETS)))
            sizes = stored(open_.groupBy("bucket").agg(size.cast("bigint").alias("m")), "open-buckets")
            dealt = stored(block_pairs(open_, sizes, "bucket", "id", BLOCK), "open-blocks")
            dealt = dealt.join(signs.select("id", "bands"), "id").join(full, "id")
            new = stored(map_groups(dealt, ["bucket", "t", "_i", "_j"], lambda g: _across(g, percent), "a bigint, b bigint"), "links")
        links = new if links is None else links.unionByName(new)
        labels = components(links).select(F.col("v").alias("id"), F.col("component").alias("c"))
    if labels is not None:
        member = member.join(labels.withColumnRenamed("id", "rep"), "rep", "left").select("id", F.coalesce("c", "rep").alias("rep"))
    member = member.groupBy("id").agg(F.min("rep").alias("component_id"))
    out = sign.select("id", F.col("n").alias("n_shingles")).join(member, "id", "left")
    out = out.withColumn("component_id", F.coalesce("component_id", "id"))
    return out.select(F.col("id").alias(id), "n_shingles", "component_id", F.coalesce(F.col("component_id") == F.col("id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id: str = "doc_id", **options) -> DataFrame:
    """``docs`` with one document of each group of near duplicates."""
    verdict = near_duplicates(docs, id, **options).where("not kept").select(F.col(id).alias("_gone")).distinct()
    return docs.join(verdict, docs[id] == verdict["_gone"], "left_anti")
