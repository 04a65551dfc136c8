"""Hard negatives: Strassen products of integer tiles and mergeable heaps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from argent.llm.common import add_columns, fixed_rows, map_groups
from argent.session import stored

#: Rows of a block of anchors and of a block of candidates that meet in a task; rows of a tile.
ANCHORS, CANDIDATES, TILE = 2048, 8192, 1024
#: The recursion ends where a side of a tile is at most LEAF.
LEAF = 16
#: Squared lengths stay below this, so that scores and 100 times a score are exact in 64 bits.
MOST = 1 << 56
NONE = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of two int64 matrices by Strassen's recursion.

    Sides are padded with zeros to a multiple of two halves at each level; a
    level ends the recursion when one side is at most ``leaf``. Sums and
    products are taken in 64-bit integers, whose overflow in between cancels,
    so the result is exact if it fits in 64 bits.
    """
    n, k = a.shape
    m = b.shape[1]
    if min(n, k, m) <= leaf:
        return a @ b
    if n % 2 or k % 2 or m % 2:
        pa_, pb = np.zeros((n + n % 2, k + k % 2), np.int64), np.zeros((k + k % 2, m + m % 2), np.int64)
        pa_[:n, :k], pb[:k, :m] = a, b
        return strassen(pa_, pb, leaf)[:n, :m]
    n, k, m = n // 2, k // 2, m // 2
    a11, a12, a21, a22 = a[:n, :k], a[:n, k:], a[n:, :k], a[n:, k:]
    b11, b12, b21, b22 = b[:k, :m], b[:k, m:], b[k:, :m], b[k:, m:]
    c = np.empty((2 * n, 2 * m), np.int64)
    c11, c12, c21, c22 = c[:n, :m], c[:n, m:], c[n:, :m], c[n:, m:]
    p = strassen(a11 + a22, b11 + b22, leaf)
    c11[:], c22[:] = p, p
    p = strassen(a21 + a22, b11, leaf)
    c21[:] = p
    c22 -= p
    p = strassen(a11, b12 - b22, leaf)
    c12[:] = p
    c22 += p
    p = strassen(a22, b21 - b11, leaf)
    c11 += p
    c21 += p
    p = strassen(a11 + a12, b22, leaf)
    c11 -= p
    c12 += p
    c22 += strassen(a21 - a11, b11 + b12, leaf)
    c11 += strassen(a12 - a22, b21 + b22, leaf)
    return c


class Heaps:
    """The best ``size`` (score, id) of each of ``rows`` rows: higher scores
    first, then smaller ids. Heaps of parts of the candidates merge into the
    heaps of all."""

    def __init__(self, rows: int, size: int):
        self.size = size
        self.score = np.full((rows, size), NONE, np.int64)
        self.id = np.full((rows, size), np.iinfo(np.int64).max, np.int64)

    def merge(self, score: np.ndarray, id: np.ndarray) -> None:
        """Merge others, in any order; NONE is no entry."""
        score, id = np.hstack([self.score, score]), np.hstack([self.id, id])
        order = np.lexsort((id, ~score))[:, :self.size]  # ~ reverses the order without overflow
        self.score, self.id = np.take_along_axis(score, order, 1), np.take_along_axis(id, order, 1)

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        """Merge a tile's scores, which are changed; columns stand in order of ids."""
        rows = np.flatnonzero(score.max(axis=1) >= np.maximum(self.score[:, -1], NONE + 1))
        if not len(rows):
            return
        score = score[rows]
        at = np.arange(len(rows))
        best, who = np.full((len(rows), self.size), NONE, np.int64), np.full((len(rows), self.size), np.iinfo(np.int64).max, np.int64)
        for k in range(self.size):  # the first maximum has the smallest id
            j = score.argmax(axis=1)
            found = score[at, j]
            best[:, k], who[:, k] = found, np.where(found == NONE, np.iinfo(np.int64).max, ids[j])
            score[at, j] = NONE
            if (found == NONE).all():
                break
        some = Heaps(len(rows), self.size)
        some.score, some.id = self.score[rows], self.id[rows]
        some.merge(best, who)
        self.score[rows], self.id[rows] = some.score, some.id


def _integers(vectors: DataFrame, scale: int) -> DataFrame:
    """(id, label, anchor, e, d) of the rows that take part; e = floor(scale * x)."""
    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        out: list = []
        for v in batch.column(batch.schema.get_field_index("v")).to_pylist():
            x = None
            if not any(c is None for c in v):
                x = np.asarray(v, np.float64)
                x = np.floor(scale * x) if np.isfinite(x).all() else None
                if x is not None and not float(x @ x) < MOST:
                    raise ValueError(f"a vector is too long for exact scores in 64 bits: its squared length is {float(x @ x)}, the most is {MOST}")
            out.append(None if x is None else x.astype(np.int64).tolist())
        return [pa.array(out, pa.list_(pa.int64()))]
    own = add_columns(vectors.where("id is not null and label is not null and v is not null"), run, [("e", "array<bigint>")]).where("e is not null").drop("v")
    return own.withColumn("d", F.size("e"))


def _tiles(scores: np.ndarray, e: np.ndarray, step: int = TILE) -> Iterator[tuple[slice, np.ndarray]]:
    """(candidates, scores of all anchors) tile by tile."""
    for i in range(0, len(e), step):
        part = slice(i, i + step)
        yield part, np.vstack([strassen(scores[r:r + TILE], np.ascontiguousarray(e[part].T)) for r in range(0, len(scores), TILE)])


def _blocks(anchors: DataFrame, rows: DataFrame, by: list[str]) -> DataFrame:
    """Anchors (side 0) and candidates (side 1) dealt over pairs of blocks
    (i, j) of the classes ``by``; each pair has about ANCHORS + CANDIDATES rows.

    The sizes of the classes are joined, not gathered; a block is chosen by hash of
    the id, so a class that holds most rows has as many more blocks.
    """
    def sized(df: DataFrame, name: str, most: int) -> DataFrame:
        return df.groupBy(*by).agg(F.ceil(F.count("*") / most).cast("int").alias(name))
    sizes = stored(sized(anchors, "ni", ANCHORS).join(sized(rows, "nj", CANDIDATES), by), "negative-sizes")
    own = lambda n: F.pmod(F.xxhash64(F.lit(5), "id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = anchors.join(sizes, by).withColumn("i", own("ni")).withColumn("j", every("nj"))
    right = rows.join(sizes, by).withColumn("j", own("nj")).withColumn("i", every("ni"))
    return left.withColumn("side", F.lit(0)).unionByName(right.withColumn("side", F.lit(1)), allowMissingColumns=True).drop("ni", "nj")


def _sides(rows: pa.Table) -> tuple[pa.Table, pa.Table] | None:
    """Anchors and candidates of a block, candidates by id."""
    side = rows.column("side").to_numpy()
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if not len(left) or not len(right):
        return None
    right = right[np.argsort(rows.column("id").to_numpy()[right], kind="stable")]
    return rows.take(pa.array(left)), rows.take(pa.array(right))


def _best(found: DataFrame, keys: list[str], score: str, id: str, most: int) -> DataFrame:
    """The heaps of the blocks merged: the best ``most`` rows by ``keys``, with their rank."""
    order = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc(id))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def hard_negatives(vectors: DataFrame, anchors: Column, id: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = 256,
                   n_positives: int = 5, n_negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components become floor(scale * x), x as double; a score is the integer
    inner product with the anchor, and higher scores, then smaller ids, come
    first. The rows for which ``anchors`` holds are the anchors. An anchor's
    positives are its first ``n_positives`` other rows of the same label; for
    each of them the first ``n_negatives`` rows of other labels are given with
    low * positive_score <= 100 * score <= high * positive_score.

    Rows with a null id or label, a null vector or a null or non-finite
    component take no part. Vectors of different lengths are strangers to each
    other; an empty vector scores 0 with the others. Rows with one id (integer)
    are one row; if they differ, that with the smallest hash stands. A vector
    whose squared length is not below MOST is an error, as its scores would not
    fit in 64 bits. Other columns are not read; an empty table gives no rows.

    Anchors and candidates meet in pairs of blocks, all rows in blocks of each
    label for the positives and in blocks of all for the negatives, so no task
    holds more than one pair of blocks and a hot label is spread. Within a pair
    the scores of a tile are Strassen products; a task keeps heaps of the best
    positives, or of the best in the window of each positive, and the heaps of
    the blocks are merged by a window that cuts them before the shuffle.
    """
    base = vectors.select(F.col(id).cast("bigint").alias("id"), F.col(label).alias("label"), F.col(vector).alias("v"), F.coalesce(anchors, F.lit(False)).alias("anchor"))
    own = _integers(base, scale)
    own = own.withColumns({"h1": F.xxhash64("label", "e"), "h2": F.xxhash64("e", F.lit(1), "label")})
    first = F.row_number().over(Window.partitionBy("id").orderBy("h1", "h2"))
    rows = stored(own.withColumn("k", first).where("k = 1").select("id", F.xxhash64("label").alias("label"), "e", "d", "anchor"), "negative-rows")
    chosen = rows.where("anchor").select("id", "label", "e", "d")
    rows = rows.select("id", "label", "e", "d")

    def positives(block: pa.Table) -> pa.RecordBatch | None:
        sides = _sides(block)
        if sides is None:
            return None
        a, b = sides
        ids, others = a.column("id").to_numpy(), b.column("id").to_numpy()
        heaps = Heaps(len(ids), n_positives)
        for part, score in _tiles(fixed_rows(a, "e", np.int64), fixed_rows(b, "e", np.int64)):
            score[ids[:, None] == others[part][None, :]] = NONE
            heaps.add(score, others[part])
        i, j = np.nonzero(heaps.score != NONE)
        return pa.RecordBatch.from_arrays([pa.array(ids[i]), pa.array(heaps.id[i, j]), pa.array(heaps.score[i, j])], names=["anchor_id", "positive_id", "positive_score"])
    found = map_groups(_blocks(chosen, rows, ["d", "label"]).select("id", "e", "d", "label", "i", "j", "side"), ["d", "label", "i", "j"], positives,
                       "anchor_id bigint, positive_id bigint, positive_score bigint")
    pairs = stored(_best(found, ["anchor_id"], "positive_score", "positive_id", n_positives).drop("rank"), "negative-positives")
    # the window of a positive, in whole scores: low * p <= 100 * s <= high * p
    windows = pairs.groupBy(F.col("anchor_id").alias("id")).agg(F.sort_array(F.collect_list(F.struct("positive_score", "positive_id"))).alias("p"))
    windows = windows.select("id", F.col("p.positive_id").alias("pid"), F.col("p.positive_score").alias("ps"))
    asking = stored(chosen.join(windows, "id"), "negative-anchors")

    def negatives(block: pa.Table) -> pa.RecordBatch | None:
        sides = _sides(block)
        if sides is None:
            return None
        a, b = sides
        ids, others, la, lb = a.column("id").to_numpy(), b.column("id").to_numpy(), a.column("label").to_numpy(), b.column("label").to_numpy()
        width = max(len(x) for x in a.column("ps").to_pylist())
        pid, lo, hi, ps = (np.zeros((len(ids), width), np.int64) for _ in range(4))
        hi -= 1
        for r, (who, score) in enumerate(zip(a.column("pid").to_pylist(), a.column("ps").to_pylist())):
            p = np.array(score, np.int64)
            pid[r, :len(p)], ps[r, :len(p)], lo[r, :len(p)], hi[r, :len(p)] = who, p, -((-low * p) // 100), (high * p) // 100
        heaps = [Heaps(len(ids), n_negatives) for _ in range(width)]
        for part, score in _tiles(fixed_rows(a, "e", np.int64), fixed_rows(b, "e", np.int64)):
            score[la[:, None] == lb[part][None, :]] = NONE
            for k, heap in enumerate(heaps):
                some = np.flatnonzero((lo[:, k] <= hi[:, k]) & (score.max(axis=1) >= lo[:, k]))
                if not len(some):
                    continue
                s = score[some]
                s[(s < lo[some, k, None]) | (s > hi[some, k, None])] = NONE
                own = Heaps(len(some), n_negatives)
                own.score, own.id = heap.score[some], heap.id[some]
                own.add(s, others[part])
                heap.score[some], heap.id[some] = own.score, own.id
        out = []
        for k, heap in enumerate(heaps):
            i, j = np.nonzero(heap.score != NONE)
            out.append((ids[i], pid[i, k], heap.id[i, j], ps[i, k], heap.score[i, j]))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"])
    found = map_groups(_blocks(asking, rows, ["d"]).select("id", "label", "e", "d", "pid", "ps", "i", "j", "side"), ["d", "i", "j"], negatives,
                       "anchor_id bigint, positive_id bigint, negative_id bigint, positive_score bigint, negative_score bigint")
    return _best(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", n_negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
