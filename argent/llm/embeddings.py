"""Near-duplicate vectors by Euclidean p-stable hashing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from argent.llm.common import add_columns, block_pairs, components, map_groups
from argent.session import stored


class Tables:
    """``tables`` keys of ``k`` quantised random projections floor((p.u + b) / width)."""

    def __init__(self, tables: int, k: int, width: float, seed: int):
        self.tables, self.k, self.width, self.seed = tables, k, width, seed
        self.made: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def keys(self, u: np.ndarray) -> np.ndarray:
        """(vectors, tables) 64-bit keys."""
        d = u.shape[1]
        if d not in self.made:
            rng = np.random.default_rng((self.seed, d))
            self.made[d] = rng.standard_normal((d, self.tables * self.k)), rng.uniform(0, self.width, self.tables * self.k)
        p, b = self.made[d]
        cell = np.floor((u @ p + b) / self.width).astype(np.int32).reshape(len(u), self.tables, self.k)
        return np.array([[xxhash.xxh64_intdigest(c.tobytes(), t) for t, c in enumerate(row)] for row in cell], np.uint64).view(np.int64)


def _units(vectors: list) -> tuple[list[int], list[np.ndarray]]:
    """Places and unit vectors of the rows that have a direction."""
    at, units = [], []
    for i, v in enumerate(vectors):
        if v is None or not len(v) or any(x is None for x in v):
            continue
        x = np.asarray(v, np.float64)
        if not np.isfinite(x).all() or not x.any():
            continue
        x = x / np.abs(x).max()
        at.append(i)
        units.append(x / np.sqrt(x @ x))
    return at, units


def near_vectors(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label",
                 threshold: float = 0.93, tables: int = 40, k: int = 20, width: float = 3.0, seed: int = 11) -> DataFrame:
    """(id, n_links, component_id, kept) of every row of ``vectors``.

    Rows are linked when their labels are equal and not null and the cosine of
    their vectors, in double precision, is at least ``threshold``. n_links
    counts the other rows linked directly; component_id is the smallest id
    reachable, itself included; kept is component_id = id. Null, empty, zero
    or non-finite vectors, null labels and null ids are linked with nothing;
    vectors of different lengths neither. Rows with the same id are one row,
    and each of them gets its result; if their vectors or labels differ, the
    one with the smallest hash among those that can be linked stands for them.

    Unit vectors are hashed in ``tables`` tables; with the defaults a pair at
    the threshold meets in one of them with a chance over 0.99, a closer one
    more surely. Equal vectors are one member of their buckets, with a count.
    Buckets are dealt over pairs of blocks, so a hot one is spread; within a
    pair of blocks all cosines are computed, and a linked pair counts only in
    the first table in which it meets. A task returns sums and a spanning
    forest, not the pairs, so nothing grows with the square of a group.
    """
    base = vectors.select(F.col(id).alias("id"), F.col(vector).alias("v"), F.col(label).alias("g"))

    def sign(batch, hashing):
        v = batch.column(batch.schema.get_field_index("v")).to_pylist()
        at, units = _units(v)
        key: list = [None] * len(v)
        unit: list = [None] * len(v)
        for d in {len(u) for u in units}:
            some = [(i, u) for i, u in zip(at, units) if len(u) == d]
            for (i, u), row in zip(some, hashing.keys(np.stack([u for _, u in some]))):
                key[i], unit[i] = row.tolist(), u.tolist()
        return [pa.array(unit, pa.list_(pa.float64())), pa.array(key, pa.list_(pa.int64()))]
    signed = add_columns(base.where("g is not null and id is not null"), sign, [("u", "array<double>"), ("keys", "array<bigint>")],
                         lambda: Tables(tables, k, width, seed)).where("keys is not null").drop("v")
    signed = stored(signed.withColumns({"s1": F.xxhash64(F.lit(1), "g", "u"), "s2": F.xxhash64(F.lit(2), "u", "g"),
                                        "row": F.monotonically_increasing_id()}), "vectors")
    # s1, s2 before the row: which vector stands does not depend on the order of rows
    firsts = stored(signed.groupBy("id").agg(F.min(F.struct("s1", "s2", "row")).alias("f")).select("id", "f.*"), "vector-ids")
    classes = firsts.groupBy("s1", "s2").agg(F.min(F.struct("id", "row")).alias("f"), F.count("*").alias("n"))
    classes = stored(classes.select("s1", "s2", F.col("f.id").alias("rep"), F.col("f.row").alias("row"), "n"), "vector-classes")
    member = stored(firsts.select("id", "s1", "s2").join(classes, ["s1", "s2"]).select("id", "rep", "n"), "vector-members")
    one = stored(signed.join(classes.select("row", "n"), "row").select("id", "n", "g", "u", "keys"), "unique-vectors")

    shelf = (one.select("id", F.posexplode("keys").alias("t", "key"), "g", F.size("u").alias("d"))
             .select("id", "t", F.xxhash64("g", "t", "d", "key").alias("bucket")))
    sizes = stored(shelf.groupBy("bucket").agg(F.count("*").alias("m")).where("m > 1"), "vector-buckets")
    placed = stored(block_pairs(shelf, sizes, "bucket", "id"), "vector-shelves")
    dealt = placed.join(one.select("id", "n", "u", "keys"), "id")

    def compare(rows: pa.Table) -> pa.RecordBatch | None:
        u = rows.column("u").to_pylist()
        size = np.array([len(x) for x in u])
        found = []
        for d in np.unique(size):  # different lengths meet only by a chance of 64 bits
            at = np.flatnonzero(size == d)
            out = linked(rows.take(pa.array(at)) if len(at) < len(u) else rows, np.array([u[i] for i in at]))
            if out is not None:
                found.append(out)
        return pa.Table.from_batches(found).combine_chunks().to_batches()[0] if found else None

    def linked(rows: pa.Table, x: np.ndarray) -> pa.RecordBatch | None:
        s, i, j = (rows.column(c).to_numpy() for c in ("_s", "_i", "_j"))
        left, right = np.flatnonzero(s == i[0]), np.flatnonzero(s == j[0])
        key = np.array(rows.column("keys").to_pylist(), np.int64)
        ids, n, t = rows.column("id").to_numpy(), rows.column("n").to_numpy(), int(rows.column("t")[0].as_py())
        hit = x[left] @ x[right].T >= threshold
        a, b = (p[q] for p, q in zip((left, right), np.nonzero(hit)))
        ok = a < b if i[0] == j[0] else np.ones(len(a), bool)
        ok &= ~(key[a, :t] == key[b, :t]).any(axis=1)
        a, b = a[ok], b[ok]
        if not len(a):
            return None
        links, root = np.zeros(len(ids), np.int64), ids.copy()
        np.add.at(links, a, n[b])
        np.add.at(links, b, n[a])
        while True:
            low = np.minimum(root[a], root[b])
            before = root.copy()
            np.minimum.at(root, a, low)
            np.minimum.at(root, b, low)
            if (root == before).all():
                break
        some = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(links[some]), pa.array(root[some])], names=["id", "links", "root"])
    # the bucket's table goes with it: two tables never share a bucket but by a chance of 64 bits
    found = stored(map_groups(dealt, ["bucket", "t", "_i", "_j"], compare, "id bigint, links bigint, root bigint"), "vector-links")
    direct = found.groupBy(F.col("id").alias("rep")).agg(F.sum("links").alias("links"))
    labels = components(found.select(F.col("id").alias("a"), F.col("root").alias("b"))).select(F.col("v").alias("rep"), "component")
    member = (member.join(stored(direct, "direct"), "rep", "left").join(labels, "rep", "left")
              .select("id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")))
    out = base.select("id").join(member, "id", "left")
    out = out.withColumns({"n_links": F.coalesce("n_links", F.lit(0)).cast("bigint"), "component_id": F.coalesce("component_id", "id")})
    return out.select(F.col("id").alias(id), "n_links", "component_id",
                      F.coalesce(F.col("component_id") == F.col("id"), F.lit(True)).alias("kept"))
