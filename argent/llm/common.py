"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from argent.session import stored

#: A word is a maximal run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Key columns of :func:`row_key`.
KEY = ("_k1", "_k2")
#: Rows of an Arrow batch handed to a Python worker, and the text it may hold.
BATCH_ROWS, BATCH_BYTES = 2000, 32 << 20


def row_key(df: DataFrame, *cols: str) -> DataFrame:
    """Add two never-null longs that identify a row by the given columns.

    128 hashed bits, nulls told apart from empty values; rows that are equal
    in these columns share the key and are treated as one by the operators.
    """
    parts = [x for c in cols for x in (F.col(c).isNull().cast("int"), F.col(c))]
    return df.withColumns({KEY[0]: F.xxhash64(F.lit(1), *parts),
                           KEY[1]: F.xxhash64(F.lit(2), *reversed(parts))})


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop input columns whose names an operator is about to produce."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, each lengthened until no column of ``df`` has it."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        out.append(n)
    return out


def add_columns(df: DataFrame, fn: Callable[[pa.RecordBatch], list[pa.Array]], fields: list[tuple[str, str]],
                make: Callable[[], object] | None = None, drop: tuple[str, ...] = ()) -> DataFrame:
    """Append columns computed from Arrow batches; no row moves.

    ``fn(batch[, state])`` gives one array per field; ``make()`` builds a state
    kept for the task. An input column with the name of a field is replaced;
    those named in ``drop`` are read and don't come back from the worker.
    """
    df = without(df, *[n for n, _ in fields])
    back = [(i, f) for i, f in enumerate(df.schema) if f.name not in drop]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for _, f in back), *(f"`{n}` {t}" for n, t in fields)])
    names = [*(f.name for _, f in back), *(n for n, _ in fields)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = make() if make else None
        for batch in batches:
            for part in split(batch):
                new = fn(part, state) if make else fn(part)
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i, _ in back), *new], names=names)
    return df.mapInArrow(run, schema)


def split(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of at most BATCH_ROWS rows and about BATCH_BYTES (one row at least)."""
    if not batch.num_rows:
        return
    step = max(1, min(BATCH_ROWS, int(batch.num_rows * BATCH_BYTES / max(1, batch.nbytes))))
    for i in range(0, batch.num_rows, step):
        yield batch.slice(i, step)


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


class Hashes(dict):
    """64-bit hashes of words, kept for the task up to ``limit`` words."""

    limit = 200_000

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.limit:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """(v, component) for every vertex of the links (a, b); component is the
    smallest vertex reachable.

    Each round every vertex hooks to its smallest neighbour, chains of hooks
    are shortened by pointer jumping, and the links between what remains go to
    the next round. All steps are joins and map-side combined minima; what a
    round made is stored, so that joins start from stored rows and a hot
    vertex can be split.
    """
    edges = stored(edges.select("a", "b").where("a <> b").distinct())
    labels = None
    for _ in range(rounds):
        if edges.isEmpty():
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = stored(both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("p")).select("v", F.least("v", "p").alias("p")))
        while True:
            up = hook.select(F.col("v").alias("p"), F.col("p").alias("q"))
            nxt = stored(hook.join(up, "p", "left").select("v", F.coalesce("q", "p").alias("p"), (F.coalesce("q", "p") != F.col("p")).alias("moved")))
            hook = nxt.select("v", "p")
            if nxt.where("moved").isEmpty():
                break
        if labels is None:
            labels = hook.select("v", F.col("p").alias("component"))
        else:
            labels = stored(labels.join(hook.select(F.col("v").alias("component"), "p"), "component", "left")
                                 .select("v", F.coalesce("p", "component").alias("component")))
        pa_, pb = (hook.select(F.col("v").alias(c), F.col("p").alias(f"p{c}")) for c in "ab")
        edges = stored(edges.join(pa_, "a").join(pb, "b").select(F.greatest("pa", "pb").alias("a"), F.least("pa", "pb").alias("b"))
                            .where("a <> b").distinct())
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("a").alias("v"), F.col("b").alias("component")) if labels is None else labels


def block_pairs(rows: DataFrame, sizes: DataFrame, key: str, id: str, block: int = 1024) -> DataFrame:
    """Deal the rows of each bucket over pairs of blocks (_i <= _j), so that a
    task gets about two blocks whatever the size of the bucket.

    ``sizes`` has ``key`` and the bucket's number of rows ``m``. A row of block
    s goes to every pair with s; ``_s`` says which block it is of.
    """
    n = F.ceil(F.col("m") / F.lit(block)).cast("int")
    dealt = (rows.join(sizes.select(key, n.alias("_n")), key)
             .withColumn("_s", F.pmod(F.xxhash64(F.lit(3), id), F.col("_n")).cast("int"))
             .withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_n") - 1))))
    return dealt.withColumns({"_i": F.least("_s", "_j"), "_j": F.greatest("_s", "_j")}).drop("_n")


def map_groups(df: DataFrame, keys: list[str], fn: Callable[[pa.Table], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Apply ``fn`` to the rows of each group. One shuffle by the keys, then a
    sorted stream per task, so that small groups cost no call to Spark each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if parts and (out := fn(pa.Table.from_batches(parts))) is not None:
                yield out
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
            change = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cols])) + 1
            edges = [0, *change.tolist(), batch.num_rows]
            if held and last != tuple(c[0] for c in cols):
                yield from done(held)
                held = []
            for a, b in zip(edges, edges[1:]):
                if a:
                    yield from done(held)
                    held = []
                held.append(batch.slice(a, b - a))
            last = tuple(c[-1] for c in cols)
        yield from done(held)
    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def fixed_rows(table: pa.Table, name: str, dtype) -> np.ndarray:
    """A column of equally long arrays as a matrix."""
    c = table.column(name).combine_chunks()
    return c.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(len(c), -1)
