"""Change feeds into bronze.

* :func:`apply_changes` - log-based change capture: the newest change per key
  is upserted into the bronze table; a delete keeps the row and sets the
  soft-delete flag; every touched row gets the sync time.
* :func:`snapshot_diff` - full compare of the previous copy and a new
  extract (for a source without a change log): insert / update / delete rows.
* :func:`changed_columns` - names of the columns that differ between two
  versions (NULL-safe).
* :func:`retain_changes` - keep only the last ``days`` of a change log.

All are joins / windows over whole tables; the upsert reuses the bucketed
merge sink so only the buckets a batch touches are rewritten.
"""

from __future__ import annotations

from typing import Optional, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from argent.functions.exprs import CHANGE_RETENTION_DAYS, as_of_ts, days_ago
from argent.operators.merge import deal_buckets
from argent.operators.staging import DELETED, SYNCED, dedup_latest
from argent.session import stored

OP = "_op"                  # I / U / D
OP_INSERT, OP_UPDATE, OP_DELETE = "I", "U", "D"


def latest_change(changes: DataFrame, key: str, seq_col: str, tie_breakers: Sequence[str] = ()) -> DataFrame:
    """Newest change per key (highest sequence value; NULL sequence first)."""
    return dedup_latest(changes, key, seq_col, tie_breakers)


def change_batch(changes: DataFrame, key: str, seq_col: str, op_col: str = OP, as_of=None,
                 tie_breakers: Sequence[str] = ()) -> DataFrame:
    """Newest change per key, shaped like a bronze row plus the operation."""
    cols = [c for c in changes.columns if c not in (op_col, seq_col, SYNCED, DELETED)]
    c = latest_change(changes, key, seq_col, tie_breakers)
    return c.select(*cols, as_of_ts(as_of).alias(SYNCED), (F.col(op_col) == OP_DELETE).alias(DELETED),
                    F.col(op_col).alias(OP))


def apply_change_batch(target: Optional[DataFrame], batch: DataFrame, key: str,
                       bucket_col: Optional[str] = None, pieces: int = 1, num_partitions: Optional[int] = None) -> DataFrame:
    """Apply a :func:`change_batch` (one row per key) to the bronze rows.

    Per key, with ``c`` = the change and ``t`` = the bronze row:
    insert/update -> values of ``c``, flag false; delete -> values of ``t``
    (of ``c`` when there is no ``t``) with the flag true; no change -> ``t``.
    Touched rows carry the batch's sync time.

    Target and batch rows are unioned and meet in one window per key: a
    single shuffle, partitioned by the storage bucket when ``bucket_col`` is
    given (the bucket is a function of the key), each in ``pieces`` parts.
    """
    cols = [c for c in batch.columns if c not in (OP, bucket_col)]
    if target is None:
        return batch.select(*cols)
    extra = [bucket_col] if bucket_col else []
    t = target.select(*cols, *extra, F.lit(0).alias("_side"), F.lit(None).cast("string").alias(OP))
    b = batch.select(*cols, *extra, F.lit(1).alias("_side"), F.col(OP))
    u = t.unionByName(b)
    # A NULL key matches nothing: each such row gets its own window group
    # (spread by a row hash), so many of them never form one hot group.
    nk = F.when(F.col(key).isNotNull(), F.lit(0)).otherwise(F.xxhash64(*[F.col(c) for c in cols], F.col("_side")))
    dealt = []
    if bucket_col:
        u, dealt = deal_buckets(u, bucket_col, [key, nk], pieces, num_partitions)
    u = u.withColumn("_nk", nk)
    w = Window.partitionBy(*dealt, key, "_nk")
    chg = F.max(F.when(F.col("_side") == 1, F.struct(*[F.col(c) for c in cols], F.col(OP)))).over(w)
    has_t = F.max(F.col("_side") == 0).over(w)
    u = u.withColumn("_c", chg).withColumn("_has_t", has_t)
    is_t, has_c = F.col("_side") == 0, F.col("_c").isNotNull()
    is_del = F.col("_c").getField(OP) == OP_DELETE
    keep_row = is_t | ~F.col("_has_t")            # one row per key: the target's, else the change
    vals = []
    for name in cols:
        cv = F.col("_c").getField(name)
        if name in (SYNCED, DELETED):
            vals.append(F.when(has_c, cv).otherwise(F.col(name)).alias(name))
        else:
            vals.append(F.when(has_c & (~is_del | ~F.col("_has_t")), cv).otherwise(F.col(name)).alias(name))
    return u.where(keep_row).select(*vals, *extra)


def apply_changes(target: Optional[DataFrame], changes: DataFrame, key: str, seq_col: str,
                  op_col: str = OP, as_of=None) -> DataFrame:
    """The bronze table after applying a change log (newest change per key)."""
    return apply_change_batch(target, change_batch(changes, key, seq_col, op_col, as_of), key)


def apply_changes_to_table(spark, path: str, changes: DataFrame, key: str, seq_col: str, op_col: str = OP,
                           as_of=None, num_buckets: Optional[int] = None) -> dict:
    """S2 sink: apply a change log to the bucketed bronze table at ``path``,
    rewriting only the buckets the log touches (same protocol as the merge)."""
    from argent.sources.silver_table import BUCKET, merge_upsert

    batch = change_batch(changes, key, seq_col, op_col, as_of)
    return merge_upsert(spark, path, batch, key, num_buckets=num_buckets,
                        combine=lambda tgt, staged, **dealt: apply_change_batch(tgt, staged, key, BUCKET, **dealt),
                        create=lambda b: b.drop(OP))


def _same_types(prev: DataFrame, cur: DataFrame, cols: Sequence[str]) -> tuple:
    """Both copies with the types that Spark unites them to, so that equal
    values have equal hashes."""
    kinds = prev.select(*cols).limit(0).unionByName(cur.select(*cols).limit(0)).schema
    return tuple(df.select(*[F.col(c).cast(kinds[c].dataType).alias(c) for c in cols]) for df in (prev, cur))


def _digest(cols: Sequence[str]) -> tuple:
    """128 hashed bits of a row, nulls told apart from values."""
    parts = [x for c in cols for x in (F.col(c).isNull(), F.col(c))]
    return F.xxhash64(F.lit(1), *parts), F.xxhash64(F.lit(2), *reversed(parts))


def _compared(prev: DataFrame, cur: DataFrame, key: str, extra: Sequence[Column] = ()) -> DataFrame:
    """One row per key that is not NULL: the digests of the previous (p1, p2)
    and the current (c1, c2) row, NULL when absent, and of ``extra`` (bigint
    columns of the row) the arrays p and c.

    Only the key and bigints are shuffled, whatever the width of the rows, and
    they meet in one hash aggregate that starts in every scan task. A key that
    (wrongly) repeats in an extract counts as its row of largest digest.
    """
    cols = [c for c in prev.columns if c != key]

    def side(df: DataFrame, n: int) -> DataFrame:
        d1, d2 = _digest(cols)
        return df.where(F.col(key).isNotNull()).select(F.col(key).alias("_k"), F.lit(n).alias("_side"), d1.alias("_d1"), d2.alias("_d2"),
                                                       *[x.alias(f"_x{i}") for i, x in enumerate(extra)])
    u = side(prev, 0).unionByName(side(cur, 1))
    aggs = []
    for n, name in ((0, "p"), (1, "c")):
        mine = F.when(F.col("_side") == n, F.col("_d1"))
        aggs += [F.max(mine).alias(f"{name}1"), F.max_by("_d2", mine).alias(f"{name}2"),
                 *[F.max_by(f"_x{i}", mine).alias(f"{name}_x{i}") for i in range(len(extra))]]
    return u.groupBy("_k").agg(*aggs)


def snapshot_diff(prev: DataFrame, cur: DataFrame, key: str, compare_cols: Optional[Sequence[str]] = None,
                  op_col: str = "op") -> DataFrame:
    """S3: rows that changed between two copies: ``insert`` / ``update`` /
    ``delete`` (unchanged keys are dropped). NULL-safe column compare.

    Output: ``op``, the key and the columns of the current copy (of the
    previous copy for deletes). A NULL key matches nothing: such rows are
    inserts and deletes, each for itself.

    Keys and 128-bit digests are compared first (:func:`_compared`) and the
    changed keys stored; then their rows are fetched from the copies. Spark
    knows the size of the stored keys: few are broadcast and no row is
    shuffled, many are joined by key.
    """
    cols = [key, *(compare_cols or [c for c in cur.columns if c != key])]
    prev, cur = _same_types(prev, cur, cols)
    both = _compared(prev, cur, key)
    in_p, in_c = F.col("p1").isNotNull(), F.col("c1").isNotNull()
    op = (F.when(in_c & ~in_p, F.lit("insert")).when(in_p & ~in_c, F.lit("delete"))
           .when((F.col("p1") != F.col("c1")) | (F.col("p2") != F.col("c2")), F.lit("update")))
    changed = stored(both.select("_k", op.alias(op_col), F.when(in_c, F.lit(1)).otherwise(F.lit(0)).alias("_side"), F.coalesce("c1", "p1").alias("_d1"),
                                 F.coalesce("c2", "p2").alias("_d2")).where(F.col(op_col).isNotNull()), "diff-keys")
    d1, d2 = _digest(cols[1:])

    def side(df: DataFrame, n: int) -> DataFrame:
        return df.withColumns({"_side": F.lit(n), "_d1": d1, "_d2": d2, "_k": F.col(key)})
    rows = side(prev, 0).unionByName(side(cur, 1)).join(changed, ["_k", "_side", "_d1", "_d2"])
    # equal rows of an extract: one of them
    one = F.row_number().over(Window.partitionBy("_k", "_side", "_d1", "_d2").orderBy(F.lit(0)))
    rows = rows.withColumn("_n", one).where("_n = 1").select(op_col, *cols)
    alone = prev.where(F.col(key).isNull()).select(F.lit("delete").alias(op_col), *cols)
    return rows.unionByName(alone).unionByName(cur.where(F.col(key).isNull()).select(F.lit("insert").alias(op_col), *cols))


def diff_as_changes(diff: DataFrame, op_col: str = "op", seq_col: str = "_seq") -> DataFrame:
    """A full-compare diff as a change log (insert -> I, update -> U,
    delete -> D), so that a source without a change log is applied to bronze
    by the same sink: deleted keys keep their row with the soft-delete flag."""
    op = (F.when(F.col(op_col) == "insert", F.lit(OP_INSERT))
           .when(F.col(op_col) == "update", F.lit(OP_UPDATE)).otherwise(F.lit(OP_DELETE)))
    return diff.withColumn(OP, op).withColumn(seq_col, F.lit(0)).drop(op_col)


def changed_columns(old: Column, new: Column, cols: Sequence[str]) -> Column:
    """Array of the names of ``cols`` whose values differ (NULL-safe)
    between two versions given as struct columns."""
    flags = [F.when(~old.getField(c).eqNullSafe(new.getField(c)), F.lit(c)) for c in cols]
    return F.filter(F.array(*flags), lambda x: x.isNotNull())


def diff_changed_columns(prev: DataFrame, cur: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """S4 over two copies: key and changed column names for keys in both.

    A 64-bit hash per column is shuffled beside the digest, no values."""
    cols = list(cols)
    prev, cur = _same_types(prev, cur, [key, *cols])
    both = _compared(prev, cur, key, [F.xxhash64(F.lit(3), F.col(c).isNull(), F.col(c)) for c in cols])
    both = both.where("p1 is not null and c1 is not null and (p1 <> c1 or p2 <> c2)")
    flags = [F.when(F.col(f"p_x{i}") != F.col(f"c_x{i}"), F.lit(c)) for i, c in enumerate(cols)]
    return both.select(F.col("_k").alias(key), F.filter(F.array(*flags), lambda x: x.isNotNull()).alias("changed_columns"))


def retain_changes(changes: DataFrame, ts_col: str = SYNCED, days: int = CHANGE_RETENTION_DAYS,
                   as_of=None) -> DataFrame:
    """The last ``days`` days of a change log (a pushed-down range filter;
    on date-partitioned logs it prunes whole partitions)."""
    return changes.where(F.col(ts_col) >= days_ago(days, as_of))
