"""Keyed merge of a batch into a silver table.

Semantics (a SQL ``MERGE`` on the business key):

* a batch row whose key matches target rows updates each of them (all batch
  columns except ``exclude_update``, which keep the target's value, e.g. the
  first load time);
* a batch row without a match is inserted;
* target rows without a batch row stay as they are;
* a NULL key never matches (such rows are inserted again on every run);
* ``match_cond`` restricts which *target* rows may match (the destination
  predicate of the reference, quirk Q3): an update of an older row is inserted
  as a second row.

Physical shape: the target rows and the batch rows are unioned and meet in one
window per key, so the merge costs a single shuffle. With ``bucket_col`` the
union is hash-partitioned by the storage bucket, which also satisfies the
per-key window (bucket is a function of the key) and leaves few buckets in
each task for the write that follows; a bucket too large for one task is dealt
to several by the hash of the key (``pieces``). Keys are unique in the target and
in the batch, so no window group is large. Rows with a NULL key get their own
window groups (spread by a row hash) in the same pass and come out unchanged.
"""

from __future__ import annotations

from typing import Optional, Sequence, Union

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from argent.operators.staging import AUDIT_LOAD, AUDIT_SYNC
from argent.functions.exprs import LOOKBACK_DAYS, days_ago

_SIDE = "_m_side"
_ELIG = "_m_elig"
_PIECE = "_m_piece"


def evolve_append(target_cols: Sequence[str], batch_cols: Sequence[str]) -> list:
    """Target columns first, then columns new in the batch; none dropped."""
    seen = {c.lower() for c in target_cols}
    return list(target_cols) + [c for c in batch_cols if c.lower() not in seen]


def _align(df: DataFrame, cols: Sequence[str], types: dict) -> DataFrame:
    have = {c.lower(): c for c in df.columns}
    return df.select(*[F.col(have[c.lower()]).alias(c) if c.lower() in have
                       else F.lit(None).cast(types[c]).alias(c) for c in cols])


def recent_match(days: int = LOOKBACK_DAYS, as_of=None, col: str = AUDIT_SYNC) -> Column:
    """Only target rows synced within the last ``days`` may be matched."""
    return F.col(col) >= days_ago(days, as_of)


def deal_buckets(df: DataFrame, bucket_col: str, by: Sequence[Union[str, Column]], pieces: int = 1,
                 num_partitions: Optional[int] = None) -> tuple:
    """``df`` partitioned by the bucket, each bucket in ``pieces`` parts by the
    hash of ``by``, and the columns that a window by key has to start with."""
    cols = [bucket_col]
    if pieces > 1:
        df = df.withColumn(_PIECE, F.pmod(F.hash(*by), F.lit(pieces)))
        cols.append(_PIECE)
    return (df.repartition(num_partitions, *cols) if num_partitions else df.repartition(*cols)), cols


def merge_frames(target: DataFrame, batch: DataFrame, keys: Union[str, Sequence[str]],
                 exclude_update: Sequence[str] = (AUDIT_LOAD,), match_cond: Optional[Column] = None,
                 bucket_col: Optional[str] = None, num_partitions: Optional[int] = None,
                 guard_col: Optional[str] = None, pieces: int = 1) -> DataFrame:
    """Return the target after merging ``batch`` (one row per key) into it.

    ``guard_col`` (a sequence column such as the sync time) makes the merge
    safe to replay and order-independent: a matched target row is updated
    only when the batch value is not older than the stored one; an older
    batch row is dropped. A NULL value is the newest, as in the dedup (W1).
    ``pieces`` is the number of tasks that a bucket is dealt to.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    types = {f.name: f.dataType for f in target.schema.fields}
    types.update({f.name: f.dataType for f in batch.schema.fields if f.name not in types})
    cols = evolve_append(target.columns, batch.columns)
    batch_lower = {c.lower() for c in batch.columns}
    excluded = {c.lower() for c in exclude_update}
    key_lower = {k.lower() for k in keys}
    update_cols = [c for c in cols if c.lower() in batch_lower
                   and c.lower() not in excluded and c.lower() not in key_lower
                   and c != bucket_col]

    t = _align(target, cols, types).withColumn(_SIDE, F.lit(0)) \
        .withColumn(_ELIG, F.coalesce(match_cond, F.lit(False)) if match_cond is not None else F.lit(True))
    s = _align(batch, cols, types).withColumn(_SIDE, F.lit(1)).withColumn(_ELIG, F.lit(False))
    u = t.unionByName(s)

    has_key = F.lit(True)
    for k in keys:
        has_key = has_key & F.col(k).isNotNull()
    # NULL keys never match: such rows get their own window groups (spread
    # by a row hash so that many of them do not form one hot group) and
    # pass through unchanged, in the same pass as the keyed rows.
    nk = F.when(has_key, F.lit(0)).otherwise(F.xxhash64(*[F.col(c) for c in cols], F.col(_SIDE)))
    dealt = []
    if bucket_col:
        u, dealt = deal_buckets(u, bucket_col, [*keys, nk], pieces, num_partitions)
    u = u.withColumn("_m_nk", nk).withColumn("_m_haskey", has_key)

    w = Window.partitionBy(*dealt, *keys, "_m_nk")
    src_fields = update_cols + ([guard_col] if guard_col and guard_col not in update_cols else [])
    src = F.max(F.when(F.col(_SIDE) == 1, F.struct(*[F.col(c) for c in src_fields]))).over(w)
    n_elig = F.sum(F.when((F.col(_SIDE) == 0) & F.col(_ELIG), 1).otherwise(0)).over(w)
    keyed = u.select("*", src.alias("_m_src"), n_elig.alias("_m_nelig"))

    is_t = F.col(_SIDE) == 0
    updated = is_t & F.col(_ELIG) & F.col("_m_haskey") & F.col("_m_src").isNotNull()
    if guard_col:
        g_new, g_old = F.col("_m_src").getField(guard_col), F.col(guard_col)
        updated = updated & (g_new.isNull() | F.coalesce(g_new >= g_old, F.lit(False)))
    keep = is_t | (F.col("_m_nelig") == 0) | ~F.col("_m_haskey")
    out_cols = [F.when(updated, F.col("_m_src").getField(c)).otherwise(F.col(c)).alias(c)
                if c in update_cols else F.col(c) for c in cols]
    return keyed.where(keep).select(*out_cols)


def merge_by_joins(target: DataFrame, batch: DataFrame, keys: Union[str, Sequence[str]],
                   exclude_update: Sequence[str] = (AUDIT_LOAD,), match_cond: Optional[Column] = None) -> DataFrame:
    """The same merge spelled with joins: ``(batch ⟕ target) ∪ (target ▷ batch)``.

    An independent formulation used to cross-check :func:`merge_frames`.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    types = {f.name: f.dataType for f in target.schema.fields}
    types.update({f.name: f.dataType for f in batch.schema.fields if f.name not in types})
    cols = evolve_append(target.columns, batch.columns)
    excluded = {e.lower() for e in exclude_update}
    batch_lower = {c.lower() for c in batch.columns}
    from_target = [c for c in cols if c not in keys and (c.lower() in excluded or c.lower() not in batch_lower)]
    t = _align(target, cols, types)
    s = _align(batch, cols, types)
    elig = t.where(match_cond) if match_cond is not None else t
    tm = elig.select(*keys, F.lit(True).alias("_t_hit"), *[F.col(c).alias(f"_t_{c}") for c in from_target])
    upd = s.join(tm, keys, "left").select(
        *[F.when(F.col("_t_hit"), F.col(f"_t_{c}")).otherwise(F.col(c)).alias(c) if c in from_target
          else F.col(c) for c in cols])
    on = [t[k] == s[k] for k in keys] + ([match_cond] if match_cond is not None else [])
    rest = t.join(s.select(*keys), on, "left_anti")
    return upd.unionByName(rest.select(*cols))
