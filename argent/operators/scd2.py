"""Type-2 history (S10, S11, J5, P10): timestamp strategy, hard delete -> new record.

History columns: the source columns unchanged, then ``scd_id``, ``valid_from``,
``valid_to`` (open = 9999-12-31), ``updated_at``, ``is_current``, ``is_deleted``.

Rules per key, comparing the current version ``h`` with the source row ``s``
(source one row per key; ``updated`` = its sync time):

1. only ``s``                        -> open a version at ``updated``;
2. both, ``updated > h.valid_from``   -> close ``h`` at ``updated``, open a version;
3. both, not newer                   -> unchanged;
4. only ``h`` (not a marker)         -> close ``h`` at ``as_of`` and open a delete
                                        marker (``is_deleted``) at ``as_of``;
5. only ``h`` (a marker)             -> unchanged;
6. both, ``h`` is a marker           -> the key came back: close the marker and open
                                        a version at ``greatest(updated, h.valid_from)``.

Columns: those of the history, then those new in the source (null in older
versions); a column the source no longer has is null in its new versions.

In every new version ``updated_at = valid_from`` and ``scd_id = md5(key|updated_at)``,
so ids stay unique per key. Re-running a run changes nothing.

Physical shape: the source's newest row per key and the current versions meet
in one full outer join on the key, whose partitioning the two sides already
have or get in one shuffle. Closed versions pass through untouched; the table
sink (:func:`snapshot`) does not even read them.
"""

from __future__ import annotations

import datetime as _dt
from typing import Optional, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from argent.functions.exprs import OPEN_END_DATE, as_of_ts, lit_ts, scd_id
from argent.operators.merge import _align, evolve_append
from argent.operators.staging import DELETED, SYNCED, dedup_latest

SCD_COLUMNS = ("scd_id", "valid_from", "valid_to", "updated_at", "is_current", "is_deleted")
_H, _S, _K, _VALUE, _NULL = "_h", "_s", "_key", "_k_value", "_k_null"


def history_columns(source_cols: Sequence[str]) -> list:
    return [*source_cols, *SCD_COLUMNS]


def _same_columns(history: DataFrame, source: DataFrame) -> tuple:
    """(source columns of both, history and source with all of them)."""
    own = [c for c in history.columns if c not in SCD_COLUMNS]
    cols = evolve_append(own, source.columns)
    types = {f.name: f.dataType for df in (source, history) for f in df.schema.fields}
    rest = [c for c in history.columns if c in SCD_COLUMNS]
    return cols, _align(history, [*cols, *rest], types), _align(source, cols, types)


def open_versions(source: DataFrame, key: str, updated_col: str = SYNCED) -> DataFrame:
    """First run: every source row opens a version."""
    u = F.col(updated_col)
    return source.select(
        *source.columns,
        scd_id(key, u).alias("scd_id"),
        u.alias("valid_from"),
        lit_ts(OPEN_END_DATE).alias("valid_to"),
        u.alias("updated_at"),
        F.lit(True).alias("is_current"),
        F.lit(False).alias("is_deleted"),
    )


def _active(source: DataFrame, soft_delete_as_delete: bool) -> DataFrame:
    if soft_delete_as_delete and DELETED in source.columns:
        d = F.col(DELETED)
        return source.where(~d | d.isNull())
    return source


def _keyed(df: DataFrame, key: str) -> DataFrame:
    """``df`` with the key as two columns that are never null, so that a NULL key
    is a key like others for grouping and joining alike."""
    kind = df.schema[key].dataType
    empty = "" if isinstance(kind, T.StringType) else "1970-01-01" if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)) else "0"
    return df.withColumns({_NULL: F.col(key).isNull(), _VALUE: F.coalesce(F.col(key), F.lit(empty).cast(kind))})


def _prepare_source(source: DataFrame, key: str, updated_col: str, soft_delete_as_delete: bool) -> DataFrame:
    """The newest row per key, with the key columns of :func:`_keyed`."""
    others = [c for c in source.columns if c not in (key, updated_col)]
    return dedup_latest(_keyed(_active(source, soft_delete_as_delete), key), [_VALUE, _NULL], updated_col, others)


def classify(h: Column, s: Column, updated_col: str) -> Column:
    """Action label of one key: insert / update / unchanged / delete / deleted / return."""
    marker = h.getField("is_deleted")
    return (F.when(h.isNull(), F.lit("insert"))
             .when(s.isNull() & marker, F.lit("deleted"))
             .when(s.isNull(), F.lit("delete"))
             .when(marker, F.lit("return"))
             .when(s.getField(updated_col) > h.getField("valid_from"), F.lit("update"))
             .otherwise(F.lit("unchanged")))


def _paired(current: DataFrame, source: DataFrame, key: str, hcols: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """One row per key with the current version ``_h`` and the source row ``_s``
    as structs (NULL when absent). ``source`` has one row per key and the key
    columns; the current versions are unique by the rules above."""
    h = _keyed(current, key).select(_VALUE, _NULL, F.struct(*hcols).alias(_H))
    s = source.select(_VALUE, _NULL, F.struct(*cols).alias(_S))
    return h.join(s, [_VALUE, _NULL], "full_outer")


def changes(history: DataFrame, source: DataFrame, key: str, as_of=None, updated_col: str = SYNCED,
            soft_delete_as_delete: bool = False) -> DataFrame:
    """Full compare of current history and source -> (key, action).

    Only keys, times and delete flags take part: the newest time per key is a
    hash aggregate with partial sums in every scan task (a NULL time is the
    newest, as in the dedup), so what is shuffled does not grow with the width
    of the rows."""
    u = F.col(updated_col)
    newest = F.when(F.count_if(u.isNull()) > 0, F.lit(None)).otherwise(F.max(u)).cast(source.schema[updated_col].dataType)
    src = _keyed(_active(source, soft_delete_as_delete).select(key, updated_col), key).groupBy(_VALUE, _NULL).agg(newest.alias(updated_col))
    cur = history.where(F.col("is_current")).select(key, "valid_from", "is_deleted")
    p = _paired(cur, src, key, ["valid_from", "is_deleted"], [updated_col])
    return p.select(F.when(~F.col(_NULL), F.col(_VALUE)).alias(key), classify(F.col(_H), F.col(_S), updated_col).alias("action"))


def scd2_apply(history: Optional[DataFrame], source: DataFrame, key: str, as_of=None,
               updated_col: str = SYNCED, soft_delete_as_delete: bool = False) -> DataFrame:
    """The history after one snapshot run. ``history=None`` is the first run."""
    if history is None:
        return open_versions(_prepare_source(source, key, updated_col, soft_delete_as_delete).drop(_VALUE, _NULL), key, updated_col)

    cols, history, source = _same_columns(history, source)
    hcols = history_columns(cols)
    src = _prepare_source(source, key, updated_col, soft_delete_as_delete)
    cur = history.where(F.col("is_current"))
    closed = history.where(~F.col("is_current"))
    p = _paired(cur, src, key, hcols, cols)

    h, s = F.col(_H), F.col(_S)
    now = as_of_ts(as_of)
    action = classify(h, s, updated_col)
    upd = s.getField(updated_col)
    back_at = F.greatest(upd, h.getField("valid_from"))
    sentinel = lit_ts(OPEN_END_DATE)

    # Each key emits one or two versions; a small array of version kinds is
    # exploded and every output column is one CASE on the kind (small
    # expressions keep code generation cheap).
    kinds = (F.when(action == "insert", F.array(F.lit("open")))
              .when(action == "update", F.array(F.lit("close_upd"), F.lit("open")))
              .when(action == "delete", F.array(F.lit("close_now"), F.lit("marker")))
              .when(action == "return", F.array(F.lit("close_back"), F.lit("open_back")))
              .otherwise(F.array(F.lit("keep"))))
    e = p.select(_H, _S, back_at.alias("_back"), F.explode(kinds).alias("_kind"))
    kind, back = F.col("_kind"), F.col("_back")
    is_open = kind.isin("open", "open_back")
    start_at = (F.when(kind == "open", upd).when(kind == "open_back", back)
                 .when(kind == "marker", now).otherwise(h.getField("valid_from")))
    end_at = (F.when(kind == "close_upd", upd).when(kind == "close_now", now).when(kind == "close_back", back)
               .when(kind == "keep", h.getField("valid_to")).otherwise(sentinel))
    out_cols = [F.when(is_open, s.getField(c)).otherwise(h.getField(c)).alias(c) for c in cols]
    out_cols += [
        F.when(is_open | (kind == "marker"), scd_id(F.col(_K), start_at)).otherwise(h.getField("scd_id")).alias("scd_id"),
        start_at.alias("valid_from"),
        end_at.alias("valid_to"),
        F.when(is_open | (kind == "marker"), start_at).otherwise(h.getField("updated_at")).alias("updated_at"),
        (end_at == sentinel).alias("is_current"),
        F.when(kind == "marker", F.lit(True)).when(is_open, F.lit(False))
         .otherwise(h.getField("is_deleted")).alias("is_deleted"),
    ]
    out = e.withColumn(_K, F.coalesce(s.getField(key), h.getField(key))).select(*out_cols)
    return out.unionByName(closed.select(*hcols))


def current_view(history: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Current, not-deleted versions with their validity columns."""
    d = F.col("is_deleted")
    return (history.where((F.col("is_current") == F.lit(True)) & (~d | d.isNull()))
                   .select(*columns, "valid_from", "valid_to", "updated_at"))


#: Partition values of a history table: the current versions of a bucket, and
#: the versions that runs closed.
CLOSED = "closed"


def snapshot(spark, path: str, source: DataFrame, key: str, as_of=None, updated_col: str = SYNCED,
             soft_delete_as_delete: bool = False, num_buckets: Optional[int] = None, pii: Optional[dict] = None,
             docs: Optional[dict] = None) -> dict:
    """S10 sink: apply one snapshot run to the history table at ``path``.

    Layout: ``_part=c<bucket>`` holds the current version of every key
    (bucket = ``pmod(xxhash64(key), N)``), ``_part=closed`` of each commit the
    versions it closed. A run first compares keys and times (:func:`changes`)
    to learn the buckets that hold a change; it then pairs the rows of these
    buckets with the source and writes them and the versions it closed as one
    commit (``silver_table.commit``). Buckets without a change and closed
    history are neither read nor rewritten, and a run without changes commits
    nothing. ``pii`` tags (G1) and ``docs`` (S12) are kept with the table.
    """
    from argent.operators.governance import tag_pii
    from argent.operators.staging import with_docs
    from argent.sources.silver_table import (
        PART, bucket_expr, commit, conformed, first_buckets, hashed_keys, open_table, read_folders, reconciled,
    )

    if as_of is None:
        as_of = _dt.datetime.now(_dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")   # one value for the run
    table = open_table(spark, path)

    def described(schema: T.StructType) -> T.StructType:
        if not (pii or docs):
            return schema
        empty = spark.createDataFrame([], schema)
        have = {c: t for c, t in (docs or {}).items() if c in empty.columns}
        return with_docs(tag_pii(empty, pii or {}), have).schema

    if table is None:
        layout = {"keys": [key], "buckets": int(num_buckets or first_buckets(source))}
        out = scd2_apply(None, source, key, as_of, updated_col, soft_delete_as_delete)
        schema = described(out.schema)
        bucket = bucket_expr(hashed_keys(schema, [key]), layout["buckets"])
        out = out.withColumn(PART, F.concat(F.lit("c"), bucket.cast("string")))
        commit(out.hint("rebalance", PART), path, None, schema, layout, PART)
        return {"mode": "create", "buckets": layout["buckets"]}

    # the source columns of the table after this run, with types that hold both
    own = [f for f in table.schema.fields if f.name not in SCD_COLUMNS]
    columns = reconciled(T.StructType(own), source.schema, [key])
    source = conformed(source, columns)
    versions = T.StructType([f for f in table.schema.fields if f.name in SCD_COLUMNS])
    table.schema = described(T.StructType([*columns.fields, *versions.fields]))
    buckets = table.layout["buckets"]

    def bucket_of(schema: T.StructType) -> Column:
        return bucket_expr(hashed_keys(schema, [key]), buckets)
    current = read_folders(spark, table, lambda p: p != CLOSED).drop(PART)
    act = changes(current, source, key, as_of, updated_col, soft_delete_as_delete).where(~F.col("action").isin("unchanged", "deleted"))
    # at most as many small integers as the table has buckets
    touched = act.agg(F.collect_set(bucket_of(act.schema)).alias("b")).first()["b"]
    if not touched:
        return {"mode": "snapshot", "buckets": 0}
    if len(touched) < buckets:
        source = source.where(bucket_of(source.schema).isin([int(b) for b in touched]))
    parts = {f"c{b}" for b in touched}
    current = read_folders(spark, table, parts.__contains__).drop(PART)
    out = scd2_apply(current, source, key, as_of, updated_col, soft_delete_as_delete)
    part = F.when(F.col("is_current"), F.concat(F.lit("c"), bucket_of(out.schema).cast("string"))).otherwise(F.lit(CLOSED))
    # a bucket's versions together, a large bucket split over tasks
    out = out.withColumn(_K, bucket_of(out.schema)).hint("rebalance", _K).drop(_K)
    commit(out.withColumn(PART, part).select(*table.schema.fieldNames(), PART), path, table, table.schema, table.layout, PART,
           replaces=parts.__contains__)
    return {"mode": "snapshot", "buckets": len(touched)}
