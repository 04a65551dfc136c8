"""Staging steps shared by every silver model.

Each step is a DataFrame -> DataFrame function so a model is a ``transform``
chain (P11); Catalyst fuses the projections and pushes the filters into the
Parquet scan.
"""

from __future__ import annotations

from typing import Iterable, Optional, Sequence, Union

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from argent.functions.exprs import (
    DEV_WINDOW_DAYS, LOOKBACK_DAYS, MIN_DATE, as_of_ts, col_of, days_ago, lit_date, lit_ts,
)

SYNCED = "_synced"
DELETED = "_deleted"

# Audit columns added to every silver row.
AUDIT_SYNC = "_bronze_sync_timestamp"
AUDIT_LOAD = "_silver_load_timestamp"
AUDIT_RUN = "_run_id"
AUDIT_DELETED = "_is_deleted"
AUDIT_COLUMNS = (AUDIT_SYNC, AUDIT_LOAD, AUDIT_RUN, AUDIT_DELETED)


def active_only(df: DataFrame, deleted_col: str = DELETED) -> DataFrame:
    """Drop soft-deleted rows; a NULL flag counts as active."""
    d = F.col(deleted_col)
    return df.where(~d | d.isNull())


def dedup_latest(df: DataFrame, keys: Union[str, Sequence[str]], order_col: str = SYNCED,
                 tie_breakers: Sequence[Union[str, Column]] = ()) -> DataFrame:
    """Keep the newest row per key (NULL order value first).

    ``row_number() = 1`` lets Spark put a partial ``WindowGroupLimit`` before the
    shuffle, so every map task forwards at most one row per key: a key that
    holds a large share of the rows is cut down before it is shuffled.
    Tie-breakers make the pick deterministic when order values are equal.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [F.col(order_col).desc_nulls_first()] + [col_of(t).asc_nulls_first() for t in tie_breakers]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def add_audit(df: DataFrame, run_id: str, as_of=None, synced_col: str = SYNCED,
              deleted_col: str = DELETED) -> DataFrame:
    """Rename the change columns to audit names, stamp run id and load time."""
    rest = [c for c in df.columns if c not in (synced_col, deleted_col)]
    return df.select(*rest, F.col(synced_col).alias(AUDIT_SYNC), as_of_ts(as_of).alias(AUDIT_LOAD),
                     F.lit(run_id).alias(AUDIT_RUN), F.col(deleted_col).alias(AUDIT_DELETED))


def high_water(target: DataFrame, col: str = AUDIT_SYNC, min_date: str = MIN_DATE) -> Column:
    """A1: ``coalesce(max(col), min_date)`` over the target, as a one-row aggregate.

    Only the one column is read; partial aggregation runs in every scan task.
    """
    return F.coalesce(F.max(col), lit_ts(min_date))


def high_water_value(target: Optional[DataFrame], col: str = AUDIT_SYNC, min_date: str = MIN_DATE):
    """A1 collected: one scalar (the only value that crosses to the driver)."""
    if target is None:
        return None
    return target.agg(high_water(target, col, min_date).alias("hw")).first()["hw"]


def incremental_filter(df: DataFrame, target: Optional[DataFrame], synced_col: str = SYNCED,
                       min_date: str = MIN_DATE, lookback_days: int = LOOKBACK_DAYS,
                       as_of=None, watermark=None) -> DataFrame:
    """P5 + P6: rows newer than the target's high-water mark, or inside the
    look-back window (late rows are re-read).

    The mark is collected as a literal so that the filter reaches the Parquet
    scan (``PushedFilters``) and date-partitioned bronze is pruned.
    ``target is None`` is the first run: no filter.
    """
    if target is None and watermark is None:
        return df
    hw = watermark if watermark is not None else high_water_value(target, AUDIT_SYNC, min_date)
    s = F.col(synced_col)
    return df.where((s > lit_ts(hw)) | (s >= days_ago(lookback_days, as_of)))


def limit_dates(df: DataFrame, date_col: str, days: int = DEV_WINDOW_DAYS, as_of=None,
                env: str = "dev") -> DataFrame:
    """Outside production keep only the last ``days`` days of ``date_col``.

    Applied as its own filter (the reference's template binds it to one arm of
    the incremental OR; quirk Q1).
    """
    if env == "prod":
        return df
    today = lit_date(str(as_of)[:10]) if as_of is not None else F.current_date()
    return df.where(F.col(date_col).try_cast("date") >= F.date_sub(today, days))


def current_rows(history: DataFrame, current_col: str = "is_current",
                 deleted_col: str = "is_deleted") -> DataFrame:
    """P10: current versions whose delete flag is false or NULL."""
    d = F.col(deleted_col)
    return history.where((F.col(current_col) == F.lit(True)) & (~d | d.isNull()))


def violations(df: DataFrame, cond: Column) -> DataFrame:
    """The rows a check flags."""
    return df.where(cond)


def project(df: DataFrame, cols: Iterable[Union[str, Column]]) -> DataFrame:
    """Explicit projection (Catalyst prunes the scan to these columns)."""
    return df.select(*cols)


def with_docs(df: DataFrame, column_docs: dict) -> DataFrame:
    """Attach column descriptions (``comment`` metadata, kept in Parquet)."""
    out = df
    for c, text in column_docs.items():
        meta = dict(out.schema[c].metadata or {})
        meta["comment"] = text
        out = out.withMetadata(c, meta)
    return out
