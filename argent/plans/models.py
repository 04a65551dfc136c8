"""Silver model specs (M1-M13) and the build / materialize entry points.

A staging model is: bronze scan (S1) -> incremental filter (P5/P6) ->
[dev date window (P8)] -> active rows (P7) -> newest per key (W1) ->
cleaning -> audit columns (P2-P4) -> create or merge (S8 / S6).
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass
from typing import Callable, Dict, Optional, Sequence, Tuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from argent.functions.exprs import LOOKBACK_DAYS, clean_upper, money, or_unknown, to_text, try_ts, whole
from argent.operators.merge import recent_match
from argent.operators.staging import (
    AUDIT_COLUMNS, DELETED, SYNCED, active_only, add_audit, dedup_latest, incremental_filter, limit_dates, with_docs,
)

Clean = Optional[Callable[[Column], Column]]


@dataclass(frozen=True)
class ModelSpec:
    name: str
    source: str
    group: str                       # erp / crm / marketing (freshness group)
    key: str
    columns: Tuple[Tuple[str, Clean], ...]   # business columns after the key, with cleaning
    match_window: bool = False       # J4: only recent target rows may match
    date_limit: Optional[str] = None  # P8 column (outside production)
    tie_breakers: Tuple[str, ...] = ()
    growing_key: bool = False        # ids come in time order: key-range buckets

    @property
    def column_names(self) -> list:
        return [c for c, _ in self.columns]

    @property
    def docs(self) -> dict:
        return {c: COLUMN_DOCS[c] for c in (self.key, *self.column_names, *AUDIT_COLUMNS) if c in COLUMN_DOCS}

    @property
    def ties(self) -> list:
        """Order of rows with one key and sync time: the tie-breakers, then every
        other column of the model, so that only equal rows are left to chance."""
        return list(dict.fromkeys([*self.tie_breakers, *self.column_names, DELETED]))

    @property
    def scan_columns(self) -> list:
        extra = [t for t in self.tie_breakers if t not in self.column_names and t != self.key]
        return [self.key, *self.column_names, *extra, SYNCED, DELETED]


@dataclass(frozen=True)
class SnapshotSpec:
    name: str
    source: str
    key: str
    columns: Tuple[str, ...]
    pii: Tuple[Tuple[str, str], ...] = ()     # (column, PII class) tags written with the table

    @property
    def docs(self) -> dict:
        return {c: COLUMN_DOCS[c] for c in (self.key, *self.columns, *HISTORY_DOCS) if c in COLUMN_DOCS}


# Column descriptions kept with every table.
HISTORY_DOCS = ("scd_id", "valid_from", "valid_to", "updated_at", "is_current", "is_deleted")
COLUMN_DOCS: Dict[str, str] = {
    "REGISTRATION_ID": "Key of the registration", "INCIDENT_ID": "Key of the incident", "INTERACTION_ID": "Key of the interaction",
    "SURVEY_ID": "Key of the survey answer", "ADDRESS_ID": "Key of the address", "BRAND_ID": "Key of the brand",
    "CATEGORY_ID": "Key of the category", "CITY_TIER_ID": "Key of the city tier", "ORDER_ID": "Key of the order",
    "LINE_ID": "Key of the order line", "CAMPAIGN_ID": "Key of the campaign", "ITEM_ID": "Key of the item",
    "CUSTOMER_ID": "Key of the customer", "CHANNEL": "Channel of the registration, 'Unknown' when missing",
    "INCIDENT_DATE": "Time of the incident, null when it cannot be read", "INTERACTION_DATE": "Time of the interaction, null when it cannot be read",
    "NPS_SCORE": "Recommendation score, 0 to 10", "CSAT_SCORE": "Satisfaction score, 1 to 5", "CITY": "City, upper case", "STATE": "State, upper case",
    "TIER": "Tier of the city, upper case", "BRAND_NAME": "Name of the brand, 'Unknown' when missing",
    "CATEGORY_NAME": "Name of the category, 'Unknown' when missing", "ORDER_DATE": "Time of the order, null when it cannot be read",
    "TOTAL_AMOUNT": "Amount of the order, two decimals", "ORDER_STATUS": "Status of the order, upper case", "QUANTITY": "Ordered pieces",
    "UNIT_PRICE": "Price of a piece, two decimals", "CAMPAIGN_NAME": "Name of the campaign", "TOTAL_SPEND": "Spend, whole number",
    "CUSTOMERS_ACQUIRED": "Customers won, whole number", "EMAIL": "E-mail address", "PHONE": "Phone number", "FIRST_NAME": "First name", "LAST_NAME": "Last name",
    "REGISTRATION_DATE": "Time of registration", "CUSTOMER_TYPE": "Type of customer", "STATUS": "Status as the source has it",
    "_bronze_sync_timestamp": "When the row reached bronze", "_silver_load_timestamp": "When the row first reached silver",
    "_run_id": "Run that wrote the row last", "_is_deleted": "Soft-delete flag of the source",
    "scd_id": "Key of the version", "valid_from": "Start of the version", "valid_to": "End of the version, 9999-12-31 while it is current",
    "updated_at": "Sync time that opened the version", "is_current": "Whether the version is the current one", "is_deleted": "Whether the version marks a delete",
}

# Event-keyed CRM tables get ids in time order: key-range buckets keep an
# incremental merge inside the newest few buckets.
MODELS: Dict[str, ModelSpec] = {m.name: m for m in [
    ModelSpec("registration_source", "registration_source", "crm", "REGISTRATION_ID",
              (("CUSTOMER_ID", None), ("CHANNEL", or_unknown)), growing_key=True),
    ModelSpec("incidents", "incidents", "crm", "INCIDENT_ID",
              (("CUSTOMER_ID", None), ("INCIDENT_DATE", try_ts)), growing_key=True),
    ModelSpec("interactions", "interactions", "crm", "INTERACTION_ID",
              (("CUSTOMER_ID", None), ("INTERACTION_DATE", try_ts)), match_window=True, growing_key=True),
    ModelSpec("surveys", "surveys", "crm", "SURVEY_ID",
              (("CUSTOMER_ID", None), ("NPS_SCORE", whole), ("CSAT_SCORE", whole)), growing_key=True),
    ModelSpec("addresses", "addresses", "erp", "ADDRESS_ID",
              (("CITY", clean_upper), ("STATE", clean_upper))),
    ModelSpec("brands", "brands", "erp", "BRAND_ID", (("BRAND_NAME", or_unknown),)),
    ModelSpec("categories", "categories", "erp", "CATEGORY_ID", (("CATEGORY_NAME", or_unknown),)),
    ModelSpec("city_tiers", "city_tiers", "erp", "CITY_TIER_ID",
              (("CITY", clean_upper), ("STATE", clean_upper), ("TIER", clean_upper))),
    ModelSpec("order_headers", "order_headers", "erp", "ORDER_ID",
              (("CUSTOMER_ID", None), ("ORDER_DATE", try_ts), ("TOTAL_AMOUNT", money),
               ("ORDER_STATUS", clean_upper)), match_window=True, date_limit="ORDER_DATE"),
    ModelSpec("order_lines", "order_lines", "erp", "LINE_ID",
              (("ORDER_ID", None), ("ITEM_ID", None), ("QUANTITY", whole), ("UNIT_PRICE", money)),
              match_window=True, tie_breakers=("ITEM_ID",)),
    ModelSpec("campaigns", "campaigns", "marketing", "CAMPAIGN_ID",
              (("CAMPAIGN_NAME", to_text), ("TOTAL_SPEND", whole), ("CUSTOMERS_ACQUIRED", whole))),
]}

SNAPSHOTS: Dict[str, SnapshotSpec] = {s.name: s for s in [
    SnapshotSpec("customer_history", "customers", "CUSTOMER_ID",
                 ("EMAIL", "PHONE", "FIRST_NAME", "LAST_NAME", "REGISTRATION_DATE", "CUSTOMER_TYPE", "STATUS"),
                 pii=(("EMAIL", "EMAIL"), ("PHONE", "PHONE"), ("FIRST_NAME", "FIRST_NAME"), ("LAST_NAME", "LAST_NAME"))),
    SnapshotSpec("item_history", "items", "ITEM_ID", ("STATUS", "CATEGORY_ID", "BRAND_ID")),
]}


def clean(df: DataFrame, spec: ModelSpec) -> DataFrame:
    """The model's own projection: key, cleaned columns, change columns."""
    cols = [F.col(spec.key)]
    for name, fn in spec.columns:
        cols.append((fn(F.col(name)) if fn else F.col(name)).alias(name))
    return df.select(*cols, SYNCED, DELETED)


def build_silver(bronze: DataFrame, spec: ModelSpec, as_of, run_id: str,
                 target: Optional[DataFrame] = None, env: str = "prod",
                 lookback_days: int = LOOKBACK_DAYS, propagate_deletes: bool = False,
                 watermark=None) -> DataFrame:
    """The batch of one run of a staging model (before the merge).

    ``target`` (the current silver table) turns on the incremental filter;
    ``propagate_deletes`` dedups before dropping deletes, so that a delete
    reaches silver as ``_is_deleted = true`` (quirk Q2; off = reference order).
    """
    df = bronze.select(*spec.scan_columns)
    if target is not None or watermark is not None:
        df = incremental_filter(df, target, SYNCED, lookback_days=lookback_days, as_of=as_of,
                                watermark=watermark)
    if spec.date_limit:
        df = limit_dates(df, spec.date_limit, as_of=as_of, env=env)
    if propagate_deletes:
        df = dedup_latest(df, spec.key, SYNCED, spec.ties)
    else:
        df = dedup_latest(active_only(df), spec.key, SYNCED, spec.ties)
    return df.transform(lambda d: clean(d, spec)).transform(lambda d: add_audit(d, run_id, as_of))


def match_condition(spec: ModelSpec, as_of, use_window: Optional[bool] = None,
                    lookback_days: int = LOOKBACK_DAYS):
    """J4 destination predicate for models that declare it (or when forced)."""
    on = spec.match_window if use_window is None else use_window
    return recent_match(lookback_days, as_of) if on else None


def utc_now() -> str:
    return _dt.datetime.now(_dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


def window_start(as_of, lookback_days: int = LOOKBACK_DAYS) -> _dt.datetime:
    """The time from which the match window of a run matches."""
    at = as_of if isinstance(as_of, _dt.datetime) else _dt.datetime.fromisoformat(str(as_of))
    return at - _dt.timedelta(days=lookback_days)


def materialize(spark: SparkSession, spec: ModelSpec, bronze: DataFrame, path: str, as_of, run_id: str,
                env: str = "prod", use_window: Optional[bool] = False, full_refresh: bool = False,
                lookback_days: int = LOOKBACK_DAYS, propagate_deletes: bool = False,
                num_buckets: Optional[int] = None, range_width: Optional[int] = None) -> dict:
    """First run creates the table, later runs merge incrementally.

    ``full_refresh`` is refused: silver tables are never rebuilt (the
    reference disables it).  ``use_window=None`` follows the spec's J4 flag;
    the default key-only match keeps the table unique (quirk Q3). A table whose
    first run has the match window is laid out by sync time, so that later runs
    read and rewrite only the folders in it.
    ``propagate_deletes`` lets deletes reach the table (quirk Q2).
    ``num_buckets`` or ``range_width`` set the layout of a first build; without
    them it comes from the size of the bronze table (and the span of its keys,
    for a key that grows with time). A stored table keeps its own. Column
    descriptions and one of the table are kept with it (S12).
    """
    from argent.sources.silver_table import day_unit_for, merge_upsert, range_width_for, table_high_water

    if full_refresh:
        raise ValueError(f"full refresh of {spec.name} is disabled")
    as_of = as_of or utc_now()                  # one value for the run
    hw = table_high_water(spark, path)          # None on the first run
    window = match_condition(spec, as_of, use_window, lookback_days)
    if hw is None and window is None and spec.growing_key and not (num_buckets or range_width):
        range_width = range_width_for(bronze.select(*spec.scan_columns), spec.key)
    day_unit = day_unit_for(bronze.select(*spec.scan_columns), SYNCED) if hw is None and window is not None else "day"
    batch = build_silver(bronze, spec, as_of, run_id, env=env, lookback_days=lookback_days,
                         propagate_deletes=propagate_deletes, watermark=hw)
    return merge_upsert(spark, path, with_docs(batch, spec.docs), spec.key, match_cond=window, num_buckets=num_buckets,
                        comment=f"Newest row per {spec.key} of {spec.source}", range_width=range_width, day_unit=day_unit,
                        window_from=window_start(as_of, lookback_days) if window is not None else None)
