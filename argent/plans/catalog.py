"""Registered queries: one per inventory row, each ``(spark, sf_dir) -> DataFrame``.

All of them read the driver tables (through the fixture recipes) in full, so
their work grows with the scale factor. Names are the inventory id in lower
case plus a short name.
"""

from __future__ import annotations

from typing import Callable, Dict, Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from argent.functions import exprs as fn
from argent.functions.exprs import lit_ts
from argent.operators import cdc, scd2
from argent.operators import governance as gov
from argent.operators import quality as dq
from argent.operators import staging as st
from argent.plans import pipeline
from argent.plans.checks import FRESHNESS, SUITES
from argent.plans.models import MODELS, build_silver, materialize
from argent.session import cut_lineage, work_dir
from argent.sources import fixtures as fx
from argent.sources.bronze import SOURCES, project_bronze, source_path
from argent.sources.silver_table import newest, read_table, write_table
from argent.streaming import run_incremental

RUN1 = "run-0001"
RUN2 = "run-0002"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: Dict[str, Query] = {}


def query(name: str):
    def deco(f):
        QUERIES[name] = f
        return f
    return deco


def full_build(spark, sf_dir, model: str, run_id: str = RUN1, **kw) -> DataFrame:
    spec = MODELS[model]
    return build_silver(fx.bronze(spark, sf_dir, spec.source), spec, fx.fixture_as_of(spec.source), run_id, **kw)


_M = [("m1", "registration_source"), ("m2", "incidents"), ("m3", "interactions"), ("m4", "surveys"),
      ("m5", "addresses"), ("m6", "brands"), ("m7", "categories"), ("m8", "city_tiers"),
      ("m9", "order_headers"), ("m10", "order_lines"), ("m11", "campaigns")]

for _id, _model in _M:
    QUERIES[f"{_id}_{_model}"] = (lambda m: lambda spark, sf_dir: full_build(spark, sf_dir, m))(_model)


# ---------------------------------------------------------------------------
# Two-run incremental fixtures (P5, P6, A1, S6-S9, J3, J4, ST3)
# ---------------------------------------------------------------------------


ORDERS_CUT = "2000-01-01 00:00:00"
EVENTS_CUT = "2024-01-20 00:00:00"
EARLY_DAY = "2024-01-30 00:00:00"   # rows of the last day delivered before the late ones


def run1_input(bronze: DataFrame, cut: str, early_from: str | None = None) -> DataFrame:
    cond = F.col(st.SYNCED) < lit_ts(cut)
    if early_from:
        cond = cond | (F.col(st.SYNCED) >= lit_ts(early_from))
    return bronze.where(cond)


def two_runs(spark, sf_dir, model: str, use_window=False, early_from=None) -> DataFrame:
    """Run 1 builds the table from rows before the cut; run 2 loads the whole
    bronze table incrementally and merges. Returns the table after run 2."""
    spec = MODELS[model]
    bronze = fx.bronze(spark, sf_dir, spec.source)
    orders = spec.source in ("order_headers", "order_lines")
    cut = ORDERS_CUT if orders else EVENTS_CUT
    path = work_dir(spark, f"silver-{model}")
    materialize(spark, spec, run1_input(bronze, cut, early_from), path, cut, RUN1, use_window=use_window)
    materialize(spark, spec, bronze, path, fx.fixture_as_of(spec.source), RUN2, use_window=use_window)
    return read_table(spark, path)


def run1_table(spark, sf_dir, model: str) -> DataFrame:
    spec = MODELS[model]
    bronze = fx.bronze(spark, sf_dir, spec.source)
    cut = ORDERS_CUT if spec.source in ("order_headers", "order_lines") else EVENTS_CUT
    return build_silver(run1_input(bronze, cut), spec, cut, RUN1)


@query("s1_read_bronze")
def _s1(spark, sf_dir):
    return project_bronze(fx.order_lines(spark, sf_dir), "order_lines")


@query("p1_select")
def _p1(spark, sf_dir):
    return st.project(fx.order_headers(spark, sf_dir), ["ORDER_ID", "CUSTOMER_ID", "ORDER_STATUS"])


def _dedup_active_brands(spark, sf_dir):
    b = fx.brands(spark, sf_dir)
    return st.dedup_latest(st.active_only(b), "BRAND_ID")


@query("p2_audit_rename")
def _p2(spark, sf_dir):
    return st.add_audit(_dedup_active_brands(spark, sf_dir), RUN1, fx.EVENTS_AS_OF) \
        .select("BRAND_ID", st.AUDIT_SYNC, st.AUDIT_DELETED)


@query("p3_run_id")
def _p3(spark, sf_dir):
    return st.add_audit(_dedup_active_brands(spark, sf_dir), RUN1, fx.EVENTS_AS_OF).select("BRAND_ID", st.AUDIT_RUN)


@query("p4_load_time")
def _p4(spark, sf_dir):
    return st.add_audit(_dedup_active_brands(spark, sf_dir), RUN1, fx.EVENTS_AS_OF).select("BRAND_ID", st.AUDIT_LOAD)


@query("p5_high_water_filter")
def _p5(spark, sf_dir):
    target = run1_table(spark, sf_dir, "interactions")
    b = fx.interactions(spark, sf_dir)
    return st.incremental_filter(b, target, lookback_days=0, as_of=fx.EVENTS_AS_OF) \
        .select("INTERACTION_ID", st.SYNCED, st.DELETED)


@query("p6_lookback")
def _p6(spark, sf_dir):
    target = run1_table(spark, sf_dir, "interactions")
    b = fx.interactions(spark, sf_dir)
    return st.incremental_filter(b, target, as_of=fx.EVENTS_AS_OF).select("INTERACTION_ID", st.SYNCED, st.DELETED)


@query("p7_active_only")
def _p7(spark, sf_dir):
    return st.active_only(fx.order_headers(spark, sf_dir)).select("ORDER_ID", st.SYNCED, st.DELETED)


@query("p8_limit_dates")
def _p8(spark, sf_dir):
    return full_build(spark, sf_dir, "order_headers", env="dev")


@query("p9_keep_rank1")
def _p9(spark, sf_dir):
    return st.dedup_latest(st.active_only(fx.order_headers(spark, sf_dir)), "ORDER_ID") \
        .select("ORDER_ID", "TOTAL_AMOUNT", st.SYNCED, st.DELETED)


@query("p11_transform_chain")
def _p11(spark, sf_dir):
    return full_build(spark, sf_dir, "city_tiers")


@query("p12_violations")
def _p12(spark, sf_dir):
    s = full_build(spark, sf_dir, "surveys")
    return st.violations(s, (F.col("NPS_SCORE") < 0) | (F.col("NPS_SCORE") > 10)).select("SURVEY_ID", "NPS_SCORE")


@query("w1_dedup_latest")
def _w1(spark, sf_dir):
    return st.dedup_latest(fx.order_lines(spark, sf_dir), "LINE_ID", st.SYNCED, ("ITEM_ID", "TIE")) \
        .select("LINE_ID", "ITEM_ID", "TIE", st.SYNCED, st.DELETED)


@query("o3_top1_per_group")
def _o3(spark, sf_dir):
    return st.dedup_latest(fx.orders_v1(spark, sf_dir), "CUSTOMER_ID", st.SYNCED, ("ORDER_ID",)) \
        .select("CUSTOMER_ID", "ORDER_ID", st.SYNCED)


@query("a1_high_water")
def _a1(spark, sf_dir):
    target = run1_table(spark, sf_dir, "order_headers")
    return target.agg(st.high_water(target).alias("high_water"))


@query("s6_merge_upsert")
def _s6(spark, sf_dir):
    return two_runs(spark, sf_dir, "order_headers")


@query("s7_merge_exclude")
def _s7(spark, sf_dir):
    return two_runs(spark, sf_dir, "order_lines").select("LINE_ID", st.AUDIT_LOAD, st.AUDIT_RUN, st.AUDIT_SYNC)


@query("s8_materialize")
def _s8(spark, sf_dir):
    spec = MODELS["addresses"]
    path = work_dir(spark, "silver-addresses")
    materialize(spark, spec, fx.addresses(spark, sf_dir), path, fx.EVENTS_AS_OF, RUN1)
    return read_table(spark, path)


@query("j3_merge_match")
def _j3(spark, sf_dir):
    return two_runs(spark, sf_dir, "surveys")


@query("j4_merge_window")
def _j4(spark, sf_dir):
    return two_runs(spark, sf_dir, "order_headers", use_window=True)


@query("u1_union")
def _u1(spark, sf_dir):
    return two_runs(spark, sf_dir, "campaigns")


@query("st3_late_data")
def _st3(spark, sf_dir):
    return two_runs(spark, sf_dir, "interactions", use_window=None, early_from=EARLY_DAY)


# ---------------------------------------------------------------------------
# Type-2 history
# ---------------------------------------------------------------------------

CUSTOMER_VIEW_COLS = ["CUSTOMER_ID", "EMAIL", "PHONE", "FIRST_NAME", "LAST_NAME",
                      "REGISTRATION_DATE", "CUSTOMER_TYPE", "STATUS"]


def history_table(spark, sf_dir, snap: str, runs=(1, 2, 3)) -> DataFrame:
    """Apply the snapshot runs through the bucketed history sink; return the table."""
    from argent.plans.models import SNAPSHOTS
    spec = SNAPSHOTS[snap]
    run_of = fx.customers_run if spec.source == "customers" else fx.items_run
    path = work_dir(spark, f"history-{snap}")
    for r in runs:
        scd2.snapshot(spark, path, run_of(spark, sf_dir, r), spec.key, fx.HISTORY_RUNS[r], pii=dict(spec.pii))
    return read_table(spark, path)


def history_in_memory(spark, sf_dir, runs=(1, 2, 3)) -> DataFrame:
    """The history as a DataFrame (no table); lineage is cut between runs so
    run n does not recompute runs 1..n-1."""
    h = None
    for i, r in enumerate(runs):
        h = scd2.scd2_apply(h, fx.customers_run(spark, sf_dir, r), "CUSTOMER_ID", fx.HISTORY_RUNS[r])
        if i < len(runs) - 1:
            h = cut_lineage(h)
    return h


@query("s10_scd2_apply")
def _s10(spark, sf_dir):
    return history_in_memory(spark, sf_dir)


@query("s10_history_evolve")
def _s10_evolve(spark, sf_dir):
    """PHONE appears in the source with run 2."""
    path = work_dir(spark, "history-evolve")
    for r in (1, 2, 3):
        source = fx.customers_run(spark, sf_dir, r)
        scd2.snapshot(spark, path, source.drop("PHONE") if r == 1 else source, "CUSTOMER_ID", fx.HISTORY_RUNS[r])
    return read_table(spark, path)


@query("m12_customer_history")
def _m12(spark, sf_dir):
    return history_table(spark, sf_dir, "customer_history")


@query("m13_item_history")
def _m13(spark, sf_dir):
    return history_table(spark, sf_dir, "item_history")


@query("m14_current_customers")
def _m14(spark, sf_dir):
    return scd2.current_view(history_table(spark, sf_dir, "customer_history"), CUSTOMER_VIEW_COLS)


@query("s11_current_view")
def _s11(spark, sf_dir):
    return scd2.current_view(history_table(spark, sf_dir, "item_history", runs=(1, 2)),
                             ["ITEM_ID", "STATUS", "CATEGORY_ID", "BRAND_ID"])


@query("p10_current_rows")
def _p10(spark, sf_dir):
    h = history_in_memory(spark, sf_dir, runs=(1, 2))
    return st.current_rows(h).select("CUSTOMER_ID", "STATUS", "valid_from", "is_deleted")


@query("j5_history_compare")
def _j5(spark, sf_dir):
    h = history_in_memory(spark, sf_dir, runs=(1, 2))
    return scd2.changes(h, fx.customers_run(spark, sf_dir, 3), "CUSTOMER_ID")


@query("f9_as_of")
def _f9(spark, sf_dir):
    return fx.interactions(spark, sf_dir).select(
        "INTERACTION_ID", fn.as_of_ts(fx.EVENTS_AS_OF).alias("AS_OF"),
        (F.col(st.SYNCED) <= fn.as_of_ts(fx.EVENTS_AS_OF)).alias("BEFORE_AS_OF"),
        (F.col(st.SYNCED) <= fn.as_of_ts()).alias("BEFORE_NOW"))


@query("f12_type_name")
def _f12(spark, sf_dir):
    return full_build(spark, sf_dir, "order_headers").select(
        "ORDER_ID", fn.type_of("ORDER_ID").alias("ID_TYPE"), fn.type_of("TOTAL_AMOUNT").alias("AMOUNT_TYPE"))


@query("f13_case_when")
def _f13(spark, sf_dir):
    k = F.col("CUSTOMER_ID")
    role = (F.when(k % 4 == 0, F.lit("compliance_role")).when(k % 4 == 1, F.lit("ADMIN_ROLE"))
            .when(k % 4 == 2, F.lit("ANALYST_ROLE")))
    return fx.customers(spark, sf_dir).select("CUSTOMER_ID", fn.mask_by_role("EMAIL", role).alias("EMAIL"))


@query("f16_open_end")
def _f16(spark, sf_dir):
    h = history_in_memory(spark, sf_dir, runs=(1, 2))
    return h.where(F.col("valid_to") == scd2.lit_ts(scd2.OPEN_END_DATE)).select("CUSTOMER_ID", "valid_from", "valid_to")


@query("f17_scd_id")
def _f17(spark, sf_dir):
    return history_in_memory(spark, sf_dir, runs=(1, 2)).select("CUSTOMER_ID", "updated_at", "scd_id")


# ---------------------------------------------------------------------------
# Data quality
# ---------------------------------------------------------------------------


@query("a2_duplicate_groups")
def _a2(spark, sf_dir):
    return dq.duplicate_groups(two_runs(spark, sf_dir, "order_headers", use_window=True), "ORDER_ID")


@query("d1_unique")
def _d1(spark, sf_dir):
    t = two_runs(spark, sf_dir, "order_headers", use_window=True)
    return dq.run_checks(t, [dq.unique("ORDER_ID")], "order_headers")


@query("d2_not_null")
def _d2(spark, sf_dir):
    return dq.run_checks(full_build(spark, sf_dir, "city_tiers"), SUITES["city_tiers"], "city_tiers")


@query("d3_in_range")
def _d3(spark, sf_dir):
    return dq.run_checks(full_build(spark, sf_dir, "surveys"), SUITES["surveys"], "surveys")


@query("d4_not_after")
def _d4(spark, sf_dir):
    return dq.run_checks(full_build(spark, sf_dir, "incidents"), [dq.not_after("INCIDENT_DATE")], "incidents",
                         as_of=EVENTS_CUT)


@query("d5_matches")
def _d5(spark, sf_dir):
    from argent.functions.exprs import EMAIL_PATTERN_COLUMN
    return dq.run_checks(fx.customers(spark, sf_dir),
                         [dq.not_null("EMAIL"), dq.matches("EMAIL", EMAIL_PATTERN_COLUMN)], "customers")


@query("d6_positive")
def _d6(spark, sf_dir):
    return dq.run_checks(full_build(spark, sf_dir, "campaigns"), [dq.positive("TOTAL_SPEND")], "campaigns")


@query("d7_has_type")
def _d7(spark, sf_dir):
    checks = [dq.has_type("ORDER_ID", "bigint"), dq.has_type("TOTAL_AMOUNT", "DECIMAL(18,2)"),
              dq.has_type("CUSTOMER_ID", "integer")]
    return dq.run_checks(full_build(spark, sf_dir, "order_headers"), checks, "order_headers")


@query("o2_type_probe")
def _o2(spark, sf_dir):
    checks = [dq.has_type("SURVEY_ID", "BIGINT"), dq.has_type("NPS_SCORE", "decimal(38,0)"),
              dq.has_type("CSAT_SCORE", "double")]
    return dq.run_checks(full_build(spark, sf_dir, "surveys"), checks, "surveys")


@query("d8_valid_email")
def _d8(spark, sf_dir):
    return dq.run_checks(fx.customers(spark, sf_dir), [dq.valid_email("EMAIL")], "customers")


def _orders_vs_history(spark, sf_dir):
    """Orders against the history after run 2."""
    orders = full_build(spark, sf_dir, "order_headers")
    hist = history_in_memory(spark, sf_dir, runs=(1, 2))
    return orders, hist


@query("j1_orphans")
def _j1(spark, sf_dir):
    orders, hist = _orders_vs_history(spark, sf_dir)
    return dq.orphans(orders, hist, "CUSTOMER_ID", F.col("is_current") == F.lit(True)).select("ORDER_ID", "CUSTOMER_ID")


@query("d9_references")
def _d9(spark, sf_dir):
    orders, hist = _orders_vs_history(spark, sf_dir)
    return dq.references(orders, hist, "CUSTOMER_ID", "order_headers", F.col("is_current") == F.lit(True))


def _bronze_tables(spark, sf_dir, *sources) -> str:
    """The bronze tables as the ingest keeps them; gives their root."""
    root = work_dir(spark, "bronze")
    for name in sources:
        write_table(fx.bronze(spark, sf_dir, name), source_path(root, name), SOURCES[name].key)
    return root


@query("a3_freshness")
def _a3(spark, sf_dir):
    root = _bronze_tables(spark, sf_dir, "interactions")
    return dq.freshness_of(newest(spark, source_path(root, "interactions"), st.SYNCED), "interactions", FRESHNESS["crm"],
                           "2024-01-31 01:30:00")


@query("d10_freshness")
def _d10(spark, sf_dir):
    return pipeline.source_freshness(spark, _bronze_tables(spark, sf_dir, *SOURCES), "2024-01-31 03:00:00")


@query("a4_run_checks")
def _a4(spark, sf_dir):
    return dq.run_checks(full_build(spark, sf_dir, "order_headers"), SUITES["order_headers"], "order_headers",
                         as_of=fx.ORDERS_AS_OF)


def _suite_results(spark, sf_dir):
    out = None
    for m in ("order_headers", "order_lines", "surveys", "campaigns", "city_tiers", "registration_source"):
        r = dq.run_checks(full_build(spark, sf_dir, m), SUITES[m], m, as_of=fx.fixture_as_of(m))
        out = r if out is None else out.unionByName(r)
    return out


@query("d11_run_status")
def _d11(spark, sf_dir):
    return dq.run_status(_suite_results(spark, sf_dir))


@query("j2_inner_join_order")
def _j2(spark, sf_dir):
    o = full_build(spark, sf_dir, "order_headers")
    c = fx.customers(spark, sf_dir).select("CUSTOMER_ID", "LAST_NAME")
    return o.join(c, "CUSTOMER_ID", "inner").select("ORDER_ID", "CUSTOMER_ID", "LAST_NAME") \
        .orderBy("LAST_NAME", "ORDER_ID")


@query("o1_sort")
def _o1(spark, sf_dir):
    return full_build(spark, sf_dir, "campaigns").select("CAMPAIGN_ID", "CAMPAIGN_NAME").orderBy("CAMPAIGN_NAME")


# ---------------------------------------------------------------------------
# Change feeds (S2-S5), schema evolution (S9), docs
# ---------------------------------------------------------------------------

CHANGE_COLS = ["ORDER_ID", "CUSTOMER_ID", "ORDER_DATE", "TOTAL_AMOUNT", "ORDER_STATUS"]
CAMPAIGN_COLS = ["CAMPAIGN_NAME", "TOTAL_SPEND", "CUSTOMERS_ACQUIRED"]


@query("s2_apply_changes")
def _s2(spark, sf_dir):
    path = work_dir(spark, "bronze-order-headers")
    write_table(fx.orders_bronze_base(spark, sf_dir), path, "ORDER_ID")
    cdc.apply_changes_to_table(spark, path, fx.order_changes(spark, sf_dir), "ORDER_ID", fx.SEQ,
                               as_of=fx.ORDERS_AS_OF)
    return read_table(spark, path)


@query("s2_ingest_runs")
def _s2i(spark, sf_dir):
    """Two deliveries of the order headers' change log through the ingest."""
    landing, bronze = work_dir(spark, "landing"), work_dir(spark, "bronze-erp")
    first = fx.orders_bronze_base(spark, sf_dir).select(*CHANGE_COLS, F.col(st.SYNCED).alias(fx.SEQ), F.lit("I").alias(cdc.OP))
    for n, (delivery, as_of) in enumerate([(first, "2001-08-02 00:00:00"), (fx.order_changes(spark, sf_dir), fx.ORDERS_AS_OF)]):
        delivery.write.parquet(source_path(f"{landing}/{n}", "order_headers"))
        pipeline.run_ingest(spark, f"{landing}/{n}", bronze, as_of, groups=["erp"])
    return read_table(spark, source_path(bronze, "order_headers"))


@query("s3_ingest_compare")
def _s3i(spark, sf_dir):
    """Two full extracts of the campaigns through the ingest."""
    landing, bronze = work_dir(spark, "landing"), work_dir(spark, "bronze-marketing")
    for n, as_of in ((1, "2024-01-30 00:00:00"), (2, fx.EVENTS_AS_OF)):
        fx.campaigns_extract(spark, sf_dir, n).write.parquet(source_path(f"{landing}/{n}", "campaigns"))
        pipeline.run_ingest(spark, f"{landing}/{n}", bronze, as_of, groups=["marketing"])
    return read_table(spark, source_path(bronze, "campaigns"))


@query("s3_snapshot_diff")
def _s3(spark, sf_dir):
    return cdc.snapshot_diff(fx.campaigns_extract(spark, sf_dir, 1), fx.campaigns_extract(spark, sf_dir, 2),
                             "CAMPAIGN_ID", CAMPAIGN_COLS)


@query("s3_orders_diff")
def _s3o(spark, sf_dir):
    return cdc.snapshot_diff(fx.orders_extract(spark, sf_dir, 1), fx.orders_extract(spark, sf_dir, 2), "ORDER_ID")


@query("s3_full_compare_apply")
def _s3a(spark, sf_dir):
    """The marketing source has no change log: diff the new extract against
    the previous one and apply it to bronze (inserts, updates, soft deletes)."""
    prev = fx.campaigns_extract(spark, sf_dir, 1)
    path = work_dir(spark, "bronze-campaigns")
    write_table(prev.select("*", lit_ts("2024-01-30 00:00:00").alias(st.SYNCED), F.lit(False).alias(st.DELETED)),
                path, "CAMPAIGN_ID")
    d = cdc.snapshot_diff(prev, fx.campaigns_extract(spark, sf_dir, 2), "CAMPAIGN_ID", CAMPAIGN_COLS)
    cdc.apply_changes_to_table(spark, path, cdc.diff_as_changes(d), "CAMPAIGN_ID", "_seq", as_of=fx.EVENTS_AS_OF)
    return read_table(spark, path)


@query("s4_changed_columns")
def _s4(spark, sf_dir):
    d = cdc.diff_changed_columns(fx.campaigns_extract(spark, sf_dir, 1), fx.campaigns_extract(spark, sf_dir, 2),
                                 "CAMPAIGN_ID", CAMPAIGN_COLS)
    return d.select("CAMPAIGN_ID", F.array_join("changed_columns", ",").alias("changed_columns"))


@query("s5_retain_changes")
def _s5(spark, sf_dir):
    return cdc.retain_changes(fx.interactions(spark, sf_dir), st.SYNCED, as_of=fx.EVENTS_AS_OF) \
        .select("INTERACTION_ID", st.SYNCED)


@query("s9_schema_evolve")
def _s9(spark, sf_dir):
    from dataclasses import replace
    spec = MODELS["campaigns"]
    old = replace(spec, columns=spec.columns[:2])
    bronze = fx.campaigns(spark, sf_dir)
    path = work_dir(spark, "silver-campaigns-evolve")
    materialize(spark, old, run1_input(bronze, EVENTS_CUT), path, EVENTS_CUT, RUN1)
    materialize(spark, spec, bronze, path, fx.EVENTS_AS_OF, RUN2)
    return read_table(spark, path)


@query("s9_type_widen")
def _s9w(spark, sf_dir):
    """CUSTOMER_ID is an int in the source of run 1 and a bigint in run 2."""
    spec = MODELS["order_headers"]
    bronze = fx.order_headers(spark, sf_dir)
    path = work_dir(spark, "silver-headers-widen")
    narrow = run1_input(bronze, ORDERS_CUT).withColumn("CUSTOMER_ID", F.col("CUSTOMER_ID").cast("int"))
    materialize(spark, spec, narrow, path, ORDERS_CUT, RUN1)
    materialize(spark, spec, bronze.withColumn("CUSTOMER_ID", F.col("CUSTOMER_ID").cast("bigint")), path, fx.ORDERS_AS_OF, RUN2)
    return read_table(spark, path)


@query("s12_with_docs")
def _s12(spark, sf_dir):
    docs = {"BRAND_ID": "Brand key", "BRAND_NAME": "Brand name, 'Unknown' when missing"}
    return st.with_docs(full_build(spark, sf_dir, "brands"), docs)


# ---------------------------------------------------------------------------
# Governance
# ---------------------------------------------------------------------------


@query("g1_tag_pii")
def _g1(spark, sf_dir):
    return gov.tag_pii(fx.customers(spark, sf_dir), gov.CUSTOMER_PII)


@query("g2_mask_string")
def _g2(spark, sf_dir):
    c = fx.customers(spark, sf_dir)
    return c.select("CUSTOMER_ID", fn.mask_string("EMAIL").alias("EMAIL"), fn.mask_string("PHONE").alias("PHONE"),
                    fn.mask_string("FIRST_NAME", ["COMPLIANCE_ROLE"]).alias("FIRST_NAME"))


@query("g3_mask_date")
def _g3(spark, sf_dir):
    o = fx.orders_v1(spark, sf_dir)
    d = F.to_date("ORDER_DATE")
    return o.select("ORDER_ID", fn.mask_date(d).alias("ORDER_DAY"), fn.mask_date(d, ["ADMIN_ROLE"]).alias("ORDER_DAY_ADMIN"))


@query("g4_masked_view")
def _g4(spark, sf_dir):
    return gov.masked_view(gov.tag_pii(fx.customers(spark, sf_dir), gov.CUSTOMER_PII))


# ---------------------------------------------------------------------------
# Column functions
# ---------------------------------------------------------------------------
@query("f1_or_unknown")
def _f1(spark, sf_dir):
    return fx.categories(spark, sf_dir).select("CATEGORY_ID", fn.or_unknown("CATEGORY_NAME").alias("CATEGORY_NAME"))


@query("f2_clean_upper")
def _f2(spark, sf_dir):
    return fx.addresses(spark, sf_dir).select("ADDRESS_ID", fn.clean_upper("CITY").alias("CITY"),
                                              fn.clean_upper("STATE").alias("STATE"))


@query("f3_money")
def _f3(spark, sf_dir):
    return fx.order_lines(spark, sf_dir).select("LINE_ID", "TIE", fn.money("UNIT_PRICE").alias("UNIT_PRICE"))


@query("f4_whole")
def _f4(spark, sf_dir):
    return fx.surveys(spark, sf_dir).select("SURVEY_ID", fn.whole("NPS_SCORE").alias("NPS_SCORE"),
                                            fn.whole(F.col("CSAT_SCORE") / 2).alias("CSAT_HALF"))


@query("f5_to_text")
def _f5(spark, sf_dir):
    return fx.campaigns(spark, sf_dir).select("CAMPAIGN_ID", fn.to_text("CUSTOMERS_ACQUIRED").alias("CUSTOMERS_ACQUIRED"))


@query("f6_try_ts")
def _f6(spark, sf_dir):
    return fx.incidents(spark, sf_dir).select("INCIDENT_ID", fn.try_ts("INCIDENT_DATE").alias("INCIDENT_DATE"))


@query("f8_days_ago")
def _f8(spark, sf_dir):
    return fx.interactions(spark, sf_dir).where(F.col(st.SYNCED) >= fn.days_ago(3, fx.EVENTS_AS_OF)) \
        .select("INTERACTION_ID", st.SYNCED)


@query("f10_is_email")
def _f10(spark, sf_dir):
    return fx.customers(spark, sf_dir).select("CUSTOMER_ID", fn.is_email("EMAIL").alias("EMAIL_OK"))


@query("f11_regex")
def _f11(spark, sf_dir):
    e = F.col("EMAIL")
    return fx.customers(spark, sf_dir).select(
        "CUSTOMER_ID",
        e.rlike(fn.full_match(fn.EMAIL_PATTERN_MACRO)).alias("match_macro"),
        e.rlike(fn.full_match(fn.EMAIL_PATTERN_TEST)).alias("match_test"),
        e.rlike(fn.full_match(fn.EMAIL_PATTERN_COLUMN)).alias("match_column"))


@query("f14_year_floor")
def _f14(spark, sf_dir):
    return fx.orders_v1(spark, sf_dir).select("ORDER_ID", fn.year_floor(st.SYNCED).alias("ORDER_YEAR"))


@query("f15_upper_differs")
def _f15(spark, sf_dir):
    return fx.categories(spark, sf_dir).select("CATEGORY_ID",
                                               fn.upper_differs("CATEGORY_ID", "CATEGORY_NAME").alias("DIFFERS"))


# ---------------------------------------------------------------------------
# Streaming (ST1, ST2, ST4)
# ---------------------------------------------------------------------------


def _land(df: DataFrame, path: str) -> None:
    """Deliver a bronze extract as new files in a landing folder."""
    df.write.mode("append").parquet(path)


def streamed_table(spark, sf_dir, model: str, deliveries, files_per_batch: Optional[int] = None) -> DataFrame:
    spec = MODELS[model]
    root = work_dir(spark, f"stream-{model}")
    landing, target, ckpt = f"{root}/landing", f"{root}/silver", f"{root}/_checkpoint"
    schema = None
    for d in deliveries:
        df = d(spark, sf_dir)
        schema = schema or df.schema
        _land(df, landing)
        run_incremental(spark, spec, landing, schema, target, ckpt, fx.fixture_as_of(spec.source), RUN1,
                        max_files_per_trigger=files_per_batch)
    return read_table(spark, target)


@query("st1_micro_batch")
def _st1(spark, sf_dir):
    return streamed_table(spark, sf_dir, "surveys", [fx.surveys])


@query("st2_stream_upsert")
def _st2(spark, sf_dir):
    return streamed_table(spark, sf_dir, "order_headers", [fx.orders_v1, fx.orders_v2], files_per_batch=2)


@query("st4_stream_high_water")
def _st4(spark, sf_dir):
    t = streamed_table(spark, sf_dir, "order_headers", [fx.orders_v1, fx.orders_v2])
    return t.agg(st.high_water(t).alias("high_water"))


@query("f7_lit_ts")
def _f7(spark, sf_dir):
    d = fx.incidents(spark, sf_dir)
    return d.select("INCIDENT_ID", F.coalesce(fn.try_ts("INCIDENT_DATE"), fn.lit_ts(fn.MIN_DATE)).alias("INCIDENT_AT"))
