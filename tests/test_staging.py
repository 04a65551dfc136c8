import datetime as dt

from argent.operators import staging as st
from argent.plans.models import MODELS, build_silver

T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
SCHEMA = "k long, v string, _synced timestamp_ntz, _deleted boolean"


def test_dedup_latest_nulls_first(spark):
    df = spark.createDataFrame([(1, "old", T1, False), (1, "new", T2, False), (2, "nullsync", None, False),
                                (2, "t1", T1, False), (None, "a", T1, False), (None, "b", T1, False)], SCHEMA)
    got = {r.k: r.v for r in st.dedup_latest(df, "k").collect()}
    assert got[1] == "new" and got[2] == "nullsync"
    assert st.dedup_latest(df, "k").where("k is null").count() == 1


def test_active_only_keeps_null(spark):
    df = spark.createDataFrame([(1, "a", T1, True), (2, "b", T1, False), (3, "c", T1, None)], SCHEMA)
    assert sorted(r.k for r in st.active_only(df).collect()) == [2, 3]


def test_delete_order_quirk(spark):
    df = spark.createDataFrame([(1, "v1", T1, False), (1, "v2", T2, True)], SCHEMA)
    ref = st.dedup_latest(st.active_only(df), "k").first()
    assert ref.v == "v1"
    prop = st.active_only(st.dedup_latest(df, "k"))
    assert prop.count() == 0


def test_incremental_filter_empty_target(spark):
    df = spark.createDataFrame([(1, "a", dt.datetime(1999, 12, 31), False), (2, "b", dt.datetime(2000, 1, 2), False)],
                               SCHEMA)
    target = spark.createDataFrame([], "_bronze_sync_timestamp timestamp_ntz")
    got = st.incremental_filter(df, target, lookback_days=0, as_of="2024-01-31 00:00:00")
    assert [r.k for r in got.collect()] == [2]


def test_incremental_filter_is_pushed_to_scan(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", T1, False)], SCHEMA)
    p = str(tmp_path / "b")
    df.write.parquet(p)
    plan = st.incremental_filter(spark.read.parquet(p), None, watermark="2023-12-31 00:00:00",
                                 as_of="2024-01-31 00:00:00")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "_synced" in plan


def test_build_silver_columns(spark):
    from tests.conftest import SF0001
    from argent.sources import fixtures as fx
    spec = MODELS["order_headers"]
    out = build_silver(fx.order_headers(spark, SF0001), spec, fx.ORDERS_AS_OF, "r1")
    assert out.columns == ["ORDER_ID", "CUSTOMER_ID", "ORDER_DATE", "TOTAL_AMOUNT", "ORDER_STATUS",
                           *st.AUDIT_COLUMNS]
    assert out.groupBy("ORDER_ID").count().where("count > 1").count() == 0
