from pyspark.sql import Window
from pyspark.sql import functions as F

from argent.operators import scd2
from argent.session import work_dir
from argent.sources import fixtures as fx
from argent.sources.silver_table import read_table

from tests.conftest import SF001, rows


def test_three_runs_match_fixture_counts(spark):
    path = work_dir(spark, "t-hist")
    counts = []
    for r in (1, 2, 3):
        src = fx.customers_run(spark, SF001, r)
        scd2.snapshot(spark, path, src, "CUSTOMER_ID", fx.HISTORY_RUNS[r], num_buckets=8)
        h = read_table(spark, path)
        counts.append(h.count())
        before = rows(h)
        scd2.snapshot(spark, path, src, "CUSTOMER_ID", fx.HISTORY_RUNS[r], num_buckets=8)   # re-run: no change
        assert rows(read_table(spark, path)) == before
    assert counts == [1350, 1855, 1895]
    h = read_table(spark, path)
    assert scd2.current_view(h, ["CUSTOMER_ID"]).count() == 1469
    # at most one current row per key, contiguous non-overlapping intervals
    assert h.where("is_current").groupBy("CUSTOMER_ID").count().where("count > 1").count() == 0
    w = Window.partitionBy("CUSTOMER_ID").orderBy("valid_from")
    gaps = h.withColumn("nxt", F.lead("valid_from").over(w)).where("nxt is not null and nxt <> valid_to")
    assert gaps.count() == 0


def test_marker_and_return(spark):
    import datetime as dt
    S = "k long, v string, _synced timestamp_ntz"
    d = lambda day: dt.datetime(2024, 1, day)
    h = scd2.scd2_apply(None, spark.createDataFrame([(1, "a", d(5))], S), "k", "2024-01-10")
    h = scd2.scd2_apply(h, spark.createDataFrame([], S), "k", "2024-01-20")
    got = sorted((r.valid_from, r.valid_to, r.is_deleted) for r in h.collect())
    assert got == [(d(5), d(20), False), (d(20), dt.datetime(9999, 12, 31), True)]
    h = scd2.scd2_apply(h, spark.createDataFrame([(1, "b", d(25))], S), "k", "2024-01-30")
    cur = h.where("is_current").collect()
    assert len(cur) == 1 and cur[0].v == "b" and not cur[0].is_deleted and h.count() == 3


def test_new_source_columns_reach_the_history(spark):
    import datetime as dt
    d = lambda day: dt.datetime(2024, 1, day)
    path = work_dir(spark, "t-hist-evolve")
    runs = [(10, [(1, "a", d(5)), (2, "b", d(5)), (3, "c", d(5))], "k long, v string, _synced timestamp_ntz"),
            (20, [(1, "a", d(15)), (2, "b", d(5)), (3, "c", d(15))], "k long, v string, _synced timestamp_ntz"),
            (30, [(1, "a", d(25), "x"), (2, "b", d(5), "y"), (4, "d", d(25), "z")], "k long, v string, _synced timestamp_ntz, w string"),
            (31, [(1, d(25), "x"), (2, d(5), "y"), (4, d(30), "zz")], "k long, _synced timestamp_ntz, w string")]
    for day, data, schema in runs:
        source = spark.createDataFrame(data, schema)
        scd2.snapshot(spark, path, source, "k", f"2024-01-{day}", num_buckets=4)
    h = read_table(spark, path)
    assert h.columns == ["k", "v", "_synced", "w", *scd2.SCD_COLUMNS]
    got = sorted(((r.k, r.valid_from.day, r.v, r.w, r.is_current) for r in h.where("not is_deleted").collect()))
    assert got == [(1, 5, "a", None, False), (1, 15, "a", None, False), (1, 25, "a", "x", True), (2, 5, "b", None, True),
                   (3, 5, "c", None, False), (3, 15, "c", None, False), (4, 25, "d", "z", False), (4, 30, None, "zz", True)]
    actions = {r.k: r.action for r in scd2.changes(h, spark.createDataFrame([(4, d(31), "zz", 1)], "k long, _synced timestamp_ntz, w string, n int"), "k").collect()}
    assert actions == {1: "delete", 2: "delete", 3: "deleted", 4: "update"}


def test_history_keeps_pii_tags(spark):
    from argent.operators import governance as gov
    path = work_dir(spark, "t-hist-tags")
    tags = {"EMAIL": "EMAIL", "PHONE": "PHONE"}
    for r in (1, 2):
        scd2.snapshot(spark, path, fx.customers_run(spark, SF001, r), "CUSTOMER_ID", fx.HISTORY_RUNS[r],
                      num_buckets=4, pii=tags)
    h = read_table(spark, path)
    assert gov.pii_columns(h) == tags
    assert gov.masked_view(h).where("EMAIL <> '***MASKED***'").count() == 0


def _folders(spark, path):
    """Live partition folders and the commits that wrote them."""
    from argent.sources.silver_table import open_table
    return {(c, p) for c, parts in open_table(spark, path).live.items() for p in parts}


def test_runs_never_rewrite_closed_history(spark):
    path = work_dir(spark, "t-hist-parts")
    closed = []
    for r in (1, 2, 3):
        scd2.snapshot(spark, path, fx.customers_run(spark, SF001, r), "CUSTOMER_ID", fx.HISTORY_RUNS[r],
                      num_buckets=4)
        closed.append({f for f in _folders(spark, path) if f[1] == scd2.CLOSED})
    assert [len(c) for c in closed] == [0, 1, 2] and closed[1] < closed[2]
    assert read_table(spark, path).where("is_current").count() == 1500      # one current row per key
    # the same run again commits nothing
    before = _folders(spark, path)
    assert scd2.snapshot(spark, path, fx.customers_run(spark, SF001, 3), "CUSTOMER_ID", fx.HISTORY_RUNS[3])["buckets"] == 0
    assert _folders(spark, path) == before and read_table(spark, path).count() == 1895


def test_a_run_rewrites_only_buckets_with_a_change(spark):
    import datetime as dt
    path = work_dir(spark, "t-hist-few")
    base = spark.range(500).select(F.col("id").alias("k"), F.lit("a").alias("v"), F.lit(dt.datetime(2024, 1, 5)).alias("_synced"))
    scd2.snapshot(spark, path, base, "k", "2024-01-10", num_buckets=16)
    first = _folders(spark, path)
    one = base.withColumns({"v": F.when(F.col("k") == 7, "b").otherwise(F.col("v")),
                            "_synced": F.when(F.col("k") == 7, F.lit(dt.datetime(2024, 1, 15))).otherwise(F.col("_synced"))})
    assert scd2.snapshot(spark, path, one, "k", "2024-01-20") == {"mode": "snapshot", "buckets": 1}
    now = _folders(spark, path)
    assert len(first & now) == 15 and {p for _, p in now - first} == {next(iter(first - now))[1], scd2.CLOSED}
    assert scd2.snapshot(spark, path, one, "k", "2024-01-21") == {"mode": "snapshot", "buckets": 0}
    assert _folders(spark, path) == now
    want = scd2.scd2_apply(scd2.scd2_apply(None, base, "k", "2024-01-10"), one, "k", "2024-01-20")
    assert rows(read_table(spark, path)) == rows(want)


def test_null_keys_and_null_times(spark):
    import datetime as dt
    S = "k string, v string, _synced timestamp_ntz"
    d = lambda day: dt.datetime(2024, 1, day)
    path = work_dir(spark, "t-hist-null")
    first = spark.createDataFrame([(None, "a", d(5)), ("", "e", d(5)), ("x", "b", d(5)), ("y", "c", None)], S)
    second = spark.createDataFrame([(None, "a2", d(6)), ("", "e", d(5)), ("x", "b2", None), ("x", "b3", d(9)), ("y", "c", d(7))], S)
    scd2.snapshot(spark, path, first, "k", "2024-01-10", num_buckets=4)
    scd2.snapshot(spark, path, second, "k", "2024-01-20")
    h = read_table(spark, path)
    assert rows(h.where("is_current"), "k", "v") == sorted([(None, "a2"), ("", "e"), ("x", "b"), ("y", "c")], key=repr)
    assert {(r.k, r.action) for r in scd2.changes(h, second, "k").collect()} == {(None, "unchanged"), ("", "unchanged"), ("x", "unchanged"), ("y", "unchanged")}


def test_source_types_widen_in_the_history(spark):
    import datetime as dt
    path = work_dir(spark, "t-hist-types")
    make = lambda kind, t, n: spark.range(n).select("id", F.col("id").cast(kind).alias("x"), F.lit(dt.datetime(2024, 1, t)).alias("_synced"))
    scd2.snapshot(spark, path, make("int", 5, 40), "id", "2024-01-10", num_buckets=4)
    scd2.snapshot(spark, path, make("bigint", 15, 3).unionByName(make("bigint", 5, 40).where("id >= 3")), "id", "2024-01-20")
    h = read_table(spark, path)
    assert h.schema["x"].dataType.simpleString() == "bigint" and h.count() == 43
    import pytest
    with pytest.raises(TypeError, match="column x"):
        scd2.snapshot(spark, path, make("string", 25, 40), "id", "2024-01-30")


def test_readers_see_whole_histories_wherever_a_run_stops(spark, monkeypatch):
    import pytest

    from tests.test_merge import Died, POINTS, _dies
    a = work_dir(spark, "t-hist-a")
    for r in (1, 2):
        scd2.snapshot(spark, a, fx.customers_run(spark, SF001, r), "CUSTOMER_ID", fx.HISTORY_RUNS[r], num_buckets=8)
    before = rows(read_table(spark, a))
    source = fx.customers_run(spark, SF001, 3)
    for where in POINTS:
        with monkeypatch.context() as m:
            _dies(m, where)
            with pytest.raises(Died):
                scd2.snapshot(spark, a, source, "CUSTOMER_ID", fx.HISTORY_RUNS[3])
        if where != "clean-up":
            assert rows(read_table(spark, a)) == before
    h = read_table(spark, a)
    assert h.count() == 1895 and h.select("scd_id").distinct().count() == 1895
    assert scd2.snapshot(spark, a, source, "CUSTOMER_ID", "2024-01-30 01:00:00")["buckets"] == 0     # an hour later
