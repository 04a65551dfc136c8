import datetime as dt

import pytest
from pyspark.sql import functions as F

from argent.operators.merge import merge_by_joins, merge_frames, recent_match
from argent.session import work_dir
from argent.sources.silver_table import merge_upsert, read_table, write_table

from tests.conftest import rows

S = "k long, v string, _bronze_sync_timestamp timestamp_ntz, _silver_load_timestamp timestamp_ntz"
L0, L1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 20)


def test_merge_edge_rows(spark):
    tgt = spark.createDataFrame([(1, "old", L0, L0)], S)
    src = spark.createDataFrame([(1, "new", L1, L1), (2, "ins", L1, L1), (None, "nul", L1, L1)], S)
    for f in (merge_frames, merge_by_joins):
        out = {r.v: r for r in f(tgt, src, "k").collect()}
        assert set(out) == {"new", "ins", "nul"}
        assert out["new"]._silver_load_timestamp == L0     # first load time kept
        assert out["ins"]._silver_load_timestamp == L1


def test_match_window_duplicates(spark):
    tgt = spark.createDataFrame([(1, "old", dt.datetime(2024, 1, 20), L0)], S)
    src = spark.createDataFrame([(1, "new", L1, L1)], S)
    assert merge_frames(tgt, src, "k").count() == 1
    win = recent_match(3, "2024-01-30 00:00:00")
    assert merge_frames(tgt, src, "k", match_cond=win).count() == 2
    assert merge_by_joins(tgt, src, "k", match_cond=win).count() == 2


def test_schema_evolution(spark):
    tgt = spark.createDataFrame([(1, "a", "gone", L0, L0)], "k long, v string, old string, "
                                "_bronze_sync_timestamp timestamp_ntz, _silver_load_timestamp timestamp_ntz")
    src = spark.createDataFrame([(2, "b", "x", L1, L1)], "k long, v string, extra string, "
                                "_bronze_sync_timestamp timestamp_ntz, _silver_load_timestamp timestamp_ntz")
    out = {r.k: r for r in merge_frames(tgt, src, "k").collect()}
    assert out[1].extra is None and out[1].old == "gone"
    assert out[2].extra == "x" and out[2].old is None


def test_guard_keeps_newer(spark):
    tgt = spark.createDataFrame([(1, "newer", L1, L0)], S)
    src = spark.createDataFrame([(1, "older", L0, L0)], S)
    out = merge_frames(tgt, src, "k", guard_col="_bronze_sync_timestamp").collect()
    assert [r.v for r in out] == ["newer"]


def _batch(spark, lo, hi, tag):
    return spark.range(lo, hi).select(F.col("id").alias("k"), F.lit(tag).alias("v"),
                                      F.lit(L1).cast("timestamp_ntz").alias("_bronze_sync_timestamp"),
                                      F.lit(L1).cast("timestamp_ntz").alias("_silver_load_timestamp"))


def test_sink_idempotent_and_split_equals_whole(spark):
    a = work_dir(spark, "t-merge-a")
    b = work_dir(spark, "t-merge-b")
    base = _batch(spark, 0, 500, "base")
    write_table(base, a, "k", 16)
    write_table(base, b, "k", 16)
    whole = _batch(spark, 400, 700, "upd")
    merge_upsert(spark, a, whole, "k", num_buckets=16)
    first = rows(read_table(spark, a))
    merge_upsert(spark, a, whole, "k", num_buckets=16)
    assert rows(read_table(spark, a)) == first
    merge_upsert(spark, b, _batch(spark, 400, 550, "upd"), "k", num_buckets=16)
    merge_upsert(spark, b, _batch(spark, 550, 700, "upd"), "k", num_buckets=16)
    assert rows(read_table(spark, b)) == first
    assert len(first) == 700


def test_sink_rewrites_only_touched_buckets(spark):
    p = work_dir(spark, "t-merge-c")
    write_table(_batch(spark, 0, 1000, "base"), p, "k", 32)
    rep = merge_upsert(spark, p, _batch(spark, 5, 6, "upd"), "k", num_buckets=32)
    assert rep["buckets"] == 1


def test_bucket_count_is_kept(spark):
    from argent.sources.silver_table import buckets_for, stored_buckets
    p = work_dir(spark, "t-merge-d")
    write_table(_batch(spark, 0, 100, "base"), p, "k", 8)
    merge_upsert(spark, p, _batch(spark, 50, 150, "upd"), "k", num_buckets=64)   # asks for another count
    t = read_table(spark, p, keep_bucket=True)
    assert stored_buckets(t, ["k"]) == 8
    assert t.select("_bucket").distinct().count() <= 8
    assert t.groupBy("k").count().where("count > 1").count() == 0 and t.count() == 150
    assert buckets_for(100 * 1024 ** 4) == 1 << 18 and buckets_for(1) == 8


def _at(seconds):
    return F.timestamp_seconds(F.col("k") + seconds).cast("timestamp_ntz")


def test_high_water_is_exact_without_a_job(spark):
    from argent.sources.silver_table import table_high_water
    p = work_dir(spark, "t-merge-hw")
    write_table(_batch(spark, 0, 300, "base").withColumn("_bronze_sync_timestamp", _at(0)), p, "k", 8)
    scan = lambda: read_table(spark, p).agg(F.max("_bronze_sync_timestamp")).first()[0]
    assert table_high_water(spark, p) == scan()
    merge_upsert(spark, p, _batch(spark, 290, 320, "upd").withColumn("_bronze_sync_timestamp", _at(1000)), "k")
    assert table_high_water(spark, p) == scan()
    # batches that lower the newest time of some buckets, of all, and of none
    merge_upsert(spark, p, _batch(spark, 319, 320, "old").withColumn("_bronze_sync_timestamp", _at(-5000)), "k")
    assert table_high_water(spark, p) == scan()
    merge_upsert(spark, p, _batch(spark, 0, 320, "old").withColumn("_bronze_sync_timestamp", _at(-9000)), "k")
    assert table_high_water(spark, p) == scan()
    merge_upsert(spark, p, _batch(spark, 0, 320, "nul").withColumn("_bronze_sync_timestamp", F.lit(None).cast("timestamp_ntz")), "k")
    assert scan() is None and table_high_water(spark, p) == dt.datetime(2000, 1, 1)
    assert table_high_water(spark, work_dir(spark, "t-none")) is None


def test_range_buckets_confine_a_recent_batch(spark):
    from argent.sources.silver_table import stored_range_width
    p = work_dir(spark, "t-merge-range")
    write_table(_batch(spark, 0, 10000, "base"), p, "k", range_width=1000)
    t = read_table(spark, p, keep_bucket=True)
    assert stored_range_width(t, ["k"]) == 1000 and t.select("_bucket").distinct().count() == 10
    rep = merge_upsert(spark, p, _batch(spark, 9950, 10100, "new"), "k")      # newest keys only
    assert rep["buckets"] == 2                                               # buckets 9 and 10
    out = read_table(spark, p)
    assert out.count() == 10100 and out.groupBy("k").count().where("count > 1").count() == 0
    nulls = _batch(spark, 0, 3, "nul").withColumn("k", F.lit(None).cast("long"))
    merge_upsert(spark, p, nulls, "k")
    assert read_table(spark, p).where("k is null").count() == 3


class Died(Exception):
    pass


def _dies(monkeypatch, where):
    """The writer stops at ``where``: in the rows' write, before the pointer is
    written, between its file and its rename, or before the clean-up."""
    from pyspark.sql import DataFrameWriter

    from argent.sources import silver_table as sink

    def die(*a, **k):
        raise Died
    if where == "rows":
        real = DataFrameWriter.parquet

        def write(self, path, *a, **k):
            real(self, path, *a, **k)
            if "/data/_commit=" in path:
                raise Died
        monkeypatch.setattr(DataFrameWriter, "parquet", write)
    elif where == "pointer":
        monkeypatch.setattr(sink, "publish", die)
    elif where == "rename":
        from argent import session

        def half(spark, path, text):
            session.replace_text(spark, path + ".half", text)
            raise Died
        monkeypatch.setattr(sink, "replace_text", half)
    else:
        monkeypatch.setattr(sink, "clean_up", die)


POINTS = ["rows", "pointer", "rename", "clean-up"]


@pytest.mark.parametrize("where", POINTS)
@pytest.mark.parametrize("unit", [None, "day"])
def test_readers_see_whole_tables_wherever_a_merge_stops(spark, monkeypatch, where, unit):
    from argent.sources.silver_table import table_high_water
    a, b = work_dir(spark, "t-merge-ra"), work_dir(spark, "t-merge-rb")
    base = _batch(spark, 0, 400, "base").withColumn("_bronze_sync_timestamp", _at(0))
    for p in (a, b):
        write_table(base, p, "k", 8, day_unit=unit)
    batch = _batch(spark, 300, 500, "upd").withColumn("_bronze_sync_timestamp", _at(10 ** 6))
    merge_upsert(spark, a, batch, "k")
    before, after, marks = rows(base), rows(read_table(spark, a)), table_high_water(spark, b)
    with monkeypatch.context() as m:
        _dies(m, where)
        with pytest.raises(Died):
            merge_upsert(spark, b, batch, "k")
    done = where == "clean-up"
    assert rows(read_table(spark, b)) == (after if done else before)
    assert table_high_water(spark, b) == (table_high_water(spark, a) if done else marks)
    merge_upsert(spark, b, batch, "k")
    assert rows(read_table(spark, b)) == after
    assert table_high_water(spark, b) == table_high_water(spark, a)


@pytest.mark.parametrize("where", POINTS)
def test_a_first_build_is_there_whole_or_not(spark, monkeypatch, where):
    p = work_dir(spark, "t-merge-first")
    base = _batch(spark, 0, 100, "base")
    with monkeypatch.context() as m:
        _dies(m, where)
        with pytest.raises(Died):
            write_table(base, p, "k", 8)
    t = read_table(spark, p)
    assert (rows(t) == rows(base)) if where == "clean-up" else t is None
    write_table(base, p, "k", 8)
    assert rows(read_table(spark, p)) == rows(base)


def test_a_reader_on_its_way_keeps_its_version_and_old_folders_go(spark):
    from argent.session import child_names
    from argent.sources.silver_table import open_table
    p = work_dir(spark, "t-merge-reader")
    write_table(_batch(spark, 0, 300, "base"), p, "k", 8)
    reader = read_table(spark, p)
    merge_upsert(spark, p, _batch(spark, 0, 300, "upd"), "k")
    assert reader.where("v = 'base'").count() == 300
    assert len(child_names(spark, f"{p}/data")) == 2
    merge_upsert(spark, p, _batch(spark, 5, 6, "one"), "k")        # one bucket
    table = open_table(spark, p)
    assert len(child_names(spark, f"{p}/data")) == 2 and len(table.live) == 2
    merge_upsert(spark, p, _batch(spark, 5, 6, "two"), "k")
    merge_upsert(spark, p, _batch(spark, 5, 6, "three"), "k")
    table = open_table(spark, p)
    held = {c: {n.split("=")[1] for n in child_names(spark, f"{p}/data/_commit={c}") if "=" in n} for c in table.live}
    assert held == table.live and sum(map(len, held.values())) == 8
    assert read_table(spark, p).groupBy("v").count().collect() == read_table(spark, p).groupBy("v").count().collect()
    assert {r.v: r["count"] for r in read_table(spark, p).groupBy("v").count().collect()} == {"upd": 299, "three": 1}


def test_two_writers_of_one_version(spark):
    from argent.sources import silver_table as sink
    p = work_dir(spark, "t-merge-two")
    write_table(_batch(spark, 0, 50, "base"), p, "k", 8)
    old = sink.open_table(spark, p)
    merge_upsert(spark, p, _batch(spark, 0, 10, "first"), "k")
    with pytest.raises(RuntimeError, match="another commit"):
        sink.commit(read_table(spark, p, keep_bucket=True), p, old, old.schema, old.layout)
    assert read_table(spark, p).where("v = 'first'").count() == 10


def test_materialize_after_a_run_that_died(spark, monkeypatch):
    from argent.plans.models import MODELS, materialize
    from argent.sources import fixtures as fx
    from tests.conftest import SF001
    spec = MODELS["order_headers"]
    v1, v2 = fx.orders_v1(spark, SF001), fx.order_headers(spark, SF001)
    a, b = work_dir(spark, "t-mat-a"), work_dir(spark, "t-mat-b")
    for bronze in (v1, v2):
        materialize(spark, spec, bronze, a, fx.ORDERS_AS_OF, "r")
        with monkeypatch.context() as m:
            _dies(m, "pointer")
            with pytest.raises(Died):
                materialize(spark, spec, bronze, b, fx.ORDERS_AS_OF, "r")
        materialize(spark, spec, bronze, b, fx.ORDERS_AS_OF, "r")
    assert rows(read_table(spark, b)) == rows(read_table(spark, a))


def test_build_replaces_an_earlier_table(spark):
    p = work_dir(spark, "t-merge-replace")
    write_table(_batch(spark, 0, 200, "base"), p, "k", 16)
    write_table(_batch(spark, 0, 3, "new"), p, "k", 4)
    assert read_table(spark, p).count() == 3


# -- types (S9) --------------------------------------------------------------


def _typed(spark, kind, ids, expr="k"):
    return spark.createDataFrame([(i, L1) for i in ids], "k long, _bronze_sync_timestamp timestamp_ntz").withColumn("x", F.expr(f"cast({expr} as {kind})"))


@pytest.mark.parametrize("first, second, third", [
    ("int", "bigint", "bigint"), ("bigint", "int", "bigint"), ("tinyint", "smallint", "smallint"), ("int", "double", "double"), ("float", "double", "double"),
    ("int", "decimal(12,2)", "decimal(12,2)"), ("bigint", "decimal(5,2)", "decimal(22,2)"), ("decimal(10,2)", "decimal(12,4)", "decimal(12,4)"),
    ("decimal(10,0)", "decimal(10,4)", "decimal(14,4)")])
def test_types_widen_without_rewriting_old_files(spark, first, second, third):
    p = work_dir(spark, "t-types")
    write_table(_typed(spark, first, range(60)), p, "k", 8)
    rep = merge_upsert(spark, p, _typed(spark, second, [5, 70]), "k")
    assert rep["buckets"] <= 2                       # the other buckets keep their files
    t = read_table(spark, p)
    assert t.schema["x"].dataType.simpleString() == third
    for vectorized in ("true", "false"):
        spark.conf.set("spark.sql.parquet.enableVectorizedReader", vectorized)
        try:
            assert sorted((r.k, int(r.x)) for r in t.collect()) == [(i, i) for i in [*range(60), 70]]
            assert t.where("x = 70").count() == 1 and t.where("x = 7").count() == 1
        finally:
            spark.conf.unset("spark.sql.parquet.enableVectorizedReader")
    merge_upsert(spark, p, _typed(spark, first, range(60)), "k")
    assert read_table(spark, p).count() == 61


@pytest.mark.parametrize("first, second", [("int", "string"), ("bigint", "double"), ("decimal(38,0)", "decimal(38,2)"), ("date", "int"), ("timestamp", "timestamp_ntz"), ("smallint", "float")])
def test_types_that_lose_are_refused(spark, first, second):
    p = work_dir(spark, "t-types-bad")
    write_table(_typed(spark, first, range(9), "k" if first not in ("date", "timestamp") else "date'2020-01-01'"), p, "k", 8)
    before = rows(read_table(spark, p))
    with pytest.raises(TypeError, match="column x"):
        merge_upsert(spark, p, _typed(spark, second, [5], "k" if second != "timestamp_ntz" else "date'2020-01-01'"), "k")
    assert rows(read_table(spark, p)) == before


def test_a_widened_key_keeps_its_bucket(spark):
    p = work_dir(spark, "t-types-key")
    narrow = _batch(spark, 0, 50, "base").withColumn("k", F.col("k").cast("int"))
    write_table(narrow, p, "k", 8)
    merge_upsert(spark, p, _batch(spark, 0, 60, "upd"), "k")
    t = read_table(spark, p)
    assert t.schema["k"].dataType.simpleString() == "bigint" and t.count() == 60 and t.where("v = 'upd'").count() == 60
    with pytest.raises(TypeError, match="key k"):
        merge_upsert(spark, p, _batch(spark, 0, 3, "dec").withColumn("k", F.col("k").cast("decimal(20,0)")), "k")


def test_new_columns_rewrite_only_touched_buckets_and_metadata_stays(spark):
    from argent.operators.staging import with_docs
    p = work_dir(spark, "t-evolve")
    write_table(with_docs(_batch(spark, 0, 200, "base"), {"v": "a value"}), p, "k", 16)
    rep = merge_upsert(spark, p, _batch(spark, 5, 6, "upd").withColumn("extra", F.lit("x")), "k")
    assert rep["buckets"] == 1
    merge_upsert(spark, p, with_docs(_batch(spark, 7, 8, "upd"), {"k": "the key"}), "k")
    t = read_table(spark, p)
    assert t.schema["v"].metadata == {"comment": "a value"} and t.schema["k"].metadata["comment"] == "the key"
    assert t.where("extra = 'x'").count() == 1 and t.where("extra is null").count() == 199


# -- layouts -------------------------------------------------------------------


@pytest.mark.parametrize("unit", ["day", "month", "year"])
def test_the_window_prunes_the_days_of_the_target(spark, capsys, unit):
    from argent.sources.silver_table import open_table, read_folders
    day = lambda d: F.lit(dt.datetime(2024, 1, d, 7))
    at = lambda lo, hi, tag, d: _batch(spark, lo, hi, tag).withColumn("_bronze_sync_timestamp", day(d))
    base = _batch(spark, 50, 60, "z").withColumn("_bronze_sync_timestamp", F.lit(dt.datetime(2023, 5, 5))).unionByName(at(0, 10, "a", 1)).unionByName(at(10, 20, "b", 18)).unionByName(at(20, 30, "c", 20))
    base = base.unionByName(_batch(spark, 30, 33, "n").withColumn("_bronze_sync_timestamp", F.lit(None).cast("timestamp_ntz")))
    as_of = "2024-01-20 12:00:00"
    by_day, by_key = work_dir(spark, "t-day"), work_dir(spark, "t-key")
    kw = {"match_cond": recent_match(3, as_of), "window_from": dt.datetime(2024, 1, 17, 12), "day_unit": unit}
    merge_upsert(spark, by_day, base, "k", **kw)
    write_table(base, by_key, "k", 8)
    assert open_table(spark, by_day).layout["day"] == "_bronze_sync_timestamp"
    old = open_table(spark, by_day)
    batch = at(5, 7, "late", 3).unionByName(at(15, 25, "new", 21)).unionByName(at(40, 42, "ins", 2))
    merge_upsert(spark, by_day, batch, "k", **kw)
    merge_upsert(spark, by_key, batch, "k", match_cond=kw["match_cond"])
    assert rows(read_table(spark, by_day)) == rows(read_table(spark, by_key))
    table = open_table(spark, by_day)
    first = next(iter(old.live))
    older = {"day": {"2023-05-05", "2024-01-01"}, "month": {"2023-05-01"}, "year": {"2023-01-01"}}[unit]
    assert table.live[first] == older | {"__HIVE_DEFAULT_PARTITION__"}      # older folders were not rewritten
    recent = read_folders(spark, table).where(F.col("_day") >= F.lit(dt.date(2024, 1, 17)))
    recent.explain(mode="formatted")
    assert "PartitionFilters: [isnotnull(_day" in capsys.readouterr().out
    # without a window any folder may match
    merge_upsert(spark, by_day, at(0, 3, "key", 25), "k")
    assert read_table(spark, by_day).where("k < 3").count() == 3


def test_day_unit_comes_from_the_size(spark, monkeypatch):
    from argent.sources import silver_table as sink
    src = work_dir(spark, "t-unit-src")
    _batch(spark, 0, 3000, "base").withColumn("_bronze_sync_timestamp", F.timestamp_seconds(F.col("k") * 86400).cast("timestamp_ntz")).write.parquet(src)
    df = spark.read.parquet(src)
    size = sink.input_bytes(df)
    for least, unit in ((size / 4000, "day"), (size / 200, "month"), (size, "year")):
        monkeypatch.setattr(sink, "DAY_BYTES", least)
        assert sink.day_unit_for(df, "_bronze_sync_timestamp") == unit
    assert sink.day_unit_for(df.where("k < 0"), "_bronze_sync_timestamp") == "day"


def test_bucket_count_comes_from_the_size(spark, monkeypatch):
    from argent.sources import silver_table as sink
    src = work_dir(spark, "t-size-src")
    _batch(spark, 0, 20000, "base").write.parquet(src)
    monkeypatch.setattr(sink, "TARGET_BUCKET_BYTES", 1000)
    monkeypatch.setattr(sink.buckets_for, "__defaults__", (1000, 8))
    df = spark.read.parquet(src)
    n = sink.first_buckets(df)
    assert n == sink.buckets_for(sink.input_bytes(df), 1000) > 8
    assert sink.first_buckets(spark.createDataFrame(df.rdd, df.schema)) == sink.DEFAULT_BUCKETS
    assert sink.range_width_for(df, "k") == -(-20000 // n)
    p = work_dir(spark, "t-size")
    write_table(df, p, "k")
    assert sink.open_table(spark, p).layout["buckets"] == n


def test_a_micro_batch_is_applied_once(spark):
    p = work_dir(spark, "t-once")
    merge_upsert(spark, p, _batch(spark, 0, 10, "zero"), "k", applied=("s", 0))
    assert merge_upsert(spark, p, _batch(spark, 0, 10, "again"), "k", applied=("s", 0))["mode"] == "skipped"
    assert merge_upsert(spark, p, _batch(spark, 5, 12, "one"), "k", applied=("s", 1))["mode"] == "merge"
    assert merge_upsert(spark, p, _batch(spark, 5, 12, "again"), "k", applied=("s", 1))["mode"] == "skipped"
    assert merge_upsert(spark, p, _batch(spark, 0, 1, "other"), "k", applied=("t", 0))["mode"] == "merge"
    assert {r.v: r["count"] for r in read_table(spark, p).groupBy("v").count().collect()} == {"zero": 4, "one": 7, "other": 1}


def test_guard_treats_a_null_time_as_the_newest(spark):
    tgt = spark.createDataFrame([(1, "timed", L1, L0), (2, "null", None, L0), (3, "null", None, L0)], S)
    src = spark.createDataFrame([(1, "null", None, L1), (2, "timed", L1, L1), (3, "null2", None, L1)], S)
    out = merge_frames(tgt, src, "k", guard_col="_bronze_sync_timestamp")
    assert rows(out, "k", "v") == [(1, "null"), (2, "null"), (3, "null2")]


def _largest_file(spark, path):
    """Rows of the fullest live file of a table."""
    from argent.sources.silver_table import open_table, read_folders
    return read_folders(spark, open_table(spark, path)).groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]


def _with_loose_rows(spark, first, last, tag):
    """Keyed rows, and rows without a key, some of them equal."""
    loose = spark.range(200).select(F.lit(None).cast("bigint").alias("k"), (F.col("id") % 150).cast("string").alias("v"))
    more = [F.lit(c).cast("timestamp_ntz").alias(n) for n, c in (("_bronze_sync_timestamp", L0), ("_silver_load_timestamp", L0))]
    return _batch(spark, first, last, tag).unionByName(loose.select("*", *more), allowMissingColumns=True)


def test_a_large_bucket_is_merged_by_several_tasks(spark, monkeypatch):
    from argent.sources import silver_table as sink
    a, b = work_dir(spark, "t-merge-deal"), work_dir(spark, "t-merge-whole")
    for p in (a, b):
        write_table(_with_loose_rows(spark, 0, 4000, "base"), p, "k", 1)
    merge_upsert(spark, b, _with_loose_rows(spark, 3000, 6000, "upd"), "k")
    monkeypatch.setattr(sink, "TASK_ROWS", 500, raising=False)
    merge_upsert(spark, a, _with_loose_rows(spark, 3000, 6000, "upd"), "k")
    out = rows(read_table(spark, a))
    assert out == rows(read_table(spark, b)) and len(out) == 6000 + 400
    assert _largest_file(spark, a) < 2000


def test_a_large_bucket_of_changes_is_applied_by_several_tasks(spark, monkeypatch):
    from argent.operators.cdc import OP, apply_changes_to_table
    from argent.sources import silver_table as sink
    a, b = work_dir(spark, "t-cdc-deal"), work_dir(spark, "t-cdc-whole")

    def changes(first, last, op):
        return spark.range(first, last).select(F.col("id").alias("k"), F.concat(F.lit(op), F.col("id").cast("string")).alias("v"),
                                               F.lit(1).alias("_seq"), F.lit(op).alias(OP))
    for p in (a, b):
        apply_changes_to_table(spark, p, changes(0, 4000, "I"), "k", "_seq", as_of="2024-01-01 00:00:00", num_buckets=1)
        if p == b:
            monkeypatch.undo()
        else:
            monkeypatch.setattr(sink, "TASK_ROWS", 500, raising=False)
        for first, last, op in ((3000, 6000, "U"), (500, 700, "D")):
            apply_changes_to_table(spark, p, changes(first, last, op), "k", "_seq", as_of="2024-01-02 00:00:00")
    out = rows(read_table(spark, a))
    assert out == rows(read_table(spark, b)) and len(out) == 6000
    assert _largest_file(spark, a) < 2000


def test_a_large_bucket_of_a_first_build_is_written_by_several_tasks(spark, monkeypatch):
    was = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8k")
    try:
        p = work_dir(spark, "t-build-deal")
        write_table(spark.range(0, 40000, 1, 16).select(F.col("id").alias("k"), F.md5(F.col("id").cast("string")).alias("v")), p, "k", 1)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", was)
    assert read_table(spark, p).distinct().count() == 40000
    assert _largest_file(spark, p) < 20000
