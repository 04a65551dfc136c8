"""Plan shape: the properties the scale design depends on, read from explain()."""

import re

from pyspark.sql import functions as F

from argent.operators import quality as dq, scd2
from argent.operators import staging as st
from argent.operators.merge import merge_frames
from argent.sources.silver_table import BUCKET, bucket_expr, read_table, write_table
from argent.session import work_dir


def plan(df, capsys) -> str:
    capsys.readouterr()
    df.explain(mode="formatted")
    return capsys.readouterr().out


def tree(text: str) -> str:
    return text.split("\n\n")[0]


def _bronze(spark, n=2000):
    return spark.range(n).select((F.col("id") % 500).alias("k"), F.col("id").cast("string").alias("v"),
                                 F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("_synced"),
                                 F.lit(False).alias("_deleted"))


def test_dedup_limits_rows_before_the_shuffle(spark, capsys, tmp_path):
    p = str(tmp_path / "b")
    _bronze(spark).write.parquet(p)
    t = tree(plan(st.dedup_latest(spark.read.parquet(p), "k"), capsys))
    assert t.count("Exchange") == 1
    # the partial group limit sits below (before) the exchange
    assert re.search(r"Exchange[\s\S]*WindowGroupLimit", t)


def test_merge_is_one_shuffle_and_one_target_scan(spark, capsys):
    tp, bp = work_dir(spark, "t-plan-t"), work_dir(spark, "t-plan-b")
    write_table(_bronze(spark).dropDuplicates(["k"]), tp, "k", 16)
    b = _bronze(spark, 300).dropDuplicates(["k"]).withColumn(BUCKET, bucket_expr(["k"], 16))
    b.write.parquet(bp)
    m = merge_frames(read_table(spark, tp, keep_bucket=True), spark.read.parquet(bp), "k",
                     exclude_update=(), bucket_col=BUCKET)
    t = tree(plan(m, capsys))
    assert t.count("Exchange") == 1
    assert t.count("Scan parquet") == 2          # target once, batch once


def test_row_checks_are_one_scan_one_exchange(spark, capsys, tmp_path):
    p = str(tmp_path / "c")
    _bronze(spark).write.parquet(p)
    df = spark.read.parquet(p)
    checks = [dq.not_null("v"), dq.in_range("k", 0, 100), dq.matches("v", r"^\d+$"), dq.positive("k")]
    t = tree(plan(dq.row_checks(df, checks, "t"), capsys))
    assert t.count("Scan parquet") == 1 and t.count("Exchange") == 1


def test_history_compare_is_a_join_of_hash_aggregates(spark, capsys):
    path = work_dir(spark, "t-plan-h")
    src = _bronze(spark).dropDuplicates(["k"])
    scd2.snapshot(spark, path, src, "k", "2024-01-10", num_buckets=8)
    from argent.sources.silver_table import open_table, read_folders
    cur = read_folders(spark, open_table(spark, path), lambda p: p != scd2.CLOSED)
    full = plan(scd2.changes(cur, _bronze(spark), "k"), capsys)
    t = tree(full)
    assert "FullOuter" in full and ("SortMergeJoin" in t or "ShuffledHashJoin" in t)
    assert "SortAggregate" not in t and "HashAggregate" in t
    assert t.count("Exchange") == 2              # one per side, the aggregate's is the join's
    assert "ReadSchema: struct<k:bigint,valid_from:timestamp_ntz,is_current:boolean,is_deleted:boolean>" in full
    out = plan(scd2.scd2_apply(cur.drop("_part"), _bronze(spark), "k", "2024-01-20"), capsys)
    assert "SortAggregate" not in out and tree(out).count("Exchange") == 2


def test_all_checks_come_from_one_scan(spark, capsys, tmp_path):
    p = str(tmp_path / "c")
    _bronze(spark).write.parquet(p)
    checks = [dq.unique("k"), dq.not_null("v"), dq.unique("v"), dq.in_range("k", 0, 100), dq.has_type("k", "bigint")]
    t = tree(plan(dq.run_checks(spark.read.parquet(p), checks, "t"), capsys))
    assert t.count("Scan parquet") == 1 and t.count("Exchange") == 2 and "SortAggregate" not in t


def test_diff_shuffles_keys_and_digests_only(spark, capsys, tmp_path):
    from argent.operators import cdc
    for n in (1, 2):
        _bronze(spark).dropDuplicates(["k"]).withColumn("wide", F.repeat(F.col("v"), n)).write.parquet(str(tmp_path / str(n)))
    prev, cur = (spark.read.parquet(str(tmp_path / n)) for n in "12")
    for df in (cdc._compared(prev, cur, "k"), cdc.diff_changed_columns(prev, cur, "k", ["v", "wide"])):
        t = plan(df, capsys)
        assert "SortAggregate" not in t and tree(t).count("Exchange") == 1
        shuffled = re.search(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", t).group(1)
        assert "wide" not in shuffled and "v#" not in shuffled and shuffled.startswith("_k#")
    d = plan(cdc.snapshot_diff(prev, cur, "k"), capsys)
    assert "SortAggregate" not in d


def test_newest_time_comes_from_the_footers(spark, capsys):
    from argent.sources.silver_table import newest
    p = work_dir(spark, "t-newest")
    one = _bronze(spark).dropDuplicates(["k"])
    write_table(one, p, "k", 8)
    want = one.agg(F.max("_synced")).first()[0]
    df = newest(spark, p, "_synced")
    assert df.first()[0] == want
    assert "PushedAggregation: [MAX(_synced)]" in plan(df, capsys)
    # later commits with a new column and a wider type: files differ, the place of the column does not
    from argent.sources.silver_table import merge_upsert
    later = one.where("k < 5").withColumns({"_synced": F.lit("2031-05-06 07:08:09.123456").cast("timestamp_ntz"), "extra": F.lit("x")})
    merge_upsert(spark, p, later, "k", exclude_update=())
    df = newest(spark, p, "_synced")
    assert str(df.first()[0]) == "2031-05-06 07:08:09.123456" and "PushedAggregation" in plan(df, capsys)
    # a column with nulls, or another one, is read
    merge_upsert(spark, p, later.withColumn("_synced", F.lit(None).cast("timestamp_ntz")), "k", exclude_update=())
    df = newest(spark, p, "_synced")
    assert df.first()[0] == one.where("k >= 5").agg(F.max("_synced")).first()[0] and "PushedAggregation" not in plan(df, capsys)
    assert newest(spark, p, "v").first()[0] == one.agg(F.max("v")).first()[0]
    assert newest(spark, work_dir(spark, "t-newest-none"), "_synced") is None


def test_no_forced_broadcast(spark, capsys, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        child = _bronze(spark)
        parent = _bronze(spark, 100)
        t = plan(dq.orphans(child, parent, "k"), capsys)
        assert "Broadcast" not in t
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
