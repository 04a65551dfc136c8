import datetime as dt

import pytest
from pyspark.sql import functions as F

from argent.operators import cdc, governance as gov
from argent.sources import fixtures as fx

from tests.conftest import SF0001


def test_snapshot_diff_edge_rows(spark):
    prev = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (5, "e")], "k long, v string")
    cur = spark.createDataFrame([(1, "a"), (2, "c"), (3, None), (4, "d")], "k long, v string")
    got = sorted((r.k, r.op) for r in cdc.snapshot_diff(prev, cur, "k").collect())
    assert got == [(2, "update"), (4, "insert"), (5, "delete")]
    ch = cdc.diff_changed_columns(prev, cur, "k", ["v"]).collect()
    assert [(r.k, r.changed_columns) for r in ch] == [(2, ["v"])]


def test_apply_changes(spark):
    T = dt.datetime(2024, 1, 1)
    tgt = spark.createDataFrame([(1, "a", T, False), (2, "b", T, False)], "k long, v string, _synced timestamp_ntz, "
                                "_deleted boolean")
    ch = spark.createDataFrame([(1, "a2", 1, "U"), (1, "a3", 2, "U"), (2, "zz", 1, "D"), (3, "c", 1, "I")],
                               "k long, v string, seq int, _op string")
    got = {r.k: (r.v, r._deleted) for r in cdc.apply_changes(tgt, ch, "k", "seq", as_of="2024-01-02").collect()}
    assert got == {1: ("a3", False), 2: ("b", True), 3: ("c", False)}


def test_tags_validate_and_mask(spark):
    df = spark.createDataFrame([("x@y.z", dt.date(1990, 5, 6), 1)], "email string, dob date, n int")
    with pytest.raises(ValueError):
        gov.tag_pii(df, {"email": "NOT_A_TYPE"})
    t = gov.tag_pii(df, {"email": "EMAIL", "dob": "DOB"})
    assert gov.pii_columns(t) == {"email": "EMAIL", "dob": "DOB"}
    r = gov.masked_view(t).first()
    assert (r.email, r.dob, r.n) == ("***MASKED***", dt.date(1990, 1, 1), 1)
    assert gov.masked_view(t, ["ADMIN_ROLE"]).first().email == "x@y.z"
    assert gov.masked_view(t, layer="silver").first().email == "x@y.z"


def test_docs_and_tags_survive_parquet_and_union(spark, tmp_path):
    from pyspark.sql import functions as F
    from argent.operators.staging import with_docs
    df = spark.createDataFrame([("x@y.z", 1)], "email string, n int")
    t = with_docs(gov.tag_pii(df, {"email": "EMAIL"}), {"n": "a count"})
    p = str(tmp_path / "t")
    t.unionByName(t).write.parquet(p)
    back = spark.read.parquet(p)
    assert gov.pii_columns(back) == {"email": "EMAIL"}
    assert back.schema["n"].metadata["comment"] == "a count"
    # column functions drop the tag: re-apply from the spec after transforms
    assert gov.pii_columns(back.select(F.upper("email").alias("email"))) == {}


def test_apply_changes_null_keys_never_match(spark):
    T = dt.datetime(2024, 1, 1)
    tgt = spark.createDataFrame([(None, "t1", T, False), (None, "t2", T, False), (1, "a", T, False)],
                                "k long, v string, _synced timestamp_ntz, _deleted boolean")
    ch = spark.createDataFrame([(None, "c", 1, "U")], "k long, v string, seq int, _op string")
    got = sorted(((r.k, r.v) for r in cdc.apply_changes(tgt, ch, "k", "seq", as_of="2024-01-02").collect()), key=repr)
    assert got == sorted([(None, "t1"), (None, "t2"), (None, "c"), (1, "a")], key=repr)


def test_snapshot_diff_null_keys_like_a_join(spark):
    prev = spark.createDataFrame([(None, "x"), (None, "x"), (1, "a")], "k long, v string")
    cur = spark.createDataFrame([(None, "x"), (1, "b")], "k long, v string")
    got = sorted(((r.k, r.op, r.v) for r in cdc.snapshot_diff(prev, cur, "k").collect()), key=repr)
    want = sorted([(None, "delete", "x"), (None, "delete", "x"), (None, "insert", "x"), (1, "update", "b")], key=repr)
    assert got == want


def test_full_compare_applied_as_soft_deletes(spark):
    T = dt.datetime(2024, 1, 1)
    prev = spark.createDataFrame([(1, "a"), (2, "b"), (5, "e")], "k long, v string")
    cur = spark.createDataFrame([(1, "a"), (2, "c"), (4, "d")], "k long, v string")
    bronze = prev.select("*", F.lit(T).cast("timestamp_ntz").alias("_synced"), F.lit(False).alias("_deleted"))
    changes = cdc.diff_as_changes(cdc.snapshot_diff(prev, cur, "k"))
    out = {r.k: (r.v, r._deleted, r._synced == T) for r in
           cdc.apply_changes(bronze, changes, "k", "_seq", as_of="2024-01-02").collect()}
    assert out == {1: ("a", False, True), 2: ("c", False, False), 4: ("d", False, False), 5: ("e", True, False)}


def test_diff_with_repeated_and_null_keys_and_other_types(spark):
    from argent.operators import cdc
    prev = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (2, "b", 2), (3, None, 3), (4, "d", 4), (None, "n", 5), (None, "n", 5), (6, "", 6)], "k int, v string, n int")
    cur = spark.createDataFrame([(1, "a", 1), (2, "b", 9), (2, "b", 9), (3, "c", 3), (5, "e", 5), (None, "n", 5), (6, None, 6)], "k bigint, v string, n bigint")
    got = sorted((tuple(r) for r in cdc.snapshot_diff(prev, cur, "k").collect()), key=repr)
    want = [("update", 2, "b", 9), ("update", 3, "c", 3), ("delete", 4, "d", 4), ("insert", 5, "e", 5), ("delete", None, "n", 5), ("delete", None, "n", 5),
            ("insert", None, "n", 5), ("update", 6, None, 6)]
    assert got == sorted(want, key=repr)
    columns = {r.k: list(r.changed_columns) for r in cdc.diff_changed_columns(prev, cur, "k", ["v", "n"]).collect()}
    assert columns == {2: ["n"], 3: ["v"], 6: ["v"]}
    assert cdc.snapshot_diff(prev.limit(0), cur, "k").count() == 6 and cdc.snapshot_diff(prev, prev, "k").where("k is not null").count() == 0


def test_ingest_of_logs_and_extracts(spark):
    from argent.operators import governance as gov
    from argent.plans import pipeline
    from argent.session import work_dir
    from argent.sources.bronze import read_bronze, source_path
    from argent.sources.silver_table import open_table
    landing, bronze = work_dir(spark, "t-landing"), work_dir(spark, "t-ingest")
    log = "CUSTOMER_ID bigint, EMAIL string, PHONE string, FIRST_NAME string, LAST_NAME string, REGISTRATION_DATE string, CUSTOMER_TYPE string, STATUS string, _seq int, _op string"
    row = lambda i, email, seq, op: (i, email, "p", "f", "l", "d", "t", "s", seq, op)
    camp = "CAMPAIGN_ID bigint, CAMPAIGN_NAME string, TOTAL_SPEND double, CUSTOMERS_ACQUIRED int"
    deliveries = [([row(1, "a", 1, "I"), row(2, "b", 1, "I"), row(1, "a2", 2, "U")], [(1, "x", 1.0, 1), (2, "y", 2.0, 2)]),
                  ([row(2, "b", 3, "D"), row(3, "c", 3, "I")], [(2, "y", 2.5, 2), (3, "z", 3.0, 3)]),
                  ([row(2, "b3", 4, "I")], [(1, "x", 1.0, 1), (2, "y", 2.5, 2), (3, "z", 3.0, 3)])]
    for n, (changes, extract) in enumerate(deliveries):
        spark.createDataFrame(changes, log).write.parquet(source_path(f"{landing}/{n}", "customers"))
        spark.createDataFrame(extract, camp).write.parquet(source_path(f"{landing}/{n}", "campaigns"))
        rep = pipeline.run_ingest(spark, f"{landing}/{n}", bronze, f"2024-01-0{n + 1} 00:00:00")
        assert rep["items"]["mode"] == "nothing delivered" and rep["customers"]["mode"] == ("merge" if n else "create")
    got = {r.CUSTOMER_ID: (r.EMAIL, r._synced.day, r._deleted) for r in read_bronze(spark, bronze, "customers").collect()}
    assert got == {1: ("a2", 1, False), 2: ("b3", 3, False), 3: ("c", 2, False)}
    got = {r.CAMPAIGN_ID: (r.TOTAL_SPEND, r._synced.day, r._deleted) for r in read_bronze(spark, bronze, "campaigns").collect()}
    assert got == {1: (1.0, 3, False), 2: (2.5, 2, False), 3: (3.0, 2, False)}
    # tags stay with the bronze table through every commit
    assert gov.pii_columns(read_bronze(spark, bronze, "customers")) == gov.CUSTOMER_PII
    assert open_table(spark, source_path(bronze, "customers")).version == 3


def test_descriptions_stay_with_the_tables(spark):
    from argent.plans import pipeline
    from argent.plans.models import MODELS
    from argent.session import work_dir
    from argent.sources.bronze import source_path
    from argent.sources.silver_table import open_table, read_table
    bronze, silver = work_dir(spark, "t-docs-bronze"), work_dir(spark, "t-docs-silver")
    for name in ("brands", "customers", "order_headers"):
        fx.bronze(spark, SF0001, name).write.parquet(source_path(bronze, name))
    for run in ("r1", "r2"):
        pipeline.run_models(spark, bronze, silver, "2024-01-31 00:00:00", run, ["brands", "order_headers"], propagate_deletes=True, num_buckets=4)
        pipeline.run_snapshots(spark, bronze, silver, "2024-01-31 00:00:00", ["customer_history"])
    for name, path in (("brands", pipeline.silver_path(silver, "brands")), ("order_headers", pipeline.silver_path(silver, "order_headers"))):
        t = read_table(spark, path)
        assert {f.name: f.metadata["comment"] for f in t.schema.fields} == MODELS[name].docs
        assert open_table(spark, path).comment == f"Newest row per {MODELS[name].key} of {name}"
    h = read_table(spark, pipeline.history_path(silver, "customer_history"))
    assert h.schema["EMAIL"].metadata == {"comment": "E-mail address", "pii_type": "EMAIL"} and h.schema["valid_to"].metadata["comment"]
    # the model's match window and the options reach the tables
    assert open_table(spark, pipeline.silver_path(silver, "order_headers")).layout.get("unit") and open_table(spark, pipeline.silver_path(silver, "brands")).layout["buckets"] == 4
    assert read_table(spark, pipeline.silver_path(silver, "order_headers")).where("_is_deleted").count() > 0
