"""End to end over file-based bronze: run, re-run, snapshot, tests, freshness, CLI."""

from argent.plans import pipeline
from argent.plans.models import MODELS, build_silver
from argent.session import work_dir
from argent.sources import fixtures as fx
from argent.sources.bronze import SOURCES, source_path
from argent.sources.silver_table import read_table

from tests.conftest import SF0001, rows

AS_OF = "2024-01-31 00:00:00"


def test_pipeline_end_to_end(spark):
    bronze, silver = work_dir(spark, "t-bronze"), work_dir(spark, "t-silver")
    for name in SOURCES:
        b = fx.bronze(spark, SF0001, name)
        if name == "order_lines":
            b = b.drop("TIE")               # the source has no such column
        b.write.parquet(source_path(bronze, name))

    rep = pipeline.run_models(spark, bronze, silver, AS_OF, "r1", threads=2)
    assert set(rep) == set(MODELS) and all(r["mode"] == "create" for r in rep.values())
    for name in ("surveys", "order_headers"):
        spec = MODELS[name]
        want = build_silver(fx.bronze(spark, SF0001, spec.source), spec, AS_OF, "r1")
        assert rows(read_table(spark, pipeline.silver_path(silver, name))) == rows(want)

    # a second run over the same bronze changes no business value
    before = rows(read_table(spark, pipeline.silver_path(silver, "surveys")).drop("_run_id"))
    rep2 = pipeline.run_models(spark, bronze, silver, AS_OF, "r2", models=["surveys"], threads=1)
    assert rep2["surveys"]["mode"] == "merge"
    assert rows(read_table(spark, pipeline.silver_path(silver, "surveys")).drop("_run_id")) == before

    pipeline.run_snapshots(spark, bronze, silver, AS_OF)
    assert pipeline.current_customers(spark, silver).count() > 0
    views = pipeline.register_views(spark, silver)
    assert "order_lines" in views and "current_customers" in views
    n = spark.sql("select count(*) from order_headers o join current_customers c using (CUSTOMER_ID)").first()[0]
    assert n > 0

    res = {(r.table, r.check): r for r in pipeline.run_tests(spark, silver, AS_OF).collect()}
    assert res[("order_headers", "unique_order_id")].status == "pass"
    assert ("order_headers", "order_customer_exists") in res
    fr = {r.source: r.status for r in pipeline.source_freshness(spark, bronze, AS_OF).collect()}
    assert set(fr) == set(SOURCES) and fr["order_headers"] == "error"
