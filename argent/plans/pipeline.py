"""

Bronze tables live at ``<bronze_root>/<group>/<table>``; silver tables at
``<silver_root>/<group>/<model>`` (bucketed, see ``silver_table``); history
tables at ``<silver_root>/snapshots/<name>``.

Models are independent, so ``threads`` > 1 submits several of them to Spark at
once from a driver thread pool (in Spark's default order, first come first
served, unless the session sets spark.scheduler.mode); the reference runs 4 at once in production and 2 in development.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from typing import Iterable, Optional

from pyspark.sql import DataFrame, SparkSession

from argent.operators import cdc, scd2
from argent.operators import quality as dq
from argent.operators.governance import tag_pii
from argent.operators.staging import active_only
from argent.plans.checks import FRESHNESS, SUITES
from argent.plans.models import MODELS, SNAPSHOTS, materialize
from argent.session import path_exists
from argent.sources.bronze import SOURCES, SYNCED, read_bronze, source_path
from argent.sources.silver_table import newest, read_table

SEQ = "_seq"                 # order of the changes of a key in a change log
THREADS = {"prod": 4, "dev": 2}


def silver_path(silver_root: str, model: str) -> str:
    return f"{silver_root.rstrip('/')}/{MODELS[model].group}/{model}"


def history_path(silver_root: str, snap: str) -> str:
    return f"{silver_root.rstrip('/')}/snapshots/{snap}"


def _pool_map(fn, items, threads: int):
    items = list(items)
    if threads <= 1 or len(items) <= 1:
        return [fn(i) for i in items]
    with ThreadPoolExecutor(max_workers=threads) as pool:
        return list(pool.map(fn, items))


def run_ingest(spark: SparkSession, landing_root: str, bronze_root: str, as_of=None,
               sources: Optional[Iterable[str]] = None, groups: Optional[Iterable[str]] = None, threads: int = 1) -> dict:
    """Entry 0: bring what was delivered under ``<landing_root>/<group>/<table>``
    into the bronze tables of the selected sources (or groups).

    A source with a change log delivers its changes: key and columns, ``_seq``
    and ``_op`` (I, U or D); the newest change per key is applied (S2). A source
    without one delivers a full extract, which is compared with the rows that
    are active in bronze; the differences are applied alike (S3). Deletes set
    the soft-delete flag, touched rows carry ``as_of``, and PII tags are kept
    with the table. A source without a delivery is left as it is.
    """
    names = list(sources or [s.table for s in SOURCES.values() if groups is None or s.group in set(groups)])

    def one(name):
        src = SOURCES[name]
        path, landing = source_path(bronze_root, name), source_path(landing_root, name)
        if not path_exists(spark, landing):
            return name, {"mode": "nothing delivered"}
        cols = [src.key, *src.columns]
        delivered = spark.read.parquet(landing)
        if src.capture == "log":
            changes, seq = delivered.select(*cols, SEQ, cdc.OP), SEQ
        else:
            extract = delivered.select(*cols)
            before = read_table(spark, path)
            before = extract.limit(0) if before is None else active_only(before).select(*cols)
            changes, seq = cdc.diff_as_changes(cdc.snapshot_diff(before, extract, src.key, src.columns), seq_col=SEQ), SEQ
        return name, cdc.apply_changes_to_table(spark, path, tag_pii(changes, dict(src.pii)), src.key, seq, as_of=as_of)

    return dict(_pool_map(one, names, threads))


def run_models(spark: SparkSession, bronze_root: str, silver_root: str, as_of=None, run_id: str = "run",
               models: Optional[Iterable[str]] = None, env: str = "prod", threads: Optional[int] = None,
               use_window: Optional[bool] = None, propagate_deletes: bool = False,
               num_buckets: Optional[int] = None, range_width: Optional[int] = None) -> dict:
    """Entry 1: build or incrementally merge every selected staging model.

    ``use_window=None`` follows each model's own match window (J4, and with it
    quirk Q3); False matches by key alone. The other options are those of
    ``materialize``."""
    names = list(models or MODELS)

    def one(name):
        spec = MODELS[name]
        bronze = read_bronze(spark, bronze_root, spec.source, spec.scan_columns)
        return name, materialize(spark, spec, bronze, silver_path(silver_root, name), as_of, run_id, env=env, use_window=use_window,
                                 propagate_deletes=propagate_deletes, num_buckets=num_buckets, range_width=range_width)

    return dict(_pool_map(one, names, threads or THREADS.get(env, 1)))


def run_snapshots(spark: SparkSession, bronze_root: str, silver_root: str, as_of=None,
                  snapshots: Optional[Iterable[str]] = None, threads: int = 1) -> dict:
    """Entry 2: apply one snapshot run to every selected history table."""
    names = list(snapshots or SNAPSHOTS)

    def one(name):
        spec = SNAPSHOTS[name]
        src = read_bronze(spark, bronze_root, spec.source)
        return name, scd2.snapshot(spark, history_path(silver_root, name), src, spec.key, as_of,
                                   pii=dict(spec.pii), docs=spec.docs)

    return dict(_pool_map(one, names, threads))


def current_customers(spark: SparkSession, silver_root: str) -> Optional[DataFrame]:
    """The current-customers view over the customer history."""
    h = read_table(spark, history_path(silver_root, "customer_history"))
    if h is None:
        return None
    cols = ["CUSTOMER_ID", *SNAPSHOTS["customer_history"].columns]
    return scd2.current_view(h, cols)


def run_tests(spark: SparkSession, silver_root: str, as_of=None) -> DataFrame:
    """Entry 3: every check suite plus the order -> customer reference check,
    as one result DataFrame (``check, table, column, severity, failures, status``)."""
    parts = []
    for table, checks in SUITES.items():
        path = (history_path(silver_root, table) if table in SNAPSHOTS else silver_path(silver_root, table))
        df = read_table(spark, path)
        if df is not None:
            parts.append(dq.run_checks(df, checks, table, as_of))
    orders = read_table(spark, silver_path(silver_root, "order_headers"))
    hist = read_table(spark, history_path(silver_root, "customer_history"))
    if orders is not None and hist is not None:
        from pyspark.sql import functions as F
        parts.append(dq.references(orders, hist, "CUSTOMER_ID", "order_headers", F.col("is_current") == F.lit(True),
                                   name="order_customer_exists"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def source_freshness(spark: SparkSession, bronze_root: str, as_of=None,
                     sources: Optional[Iterable[str]] = None) -> DataFrame:
    """Freshness of every bronze source against its group's thresholds.

    The newest load time of a table that the ingest wrote comes from the
    footers of its files; a plain folder's one column is read."""
    out = None
    for name in (sources or SOURCES):
        rule = FRESHNESS[SOURCES[name].group]
        found = newest(spark, source_path(bronze_root, name), SYNCED)
        f = (dq.freshness(read_bronze(spark, bronze_root, name, [SYNCED]), name, SYNCED, rule, as_of) if found is None
             else dq.freshness_of(found, name, rule, as_of))
        out = f if out is None else out.unionByName(f)
    return out


def register_views(spark: SparkSession, silver_root: str) -> list:
    """Expose every existing silver and history table, and the current
    customers view, as temp views for ``spark.sql`` (names = model names)."""
    names = []
    for name in MODELS:
        df = read_table(spark, silver_path(silver_root, name))
        if df is not None:
            df.createOrReplaceTempView(name)
            names.append(name)
    for name in SNAPSHOTS:
        df = read_table(spark, history_path(silver_root, name))
        if df is not None:
            df.createOrReplaceTempView(name)
            names.append(name)
    cur = current_customers(spark, silver_root)
    if cur is not None:
        cur.createOrReplaceTempView("current_customers")
        names.append("current_customers")
    return names
