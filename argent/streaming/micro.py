"""Micro-batch loads with Structured Streaming (ST1-ST4).

* :func:`bronze_stream` - ``readStream`` over a bronze Parquet folder; new
  files become new micro-batches (the stream checkpoint records which).
* :func:`stream_upsert` - ST2: every micro-batch is staged like a batch run
  (active rows, newest per key, cleaning, audit columns) and merged into the
  bucketed silver table with a sequence guard, so a late batch never overwrites
  a newer row (ST3) and the result equals the batch build. The commit records
  the micro-batch's number, so one that is delivered again is not applied again.
* :func:`run_incremental` - ST1: the scheduled load. ``trigger`` is
  ``{"availableNow": True}`` (drain what is there, then stop; run it from a
  scheduler every 15 minutes) or ``{"processingTime": "15 minutes"}``.

The high-water mark of the batch path (ST4) stands in the table's pointer
(:func:`argent.sources.silver_table.table_high_water`); the stream checkpoint is
an independent second position.
"""

from __future__ import annotations

from typing import Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from argent.operators.staging import AUDIT_SYNC
from argent.plans.models import ModelSpec, build_silver, match_condition, utc_now, window_start

DEFAULT_TRIGGER = {"availableNow": True}


def bronze_stream(spark: SparkSession, path: str, schema, max_files_per_trigger: Optional[int] = None) -> DataFrame:
    """A streaming scan of a bronze folder (schema given: no inference on streams)."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(path)


def stream_upsert(stream: DataFrame, spec: ModelSpec, target_path: str, checkpoint: str, as_of, run_id: str,
                  trigger: Optional[dict] = None, use_window: Optional[bool] = False,
                  query_name: Optional[str] = None) -> StreamingQuery:
    """ST2: keyed upsert of every micro-batch into the silver table.

    ``as_of`` is a time, None (the time of each micro-batch) or a function that
    gives it; ``run_id`` is a text or a function of the batch number.
    """
    from argent.sources.silver_table import merge_upsert

    def per_batch(df: DataFrame, batch_id: int) -> None:
        now = (as_of() if callable(as_of) else as_of) or utc_now()
        batch = build_silver(df, spec, now, run_id(batch_id) if callable(run_id) else run_id)
        window = match_condition(spec, now, use_window)
        merge_upsert(df.sparkSession, target_path, batch, spec.key, match_cond=window, guard_col=AUDIT_SYNC,
                     window_from=window_start(now) if window is not None else None, applied=(checkpoint, batch_id))

    w = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    return w.trigger(**(trigger or DEFAULT_TRIGGER)).start()


def run_incremental(spark: SparkSession, spec: ModelSpec, bronze_path: str, schema, target_path: str,
                    checkpoint: str, as_of, run_id: str, trigger: Optional[dict] = None,
                    max_files_per_trigger: Optional[int] = None, timeout_s: Optional[float] = None) -> None:
    """ST1: one scheduled micro-batch load of a model; waits for it to finish
    (``availableNow``) or for ``timeout_s`` (continuous triggers)."""
    q = stream_upsert(bronze_stream(spark, bronze_path, schema, max_files_per_trigger), spec, target_path,
                      checkpoint, as_of, run_id, trigger)
    if (trigger or DEFAULT_TRIGGER).get("availableNow"):
        q.awaitTermination()
    else:
        q.awaitTermination(timeout_s)
        q.stop()
    if q.exception() is not None:
        raise q.exception()
