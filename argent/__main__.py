"""Command line: ``python -m argent <command> --bronze ROOT --silver ROOT [...]``.

Commands mirror the pipeline's entry points:

* ``ingest``     apply delivered change logs and full extracts to the bronze tables
* ``run``        build / merge the staging models
* ``snapshot``   apply a snapshot run to the history tables
* ``test``       run every check suite; exit code 1 if an error-severity check failed
* ``freshness``  source freshness; exit code 1 on an error status

The results of ``test`` and ``freshness`` are small (one row per check /
source) and are printed.
"""

from __future__ import annotations

import argparse
import json
import sys


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="argent")
    ap.add_argument("command", choices=["ingest", "run", "snapshot", "test", "freshness"])
    ap.add_argument("--landing", help="root of the deliveries (<root>/<group>/<table>)")
    ap.add_argument("--groups", nargs="*", default=None, help="source groups to ingest (default: all)")
    ap.add_argument("--bronze", help="bronze root (<root>/<group>/<table>)")
    ap.add_argument("--silver", help="silver root")
    ap.add_argument("--as-of", default=None, help="run time, e.g. '2024-01-31 00:00:00' (default: now)")
    ap.add_argument("--run-id", default="run")
    ap.add_argument("--models", nargs="*", default=None)
    ap.add_argument("--match", default="model", choices=["model", "key"],
                    help="match window of each model, or match by key alone")
    ap.add_argument("--propagate-deletes", action="store_true", help="let deletes reach silver")
    ap.add_argument("--buckets", type=int, default=None, help="hash buckets of a first build (default: from the size)")
    ap.add_argument("--env", default="prod", choices=["prod", "dev"])
    ap.add_argument("--threads", type=int, default=None)
    ap.add_argument("--master", default=None, help="only for local runs; clusters set it in spark-submit")
    a = ap.parse_args(argv)

    from argent.plans import pipeline
    from argent.session import get_session

    spark = get_session(a.master)
    if a.command == "ingest":
        print(json.dumps(pipeline.run_ingest(spark, a.landing, a.bronze, a.as_of, a.models, a.groups, a.threads or 1), default=str))
        return 0
    if a.command == "run":
        print(json.dumps(pipeline.run_models(spark, a.bronze, a.silver, a.as_of, a.run_id, a.models, a.env, a.threads,
                                             use_window=False if a.match == "key" else None,
                                             propagate_deletes=a.propagate_deletes, num_buckets=a.buckets), default=str))
        return 0
    if a.command == "snapshot":
        print(json.dumps(pipeline.run_snapshots(spark, a.bronze, a.silver, a.as_of, a.models), default=str))
        return 0
    if a.command == "test":
        rows = pipeline.run_tests(spark, a.silver, a.as_of).collect()     # one row per check
    else:
        rows = pipeline.source_freshness(spark, a.bronze, a.as_of, a.models).collect()   # one row per source
    for r in rows:
        print(json.dumps(r.asDict(), default=str))
    return 1 if any(r["status"] == "error" for r in rows) else 0


if __name__ == "__main__":
    sys.exit(main())
