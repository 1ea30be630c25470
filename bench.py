"""Benchmark: run every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with a ``noop`` write (every row computed,
nothing collected): one untimed pass (JVM warm-up), then ``$BENCH_RUNS``
(default 2) timed passes; each query reports its best pass.  Derived inputs
(trip files landed from ``lineitem``, the partitioned trip table, text files)
are built first and timed separately as ``prep``; the trip ingest itself is
also timed as the ``trips_partitioned_write`` query.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = set(sys.argv[1:])

    from tessera.plans import catalog, materialize as M
    from tessera.session import local_session
    from tessera.plans.timing import time_queries

    # Spark's event log, in a fresh scratch folder, for per-stage times
    log_dir = tempfile.mkdtemp(prefix="tessera-bench-events-", dir="/tmp")
    spark = local_session(cpus, app="tessera-bench",
                          extra={"spark.eventLog.enabled": "true",
                                 "spark.eventLog.dir": log_dir,
                                 # one plain JSON-lines file, readable without codecs
                                 "spark.eventLog.rolling.enabled": "false",
                                 "spark.eventLog.compress": "false"})
    prep = {}
    for name, build in (("landing", M.trip_landing), ("trips_by_month", M.trips_table),
                        ("lines_input", M.text_lines), ("corpus_input", M.tsv_corpus)):
        t0 = time.perf_counter()
        build(spark, sf_dir)
        prep[name] = round(time.perf_counter() - t0, 3)

    qs = {k: v for k, v in catalog.queries().items() if not only or k in only}
    # a first pass: reported as "cold"; it also compiles the code paths that
    # the queries share, so the timed passes are not charged for it
    cold = time_queries(spark, qs, sf_dir)
    runs = max(1, int(os.environ.get("BENCH_RUNS", "2")))
    passes = [time_queries(spark, qs, sf_dir, label_prefix=f"p{i}:") for i in range(runs)]
    # best of the timed passes per query (run-to-run noise is ~20 % here)
    timings = {k: min((p[k] for p in passes), key=lambda t: t["sec"]) for k in qs}
    total = round(sum(t["sec"] for t in timings.values()), 3)
    out = {
        "metric": "total_query_time",
        "value": total,
        "unit": "sec",
        "queries": {k: t["sec"] for k, t in timings.items()},
        "cold": {k: cold[k]["sec"] for k in qs},
        "prep": prep,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": cpus,
        "runs": f"best of {runs} timed passes after one warm-up pass",
    }
    spark.stop()   # closes the event log
    # per query (last timed pass): stages run and the longest single task
    try:
        import glob
        from tessera.plans.timing import query_stage_summary
        reader = local_session(2, app="tessera-bench-log",
                               extra={"spark.eventLog.enabled": "false"})
        last = f"p{runs - 1}:"
        logs = [f for f in glob.glob(f"{log_dir}/*") if not os.path.isdir(f)]
        summary = {r["query"][len(last):]: {"stages": r["stages"], "max_task_ms": r["max_task_ms"]}
                   for r in query_stage_summary(reader, logs).collect()
                   if r["query"].startswith(last)}
        out["stages"] = dict(sorted(summary.items()))
        reader.stop()
    except Exception as e:  # noqa: BLE001 - timings stand without the log summary
        out["stages_error"] = str(e)[:200]
    print(json.dumps(out))


if __name__ == "__main__":
    main()
