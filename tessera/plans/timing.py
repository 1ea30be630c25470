"""Per-query wall-clock timing (the run scripts' per-stage "Time taken").

A query is timed by executing it completely into the ``noop`` sink, which
computes every row without collecting any to the driver.  Row counts come
from a listener-free second pass only when asked for.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def run_to_noop(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def time_query(spark: SparkSession, fn: Callable[[SparkSession, str], DataFrame],
               sf_dir: str, count_rows: bool = False, label: str | None = None) -> dict:
    """Wall clock of one query; its jobs carry ``label`` as description."""
    sc = spark.sparkContext
    if label:
        sc.setJobDescription(label)
    try:
        t0 = time.perf_counter()
        df = fn(spark, sf_dir)
        run_to_noop(df)
        sec = time.perf_counter() - t0
    finally:
        if label:
            sc.setJobDescription(None)
    rows = df.count() if count_rows else None
    return {"sec": round(sec, 3), "rows": rows}


def time_queries(spark: SparkSession, qs: dict, sf_dir: str,
                 count_rows: bool = False, label_prefix: str = "") -> dict[str, dict]:
    """``{name: {"sec": s, "rows": n}}`` for every query, in order.

    Each query's jobs are described as ``label_prefix + name``.
    """
    return {name: time_query(spark, fn, sf_dir, count_rows, label=label_prefix + name)
            for name, fn in qs.items()}


_EVENT_SCHEMA = (
    "`Event` string, `Properties` map<string,string>, `Stage IDs` array<bigint>, "
    "`Stage ID` bigint, "
    "`Stage Info` struct<`Stage ID`: bigint, `Stage Name`: string, `Number of Tasks`: bigint, "
    "`Submission Time`: bigint, `Completion Time`: bigint>, "
    "`Task Info` struct<`Launch Time`: bigint, `Finish Time`: bigint>")


def stage_timings(spark: SparkSession, event_log: str | list[str]) -> DataFrame:
    """Per query and stage: tasks, stage time and the longest task, in ms.

    Read from Spark's event log (``spark.eventLog.enabled``; JSON lines,
    written with ``spark.eventLog.compress=false``) with Spark itself.  Stages are tied to queries through the job description
    set by ``time_query``; the longest task against the median shows skew.
    """
    from pyspark.sql import functions as F

    # only the fields used; no schema inference over the whole log (which
    # also trips over keys differing in case only between event types)
    ev = spark.read.schema(_EVENT_SCHEMA).json(event_log)
    jobs = (ev.where(F.col("Event") == "SparkListenerJobStart")
            .select(F.col("Properties").getItem("spark.job.description").alias("query"),
                    F.explode(F.col("`Stage IDs`")).alias("stage_id")))
    info = F.col("`Stage Info`")
    stages = (ev.where(F.col("Event") == "SparkListenerStageCompleted")
              .select(info.getField("Stage ID").alias("stage_id"),
                      info.getField("Stage Name").alias("stage_name"),
                      info.getField("Number of Tasks").alias("tasks"),
                      (info.getField("Completion Time") - info.getField("Submission Time"))
                      .alias("stage_ms")))
    task = F.col("`Task Info`")
    tasks = (ev.where(F.col("Event") == "SparkListenerTaskEnd")
             .select(F.col("`Stage ID`").alias("stage_id"),
                     (task.getField("Finish Time") - task.getField("Launch Time")).alias("ms"))
             .groupBy("stage_id")
             .agg(F.max("ms").alias("max_task_ms"),
                  F.percentile_approx("ms", 0.5).alias("median_task_ms")))
    return (jobs.where(F.col("query").isNotNull())
            .join(stages, "stage_id").join(tasks, "stage_id", "left")
            .select("query", "stage_id", "stage_name", "tasks", "stage_ms",
                    "max_task_ms", "median_task_ms"))


def query_stage_summary(spark: SparkSession, event_log: str | list[str]) -> DataFrame:
    """Per query: stages, summed stage time, tasks and the longest task."""
    from pyspark.sql import functions as F
    return (stage_timings(spark, event_log).groupBy("query")
            .agg(F.count(F.lit(1)).alias("stages"), F.sum("stage_ms").alias("stage_ms"),
                 F.sum("tasks").alias("tasks"), F.max("max_task_ms").alias("max_task_ms")))


def timings_frame(spark: SparkSession, timings: dict[str, dict]) -> DataFrame:
    """The timings as a small DataFrame ``(query, sec, rows)``."""
    return spark.createDataFrame(
        [(k, float(v["sec"]), v["rows"]) for k, v in timings.items()],
        "query string, sec double, rows bigint")
