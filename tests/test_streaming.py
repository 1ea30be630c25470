"""Incremental ingest: re-runs pick up only new files, never duplicate rows."""

from tessera.plans.ingest import ingest_trips
from tessera.sources.trips import read_trips_partitioned
from tessera.streaming.ingest import run_trip_ingest
from tests.test_trips import A_TYPES, B_TYPES, ROWS_A, ROWS_B, _raw


def test_stream_ingest_is_incremental_and_idempotent(spark, tmp_path):
    a, b = str(tmp_path / "raw_a"), str(tmp_path / "raw_b")
    out, ck = str(tmp_path / "taxi_part"), str(tmp_path / "ck")
    _raw(spark, ROWS_A, A_TYPES, 1.0).write.parquet(a)
    _raw(spark, ROWS_B[:1], B_TYPES, 1).write.parquet(b)
    dirs = {"a": a, "b": b}
    run_trip_ingest(spark, dirs, out, ck, years=(2020, 2025))
    assert read_trips_partitioned(spark, out).count() == 3

    run_trip_ingest(spark, dirs, out, ck, years=(2020, 2025))       # nothing new
    assert read_trips_partitioned(spark, out).count() == 3

    _raw(spark, ROWS_B[1:], B_TYPES, 1).write.mode("append").parquet(b)  # a new month arrives
    run_trip_ingest(spark, dirs, out, ck, years=(2020, 2025))
    streamed = read_trips_partitioned(spark, out)
    assert streamed.count() == 4

    batch = read_trips_partitioned(
        spark, ingest_trips(spark, a, b, str(tmp_path / "batch"), years=(2020, 2025)))
    assert sorted(map(tuple, streamed.collect()), key=repr) == \
        sorted(map(tuple, batch.collect()), key=repr)


def test_bounded_micro_batches_same_result(spark, tmp_path):
    import os
    a = str(tmp_path / "raw_a")
    for i, row in enumerate(ROWS_A):                 # one file per row
        _raw(spark, [row], A_TYPES, 1.0).coalesce(1).write.mode("append").parquet(a)
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    run_trip_ingest(spark, {"a": a}, out, ck, years=(2020, 2025), max_files_per_trigger=1)
    batches = [f for f in os.listdir(f"{ck}/commits") if not f.startswith(".")]
    assert len(batches) == len(ROWS_A)                               # one batch per file
    assert read_trips_partitioned(spark, out).count() == 2
