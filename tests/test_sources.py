"""Sources: TSV edge cases (S12), directory input (S19), era readers (S10, S11)."""

import os

import pytest

from tessera import schemas
from tessera.sources.text import read_lines, read_lines_positioned, read_tsv_corpus, write_tsv_corpus
from tessera.sources.trips import read_trips_era


def _write(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w", encoding="utf-8") as f:
        f.write(text)


def test_tsv_edges(spark, tmp_path):
    d = str(tmp_path / "corpus")
    _write(d, "corpus.txt",
           'doc_1\tHe said "hi\ndoc_2\t\ndoc_3\ndoc_4\ta\textra\n\n\\N\tx\n')
    rows = [tuple(r) for r in read_tsv_corpus(spark, d).collect()]
    assert rows == [("doc_1", 'He said "hi'), ("doc_2", ""), ("doc_3", None),
                    ("doc_4", "a"), ("", None), ("\\N", "x")]
    mapped = [tuple(r) for r in read_tsv_corpus(spark, d, map_null_marker=True).collect()]
    assert mapped[-1] == (None, "x")


def test_tsv_round_trip_nulls(spark, tmp_path):
    df = spark.createDataFrame([("a", "x y"), ("b", None), (None, "z")],
                               "doc_id string, content string")
    out = write_tsv_corpus(df, "doc_id", "content", str(tmp_path / "tsv"))
    back = sorted((tuple(r) for r in read_tsv_corpus(spark, out, map_null_marker=True).collect()),
                  key=repr)
    assert back == sorted([("a", "x y"), ("b", None), (None, "z")], key=repr)


def test_lines_read_whole_directory(spark, tmp_path):
    d = str(tmp_path / "input")
    _write(d, "a.txt", "one\ntwo\n")
    _write(d, "b.txt", "three\n")
    assert sorted(r.line for r in read_lines(spark, d).collect()) == ["one", "three", "two"]


def test_positioned_lines_give_file_order(spark, tmp_path):
    from tessera.operators.corpus import number_segments
    d = str(tmp_path / "input")
    _write(d, "a.txt", "".join(f"a{i}\n" for i in range(50)))
    _write(d, "b.txt", "".join(f"b{i}\n" for i in range(30)))
    df = read_lines_positioned(spark, d)
    numbered, total = number_segments(df, ["_file", "_start"], "_pos")
    n = numbered.select("line", "n")
    assert total == 80
    got = [r.line for r in n.orderBy("n").collect()]
    assert got == [f"a{i}" for i in range(50)] + [f"b{i}" for i in range(30)]
    assert [r.n for r in n.orderBy("n").collect()] == list(range(1, 81))


def _era_frames(spark):
    a = spark.createDataFrame(
        [(1, 1577836800000000, 1577837000000000, 1.0, 2.5, 1.0, "N", 10, 20, 1,
          9.0, 0.5, 0.5, 1.0, 0.0, 0.3, 11.3, 2.5, 1.25)],
        "VendorID bigint, tpep_pickup_datetime bigint, tpep_dropoff_datetime bigint, "
        "passenger_count double, trip_distance double, RatecodeID double, "
        "store_and_fwd_flag string, PULocationID bigint, DOLocationID bigint, "
        "payment_type bigint, fare_amount double, extra double, mta_tax double, "
        "tip_amount double, tolls_amount double, improvement_surcharge double, "
        "total_amount double, congestion_surcharge double, airport_fee double")
    b = spark.createDataFrame(
        [(2, 1675209600000000, 1675209900000000, 2, 1.5, 1, "Y", 11, 21, 2,
          7.0, 0.0, 0.5, 0.0, 0.0, 1.0, 8.5, 0.0, 0.0)],
        "VendorID int, tpep_pickup_datetime bigint, tpep_dropoff_datetime bigint, "
        "passenger_count bigint, trip_distance double, RatecodeID bigint, "
        "store_and_fwd_flag string, PULocationID int, DOLocationID int, "
        "payment_type bigint, fare_amount double, extra double, mta_tax double, "
        "tip_amount double, tolls_amount double, improvement_surcharge double, "
        "total_amount double, congestion_surcharge double, Airport_fee double")
    return a, b


def test_era_readers_exact_types_and_pruning(spark, tmp_path):
    a, b = _era_frames(spark)
    a.write.parquet(str(tmp_path / "raw_a"))
    b.write.parquet(str(tmp_path / "raw_b"))
    ra = read_trips_era(spark, str(tmp_path / "raw_a"), "a")
    rb = read_trips_era(spark, str(tmp_path / "raw_b"), "b")
    assert ra.schema == schemas.ERA_A and rb.schema == schemas.ERA_B
    assert ra.first().vendorid == 1 and rb.first().pulocationid == 11
    assert "airport_fee" not in ra.columns


def test_mixed_era_directory_is_rejected_by_one_reader(spark, tmp_path):
    a, b = _era_frames(spark)
    a.write.parquet(str(tmp_path / "mixed"))
    b.write.mode("append").parquet(str(tmp_path / "mixed"))
    with pytest.raises(Exception):
        read_trips_era(spark, str(tmp_path / "mixed"), "a").collect()


def test_timestamp_column_read_as_micros(spark, tmp_path):
    from pyspark.sql import functions as F
    df = spark.range(1).select(
        F.lit("2020-01-01 10:00:00.123456").cast("timestamp_ntz").alias("tpep_pickup_datetime"))
    df.write.parquet(str(tmp_path / "ts"))
    got = spark.read.schema("tpep_pickup_datetime bigint").parquet(str(tmp_path / "ts")).first()[0]
    assert got == 1577872800123456


def test_mixed_landing_routed_by_file_name(spark, tmp_path):
    import pyarrow.parquet as pq
    from tessera.operators.trips import unify
    from tessera.sources.trips import read_trips_routed, route_by_name
    a, b = _era_frames(spark)
    land = tmp_path / "landing"
    land.mkdir()
    pq.write_table(pq.read_table(_one_file(a, tmp_path / "a")), land / "yellow_tripdata_2023-01.parquet")
    pq.write_table(pq.read_table(_one_file(b, tmp_path / "b")), land / "yellow_tripdata_2023-02.parquet")
    (land / "notes.txt").write_text("not a trip file")
    routes = route_by_name(spark, str(land))
    assert [p.rsplit("/", 1)[-1] for p in routes["a"]] == ["yellow_tripdata_2023-01.parquet"]
    assert [p.rsplit("/", 1)[-1] for p in routes["b"]] == ["yellow_tripdata_2023-02.parquet"]
    eras = read_trips_routed(spark, str(land))
    assert eras["a"].schema == schemas.ERA_A and eras["b"].schema == schemas.ERA_B
    assert unify(eras.values(), 2020, 2025).count() == 2


def _one_file(df, path):
    import glob
    df.coalesce(1).write.parquet(str(path))
    return glob.glob(f"{path}/*.parquet")[0]


def test_title_corpus_file_order_with_blanks(spark, tmp_path):
    from tessera.operators.corpus import number_corpus_file_order
    d = str(tmp_path / "titles")
    _write(d, "a.txt", "  First \n\n Second\n   \nThird\n")
    _write(d, "b.txt", "\nFourth\n")
    rows = [(r.doc_id, r.content, r.n) for r in
            number_corpus_file_order(read_lines_positioned(spark, d))[0].orderBy("n").collect()]
    assert rows == [("doc_1.txt", "First", 1), ("doc_2.txt", "Second", 2),
                    ("doc_3.txt", "Third", 3), ("doc_4.txt", "Fourth", 4)]


def test_unknown_or_foreign_trip_files_are_errors(spark, tmp_path):
    from tessera.sources.trips import route_by_name
    a, _ = _era_frames(spark)
    one = tmp_path / "unknown"
    a.write.parquet(str(one / "fhv_tripdata_2020-01.parquet"))
    with pytest.raises(ValueError, match="not a monthly trip file"):
        route_by_name(spark, str(one))
    two = tmp_path / "green"
    a.withColumnRenamed("tpep_pickup_datetime", "lpep_pickup_datetime").write.parquet(
        str(two / "green_tripdata_2020-01.parquet"))
    with pytest.raises(ValueError, match="no column tpep_pickup_datetime"):
        route_by_name(spark, str(two))


def test_tsv_sink_refuses_separators(spark, tmp_path):
    from tessera.sources.text import write_tsv_corpus
    for row in (("a", "x\ny"), ("a\tb", "x"), ("a\nb", "x")):
        df = spark.createDataFrame([row], "doc_id string, content string")
        with pytest.raises(Exception, match="separates fields or rows"):
            write_tsv_corpus(df, "doc_id", "content", str(tmp_path / "out"))


def test_landing_deals_a_month_to_one_task_and_keeps_every_trip(spark, workdir):
    from pyspark.sql import functions as F

    from tessera.sources import testdata as TD
    from tests.conftest import SF_SMALL

    lineitem = TD.table(spark, SF_SMALL, "lineitem")
    TD.land_trips(lineitem.unionByName(lineitem.limit(1).withColumn("l_shipdate", F.lit(None).cast("timestamp_ntz"))), workdir)
    trips = TD.trips_from_lineitem(lineitem)
    months = trips.select("file_year", "file_month").distinct().count()
    n_files, n_rows = 0, 0
    for era in ("a", "b"):
        read = spark.read.option("recursiveFileLookup", "true").parquet(f"{workdir}/raw_{era}")
        n_files += len(read.inputFiles())
        n_rows += read.count()
    assert n_rows == lineitem.count()
    assert n_files == months
