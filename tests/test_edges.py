"""Empty inputs, short results and other edges."""

from tessera.operators import text as TX
from tessera.operators import trips as TR
from tessera.plans.ingest import ingest_trips, show_partitions
from tessera.sources.trips import read_trips_partitioned
from tests.test_trips import A_TYPES, B_TYPES, _raw


def test_empty_corpus(spark):
    empty = spark.createDataFrame([], "doc_id string, content string")
    assert TX.word_count_top(empty, "content").count() == 0
    assert TX.vocabulary_size(empty, "content").first()[0] == 0
    assert TX.doc_frequency(empty).count() == 0
    assert TX.inverted_index(empty).count() == 0
    assert TX.postings(empty).count() == 0
    assert TX.search_word(empty, "the").count() == 0


def test_search_fewer_hits_than_k(spark):
    df = spark.createDataFrame([("a", "red red"), ("b", "red"), ("c", "blue")],
                               "doc_id string, content string")
    rows = [tuple(r) for r in TX.search_word(df, "red", k=10).collect()]
    assert rows == [("a", "red red", 2), ("b", "red", 1)]


def test_ingest_with_no_rows_in_window(spark, tmp_path):
    a = str(tmp_path / "raw_a")
    _raw(spark, [(1577836799999999, 1.0, 1, 10.0)], A_TYPES, 1.0).write.parquet(a)
    out = ingest_trips(spark, a, None, str(tmp_path / "t"), years=(2020, 2025))
    t = read_trips_partitioned(spark, out)
    assert t.count() == 0
    assert TR.trip_total(t).first()[0] == 0
    assert show_partitions(spark, out).count() == 0


def test_one_era_only(spark, tmp_path):
    b = str(tmp_path / "raw_b")
    _raw(spark, [(1675209600000000, 2.25, 0, -4.0)], B_TYPES, 1).write.parquet(b)
    out = ingest_trips(spark, None, b, str(tmp_path / "t"), years=(2020, 2025))
    assert read_trips_partitioned(spark, out).count() == 1


def test_inventory_missing_folders(spark, tmp_path):
    import pytest
    from tessera.operators.files import source_inventory
    a = str(tmp_path / "raw_a")
    spark.range(3).write.parquet(a)
    inv = {r.era: r.n_files for r in
           source_inventory(spark, {"a": a, "b": str(tmp_path / "nope")}).collect()}
    assert inv["a"] >= 1 and "b" not in inv
    with pytest.raises(FileNotFoundError):
        source_inventory(spark, {"a": str(tmp_path / "x"), "b": str(tmp_path / "y")})
