"""Named table definitions and SQL over them, against rows worked out by hand."""

import pytest

from tessera import schemas
from tessera.operators import text as TX
from tessera.plans.ingest import append_era, append_era_to_table, ingest_trips, rebuild_table
from tessera.sources import tables as T
from tessera.sources.trips import read_trips_partitioned
from tests.test_trips import A_TYPES, B_TYPES, ROWS_A, ROWS_B, _raw


def test_lines_table_is_redefined_and_queried(spark, tmp_path):
    d = tmp_path / "notes"
    d.mkdir()
    (d / "a.txt").write_text("Green tea, GREEN leaf.\nit's tea\n")
    T.define_lines_table(spark, "notes", str(tmp_path / "notes"))
    t = T.define_lines_table(spark, "notes", str(d))
    assert spark.sql("SELECT count(*) FROM notes WHERE line LIKE '%tea%'").first()[0] == 2
    assert sorted(map(tuple, TX.word_counts(t).collect())) == [("green", 2), ("it", 1), ("leaf", 1), ("tea", 2)]


def test_corpus_table(spark, tmp_path):
    d = tmp_path / "shelf"
    d.mkdir()
    (d / "c.txt").write_text("b1\tRed Harbour\nb2\tHarbour of the Red Harbour\nb1\tRed Harbour\n")
    t = T.define_corpus_table(spark, "shelf", str(d))
    assert t.columns == ["doc_id", "content"] and t.count() == 3
    index = {r.word: (r.doc_count, r.doc_list) for r in TX.inverted_index(t, k=5, layout="single").collect()}
    assert index == {"red": (2, "b1,b2"), "harbour": (2, "b1,b2")}
    found = [tuple(r) for r in TX.search_all_words(spark.table("shelf"), ["red", "harbour"]).collect()]
    assert found == [("b1", "Red Harbour", 4), ("b2", "Harbour of the Red Harbour", 3)]


def test_era_and_partitioned_tables(spark, tmp_path):
    a, b = str(tmp_path / "raw_a"), str(tmp_path / "raw_b")
    _raw(spark, ROWS_A, A_TYPES, 1.0).write.parquet(a)
    _raw(spark, ROWS_B, B_TYPES, 1).write.parquet(b)
    assert T.define_trips_era_table(spark, "era_a", a, "a").schema["vendorid"].dataType.simpleString() == "bigint"
    assert T.define_trips_era_table(spark, "era_b", b, "b").schema["vendorid"].dataType.simpleString() == "int"
    out = ingest_trips(spark, a, b, str(tmp_path / "trips"), years=(2020, 2025))
    T.define_trips_partitioned_table(spark, "trips_defined", out)
    T.define_trips_partitioned_table(spark, "trips_defined", out)        # redefining replaces
    parts = {r[0] for r in spark.sql("SHOW PARTITIONS trips_defined").collect()}
    assert parts == {"anio=2020/mes=1", "anio=2023/mes=1", "anio=2023/mes=2", "anio=2023/mes=12"}
    early = spark.sql("SELECT mes FROM trips_defined WHERE anio = 2023 AND mes < 4").collect()
    assert sorted(r.mes for r in early) == [1, 2]


def test_definitions_are_found_by_another_session(spark, tmp_path):
    d = tmp_path / "it's here"
    d.mkdir()
    (d / "c.txt").write_text("b1\t\nb2\t\\N\textra\n\nb3\n")
    T.define_lines_table(spark, "kept_lines", str(d))
    T.define_corpus_table(spark, "kept_corpus", str(d), map_null_marker=True)
    a = str(tmp_path / "raw_a")
    _raw(spark, ROWS_A, A_TYPES, 1.0).write.parquet(a + "/yellow_tripdata_2020-01.parquet")
    T.define_trips_era_table(spark, "kept_era", a, "a")
    other = spark.newSession()
    assert other.sql("SELECT count(*) FROM kept_lines").first()[0] == 4
    rows = {tuple(r) for r in other.sql("SELECT doc_id, content FROM kept_corpus").collect()}
    assert rows == {("b1", ""), ("b2", None), ("", None), ("b3", None)}
    assert other.table("kept_era").columns == schemas.TRIP_COLUMNS and other.table("kept_era").count() == len(ROWS_A)
    # a table takes the place of a view, and a temporary view does not hide it
    spark.range(3).createOrReplaceTempView("kept_corpus")
    T.define_lines_table(spark, "kept_corpus", str(d))
    assert other.table("kept_corpus").columns == ["line"] == spark.table("kept_corpus").columns


def test_append_through_the_name_registers_its_months(spark, tmp_path):
    a, b = str(tmp_path / "raw_a"), str(tmp_path / "raw_b")
    _raw(spark, ROWS_A, A_TYPES, 1.0).write.parquet(a)
    _raw(spark, ROWS_B, B_TYPES, 1).write.parquet(b)
    out = ingest_trips(spark, a, None, str(tmp_path / "trips"), years=(2020, 2025))
    T.define_trips_partitioned_table(spark, "grown", out)
    before = spark.sql("SELECT count(*) FROM grown").first()[0]
    append_era_to_table(spark, b, "b", "grown", years=(2020, 2025))
    folder = read_trips_partitioned(spark, out)
    assert sorted(map(repr, spark.sql("SELECT * FROM grown").select(*folder.columns).collect())) == sorted(map(repr, folder.collect()))
    assert spark.sql("SELECT count(*) FROM grown").first()[0] > before
    assert "anio=2023/mes=12" in {r[0] for r in spark.sql("SHOW PARTITIONS grown").collect()}
    # months written past the table are seen once they are recovered
    append_era(spark, b, "b", out + "-2", years=(2020, 2025))
    T.define_trips_partitioned_table(spark, "late", out + "-2")
    append_era(spark, a, "a", out + "-2", years=(2020, 2025))
    assert T.recover_partitions(spark, "late").count() == folder.count()


def test_failed_rebuild_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    a, b = str(tmp_path / "raw_a"), str(tmp_path / "raw_b")
    _raw(spark, ROWS_A, A_TYPES, 1.0).write.parquet(a)
    _raw(spark, ROWS_B, B_TYPES, 1).write.parquet(b)
    root = str(tmp_path / "versions")
    first = rebuild_table(spark, a, None, "rebuilt", root, years=(2020, 2025))
    old = sorted(map(repr, spark.table("rebuilt").collect()))

    def intact():
        return sorted(map(repr, spark.sql("SELECT * FROM rebuilt").collect())) == old

    bad = tmp_path / "raw_bad"
    bad.mkdir()
    (bad / "part.parquet").write_bytes(b"this is no Parquet file")
    with pytest.raises(Exception):                       # while the rows are written
        rebuild_table(spark, a, str(bad), "rebuilt", root, years=(2020, 2025))
    assert intact()
    with monkeypatch.context() as m:                     # while the new table is defined
        m.setattr(T, "recover_partitions", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            rebuild_table(spark, a, b, "rebuilt", root, years=(2020, 2025))
    assert intact()
    with pytest.raises(Exception):                       # between the two renames
        T.swap_table(spark, "rebuilt", "there_is_no_such_table")
    assert intact()
    second = rebuild_table(spark, a, b, "rebuilt", root, years=(2020, 2025))
    assert second != first and not intact()
    assert spark.table("rebuilt").count() == read_trips_partitioned(spark, second).count() > len(old)
    assert "anio=2023/mes=12" in {r[0] for r in spark.sql("SHOW PARTITIONS rebuilt").collect()}
