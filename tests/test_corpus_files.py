"""Corpus preparation (R1-R5) and file bookkeeping (R6-R9)."""

import re

import pytest
from pyspark.sql import functions as F

from tessera.operators import corpus as C
from tessera.operators import files as FL


def test_number_rows_is_dense_and_ordered(spark):
    df = spark.range(0, 1000, numPartitions=7).select(
        (F.col("id") * 7919 % 1000).alias("k"))
    rows = C.number_rows(df, ["k"])[0].select("k", "n").collect()
    assert sorted((r.k, r.n) for r in rows) == [(k, k + 1) for k in range(1000)]


def test_number_corpus_ids_and_blanks(spark):
    titles = spark.createDataFrame(
        [(i, f"  Title {i}\t") for i in range(1, 12)] + [(99, "   "), (100, "")],
        "pos int, title string")
    rows = C.number_corpus(titles, order=["pos"])[0].collect()
    assert [r.doc_id for r in rows][:2] == ["doc_01.txt", "doc_02.txt"]
    assert len(rows) == 11 and rows[-1].doc_id == "doc_11.txt"
    assert rows[0].content == "Title 1"


def test_doc_map(spark):
    titles = spark.createDataFrame([(1, "A"), (2, "B")], "pos int, title string")
    m = C.doc_map(C.number_corpus(titles, order=["pos"])[0]).collect()
    assert [(r.doc_id, r.title) for r in m] == [("doc_1.txt", "A"), ("doc_2.txt", "B")]


def test_replicate_corpus_fresh_ids_then_copies(spark):
    titles = spark.createDataFrame([(i, f"t{i}") for i in range(1, 6)], "pos int, title string")
    numbered, total = C.number_corpus(titles, order=["pos"])
    rep = C.replicate_corpus(numbered, total, base_repeats=3, num_copies=2).collect()
    assert len(rep) == 5 * 3 * 2
    ids = {r.doc_id for r in rep}
    assert len(ids) == 15 and "doc_15.txt" in ids and "doc_01.txt" in ids
    by_id = {}
    for r in rep:
        by_id.setdefault(r.doc_id, set()).add(r.content)
    assert by_id["doc_06.txt"] == {"t1"}          # second pass, first title


def test_plan_replication():
    mb = 1024 * 1024
    assert C.plan_replication(2 * mb, 200 * mb) == (25, 4)
    assert C.plan_replication(100 * mb, 200 * mb) == (1, 2)
    # half-way cases go to the even number
    assert C.plan_replication(50 * mb, 125 * mb) == (1, 2)
    assert C.plan_replication(50 * mb, 175 * mb) == (1, 4)
    big = 10 ** 30 + 1                       # beyond what a float can hold
    assert C.plan_replication(big, 3 * big, part_bytes=big + 1) == (2, 2)
    assert C.plan_text_replication(2 * mb, 200 * mb) == (3, 33)
    assert C.plan_text_replication(10 * mb, 200 * mb) == (1, 20)
    with pytest.raises(ValueError):
        C.plan_replication(0, 10)


def test_corpus_stats(spark):
    df = spark.createDataFrame([("ab\ncd",), ("é",)], "line string")
    r = C.corpus_stats(df).first()
    assert (r.n_docs, r.n_lines, r.n_bytes) == (2, 3, 6 + 3)
    assert r.mb == pytest.approx(9 / 1048576)


def test_gen_sentences_deterministic_and_well_formed(spark):
    one = spark.range(0, 200, numPartitions=1)
    many = spark.range(0, 200, numPartitions=8)
    a = {r.id: r.line for r in C.gen_sentences(one).collect()}
    b = {r.id: r.line for r in C.gen_sentences(many).collect()}
    assert a == b
    vocab = set(C.NOUNS) | set(C.VERBS) | set(C.ADJECTIVES) | set(C.CONNECTORS) | {
        "the", "can", "every", "and", "together", "must", "of", "shapes", "our"}
    for line in a.values():
        sentences = [s for s in re.split(r"(?<=\.) ", line)]
        assert 3 <= len(sentences) <= 7
        assert all(s[0].isupper() and s.endswith(".") for s in sentences)
        words = re.findall(r"[a-z]+", line.lower())
        assert set(words) <= vocab
    assert a != {r.id: r.line for r in C.gen_sentences(one, seed=7).collect()}


def test_classify_era(spark):
    names = ["yellow_tripdata_2022-12.parquet", "yellow_tripdata_2023-01.parquet",
             "yellow_tripdata_2023-02.parquet", "green_tripdata_2024-01.parquet", "other.txt"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = [(r.name, r.era) for r in FL.classify_era(df, "name").collect()]
    assert got == [(names[0], "a"), (names[1], "a"), (names[2], "b"), (names[3], "b"),
                   (names[4], None)]


def test_expand_and_missing(spark):
    expected = FL.expand_months(FL.year_range(spark, "2020-2025"))
    assert expected.count() == 72
    assert FL.expand_months(FL.year_range(spark, 2024), [1, 2, 3]).count() == 3
    assert FL.year_range(spark, "2020 2022").count() == 2
    found = spark.createDataFrame([("yellow_tripdata_2020-01.parquet",)], "file_name string")
    assert FL.missing_files(expected, found).count() == 71
    with pytest.raises(ValueError):
        FL.expand_months(FL.year_range(spark, 2024), [0, 13])


def test_source_inventory(spark, tmp_path):
    a = str(tmp_path / "raw_a")
    b = str(tmp_path / "raw_b")
    spark.range(10).write.parquet(a)
    spark.range(10).write.parquet(b)
    inv = {r.era: r.n_files for r in FL.source_inventory(spark, {"a": a, "b": b}).collect()}
    assert inv["a"] >= 1 and inv["b"] >= 1
    empty = str(tmp_path / "empty")
    spark.range(0).write.parquet(empty)
    with pytest.raises(FileNotFoundError):
        FL.source_inventory(spark, {"a": empty}, glob="*.none")


def test_gen_text_stops_at_target_bytes(spark):
    target = 20_000
    lines = C.gen_text(spark, target, partitions=5).orderBy("id").collect()
    sizes = [len(r.line.encode("utf-8")) + 1 for r in lines]
    assert [r.id for r in lines] == list(range(len(lines)))
    assert sum(sizes) >= target and sum(sizes[:-1]) < target
    same = C.gen_text(spark, target, partitions=2).orderBy("id").collect()
    assert [r.line for r in same] == [r.line for r in lines]


def test_number_rows_heavy_ties_are_split_and_stable(spark):
    df = spark.range(0, 3000, numPartitions=6).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"))
    # tiny data: keep AQE from merging the range partitions back into one
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out, total = C.number_rows(df, ["k"])
        rows = sorted((r.n, r.k, r.id) for r in out.collect())
        sizes = out.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [r[0] for r in rows] == list(range(1, 3001))
    tied = [r[2] for r in rows[:1000]]
    assert all(r[1] == 0 for r in rows[:1000]) and tied == sorted(tied)   # input order
    assert max(r["count"] for r in sizes) < 1000                         # ties split


def test_cluster_conf_scales_with_input():
    from tessera.session import cluster_conf
    small = cluster_conf(10 << 30)
    big = cluster_conf(100 << 40)
    assert int(small["spark.sql.shuffle.partitions"]) == 200
    assert int(big["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    assert big["spark.sql.adaptive.enabled"] == "true"


def test_build_title_corpus(spark, tmp_path):
    from tessera.plans.build import build_title_corpus
    from tessera.sources.text import read_tsv_corpus
    d = tmp_path / "titles"
    d.mkdir()
    (d / "t.txt").write_text("Alpha\n\nBeta\nGamma\n")
    plain = build_title_corpus(spark, str(d), str(tmp_path / "plain"))
    rows = sorted(map(tuple, read_tsv_corpus(spark, plain["corpus"]).collect()))
    assert rows == [("doc_1.txt", "Alpha"), ("doc_2.txt", "Beta"), ("doc_3.txt", "Gamma")]
    single = sum(len(t) + 15 for t in ("Alpha", "Beta", "Gamma"))
    grown = build_title_corpus(spark, str(d), str(tmp_path / "grown"),
                               target_bytes=6 * single, part_bytes=2 * single)
    assert (grown["base_repeats"], grown["num_copies"]) == (2, 3)
    corpus = read_tsv_corpus(spark, grown["corpus"])
    assert corpus.count() == 3 * 2 * 3
    assert corpus.select("doc_id").distinct().count() == 6
    dm = sorted(map(tuple, read_tsv_corpus(spark, grown["doc_map"]).collect()))
    assert dm[:2] == [("doc_1.txt", "Alpha"), ("doc_2.txt", "Beta")]
    assert dm[3] == ("doc_4.txt", "Alpha") and len(dm) == 6


def test_build_text(spark, tmp_path):
    from tessera.plans.build import build_text
    from tessera.sources.text import read_lines
    res = build_text(spark, str(tmp_path / "t"), base_bytes=5000, target_bytes=20000,
                     min_part_bytes=8000)
    lines = read_lines(spark, res["text"])
    base = C.gen_text(spark, 5000)
    actual = C.corpus_stats(base).first()["n_bytes"]
    repeats, copies = C.plan_text_replication(actual, 20000, 8000)
    assert res["times"] == repeats * copies == 4
    assert lines.count() == base.count() * res["times"]
    assert set(r.line for r in lines.collect()) == set(r.line for r in base.collect())


def test_name_and_id_padding(spark):
    df = spark.createDataFrame([(2020, 1), (999, 12), (12345, 7)], "y int, m int")
    names = [r[0] for r in df.select(FL.trip_file_name(F.lit("yellow"), "y", "m")).collect()]
    assert names == ["yellow_tripdata_2020-01.parquet", "yellow_tripdata_0999-12.parquet",
                     "yellow_tripdata_12345-07.parquet"]
    ids = spark.createDataFrame([(1,), (42,), (100,)], "n bigint")
    got = [r[0] for r in ids.select(C.doc_id_col(F.col("n"), 100)).collect()]
    assert got == ["doc_001.txt", "doc_042.txt", "doc_100.txt"]


@pytest.mark.parametrize("build", ["number_corpus_file_order", "build_title_corpus"])
def test_file_order_survives_other_splits_and_cores(spark, workdir, build):
    """Split planning differs between the counting and the reading job: every
    title keeps its number."""
    from tessera.plans.build import build_title_corpus
    from tessera.sources.text import read_lines_positioned, read_tsv_corpus, write_lines
    titles = spark.range(20000).select(F.concat(F.lit("title "), F.col("id").cast("string")).alias("t"))
    write_lines(titles.orderBy("t").coalesce(4), "t", workdir)
    expected = [r.t for r in titles.orderBy("t").collect()]
    changed = {"spark.sql.files.maxPartitionBytes": ("24k", "9k"),
               "spark.sql.leafNodeDefaultParallelism": ("4", "9"),
               "spark.sql.files.openCostInBytes": ("1k", "2k")}
    before = {k: spark.conf.get(k, None) for k in changed}
    try:
        for k, (first, _) in changed.items():
            spark.conf.set(k, first)
        if build == "number_corpus_file_order":
            numbered, total = C.number_corpus_file_order(read_lines_positioned(spark, workdir))
            assert total == 20000
        else:
            out = build_title_corpus(spark, workdir, f"{workdir}-out")["corpus"]
        for k, (_, then) in changed.items():
            spark.conf.set(k, then)
        if build == "build_title_corpus":
            numbered = read_tsv_corpus(spark, out)
        rows = numbered.select("doc_id", "content").orderBy("doc_id").collect()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert [r.content for r in rows] == expected
    assert rows[0].doc_id == "doc_00001.txt" and rows[-1].doc_id == "doc_20000.txt"


def test_numbering_raises_where_rows_left_their_segment(spark):
    """Segments that change between counting and reading are an error, not a loss."""
    df = spark.range(100).select("id", F.lit("a").alias("seg"))
    numbered, _ = C.number_segments(df, ["seg"], F.col("id") + F.expr("spark_partition_id()"))
    assert numbered.count() == 100
    moved, _ = C.number_segments(spark.range(0, 100, 1, 4), [F.lit("a")], F.monotonically_increasing_id())
    with pytest.raises(Exception, match="not where it was"):
        moved.collect()
