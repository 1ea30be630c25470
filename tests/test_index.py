"""The stored inverted index, and searches that read texts once."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tessera.operators import index as IX
from tessera.operators import text as TX
from tessera.session import fresh_dir

WORDS = ["red", "redder", "blue", "sea", "a", "the", "café"]


def _rows(seed, n=120):
    rng = random.Random(seed)
    ids = [None, "a", "b"] + [f"d{i}" for i in range(30)]
    out = [(rng.choice(ids), " ".join(rng.choice(WORDS) for _ in range(rng.randrange(9)))) for _ in range(n)]
    return out + [("a", None), (None, None), ("x", ""), ("x", "Red-RED'red red1red")] + out[:20]


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.mark.parametrize("seed", [1, 2])
def test_index_search_equals_text_search(spark, seed):
    df = spark.createDataFrame(_rows(seed), "doc_id string, content string")
    name = f"index_test_{seed}"
    IX.write_index(df, name, fresh_dir(spark, "index"), buckets=8, shards=3)
    for terms in (["red"], ["red", "blue"], ["the", "a", "sea"], ["caf"], ["absent"], ["Red", "red", "absent"]):
        for k in (1, 5, 1000):
            want = [tuple(r) for r in TX.search_all_words(df, terms, k).collect()]
            assert [tuple(r) for r in IX.search_with_texts(spark, name, df, terms, k).collect()] == want, (terms, k)


def test_index_holds_every_token_once_per_document(spark):
    rows = _rows(3)
    df = spark.createDataFrame(rows, "doc_id string, content string")
    got = {(r.word, r.doc_id, r.len): r.tf for r in IX.all_postings(df).groupBy("word", "doc_id", "len").agg(F.sum("tf").alias("tf")).collect()}
    want = {}
    for d, t in rows:
        for w in re.findall("[a-z]+", (t or "").lower()):
            want[(w, d, len(t))] = want.get((w, d, len(t)), 0) + 1
    assert got == want


def test_only_texts_are_shuffled_for_the_postings(spark):
    df = spark.createDataFrame(_rows(5), "doc_id string, content string")
    exchanges = [x for x in _plan(IX.all_postings(df)).splitlines() if " Exchange " in x]
    assert len(exchanges) == 1 and "word" not in exchanges[0]
    IX.write_index(df, "unshuffled_index", fresh_dir(spark, "index"), buckets=4, shards=2)
    stored = spark.table("unshuffled_index").drop("slot")
    assert sorted(map(str, stored.collect())) == sorted(map(str, IX.all_postings(df).select(*stored.columns).collect()))


def test_search_reads_the_buckets_of_its_terms_only(spark):
    df = spark.createDataFrame([(f"d{i}", f"word{chr(97 + i % 26)} common") for i in range(200)], "doc_id string, content string")
    location = fresh_dir(spark, "index")
    IX.write_index(df, "pruned_index", location, buckets=16, shards=2)
    found = IX.postings_of(spark, "pruned_index", ["wordc"])
    one_file_a_task = {"spark.sql.files.maxPartitionBytes": "64k", "spark.sql.files.openCostInBytes": "64k"}
    before = {c: spark.conf.get(c) for c in one_file_a_task}
    try:
        for c, v in one_file_a_task.items():
            spark.conf.set(c, v)
        assert IX.postings_of(spark, "pruned_index", ["wordc"]).rdd.getNumPartitions() <= 2
        assert spark.table("pruned_index").rdd.getNumPartitions() > 8
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    # the plan names the buckets where it does not leave bucketed scans to the planner
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        chosen = re.search(r"SelectedBucketsCount: (\d+) out of 16", _plan(IX.postings_of(spark, "pruned_index", ["wordc"])))
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert chosen and int(chosen.group(1)) <= 2
    assert found.count() == sum(i % 26 == 2 for i in range(200))
    # a word of all documents is in as many slots as it has shards
    slots = IX.postings_of(spark, "pruned_index", ["common"]).groupBy("slot").count().collect()
    assert len(slots) == 2 and sum(r["count"] for r in slots) == 200 and max(r["count"] for r in slots) < 150


def test_index_is_found_by_a_later_session_and_replaced(spark):
    first = spark.createDataFrame([("a", "old words")], "doc_id string, content string")
    second = spark.createDataFrame([("b", "new words")], "doc_id string, content string")
    IX.write_index(first, "kept_index", fresh_dir(spark, "index"), shards=1)
    IX.write_index(second, "kept_index", fresh_dir(spark, "index"), shards=5)
    other = spark.newSession()
    assert IX.index_shards(other, "kept_index") == 5
    assert [r.doc_id for r in IX.search_index(other, "kept_index", ["words"]).collect()] == ["b"]
    empty = spark.createDataFrame([], "doc_id string, content string")
    IX.write_index(empty, "empty_index", fresh_dir(spark, "index"))
    assert IX.search_with_texts(spark, "empty_index", empty, ["words"]).collect() == []


def test_search_counts_rows_once_and_only_those_of_the_best(spark):
    """One pass of each term's pattern per scan, no array of matches, and the
    best ids below the second count."""
    df = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("red sea, red sun").alias("content"))
    path = fresh_dir(spark, "search-plan")
    df.write.parquet(path)
    out = TX.search_all_words(spark.read.parquet(path), ["red", "sea"], k=3)
    plan = _plan(out)
    assert "regexp_extract_all" not in plan
    for term in ("red", "sea"):
        lines = [x for x in plan.splitlines() if f"(?<![a-z]){term}(?![a-z])" in x]
        assert all("Aggregate(" in x for x in lines)               # in no filter and no projection
        assert sum("partial_sum" in x for x in lines) == 2           # counted in the input of each scan's sum
        assert all(x.count(f"(?<![a-z]){term}") == 1 for x in lines)
    # the ids meet the second scan below its count
    order = [("semi" if "LeftSemi" in x else "count") for x in plan.splitlines() if "partial_sum" in x or "LeftSemi" in x]
    assert order[0] == "count" and order[1] == "semi"
    assert [tuple(r) for r in out.collect()] == [(i, "red sea, red sun", 3) for i in range(3)]
