"""Mixing to target weights."""
from collections import defaultdict

from pyspark.sql import functions as F

from tessera.llm import mixing


def targets(sizes, weights=(5, 2, 1), most=3):
    """Water filling by rounds."""
    names = sorted(s for s in sizes if s is not None) + [s for s in sizes if s is None]
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, free, out = float(sum(sizes.values())), set(names), {}
    while free:
        share = left / sum(w[s] for s in free)
        over = {s for s in free if share * w[s] >= most * sizes[s]}
        if not over:
            return out | {s: share * w[s] for s in free}
        for s in over:
            out[s] = float(most * sizes[s])
            left -= out[s]
        free -= over
    return out


def rows():
    out = [(i, "word " * (5 + i % 7), "en", "b") for i in range(300)]
    out += [(1000 + i, "one two three", "en", "a") for i in range(4)]        # stops at three times its size
    out += [(2000 + i, f"x{i} " * 9, "en", None) for i in range(50)] + [(3000, None, "en", "c"), (3001, "", "en", "c")]
    return out + [(5, "same id", "en", "b"), (5, "same id", "en", "b"), (None, "no id here", "en", "b")]


def test_targets_and_taken_words(docs_of):
    got = mixing.mixed_documents(docs_of(rows())).collect()
    assert len(got) == len(rows())
    size, taken, target, largest = defaultdict(int), defaultdict(int), {}, defaultdict(int)
    for r in got:
        size[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r.size)
        assert r.taken == r.copies * r.size <= 3 * r.size
    expected = targets(dict(size))
    for s in size:
        assert abs(target[s] - expected[s]) < 1e-6
        assert abs(taken[s] - target[s]) <= largest[s]
    assert {r.source_size for r in got if r.source == "b"} == {size["b"]}


def test_reruns_agree_and_partitions_do_not_matter(docs_of):
    docs = docs_of(rows())
    first = sorted(map(repr, mixing.mixed_documents(docs).collect()))
    again = sorted(map(repr, mixing.mixed_documents(docs.repartition(7, "text")).collect()))
    assert first == again


def test_mixed_corpus_has_a_row_per_copy_and_keeps_columns(docs_of):
    docs = docs_of(rows()).withColumn("size", F.lit("clash")).withColumn("place", F.lit(1)).withColumn("copies", F.lit("x"))
    copies = {(r.doc_id, r.source): r.copies for r in mixing.mixed_documents(docs_of(rows())).collect() if r.doc_id not in (5, None)}
    out = mixing.mixed_corpus(docs)
    assert out.columns == docs.columns
    counted = {(r.doc_id, r.source): r["count"] for r in out.groupBy("doc_id", "source").count().collect() if r.doc_id not in (5, None)}
    assert counted == {k: v for k, v in copies.items() if v}


def test_place_orders_as_exponential_keys(spark):
    df = spark.range(2000).select(F.col("id"), F.lit("t").alias("t"), (1 + F.col("id") % 4).cast("double").alias("w"))
    got = df.select("w", mixing.exponential_place(F.col("id"), F.col("t"), F.col("w")).alias("p")).groupBy("w").agg(F.avg("p")).collect()
    mean = dict(map(tuple, got))
    # the mean of 1 - u ** (1 / w) is 1 / (w + 1): heavier documents come first
    assert all(abs(mean[w] - 1 / (w + 1)) < 0.04 for w in (1.0, 2.0, 3.0, 4.0))


def test_empty_table(docs_of):
    assert mixing.mixed_documents(docs_of([])).count() == 0
    assert mixing.mixed_documents(docs_of([(1, None), (2, "")])).filter("taken <> 0").count() == 0
