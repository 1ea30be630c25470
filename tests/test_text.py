"""Text semantics S1-S8 on hand-made rows, plus metamorphic properties."""

import pytest
from pyspark.sql import functions as F

from tessera.functions.text import normalise_terms
from tessera.operators import text as TX

LINES = ["The cat, the CAT.", "a I x 42 !!", "don't stop", "Café-olé", "", None]

CORPUS = [
    ("doc_1.txt", "Twenty Years After"),
    ("doc_2.txt", "Twenty Twenty Years"),
    ("doc_3.txt", "After Years, Twenty Years"),
    ("doc_1.txt", "Twenty Years After"),
    ("doc_4.txt", "The Adventure of the Adventure"),
    ("doc_4.txt", "Another Adventure"),
]


@pytest.fixture()
def lines(spark):
    return spark.createDataFrame([(x,) for x in LINES], "line string")


@pytest.fixture()
def corpus(spark):
    return spark.createDataFrame(CORPUS, "doc_id string, content string")


def test_word_counts_s1_s3(lines):
    got = {r["word"]: r["total"] for r in TX.word_counts(lines).collect()}
    assert got == {"the": 2, "cat": 2, "don": 1, "stop": 1, "caf": 1, "ol": 1}


def test_vocabulary_size(lines):
    assert TX.vocabulary_size(lines).first()["palabras_unicas"] == 6


def test_tokenize_keeps_empty_and_single_letters(spark):
    df = spark.createDataFrame([("  The Café-X! ",)], "line string")
    assert [r.word for r in TX.tokenize(df).collect()] == ["", "the", "caf", "x", ""]


def test_null_text_yields_no_rows(spark):
    df = spark.createDataFrame([(None,)], "line string")
    assert TX.tokenize(df).count() == 0


def test_word_count_top_ties_broken_by_word(lines):
    rows = TX.word_count_top(lines, k=3).collect()
    assert [(r.word, r.total) for r in rows] == [("cat", 2), ("the", 2), ("caf", 1)]


def test_doc_frequency_counts_distinct_ids(corpus):
    got = {r.word: r.doc_count for r in TX.doc_frequency_all(corpus).collect()}
    assert got["twenty"] == 3 and got["years"] == 3 and got["after"] == 2
    assert got["adventure"] == 1 and got["another"] == 1
    assert "the" not in got and "of" not in got          # stopwords removed
    top = TX.doc_frequency(corpus, k=2).collect()
    assert [(r.word, r.doc_count) for r in top] == [("twenty", 3), ("years", 3)]


def test_doc_frequency_without_stopword_filter(corpus):
    got = {r.word: r.doc_count for r in TX.doc_frequency_all(corpus, stopwords=None).collect()}
    assert got["the"] == 1 and got["of"] == 1


def test_inverted_index_single_layout(corpus):
    rows = {r.word: r for r in TX.inverted_index(corpus, k=4, layout="single").collect()}
    assert rows["after"].doc_list == "doc_1.txt,doc_3.txt"
    assert rows["twenty"].doc_list == "doc_1.txt,doc_2.txt,doc_3.txt"
    assert rows["twenty"].doc_count == 3


def test_inverted_index_blocks_bounded_and_complete(spark):
    # numeric ids, tiny blocks: every block holds ids of one range only
    data = [(i, "alpha beta" if i % 3 else "alpha") for i in range(1, 26)]
    df = spark.createDataFrame(data, "doc_id bigint, content string")
    rows = TX.inverted_index(df, k=2, block_size=10).collect()
    by_word = {}
    for r in rows:
        ids = [int(x) for x in r.doc_list.split(",")]
        assert len(ids) <= 10
        assert ids == sorted(ids)
        assert ids == sorted(ids)
        by_word.setdefault(r.word, []).extend(ids)
    assert sorted(by_word["alpha"]) == list(range(1, 26))
    assert sorted(by_word["beta"]) == [i for i in range(1, 26) if i % 3]


def test_inverted_index_blocks_string_ids(corpus, spark):
    rows = TX.inverted_index(corpus, k=1, block_size=2).collect()
    ids = sorted(i for r in rows for i in r.doc_list.split(","))
    assert ids == ["doc_1.txt", "doc_2.txt", "doc_3.txt"]
    assert all(len(r.doc_list.split(",")) <= 2 for r in rows)
    big = spark.createDataFrame([(f"id{i:04d}", "alpha") for i in range(500)],
                                "doc_id string, content string")
    rows = TX.inverted_index(big, k=1, block_size=7).collect()
    sizes = [len(r.doc_list.split(",")) for r in rows]
    assert max(sizes) <= 7 and sum(sizes) == 500 and len({r.block for r in rows}) == len(rows)
    for r in rows:
        ids = r.doc_list.split(",")
        assert ids == sorted(ids)


def test_search_word_group_is_id_and_content(corpus):
    rows = TX.search_word(corpus, "adventure").collect()
    assert [(r.doc_id, r.titulo, r.score) for r in rows] == [
        ("doc_4.txt", "The Adventure of the Adventure", 2),
        ("doc_4.txt", "Another Adventure", 1)]


def test_search_all_words_and_semantics(corpus):
    rows = TX.search_all_words(corpus, ["Twenty", "years", "after"]).collect()
    assert [(r.doc_id, r.score) for r in rows] == [("doc_1.txt", 6), ("doc_3.txt", 4)]


def test_search_has_no_stopword_filter(corpus):
    rows = TX.search_word(corpus, "the").collect()
    assert [(r.doc_id, r.score) for r in rows] == [("doc_4.txt", 2)]


def test_search_terms_validated():
    assert normalise_terms([" Twenty", "twenty", "YEARS"]) == ["twenty", "years"]
    for bad in (["café"], ["two words"], [""], ["don't"], []):
        with pytest.raises(ValueError):
            normalise_terms(bad)


def test_replication_metamorphic(spark, corpus):
    n = 3
    rep = corpus.select("*", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("c")).drop("c")
    df1 = {r.word: r.doc_count for r in TX.doc_frequency_all(corpus).collect()}
    dfn = {r.word: r.doc_count for r in TX.doc_frequency_all(rep).collect()}
    assert df1 == dfn
    s1 = {(r.doc_id, r.titulo): r.score for r in TX.search_all_words(corpus, ["years"]).collect()}
    sn = {(r.doc_id, r.titulo): r.score for r in TX.search_all_words(rep, ["years"]).collect()}
    assert {k: v * n for k, v in s1.items()} == sn
    assert (TX.vocabulary_size(corpus, "content").first()[0]
            == TX.vocabulary_size(rep, "content").first()[0])
    i1 = sorted(map(tuple, TX.inverted_index(corpus, k=5, layout="single").collect()))
    i_n = sorted(map(tuple, TX.inverted_index(rep, k=5, layout="single").collect()))
    assert i1 == i_n
    w1 = {r.word: r.total for r in TX.word_counts(corpus, "content").collect()}
    wn = {r.word: r.total for r in TX.word_counts(rep, "content").collect()}
    assert {k: v * n for k, v in w1.items()} == wn


def test_and_search_is_intersection_of_single_searches(corpus):
    terms = ["twenty", "years"]
    both = {(r.doc_id, r.titulo): r.score
            for r in TX.search_all_words(corpus, terms, k=100).collect()}
    singles = [{(r.doc_id, r.titulo): r.score
                for r in TX.search_word(corpus, t, k=100).collect()} for t in terms]
    keys = set(singles[0]) & set(singles[1])
    assert set(both) == keys
    assert all(both[k] == singles[0][k] + singles[1][k] for k in keys)


def test_postings_rows(corpus):
    rows = {(r.word, r.doc_id): r.tf for r in TX.postings(corpus).collect()}
    assert rows[("twenty", "doc_2.txt")] == 2
    assert rows[("twenty", "doc_1.txt")] == 2      # same id twice in the corpus
    assert rows[("adventure", "doc_4.txt")] == 3


def _random_corpus(spark, seed, n=60):
    import random
    rnd = random.Random(seed)
    vocab = ["red", "blue", "widget", "gear", "the", "of"]
    rows = []
    for _ in range(n):
        doc = rnd.choice([None] + [f"d{i}" for i in range(12)])
        text = " ".join(rnd.choice(vocab) for _ in range(rnd.randint(1, 6)))
        rows.extend([(doc, text)] * rnd.choice([1, 1, 2]))
    return spark.createDataFrame(rows, "doc_id string, content string")


def _searched(rows, terms, k):
    """Search by the rule: score per (id, text), ranked with ties by id, text."""
    import re
    score = {}
    for doc, text in rows:
        found = [t for t in re.split("[^a-z]+", text.lower()) if t in terms]
        if set(found) == set(terms):
            score[doc, text] = score.get((doc, text), 0) + len(found)
    order = sorted(score.items(), key=lambda x: (-x[1], x[0][0] is None, x[0][0] or "", x[0][1]))
    return [(d, t, n) for (d, t), n in order[:k]]


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_search_equals_the_rule(spark, seed):
    corpus = _random_corpus(spark, seed)
    rows = [tuple(r) for r in corpus.collect()]
    for terms in (["red"], ["red", "widget"], ["the"]):
        for k in (1, 3, 10):
            got = [tuple(r) for r in TX.search_all_words(corpus, terms, k).collect()]
            assert got == _searched(rows, terms, k), (terms, k)


def test_search_with_thousands_of_ties(spark):
    # NULL ids and one id with thousands of texts, all with the same score
    for doc in (None, "one"):
        rows = [(doc, f"red t{i:04d}") for i in range(3000)] + [("a", "red red")]
        df = spark.createDataFrame(rows, "doc_id string, content string")
        got = [tuple(r) for r in TX.search_word(df, "red", k=10).collect()]
        assert got == [("a", "red red", 2)] + [(doc, f"red t{i:04d}", 1) for i in range(9)]


def test_building_a_plan_starts_no_job(spark, corpus):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy-check", "plans only")
    try:
        TX.doc_frequency(corpus), TX.inverted_index(corpus), TX.postings(corpus)
        TX.search_word(corpus, "adventure"), TX.search_all_words(corpus, ["twenty", "years"])
        assert list(tracker.getJobIdsForGroup("lazy-check")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_text_scans_of_a_search(spark, tmp_path):
    from tessera.sources.text import read_tsv_corpus, write_tsv_corpus
    df = spark.createDataFrame([(f"d{i}", "red blue") for i in range(50)], "doc_id string, content string")
    path = write_tsv_corpus(df, "doc_id", "content", str(tmp_path / "c"))
    out = TX.search_word(read_tsv_corpus(spark, path), "red")
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan text") == 2      # one to score, one for the text of the top k
    assert "[^a-z]+" not in plan


def test_inverted_index_reuses_the_pairs_exchange(spark):
    # the pair exchange is built once, read twice
    df = spark.createDataFrame([(i % 20, "alpha beta gamma") for i in range(50)],
                               "doc_id bigint, content string")
    out = TX.inverted_index(df, k=2)
    out.collect()
    assert "ReusedExchange" in out._jdf.queryExecution().executedPlan().toString()


def test_index_blocks_of_sparse_and_smallest_ids(spark):
    ids = [(i * 0x9E3779B97F4A7C15) % (1 << 63) for i in range(1, 2000)] + [-(1 << 63)]
    df = spark.createDataFrame([(i, "alpha") for i in ids], "doc_id bigint, content string")
    rows = TX.inverted_index(df, k=1, block_size=1000).collect()
    assert len(rows) <= 4 and all(len(r.doc_list.split(",")) <= 1000 for r in rows)
    assert sorted(int(x) for r in rows for x in r.doc_list.split(",")) == sorted(ids)


def test_stopwords_as_table_equal_list(spark, corpus):
    from tessera.functions.text import STOPWORDS
    table = spark.createDataFrame([(w,) for w in STOPWORDS], "w string")
    a = sorted(map(tuple, TX.doc_frequency_all(corpus).collect()))
    b = sorted(map(tuple, TX.doc_frequency_all(corpus, stopwords=table).collect()))
    assert a == b
    custom = spark.createDataFrame([("twenty",), ("years",)], "w string")
    got = {r.word for r in TX.doc_frequency_all(corpus, stopwords=custom).collect()}
    assert "twenty" not in got and "years" not in got and "the" in got


def test_null_ids_are_not_documents(spark):
    df = spark.createDataFrame([(None, "alpha beta"), (None, "alpha"), ("d1", "alpha"),
                                ("d2", "gamma")], "doc_id string, content string")
    got = {r.word: r.doc_count for r in TX.doc_frequency_all(df, stopwords=None).collect()}
    assert got == {"alpha": 1, "beta": 0, "gamma": 1}
    single = {r.word: (r.doc_count, r.doc_list) for r in
              TX.inverted_index(df, k=3, stopwords=None, layout="single").collect()}
    assert single == {"alpha": (1, "d1"), "gamma": (1, "d2"), "beta": (0, "")}
    blocks = [tuple(r) for r in TX.inverted_index(df, k=3, stopwords=None).collect()]
    assert all(r[3] != "" for r in blocks) and len(blocks) == 2


def test_a_hot_group_of_copies(spark):
    # a third of all rows are copies of one document; the other ids are unique
    rows = [(f"d{i}", f"alpha w{i % 7} beta{i % 3}") for i in range(60)]
    rows += [("hot", "alpha gamma delta")] * 30 + [(None, "alpha zeta")] * 3
    df = spark.createDataFrame(rows, "doc_id string, content string")
    counts = dict(map(tuple, TX.doc_frequency_all(df, stopwords=None).collect()))
    assert counts["alpha"] == 61 and counts["gamma"] == 1 and counts["zeta"] == 0
    blocks = [r for r in TX.inverted_index(df, k=6, stopwords=None, block_size=8).collect()
              if r.word == "alpha"]
    listed = [x for r in blocks for x in r.doc_list.split(",")]
    assert sorted(listed) == sorted({d for d, _ in rows if d}) and all(
        len(r.doc_list.split(",")) <= 8 for r in blocks)


def test_postings_group_rows_of_one_id(spark, corpus):
    uniq = spark.createDataFrame(
        [(f"d{i}", t) for i, (_, t) in enumerate(CORPUS)] + [("e", ""), ("f", None),
                                                           (None, "red red"), (None, "red")],
        "doc_id string, content string")
    rows = {(r.word, r.doc_id): r.tf for r in TX.postings(uniq).collect()}
    assert rows[("red", None)] == 3 and rows[("adventure", "d4")] == 2
