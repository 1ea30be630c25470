"""Subword classifier: held-out results, misspellings, edge cases."""
import random

from pyspark.sql import functions as F

from tessera.llm import toxicity as X


def corpus(n, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgimnorstu") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    bad = ["wretched", "dimwitted", "loathsome", "blockhead"]
    texts, labels = [], []
    for i in range(n):
        w = [rng.choice(words) for _ in range(rng.randint(5, 200))]
        if i % 5 == 0:
            for _ in range(rng.randint(1, 3)):
                w.insert(rng.randrange(len(w)), rng.choice(bad))
        texts.append(" ".join(w))
        labels.append(int(i % 5 == 0))
    return texts, labels


def test_held_out_and_unseen_misspellings():
    texts, labels = corpus(600, 1)
    model = X.train(texts[:400], labels[:400])
    got = [model.score(t) >= X.TOXIC_FROM for t in texts[400:]]
    hits = sum(g and y for g, y in zip(got, labels[400:]))
    wrong = sum(g and not y for g, y in zip(got, labels[400:]))
    assert hits >= 0.9 * sum(labels[400:]) and wrong <= 2
    plain = model.score("a quiet text about nothing")
    for misspelt in ("wretchedd", "loathsomme", "dimwited", "blockheads"):
        assert model.score(f"you {misspelt} one") > plain


def test_one_passage_in_a_long_text_counts():
    texts, labels = corpus(400, 1)
    model = X.train(texts, labels)
    long = " ".join(texts[1::5][:60])
    assert model.score(long) < X.TOXIC_FROM <= model.score(long + " wretched loathsome " + long)


def test_table_and_edges(spark, docs_of):
    texts, labels = corpus(300, 2)
    docs = docs_of([(i, t) for i, t in enumerate(texts)] + [(None, "loathsome"), (900, None), (901, ""), (902, "x" * 100_000), (0, texts[0])])
    rows = [(i, y, y) for i, y in enumerate(labels)] + [(None, 1, 1), (5, None, None), (0, 0, 0)]
    table = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    out = X.toxicity_scores(docs.withColumn("predicted", F.lit("clash")), table).collect()
    assert len(out) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)
    by = {r.doc_id: r for r in out}
    assert by[900].score == by[901].score and by[None].held_out is False
    again = {r.doc_id: r.score for r in X.toxicity_scores(docs, table).collect()}
    assert all(again[r.doc_id] == r.score for r in out)
    none = X.toxicity_scores(docs, table.filter("toxic = 0"))
    assert {r.predicted for r in none.collect()} == {0}
    assert X.toxicity_scores(docs_of([]), table).count() == 0


def test_labels_of_held_out_rows_are_not_read(spark, docs_of):
    from tessera.llm.common import learnable
    docs = docs_of([(i, f"text {i}") for i in range(200)])
    table = spark.createDataFrame([(i, 1, i % 2) for i in range(200)], "doc_id long, quality int, toxic int")
    texts, _ = X.labelled_sample(docs, table, learnable(F.col("i")), max_toxic=40, max_clean=50)
    import zlib
    ids = [int(t.split()[1]) for t in texts]
    assert len(ids) == 90 and all(zlib.crc32(str(i).encode()) % 3 != 1 for i in ids)


def test_a_passage_whose_words_occur_earlier_counts():
    texts, labels = corpus(400, 1)
    model = X.train(texts, labels)
    long = " ".join(texts[1::5][:60])
    apart = long + " wretched " + long + " loathsome " + long
    assert X.words_of("A b, a b") == ["a", "b", "a", "b"]
    # the two words stand apart, each beside others, before they stand together
    alone = max(model.score(long + " wretched " + long), model.score(long + " loathsome " + long))
    assert model.score(apart) <= alone + 1e-9
    assert model.score(apart + " wretched loathsome " + long) >= model.score("wretched loathsome") - 1e-9 >= X.TOXIC_FROM
    # words that were never adjacent make no window
    assert model.score("wretched of the of loathsome") < model.score("wretched loathsome")


def test_many_texts_score_as_one_by_one():
    texts, labels = corpus(200, 4)
    model = X.train(texts, labels, steps=25)
    odd = [None, "", " ... ", "... loathsome ,", "x" * 300 + " dimwitted", "\ud800 é ΣΑΣ İx wretched", "blockhead"]
    assert model.scores(odd + texts) == [model.score(t) for t in odd + texts]
    again = X.train(texts, labels, steps=25)
    assert again.scores(texts + odd) == model.scores(texts + odd)
    # a word's logit is the mean over its own n-grams, beside words of other sizes or alone
    words = ["a", "loathsome", "é" * 70, "dimwitted", "b"]
    flat, sizes = X.subwords(words)
    assert [len(X.subwords([w])[0]) for w in words] == list(sizes)
    assert list(flat) == [b for w in words for b in X.subwords([w])[0]]


def test_ngrams_have_the_hashes_of_the_library():
    import xxhash
    rng = random.Random(9)
    alphabets = ["abcdefghij", "aéß", "щюя", "日本語", "a\U0001F600é", "\ud800a"]
    words = ["", "a", "é"] + ["".join(rng.choice(a) for _ in range(rng.randrange(12))) for a in alphabets for _ in range(60)]
    flat, sizes = X.subwords(words)
    want = []
    for word in words:
        w = f"<{word}>"
        grams = [w] + [w[i:i + n] for n in X.GRAM_SIZES for i in range(len(w) - n + 1)]
        want += [xxhash.xxh3_64_intdigest(g.encode("utf-8", "surrogatepass")) % X.BUCKETS for g in grams]
    assert flat.tolist() == want and sizes.sum() == len(want)


def test_training_holds_few_bytes_for_each_ngram():
    import tracemalloc
    rng = random.Random(7)
    texts = [" ".join("".join(rng.choice("abcdefgimnorstu") for _ in range(10)) for _ in range(100)) for _ in range(300)]
    n_grams = sum(4 * 12 - 13 for t in texts for _ in t.split())
    tracemalloc.start()
    try:
        X.train(texts, [i % 2 for i in range(len(texts))], steps=2)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 55 * n_grams, peak / n_grams
