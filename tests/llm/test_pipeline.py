"""The pipeline's stages over one small corpus, and the registered queries' SQL."""
import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tessera.llm.common import learnable

SF = "/root/testdata/sf0.001"


def test_stages_keep_their_contract(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    seen = [docs.count()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        after = corpus_pipeline.land(stage(spark, docs, SF), "test-stage")
        if k < 4:
            assert after.columns == docs.columns
        if k == 0:
            assert after.count() == docs.count()                       # all are in a learned language
        if k == 1:
            gone = {r.doc_id for r in docs.join(after, "doc_id", "left_anti").collect()}
            # six toxic documents to learn from: a few clean ones may be lost
            clean = sum(1 for v in labels.values() if v == 0)
            assert sum(labels.get(i) == 0 for i in gone) <= 0.05 * clean
        if k == 2:
            texts = [r.text for r in after.collect()]
            assert len(set(texts)) == len(texts)
        docs = after
        seen.append(docs.count())
    assert docs.count() == docs.filter("n_tokens = size(ids)").count() > 0
    assert seen[1] >= seen[2] >= seen[3]


def test_near_duplicate_stage_with_repeats_and_nulls(spark, docs_of):
    words = " ".join(f"w{i}" for i in range(100))
    rows = [(5, words), (3, words + " x"), (9, words), (9, words), (7, "other words entirely here now"), (7, None), (8, None), (None, "a b"),
            (7, "second text with this id of seven")]
    docs = docs_of(rows).withColumn("row", F.col("doc_id")).withColumn("turn", F.col("text"))
    out = corpus_pipeline.one_of_each(spark, docs, SF)
    assert out.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == sorted(
        [(3, words + " x"), (7, "other words entirely here now"), (7, None), (8, None), (None, "a b"),
         (7, "second text with this id of seven")], key=repr)


def test_language_stage_rejects_what_is_in_no_learned_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = {-1: None, -2: "", -3: "12345 67890 ...", -4: " ".join(chr(0x10D0 + i % 33) * 7 for i in range(200)),
           -5: "\u12a0\u12ed\u12f0\u1208\u121d " * 50}
    rows = spark.createDataFrame(list(odd.items()), "doc_id long, text string").selectExpr(
        "doc_id", "text", "'en' AS lang", "'s' AS source", "0L AS n_chars")
    both = docs.unionByName(rows, allowMissingColumns=True)
    kept = {r.doc_id for r in corpus_pipeline.language(spark, both, SF).collect()}
    assert kept == {r.doc_id for r in docs.collect()}


def test_toxicity_stage_rejects_toxic_and_keeps_clean(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    kept = corpus_pipeline.not_toxic(spark, docs, sf).select("doc_id").distinct().withColumn("kept", F.lit(True))
    known = docs.select("doc_id").distinct().join(labels, "doc_id").join(kept, "doc_id", "left").collect()
    toxic = [r for r in known if r.toxic == 1]
    clean = [r for r in known if r.toxic == 0]
    assert sum(not r.kept for r in toxic) >= 0.8 * len(toxic) > 0
    # none that the model learned from; of the others, which have 33 toxic documents to be told by, two of 95
    learned = {r.doc_id for r in docs.filter(learnable("doc_id")).select("doc_id").collect()}
    lost = [r.doc_id for r in clean if not r.kept]
    assert not learned.intersection(lost) and len(lost) <= 2


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_stages_with_nulls_repeats_clashing_names_and_empty_tables(spark, docs_of, stage):
    english = " ".join("the quiet river runs past an old mill and its garden every morning".split()[i % 13] for i in range(60))
    rows = [(1, english, "en", "a"), (1, english, "en", "a"), (2, None, None, None), (None, "", None, "a"), (3, english + " end", None, None)]
    extra = {"score": "1", "predicted": "'p'", "row": "2", "turn": "'t'", "component": "3", "n_tokens": "4", "taken": "5", "lang_pred": "'x'"}
    docs = docs_of(rows).selectExpr("*", *[f"{v} AS {c}" for c, v in extra.items()])
    out = stage(spark, docs, SF)
    got = out.collect()
    if stage is not corpus_pipeline.tokenised:
        assert out.columns == docs.columns
        known = {(r.doc_id, r.text) for r in docs.collect()}
        assert {(r.doc_id, r.text) for r in got} <= known and any(r.text and r.text.startswith("the quiet") for r in got)
    else:
        assert sorted(r.n_tokens for r in got)[:2] == [0, 0] and len(got) == len(rows)
    assert stage(spark, docs.limit(0), SF).count() == 0


@pytest.mark.parametrize("name", ["op1_source_mix", "op2_ngram_join", "op3_token_counts", "op4_license_scan", "op7_chat_format"])
def test_sql_agrees(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(entry.oracle_sql()[name])
    got = entry.queries()[name](spark, SF)
    assert sorted(want.columns) == sorted(got.columns)

    def plain(row):
        return tuple(round(v, 6) if isinstance(v, float) else v for v in row)
    columns = sorted(want.columns)
    left = sorted((plain(r) for r in want.project(", ".join(columns)).fetchall()), key=repr)
    right = sorted((plain(tuple(r)) for r in got.select(*columns).collect()), key=repr)
    assert left == right
