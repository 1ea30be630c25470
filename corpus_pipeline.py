"""Corpus pipeline: documents in, a weighted and tokenised training mix out.

Five stages, each over all that the one before kept; each is written as Parquet
and read again.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tessera.llm import bpe, catalog, langid, mixing, ngram_join, toxicity
from tessera.llm.common import land, learnable

#: Documents whose n-grams the predicted language covers less than this are
#: in no learned language.
MIN_COVERAGE = 0.2
#: Five-word shingles, Jaccard of at least 0.8.
NEAR = ngram_join.Rule(width=5, num=80, den=100)


def _free(docs: DataFrame, *names: str) -> tuple[str, ...]:
    """Names like these that no column of ``docs`` has."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return tuple(out)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a language that the corpus is labelled with."""
    names = _free(docs, "lang_pred", "lang_score", "lang_coverage")
    found = langid.identify(docs, langid.fit(docs, may_learn=learnable("doc_id")), names=names)
    known = (F.col(names[0]) != langid.UNKNOWN) & (F.col(names[2]) >= MIN_COVERAGE)
    return found.filter(known).select(*[F.col(f"`{c}`") for c in docs.columns])


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that the classifier does not predict to be toxic."""
    names = _free(docs, "toxic_score", "toxic_predicted")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.score(docs, toxicity.fit(docs, labels), names=names)
    return scored.filter(F.col(names[1]) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates: that of the smallest id.

    Documents without words are kept.  Rows that agree in id and text are near
    duplicates of each other, too.
    """
    groups = land(ngram_join.join_components(docs, NEAR).filter("n_shingles > 0"), "near-groups")
    many = groups.groupBy("component").agg(
        F.count("*").alias("c"), F.min(F.struct("row", "text_hash")).alias("first")).filter("c > 1")
    decided = (groups.join(many, "component")
               .groupBy("row", "text_hash")
               .agg(F.first(F.struct("row", "text_hash") == F.col("first")).alias("stays")))
    row, text_hash, stays, turn = _free(docs, "row", "text_hash", "stays", "turn")
    decided = decided.select(F.col("row").alias(row), F.col("text_hash").alias(text_hash), F.col("stays").alias(stays))
    keyed = (docs.withColumn(text_hash, F.xxhash64("text"))
             .withColumn(row, F.coalesce(F.col("doc_id").cast("long"), F.col(text_hash))))
    placed = keyed.join(decided, [row, text_hash], "left").withColumn(turn, F.row_number().over(
        Window.partitionBy(row, text_hash).orderBy(F.lit(1))))
    return (placed.filter(F.col(stays).isNull() | (F.col(stays) & (F.col(turn) == 1)))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources at their target weights: a row for each copy taken."""
    return mixing.mixed_corpus(docs)


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and the token ids of each row."""
    tokenizer = catalog.tokenizer().learn_dictionary(docs)
    rows = bpe.encoded(docs.select("doc_id", "lang", "source", "text"), tokenizer).drop("text")
    return rows.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language ID", language),
    ("toxicity", not_toxic),
    ("n-gram Jaccard join", one_of_each),
    ("mixing sources to target weights", mixed),
    ("byte-level BPE encoding and decoding", tokenised),
]
#: Language, toxicity and the tokenizer are no SQL; tests hold the stages
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; lineage is cut after each."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = land(stage(spark, docs, sf_dir), f"stage-{name.split()[0].lower()}")
    return docs
