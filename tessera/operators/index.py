"""A stored inverted index: written once, searched without reading the texts.

The index is a catalog table of postings ``(word, doc_id, text identity, tf)``,
bucketed and sorted on ``slot``.  A word owns ``shards`` slots and its postings are
dealt over them by the document, so the postings of a word that is in every
document are many files and many tasks, and a rare word's are a few rows.  A
search filters on its terms' slots, which prunes the files to their buckets, and
joins the terms' postings on the document: shuffled are postings of the
terms, never texts.  The texts of the k best documents are read at the end.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import normalise_terms, token_array
from tessera.operators.text import rows_of_ids
from tessera.sources.tables import _drop, quoted

BUCKETS = 64
SHARDS = 8


def _identity(content: str) -> list[Column]:
    """What tells the texts of one id apart, in a few bytes."""
    text = F.col(content)
    return [F.xxhash64(text).alias("h1"), F.hash(text).alias("h2"), F.length(text).alias("len")]


def _word_slot(word: Column, shards: int) -> Column:
    """First slot of a word; a word's slots follow each other."""
    return F.xxhash64(word).bitwiseAND(F.lit((1 << 40) - 1)) * shards


def all_postings(corpus: DataFrame, doc_id: str = "doc_id", content: str = "content") -> DataFrame:
    """(word, doc_id, h1, h2, len, tf) of every token, stopwords and single letters too.

    A group (doc_id, content) is one document; the tf of its repeated rows add
    up, as in a search of the texts.  NULL texts have no postings.  The texts are
    shuffled by document, once; what they consist of is counted where they are.
    """
    document = ["doc_id", "h1", "h2", "len"]
    texts = corpus.select(F.col(doc_id).alias("doc_id"), *_identity(content), F.col(content).alias("_text")).repartition(*document)
    rows = texts.select(*document, F.explode(token_array("_text")).alias("word")).where(F.col("word") != "")
    return rows.groupBy(*document, "word").agg(F.count("*").alias("tf")).select("word", *document, "tf")


def write_index(corpus: DataFrame, table: str, location: str, doc_id: str = "doc_id", content: str = "content",
                buckets: int = BUCKETS, shards: int = SHARDS) -> DataFrame:
    """Write the corpus's postings as the external table ``table`` at ``location``.

    The postings, many times the size of the texts, are not shuffled: each task
    writes those of its documents, a sorted file for each bucket.  A word in a
    third of all documents is spread over ``shards`` slots.  ``shards`` is kept with
    the table; searches read it from there.
    """
    spark = corpus.sparkSession
    slot = _word_slot(F.col("word"), shards) + F.pmod(F.xxhash64("doc_id", "h1"), F.lit(shards))
    rows = all_postings(corpus, doc_id, content).withColumn("slot", slot)
    _drop(spark, table)
    (rows.write.mode("overwrite").format("parquet")
     .bucketBy(buckets, "slot").sortBy("slot", "word").option("path", location).saveAsTable(table))
    spark.sql(f"ALTER TABLE {quoted(table)} SET TBLPROPERTIES ('shards' = '{shards}')")
    return spark.table(table)


def index_shards(spark: SparkSession, table: str) -> int:
    return int(spark.sql(f"SHOW TBLPROPERTIES {quoted(table)}('shards')").first()["value"])


def postings_of(spark: SparkSession, table: str, terms: Iterable[str]) -> DataFrame:
    """The postings of some words; only the buckets of their slots are read."""
    ts = normalise_terms(terms)
    shards = index_shards(spark, table)
    slots = [_word_slot(F.lit(t), shards) + F.lit(s) for t in ts for s in range(shards)]
    return spark.table(table).where(F.col("slot").isin(*slots) & F.col("word").isin(*ts))


def search_index(spark: SparkSession, table: str, terms: Iterable[str], k: int = 10) -> DataFrame:
    """(doc_id, h1, h2, len, score) of the documents that hold every term.

    The term lists meet on the document: a document is in a list once, so it
    holds all terms if it meets as many postings as there are terms.  All
    documents that tie with the last of the k by (score, doc_id) are kept.
    """
    ts = normalise_terms(terms)
    found = (postings_of(spark, table, ts).groupBy("doc_id", "h1", "h2", "len")
             .agg(F.count("*").alias("n"), F.sum("tf").alias("score")).where(F.col("n") == len(ts)).drop("n"))
    best = found.orderBy(F.desc("score"), F.asc_nulls_last("doc_id")).limit(k).select("doc_id").distinct()
    return rows_of_ids(found, best.withColumnRenamed("doc_id", "_id"))


def search_with_texts(spark: SparkSession, table: str, corpus: DataFrame, terms: Iterable[str], k: int = 10,
                      doc_id: str = "doc_id", content: str = "content") -> DataFrame:
    """``operators.text.search_all_words`` answered from the index: (doc_id, titulo, score).

    ``corpus`` is read for the ids of the best documents only, to show their texts.
    """
    found = search_index(spark, table, terms, k)
    rows = rows_of_ids(corpus, found.select(F.col("doc_id").alias("_id")).distinct(), doc_id)
    texts = rows.select(F.col(doc_id).alias("_id"), F.col(content).alias("titulo"), *_identity(content)).distinct()
    shown = found.join(texts, F.col("doc_id").eqNullSafe(F.col("_id")) & (found.h1 == texts.h1) & (found.h2 == texts.h2)
                       & (found.len == texts.len))
    return (shown.select(F.col("doc_id").alias(doc_id), "titulo", "score")
            .orderBy(F.desc("score"), F.asc_nulls_last(doc_id), F.asc_nulls_last("titulo")).limit(k))
