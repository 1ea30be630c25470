"""Text analytics over a lines table or a ``(doc_id, content)`` corpus.

Plans, and why they hold at scale:

* Word counts are a map-side partially aggregated ``groupBy(word)``; a hot
  word costs one partial row per task, not one row per occurrence.
* Document frequency makes (word, doc_id) pairs distinct, first inside each
  row, then in each task, then once over the shuffle; the count per word is
  partially aggregated.  The same plan serves unique, repeated and NULL ids.
* The inverted index never gathers a whole postings list in one task: the
  top-k words are chosen from document frequencies first, and their postings
  are cut into blocks of bounded size.
* Searches count the terms in each row (no tokens and no arrays are made) after
  a substring test.  Keys and scores of matching rows are aggregated without
  their text; the ids of the top k then meet a second scan, and only their rows
  are counted again with the text.  Every top-k has a tie-breaker so results are
  deterministic.  ``operators.index`` stores the postings, for many searches.

Nothing here runs a job or looks at sizes while a plan is built.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import (
    STOPWORDS, is_word, may_contain_all, normalise_terms, not_stopword, term_count,
    token_array, tokens)

DEFAULT_BLOCK_SIZE = 1000


def tokenize(df: DataFrame, text: str = "line", keep: Iterable[str] = (),
             word: str = "word") -> DataFrame:
    """``LATERAL VIEW EXPLODE(SPLIT(LOWER(text), '[^a-z]+'))``: raw tokens."""
    return df.select(*keep, tokens(text).alias(word))


def words(df: DataFrame, text: str = "line", keep: Iterable[str] = (),
          stopwords: Iterable[str] | DataFrame | None = None,
          distinct_per_row: bool = False) -> DataFrame:
    """Tokens kept by the word rule (``length > 1``), optionally minus stopwords."""
    arr = token_array(text)
    if distinct_per_row:
        arr = F.array_distinct(arr)
    out = df.select(*keep, F.explode(arr).alias("word")).where(is_word("word"))
    return remove_stopwords(out, stopwords)


def remove_stopwords(df: DataFrame, stopwords: Iterable[str] | DataFrame | None,
                     word: str = "word") -> DataFrame:
    """Drop rows whose ``word`` is a stopword.

    A list becomes ``word NOT IN (...)`` (an in-memory hash set in every
    task).  A DataFrame of stopwords (first column) is a left anti join, which
    Spark broadcasts if the table is small enough.
    """
    if stopwords is None:
        return df
    if isinstance(stopwords, DataFrame):
        sw = stopwords.select(F.col(stopwords.columns[0]).alias("__stop")).distinct()
        return df.join(sw, F.col(word) == F.col("__stop"), "left_anti")
    return df.where(not_stopword(word, stopwords))


def word_counts(lines: DataFrame, text: str = "line") -> DataFrame:
    """``(word, total)`` for every word."""
    return words(lines, text).groupBy("word").agg(F.count(F.lit(1)).alias("total"))


def word_count_top(lines: DataFrame, text: str = "line", k: int = 10) -> DataFrame:
    """The ``k`` most frequent words: ``(word, total)``, ties by word."""
    return (word_counts(lines, text)
            .orderBy(F.desc("total"), F.asc("word")).limit(k))


def vocabulary_size(lines: DataFrame, text: str = "line") -> DataFrame:
    """Exact number of distinct words: ``(palabras_unicas)``."""
    return words(lines, text, distinct_per_row=True).agg(
        F.countDistinct("word").alias("palabras_unicas"))


def doc_words(corpus: DataFrame, doc_id: str = "doc_id", content: str = "content",
              stopwords: Iterable[str] | DataFrame | None = STOPWORDS) -> DataFrame:
    """``(word, doc_id)``: every pair once."""
    return words(corpus, content, keep=[doc_id], stopwords=stopwords,
                 distinct_per_row=True).select("word", doc_id).distinct()


def doc_frequency_all(corpus: DataFrame, doc_id: str = "doc_id",
                      content: str = "content",
                      stopwords: Iterable[str] | DataFrame | None = STOPWORDS) -> DataFrame:
    """``(word, doc_count)`` for every word: distinct documents containing it.

    ``COUNT(DISTINCT doc_id)`` semantics: NULL ids are not counted (a word
    seen only under NULL ids has ``doc_count`` 0).
    """
    return (doc_words(corpus, doc_id, content, stopwords)
            .groupBy("word").agg(F.count(doc_id).alias("doc_count")))


def doc_frequency(corpus: DataFrame, k: int = 20, doc_id: str = "doc_id",
                  content: str = "content",
                  stopwords: Iterable[str] | DataFrame | None = STOPWORDS) -> DataFrame:
    """Top ``k`` words by document frequency, stopwords removed."""
    return (doc_frequency_all(corpus, doc_id, content, stopwords)
            .orderBy(F.desc("doc_count"), F.asc("word")).limit(k))


def postings(corpus: DataFrame, doc_id: str = "doc_id", content: str = "content",
             stopwords: Iterable[str] | DataFrame | None = STOPWORDS) -> DataFrame:
    """The full index as rows: ``(word, doc_id, tf)``.

    One aggregation on (word, doc_id), combined in each task first and spread
    over as many tasks as there are pairs; NULL ids group together.
    """
    return (words(corpus, content, keep=[doc_id], stopwords=stopwords)
            .groupBy("word", doc_id).agg(F.count(F.lit(1)).alias("tf")))


def inverted_index(corpus: DataFrame, k: int = 20, doc_id: str = "doc_id",
                   content: str = "content",
                   stopwords: Iterable[str] | DataFrame | None = STOPWORDS,
                   block_size: int = DEFAULT_BLOCK_SIZE,
                   layout: str = "blocks") -> DataFrame:
    """Postings of the top ``k`` words by document frequency.

    ``layout="blocks"`` (default) returns ``(word, doc_count, block,
    doc_list)``: each row lists, comma-joined and sorted, at most
    ``block_size`` ids of one word.  Ids of any type are dealt by the MD5 of
    their text into buckets of about ``block_size`` ids, each cut into sorted
    slices (block = bucket * 2^20 + slice); NULL ids are in no block.  No row
    and no task holds a whole postings list.

    ``layout="single"`` returns one ``(word, doc_count, doc_list)`` row per
    word, the whole list in one value; its size grows with the corpus, so use
    it only where a word's postings fit in one task.
    """
    if layout not in ("blocks", "single"):
        raise ValueError(f"unknown layout {layout!r}")
    pairs = doc_words(corpus, doc_id, content, stopwords)
    if layout == "blocks":
        pairs = pairs.where(F.col(doc_id).isNotNull())
    counts = pairs.groupBy("word").agg(F.count(doc_id).alias("doc_count"))
    top = counts.orderBy(F.desc("doc_count"), F.asc("word")).limit(k)
    sel = pairs.join(top, "word")
    if layout == "single":
        return (sel.groupBy("word", "doc_count")
                .agg(F.array_join(F.array_sort(F.collect_set(doc_id)).cast("array<string>"),
                                  ",").alias("doc_list")))
    n_blocks = F.greatest(F.lit(1), F.ceil(F.col("doc_count") / F.lit(block_size)))
    digest = F.md5(F.col(doc_id).cast("string").cast("binary"))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % n_blocks
    lists = (sel.withColumn("block", bucket).groupBy("word", "doc_count", "block")
             .agg(F.array_sort(F.collect_set(doc_id)).cast("array<string>").alias("ids")))
    n = F.ceil(F.size("ids") / F.lit(block_size)).cast("int")
    slices = F.transform(F.sequence(F.lit(0), n - 1),
                         lambda i: F.slice("ids", i * block_size + 1, block_size))
    return (lists.select("word", "doc_count", "block",
                         F.posexplode(slices).alias("part", "chunk"))
            .select("word", "doc_count",
                    (F.col("block") * F.lit(1 << 20) + F.col("part")).alias("block"),
                    F.array_join("chunk", ",").alias("doc_list")))


def search_word(corpus: DataFrame, word: str, k: int = 10, doc_id: str = "doc_id",
                content: str = "content") -> DataFrame:
    """Documents containing ``word``, scored by its term frequency.

    Output ``(doc_id, titulo, score)``; the group is (doc_id, content), so a
    replicated row adds its count again.  No stopword or length filter.
    """
    return search_all_words(corpus, [word], k, doc_id, content)


def _scored(rows: DataFrame, keys: list, ts: list[str], content: str) -> DataFrame:
    """Groups of ``rows`` that hold every term, with the summed ``score``.

    The terms are counted in the aggregate's input and tested on its output: a
    group's rows have the same text, so each term is counted once per row.
    """
    counts = [f"_c{i}" for i in range(len(ts))]
    groups = rows.groupBy(*keys).agg(*[F.sum(term_count(content, t)).alias(c) for t, c in zip(ts, counts)])
    score = F.expr(" + ".join(counts)).cast("bigint")
    return groups.where(" AND ".join(f"{c} > 0" for c in counts)).withColumn("score", score).drop(*counts)


def search_all_words(corpus: DataFrame, terms: Iterable[str], k: int = 10,
                     doc_id: str = "doc_id", content: str = "content") -> DataFrame:
    """Documents containing every term (AND), scored by summed frequencies.

    A group (doc_id, content) always has identical text in all its rows, so
    "all terms present" holds for all of them or none.

    1. Rows that pass a substring test are counted and aggregated on (doc_id,
       two hashes and the length of the text): a few bytes per row cross the
       shuffle, no text.
    2. The top k of those groups by (score, doc_id) name at most k ids.  Any
       group of the true top k has one of them, as groups that tie on (score,
       doc_id) share the id.
    3. The rows of these ids are counted again, grouped on (doc_id, content)
       and ranked; this is exact for ids with many texts, too.  The ids meet the
       scan before anything is counted, so no other text is looked through.
    """
    ts = normalise_terms(terms)
    corpus = corpus.select(doc_id, content)
    text = F.col(content)
    keyed = _scored(corpus.where(may_contain_all(content, ts)),
                    [F.col(doc_id), F.xxhash64(text).alias("_h1"), F.hash(text).alias("_h2"), F.length(text).alias("_len")],
                    ts, content)
    best = (F.desc("score"), F.asc_nulls_last(doc_id))
    ids = keyed.orderBy(*best).limit(k).select(F.col(doc_id).alias("_id"))
    groups = _scored(rows_of_ids(corpus, ids, doc_id), [doc_id, content], ts, content)
    return (groups.select(doc_id, F.col(content).alias("titulo"), "score")
            .orderBy(*best, F.asc_nulls_last("titulo")).limit(k))


def rows_of_ids(corpus: DataFrame, ids: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Rows of ``corpus`` whose id (NULL included) is one of ``ids`` (column ``_id``)."""
    return corpus.join(ids, F.col(doc_id).eqNullSafe(F.col("_id")), "left_semi")
