"""Token counts as delta-maintained rollups.

A batch is a table of changes: (doc_id, tokenizer, op, source, lang, n_tokens),
``op`` one of insert, revise, delete.  Committing a batch writes its *images*
(the state of each changed document afterwards) and its *deltas*: signed sums of
documents and tokens by source, language and tokenizer version, computed from
the images before and after.  Totals are the sum of all deltas.  A commit scans the
images of all earlier batches and keeps those of the documents it changes.

Both tables are written below one folder per batch, the deltas last; Spark's
``_SUCCESS`` mark of the deltas is the commit.  A batch id that is committed is
left alone, a batch that was cut off is written again as a whole: replays and
retries change nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from tessera.llm.common import WORD, land
from tessera.session import fresh_dir

KEYS = ["source", "lang", "tokenizer"]
CHANGES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("tokenizer", T.StringType()),
    T.StructField("op", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("n_tokens", T.LongType())])
IMAGES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("tokenizer", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("n_tokens", T.LongType()), T.StructField("there", T.BooleanType())])
DELTAS = T.StructType([T.StructField(c, T.StringType()) for c in KEYS] + [
    T.StructField("docs", T.LongType()), T.StructField("tokens", T.LongType())])


class TokenRollup:
    """A rollup below ``folder``, a folder that all executors share."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = folder or fresh_dir(spark, "token-counts")

    def _path(self, table: str, batch: int) -> str:
        return f"{self.folder}/{table}/batch={batch:08d}"

    def _is_there(self, path: str) -> bool:
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def committed(self, batch: int) -> bool:
        return self._is_there(f"{self._path('deltas', batch)}/_SUCCESS")

    def batches(self) -> list[int]:
        """Committed batch numbers in order."""
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/deltas")
        fs = p.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(p):
            return []
        names = sorted(s.getPath().getName() for s in fs.listStatus(p))
        return [b for b in (int(n.split("=")[1]) for n in names) if self.committed(b)]

    def _read(self, table: str, schema: T.StructType, batches: list[int]) -> DataFrame:
        out = self.spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("batch", T.IntegerType(), False)]))
        for b in batches:
            out = out.unionByName(self.spark.read.schema(schema).parquet(self._path(table, b)).withColumn("batch", F.lit(b)))
        return out

    def commit(self, batch: int, changes: DataFrame) -> bool:
        """Apply one batch; False if it was committed before (nothing is done).

        A document changed more than once in a batch takes its largest
        (op, n_tokens, source, lang), with delete above revise above insert.
        Inserting what is there and revising or deleting what is not are the
        same as revising, inserting and nothing.  NULL counts are 0, an unknown
        or NULL ``op`` counts as insert; rows without a document id or a
        tokenizer are no changes.  Other columns are ignored.

        Batches are committed in the order of their numbers, gaps allowed: a
        number below the largest committed one would count its documents next
        to later images of them and raises ValueError.
        """
        if self.committed(batch):
            return False
        earlier = self.batches()
        if earlier and batch < earlier[-1]:
            raise ValueError(f"batch {batch} comes after batch {earlier[-1]}, which is committed")
        rank = F.when(F.col("op") == "delete", 2).when(F.col("op") == "revise", 1).otherwise(0)
        last = (changes.filter("doc_id IS NOT NULL AND tokenizer IS NOT NULL")
                .groupBy(F.col("doc_id").cast("long").alias("doc_id"), "tokenizer")
                .agg(F.max(F.struct(rank.alias("rank"), F.coalesce(F.col("n_tokens").cast("long"), F.lit(0)).alias("n_tokens"),
                                    "source", "lang")).alias("c")))
        after = last.select("doc_id", "tokenizer", "c.source", "c.lang",
                            F.when(F.col("c.rank") == 2, F.lit(0)).otherwise(F.col("c.n_tokens")).cast("long").alias("n_tokens"),
                            (F.col("c.rank") != 2).alias("there"))
        after.write.mode("overwrite").parquet(self._path("images", batch))
        after = self.spark.read.schema(IMAGES).parquet(self._path("images", batch))
        plus = after.filter("there").select(*KEYS, F.lit(1).alias("sign"), "n_tokens")
        if earlier:
            before = (self._read("images", IMAGES, earlier)
                      .join(after.select("doc_id", "tokenizer"), ["doc_id", "tokenizer"], "left_semi")
                      .groupBy("doc_id", "tokenizer")
                      .agg(F.max(F.struct("batch", "source", "lang", "n_tokens", "there")).alias("b"))
                      .filter("b.there"))
            plus = plus.unionByName(before.select(
                F.col("b.source").alias("source"), F.col("b.lang").alias("lang"), "tokenizer",
                F.lit(-1).alias("sign"), F.col("b.n_tokens").alias("n_tokens")))
        deltas = plus.groupBy(*KEYS).agg(F.sum("sign").cast("long").alias("docs"),
                                         F.sum(F.col("sign") * F.col("n_tokens")).cast("long").alias("tokens"))
        deltas.write.mode("overwrite").parquet(self._path("deltas", batch))
        return True

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, docs, tokens over all committed batches."""
        return (self._read("deltas", DELTAS, self.batches()).groupBy(*KEYS)
                .agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).filter("docs <> 0 OR tokens <> 0"))


def document_batches(docs: DataFrame) -> list[DataFrame]:
    """Five batches of changes that derive from a documents table.

    0: every document under ``words-1`` (its n_chars as a first estimate);
    1: the true word counts revise all of them; 2: letter runs under
    ``runs-2``; 3: documents of fewer than 20 words are deleted from both;
    4: they are inserted again, so the totals are over all documents.

    Every row is a document, also without an id or where ids repeat: its key is
    a hash of the id, the text and its number among the rows that agree in both.
    """
    counts = {"_words": F.regexp_count("text", F.lit(WORD)), "_runs": F.regexp_count("text", F.lit("[A-Za-z]+"))}
    base = docs.select("doc_id", "source", "lang", F.xxhash64("text", F.col("text").isNull()).alias("_hash"), "n_chars",
                       *[F.coalesce(c, F.lit(0)).cast("long").alias(name) for name, c in counts.items()])
    same = Window.partitionBy("doc_id", "_hash").orderBy("source", "lang", "n_chars")
    base = base.withColumn("_turn", F.row_number().over(same)).withColumn(
        "doc_id", F.xxhash64(F.col("doc_id").isNull(), "doc_id", "_hash", "_turn"))
    base = land(base.drop("_hash", "_turn"), "token-count-rows")
    words, runs = F.col("_words"), F.col("_runs")

    def changes(rows: DataFrame, op: str, tokenizer: str, n) -> DataFrame:
        return rows.select("doc_id", F.lit(tokenizer).alias("tokenizer"), F.lit(op).alias("op"), "source", "lang", n.alias("n_tokens"))

    short = base.filter(words < 20)
    none = F.lit(0).cast("long")
    return [changes(base, "insert", "words-1", F.col("n_chars")), changes(base, "revise", "words-1", words),
            changes(base, "insert", "runs-2", runs),
            changes(short, "delete", "words-1", none).unionByName(changes(short, "delete", "runs-2", none)),
            changes(short, "insert", "words-1", words).unionByName(changes(short, "insert", "runs-2", runs))]


def document_token_counts(docs: DataFrame) -> DataFrame:
    """Totals after the five batches, the second delivered twice."""
    rollup = TokenRollup(docs.sparkSession)
    batches = document_batches(docs)
    for number, changes in [*enumerate(batches), (1, batches[1])]:
        rollup.commit(number, changes)
    return rollup.totals()
