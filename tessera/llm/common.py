"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import fresh_dir

# The six white-space characters that separate words.
WORD = r"[^\x20\x09-\x0D]+"
# A-Z to a-z for byte strings; no other byte changes.
LOWER_AZ = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
HELD_OUT_REMAINDER = 1
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def land(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back.

    Cuts the lineage, so a lost executor costs the re-run of the stages that
    follow, and a table used twice is computed once.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def prepare_python(spark: SparkSession, rows: int = 256) -> None:
    """Settings for operators that run Python in tasks.

    Arrow batches of whole texts hold ``rows`` rows instead of the default
    10,000, which is what fills a worker's memory; a value that the deployment
    set itself is left alone.  Workers on this machine also find this package
    when it is not installed; on a cluster, install it or pass --py-files.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, "10000") == "10000":
        spark.conf.set(key, str(rows))
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of ``df`` has, each with more underscores in front."""
    taken = {c.lower() for c in df.columns}
    return [next(n for n in ("_" * k + name for k in range(len(taken) + 1)) if n.lower() not in taken) for name in names]


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """crc32(doc_id as text) mod 3 is 1; false for a NULL id."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string")) % 3 == HELD_OUT_REMAINDER, F.lit(False))


def learnable(doc_id: str | Column = "doc_id") -> Column:
    """Rows that a model may learn from: a known id that is not held out."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return c.isNotNull() & ~held_out(c)


def unit_hash(*cols: str | Column) -> Column:
    """A value in [0, 1) that depends on the given columns only."""
    return (F.xxhash64(*cols).bitwiseAND(F.lit((1 << 53) - 1))) / F.lit(float(1 << 53))
