"""Text sources and sinks: line files and tab-separated corpora.

Both readers take a directory (every file in it counts) or a file, like an
external table LOCATION.  They are plain ``spark.read.text`` scans, so input
is split across tasks by ``spark.sql.files.maxPartitionBytes``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Hive's default marker for NULL in text tables.
HIVE_NULL = "\\N"


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line: ``(line STRING)``."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def read_lines_positioned(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(line, _file, _start, _pos)``: lines with their place in the input.

    Ordering by ``(_file, _start, _pos)`` is file order (file, split, line
    within split); it feeds ``operators.corpus.number_segments`` without a
    sort of the data.
    """
    return (spark.read.text(path)
            .select(F.col("value").alias("line"),
                    F.col("_metadata.file_path").alias("_file"),
                    F.col("_metadata.file_block_start").alias("_start"),
                    F.monotonically_increasing_id().alias("_pos")))


def split_tsv(value: Column, map_null_marker: bool = False) -> tuple[Column, Column]:
    """First two tab-separated fields of a line, delimited-text style.

    No quoting; a missing field is NULL, an empty field stays ``''``; fields
    past the second are ignored.  ``F.get`` returns NULL out of range (plain
    indexing would raise under ANSI mode).
    """
    parts = F.split(value, "\t", -1)
    doc_id, content = F.get(parts, 0), F.get(parts, 1)
    if map_null_marker:
        doc_id = F.when(doc_id == HIVE_NULL, None).otherwise(doc_id)
        content = F.when(content == HIVE_NULL, None).otherwise(content)
    return doc_id, content


def read_tsv_corpus(spark: SparkSession, path: str | list[str],
                    map_null_marker: bool = False) -> DataFrame:
    """``(doc_id STRING, content STRING)`` from ``doc_id<TAB>content`` lines.

    Read as text and split (the CSV reader would turn ``''`` into NULL and
    skip blank lines).  ``\\N`` stays literal unless ``map_null_marker``.
    """
    doc_id, content = split_tsv(F.col("value"), map_null_marker)
    return spark.read.text(path).select(doc_id.alias("doc_id"), content.alias("content"))


def write_lines(df: DataFrame, line: str | Column, path: str,
                mode: str = "overwrite") -> str:
    """Write one text line per row (the sink for generated text)."""
    c = F.col(line) if isinstance(line, str) else line
    df.select(c.cast("string").alias("value")).write.mode(mode).text(path)
    return path


def write_tsv_corpus(df: DataFrame, doc_id: str, content: str, path: str,
                     mode: str = "overwrite") -> str:
    """Write ``doc_id<TAB>content`` lines (corpus and doc-map sinks).

    NULL is written as ``\\N`` (what a delimited-text table writes), so a
    reader with ``map_null_marker=True`` gets it back as NULL.  An id or text
    with a line end, or an id with a tab, has no place in the format: the
    write fails instead of writing rows that read back as others.
    """
    def checked(name: str, bad: str) -> Column:
        c = F.col(name).cast("string")
        return F.when(c.rlike(bad), F.raise_error(F.concat(
            F.lit(f"{name} holds a character that separates fields or rows: "), c))).otherwise(c)

    line = F.concat_ws("\t",
                       F.coalesce(checked(doc_id, "[\\t\\n\\r]"), F.lit(HIVE_NULL)),
                       F.coalesce(checked(content, "[\\n\\r]"), F.lit(HIVE_NULL)))
    df.select(line.alias("value")).write.mode(mode).text(path)
    return path
