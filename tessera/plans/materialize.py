"""Written intermediate tables derived from the supplied test tables.

Several registered queries start from the same derived files (landed trip
files, the partitioned trip table, text files written from ``documents``).
Each is written once per (work folder, source folder) into the shared work
folder and reused; a written table also cuts lineage, so a lost executor
re-reads files instead of recomputing the derivation.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

from tessera.plans.ingest import ingest_trips
from tessera.session import fresh_dir, work_root
from tessera.sources import testdata
from tessera.sources.text import write_lines, write_tsv_corpus

_MEMO: dict[tuple[str, str, str], str] = {}


def _memo(spark: SparkSession, sf_dir: str, what: str, build) -> str:
    key = (work_root(spark), os.path.abspath(sf_dir), what)
    if key not in _MEMO:
        _MEMO[key] = build(fresh_dir(spark, what))
    return _MEMO[key]


def trip_landing(spark: SparkSession, sf_dir: str) -> str:
    """Folder with ``raw_a``/``raw_b`` trip files landed from ``lineitem``."""
    return _memo(spark, sf_dir, "landing", lambda d: testdata.land_trips(
        testdata.table(spark, sf_dir, "lineitem"), d))


def era_path(spark: SparkSession, sf_dir: str, era: str) -> str:
    return f"{trip_landing(spark, sf_dir)}/raw_{era}"


def trips_table(spark: SparkSession, sf_dir: str) -> str:
    """The partitioned trip table built from the landed files."""
    return _memo(spark, sf_dir, "trips_by_month", lambda d: ingest_trips(
        spark, era_path(spark, sf_dir, "a"), era_path(spark, sf_dir, "b"), d,
        years=testdata.TEST_YEARS))


def text_lines(spark: SparkSession, sf_dir: str) -> str:
    """Text files holding ``documents.text`` (one file per task)."""
    return _memo(spark, sf_dir, "lines_input", lambda d: write_lines(
        testdata.table(spark, sf_dir, "documents"), "text", d))


def tsv_corpus(spark: SparkSession, sf_dir: str) -> str:
    """``p_partkey<TAB>p_name`` lines written from ``part``."""
    return _memo(spark, sf_dir, "corpus_input", lambda d: write_tsv_corpus(
        testdata.table(spark, sf_dir, "part"), "p_partkey", "p_name", d))


def title_lines(spark: SparkSession, sf_dir: str) -> str:
    """``part.p_name`` as text lines, in ``p_partkey`` order across files.

    Range-partitioned sort: part file i holds the i-th key range, so file
    order (file name, then line) is key order.
    """
    def build(d: str) -> str:
        part = testdata.table(spark, sf_dir, "part").orderBy("p_partkey")
        return write_lines(part, "p_name", d)
    return _memo(spark, sf_dir, "titles", build)
