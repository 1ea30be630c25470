"""Trip ingest: two era readers -> one table partitioned by (anio, mes).

The rebuild is a single overwrite of the whole table (re-running it never
duplicates rows).  ``append_era`` reproduces the reference's per-era
``INSERT INTO`` for incremental loads; ``replace_partitions`` overwrites only
the months present in the new data (dynamic partition overwrite).

Write layout: by default nothing is shuffled -- each task sorts its own rows
by (anio, mes) and writes one file per month it holds.  Source files are
monthly, so a task normally holds one month and writes one file.  When the
input is not organised by month, ``rebalance=True`` adds one shuffle on
(anio, mes) whose skewed partitions AQE splits and whose small ones it
merges, so a month holding a third of all rows is still written by many
tasks.  ``max_records_per_file`` caps file size in either case.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import schemas
from tessera.operators.trips import SOURCE_YEARS, in_year_window, unify, unify_era
from tessera.sources import tables
from tessera.sources.trips import read_trips_era


def _writer(df: DataFrame, mode: str, rebalance: bool, max_records_per_file: int | None):
    if rebalance:
        df = df.hint("rebalance", *schemas.PARTITION_COLUMNS)
    w = df.write.partitionBy(*schemas.PARTITION_COLUMNS)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", int(max_records_per_file))
    if mode == "overwrite":
        w = w.mode("overwrite").option("partitionOverwriteMode", "static")
    elif mode == "replace_partitions":
        w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    elif mode == "append":
        w = w.mode("append")
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return w


def unified_trips(spark: SparkSession, era_a: str | list[str] | None,
                  era_b: str | list[str] | None,
                  years: tuple[int, int] = SOURCE_YEARS) -> DataFrame:
    """Both eras read with their own types, unified and year-filtered."""
    eras = []
    if era_a:
        eras.append(read_trips_era(spark, era_a, "a"))
    if era_b:
        eras.append(read_trips_era(spark, era_b, "b"))
    return unify(eras, *years)


def ingest_trips(spark: SparkSession, era_a: str | list[str] | None,
                 era_b: str | list[str] | None, out: str,
                 years: tuple[int, int] = SOURCE_YEARS, mode: str = "overwrite",
                 rebalance: bool = False,
                 max_records_per_file: int | None = None) -> str:
    """Rebuild (or update) the partitioned trip table at ``out``."""
    df = unified_trips(spark, era_a, era_b, years)
    _writer(df, mode, rebalance, max_records_per_file).parquet(out)
    return out


def ingest_routed(spark: SparkSession, landing: str, out: str,
                  years: tuple[int, int] = SOURCE_YEARS,
                  era_b_from: tuple[int, int] | None = None, **write) -> str:
    """Rebuild from one landing folder holding monthly files of both eras.

    Each file goes to the reader of its era by its name, then as
    ``ingest_trips``.
    """
    from tessera.sources.trips import route_by_name
    routes = route_by_name(spark, landing, era_b_from)
    return ingest_trips(spark, routes["a"] or None, routes["b"] or None, out, years, **write)


def append_era(spark: SparkSession, path: str | list[str], era: str, out: str,
               years: tuple[int, int] = SOURCE_YEARS, rebalance: bool = False,
               max_records_per_file: int | None = None) -> str:
    """``INSERT INTO <table> PARTITION (anio, mes) SELECT ...`` for one era.

    Appends: running it twice doubles that era's rows, as in the reference.
    """
    raw = read_trips_era(spark, path, era)
    df = unify_era(in_year_window(raw, *years))
    _writer(df, "append", rebalance, max_records_per_file).parquet(out)
    return out


def append_era_to_table(spark: SparkSession, path: str | list[str], era: str, table: str,
                        years: tuple[int, int] = SOURCE_YEARS, rebalance: bool = False) -> DataFrame:
    """``INSERT INTO table PARTITION (anio, mes) SELECT ...`` for one era.

    The insert goes through the catalog table, which registers the months that
    it adds: SQL over the name sees them at once.  Columns are matched by name.
    """
    df = unify_era(in_year_window(read_trips_era(spark, path, era), *years))
    if rebalance:
        df = df.hint("rebalance", *schemas.PARTITION_COLUMNS)
    df.select(*spark.table(table).columns).write.insertInto(table)
    return spark.table(table)


def rebuild_table(spark: SparkSession, era_a: str | list[str] | None, era_b: str | list[str] | None,
                  table: str, root: str, years: tuple[int, int] = SOURCE_YEARS, **write) -> str:
    """Rebuild a named trip table; until it is complete the name keeps the old rows.

    The new rows are written to a folder of their own below ``root``, defined as
    a table beside the old one, and the name is switched to it last.  A rebuild
    that fails on the way leaves the name, the old files and any reader of them as
    they were.  Returns the new location; earlier ones are the caller's to remove.
    """
    location = f"{root.rstrip('/')}/rebuild-{uuid.uuid4().hex[:12]}"
    ingest_trips(spark, era_a, era_b, location, years, **write)
    staged = f"{table}__rebuild"
    tables.define_trips_partitioned_table(spark, staged, location)
    tables.swap_table(spark, table, staged)
    return location


def show_partitions(spark: SparkSession, root: str) -> DataFrame:
    """Partitions present, ``anio=YYYY/mes=M`` as ``SHOW PARTITIONS`` prints them.

    Answered from the file listing alone: the ``binaryFile`` source discovers
    ``anio``/``mes`` from the folder names and, with ``content`` never
    selected, opens no file -- the cost grows with the number of files, not
    rows.  Only committed data files (``*.parquet``) count.
    """
    files = (spark.read.format("binaryFile")
             .option("pathGlobFilter", "*.parquet")
             .option("basePath", root)
             .load(root))
    if not {"anio", "mes"} <= set(files.columns):      # no partition written yet
        return spark.createDataFrame([], "anio int, mes int, partition string")
    return (files.select(F.col("anio").cast("int").alias("anio"),
                         F.col("mes").cast("int").alias("mes"))
            .distinct()
            .select("anio", "mes",
                    F.format_string("anio=%d/mes=%d", "anio", "mes").alias("partition"))
            .orderBy("anio", "mes"))
