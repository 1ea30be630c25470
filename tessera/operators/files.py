"""File-level bookkeeping for trip sources, as DataFrame jobs.

* ``trip_file_name`` / ``parse_trip_file``: ``{type}_tripdata_{YYYY}-{MM}.parquet``;
* ``classify_era``: which schema era a monthly file belongs to;
* ``expand_months``: year range x month list -> expected monthly files;
* ``missing_files``: expected files not yet present (idempotent re-runs);
* ``source_inventory``: file count and bytes per era, from a listing.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TRIP_FILE_REGEX = r"((yellow|green)_tripdata_([0-9]{4})-([0-9]{2})\.parquet)"
ALL_MONTHS = tuple(range(1, 13))
# First month of era B in the published source data (2023-02).
SOURCE_ERA_B_FROM = (2023, 2)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trip_file_name(trip_type: str | Column, year: str | Column,
                   month: str | Column) -> Column:
    """``yellow_tripdata_2020-01.parquet`` style name.

    Built with ``concat``/``lpad`` (cheap per row) rather than ``format_string``.
    """
    def padded(c: Column, width: int) -> Column:
        s = c.cast("string")
        return F.when(F.length(s) < width, F.lpad(s, width, "0")).otherwise(s)
    return F.concat(_col(trip_type), F.lit("_tripdata_"), padded(_col(year), 4),
                    F.lit("-"), padded(_col(month), 2), F.lit(".parquet"))


def parse_trip_file(path: str | Column) -> dict[str, Column]:
    """Pull name, type, year and month out of a path holding a trip file name."""
    p = _col(path)
    name = F.regexp_extract(p, TRIP_FILE_REGEX, 1)
    return {
        "file_name": F.when(name != "", name),
        "trip_type": F.when(name != "", F.regexp_extract(p, TRIP_FILE_REGEX, 2)),
        "year": F.when(name != "", F.regexp_extract(p, TRIP_FILE_REGEX, 3).cast("int")),
        "month": F.when(name != "", F.regexp_extract(p, TRIP_FILE_REGEX, 4).cast("int")),
    }


def era_of(year: str | Column, month: str | Column,
           era_b_from: tuple[int, int] = SOURCE_ERA_B_FROM) -> Column:
    """'a' before the boundary month, 'b' from it on (NULL if unknown)."""
    y, m = _col(year), _col(month)
    by, bm = era_b_from
    is_a = (y < by) | ((y == by) & (m < bm))
    return F.when(y.isNull() | m.isNull(), F.lit(None)).when(is_a, "a").otherwise("b")


def classify_era(df: DataFrame, name_col: str,
                 era_b_from: tuple[int, int] = SOURCE_ERA_B_FROM) -> DataFrame:
    """Add ``trip_type``, ``year``, ``month`` and ``era`` parsed from a file name.

    Columns already present keep their values (and spare the regex).
    """
    parts = parse_trip_file(name_col)
    out = df
    for k in ("trip_type", "year", "month"):
        if k not in df.columns:
            out = out.withColumn(k, parts[k])
    return out.withColumn("era", era_of("year", "month", era_b_from))


def expand_months(years: DataFrame, months: Iterable[int] = ALL_MONTHS,
                  trip_type: str = "yellow", year_col: str = "year") -> DataFrame:
    """Expected monthly files for every year in ``years`` x ``months``."""
    ms = sorted({int(m) for m in months})
    if not ms or ms[0] < 1 or ms[-1] > 12:
        raise ValueError(f"months must lie in 1..12, got {ms}")
    out = (years.select(F.col(year_col).cast("int").alias("year"))
           .select("year", F.explode(F.array(*[F.lit(m) for m in ms])).alias("month")))
    return out.select(trip_file_name(F.lit(trip_type), "year", "month").alias("file_name"),
                      "year", "month")


def year_range(spark: SparkSession, spec: str | int | Iterable[int]) -> DataFrame:
    """Years from ``"2020-2025"``, ``"2020 2021"``, a single year or a list."""
    if isinstance(spec, int):
        years = [spec]
    elif isinstance(spec, str):
        s = spec.strip()
        if "-" in s:
            lo, hi = (int(x) for x in s.split("-", 1))
            years = list(range(lo, hi + 1))
        else:
            years = [int(x) for x in s.split()]
    else:
        years = [int(x) for x in spec]
    return spark.createDataFrame([(y,) for y in years], "year int")


def years_between(df: DataFrame, lo_col: str, hi_col: str) -> DataFrame:
    """One row per year from ``lo`` to ``hi`` of every input row."""
    return df.select(F.explode(F.sequence(F.col(lo_col).cast("int"),
                                          F.col(hi_col).cast("int"))).alias("year"))


def missing_files(expected: DataFrame, found: DataFrame,
                  key: str = "file_name") -> DataFrame:
    """Expected files that are not present yet (left anti join on the name)."""
    return expected.join(found.select(key).distinct(), key, "left_anti")


def list_files(spark: SparkSession, root: str, glob: str = "*.parquet") -> DataFrame:
    """``(path, length)`` of every file below ``root`` (content never read).

    A folder that does not exist lists as empty.
    """
    from pyspark.errors import AnalysisException
    try:
        return (spark.read.format("binaryFile")
                .option("recursiveFileLookup", "true")
                .option("pathGlobFilter", glob)
                .load(root)
                .select("path", "length"))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        return spark.createDataFrame([], "path string, length bigint")


def source_inventory(spark: SparkSession, era_roots: dict[str, str],
                     glob: str = "*.parquet", require_any: bool = True) -> DataFrame:
    """File count, bytes and monthly files per era folder.

    ``era_roots`` maps an era name to its folder.  Raises when no era has a
    single file, like the pre-flight check before a run.
    """
    frames = []
    for era, root in era_roots.items():
        frames.append(list_files(spark, root, glob).withColumn("era", F.lit(era)))
    files = frames[0]
    for f in frames[1:]:
        files = files.unionByName(f)
    inv = (files.withColumn("file_name", parse_trip_file("path")["file_name"])
           .groupBy("era")
           .agg(F.count("*").alias("n_files"),
                F.sum("length").alias("n_bytes"),
                F.countDistinct("file_name").alias("n_months")))
    if require_any:
        total = inv.agg(F.sum("n_files")).first()[0]
        if not total:
            raise FileNotFoundError(f"no {glob} files in any of {list(era_roots.values())}")
    return inv
