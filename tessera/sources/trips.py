"""Trip Parquet sources: one reader per schema era, and the partitioned table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera import schemas


def read_trips_era(spark: SparkSession, path: str | list[str], era: str) -> DataFrame:
    """Raw trips of one era with that era's exact declared types.

    Only the 18 declared columns are read (extra file columns are pruned);
    names resolve case-insensitively (``VendorID`` -> ``vendorid``).  The
    timestamp columns come back as raw int64 µs.
    """
    schema = schemas.ERAS[era.lower()]
    paths = [path] if isinstance(path, str) else list(path)
    # folder-per-file layouts surface a discovered partition column; keep
    # exactly the declared columns
    return spark.read.schema(schema).parquet(*paths).select(*schemas.TRIP_COLUMNS)


def read_trips_partitioned(spark: SparkSession, root: str) -> DataFrame:
    """The unified table with ``anio``/``mes`` as INT partition columns.

    Declaring the schema fixes the partition column types and skips schema
    inference; filters on ``anio``/``mes`` prune directories.
    """
    return spark.read.schema(schemas.PARTITIONED).option("basePath", root).parquet(root)


def route_by_name(spark: SparkSession, root: str,
                  era_b_from: tuple[int, int] | None = None) -> dict[str, list[str]]:
    """Paths of the monthly trip files under ``root``, grouped by era.

    The era comes from the name (``{type}_tripdata_{YYYY}-{MM}.parquet``, a
    file or a folder of part files).  The listing is metadata only; one path
    per month comes back, as many as there are months.  A Parquet file
    without such a name, or a month whose trips lack the pickup column, is an
    error: loading the rest would pass for the whole.
    """
    from pyspark.sql import functions as F

    from tessera.operators.files import SOURCE_ERA_B_FROM, TRIP_FILE_REGEX, classify_era, list_files
    files = list_files(spark, root, "*.parquet")
    routed = classify_era(files, "path", era_b_from or SOURCE_ERA_B_FROM)
    unknown = [r["path"] for r in routed.where(F.col("era").isNull()).select("path").limit(3).collect()]
    if unknown:
        raise ValueError(f"not a monthly trip file: {unknown}")
    month = F.regexp_extract("path", f"^(.*?{TRIP_FILE_REGEX})", 1)
    months = routed.select("era", "trip_type", month.alias("path")).distinct().collect()
    for trip_type in sorted({r["trip_type"] for r in months}):
        one = min(r["path"] for r in months if r["trip_type"] == trip_type)
        if schemas.PICKUP not in {c.lower() for c in spark.read.parquet(one).columns}:
            raise ValueError(f"no column {schemas.PICKUP} in {one}")
    out: dict[str, list[str]] = {"a": [], "b": []}
    for r in sorted(months, key=lambda r: r["path"]):
        out[r["era"]].append(r["path"])
    return out


def read_trips_routed(spark: SparkSession, root: str,
                      era_b_from: tuple[int, int] | None = None) -> dict[str, DataFrame]:
    """One DataFrame per era present under ``root``, each read with its own types."""
    return {era: read_trips_era(spark, paths, era)
            for era, paths in route_by_name(spark, root, era_b_from).items() if paths}
