"""Inputs derived from the supplied test tables.

The supplied tables are TPC-H-like (``lineitem``, ``part``, ...) plus a
``documents`` text table.  The workloads map onto them as follows:

* text lines / corpus  -> ``documents(doc_id, text)``;
* short titles         -> ``part(p_partkey, p_name)``;
* taxi trips           -> ``lineitem``: every line item becomes one trip whose
  pickup is the ship date plus a time of day and a sub-second fraction
  derived from the keys.  The trips are landed as Parquet the way the
  source publishes them: one folder per era (``raw_a``/``raw_b``), one
  sub-folder per monthly file, physical types of that era, mixed-case column
  names, an extra undeclared column and timestamps stored as µs.

Every mapping here is a deterministic function of the source row, so the
DuckDB oracle recomputes it from the same table (see ``plans.catalog``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.files import era_of, trip_file_name

# Era boundary and year window used for the supplied data (lineitem spans
# 1995-2001); the reference's own values are (2023, 2) and 2020-2025.
TEST_ERA_B_FROM = (1998, 2)
TEST_YEARS = (1996, 2000)
TEST_PARTITION_YEAR = 1998
TEST_PARTITION_MONTHS = (1, 2, 3)
# What a trip is made of.
LINE_ITEM = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
             "l_returnflag", "l_linestatus", "l_shipdate")
TASKS_PER_SPLIT, TASKS_PER_SHARE = 4, 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents.text`` as the ``line`` column of a text-lines table."""
    return table(spark, sf_dir, "documents").select(F.col("text").alias("line"))


def documents_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as a ``(doc_id, content)`` corpus (numeric ids kept)."""
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.col("text").alias("content"))


def part_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` as a ``(doc_id, content)`` corpus of short titles."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("doc_id"), F.col("p_name").alias("content"))


def _c(name: str) -> Column:
    return F.col(name)


def trips_from_lineitem(lineitem: DataFrame, *keep: str) -> DataFrame:
    """One raw trip per line item (physical values, before era typing).

    Returns the 18 trip columns with pickup/dropoff as TIMESTAMP_NTZ with µs,
    plus ``airport_fee`` (an undeclared column) and ``file_year`` /
    ``file_month`` (the monthly file the trip is published in) and the columns
    of ``keep``.
    """
    ok, ln, pk, sk = _c("l_orderkey"), _c("l_linenumber"), _c("l_partkey"), _c("l_suppkey")
    offset_us = (((ok * 131 + ln * 3607) % 86400) * 1_000_000 + (pk * 7919) % 1_000_000)
    pickup = F.when(ok % 1009 == 0, F.lit(None)).otherwise(
        F.timestamp_add("MICROSECOND", offset_us, _c("l_shipdate")))
    dropoff = F.timestamp_add(
        "SECOND", _c("l_quantity").cast("bigint") * 60 + 30, pickup)
    fare = F.floor(_c("l_extendedprice") / 50) / 4
    extra = (ln % 3) * 0.5
    mta = F.lit(0.5)
    tip = F.round(_c("l_discount") * 100) / 4
    tolls = F.when(pk % 10 == 0, 6.25).otherwise(0.0)
    improvement = F.lit(1.0)
    congestion = F.when(sk % 2 == 0, 2.5).otherwise(0.0)
    total = F.when(_c("l_returnflag") == "R", -fare).otherwise(
        fare + extra + mta + tip + tolls + improvement + congestion)
    return lineitem.select(
        sk.alias("vendorid"),
        pickup.alias("tpep_pickup_datetime"),
        dropoff.alias("tpep_dropoff_datetime"),
        F.when(ln == 6, F.lit(None)).otherwise(ok % 4 + 1).alias("passenger_count"),
        ((_c("l_quantity") - 1) * 0.25).alias("trip_distance"),
        (pk % 5 + 1).alias("ratecodeid"),
        F.when(_c("l_linestatus") == "F", "N").otherwise("Y").alias("store_and_fwd_flag"),
        (pk % 265 + 1).alias("pulocationid"),
        (sk % 265 + 1).alias("dolocationid"),
        F.when((ln == 7) & (ok % 2 == 0), F.lit(None))
         .when(ln == 7, F.lit(0)).otherwise(ln).cast("bigint").alias("payment_type"),
        fare.alias("fare_amount"),
        extra.alias("extra"),
        mta.alias("mta_tax"),
        tip.alias("tip_amount"),
        tolls.alias("tolls_amount"),
        improvement.alias("improvement_surcharge"),
        total.alias("total_amount"),
        congestion.alias("congestion_surcharge"),
        ((ln % 2) * 1.25).alias("airport_fee"),
        F.year("l_shipdate").alias("file_year"),
        F.month("l_shipdate").alias("file_month"),
        *keep,
    )


# Physical column names and types as published per era (names in the
# source's mixed case; readers resolve them case-insensitively).
_PHYSICAL = {
    "a": [("VendorID", "bigint"), ("tpep_pickup_datetime", None),
          ("tpep_dropoff_datetime", None), ("passenger_count", "double"),
          ("trip_distance", "double"), ("RatecodeID", "double"),
          ("store_and_fwd_flag", "string"), ("PULocationID", "bigint"),
          ("DOLocationID", "bigint"), ("payment_type", "bigint"),
          ("fare_amount", "double"), ("extra", "double"), ("mta_tax", "double"),
          ("tip_amount", "double"), ("tolls_amount", "double"),
          ("improvement_surcharge", "double"), ("total_amount", "double"),
          ("congestion_surcharge", "double"), ("airport_fee", "double")],
    "b": [("VendorID", "int"), ("tpep_pickup_datetime", None),
          ("tpep_dropoff_datetime", None), ("passenger_count", "bigint"),
          ("trip_distance", "double"), ("RatecodeID", "bigint"),
          ("store_and_fwd_flag", "string"), ("PULocationID", "int"),
          ("DOLocationID", "int"), ("payment_type", "bigint"),
          ("fare_amount", "double"), ("extra", "double"), ("mta_tax", "double"),
          ("tip_amount", "double"), ("tolls_amount", "double"),
          ("improvement_surcharge", "double"), ("total_amount", "double"),
          ("congestion_surcharge", "double"), ("Airport_fee", "double")],
}


def _era_physical(df: DataFrame, era: str) -> list[Column]:
    cols = []
    for name, typ in _PHYSICAL[era]:
        c = F.col(name.lower())
        cols.append((c if typ is None else c.cast(typ)).alias(name))
    return cols


def land_trips(lineitem: DataFrame, root: str, era_b_from=TEST_ERA_B_FROM,
               trip_type: str = "yellow") -> str:
    """Write ``root/raw_a`` and ``root/raw_b`` as the source publishes them.

    Each trip goes to the folder of its monthly file, routed by the file's
    era (``era_of``, the rule ``classify_era`` applies to file names).  One write
    per era, since the two eras have different physical types.
    """
    # Line items are shuffled, narrower than the trips made of them, by (month,
    # share of the month): small data gives one file per month, as published,
    # while a month of larger data is dealt over several tasks.  There are
    # enough tasks that each sorts its rows in memory; a fixed count is not
    # merged by AQE.
    spark = lineitem.sparkSession
    splits = lineitem.rdd.getNumPartitions()
    n = max(2 * spark.sparkContext.defaultParallelism, TASKS_PER_SPLIT * splits)
    shares = max(1, TASKS_PER_SPLIT * splits // TASKS_PER_SHARE)
    year, month = F.year("l_shipdate"), F.month("l_shipdate")
    needed = lineitem.select(*LINE_ITEM)
    for era in ("a", "b"):
        # every row of an era has a name; one that cannot be NULL is sorted by once
        name = F.coalesce(trip_file_name(F.lit(trip_type), year, month), F.lit(""))
        rows = (needed.where(era_of(year, month, era_b_from) == era)
                .repartition(n, year, month, F.pmod(F.xxhash64(*LINE_ITEM), F.lit(shares)))
                .withColumn("tripfile", name).sortWithinPartitions("tripfile"))
        trips = trips_from_lineitem(rows, "tripfile")
        (trips.select(*_era_physical(trips, era), "tripfile")
         .write.mode("overwrite").partitionBy("tripfile")
         .parquet(f"{root}/raw_{era}"))
    return root
