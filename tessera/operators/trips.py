"""Trip record operators: era unification and the analytical queries.

All queries are single-pass aggregations with map-side partial aggregation
(or a per-task top-k for the ranked ones), so no task ever sees more than
its own split plus one partial row per group from every other task.
Filters on ``anio``/``mes`` prune partition folders of the written table.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera import schemas
from tessera.functions.trips import (
    micros_to_timestamp, micros_window, payment_label, positive)

SOURCE_YEARS = (2020, 2025)

_UNIFIED_TYPES = {f.name: f.dataType for f in schemas.UNIFIED.fields}
_STAMPS = ("tpep_pickup_datetime", "tpep_dropoff_datetime")


def unify_era(raw: DataFrame) -> DataFrame:
    """Raw era rows -> unified types plus ``anio``/``mes`` (no row filter).

    Ids become BIGINT, counts DOUBLE (a no-op cast where the era already has
    the type) and the µs timestamps become wall-clock timestamps truncated to
    the second.  Columns are produced by name, never by position.
    """
    cols = []
    for c in schemas.TRIP_COLUMNS:
        if c in _STAMPS:
            cols.append(micros_to_timestamp(c).alias(c))
        else:
            cols.append(F.col(c).cast(_UNIFIED_TYPES[c]).alias(c))
    out = raw.select(*cols)
    return out.select("*",
                      F.year("tpep_pickup_datetime").alias("anio"),
                      F.month("tpep_pickup_datetime").alias("mes"))


def in_year_window(raw: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """Raw rows whose pickup, once truncated, falls in the year window.

    Expressed as a range on the stored µs column so Parquet row groups are
    skipped by their statistics.
    """
    return raw.where(micros_window("tpep_pickup_datetime", first_year, last_year))


def unify(eras: Iterable[DataFrame], first_year: int = SOURCE_YEARS[0],
          last_year: int = SOURCE_YEARS[1]) -> DataFrame:
    """All eras unified, filtered to the year window, unioned by name.

    The window is applied once, as the pushed-down µs range, which selects
    exactly the rows ``YEAR(pickup) BETWEEN first AND last`` would keep.
    """
    out = None
    for raw in eras:
        u = unify_era(in_year_window(raw, first_year, last_year))
        out = u if out is None else out.unionByName(u)
    if out is None:
        raise ValueError("no era given")
    return out


def trip_total(trips: DataFrame) -> DataFrame:
    return trips.agg(F.count(F.lit(1)).alias("total_viajes"))


def distance_stats(trips: DataFrame) -> DataFrame:
    """Average (3 decimals) and maximum (2 decimals) of positive distances."""
    return (trips.where(positive("trip_distance"))
            .agg(F.round(F.avg("trip_distance"), 3).alias("distancia_promedio"),
                 F.round(F.max("trip_distance"), 2).alias("distancia_maxima")))


def distance_avg(trips: DataFrame) -> DataFrame:
    return (trips.where(positive("trip_distance"))
            .agg(F.round(F.avg("trip_distance"), 3).alias("distancia_promedio")))


def trips_by_hour(trips: DataFrame) -> DataFrame:
    """Trips per pickup hour, busiest first (hour breaks ties)."""
    return (trips.groupBy(F.hour("tpep_pickup_datetime").alias("hora"))
            .agg(F.count(F.lit(1)).alias("viajes"))
            .orderBy(F.desc("viajes"), F.asc_nulls_last("hora")))


def payment_methods(trips: DataFrame) -> DataFrame:
    """Per payment code: label, trips and average ticket (2 decimals).

    The label is computed after grouping, on the code: every distinct code
    (NULL and 0 included) is its own row, several of them may read 'Otro'.
    """
    return (trips.groupBy("payment_type")
            .agg(F.count(F.lit(1)).alias("viajes"),
                 F.round(F.avg("total_amount"), 2).alias("ticket_promedio"))
            .select("payment_type", payment_label("payment_type").alias("metodo_pago"),
                    "viajes", "ticket_promedio")
            .orderBy(F.desc("viajes"), F.asc_nulls_last("payment_type")))


def payment_counts(trips: DataFrame) -> DataFrame:
    return (trips.groupBy("payment_type").agg(F.count(F.lit(1)).alias("viajes"))
            .orderBy(F.desc("viajes"), F.asc_nulls_last("payment_type")))


_TOP_COLUMNS = ["tpep_pickup_datetime", "trip_distance", "payment_type", "total_amount"]


def top_trips(trips: DataFrame, k: int = 10, with_payment: bool = True) -> DataFrame:
    """The ``k`` most expensive trips with a positive total.

    Planned as a per-task top-k followed by one merge of k rows per task.
    Ties are broken on the remaining output columns.
    """
    cols = [c for c in _TOP_COLUMNS if with_payment or c != "payment_type"]
    order = [F.desc("total_amount")] + [F.asc_nulls_last(c) for c in cols if c != "total_amount"]
    return (trips.where(positive("total_amount")).select(*cols)
            .orderBy(*order).limit(k))


def top_trips_narrow(trips: DataFrame, k: int = 10) -> DataFrame:
    return top_trips(trips, k, with_payment=False)


def in_partitions(trips: DataFrame, year: int, months: Iterable[int]) -> DataFrame:
    """``anio = year AND mes IN (months)`` -- a partition filter (pruning)."""
    ms = sorted({int(m) for m in months})
    return trips.where((F.col("anio") == year) & F.col("mes").isin(*ms))


def monthly_revenue(trips: DataFrame, year: int, months: Iterable[int]) -> DataFrame:
    return (in_partitions(trips, year, months)
            .groupBy("anio", "mes")
            .agg(F.count(F.lit(1)).alias("viajes"),
                 F.round(F.avg("fare_amount"), 2).alias("tarifa_promedio"),
                 F.round(F.sum("total_amount"), 2).alias("recaudacion"))
            .orderBy("anio", "mes"))


def monthly_counts(trips: DataFrame, year: int, months: Iterable[int]) -> DataFrame:
    return (in_partitions(trips, year, months)
            .groupBy("anio", "mes").agg(F.count(F.lit(1)).alias("viajes"))
            .orderBy("anio", "mes"))


def partition_count(trips: DataFrame, year: int, month: int) -> DataFrame:
    return in_partitions(trips, year, [month]).agg(F.count(F.lit(1)).alias("viajes"))
