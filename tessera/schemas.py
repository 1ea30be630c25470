"""Declared schemas (schema-on-read, as the reference declares them).

Trip Parquet changed its physical types partway through its history, so each
era is read with its exact types and cast afterwards (a single reader over a
mixed directory fails; INT64 -> DOUBLE is not a legal read-time widening).
Timestamps are declared BIGINT: the files store int64 microseconds and the
conversion (truncate to the second, then to a timestamp) is done in SQL.
"""

from __future__ import annotations

from pyspark.sql import types as T

PICKUP = "tpep_pickup_datetime"

# The 18 trip columns in their published order.  airport_fee / cbd_congestion_fee
# are deliberately not declared: they change name and type between years.
TRIP_COLUMNS = [
    "vendorid", "tpep_pickup_datetime", "tpep_dropoff_datetime",
    "passenger_count", "trip_distance", "ratecodeid", "store_and_fwd_flag",
    "pulocationid", "dolocationid", "payment_type", "fare_amount", "extra",
    "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
    "total_amount", "congestion_surcharge",
]

_MONEY = ["fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
          "improvement_surcharge", "total_amount", "congestion_surcharge"]


def _trip_schema(ids, counts, stamps) -> T.StructType:
    typ = {
        "vendorid": ids, "pulocationid": ids, "dolocationid": ids,
        "passenger_count": counts, "ratecodeid": counts,
        "tpep_pickup_datetime": stamps, "tpep_dropoff_datetime": stamps,
        "trip_distance": T.DoubleType(), "store_and_fwd_flag": T.StringType(),
        "payment_type": T.LongType(),
        **{m: T.DoubleType() for m in _MONEY},
    }
    return T.StructType([T.StructField(c, typ[c], True) for c in TRIP_COLUMNS])


# Era A (up to and including 2023-01 in the source data): DOUBLE counts, BIGINT ids.
ERA_A = _trip_schema(T.LongType(), T.DoubleType(), T.LongType())
# Era B (from 2023-02): BIGINT counts, INT ids.
ERA_B = _trip_schema(T.IntegerType(), T.LongType(), T.LongType())
ERAS = {"a": ERA_A, "b": ERA_B}

# Unified row: ids BIGINT, counts DOUBLE, timestamps as wall-clock timestamps
# (Hive TIMESTAMP has no zone; TIMESTAMP_NTZ is its Spark equivalent).
UNIFIED = _trip_schema(T.LongType(), T.DoubleType(), T.TimestampNTZType())

PARTITION_COLUMNS = ["anio", "mes"]
PARTITIONED = T.StructType(
    UNIFIED.fields
    + [T.StructField("anio", T.IntegerType(), True),
       T.StructField("mes", T.IntegerType(), True)])

# Text inputs.
LINES = T.StructType([T.StructField("line", T.StringType(), True)])
CORPUS = T.StructType([T.StructField("doc_id", T.StringType(), True),
                       T.StructField("content", T.StringType(), True)])
