"""Column expressions for trip records."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_SECOND = 1_000_000

# payment_type codes and their labels (TLC data dictionary, in
# the reference's Spanish); any other value, NULL and 0 included, is 'Otro'.
PAYMENT_LABELS = {
    1: "Tarjeta de crédito",
    2: "Efectivo",
    3: "Sin cargo",
    4: "Disputa",
    5: "Desconocido",
    6: "Viaje anulado",
}
PAYMENT_OTHER = "Otro"



def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros_to_timestamp(micros: str | Column) -> Column:
    """int64 µs -> wall-clock timestamp truncated to the second.

    Same as ``CAST(from_unixtime(us DIV 1000000) AS TIMESTAMP)`` under a UTC
    session: ``DIV`` truncates toward zero before conversion, so sub-second
    digits are cut (``timestamp_micros`` would keep them).  The result is a
    TIMESTAMP_NTZ computed without any zone lookup.
    """
    seconds = F.expr(f"{_sql(micros)} div {MICROS_PER_SECOND}")
    return F.timestamp_add("SECOND", seconds, F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))


def _sql(c: str | Column) -> str:
    if isinstance(c, str):
        return f"`{c}`"
    raise TypeError("micros_to_timestamp expects a column name")


def micros_window(micros: str | Column, first_year: int, last_year: int) -> Column:
    """The year window as a range on the raw int64 µs column.

    Exactly equivalent to ``YEAR(ts) BETWEEN first AND last`` applied after
    ``micros_to_timestamp`` (the bounds account for ``DIV`` truncating toward
    zero on either side of the epoch), but a plain range on a stored column
    is pushed into the Parquet reader and skips row groups by statistics.
    """
    lo, hi = micros_bounds(first_year, last_year)
    m = _col(micros)
    return m.isNotNull() & (m >= lo) & (m <= hi)


def micros_bounds(first_year: int, last_year: int) -> tuple[int, int]:
    """Inclusive µs range whose truncated seconds fall in the year window."""
    epoch = _dt.datetime(1970, 1, 1)
    lo_s = int((_dt.datetime(first_year, 1, 1) - epoch).total_seconds())
    last_s = int((_dt.datetime(last_year + 1, 1, 1) - epoch).total_seconds()) - 1
    us = MICROS_PER_SECOND
    # smallest µs value m with trunc(m / us) >= lo_s
    lo = lo_s * us if lo_s > 0 else (lo_s - 1) * us + 1
    # largest µs value m with trunc(m / us) <= last_s
    hi = (last_s + 1) * us - 1 if last_s >= 0 else last_s * us
    return lo, hi


def positive(c: str | Column) -> Column:
    """``x > 0``; NULL drops out, and so does NaN (Spark orders NaN above all)."""
    x = _col(c)
    return (x > 0) & ~F.isnan(x)


def payment_label(payment_type: str | Column) -> Column:
    """Simple CASE over the payment code, ELSE 'Otro'."""
    p = _col(payment_type)
    expr = None
    for code, label in PAYMENT_LABELS.items():
        expr = (F.when(p == code, label) if expr is None
                else expr.when(p == code, label))
    return expr.otherwise(PAYMENT_OTHER)
