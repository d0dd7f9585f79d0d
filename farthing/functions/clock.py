"""Event-time arithmetic on exact microseconds.

Every helper accepts TIMESTAMP or TIMESTAMP_NTZ columns; the session zone must
be UTC (see ``session.pin_utc``) so both read as the same instant.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SECOND = 1_000_000
HOUR = 3600 * SECOND
DAY = 24 * HOUR


def instant(value: str | datetime) -> Column:
    """A literal instant. Literal bounds reach the Parquet scan as filters."""
    text = value if isinstance(value, str) else value.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def literal_micros(value: str | datetime) -> int:
    moment = value if isinstance(value, datetime) else datetime.fromisoformat(value)
    delta = moment - datetime(1970, 1, 1)
    return (delta.days * 86400 + delta.seconds) * SECOND + delta.microseconds


def from_micros(value: Column) -> Column:
    return F.timestamp_micros(value).cast("timestamp_ntz")


def day_number(ts: Column) -> Column:
    """Whole UTC days since 1970-01-01, floored (also before 1970)."""
    return F.date_diff(F.to_date(ts), F.lit("1970-01-01").cast("date"))


def day_date(number: Column) -> Column:
    return F.date_add(F.lit("1970-01-01").cast("date"), number.cast("int"))


def right_closed_bin(ts: Column, origin: str | datetime, step: int) -> Column:
    """End of the bin (end - step, end] that holds ``ts``; an exact edge stays.

    ``F.window`` bins are left-closed, which would move exact edges.
    """
    start = F.lit(literal_micros(origin))
    offset = micros(ts) - start
    rest = F.pmod(offset, F.lit(step))
    edge = (offset - rest) + F.when(rest == 0, F.lit(0)).otherwise(F.lit(step))
    return from_micros(start + edge)


def time_grid(df: DataFrame, start: str | datetime, end: str | datetime, step: int, name: str) -> DataFrame:
    """One row per grid point start, start+step, … ≤ end (distributed range)."""
    low, high = literal_micros(start), literal_micros(end)
    points = df.sparkSession.range(low, high + 1, step)
    return points.select(from_micros(F.col("id")).alias(name))
