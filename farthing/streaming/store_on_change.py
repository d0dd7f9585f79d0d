"""Store-on-change over a stream of observations.

Two forms. ``store_on_change_stream`` keeps state per listing and UTC day until the
watermark has passed that day, so it does not grow with the stream and a late row is
judged against its own day. ``write_changes`` is for streams in which one listing
may dominate: it runs the batch operator, which spreads such a listing, on every
micro-batch against what earlier ones wrote on the same days.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from farthing.functions import clock
from farthing.operators.changes import same_state, store_on_change
from farthing.operators.series import latest_per

register_pickle_by_value(sys.modules[__name__])

OUTPUT = (
    "id bigint, listing_id bigint, price double, price_per_round double, in_stock boolean, recorded_at timestamp, "
    "_nan_price boolean, _nan_unit boolean"
)
# The last written row of the day, and the rows that wait for the watermark.
STATE = (
    "seen boolean, price double, unit double, stock boolean, odd boolean, ids array<bigint>, prices array<double>, "
    "units array<double>, stocks array<boolean>, times array<bigint>, nan_prices array<boolean>, nan_units array<boolean>"
)
FIELDS = ["id", "price", "price_per_round", "in_stock", "_micros", "_nan_price", "_nan_unit"]
DAY_MS = 86_400_000


def _plain(frame: pd.DataFrame) -> list[tuple]:
    """Rows as tuples of plain values; pandas shows NULL as NaN, here it is None."""
    return [
        (int(i), None if pd.isna(p) else float(p), None if pd.isna(u) else float(u), bool(s), int(t), bool(x), bool(y))
        for i, p, u, s, t, x, y in frame[FIELDS].itertuples(index=False, name=None)
    ]


def _advance(wait: bool):
    """Rows of one listing and day that differ from the last written one.

    With ``wait`` a row is judged once the watermark has passed it, so rows are taken in
    the order of their times however they arrived; else each micro-batch's rows are
    judged at once, in time order.
    """

    def fold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        listing, day = key
        last, seen, held = None, False, []
        if state.exists:
            seen, price, unit, stock, odd, *columns = state.get
            last = (price, unit, stock) if seen and not odd else None
            held = [(i, p, u, bool(s), t, bool(x), bool(y)) for i, p, u, s, t, x, y in zip(*columns)]
        if not state.hasTimedOut:
            for frame in batches:
                held += _plain(frame)
        held.sort(key=lambda r: (r[4], r[0]))
        mark = state.getCurrentWatermarkMs()
        ready = sum(r[4] <= mark * 1000 for r in held) if wait else len(held)
        written = []
        for row in held[:ready]:
            now, odd = row[1:4], row[5] or row[6]
            if not seen or odd or last is None or not same_state(last, now):
                written.append(row)
                # Whatever follows a NaN differs from it.
                seen, last = True, None if odd else now
        held = held[ready:]
        end = (int(day) + 1) * DAY_MS
        if held or mark < end:
            price, unit, stock = last or (None, None, False)
            state.update((seen, price, unit, stock, last is None, *(list(c) for c in zip(*held)))
                         if held else (seen, price, unit, stock, last is None, *([] for _ in FIELDS)))
            # Also before the first watermark: a key that gets no other row must still be heard again.
            due = held[0][4] // 1000 + 1 if held else end
            state.setTimeoutTimestamp(max(due, mark + 1, 1))
        elif state.exists:
            state.remove()
        yield pd.DataFrame(
            {
                "id": pd.Series([r[0] for r in written], dtype="int64"), "listing_id": listing,
                "price": pd.Series([r[1] for r in written], dtype="float64"), "price_per_round": pd.Series([r[2] for r in written], dtype="float64"),
                "in_stock": pd.Series([r[3] for r in written], dtype="bool"), "recorded_at": pd.to_datetime([r[4] for r in written], unit="us"),
                "_nan_price": pd.Series([r[5] for r in written], dtype="bool"), "_nan_unit": pd.Series([r[6] for r in written], dtype="bool"),
            }
        )

    return fold


def store_on_change_stream(observed: DataFrame, lateness: str = "1 day", wait: bool = False) -> DataFrame:
    """Streaming twin of ``changes.store_on_change``.

    The watermark bounds both how late a row may be and how long state is kept. For
    input in time order both forms equal the batch result; with ``wait`` any order within the
    lateness does, at the price of emitting rows when the watermark passes them. Rows
    without a listing or a time have no day to compare with and are left out.
    """
    number = lambda c: F.col(c).cast("double")
    nan = lambda c: F.coalesce(F.isnan(number(c)), F.lit(False))
    rows = observed.where("listing_id is not null and recorded_at is not null").select(
        F.col("id").cast("bigint").alias("id"),
        F.col("listing_id").cast("bigint").alias("listing_id"),
        number("price").alias("price"),
        number("price_per_round").alias("price_per_round"),
        F.coalesce(F.col("in_stock"), F.lit(False)).alias("in_stock"),
        F.col("recorded_at").cast("timestamp").alias("recorded_at"),
    )
    rows = rows.withColumn("_day", clock.day_number(F.col("recorded_at")).cast("bigint"))
    rows = rows.withColumn("_nan_price", nan("price")).withColumn("_nan_unit", nan("price_per_round"))
    rows = rows.withColumn("_micros", F.unix_micros("recorded_at"))
    marked = rows.withWatermark("recorded_at", lateness)
    written = marked.groupBy("listing_id", "_day").applyInPandasWithState(
        _advance(wait), OUTPUT, STATE, "append", GroupStateTimeout.EventTimeTimeout
    )
    restored = written.withColumn("price", F.when(F.col("_nan_price"), F.lit(float("nan"))).otherwise(F.col("price")))
    restored = restored.withColumn(
        "price_per_round", F.when(F.col("_nan_unit"), F.lit(float("nan"))).otherwise(F.col("price_per_round"))
    )
    return restored.drop("_nan_price", "_nan_unit")


def write_changes(target: str):
    """A ``foreachBatch`` function that stores the changes of each micro-batch.

    The target is partitioned by day, then batch. A batch reads only its own days, and of
    those only what earlier batches wrote, so one that is run again after a failure
    overwrites its own partitions with the same rows. The target need not exist.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        spark, day = batch.sparkSession, F.to_date("recorded_at")
        days = [r.day for r in batch.select(day.alias("day")).distinct().collect() if r.day is not None]
        try:
            kept = spark.read.option("basePath", target).parquet(target)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            kept = None
        baseline = None
        if kept is not None:
            earlier = kept.where(F.col("day").isin(days) & (F.col("batch_id") < batch_id)).drop("batch_id")
            baseline = latest_per(earlier, ["listing_id", "day"], ["recorded_at", "id"]).drop("day")
        written = store_on_change(batch, baseline).withColumn("day", day).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        out = written.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        out.partitionBy("day", "batch_id").parquet(target)

    return store
