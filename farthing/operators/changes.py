"""Store-on-change: which observations are worth writing."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farthing.functions import clock
from farthing.operators.spread import carry_forward, running_sum

PRICE_TOLERANCE = 0.005
UNIT_TOLERANCE = 0.00005
SLICE_MICROS = 15 * 60 * clock.SECOND
# Executors need not have the package installed to run the fold.
register_pickle_by_value(sys.modules[__name__])

STATE = ("price", "price_per_round", "in_stock")


def same_number(left: float | None, right: float | None, tolerance: float) -> bool:
    """Equal within a tolerance; missing equals only missing, NaN nothing."""
    if left is None or right is None:
        return left is None and right is None
    return abs(left - right) < tolerance


def same_state(left: tuple, right: tuple) -> bool:
    return (
        same_number(left[0], right[0], PRICE_TOLERANCE)
        and same_number(left[1], right[1], UNIT_TOLERANCE)
        and bool(left[2]) == bool(right[2])
    )


def _moved(now: Column, before: Column, tolerance: float) -> Column:
    """Certainly different from whatever was written last.

    The previous observation lies within one tolerance of the last written
    value, so a step of two tolerances leaves that value too.
    """
    a, b = now.cast("double"), before.cast("double")
    nan = F.coalesce(F.isnan(a), F.lit(False)) | F.coalesce(F.isnan(b), F.lit(False))
    step = F.coalesce(F.abs(a - b) >= 2 * tolerance * 1.000001, F.lit(False))
    return (now.isNull() != before.isNull()) | nan | step


def _repeats(now: Column, before: Column) -> Column:
    return now.eqNullSafe(before)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep the rows that differ from the last written one of their run.

    Batches arrive sorted by run, so only one state is ever held. A batch
    without an unsure row passes whole. Arrow keeps NULL and NaN apart.
    """
    last = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        states = [batch.column(name) for name in ("_p", "_u", "_stock")]
        unsure = batch.column("_unsure").to_pylist()
        if not any(unsure):
            last = tuple(column[batch.num_rows - 1].as_py() for column in states)
            yield batch
            continue
        keep = []
        for doubtful, *state in zip(unsure, *(column.to_pylist() for column in states)):
            write = not doubtful or not same_state(last, state)
            keep.append(write)
            if write:
                last = state
        yield batch.filter(pa.array(keep))


def store_on_change(
    observed: DataFrame,
    baseline: DataFrame | None = None,
    fail_open: bool = False,
    slice_micros: int = SLICE_MICROS,
) -> DataFrame:
    """Rows to write: the first per listing and UTC day, then every change.

    A change is measured against the last *written* row of the day (price,
    unit price, stock flag), so a slow drift is written once it leaves the
    tolerance. ``baseline`` holds the latest stored row per listing for the
    days concerned; with ``fail_open`` (no baseline could be read) everything
    is written.

    Deciding against the last written row is sequential, but only between two
    rows that are certain to be written: the first of a day, a stock flip, a
    step of two tolerances. Exact repeats of the previous observation are
    never written. Both facts need only the previous observation, which is
    found slice by slice (see ``carry_forward``); the runs between certain
    rows are then scanned independently, so no listing is one task's work.
    """
    if fail_open:
        return observed
    names = observed.columns
    stamped = observed.withColumn("_base", F.lit(False))
    if baseline is not None:
        base = baseline.select(*[F.col(c) if c in baseline.columns else F.lit(None).alias(c) for c in names])
        stamped = stamped.unionByName(base.withColumn("_base", F.lit(True)))
    us = clock.micros(F.col("recorded_at"))
    slice_of = F.when(F.col("_base"), F.lit(-1)).otherwise(F.floor(F.pmod(us, F.lit(clock.DAY)) / F.lit(slice_micros)))
    staged = stamped.withColumn("_day", clock.day_number(F.col("recorded_at"))).withColumn(
        "_slice", slice_of.cast("int")
    )
    # A NULL stock flag reads as out of stock.
    staged = staged.withColumn("_stock", F.coalesce(F.col("in_stock"), F.lit(False)))
    state = F.struct(F.col("price").alias("p"), F.col("price_per_round").alias("u"), F.col("_stock").alias("s"))
    keys, order = ["listing_id", "_day"], ["recorded_at", "id"]
    linked = carry_forward(staged, keys, "_slice", order, state, "_prev")
    before = F.col("_prev")
    repeat = (
        before.isNotNull()
        & _repeats(F.col("price"), before["p"])
        & _repeats(F.col("price_per_round"), before["u"])
        & (F.col("_stock") == before["s"])
        & ~F.coalesce(F.isnan(F.col("price").cast("double")), F.lit(False))
        & ~F.coalesce(F.isnan(F.col("price_per_round").cast("double")), F.lit(False))
    )
    certain = (
        before.isNull()
        | (F.col("_stock") != before["s"])
        | _moved(F.col("price"), before["p"], PRICE_TOLERANCE)
        | _moved(F.col("price_per_round"), before["u"], UNIT_TOLERANCE)
    )
    moved = linked.where(~repeat).withColumn("_unsure", ~certain)
    runs = running_sum(moved, keys, "_slice", order, F.when(F.col("_unsure"), 0).otherwise(1), "_run")
    runs = runs.select(
        *names, "_base", "_day", "_run", "_unsure", "_stock",
        F.col("price").cast("double").alias("_p"), F.col("price_per_round").cast("double").alias("_u"),
        "_slice",
    )
    ordered = runs.repartition("listing_id", "_day", "_run").sortWithinPartitions(
        "listing_id", "_day", "_run", "_slice", *order
    )
    written = ordered.mapInArrow(_fold, ordered.schema)
    return written.where(~F.col("_base")).select(*names)


def day_baseline(history: DataFrame, day: str) -> DataFrame:
    """Latest stored row per listing of one UTC day.

    The day's edges are literals, so only its files are read.
    """
    start = clock.literal_micros(day)
    rows = history.where(
        (F.col("recorded_at") >= clock.from_micros(F.lit(start)))
        & (F.col("recorded_at") < clock.from_micros(F.lit(start + clock.DAY)))
    )
    state = F.struct("id", "recorded_at", *STATE)
    return (
        rows.groupBy("listing_id")
        .agg(F.max_by(state, F.struct("recorded_at", "id")).alias("_row"))
        .select("listing_id", "_row.*")
    )


def stamp_on_success(retailers: DataFrame, runs: DataFrame, as_of: Column) -> DataFrame:
    """Advance last_scraped_at only for retailers whose run saved rows."""
    saved = runs.groupBy(F.col("retailer_id").alias("_rid")).agg(F.max(F.col("saved") > 0).alias("_ok"))
    joined = retailers.join(saved, F.col("id") == F.col("_rid"), "left")
    stamp = F.when(F.coalesce("_ok", F.lit(False)), as_of).otherwise(F.col("last_scraped_at"))
    return joined.withColumn("last_scraped_at", stamp).select(*retailers.columns)


def stock_stamps(listings: DataFrame, as_of: Column) -> DataFrame:
    """Stock columns of an update; last_seen_in_stock only when in stock."""
    flag = F.coalesce(F.col("in_stock"), F.lit(False))
    return (
        listings.withColumn("in_stock", flag)
        .withColumn("stock_level", F.when(flag, "In Stock").otherwise("Out of Stock"))
        .withColumn("last_seen_in_stock", F.when(flag, as_of))
    )
