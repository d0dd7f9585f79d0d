"""Floor series over time: daily bins, right-closed bins, carry-forward."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farthing.functions import clock, prices
from farthing.operators import pool as pools
from farthing.operators.spread import HOT_ROWS, auto_slices, carry_forward, cheapest, running_sum


def latest_per(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key in the given ascending order.

    Combined map-side: each task ships one row per key.
    """
    spec = [F.col(c).desc() for c in order]
    return cheapest(df, keys, spec, 1).drop("_rank")


def _sliced(df: DataFrame, by: Sequence[str], order: Sequence[str], slice_of: Column | None, hot_rows: int) -> DataFrame:
    return auto_slices(df, by, order[0], "_slice", hot_rows) if slice_of is None else df.withColumn("_slice", slice_of)


def locf(
    df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, slice_of: Column | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Carry the last non-null value forward; rows before the first drop out.

    Keys above ``hot_rows`` rows are cut into slices along the first order
    column and scanned in parallel; ``slice_of`` (a coarser time, say) gives
    other slices.
    """
    sliced = _sliced(df, by, order, slice_of, hot_rows)
    filled = carry_forward(sliced, by, "_slice", order, F.col(value), "_filled", inclusive=True).drop("_slice")
    return filled.where(F.col("_filled").isNotNull()).withColumn(value, F.col("_filled")).drop("_filled")


def islands(
    df: DataFrame, by: Sequence[str], order: Sequence[str], starts: Column, name: str = "island",
    slice_of: Column | None = None, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Number of island starts so far, per key (slices as in ``locf``)."""
    step = F.when(starts, 1).otherwise(0)
    return running_sum(_sliced(df, by, order, slice_of, hot_rows), by, "_slice", order, step, name).drop("_slice")


def right_closed_bins(df: DataFrame, ts: str, origin: str, step: int, name: str = "bin") -> DataFrame:
    return df.withColumn(name, clock.right_closed_bin(F.col(ts), origin, step))


def bucket_floor_series(
    history: DataFrame,
    listings: DataFrame,
    as_of: str | datetime,
    series: Sequence[str] = ("caliber_normalized", "case_material"),
    keep: dict | None = None,
    days: int = 30,
    condition: str | None = "New",
    bucket_hours: int = 6,
    fresh_hours: int = 6,
    min_alive_fraction: float = 0.25,
    cheapest_n: int = 3,
    price_floor: float = 0.05,
    min_pool: int = 5,
    exclude_ids: Sequence[int] = (),
) -> DataFrame:
    """Floor per right-closed bucket with a liveness gate and carry-forward.

    Runs for every series (each category and case material, say) at once;
    ``keep`` narrows to single values. A listing counts in a bucket with its
    latest row; the bucket counts when at least max(3, ceil(pool × fraction))
    listings were seen; other buckets repeat the last counted floor; buckets
    before the first counted one and pools below ``min_pool`` are left out.
    """
    if fresh_hours != bucket_hours:
        raise ValueError(f"fresh_hours must equal bucket_hours (got {fresh_hours} and {bucket_hours})")
    moment = as_of if isinstance(as_of, datetime) else datetime.fromisoformat(as_of)
    end = moment.replace(minute=0, second=0, microsecond=0)
    span, step = days * clock.DAY, bucket_hours * clock.HOUR
    end_us = clock.literal_micros(end)
    start_us = end_us - span
    chosen = pools.optional_eq(listings, {**(keep or {}), "condition_type": condition}).where(F.col("in_stock"))
    chosen = pools.exclude_ids(chosen, list(exclude_ids))
    chosen = chosen.select(F.col("id").alias("listing_id"), *series)
    sizes = chosen.groupBy(*series).agg(F.count(F.lit(1)).alias("pool_size"))
    sizes = sizes.where(F.col("pool_size") >= min_pool)

    low = clock.from_micros(F.lit(start_us - step))
    facts = history.where(
        (F.col("recorded_at") > low)
        & (F.col("recorded_at") <= clock.from_micros(F.lit(end_us)))
        & (F.col("price_per_round") >= price_floor)
    ).select("id", "listing_id", "price_per_round", "recorded_at")
    # A bucket is numbered by its end: 0 is the grid start.
    offset = clock.micros(F.col("recorded_at")) - F.lit(start_us)
    rest = F.pmod(offset, F.lit(step))
    bucket = ((offset - rest) / F.lit(step)).cast("bigint") + F.when(rest == 0, 0).otherwise(1)
    # The history shrinks to one row per listing and bucket, combined in the scan, before
    # it meets the listings: a listing with very many rows is no large key of the join.
    latest = latest_per(facts.withColumn("bucket", bucket), ["listing_id", "bucket"], ["recorded_at", "id"])
    latest = latest.join(chosen, "listing_id").select(*series, "listing_id", "bucket", "price_per_round", "recorded_at", "id")
    alive = latest.groupBy(*series, "bucket").agg(F.count(F.lit(1)).alias("alive_count"))
    lows = cheapest(latest.select(*series, "bucket", "price_per_round"), [*series, "bucket"], ["price_per_round"],
                    cheapest_n)
    floors = lows.groupBy(*series, "bucket").agg(F.array_sort(F.collect_list("price_per_round")).alias("_lows"))
    floors = floors.select(*series, "bucket", prices.ordered_mean(F.col("_lows")).alias("_floor"))
    per_bucket = alive.join(floors, [*series, "bucket"])

    last_bucket = (end_us - start_us) // step
    grid = sizes.withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(last_bucket).cast("bigint"))))
    need = F.greatest(F.lit(3), F.ceil(F.col("pool_size") * F.lit(float(min_alive_fraction))))
    full = grid.join(per_bucket, [*series, "bucket"], "left").withColumn(
        "alive_count", F.coalesce("alive_count", F.lit(0).cast("bigint"))
    )
    gated = full.withColumn("floor_cpr", F.when(F.col("alive_count") >= need, F.col("_floor")))
    # The carry runs over the grid of one series, whose length is fixed by the window.
    carried = locf(gated, series, ["bucket"], "floor_cpr")
    stamp = clock.from_micros(F.lit(start_us) + F.col("bucket") * F.lit(step))
    return carried.select(*series, stamp.alias("day_bucket"), "floor_cpr", "alive_count", "pool_size")


def daily_floor_series(
    history: DataFrame,
    catalog: DataFrame,
    category: str,
    since: str | datetime,
    price_floor: float,
    hard_ceiling: float,
    as_of: str | datetime,
    until: str | datetime | None = None,
    price_mult: float = 1.0,
    split: str = "none",
    n: int = 3,
    **filters,
) -> DataFrame:
    """Mean of the ``n`` cheapest listings of each completed UTC day.

    A listing counts with its cheapest in-stock price of the day inside the
    price bounds; the multiplier (a tax, say) applies after the bounds. Days
    without observations stay absent, and the current day never appears.
    ``filters`` are those of ``pool.pool``.
    """
    if split not in ("none", "retailer", "condition"):
        raise ValueError(f"split must be none, retailer or condition, got {split!r}")
    if price_mult is None or price_mult <= 0:
        raise ValueError(f"price_mult must be above 0, got {price_mult!r}")
    bounds = pools.price_bounds(catalog, category, price_floor, hard_ceiling)
    chosen = pools.pool(catalog, category, **filters)
    key = {
        "none": F.lit(""),
        "retailer": F.col("retailer_id").cast("string"),
        "condition": F.coalesce(F.nullif(F.col("condition_type"), F.lit("")), F.lit("Unknown")),
    }[split]
    members = chosen.select(F.col("id").alias("listing_id"), key.alias("series_key"))
    sizes = members.groupBy("series_key").agg(F.count(F.lit(1)).cast("int").alias("pool_size"))
    if split == "retailer":
        members = members.where(F.col("series_key").isNotNull())

    today = clock.literal_micros(as_of) // clock.DAY
    price = F.col("price_per_round").cast("double")
    rows = history.where(F.col("in_stock") & (F.col("recorded_at") >= clock.instant(since)))
    if until is not None:
        rows = rows.where(F.col("recorded_at") <= clock.instant(until))
    # Today's start is a literal, so unfinished days are pruned by the scan.
    rows = rows.where(F.col("recorded_at") < clock.from_micros(F.lit(today * clock.DAY)))
    rows = rows.where(F.col("price_per_round").isNotNull() & (price >= float(price_floor)) & (price <= float(hard_ceiling)))
    rows = rows.select("listing_id", price.alias("_price"), clock.day_number(F.col("recorded_at")).alias("_day"))
    # The bounds are one aggregated row, so the history shrinks to one low per listing
    # and day, combined in the scan, before it meets the listings.
    kept = rows.crossJoin(F.broadcast(bounds))
    kept = kept.where((F.col("_price") >= F.col("lo")) & (F.col("_price") <= F.col("hi")))
    kept = kept.withColumn("_price", F.col("_price") * F.lit(float(price_mult))).where(F.col("_price") > 0)
    lows = kept.groupBy("listing_id", "_day").agg(F.min("_price").alias("_low")).join(members, "listing_id")
    top = cheapest(lows.select("series_key", "_day", "_low"), ["series_key", "_day"], ["_low"], n)
    means = top.groupBy("series_key", "_day").agg(F.array_sort(F.collect_list("_low")).alias("_lows"))
    return (
        means.join(sizes, "series_key", "left")
        .select(
            "series_key",
            clock.day_date(F.col("_day")).alias("day"),
            prices.ordered_mean(F.col("_lows")).alias("value"),
            F.coalesce("pool_size", F.lit(0)).alias("pool_size"),
        )
    )


def asof_latest(
    facts: DataFrame,
    by: Sequence[str],
    value: str,
    start: str | datetime,
    end: str | datetime,
    step: int,
    tolerance: int,
    ts: str = "recorded_at",
    tie: str = "id",
    min_value: float | None = None,
) -> DataFrame:
    """For each grid time t, the latest fact within [t - tolerance, t] by key.

    Each fact is copied to the grid points it covers (at most tolerance/step
    + 1 of them), which turns the range condition into grouping keys; only
    covered pairs are ever produced and they are combined map-side.
    """
    low, high = clock.literal_micros(start), clock.literal_micros(end)
    last = (high - low) // step
    rows = facts
    if min_value is not None:
        rows = rows.where(F.col(value) >= min_value)
    rows = rows.where(
        (F.col(ts) >= clock.from_micros(F.lit(low - tolerance))) & (F.col(ts) <= clock.from_micros(F.lit(high)))
    )
    offset = clock.micros(F.col(ts)) - F.lit(low)
    rest = F.pmod(offset, F.lit(step))
    first = ((offset - rest) / F.lit(step)).cast("bigint") + F.when(rest == 0, 0).otherwise(1)
    reach = offset + F.lit(tolerance)
    until = ((reach - F.pmod(reach, F.lit(step))) / F.lit(step)).cast("bigint")
    begin = F.greatest(first, F.lit(0).cast("bigint"))
    stop = F.least(until, F.lit(last).cast("bigint"))
    covered = F.when(begin <= stop, F.sequence(begin, stop, F.lit(1).cast("bigint")))
    spread = rows.select(*by, F.col(value).alias(value), F.col(ts).alias("_ts"), F.col(tie).alias("_tie"),
                         F.explode(covered).alias("_point"))
    picked = spread.groupBy("_point", *by).agg(F.max_by(value, F.struct("_ts", "_tie")).alias(value))
    return picked.select(clock.from_micros(F.lit(low) + F.col("_point") * F.lit(step)).alias("t"), *by, value)
