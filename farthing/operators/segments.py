"""Segment statistics over a window of price observations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farthing.functions import prices
from farthing.operators.spread import attach_facts, cheapest, join_facts
from farthing.operators.stats import interpolated_median

SEGMENT = ("caliber_normalized", "bullet_type", "case_material")


def observations(
    history: DataFrame,
    listings: DataFrame,
    since: Column,
    condition: str | None = "New",
    skip_components: bool = True,
    segment: Sequence[str] = SEGMENT,
) -> DataFrame:
    """Positive prices since a time with their listing's segment.

    The time bound is a literal, so it prunes the history scan; listings are
    reduced to id and segment before the join.
    """
    chosen = listings
    if condition is not None:
        chosen = chosen.where(F.col("condition_type") == condition)
    if skip_components:
        chosen = chosen.where(~F.col("is_component"))
    for name in segment:
        chosen = chosen.where(F.col(name).isNotNull())
    chosen = chosen.select(F.col("id").alias("listing_id"), *segment)
    facts = history.where((F.col("recorded_at") >= since) & prices.positive(F.col("price_per_round")))
    facts = facts.select("listing_id", F.col("price_per_round").cast("double").alias("ppr"))
    return join_facts(facts, chosen, "listing_id", "ppr")


def above_floor(
    observed: DataFrame, floors: DataFrame, default: float, category: str = SEGMENT[0], price: str = "ppr"
) -> DataFrame:
    """Prices at or above their category's floor, or the default floor."""
    table = floors.select(F.col(floors.columns[0]).alias("_cal"), F.col(floors.columns[1]).alias("_floor"))
    joined = observed.join(table, F.col(category) == F.col("_cal"), "left")
    return joined.where(F.col(price) >= F.coalesce("_floor", F.lit(default))).drop("_cal", "_floor")


def segment_floor(
    history: DataFrame,
    listings: DataFrame,
    floors: DataFrame,
    since: Column,
    condition: str | None = "New",
    min_listings: int = 5,
    full_n: int = 10,
    small_n: int = 3,
    full_threshold: int = 20,
    default_floor: float = 0.10,
    segment: Sequence[str] = SEGMENT,
) -> DataFrame:
    """Mean of the cheapest listings of every segment.

    A listing counts with its lowest price of the window. Deep segments
    average ``full_n`` listings, shallow ones ``small_n``; segments with fewer
    than ``min_listings`` are dropped.
    """
    seen = above_floor(observations(history, listings, since, condition, True, segment), floors, default_floor,
                       segment[0])
    lows = seen.groupBy("listing_id", *segment).agg(F.min("ppr").alias("low"))
    depth = lows.groupBy(*segment).agg(F.count(F.lit(1)).cast("int").alias("listing_count"))
    depth = depth.where(F.col("listing_count") >= min_listings)
    top = cheapest(lows.select(*segment, "low"), segment, ["low"], max(full_n, small_n))
    arrays = top.groupBy(*segment).agg(F.array_sort(F.collect_list("low")).alias("_lows"))
    wanted = F.when(F.col("listing_count") >= full_threshold, full_n).otherwise(small_n)
    return depth.join(arrays, list(segment)).select(
        *segment, prices.ordered_mean(F.slice("_lows", F.lit(1), wanted)).alias("segment_floor"), "listing_count"
    )


def segment_trimmed_mean(
    history: DataFrame,
    listings: DataFrame,
    since: Column,
    condition: str | None = "New",
    mult: float = 5.0,
    segment: Sequence[str] = SEGMENT,
) -> DataFrame:
    """Mean of the prices within [median / mult, median * mult]."""
    seen = observations(history, listings, since, condition, False, segment)
    # Counted by distinct price once: the median and the mean both read this
    # one shuffle, which spreads a hot segment by its prices.
    counted = seen.groupBy(*segment, "ppr").agg(F.count(F.lit(1)).alias("_times"))
    middle = interpolated_median(counted, segment, "ppr", weight="_times")
    joined = attach_facts(counted, middle, list(segment), "n", "ppr")
    inside = F.col("ppr").between(F.col("median") / mult, F.col("median") * mult)
    # Exact decimals: the sum is the same in any order of the rows.
    part = F.when(inside, (F.col("ppr") * F.col("_times")).cast("decimal(38,12)"))
    return joined.groupBy(*segment, "median").agg(
        (F.sum(part).cast("double") / F.sum(F.when(inside, F.col("_times")))).alias("segment_avg"),
        F.sum("_times").alias("row_count"),
    )
