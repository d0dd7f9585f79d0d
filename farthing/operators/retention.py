"""Thinning of old price history: plan, invariants, exact application."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farthing.functions import clock, prices
from farthing.operators.spread import HOT_ROWS, attach_facts, join_facts

MAX_DELETE_SHARE = 0.35


def retention_plan(
    history: DataFrame,
    listings: DataFrame,
    floors: DataFrame,
    as_of: str | datetime,
    retention_days: int = 30,
    expiry_days: int = 90,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Old rows tagged keep, tier1 (redundant), tier2 (expired) or orphan.

    Only whole UTC days before ``as_of`` less ``retention_days`` are touched; an open
    day stays as it is. Per listing and day the cheapest eligible row stays and, if another,
    the cheapest at or above the category's floor. Without an eligible row the
    last row stays as a marker, unless the day is past ``expiry_days`` and
    was never in stock; then all its rows expire. Ties: price, time, id.
    """
    now = clock.literal_micros(as_of)
    cutoff = clock.from_micros(F.lit((now - retention_days * clock.DAY) // clock.DAY * clock.DAY))
    expiry_day = (now - expiry_days * clock.DAY) // clock.DAY
    price = F.col("price_per_round").cast("double")
    old = history.where(F.col("recorded_at") < cutoff).select(
        "id", "listing_id", "price_per_round", "in_stock", "recorded_at"
    )
    floor_of = floors.select(F.col(floors.columns[0]).alias("_cal"), F.col(floors.columns[1]).alias("_floor"))
    known = listings.select(F.col("id").alias("_lid"), F.col("caliber_normalized").alias("_cal")).join(
        floor_of, "_cal", "left"
    )
    known = known.select("_lid", F.coalesce("_floor", F.lit(0.0)).alias("_floor"))
    known = known.withColumn("listing_id", F.col("_lid"))
    staged = (
        join_facts(old, known, "listing_id", "id", hot_rows, "left")
        .withColumn("day", clock.day_number(F.col("recorded_at")))
        .withColumn("_ok", F.coalesce(F.col("in_stock"), F.lit(False)) & prices.positive(price, finite=True))
    )
    rank = F.struct(price.alias("p"), F.col("recorded_at").alias("ts"), F.col("id").alias("id"))
    facts = staged.groupBy("listing_id", "day").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.min(F.when(F.col("_ok"), rank)).alias("_best"),
        F.min(F.when(F.col("_ok") & (price >= F.col("_floor")), rank)).alias("_above"),
        F.max(F.struct(F.col("recorded_at").alias("ts"), F.col("id").alias("id"))).alias("_marker"),
        F.max(F.coalesce(F.col("in_stock"), F.lit(False)).cast("int")).alias("_seen"),
    )
    facts = facts.select(
        "listing_id",
        "day",
        "_rows",
        F.col("_best.id").alias("_best_id"),
        F.col("_above.id").alias("_above_id"),
        F.col("_marker.id").alias("_marker_id"),
        "_seen",
    )
    known = F.col("_lid").isNotNull().alias("_known")
    rows = staged.select("id", "listing_id", "day", "price_per_round", "in_stock", "recorded_at", "_ok", known)
    full = attach_facts(rows, facts, ["listing_id", "day"], "_rows", "id", hot_rows)
    kept = (F.col("id") == F.col("_best_id")) | (F.col("id") == F.coalesce("_above_id", "_best_id"))
    expired = (F.col("day") < F.lit(expiry_day)) & (F.col("_seen") == 0)
    action = (
        F.when(~F.col("_known"), "orphan")
        .when(F.col("_best_id").isNotNull(), F.when(kept, "keep").otherwise("tier1"))
        .when(expired, "tier2")
        .otherwise(F.when(F.col("id") == F.col("_marker_id"), "keep").otherwise("tier1"))
    )
    columns = ["id", "listing_id", "day", "price_per_round", "in_stock", "recorded_at"]
    return full.select(*columns, (F.col("_ok") & F.col("_known")).alias("eligible"), action.alias("action"))


def retention_invariants(
    plan: DataFrame, max_deletes: int | None = None, max_share: float = MAX_DELETE_SHARE
) -> DataFrame:
    """One row of violation counts; a sound plan has zero in each.

    The share of deletes is the guard at any size; ``max_deletes`` adds an absolute one.
    """
    keep, orphan = F.col("action") == "keep", F.col("action") == "orphan"
    tier1, tier2 = F.col("action") == "tier1", F.col("action") == "tier2"
    price = F.col("price_per_round").cast("double")
    stocked = F.coalesce(F.col("in_stock"), F.lit(False))
    groups = plan.groupBy("listing_id", "day").agg(
        F.count(F.lit(1)).alias("examined"),
        F.count_if(tier1 | tier2).alias("deletes"),
        F.count_if(keep).alias("keeps"),
        F.count_if(orphan).alias("orphans"),
        F.count_if(tier2 & stocked).alias("expired"),
        F.count_if(F.col("eligible")).alias("able"),
        F.min(F.when(F.col("eligible"), price)).alias("group_min"),
        F.min(F.when(F.col("eligible") & keep, price)).alias("kept_min"),
    )
    able = F.col("able") > 0
    checks = [
        *[F.sum(n).alias(n) for n in ("examined", "deletes", "keeps", "orphans")],
        F.sum("expired").alias("expired_in_stock"),
        F.count_if(able & ~F.col("keeps").between(1, 2)).alias("eligible_keep_count"),
        F.count_if(~able & (F.col("keeps") > 1)).alias("marker_keep_count"),
        F.count_if(able & ~F.col("kept_min").eqNullSafe(F.col("group_min"))).alias("group_min_lost"),
    ]
    twice = plan.groupBy("id").agg(F.count(F.lit(1)).alias("_times")).where(F.col("_times") > 1)
    overlap = twice.agg(F.count(F.lit(1)).alias("id_in_two_tiers"))
    # Two one-row results become one row by a union and a maximum per column.
    both = groups.agg(*checks).unionByName(overlap, allowMissingColumns=True)
    names = [*groups.agg(*checks).columns, "id_in_two_tiers"]
    one = both.agg(*[F.coalesce(F.max(n), F.lit(0)).alias(n) for n in names])
    unaccounted = F.abs(F.col("examined") - F.col("deletes") - F.col("keeps") - F.col("orphans"))
    share = F.try_divide(F.col("deletes"), F.col("examined"))
    over = F.coalesce(share, F.lit(0.0)) > max_share
    if max_deletes is not None:
        over = over | (F.col("deletes") > max_deletes)
    return one.select(
        "examined", "deletes", "keeps", "orphans", "id_in_two_tiers", "expired_in_stock", "eligible_keep_count",
        "marker_keep_count", "group_min_lost", unaccounted.alias("unaccounted"), over.cast("int").alias("over_band"),
    )


def delete_ids(plan: DataFrame, *more: str) -> DataFrame:
    """(id, action) of the rows that go, and further columns of the plan."""
    return plan.where(F.col("action").isin("tier1", "tier2")).select("id", "action", *more)


def plan_difference(planned: DataFrame, written: DataFrame) -> DataFrame:
    """Ids whose tier differs between the fresh plan and the persisted set."""
    left = planned.select("id", F.col("action").alias("planned"))
    right = written.select("id", F.col("action").alias("written"))
    return left.join(right, "id", "full").where(~F.col("planned").eqNullSafe(F.col("written")))


def apply_deletes(history: DataFrame, ids: DataFrame) -> DataFrame:
    return history.join(ids.select("id"), "id", "left_anti")
