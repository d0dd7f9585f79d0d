"""End-to-end flows composed of the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farthing.functions import clock, prices, rules, text
from farthing.operators import changes, enrich, matching, pages, pool, retention, segments
from farthing.rulebook import categories, packs
from farthing.sources import sinks


def by_source(profiles: Sequence[tuple], at: int, made) -> Column:
    """``made(rule)`` with the rule of the row's source; the first profile stands for all others."""
    chain = F.when(F.lit(False), made(profiles[0][at]))
    for rule in dict.fromkeys(p[at] for p in profiles[1:]):
        chain = chain.when(F.col("source").isin([p[0] for p in profiles[1:] if p[at] == rule]), made(rule))
    return chain.otherwise(made(profiles[0][at]))


def ingest(cards: DataFrame, bounds: DataFrame, as_of: Column, profiles: Sequence[tuple] = packs.SOURCE_PROFILES) -> DataFrame:
    """Cards (source, retailer_id, seq, title, product_url, card_text,
    base_price, display_ppr) to listing rows ready for the upsert.

    ``profiles`` give each source its pack grammar, stock rule, house brand, default
    pack and country; the first one stands for sources without their own. Category from the title, attributes from title and url, unit price, price
    gate, first seen per product, stock and limit from the card's text.
    """
    cleaned = pool.title_over_category(cards, "retag", page_category="page_category")
    named = enrich.enrich_brand(cleaned, "title", "product_url")
    named = enrich.enrich_type(named, "title", "product_url")
    name, card = F.col("title"), F.col("card_text")
    low, card_low = F.col("_low"), F.col("_card_low")
    staged = named.withColumns({"_low": F.lower(text.filled(name)), "_card_low": F.lower(text.filled(card))})
    staged = staged.withColumns({"_folded": text.folded(name, low), "_card_folded": text.folded(card, card_low), "_has": rules.letters(low)})
    shaped = rules.settle(staged, {
        "total_rounds": by_source(profiles, 4, lambda rule: text.pack_count(name, rule, F.col("_folded"))),
        "grain": text.weight_number(name),
        "case_material": text.case_material(name, low=low, has=F.col("_has")),
        "condition_type": text.condition(low),
        "country_of_origin": text.origin_country(name, low=low, has=F.col("_has")),
        "retailer_product_id": text.product_key(F.col("product_url")),
        "purchase_limit": text.purchase_limit(card, F.col("_card_folded")),
        "in_stock": by_source(profiles, 5, lambda rule: text.stock_from_text(card, rule, low=card_low)),
    }, apart=True).drop("_low", "_folded", "_card_low", "_card_folded", "_has")
    shaped = enrich.source_defaults(shaped, profiles)
    priced = enrich.derive_unit_price(shaped)
    gated = enrich.gated_prices(priced, bounds).where(F.col("gate_reason") == "ok")
    fresh = matching.first_seen(gated.where(F.col("retailer_product_id").isNotNull()),
                                ["retailer_id", "retailer_product_id"], "seq")
    stamped = changes.stock_stamps(fresh, as_of)
    flagged = stamped.withColumn(
        "is_component", text.component_flag(F.col("product_url"), F.col("total_rounds"), F.col("manufacturer"))
    )
    return flagged.withColumn("last_updated", as_of).drop("lo", "hi", "gate_reason")


def observations_to_write(listings: DataFrame, as_of: Column) -> DataFrame:
    """History rows of freshly stored listings, each under an id of its own."""
    return listings.where(prices.positive(F.col("price_per_round"))).select(
        F.xxhash64(F.col("id"), as_of).alias("id"), F.col("id").alias("listing_id"), F.col("base_price").alias("price"), "price_per_round",
        "in_stock", as_of.alias("recorded_at"),
    )


def refresh_segment_cache(
    history: DataFrame, listings: DataFrame, floors: DataFrame | None, since: Column, as_of: Column, target: str,
    first: bool = False,
) -> int:
    """Segment floors into their materialised table; returns the row count.

    Without ``floors`` those of the tracked catalogue hold.
    """
    if floors is None:
        floors = pool.small_table(history.sparkSession, categories.SEGMENT_FLOORS, "category string, floor double")
    return sinks.refresh_materialized(segments.segment_floor(history, listings, floors, since), target, as_of, first)


def recheck(listings: DataFrame, fetched: DataFrame, bounds: DataFrame, as_of: Column, excluded=()) -> DataFrame:
    """Fetch results to reconciled outcomes."""
    return pages.reconcile_stock(listings, pages.recheck_decisions(fetched), as_of, bounds, excluded)


def _sound(plan: DataFrame, max_deletes: int | None, max_share: float) -> None:
    checks = retention.retention_invariants(plan, max_deletes, max_share).first().asDict()
    broken = {k: v for k, v in checks.items() if k not in ("examined", "deletes", "keeps", "orphans") and v}
    if broken:
        raise ValueError(f"retention plan rejected: {broken}")


def thin_history(
    history: DataFrame, listings: DataFrame, floors: DataFrame, as_of: str, path: str,
    max_share: float = retention.MAX_DELETE_SHARE, max_deletes: int | None = None, again: DataFrame | None = None,
) -> DataFrame:
    """Plan, check, persist and apply a retention run.

    Raises when an invariant is violated or the share (or, if given, the number) of
    deletes is out of band. Before anything goes, a second plan is made from
    ``again``, the history as it is read at that moment (``history`` if not given), and must
    equal the persisted set.
    """
    plan = retention.retention_plan(history, listings, floors, as_of)
    _sound(plan, max_deletes, max_share)
    sinks.write_delete_set(retention.delete_ids(plan), path)
    now = history if again is None else again
    return sinks.execute_delete_set(now, retention.retention_plan(now, listings, floors, as_of), path)


def thin_days(
    stored: str, listings: DataFrame, floors: DataFrame, as_of: str, path: str, retention_days: int = 30, expiry_days: int = 90,
    max_share: float = retention.MAX_DELETE_SHARE, max_deletes: int | None = None,
) -> list[str]:
    """``thin_history`` of a history stored by day (``sinks.append_observations``); returns the days rewritten.

    Days after the cut-off are neither read nor written, and of the older ones only those with
    deletes are replaced. The second plan is made from the files as they are then.
    """
    spark = listings.sparkSession
    cutoff = clock.from_micros(F.lit(clock.literal_micros(as_of) - retention_days * clock.DAY)).cast("date")

    def plan() -> DataFrame:
        old = spark.read.parquet(stored).where(F.col("day") < cutoff)
        return retention.retention_plan(old, listings, floors, as_of, retention_days, expiry_days)

    first = plan()
    _sound(first, max_deletes, max_share)
    sinks.write_delete_set(retention.delete_ids(first, "day"), path)
    saved = spark.read.parquet(path)
    if not retention.plan_difference(retention.delete_ids(plan()), saved).isEmpty():
        raise ValueError(f"the plan no longer matches the delete set at {path}")
    return sinks.delete_from_days(saved.select("id", F.date_from_unix_date(F.col("day").cast("int")).alias("day")), stored)
