"""The registered queries: every operator over the supplied tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farthing.functions import clock, markup, predicates, prices, rules, text
from farthing.operators import audit, changes, enrich, matching, pages, pool, retention, segments, series, spread, stats, substring
from farthing.plans import flows, sql_series, sql_surface
from farthing.plans.fixtures import table, view
from farthing.rulebook import brands, categories, packs
from farthing.sources import scratch, sinks, tables
from farthing.streaming import store_on_change as stream

AS_OF = "2024-01-31 00:00:00"
# A retention run in the middle of a day: the checks count whole days only.
RETENTION_AS_OF = "2024-01-31 13:45:00"
SEGMENT_SINCE = "1999-01-01 00:00:00"
FLOORS = [("ECONOMY", 60.0), ("PROMO", 45.0), ("SMALL", 80.0), ("MEDIUM", 55.0)]
OBS_FLOORS = [("ECONOMY", 5.0), ("PROMO", 20.0), ("SMALL", 1.0)]
BRAND = ("Brand#7", ["brand#7", "brand seven"], ["brand#7", "brand seven", "brand#9"], ["bolt", "Brand#7", "gear"])
URL_BRANDS = ["brand2", "brand7", "brand1"]
THRESHOLDS = [(1, 40.0), (2, 0.0), (3, 250.0), (4, 900.0), (6, 20.0), (7, 60.0)]
ATOMS = [("lt", 12.0), ("eq", 25.0), ("gt", 40.0)]
BOUNDS = [("ECONOMY", 0.5, 3.0), ("PROMO", 1.0, 20.0), ("SMALL", 2.0, 9.0), ("LARGE", 8.0, 9.0)]
EXPECTED = [("9mm", 0.15, 0.80), ("22lr", 0.05, 0.30), ("308win", 0.5, 3.0)]

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(func: Query) -> Query:
    REGISTRY[func.__name__] = func
    return func


def rows(spark: SparkSession, data: list[tuple], schema: str) -> DataFrame:
    """A rule table of the caller's own literal rows."""
    return pool.small_table(spark, data, schema)


def floors(spark: SparkSession, data=FLOORS) -> DataFrame:
    return rows(spark, data, "category string, floor double")


def _dates_as_text(df: DataFrame) -> DataFrame:
    """Dates as ISO text, which every engine prints alike."""
    return df.select(*[F.col(n).cast("string") if t == "date" else F.col(n) for n, t in df.dtypes])


def catalog(spark: SparkSession, d: str) -> DataFrame:
    return pool.capped_catalog(view(spark, d, "v_listings"), mult=3.0)


# -- sources ---------------------------------------------------------------------

@query
def read_tables(spark, d):
    loaded = tables.read_tables(spark, d, ["region", "nation"])
    joined = loaded["nation"].join(loaded["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.groupBy("r_name").agg(F.count(F.lit(1)).alias("nations"))


@query
def incremental_read(spark, d):
    return tables.incremental_read(
        table(spark, d, "events"), clock.instant("2024-01-20 00:00:00"), ["event_id", "user_id", "value"], "ts"
    )


@query
def keyset_slice(spark, d):
    return tables.keyset_slice(table(spark, d, "events"), 500, 100, "event_id").select("event_id", "user_id", "value")


@query
def content_hash(spark, d):
    return table(spark, d, "pages").select("page_id", sinks.content_hash(F.col("html")).alias("html_hash"))


@query
def upsert_merge(spark, d):
    listings = view(spark, d, "v_listings").select("id", "retailer_id", "base_price", "in_stock", "last_updated")
    target = listings.where(F.col("id") % 3 != 1)
    seen = F.when(F.col("id") % 2 == 0, F.col("last_updated"))
    updates = listings.where(F.col("id") % 5 == 0).select(
        "id", (F.col("base_price") * 2).alias("base_price"), seen.alias("last_updated"), F.lit(2).alias("seq")
    )
    # Every third of them was updated before, and some name no row.
    older = updates.where(F.col("id") % 3 == 0).withColumns({"base_price": F.lit(0.5), "seq": F.lit(1)})
    nameless = updates.where(F.col("id") % 7 == 0).withColumn("id", F.lit(None).cast("bigint"))
    return sinks.upsert(target, updates.unionByName(older).unionByName(nameless), ["id"], sparse=["last_updated"], order=["seq"])


@query
def upsert_buckets(spark, d):
    """The same updates as a table in buckets takes them, read back from storage."""
    listings = view(spark, d, "v_listings").select("id", "retailer_id", "base_price", "in_stock", "last_updated")
    path = scratch.new_folder(spark, "buckets")
    sinks.create_buckets(listings.where(F.col("id") % 3 != 1), path, ["id"], 32)
    seen = F.when(F.col("id") % 2 == 0, F.col("last_updated"))
    updates = listings.where(F.col("id") % 5 == 0).select("id", (F.col("base_price") * 2).alias("base_price"), seen.alias("last_updated"), F.lit(2).alias("seq"))
    older = updates.where(F.col("id") % 3 == 0).withColumns({"base_price": F.lit(0.5), "seq": F.lit(1)})
    sinks.upsert_buckets(updates.unionByName(older), path, ["id"], 32, ["seq"], sparse=["last_updated"])
    return spark.read.parquet(path).drop("bucket")


@query
def read_bounds(spark, d):
    """Bounds per category as a registry document, read back and met with the listings."""
    path = scratch.new_folder(spark, "bounds")
    found = view(spark, d, "v_listings").groupBy("caliber_normalized").agg(
        F.round(F.min("price_per_round") * 1.5, 4).alias("lo"), F.round(F.max("price_per_round") * 0.8, 4).alias("hi"))
    entry = F.struct(F.col("caliber_normalized").alias("slug"), F.struct("lo", "hi").alias("bounds"))
    found.agg(F.to_json(F.struct(F.collect_list(entry).alias("calibers"))).alias("value")).coalesce(1).write.text(path)
    inside = F.col("price_per_round").between(F.col("lo"), F.col("hi"))
    met = view(spark, d, "v_listings").join(tables.read_bounds(spark, path), F.col("caliber_normalized") == F.col("category"))
    return met.groupBy("category", "lo", "hi").agg(F.count_if(inside).alias("inside"), F.count(F.lit(1)).alias("n"))


@query
def read_telemetry(spark, d):
    """Run records of every event as JSON lines, every 17th of them cut short, read back and counted."""
    path = scratch.new_folder(spark, "telemetry")
    record = F.to_json(F.struct(
        F.col("ts").cast("string").alias("timestamp"), F.concat(F.lit("r"), F.col("user_id") % 7).alias("retailer"), F.col("event_type").alias("verdict"),
        (F.col("event_id") % 3 * 100 + 200).cast("int").alias("status"), (F.col("user_id") % 11).alias("n_products")))
    line = F.when(F.col("event_id") % 17 == 0, F.substring(record, 1, 20)).when(F.col("event_id") % 19 == 0, F.lit(" ")).otherwise(record)
    table(spark, d, "events").select(line.alias("value")).write.text(path)
    good, bad = tables.read_telemetry(spark, path)
    told = good.groupBy("retailer", "verdict").agg(F.count(F.lit(1)).alias("n"), F.sum("n_products").alias("products"), F.max("status").alias("status"))
    lost = bad.agg(F.lit("unreadable").alias("retailer"), F.sum("bad_lines").alias("n"))
    return told.unionByName(lost, allowMissingColumns=True)


@query
def append_observations(spark, d):
    """Two appends to a history stored by day, read back by day."""
    path, obs = scratch.new_folder(spark, "history"), view(spark, d, "v_obs")
    for part in (0, 1):
        sinks.append_observations(obs.where(F.col("id") % 2 == part), path)
    back = spark.read.parquet(path).groupBy(F.col("day").cast("string").alias("day"))
    return back.agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"), F.count_if("in_stock").alias("stocked"))


@query
def append_jsonl(spark, d):
    path, obs = scratch.new_folder(spark, "lines"), view(spark, d, "v_obs").select("id", "listing_id", "price", "in_stock")
    for part in (0, 1):
        sinks.append_jsonl(obs.where(F.col("id") % 2 == part), path)
    return spark.read.schema(obs.schema).json(path).groupBy("listing_id").agg(F.count(F.lit(1)).alias("n"), F.max("price").alias("highest"))


@query
def refresh_materialized(spark, d):
    """Two refreshes of a cached table: both versions, as readers see them."""
    target = scratch.new_folder(spark, "cache")
    listings = view(spark, d, "v_listings")
    for n, part in enumerate((listings.where("in_stock"), listings)):
        counted = part.groupBy("caliber_normalized").agg(F.count(F.lit(1)).alias("n"), F.min("price_per_round").alias("lowest"))
        sinks.refresh_materialized(counted, target, clock.instant(AS_OF), first=n == 0)
    both = [sinks.read_materialized(spark, target, v).withColumn("version", F.lit(v or 2)) for v in (1, None)]
    return both[0].unionByName(both[1])


@query
def thin_days(spark, d):
    """A history stored by day, thinned in place."""
    path, plan = scratch.new_folder(spark, "history"), scratch.new_folder(spark, "deletes")
    sinks.append_observations(view(spark, d, "v_obs"), path)
    flows.thin_days(path, view(spark, d, "v_listings"), floors(spark, OBS_FLOORS), RETENTION_AS_OF, plan, 10, 20, max_share=1.0)
    return spark.read.parquet(path).groupBy("listing_id").agg(F.count(F.lit(1)).alias("n"))


@query
def write_delete_set(spark, d):
    plan = retention.retention_plan(
        view(spark, d, "v_obs"), view(spark, d, "v_listings"), floors(spark, OBS_FLOORS), RETENTION_AS_OF, 10, 20
    )
    return sinks.write_delete_set(retention.delete_ids(plan), scratch.new_folder(spark, "deletes"))


@query
def replace_children(spark, d):
    old = view(spark, d, "v_eligible").select("rebate_id", "product_line", "amount_override")
    touched = old.where(F.col("rebate_id") % 4 == 0).select("rebate_id")
    fresh = old.where(F.col("rebate_id") % 8 == 0).select(
        "rebate_id", F.upper("product_line").alias("product_line"), F.lit(1.0).alias("amount_override")
    )
    return sinks.replace_children(old, touched, fresh, "rebate_id")


# -- filters ----------------------------------------------------------------------

@query
def optional_eq(spark, d):
    out = pool.optional_eq(view(spark, d, "v_listings"), {"caliber_normalized": "PROMO", "condition_type": "New",
                                                          "retailer_id": None})
    return pool.exclude_components(pool.positive_price(out)).select("id", "price_per_round")


@query
def exclude_ids(spark, d):
    banned = view(spark, d, "v_listings").where(F.col("id") % 7 == 0).select("id")
    literal = pool.exclude_ids(view(spark, d, "v_listings"), [1, 2, 3, 4, 5])
    return pool.exclude_ids(literal, banned).select("id")


@query
def bucket_match(spark, d):
    weight = F.col("grain")
    return view(spark, d, "v_listings").select(
        "id",
        predicates.bucket_match(weight, ATOMS).alias("named_bucket"),
        predicates.bucket_match(weight, ATOMS, True).alias("other_bucket"),
        predicates.bucket_match(F.nullif(weight, F.lit(7)), ATOMS, True).alias("null_weight"),
        predicates.bucket_match(F.when(weight == 9, F.lit(float("nan"))).otherwise(weight), ATOMS, True).alias("nan_weight"),
    )


@query
def brand_match(spark, d):
    brand = ("brand7", ["brand#7"], ["brand#7", "brand#9"], URL_BRANDS)
    return view(spark, d, "v_listings").select(
        "id", predicates.brand_match(F.col("manufacturer"), F.col("product_url"), *brand).alias("is_brand")
    )


@query
def free_shipping(spark, d):
    return pool.free_shipping(view(spark, d, "v_listings"), THRESHOLDS, 200).select("id", "retailer_id")


@query
def pool_filter(spark, d):
    return pool.pool(
        catalog(spark, d), "PROMO", condition="New", weight_atoms=ATOMS, weight_negate=True, thresholds=THRESHOLDS,
        target=0,
    ).select("id", "retailer_id", "grain", "price_per_round")


@query
def stale_in_stock(spark, d):
    return pool.stale_in_stock(view(spark, d, "v_listings"), clock.instant(AS_OF), 48).select("id", "last_updated")


@query
def active_window(spark, d):
    offers = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), F.to_date("o_orderdate").alias("valid_through"),
        F.date_add(F.to_date("o_orderdate"), 10).alias("submit_by"),
        F.expr("o_orderdate - INTERVAL '100' DAY").alias("last_seen_active_at"),
    )
    return _dates_as_text(pool.active_window(offers, clock.instant("1998-06-01 12:00:00"), 24 * 30))


@query
def title_filter(spark, d):
    return pool.title_filter(view(spark, d, "v_titles"), "gold|bronze").groupBy("title").agg(F.count(F.lit(1)).alias("n"))


@query
def accessory_blocklist(spark, d):
    kept = pool.accessory_blocklist(view(spark, d, "v_titles"), ["core", "limit 2"], ["-vmax", "magtech-"])
    return kept.groupBy("title").agg(F.count(F.lit(1)).alias("n"))


@query
def promo_filter(spark, d):
    return pool.promo_filter(view(spark, d, "v_titles"), "/wolf-").groupBy("retailer_id").agg(F.count(F.lit(1)).alias("n"))


@query
def slug_conflict(spark, d):
    tagged = enrich.enrich_category(view(spark, d, "v_titles"))
    rules_ = [("9mm", r"wolf-9mm"), ("270win", r"\bfmj\b"), ("308win", r"\bacme\b")]
    odd = tagged.withColumn("title", F.regexp_replace("title", "FMJ|Acme", ""))
    return pool.slug_conflict(odd, rules_).groupBy("caliber_normalized").agg(F.count(F.lit(1)).alias("n"))


def _by_mode(spark, d, mode, dual=()):
    out = pool.title_over_category(view(spark, d, "v_titles"), mode, dual=dual)
    return out.groupBy("page_category", "caliber_normalized").agg(F.count(F.lit(1)).alias("n"))


@query
def title_retag(spark, d):
    return _by_mode(spark, d, "retag", ("38spl", "357mag"))


@query
def title_strict(spark, d):
    return _by_mode(spark, d, "strict")


@query
def title_lenient(spark, d):
    return _by_mode(spark, d, "lenient")


@query
def constraint_audit(spark, d):
    t = view(spark, d, "v_listings")
    checks = {
        "price_positive": F.col("price_per_round") > 0, "pack_at_least_50": F.col("total_rounds") >= 50,
        "known_condition": F.col("condition_type").isin("New"), "maker_present": F.col("manufacturer").isNotNull(),
        "url_length": F.length("product_url") <= 55,
    }
    return audit.constraint_audit(t, checks, [["retailer_product_id"], ["retailer_id", "grain", "manufacturer"]])


# -- price integrity ----------------------------------------------------------------

def _capture_bounds(spark):
    return (
        rows(spark, categories.CAPTURE_BOUNDS, "category string, lo double, hi double"),
        rows(spark, list(categories.LOOSE_CATEGORY_KEYS.items()), "name string, category string"),
    )


@query
def price_gate(spark, d):
    bounds, loose = _capture_bounds(spark)
    return enrich.gated_prices(view(spark, d, "v_gate"), bounds, loose).groupBy(
        "caliber_normalized", "gate_reason", "lo", "hi").agg(F.count(F.lit(1)).alias("n"))


@query
def derive_unit_price(spark, d):
    out = enrich.derive_unit_price(view(spark, d, "v_gate"))
    return out.groupBy("total_rounds").agg(
        F.count(F.lit(1)).alias("n"), F.min("price_per_round").alias("lowest"), F.max("price_per_round").alias("highest")
    )


@query
def derive_minimum_two(spark, d):
    out = enrich.derive_unit_price(view(spark, d, "v_gate"), "keep", 2)
    return out.groupBy("total_rounds").agg(
        F.count(F.lit(1)).alias("n"), F.min("price_per_round").alias("lowest"), F.max("price_per_round").alias("highest")
    )


def _products(spark, d):
    """Orders as products whose lines are variants."""
    lines = table(spark, d, "lineitem").select(
        "l_orderkey",
        F.struct(
            F.col("l_linenumber").alias("seq"), F.col("l_partkey").alias("pk"), F.col("l_extendedprice").alias("xp"),
            F.when(F.col("l_partkey") % 3 == 0, F.col("l_quantity").cast("int").cast("string")).alias("option1"),
            F.concat(F.lit("Pack "), (F.col("l_partkey") % 60).cast("string")).alias("title"),
            F.concat(F.lit("S-"), F.col("l_suppkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("sku"),
            F.when(F.col("l_partkey") % 7 == 0, F.lit("0")).otherwise(F.col("l_extendedprice").cast("decimal(18,2)").cast("string")).alias("price"),
            (F.col("l_returnflag") != "R").alias("available"), F.col("l_partkey").alias("id"),
        ).alias("v"),
    )
    return lines.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("v")).alias("variants")).select(
        F.col("l_orderkey").cast("string").alias("handle"), "variants"
    )


@query
def variant_pick(spark, d):
    return enrich.pick_variant(_products(spark, d))


@query
def variant_first(spark, d):
    return enrich.pick_variant(_products(spark, d), mode="first")


@query
def variant_each(spark, d):
    long = _products(spark, d).withColumn("handle", F.concat(F.repeat(F.lit("h"), 100), "handle"))
    return enrich.pick_variant(long, mode="each")


@query
def category_audit(spark, d):
    expected = rows(spark, EXPECTED, "category string, lo double, hi double")
    out = audit.category_audit(view(spark, d, "v_gate"), expected)
    return out.withColumn("avg_price", F.round("avg_price", 6))


@query
def over_ceiling(spark, d):
    bounds = rows(spark, [("ECONOMY", 1.0, 20000.0), ("PROMO", 1.0, 9000.0)], "category string, lo double, hi double")
    hits = audit.over_ceiling(view(spark, d, "v_history"), view(spark, d, "v_listings"), bounds, (0.15, 30000.0))
    return audit.over_ceiling_report(hits)[0]


@query
def over_ceiling_samples(spark, d):
    bounds = rows(spark, [("ECONOMY", 1.0, 100.0), ("PROMO", 1.0, 200.0)], "category string, lo double, hi double")
    hits = audit.over_ceiling(view(spark, d, "v_obs"), view(spark, d, "v_listings"), bounds, (0.15, 150.0))
    return audit.over_ceiling_report(hits)[1].select("category", "id", "listing_id", "price_per_round")


# -- joins ------------------------------------------------------------------------------

@query
def history_join(spark, d):
    joined = view(spark, d, "v_history").join(
        view(spark, d, "v_listings").select(F.col("id").alias("listing_id"), "caliber_normalized"), "listing_id"
    )
    return joined.groupBy("caliber_normalized").agg(F.count(F.lit(1)).alias("n"), F.min("price_per_round").alias("lowest"))


@query
def above_floor(spark, d):
    seen = segments.observations(view(spark, d, "v_history"), view(spark, d, "v_listings"), clock.instant(SEGMENT_SINCE))
    kept = segments.above_floor(seen, floors(spark, [("ECONOMY", 5000.0), ("PROMO", 300.0)]), 1000.0)
    return kept.groupBy("caliber_normalized").agg(F.count(F.lit(1)).alias("n"), F.min("ppr").alias("lowest"))


@query
def pool_members(spark, d):
    chosen = pool.optional_eq(view(spark, d, "v_listings"), {"caliber_normalized": "PROMO"})
    return matching.members_only(view(spark, d, "v_obs"), chosen).select("id", "listing_id")


@query
def orphans(spark, d):
    known = view(spark, d, "v_listings").where(F.col("id") % 6 != 0)
    return matching.orphans(view(spark, d, "v_obs"), known).select("id", "listing_id")


@query
def asof_latest(spark, d):
    facts = view(spark, d, "v_obs")
    return series.asof_latest(
        facts, ["listing_id"], "price_per_round", "2024-01-10 00:00:00", "2024-01-20 00:00:00", 12 * clock.HOUR,
        30 * clock.HOUR, min_value=5.0,
    )


@query
def lateral_top1(spark, d):
    bounds = rows(spark, BOUNDS, "cal string, lo double, hi double")
    return matching.lateral_top1(bounds, view(spark, d, "v_listings"), "bolt").select(
        "cal", "id", "price_per_round", "retailer_id"
    )


@query
def keyword_match_best(spark, d):
    classes = {"small": ["SMALL", "ECONOMY", "PROMO"], "big": ["LARGE", "MEDIUM", "STANDARD"]}
    return matching.keyword_match_best(
        view(spark, d, "v_rebates"), view(spark, d, "v_eligible"), view(spark, d, "v_listings"), classes
    )


@query
def substring_index(spark, d):
    """Urls of a category's listings with the names and numbers of all its parts that they contain, by trigrams."""
    listings = view(spark, d, "v_listings").select("id", "caliber_normalized", "product_url")
    part = table(spark, d, "part")
    words = part.select(F.col("p_type").alias("caliber_normalized"), F.explode(F.array(
        F.split_part(F.col("p_name"), F.lit(" "), F.lit(1)), F.replace("p_name", F.lit(" "), F.lit("-")),
        F.concat(F.lit("-"), F.col("p_partkey").cast("string")))).alias("word")).distinct()
    met = substring.containing(listings, words, ["caliber_normalized"], "product_url", "word", "id", few=8)
    return met.groupBy("caliber_normalized", "word").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"))


@query
def rebate_amounts(spark, d):
    classes = {"small": ["SMALL", "ECONOMY", "PROMO"], "big": ["LARGE", "MEDIUM", "STANDARD"]}
    matches = matching.keyword_match_best(
        view(spark, d, "v_rebates"), view(spark, d, "v_eligible"), view(spark, d, "v_listings"), classes
    )
    return matching.amount_rollup(matches)


@query
def match_counts(spark, d):
    classes = {"small": ["SMALL", "ECONOMY", "PROMO"], "big": ["LARGE", "MEDIUM", "STANDARD"]}
    matches = matching.keyword_match_best(
        view(spark, d, "v_rebates"), view(spark, d, "v_eligible"), view(spark, d, "v_listings"), classes
    )
    return matching.match_counts(matches)


BRAND_ALIASES = {"Brand#4": ["Brand#4", "Brand#5"]}
TYPE_ALIASES = {"RED": ["RED", "BLUE"]}


@query
def alias_join(spark, d):
    return matching.alias_join(view(spark, d, "v_spec"), view(spark, d, "v_listings"), BRAND_ALIASES, TYPE_ALIASES)


def _wide_spec(spark, d):
    """Specifications reduced to fewer keys, so that keys collide."""
    return view(spark, d, "v_spec").withColumn("grain", F.col("grain") % 3)


def _wide_listings(spark, d):
    return view(spark, d, "v_listings").withColumn("grain", F.col("grain") % 3)


@query
def collision_resolution(spark, d):
    out = matching.resolve_lines(_wide_spec(spark, d), _wide_listings(spark, d), brand_aliases=BRAND_ALIASES,
                                 type_aliases=TYPE_ALIASES)
    return out.select("listing_id", "brand", "bullet_type", "status", "spec_id")


@query
def specification_matches(spark, d):
    return matching.specification_matches(
        _wide_spec(spark, d), _wide_listings(spark, d), brand_aliases={}, type_aliases={}
    ).select("spec_id", "listing_id")


@query
def match_coverage(spark, d):
    matches = matching.alias_join(view(spark, d, "v_spec"), view(spark, d, "v_listings"), BRAND_ALIASES, TYPE_ALIASES)
    return matching.match_coverage(
        view(spark, d, "v_listings"), matches, ["Brand#1", "Brand#2", "Brand#4"], ["caliber_normalized", "manufacturer"]
    )


@query
def dedupe_min_id(spark, d):
    return matching.dedupe_min_id(view(spark, d, "v_listings"), ["manufacturer", "caliber_normalized"]).select(
        "id", "manufacturer", "caliber_normalized"
    )


@query
def first_seen(spark, d):
    cards = view(spark, d, "v_titles").groupBy("retailer_id", "product_url").agg(F.min("id").alias("seq"), F.max("partkey").alias("pk"))
    more = cards.unionByName(cards.withColumn("seq", F.col("seq") + 5).withColumn("pk", -F.col("pk")))
    return matching.first_seen(more, ["retailer_id", "product_url"], "seq")


@query
def dimension_label(spark, d):
    dim = view(spark, d, "v_retailers").where(F.col("id") % 2 == 0)
    return matching.with_label(view(spark, d, "v_listings"), dim, "retailer_id").groupBy("slug").agg(
        F.count(F.lit(1)).alias("n"))


@query
def cascade_evict(spark, d):
    """What goes, and what the written tables still hold."""
    before = view(spark, d, "v_listings")
    out = matching.cascade_evict(view(spark, d, "v_retailers"), before, view(spark, d, "v_obs"), 4)
    left = {n: scratch.stored(out[n], n) for n in ("listings", "history")}
    remains = matching.evict_remains(before, left["listings"], left["history"], 4)
    report = out["evicted"].unionByName(remains, allowMissingColumns=True)
    return report.agg(*[F.max(n).alias(n) for n in report.columns])


@query
def discovery_overlap(spark, d):
    urls = view(spark, d, "v_titles").select("product_url", "partkey")
    return matching.discovery_overlap(urls.where(F.col("partkey") % 3 != 0), urls.where(F.col("partkey") % 5 != 0), "product_url")


@query
def sql_pool(spark, d):
    # Every other maker is padded by blanks of all kinds.
    padded = F.when(F.col("id") % 2 == 0, F.concat(F.lit("\t "), "manufacturer", F.lit(" \n"))).otherwise(F.col("manufacturer"))
    sql_surface.register(spark, view(spark, d, "v_listings").withColumn("manufacturer", padded), mult=3.0)
    atoms = "array(named_struct('op', 'lt', 'v', 12.0D), named_struct('op', 'gt', 'v', 40.0D))"
    brand = "'brand7', array('brand#7'), array('brand#7', 'brand#9'), array('brand2', 'brand7')"
    return spark.sql(
        f"""SELECT p.id, p.price_per_round, bucket_match(c.grain, {atoms}, true) AS middle_weight,
                   brand_match(c.manufacturer, c.product_url, {brand}) AS is_brand,
                   cart_reaches(p.price_per_round, c.total_rounds, 60.0D, 200) AS ships_free,
                   f.id IS NOT NULL AS in_filtered
              FROM pool_listings('PROMO', p_condition => 'New') p JOIN capped_catalog c ON c.id = p.id
              LEFT JOIN pool_listings('PROMO', NULL, 'New', NULL, NULL, {atoms}, true, NULL, NULL, {brand},
                   array(named_struct('rid', 1, 'thr', 60.0D), named_struct('rid', 7, 'thr', 0.0D)), 200) f ON f.id = p.id""")


@query
def sql_cheapest(spark, d):
    sql_surface.register(spark, view(spark, d, "v_listings"))
    return spark.sql("""SELECT category AS cal, id, price_per_round FROM cheapest_listings(array(
        named_struct('category', 'PROMO', 'low', 1.0D, 'high', 20.0D), named_struct('category', 'SMALL', 'low', 2.0D, 'high', 9.0D),
        named_struct('category', 'LARGE', 'low', 8.0D, 'high', 9.0D)), 'bolt')""")


@query
def sql_segment_floors(spark, d):
    sql_series.register_series(spark, view(spark, d, "v_history"), view(spark, d, "v_listings"), floors(spark))
    return spark.sql(f"""SELECT * FROM segment_floors(TIMESTAMP_NTZ '{SEGMENT_SINCE}', p_min_listings => 2, p_full_n => 4, p_full_threshold => 6,
        p_default_floor => 50.0D)""")


@query
def sql_daily_floors(spark, d):
    """All splits, each with the filters of the DataFrame form's query."""
    sql_series.register_series(spark, view(spark, d, "v_obs"), view(spark, d, "v_listings"), floors(spark), mult=3.0)
    atoms = "array(" + ", ".join(f"named_struct('op', '{op}', 'v', {v}D)" for op, v in ATOMS) + ")"
    span = "'PROMO', TIMESTAMP_NTZ '2024-01-05 06:00:00', TIMESTAMP_NTZ '2024-01-29 05:00:00', 1.0D, 60.0D"
    return spark.sql(f"""
        SELECT 'none' AS split, series_key, CAST(day AS STRING) AS day, value, pool_size FROM daily_floors({span}, p_price_mult => 1.08D)
        UNION ALL SELECT 'retailer', series_key, CAST(day AS STRING), value, pool_size
          FROM daily_floors({span}, TIMESTAMP_NTZ '2024-01-25 00:00:00', p_price_mult => 1.08D, p_split => 'retailer')
        UNION ALL SELECT 'condition', series_key, CAST(day AS STRING), value, pool_size
          FROM daily_floors({span}, p_atoms => {atoms}, p_negate => true, p_price_mult => 1.08D, p_split => 'condition')""")


@query
def sql_bucket_floors(spark, d):
    sql_series.register_series(spark, view(spark, d, "v_obs"), view(spark, d, "v_listings"), floors(spark))
    return spark.sql("""SELECT 'PROMO' AS caliber_normalized, * FROM bucket_floors('PROMO', TIMESTAMP_NTZ '2024-01-29 13:45:10', p_bucket_hours => 12,
        p_fresh_hours => 12, p_min_alive_fraction => 0.03D, p_price_floor => 2.0D, p_min_pool => 1, p_exclude_ids => array(1L, 5L, 6L, 9L))""")


# -- aggregates -----------------------------------------------------------------------------

@query
def segment_floor(spark, d):
    return segments.segment_floor(
        view(spark, d, "v_history"), view(spark, d, "v_listings"), floors(spark), clock.instant(SEGMENT_SINCE),
        min_listings=2, full_n=4, full_threshold=6, default_floor=50.0,
    )


@query
def segment_trimmed_mean(spark, d):
    out = segments.segment_trimmed_mean(
        view(spark, d, "v_history"), view(spark, d, "v_listings"), clock.instant(SEGMENT_SINCE), mult=2.0
    )
    return out.withColumn("segment_avg", F.round("segment_avg", 4))


@query
def upper_median_signed(spark, d):
    """Balances of both signs and zero."""
    return stats.upper_median(table(spark, d, "customer"), ["c_nationkey"], "c_acctbal")


@query
def interpolated_median_signed(spark, d):
    balances = table(spark, d, "supplier").withColumn("s_acctbal", F.col("s_acctbal") - 4500)
    return stats.interpolated_median(balances, ["s_nationkey"], "s_acctbal")


@query
def ranked_signed(spark, d):
    return stats.ranked_with_count(table(spark, d, "customer"), ["c_mktsegment"], "c_acctbal", "c_custkey").select(
        "c_mktsegment", "c_custkey", F.col("rn").cast("bigint").alias("rn"), "n"
    )


@query
def upper_median(spark, d):
    return stats.upper_median(view(spark, d, "v_history"), ["retailer_id"], "price_per_round")


@query
def outlier_caps(spark, d):
    return pool.outlier_caps(view(spark, d, "v_listings"))


@query
def capped_catalog(spark, d):
    return catalog(spark, d).select("id", "caliber_normalized", "price_per_round")


@query
def two_stage_bounds(spark, d):
    return pool.price_bounds(catalog(spark, d), "PROMO", 0.25, 9.5, mult=2.0)


@query
def cheapest_n_mean(spark, d):
    return stats.cheapest_n_mean(view(spark, d, "v_history"), ["retailer_id"], "price_per_round", 5)


@query
def filtered_average(spark, d):
    # AVG(x) FILTER (WHERE …) as a conditional aggregate, over exact decimals.
    value = F.when(F.col("in_stock"), F.col("price").cast("decimal(18,4)"))
    return view(spark, d, "v_obs").groupBy("listing_id").agg(
        F.round(F.avg(value).cast("double"), 6).alias("in_stock_avg"), F.count(value).alias("n"))


@query
def distinct_listings_window(spark, d):
    return audit.distinct_members(
        view(spark, d, "v_obs"), view(spark, d, "v_listings"), clock.instant("2024-01-05 00:00:00"),
        clock.instant("2024-01-06 12:00:00"),
    )


@query
def written_in_window(spark, d):
    fine, _ = audit.written_in_window(view(spark, d, "v_listings"), clock.instant("2024-01-25 00:00:00"))
    return fine


@query
def written_per_retailer(spark, d):
    return audit.written_in_window(view(spark, d, "v_listings"), clock.instant("2024-01-25 00:00:00"))[1]


@query
def coverage_counters(spark, d):
    derived = F.when(F.col("id") % 2 == 0, F.lit("x"))
    out = audit.coverage_counters(view(spark, d, "v_listings"), "retailer_id", "bullet_type", derived)[0]
    return out.withColumn("null_pct_in_stock", F.round("null_pct_in_stock", 6))


@query
def coverage_samples(spark, d):
    derived = F.when(F.col("id") % 2 == 0, F.lit("x"))
    rows_ = audit.coverage_counters(view(spark, d, "v_listings"), "retailer_id", "bullet_type", derived)[1]
    return rows_.select("retailer_id", "id", F.col("_derived").alias("derived"))


@query
def value_distribution(spark, d):
    return audit.value_distribution(view(spark, d, "v_listings"), "bullet_type")


@query
def transition_matrix(spark, d):
    changed = enrich.reparse_changes(
        view(spark, d, "v_titles").withColumn("manufacturer", F.initcap(F.split("title", " ")[0])), url="product_url"
    )
    return audit.transition_matrix(changed)


@query
def transition_top(spark, d):
    changed = enrich.reparse_changes(
        view(spark, d, "v_titles").withColumn("manufacturer", F.initcap(F.split("title", " ")[0])), url="product_url"
    )
    return audit.transition_report(changed)["per_group"]


def _maker_changes(spark, d):
    return enrich.reparse_changes(
        view(spark, d, "v_titles").withColumn("manufacturer", F.initcap(F.split("title", " ")[0])), url="product_url"
    )


@query
def transition_overall(spark, d):
    return audit.transition_report(_maker_changes(spark, d))["overall"]


@query
def transition_samples(spark, d):
    return audit.transition_report(_maker_changes(spark, d))["samples"].select("id", "old_value", "new_value")


@query
def distinct_options(spark, d):
    brand = ("Brand#7", ["brand#7"], ["brand#7", "brand#9"], URL_BRANDS)
    out = pool.distinct_options(catalog(spark, d), brand)
    # Arrays as text, so both engines print them alike.
    models = F.transform("models", lambda m: F.concat_ws(":", m["grain"].cast("int").cast("string"), m["bt"]))
    return out.select(
        F.array_join(F.transform("grains", lambda g: g.cast("string")), ",").alias("grains"),
        F.array_join("bullet_types", ",").alias("bullet_types"),
        F.array_join("case_materials", ",").alias("case_materials"),
        F.array_join("calibers", ",").alias("calibers"),
        F.array_join(models, ",").alias("models"),
    )


@query
def freshness_rollup(spark, d):
    out = audit.freshness_rollup(view(spark, d, "v_listings"), ["retailer_id", "caliber_normalized"], clock.instant(AS_OF))
    return out


def _page_results(spark, d):
    """Validation results shaped from the fetched pages."""
    length = F.length("html")
    verdict = F.when(length % 3 == 0, "PASS").when(length % 3 == 1, "FAIL").otherwise("NEEDS_REVIEW")
    return table(spark, d, "pages").select(
        text.url_host(F.col("url")).alias("retailer"), verdict.alias("verdict"),
        F.when(length % 11 == 0, F.lit(None)).when(length % 7 == 0, 404).otherwise(200).cast("int").alias("status"),
        (length % 5 == 0).alias("redirect"), (length % 4).alias("n_products"), (length % 2 + 1).alias("page_no"),
    )


@query
def verdict_rollup(spark, d):
    return audit.verdict_rollup(_page_results(spark, d))[0]


@query
def failure_causes(spark, d):
    return audit.verdict_rollup(_page_results(spark, d))[1]


@query
def empty_source_alarm(spark, d):
    return audit.empty_source_alarm(_page_results(spark, d))


@query
def amount_range(spark, d):
    return view(spark, d, "v_eligible").groupBy("rebate_id").agg(
        F.min("amount_override").alias("amount_min"), F.max("amount_override").alias("amount_max"))


@query
def request_priority(spark, d):
    wanted = table(spark, d, "customer").select(F.col("c_mktsegment").alias("retailer_name"))
    return audit.request_priority(wanted)


# -- windows and series -----------------------------------------------------------------------

@query
def ranked_with_count(spark, d):
    ranked = stats.ranked_with_count(view(spark, d, "v_obs"), ["listing_id"], "price_per_round", "id")
    return ranked.select("id", F.col("rn").cast("int").alias("rn"), "n")


@query
def islands(spark, d):
    out = series.islands(view(spark, d, "v_obs"), ["listing_id"], ["recorded_at", "id"], F.col("price_per_round") > 50,
                         slice_of=F.to_date("recorded_at"))
    return out.select("id", "island")


@query
def locf(spark, d):
    gaps = view(spark, d, "v_obs").withColumn("price_per_round", F.when(F.col("id") % 3 == 0, F.col("price_per_round")))
    out = series.locf(gaps, ["listing_id"], ["recorded_at", "id"], "price_per_round")
    return out.select("id", "listing_id", "price_per_round")


@query
def locf_sliced(spark, d):
    gaps = view(spark, d, "v_obs").withColumn("price_per_round", F.when(F.col("id") % 5 == 0, F.col("price_per_round")))
    out = series.locf(gaps, ["in_stock"], ["recorded_at", "id"], "price_per_round", F.to_date("recorded_at"))
    return out.select("id", "in_stock", "price_per_round")


@query
def time_grid(spark, d):
    grid = clock.time_grid(table(spark, d, "events"), "2024-01-01", "2024-01-31", 6 * clock.HOUR, "t")
    seen = series.right_closed_bins(view(spark, d, "v_obs"), "recorded_at", "2024-01-01", 6 * clock.HOUR)
    counts = seen.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    return grid.join(counts, grid["t"] == counts["bin"], "left").select("t", F.coalesce("n", F.lit(0)).alias("n"))


@query
def right_closed_bins(spark, d):
    edges = view(spark, d, "v_obs").withColumn(
        "recorded_at", F.when(F.col("id") % 10 == 0, F.date_trunc("hour", "recorded_at").cast("timestamp_ntz")).otherwise(F.col("recorded_at"))
    )
    return series.right_closed_bins(edges, "recorded_at", "2024-01-03 02:00:00", 6 * clock.HOUR).select("id", "bin")


@query
def day_numbers(spark, d):
    day = clock.day_number(F.col("recorded_at"))
    return view(spark, d, "v_history").groupBy(day.alias("day_no")).agg(
        F.count(F.lit(1)).alias("n")).withColumn("day", clock.day_date(F.col("day_no")).cast("string"))


@query
def latest_per_key(spark, d):
    return series.latest_per(view(spark, d, "v_obs"), ["listing_id", "in_stock"], ["recorded_at", "id"]).select(
        "listing_id", "in_stock", "id", "price_per_round")


@query
def bucket_floor_locf(spark, d):
    return series.bucket_floor_series(
        view(spark, d, "v_obs"), view(spark, d, "v_listings"), AS_OF, condition=None, series=("caliber_normalized",),
        min_pool=3, price_floor=2.0, min_alive_fraction=0.02,
    )


@query
def bucket_floor_one(spark, d):
    return series.bucket_floor_series(
        view(spark, d, "v_obs"), view(spark, d, "v_listings"), "2024-01-29 13:45:10", series=("caliber_normalized",),
        keep={"caliber_normalized": "PROMO"}, min_pool=1, price_floor=2.0, bucket_hours=12, fresh_hours=12,
        min_alive_fraction=0.03,
        exclude_ids=[1, 5, 6, 9],
    )


def _daily(spark, d, **kwargs):
    return _dates_as_text(series.daily_floor_series(
        view(spark, d, "v_obs"), catalog(spark, d), "PROMO", "2024-01-05 06:00:00", 1.0, 60.0, "2024-01-29 05:00:00",
        price_mult=1.08, **kwargs,
    ))


@query
def daily_floor(spark, d):
    return _daily(spark, d)


@query
def daily_floor_by_retailer(spark, d):
    return _daily(spark, d, split="retailer", until="2024-01-25 00:00:00")


@query
def daily_floor_by_condition(spark, d):
    return _daily(spark, d, split="condition", weight_atoms=ATOMS, weight_negate=True)


@query
def retention_plan(spark, d):
    out = retention.retention_plan(
        view(spark, d, "v_obs"), view(spark, d, "v_listings").where(F.col("id") % 9 != 0), floors(spark, OBS_FLOORS),
        RETENTION_AS_OF, retention_days=5, expiry_days=12,
    )
    return out.select("id", "listing_id", "action")


@query
def retention_invariants(spark, d):
    plan = retention.retention_plan(
        view(spark, d, "v_obs"), view(spark, d, "v_listings").where(F.col("id") % 9 != 0), floors(spark, OBS_FLOORS),
        RETENTION_AS_OF, retention_days=5, expiry_days=12,
    )
    return retention.retention_invariants(plan)


@query
def delete_set(spark, d):
    plan = retention.retention_plan(
        view(spark, d, "v_obs"), view(spark, d, "v_listings"), floors(spark, OBS_FLOORS), RETENTION_AS_OF, 10, 20
    )
    left = retention.apply_deletes(view(spark, d, "v_obs"), retention.delete_ids(plan))
    return left.groupBy("listing_id").agg(F.count(F.lit(1)).alias("n"))


@query
def run_over_run(spark, d):
    def count(start, end):
        return audit.distinct_members(
            view(spark, d, "v_obs").withColumnRenamed("listing_id", "listing_id"), view(spark, d, "v_listings"),
            clock.instant(start), clock.instant(end))

    return audit.run_over_run(
        count("2024-01-06 00:00:00", "2024-01-06 03:00:00"), count("2024-01-05 00:00:00", "2024-01-06 00:00:00"), base=2
    )


@query
def coverage_gap(spark, d):
    listings = view(spark, d, "v_listings")
    expected = listings.select("retailer_id", "caliber_normalized")
    fine, _ = audit.written_in_window(listings.where(F.col("grain") % 5 == 0), clock.instant("2024-01-29 00:00:00"))
    return audit.coverage_gap(expected, fine, view(spark, d, "v_retailers"), clock.instant("2024-01-28 00:00:00"), exempt=[3])


@query
def stale_alarm(spark, d):
    out = audit.stale_alarm(view(spark, d, "v_retailers"), clock.instant(AS_OF), 8, ["shop-5", "shop-7"], 72)
    return out.select("id", "slug", "age_hours", "threshold_hours", "severity")


@query
def cache_alarm(spark, d):
    cache = view(spark, d, "v_obs").select(F.col("recorded_at").alias("refreshed_at"))
    return audit.cache_alarm(cache, clock.instant(AS_OF), 0.01).select("newest", "age_hours", "reason")


# -- sorting and sets ----------------------------------------------------------------------------

@query
def top_per_group(spark, d):
    return audit.top_values(view(spark, d, "v_listings"), ["retailer_id"], "caliber_normalized", 3)


@query
def union_processed(spark, d):
    done = view(spark, d, "v_listings").where(F.col("id") % 4 == 0).select("id", "price_per_round")
    skipped = view(spark, d, "v_listings").where(F.col("id") % 4 == 1).select("id", F.lit("excluded").alias("category"))
    return tables.processed_and_excluded(done, skipped)


@query
def set_difference(spark, d):
    a = view(spark, d, "v_obs").where(F.col("price_per_round") > 150).select("listing_id")
    b = view(spark, d, "v_obs").where(F.col("price_per_round") < 0.5).select("listing_id")
    return audit.set_difference(a, b)


@query
def additive_diff(spark, d):
    before = view(spark, d, "v_listings").select("id", F.when(F.col("id") % 3 != 0, F.col("bullet_type")).alias("verdict"))
    after = view(spark, d, "v_listings").select(
        "id", F.when(F.col("id") % 50 == 1, F.lit("zzz")).otherwise(F.col("bullet_type")).alias("verdict"))
    return audit.additive_diff(before, after, "id", "verdict", ["red", "blue", "new", "old"])


@query
def table_compare(spark, d):
    a = view(spark, d, "v_listings").where(F.col("id") % 5 != 0).select("id", "manufacturer")
    b = view(spark, d, "v_listings").where(F.col("id") % 7 != 0).select(
        "id", F.when(F.col("id") % 11 == 0, F.lit("other")).otherwise(F.col("manufacturer")).alias("manufacturer"))
    return audit.table_compare(a, b, "id", "manufacturer")


@query
def change_of_record(spark, d):
    fresh = view(spark, d, "v_listings").select("id", "grain", "manufacturer", "last_updated")
    stored = fresh.where(F.col("id") % 9 != 0).withColumn(
        "grain", F.when(F.col("id") % 8 == 0, F.col("grain") + 1).otherwise(F.col("grain")))
    return audit.change_of_record(stored, fresh, ["id"], ["grain", "manufacturer"]).select("id", "grain", "manufacturer")


# -- text -------------------------------------------------------------------------------------------

def _per_title(frame: DataFrame, *columns) -> DataFrame:
    return frame.groupBy("title", *columns).agg(F.count(F.lit(1)).alias("n"))


@query
def category_cascade(spark, d):
    return _per_title(enrich.enrich_category(view(spark, d, "v_titles")), "caliber_normalized")


WORD_RULES = [
    ("english", [("re", r"\bthe\b"), ("sub", " and ")]),
    ("french", [("re", r"\bles?\b"), ("sub", " des ")]),
    ("german", [("re", r"\bund\b"), ("sub", " sch ")]),
    ("spanish", [("re", r"\bpara\b")]),
]


@query
def document_cascade(spark, d):
    return enrich.enrich_category(table(spark, d, "documents"), "text", "verdict", WORD_RULES).groupBy("lang", "verdict").agg(
        F.count(F.lit(1)).alias("n"))


@query
def longest_alias(spark, d):
    return _per_title(enrich.enrich_brand(view(spark, d, "v_titles"), "title"), "manufacturer")


@query
def brand_with_fallback(spark, d):
    odd = view(spark, d, "v_titles").select(
        F.when(F.col("partkey") % 3 == 0, F.lit("")).otherwise(F.col("title")).alias("title"),
        F.when(F.col("partkey") % 2 == 0, F.regexp_replace("product_url", "com/[a-z]+", "com/fed")).otherwise(F.col("product_url")).alias("product_url"),
    )
    out = enrich.enrich_brand(odd, "title", "product_url")
    return out.groupBy("title", "product_url", "manufacturer").agg(F.count(F.lit(1)).alias("n"))


@query
def type_cascade(spark, d):
    return _per_title(enrich.enrich_type(view(spark, d, "v_titles")), "bullet_type")


@query
def type_url_fallback(spark, d):
    odd = view(spark, d, "v_titles").withColumn("title", F.when(F.col("partkey") % 2 == 0, F.lit("x")).otherwise(F.col("title")))
    out = enrich.enrich_type(odd, "title", "product_url")
    return out.groupBy("title", "product_url", "bullet_type").agg(F.count(F.lit(1)).alias("n"))


@query
def maker_type_phrase(spark, d):
    kind = F.regexp_extract("title", "gr ([^-]*(?:-[A-Z][^-]*)?) - ", 1)
    return view(spark, d, "v_titles").select(kind.alias("phrase"), text.maker_type(kind).alias("maker_type")).groupBy(
        "phrase", "maker_type").agg(F.count(F.lit(1)).alias("n"))


@query
def maker_category_map(spark, d):
    raw = F.regexp_extract("title", r"(\.?\d[^ ]* (?:ACP|Special|Magnum|Winchester|Remington|Luger|Auto))", 1)
    return view(spark, d, "v_titles").select(raw.alias("name"), text.maker_category(raw).alias("slug")).groupBy(
        "name", "slug").agg(F.count(F.lit(1)).alias("n"))


@query
def purchase_limit(spark, d):
    out = view(spark, d, "v_titles").withColumn("purchase_limit", text.purchase_limit(F.col("title")))
    return _per_title(out, "purchase_limit")


@query
def pack_count(spark, d):
    profiles = [(name, name) for name in ("simple", "wide", "slash_bounded", "case_first")]
    out = enrich.pack_count_by_source(view(spark, d, "v_titles"), profiles)
    return _per_title(out, "source", "total_rounds")


@query
def small_attributes(spark, d):
    name = F.col("title")
    out = view(spark, d, "v_titles").select(
        "title",
        text.weight_number(name).alias("grain"),
        text.case_material(name).alias("case_plain"),
        text.case_material(name, "strict").alias("case_strict"),
        text.case_material(name, "polymer").alias("case_polymer"),
        text.condition(name).alias("condition_type"),
        text.origin_country(name, brands.ORIGIN_EXTENDED).alias("country"),
        text.stock_from_text(name, "absent_phrases").alias("in_stock"),
        text.stock_from_text(name, "stock_label").alias("labelled_in_stock"),
    )
    return _per_title(out, *[c for c in out.columns if c != "title"])


@query
def clean_title(spark, d):
    raw = F.regexp_extract("html", "(?s)<h1>(.*?)</h1>", 1)
    odd = F.concat(F.lit("  "), F.translate(raw, "aeo", "×–®"), F.lit("  "))
    return table(spark, d, "pages").select("page_id", text.clean_title(odd).alias("clean"))


@query
def component_flag(spark, d):
    out = view(spark, d, "v_titles").select(
        F.regexp_replace("product_url", "-\\d+$", F.lit("")).alias("link"),
        text.component_flag(
            F.regexp_replace("product_url", "nosler-", "nosler-partition-"), F.col("partkey") % 150,
            F.split("title", " ")[0]).alias("is_component"),
        (F.col("partkey") % 150).alias("rounds"),
    )
    return out.groupBy("link", "rounds", "is_component").agg(F.count(F.lit(1)).alias("n"))


CLASSES = {"en": ["the ", "and ", "of ", "for "], "fr": ["les ", "des ", "que ", "pour "], "de": ["und ", "sch", "der "],
           "es": ["para ", "los ", "las "]}


@query
def dominant_class(spark, d):
    head = F.split("text", "\n")[0]
    return table(spark, d, "documents").select(
        "doc_id", text.dominant_class(head, F.col("text"), CLASSES).alias("klass"))


@query
def component_attributes(spark, d):
    part = table(spark, d, "part")
    kind = rules.lookup((F.col("p_partkey") % 4).cast("string"), {"0": "powder", "1": "primer", "2": "bullet", "3": "brass"})
    items = part.select(
        F.col("p_partkey").alias("id"), kind.alias("category"),
        F.when(F.col("p_partkey") % 8 == 0, F.lit("Hodgdon")).when(F.col("p_partkey") % 4 == 0, F.lit("Alliant"))
        .otherwise(F.initcap(F.split("p_name", " ")[0])).alias("brand"),
        F.when(kind == "powder", F.concat(F.lit("Reloder "), (F.col("p_partkey") % 30).cast("string"), F.lit(" H4"), (F.col("p_size") % 3 * 459 + 350).cast("string")))
        .when(kind == "primer", F.concat(F.initcap("p_name"), F.when(F.col("p_size") % 2 == 0, " Large Rifle").otherwise(" Small Pistol"), F.when(F.col("p_size") % 3 == 0, " Magnum").otherwise("")))
        .when(kind == "bullet", F.concat(F.lit("FMJ "), (F.col("p_size") * 30).cast("string"), F.lit(" Grain")))
        .otherwise(F.concat(F.initcap("p_name"), F.lit(" Brass Box of 50"))).alias("product_name"),
        F.when(F.col("p_size") % 2 == 0, F.col("p_size").cast("double")).alias("grain"),
    )
    return enrich.component_attributes(items).drop("product_name", "brand", "grain")


@query
def fill_null_only(spark, d):
    stored = view(spark, d, "v_titles").withColumn("bullet_type", F.when(F.col("partkey") % 4 == 0, F.lit("SP")))
    out = enrich.fill_null_only(stored, skip_retailers=[3])
    return out.groupBy("outcome", "bullet_type").agg(F.count(F.lit(1)).alias("n"))


@query
def fill_component_types(spark, d):
    parts = view(spark, d, "v_titles").select(
        F.col("title").alias("product_name"), F.when(F.col("partkey") % 3 == 0, "powder").otherwise("bullet").alias("category"),
        F.when(F.col("partkey") % 4 == 0, F.lit("SP")).alias("bullet_type"))
    return enrich.fill_component_types(parts).groupBy("product_name", "bullet_type").agg(F.count(F.lit(1)).alias("n"))


@query
def fill_brands(spark, d):
    stored = view(spark, d, "v_titles").withColumn("manufacturer", F.when(F.col("partkey") % 4 == 0, F.lit("Kept"))).withColumn(
        "caliber", F.col("title"))
    return enrich.fill_brands(stored).groupBy("title", "product_url", "manufacturer").agg(F.count(F.lit(1)).alias("n"))


@query
def reparse_triggers(spark, d):
    stored = view(spark, d, "v_titles").withColumn(
        "manufacturer", rules.lookup((F.col("partkey") % 4).cast("string"), {"0": "Winchester", "1": "Unknown", "2": "Acme"}))
    out = enrich.reparse_changes(stored, brands.REPARSE_TRIGGER_BRANDS)
    return out.groupBy("old_value", "new_value").agg(F.count(F.lit(1)).alias("n"))


RELABEL = [("Brand#1", None, "Brand#2"), ("Brand#2", "%bolt%", "Brand#3"), ("Brand#3", "%/small/%", "Brand#1"),
           ("Brand#4", "%gear%", "Brand#5"), ("Brand#1", "%ring%", "Ring")]


@query
def bulk_relabel(spark, d):
    return enrich.bulk_relabel(view(spark, d, "v_listings"), RELABEL).select("id", "manufacturer")


@query
def slug_detect_audit(spark, d):
    out = view(spark, d, "v_titles").select("product_url", text.url_audit_type(F.col("product_url")).alias("detected"))
    return out.groupBy("product_url", "detected").agg(F.count(F.lit(1)).alias("n"))


@query
def url_parts(spark, d):
    url = F.col("product_url")
    return view(spark, d, "v_listings").select(
        "id", text.product_key(url).alias("product_key"), text.line_name(url).alias("line_name"),
        text.url_host(url).alias("host"), text.url_path(url).alias("path"))


@query
def alias_tokens(spark, d):
    names = {k: categories.CATEGORY_URL_NAMES[k] for k in ("9mm", "308win", "38spl", "10mm")}
    base = view(spark, d, "v_titles").withColumn("_s", text.spaced(F.col("title")))
    out = base.select("title", *[text.names_category(F.col("_s"), v).alias("m_" + k) for k, v in names.items()])
    return _per_title(out, *["m_" + k for k in names])


@query
def title_line(spark, d):
    lines = table(spark, d, "documents").select(
        "doc_id", text.title_line(F.col("text"), "french", 25, WORD_RULES).alias("line"))
    return lines.where(F.col("line").isNotNull())


@query
def source_defaults(spark, d):
    profiles = [("simple", "House A", 20, None), ("wide", None, 50, "USA"), ("case_first", "House C", None, None)]
    named = enrich.enrich_brand(view(spark, d, "v_titles"), "title").withColumn("total_rounds", text.pack_count(F.col("title"))).withColumn(
        "country_of_origin", text.origin_country(F.col("title")))
    out = enrich.source_defaults(named, profiles)
    return _per_title(out, "source", "manufacturer", "total_rounds", "country_of_origin")


@query
def field_first(spark, d):
    t = view(spark, d, "v_gate")
    both = text.field_first(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("total_rounds")), (F.col("id") % 4).cast("int"))
    return t.select(both.alias("rounds")).groupBy("rounds").agg(F.count(F.lit(1)).alias("n"))


@query
def price_from_text(spark, d):
    hundredths = F.floor(F.col("l_extendedprice") / 10)
    price = F.concat(F.floor(hundredths / 100).cast("string"), F.lit("."), F.lpad((hundredths % 100).cast("string"), 2, "0"))
    unit = F.format_string("%.2f", F.col("l_tax"))
    blob = F.concat(F.lit("Was $"), price, F.lit(" Now $"), F.format_string("%.2f", F.col("l_quantity")), F.lit(" ($"), unit, F.lit(" per)"))
    apart = F.concat(F.lit("$"), F.col("l_quantity").cast("int").cast("string"), F.lit(" "), F.lpad(F.col("l_linenumber").cast("string"), 2, "0"))
    split = prices.split_by_size(blob)
    return table(spark, d, "lineitem").select(
        prices.lowest_price(blob).alias("lowest"), split["unit_price"].alias("unit_price"), split["total"].alias("total"),
        prices.single_price(blob).alias("single"), prices.split_decimal_price(apart).alias("split_decimal"),
    ).groupBy("lowest", "unit_price", "total", "single", "split_decimal").agg(F.count(F.lit(1)).alias("n"))


# -- pages -------------------------------------------------------------------------------------------

@query
def unescape(spark, d):
    """Texts with many characters written as references come back whole."""
    text = F.replace(F.col("text"), F.lit("&"), F.lit("&amp;"))
    for char, reference in (("o", "&#111;"), ("d", "&#x64;"), ("é", "&eacute;"), ("ü", "&uuml"), ("ñ", "&#00241"), ("<", "&lt;"), (".", "&period;")):
        text = F.replace(text, F.lit(char), F.lit(reference))
    return table(spark, d, "documents").select("doc_id", F.sha2(markup.unescape(F.concat(text, F.lit("&#128512;&#38;lt;"))), 256).alias("text_hash"))


@query
def page_title(spark, d):
    return table(spark, d, "pages").select("page_id", markup.page_title(F.col("html")).alias("title"))


@query
def visible_text(spark, d):
    lines = markup.visible_lines(F.col("html"))
    return table(spark, d, "pages").select("page_id", F.size(lines).alias("n_lines"), F.array_join(lines, "\n").alias("body"))


@query
def canonical_redirect(spark, d):
    url = F.col("url")
    landed = (
        F.when(F.col("page_id") % 5 == 0, F.concat(F.lit("HTTPS://www."), F.regexp_replace(url, "^https?://", "")))
        .when(F.col("page_id") % 5 == 1, F.concat(F.regexp_replace(url, r"[?#].*$", ""), F.lit("/")))
        .when(F.col("page_id") % 5 == 2, F.concat(F.regexp_replace(url, r"[?#].*$", ""), F.lit("x")))
        .when(F.col("page_id") % 5 == 3, F.regexp_replace(url, "example", "other"))
        .otherwise(F.upper(url))
    )
    return table(spark, d, "pages").select("page_id", markup.redirected(url, landed).alias("redirected"))


@query
def policy_links(spark, d):
    links = markup.policy_links(F.col("html"), F.col("url"), ["th", "de"])
    return table(spark, d, "pages").select("page_id", F.posexplode(links).alias("at", "link"))


@query
def split_cards(spark, d):
    cards = pages.split_cards(table(spark, d, "pages"), "<p>")
    # Words between the card's opening and its first tag.
    return pages.card_fields(cards, {"lead": r"^<p>([^<]*)"}).select("page_id", "card_no", "lead")


@query
def label_values(spark, d):
    lines = markup.visible_lines(F.col("html"))
    return table(spark, d, "pages").select(
        "page_id", markup.value_after(lines, "The|And|En|Les|Der|Nicht|La|De").alias("after_label"))


@query
def paragraph_stance(spark, d):
    paras = markup.paragraphs(F.col("text"), "\n")
    patterns = {"place": r"(?:The|Les|La|Der|El)\b", "topic": r"(?i)en", "claims": ["ing ", "ment ", "ung "],
                "denials": ["tion ", "eau "], "codes": "(?:[A-Z][a-z]+[, ]+){2,}"}
    best = pages.page_stance(paras, **patterns)
    return table(spark, d, "documents").select("doc_id", best.alias("b")).select(
        "doc_id", "b.stance", "b.priority", "b.evidence")


@query
def site_stance(spark, d):
    paras = markup.paragraphs(F.col("text"), "\n")
    patterns = {"place": r"(?:The|Les|La|Der|El)\b", "topic": r"(?i)en", "claims": ["ing ", "ment ", "ung "],
                "denials": ["tion ", "eau "], "codes": "(?:[A-Z][a-z]+[, ]+){2,}"}
    checked = table(spark, d, "documents").select(
        F.col("source").alias("site"), F.col("doc_id").alias("seq"), F.col("doc_id").cast("string").alias("url"),
        pages.page_stance(paras, **patterns).alias("stance"))
    return pages.site_stance(checked)


@query
def number_near_keyword(spark, d):
    docs = table(spark, d, "documents").select(
        F.concat(F.col("text"), F.lit(" size "), F.format_number(F.col("n_chars"), 0), F.lit(" end")).alias("body"),
        "doc_id", F.col("n_chars").cast("int").alias("expected"))
    return docs.select("doc_id", markup.near_keyword(
        F.col("body"), F.col("expected") + F.when(F.col("doc_id") % 3 == 0, 1).otherwise(0), ["size", "zzz"], 220).alias("near"))


@query
def sitemap_urls(spark, d):
    maps = table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("sitemap_id"),
        F.concat(F.lit("<urlset>"), F.lit("<url><loc> https://s.example.com/"), (F.col("l_partkey") % 40).cast("string"),
                 F.lit("-"), rules.lookup((F.col("l_partkey") % 3).cast("string"), {"0": "9mm-luger", "1": "308-win", "2": "8x57"}),
                 F.lit("-grain-x.html</loc></url></urlset>")).alias("xml"))
    merged = maps.groupBy("sitemap_id").agg(F.array_join(F.sort_array(F.collect_set("xml")), "").alias("xml"))
    return pages.sitemap_urls(merged, "-grain-", [r"/1\d-"]).select("url", "category", "sitemap_id", "at")


def _product_pages(spark, d):
    """Product pages with embedded JSON built from the supplied rows."""
    body = F.to_json(F.struct(
        F.lit("Product").alias("@type"), F.col("p_name").alias("name"),
        F.struct(
            F.lit("Offer").alias("@type"), F.format_number(F.floor(F.col("p_retailprice") * 2), 0).alias("price"),
            F.when(F.col("p_partkey") % 5 == 0, F.lit("https://schema.org/OutOfStock"))
            .when(F.col("p_partkey") % 5 == 1, F.lit("PreOrder")).otherwise(F.lit("InStock")).alias("availability"),
        ).alias("offers")))
    wrapped = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit('{"@graph":[{"@type":"WebPage"},'), body, F.lit("]}"))).otherwise(body)
    html = F.concat(F.lit('<script type="application/ld+json">'), wrapped, F.lit("</script>"))
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("listing_id"), F.concat(F.lit("https://x/"), F.col("p_partkey").cast("string")).alias("url"),
        F.when(F.col("p_partkey") % 13 == 0, 404).when(F.col("p_partkey") % 17 == 0, 503)
        .when(F.col("p_partkey") % 19 == 0, 301).otherwise(200).alias("status"),
        F.when(F.col("p_partkey") % 7 == 0, F.lit("<html></html>")).otherwise(html).alias("html"))


@query
def recheck_decision(spark, d):
    return pages.recheck_decisions(_product_pages(spark, d))


@query
def reconcile_stock(spark, d):
    bounds = rows(spark, [("ECONOMY", 0.5, 4.0), ("PROMO", 1.0, 5.0)], "category string, lo double, hi double")
    listings = view(spark, d, "v_listings").where(F.col("in_stock"))
    return pages.reconcile_stock(
        listings, pages.recheck_decisions(_product_pages(spark, d)), clock.instant(AS_OF), bounds, [8]
    ).select("id", "category", "outcome", "gate_reason", "in_stock", "base_price", "price_per_round", "writes_history")


@query
def recheck_report(spark, d):
    bounds = rows(spark, [("ECONOMY", 0.5, 4.0), ("PROMO", 1.0, 5.0)], "category string, lo double, hi double")
    outcomes = pages.reconcile_stock(
        view(spark, d, "v_listings").where("in_stock"), pages.recheck_decisions(_product_pages(spark, d)), clock.instant(AS_OF), bounds, [8])
    return pages.recheck_report(outcomes)


@query
def page_verdict(spark, d):
    """One page per retailer and category, one row per card."""
    key = ["retailer_id", "category"]
    listed = view(spark, d, "v_titles").select("retailer_id", F.col("page_category").alias("category"), F.col("title").alias("card_title"))
    titles = listed.distinct()
    longer = F.when(F.col("retailer_id") == 3, F.concat("category", F.lit(" x "), "card_title")).otherwise(F.col("card_title"))
    cards = titles.where(~F.col("retailer_id").isin(4, 5)).withColumn("card_title", longer).unionByName(
        spread.cheapest(titles.where(F.col("retailer_id") == 5), key, ["card_title"], 2).drop("_rank"))
    checked = listed.select(*key).distinct().select(
        *key,
        F.when(F.col("retailer_id") == 9, "parent").otherwise("caliber").alias("kind"),
        F.when(F.col("retailer_id") == 8, 404).otherwise(200).alias("status"),
        F.concat(F.lit("https://a.example.com/"), "category").alias("requested_url"),
        F.concat(F.lit("https://www.a.example.com/"), "category", F.when(F.col("retailer_id") == 7, "x").otherwise("/")).alias("landed_url"),
        F.when(F.col("retailer_id") == 6, F.lit("9mm Luger deals")).otherwise(F.concat("category", F.lit(" deals"))).alias("title"))
    return pages.card_verdicts(checked, cards, key).select(
        "retailer_id", "category", "verdict", "redirect", "title_match", "gate_pass_pct", "n_products")


def _spec_pages(spark, d):
    """Specification pages in five templates, written from the part rows."""
    kinds = {"schema": "Full Metal Jacket", "labels": "FMJ", "imperial": "JHP", "lines": "Hollow Point", "heading": "TMJ"}
    source = F.element_at(F.array(*[F.lit(k) for k in kinds]), (F.col("p_partkey") % 5 + 1).cast("int"))
    key, grain = F.col("p_partkey").cast("string"), F.col("p_size").cast("string")
    speed, energy = (F.col("p_size") * 10 + 700).cast("string"), (F.col("p_size") + 300).cast("string")

    def page(text_, *parts):
        return F.format_string(text_, *parts)

    html = {
        "schema": page(
            '<script type="application/ld+json">{"@type":"Product","sku":"S%s","name":"Line %s, 9mm Luger, %s Grain, Full Metal Jacket, x"}</script>'
            '<table><tr><td>Muzzle Velocity</td><td>%s fps</td></tr></table>'
            '<script id="chart-data-energy">{"points":[[%s,2,3,4,5]]}</script>', key, F.col("p_type"), grain, speed, energy),
        "labels": page(
            '<h1 class="itemtitle">10mm Auto %s gr FMJ %s®</h1><span class="stats">Item #S%s | 25/Box</span>'
            '<div data-label="Muzzle Velocity">%s fps</div><div data-label="Muzzle Energy">%s</div>', grain, F.col("p_type"), key, speed, energy),
        "imperial": page(
            '<h1>45 Auto %sGR JHP</h1><span class="symbol">S%s</span><table id="table-imperial"><tr><td>fps</td></tr>'
            "<tr><td>Muzzle</td><td>%s</td><td>%s</td></tr></table>", grain, key, speed, energy),
        "lines": page(
            "<h1>380 Auto</h1><b>ITEM NO:</b><i>S%s</i><b>BULLET TYPE:</b><i>Hollow Point</i><b>WEIGHT:</b><i>%s GR</i><p>VELOCITY</p><p>(FEET PER SECOND)</p>"
            "<p>Muzzle:</p><p>%s</p><p>ENERGY</p><p>(FOOT POUNDS)</p><p>Muzzle:</p><p>%s</p>", key, grain, speed, energy),
        "heading": page(
            '<h1>9 mm LUGER TMJ %s GRS S%s</h1><table class="large"><tr><th>Velocity</th><th>x</th><td>%s</td></tr>'
            "<tr><th>Energy</th><th>x</th><td>%s</td></tr></table>", grain, key, speed, energy),
    }
    chain = None
    for name, body in html.items():
        chain = F.when(source == name, body) if chain is None else chain.when(source == name, body)
    return spread.dealt(table(spark, d, "part").select("p_partkey", "p_type", "p_size")).select(
        F.col("p_partkey").alias("page_id"), F.concat(F.lit("https://m.example.com/bronze/"), key, F.lit(".html")).alias("url"),
        source.alias("source"), chain.alias("html"))


@query
def ballistics_facts(spark, d):
    return pages.ballistics_facts(_spec_pages(spark, d)).select(
        "page_id", "external_id", "product_line", "caliber_normalized", "grain", "bullet_type", "muzzle_velocity_fps",
        "muzzle_energy_ftlb")


@query
def tile_facts(spark, d):
    cell = '<div class="b-producttile__info-item %s">%%s</div>'
    tile = F.format_string(
        '<div class="b-producttile__info">' + "".join(cell % c for c in ("cartridge", "weight", "type", "muzzle-velocity", "symbol", "brand")) + "</div>",
        rules.lookup((F.col("p_partkey") % 3).cast("string"), {"0": "9mm Luger", "1": ".243 Win", "2": "10mm Auto"}),
        F.concat(F.col("p_size").cast("string"), F.lit(" gr")), F.lit("Soft Point"),
        F.when(F.col("p_size") % 7 == 0, F.lit("n/a")).otherwise((F.col("p_size") + 900).cast("string")),
        F.concat(F.lit("<a>Q"), F.col("p_partkey").cast("string"), F.lit("</a>")), F.col("p_type"))
    tiled = table(spark, d, "part").groupBy(F.floor(F.col("p_partkey") / 10).alias("page_id")).agg(
        F.array_join(F.sort_array(F.collect_list(tile)), "").alias("html")).withColumn("url", F.lit("u"))
    return pages.tile_facts(tiled).select("page_id", "sku", "product_line", "caliber_normalized", "grain", "bullet_type", "muzzle_velocity_fps")


def _rebate_pages(spark, d):
    line = F.format_string("Federal %s — $%s.50 rebate per box<br/>", F.col("product_line"), F.length("product_line").cast("string"))
    grouped = view(spark, d, "v_eligible").groupBy("rebate_id").agg(F.array_join(F.sort_array(F.collect_list(line)), "").alias("body"))
    number = F.lpad(F.col("rebate_id").cast("string"), 3, "0")
    html = F.concat(
        F.lit('<div id="R10'), number, F.lit('"></div><h3>Offer '), number, F.lit('</h3><p class="fine-print">'), F.col("body"),
        F.lit('</p><p class="minimum-copy">Minimum ('), F.col("rebate_id").cast("string"),
        F.lit(') boxes. Maximum rebate $75.00</p><p class="font-italic">Valid for purchases made 3/1/2026 through 5/'),
        (F.col("rebate_id") % 28 + 1).cast("string"), F.lit("/2026. DEADLINE: 6/30/2026</p>"))
    return grouped.select(F.col("rebate_id").alias("page_id"), html.alias("html"), F.lit("https://r.example.com").alias("url"))


@query
def rebate_facts(spark, d):
    return _dates_as_text(pages.rebate_blocks(_rebate_pages(spark, d)).select(
        "external_id", "title", "detail_url", "min_qty_required", "amount_max_total", "valid_from", "valid_through", "submit_by",
        "amount_min_per_unit", "amount_max_per_unit"))


@query
def rebate_lines(spark, d):
    return pages.rebate_lines(pages.rebate_blocks(_rebate_pages(spark, d))).select("external_id", "product_line", "amount_override")


@query
def component_rows(spark, d):
    part = F.col("p_partkey").cast("string")
    body = F.format_string(
        '<script type="application/ld+json">{"@graph":[{"@type":"WebPage"},{"@type":"ProductGroup","name":"%s %s Grain","productGroupID":"G%s",'
        '"brand":{"name":"%s"},"hasVariant":[{"sku":"A%s","size":"%s","offers":{"priceSpecification":[{"price":"%s"}]}},'
        '{"sku":"B%s","url":"u?attribute_pa_quantity=%s","offers":{"price":%s}},{"sku":"C%s","offers":{"price":1}}]}]}</script>'
        '<p class="stock %s">x</p><form data-product_variations="[{&quot;sku&quot;:&quot;A%s&quot;,&quot;is_in_stock&quot;:%s}]"></form>',
        F.col("p_name"), F.col("p_size").cast("string"), part, F.col("p_brand"), part,
        F.when(F.col("p_partkey") % 2 == 0, F.lit("8-oz")).otherwise(F.lit("4")), F.col("p_size").cast("string"), part,
        (F.col("p_size") * 10).cast("string"), (F.col("p_size") + 5).cast("string"), part,
        F.when(F.col("p_partkey") % 3 == 0, F.lit("in-stock")).otherwise(F.lit("out-of-stock")), part,
        F.when(F.col("p_partkey") % 5 == 0, F.lit("false")).otherwise(F.lit("true")))
    fetched = spread.dealt(table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_size")).select(
        F.col("p_partkey").alias("page_id"), F.lit("u").alias("url"),
        F.when(F.col("p_partkey") % 2 == 0, F.lit("powder")).otherwise(F.lit("bullet")).alias("kind"), body.alias("html"))
    out = pages.component_rows(fetched, {"powder": "lb", "bullet": "count"})
    return out.select("page_id", "category", "parent_sku", "variant_sku", "product_name", "brand",
                      F.col("package_size").cast("double").alias("package_size"), "package_unit", "price", "in_stock", "grain")


@query
def verified_numbers(spark, d):
    fetched = table(spark, d, "pages").withColumn(
        "html", F.concat(F.col("html"), F.lit("<p>muzzle "), F.format_number(F.col("page_id") + 1000, 0), F.lit("</p>")))
    wanted = table(spark, d, "pages").groupBy("url").agg(F.max("page_id").alias("page_id")).select(
        F.when(F.col("page_id") % 10 == 9, F.concat(F.col("url"), F.lit("?gone"))).otherwise(F.col("url")).alias("url"),
        (F.col("page_id") + F.when(F.col("page_id") % 4 == 0, 5001).otherwise(1000)).cast("int").alias("expected"))
    out = pages.verified_numbers(fetched, wanted, ["muzzle"], 220)
    return out.groupBy("url", "expected").agg(F.max("verified").alias("verified"))


@query
def card_tiers(spark, d):
    cents = F.col("l_linenumber").cast("string")
    price_attr = F.concat(F.lit("$"), F.col("l_quantity").cast("int").cast("string"), F.lit(".99|$"), (F.col("l_quantity") * 9).cast("int").cast("string"))
    unit_attr = F.when(F.col("l_partkey") % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("$0."), cents, F.lit("|$0.9")))
    tiers = pages.tier_prices(price_attr, unit_attr, F.when(F.col("l_partkey") % 2 == 0, F.lit("20 rounds")).otherwise(F.lit("x")))
    return table(spark, d, "lineitem").select(tiers.alias("t")).select("t.*").groupBy(
        "base_price", "price_per_round", "total_rounds").agg(F.count(F.lit(1)).alias("n"))


# -- store on change ------------------------------------------------------------------------------------

@query
def store_on_change(spark, d):
    return changes.store_on_change(view(spark, d, "v_steps")).select("id", "listing_id", "price", "in_stock")


@query
def store_on_change_stream(spark, d):
    """The same rows as a stream of files: up to three days late, in any order, each file five days of arrivals."""
    steps = view(spark, d, "v_steps")
    arrival = clock.micros(F.col("recorded_at")) + F.pmod(F.xxhash64("id"), F.lit(3 * clock.DAY))
    dealt = scratch.stored(steps.withColumn("_wave", F.floor(arrival / F.lit(5 * clock.DAY)).cast("bigint")), "waves")
    waves = [r[0] for r in dealt.select("_wave").distinct().orderBy("_wave").collect()]
    source, out, marks = (scratch.new_folder(spark, n) for n in ("arrivals", "changes", "progress"))
    for wave in waves:
        dealt.where(F.col("_wave") == wave).drop("_wave").repartition(2).write.mode("append").parquet(source)
    # A last row far ahead lets the watermark pass all others.
    end = dealt.agg((F.max("recorded_at") + F.expr("INTERVAL 30 DAYS")).alias("recorded_at")).select(
        F.lit(-1).cast("bigint").alias("id"), F.lit(-1).cast("bigint").alias("listing_id"), F.lit(0.0).alias("price"),
        F.lit(0.0).alias("price_per_round"), F.lit(False).alias("in_stock"), "recorded_at")
    end.select(*[F.col(c).cast(dict(steps.dtypes)[c]) for c in steps.columns]).coalesce(1).write.mode("append").parquet(source)
    rows_in = spark.readStream.schema(steps.schema).option("maxFilesPerTrigger", 2).parquet(source)
    changed = stream.store_on_change_stream(rows_in, "8 days", wait=True)  # a wave may be cut between batches
    run = changed.writeStream.format("parquet").option("path", out).option("checkpointLocation", marks).trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.parquet(out).where("listing_id >= 0").select("id", "listing_id", "price", "in_stock")


@query
def store_on_change_baseline(spark, d):
    """The second half of every day against what the first half left stored."""
    steps = view(spark, d, "v_steps").withColumn("_day", clock.day_number(F.col("recorded_at")))
    noon = F.pmod(clock.micros(F.col("recorded_at")), F.lit(clock.DAY)) >= F.lit(clock.DAY // 2)
    base = series.latest_per(steps.where(~noon), ["listing_id", "_day"], ["recorded_at", "id"])
    return changes.store_on_change(steps.where(noon).drop("_day"), base.drop("_day")).select("id", "listing_id")


@query
def day_baseline(spark, d):
    return changes.day_baseline(view(spark, d, "v_obs"), "2024-01-15 00:00:00").select(
        "listing_id", "id", "price", "price_per_round", "in_stock")


@query
def stamp_on_success(spark, d):
    runs = view(spark, d, "v_listings").groupBy("retailer_id").agg(F.count_if(F.col("id") % 3 == 0).alias("saved"))
    runs = runs.withColumn("saved", F.when(F.col("retailer_id") % 2 == 0, F.col("saved")).otherwise(0))
    return changes.stamp_on_success(view(spark, d, "v_retailers"), runs, clock.instant(AS_OF)).select("id", "last_scraped_at")


@query
def stock_stamps(spark, d):
    return changes.stock_stamps(view(spark, d, "v_listings").select("id", "in_stock"), clock.instant(AS_OF))


@query
def ingest_flow(spark, d):
    cards = view(spark, d, "v_titles").select(
        "retailer_id", "source", F.col("id").alias("seq"), "title", "product_url", "page_category", "partkey",
        F.col("title").alias("card_text"), (F.col("partkey") % 90 + 10).cast("double").alias("base_price"),
        F.lit(0.5).alias("display_ppr"))
    bounds, _ = _capture_bounds(spark)
    # The first card of a product decides; equal sequence numbers are told apart by title. The hash, first of the keys,
    # decides nearly every comparison of the sort; the card's text is the title again and travels once.
    first = F.min(F.struct("seq", "title", "source", "page_category", "base_price", "display_ppr")).alias("c")
    cards = cards.groupBy(F.xxhash64("retailer_id", "product_url").alias("_hash"), "retailer_id", "product_url").agg(first)
    cards = cards.select("retailer_id", "product_url", "c.*", F.col("c.title").alias("card_text"))
    out = flows.ingest(cards, bounds, clock.instant(AS_OF))
    return out.select("retailer_id", "retailer_product_id", "caliber_normalized", "manufacturer", "total_rounds",
                      "price_per_round", "in_stock")
