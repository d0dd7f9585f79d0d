"""Listing filters: components, outlier caps, the filtered pool."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farthing.functions import predicates, prices
from farthing.operators.stats import upper_median
from farthing.rulebook import categories

LITERAL_IDS = 1000


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A parameter table from the caller's own literal rows.

    Its size is that of a Python argument, so it may be broadcast.
    """
    return F.broadcast(spark.createDataFrame(list(rows), schema))


def optional_eq(df: DataFrame, wanted: dict) -> DataFrame:
    """Equality filters for the given values; None means no filter."""
    for name, value in wanted.items():
        if value is not None:
            df = df.where(F.col(name) == value)
    return df


def exclude_components(df: DataFrame, flag: str = "is_component") -> DataFrame:
    return df.where(~predicates.is_component(F.col(flag)))


def positive_price(df: DataFrame, price: str = "price_per_round", finite: bool = False) -> DataFrame:
    return df.where(prices.positive(F.col(price), finite))


def exclude_ids(df: DataFrame, ids: Sequence[int] | DataFrame, key: str = "id") -> DataFrame:
    """Rows whose key is not listed. A long or distributed list anti-joins."""
    if isinstance(ids, DataFrame):
        return df.join(ids.select(F.col(ids.columns[0]).alias(key)), key, "left_anti")
    if not ids:
        return df
    if len(ids) <= LITERAL_IDS:
        return df.where(~F.coalesce(F.col(key).isin(list(ids)), F.lit(False)))
    listed = df.sparkSession.createDataFrame([(i,) for i in ids], f"{key} bigint")
    return df.join(listed, key, "left_anti")


def outlier_caps(
    listings: DataFrame, by: str = "caliber_normalized", price: str = "price_per_round", mult: float = 5.0
) -> DataFrame:
    """Cap per category: ``mult`` times the upper median of positive prices."""
    usable = listings.where(F.col(by).isNotNull() & (F.col(by) != "")).where(prices.positive(F.col(price)))
    if "is_component" in listings.columns:
        usable = exclude_components(usable)
    middle = upper_median(usable.select(by, F.col(price).cast("double").alias("_price")), [by], "_price")
    return middle.select(by, (F.col("median") * mult).alias("cap"))


def capped_catalog(
    listings: DataFrame, by: str = "caliber_normalized", price: str = "price_per_round", mult: float = 5.0
) -> DataFrame:
    """Non-component listings at or below their category's cap.

    A category without any positive price has no cap and passes untouched.
    """
    base = exclude_components(listings)
    caps = outlier_caps(base, by, price, mult).select(F.col(by).alias("_cap_key"), "cap")
    value = F.col(price).cast("double")
    within = F.col(price).isNotNull() & (value > 0) & (value <= F.col("cap"))
    joined = base.join(caps, F.col(by) == F.col("_cap_key"), "left")
    return joined.where(F.col("cap").isNull() | within).select(*listings.columns)


def price_bounds(
    catalog: DataFrame,
    category: str,
    low: float,
    high: float,
    by: str = "caliber_normalized",
    price: str = "price_per_round",
    mult: float = 5.0,
) -> DataFrame:
    """One row (lo, hi): the cap of the capped catalogue against a hard limit."""
    caps = outlier_caps(catalog.where(F.col(by) == category), by, price, mult)
    return caps.groupBy().agg(
        F.lit(float(low)).alias("lo"), F.least(F.max("cap"), F.lit(float(high))).alias("hi")
    )


def free_shipping(
    df: DataFrame, thresholds: Sequence[tuple[int, float]] | DataFrame, target: int = 0
) -> DataFrame:
    """Listings whose retailer is listed and whose cart reaches its threshold."""
    table = thresholds
    if not isinstance(table, DataFrame):
        table = small_table(df.sparkSession, thresholds, "rid int, thr double")
    keep = predicates.cart_reaches(F.col("price_per_round"), F.col("total_rounds"), F.col("thr"), target)
    hit = (F.col("rid") == F.col("retailer_id")) & keep
    return df.join(table, hit, "left_semi")


def pool(
    catalog: DataFrame,
    category: str | None,
    case_material: str | None = None,
    condition: str | None = None,
    product_type: str | None = None,
    retailer_id: int | None = None,
    weight_atoms: Sequence[tuple[str, float]] | None = None,
    weight_negate: bool = False,
    model_weight: float | None = None,
    model_type: str | None = None,
    brand: tuple | None = None,
    thresholds=None,
    target: int = 0,
) -> DataFrame:
    """The filtered pool over a capped catalogue.

    Deliberately blind to the *current* stock flag: a listing that is out of
    stock today still counts on the days it was seen in stock. ``brand`` is
    (brand, own_aliases, all_aliases, brand_list).
    """
    df = optional_eq(
        catalog,
        {
            "caliber_normalized": category,
            "case_material": case_material,
            "condition_type": condition,
            "bullet_type": product_type,
            "retailer_id": retailer_id,
        },
    )
    df = optional_eq(df, {"grain": model_weight, "bullet_type": model_type})
    df = df.where(predicates.bucket_match(F.col("grain"), weight_atoms, weight_negate))
    if brand is not None:
        df = df.where(predicates.brand_match(F.col("manufacturer"), F.col("product_url"), *brand))
    if thresholds is not None:
        df = free_shipping(df, thresholds, target)
    return df


def stale_in_stock(df: DataFrame, as_of: Column, max_age_hours: float) -> DataFrame:
    """In-stock listings not refreshed within the given age."""
    edge = as_of - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(max_age_hours * 3600.0))
    return df.where(F.col("in_stock") & (F.col("last_updated") < edge))


def active_window(df: DataFrame, as_of: Column, fresh_hours: float = 48.0) -> DataFrame:
    """Offers still valid and submittable on the day, and seen recently."""
    today = F.to_date(as_of)
    edge = as_of - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(fresh_hours * 3600.0))
    return df.where(
        (F.col("valid_through") >= today) & (F.col("submit_by") >= today) & (F.col("last_seen_active_at") >= edge)
    )


def title_filter(df: DataFrame, pattern: str, title: str = "title") -> DataFrame:
    return df.where(F.col(title).rlike("(?i)" + pattern))


def distinct_options(catalog: DataFrame, brand: tuple | None = None) -> DataFrame:
    """One row of sorted option arrays over the capped catalogue.

    Sets are combined map-side; their size is that of the vocabulary.
    """
    def options(name, extra=None):
        keep = F.col(name).isNotNull() & (F.col(name) != "")
        return F.sort_array(F.collect_set(F.when(keep, F.col(name))))

    weight = F.col("grain").cast("double")
    numeric = weight.isNotNull() & ~F.isnan(weight)
    weights = F.sort_array(F.collect_set(F.when(numeric & (weight != 0), F.col("grain"))))
    models = F.array().cast("array<struct<grain:double,bt:string>>")
    if brand is not None:
        kind = F.trim(F.col("bullet_type"), F.lit(predicates.TRIM_SET))
        mine = predicates.brand_match(F.col("manufacturer"), F.col("product_url"), *brand)
        model = F.when(mine & numeric & (kind != ""), F.struct(weight.alias("grain"), kind.alias("bt")))
        models = F.sort_array(F.collect_set(model))
    return catalog.agg(
        weights.alias("grains"),
        options("bullet_type").alias("bullet_types"),
        options("case_material").alias("case_materials"),
        options("caliber_normalized").alias("calibers"),
        models.alias("models"),
    )


def accessory_blocklist(df: DataFrame, title_words, url_words, title: str = "title", url: str = "product_url"):
    """Drop storage, tools and dummy items by words in title or url."""
    from farthing.functions import rules, text

    bad = rules.any_word(F.lower(text.filled(F.col(title))), title_words) | rules.any_word(
        F.lower(text.filled(F.col(url))), url_words
    )
    return df.where(~bad)


def promo_filter(df: DataFrame, marker: str, url: str = "product_url") -> DataFrame:
    """Drop promotional tiles by a url marker."""
    return df.where(~F.coalesce(F.contains(F.col(url), F.lit(marker)), F.lit(False)))


def slug_conflict(
    df: DataFrame,
    table: Sequence[tuple[str, str]] = categories.SLUG_CONFLICTS,
    category: str = "caliber_normalized",
    title: str = "title",
    url: str = "product_url",
) -> DataFrame:
    """Drop rows whose url names a conflicting token that the title hides."""
    from farthing.functions import text

    link, name = F.lower(text.filled(F.col(url))), F.lower(text.filled(F.col(title)))
    clash = F.lit(False)
    for slug, pattern in table:
        flagged = "(?U)" + pattern
        clash = clash | ((F.col(category) == slug) & link.rlike(flagged) & ~name.rlike(flagged))
    return df.where(~F.coalesce(clash, F.lit(False)))


def title_over_category(
    df: DataFrame,
    mode: str = "retag",
    title: str = "title",
    page_category: str = "page_category",
    dual: Sequence[str] = (),
    out: str = "caliber_normalized",
    cascade_rules=None,
) -> DataFrame:
    """Category from the title instead of the page it was listed on.

    ``retag``   take the title's category, drop titles without one.
    ``strict``  keep only titles that name the page's category.
    ``lenient`` keep the page's category unless the title names another.
    A title that names every category of ``dual`` keeps its page's category
    when that is one of them.
    """
    from farthing.functions import rules, text

    if mode not in ("retag", "strict", "lenient"):
        raise ValueError(f"mode must be retag, strict or lenient, got {mode!r}")
    table = cascade_rules or categories.CATEGORY_CASCADE
    named = df.withColumn("_low", F.lower(text.clean_title(F.col(title))))
    named = named.withColumn("_has", rules.letters(F.col("_low")))
    named = rules.settle(named, {"_own": text.category_of(F.col("_low"), table, F.col("_has"))}, apart=True).drop("_has")
    page, own = F.col(page_category), F.col("_own")
    if mode == "strict":
        return named.where(own == page).withColumn(out, own).drop("_low", "_own")
    if mode == "lenient":
        return named.where(own.isNull() | (own == page)).withColumn(out, page).drop("_low", "_own")
    chosen = own
    if dual:
        specs = dict(table)
        both = F.lit(True)
        for name in dual:
            both = both & rules.spec_hit(F.col("_low"), specs[name])
        chosen = F.when(page.isin(list(dual)) & own.isin(list(dual)) & both, page).otherwise(own)
    return named.where(own.isNotNull()).withColumn(out, chosen).drop("_low", "_own")
