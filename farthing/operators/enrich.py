"""Catalogue enrichment: text columns in, attribute columns out.

Normalised text is put into columns of its own first, so a long rule cascade
reads it once per row; the cascades themselves are native expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farthing.functions import prices, rules, text
from farthing.operators.pool import small_table
from farthing.rulebook import brands, packs, types


def enrich_category(df: DataFrame, title: str = "title", out: str = "caliber_normalized", table=None) -> DataFrame:
    staged = df.withColumn("_low", F.lower(F.col(title)))
    staged = staged.withColumn("_has", rules.letters(F.col("_low")))
    return rules.settle(staged, {out: text.category_of(F.col("_low"), table, F.col("_has"))}, apart=True).drop("_low", "_has")


def enrich_brand(
    df: DataFrame, title: str = "title", url: str | None = None, out: str = "manufacturer", aliases=None,
    prefixes=None, default: str | None = brands.UNKNOWN_BRAND,
) -> DataFrame:
    """Brand by the longest alias in the title, then the url's leading letters,
    then the longest alias in the url, then the default."""
    staged = df.withColumn("_title_text", text.brand_text(F.col(title)))
    staged = staged.withColumn("_has", rules.letters(F.col("_title_text")))
    by_title = text.longest_alias(F.col("_title_text"), aliases, F.col("_has"))
    rest = [] if default is None else [F.lit(default)]
    if url is None:
        return rules.settle(staged, {out: F.coalesce(by_title, *rest)}, apart=True).drop("_title_text", "_has")
    # The url is prepared only where the title and the leading letters name no brand.
    early = rules.settle(staged, {"_early": F.coalesce(by_title, text.slug_prefix_brand(F.col(url), prefixes))}, apart=True)
    early = early.withColumn("_url_text", F.when(F.col("_early").isNull(), text.brand_text(F.col(url))))
    early = early.withColumn("_has", F.when(F.col("_early").isNull(), rules.letters(F.col("_url_text"))))
    found = F.coalesce(F.col("_early"), text.longest_alias(F.col("_url_text"), aliases, F.col("_has")), *rest)
    return rules.settle(early, {out: found}, apart=True).drop("_title_text", "_has", "_early", "_url_text")


def enrich_type(
    df: DataFrame, title: str = "title", url: str | None = None, out: str = "bullet_type", table=None
) -> DataFrame:
    """Product type by the ordered cascade on the title, else on the url."""
    staged = df.withColumn("_type_text", text.type_text(F.col(title)))
    staged = staged.withColumn("_has", rules.letters(F.col("_type_text")))
    found = text.type_of(F.col("_type_text"), table, F.col("_has"))
    if url is not None:
        staged = rules.settle(staged, {"_by_title": found}, apart=True)
        staged = staged.withColumn("_url_type", F.when(F.col("_by_title").isNull(), text.type_text(F.col(url))))
        staged = staged.withColumn("_has", F.when(F.col("_by_title").isNull(), rules.letters(F.col("_url_type"))))
        found = F.coalesce(F.col("_by_title"), text.type_of(F.col("_url_type"), table, F.col("_has")))
    return rules.settle(staged, {out: found}, apart=True).drop("_type_text", "_has", "_by_title", "_url_type")


def enrich_listing(df: DataFrame, title: str = "title", url: str = "product_url", body: str | None = None) -> DataFrame:
    """All attributes of a catalogue row from its title and url."""
    cleaned = df.withColumn("clean_title", text.clean_title(F.col(title)))
    named = enrich_category(cleaned, "clean_title")
    named = enrich_brand(named, "clean_title", url)
    named = enrich_type(named, "clean_title", url)
    name, note = F.col("clean_title"), F.col(body or title)
    return (
        named.withColumn("grain", text.weight_number(name))
        .withColumn("case_material", text.case_material(name))
        .withColumn("condition_type", text.condition(name))
        .withColumn("country_of_origin", text.origin_country(name))
        .withColumn("purchase_limit", text.purchase_limit(note))
        .withColumn("total_rounds", text.pack_count(name))
        .withColumn("retailer_product_id", text.product_key(F.col(url)))
        .withColumn("is_component", text.component_flag(F.col(url), F.col("total_rounds"), F.col("manufacturer")))
    )


def pack_count_by_source(
    df: DataFrame, profiles: Sequence[tuple[str, str]], source: str = "source", title: str = "title",
    out: str = "total_rounds",
) -> DataFrame:
    """Pack count with the rule set of each row's source.

    Sources that share a rule set share its patterns; an unlisted source has
    no count.
    """
    chain = None
    for rule_set in dict.fromkeys(rule for _, rule in profiles):
        names = [name for name, rule in profiles if rule == rule_set]
        test, value = F.col(source).isin(names), text.pack_count(F.col(title), rule_set)
        chain = F.when(test, value) if chain is None else chain.when(test, value)
    return df.withColumn(out, chain)


PROFILE = "source string, house_brand string, default_pack int, country string"


def source_defaults(df: DataFrame, profiles: Sequence[tuple], vendor: str | None = None) -> DataFrame:
    """Per-source fallbacks for brand, pack size and country.

    The vendor's own name, where given, stands in before the house brand and
    'Unknown' is treated as missing.
    """
    table = small_table(df.sparkSession, [p[:4] for p in profiles], PROFILE).withColumnRenamed("source", "_src")
    joined = df.join(table, F.col("source") == F.col("_src"), "left")
    known = F.nullif(F.col("manufacturer"), F.lit(brands.UNKNOWN_BRAND))
    names = [known] + ([text.truthy(F.trim(F.col(vendor)))] if vendor else [])
    return (
        joined.withColumn("manufacturer", F.coalesce(*names, F.col("house_brand"), F.lit(brands.UNKNOWN_BRAND)))
        .withColumn("total_rounds", F.coalesce(F.nullif(F.col("total_rounds"), F.lit(0)), F.col("default_pack")))
        .withColumn("country_of_origin", F.coalesce(F.col("country"), F.col("country_of_origin")))
        .drop("_src", "house_brand", "default_pack", "country")
    )


def type_with_overrides(df: DataFrame, overrides: Sequence[tuple[str, str]], title: str = "title",
                        out: str = "bullet_type") -> DataFrame:
    """Source-specific phrases first, then the shared cascade."""
    early = rules.ordered_words(F.upper(text.filled(F.col(title))), overrides)
    staged = df.withColumn("_type_text", text.type_text(F.col(title)))
    return rules.settle(staged, {out: F.coalesce(early, text.type_of(F.col("_type_text")))}).drop("_type_text")


def slug_text(title: Column, url: Column) -> Column:
    """Title and url slug as one text."""
    return F.concat_ws(" ", title, F.replace(text.last_segment(url), F.lit("-"), F.lit(" ")))


def component_attributes(df: DataFrame, kind: str = "category", name: str = "product_name", brand: str = "brand"):
    """Parsed attributes by component kind; what cannot be told stays NULL."""
    is_kind = lambda value: F.col(kind) == value
    staged = df.withColumn("_type_text", text.type_text(F.col(name)))
    return (
        staged.withColumn("powder_application", F.when(is_kind("powder"), text.powder_use(F.col(brand), F.col(name))))
        .withColumn("primer_size", F.when(is_kind("primer"), text.primer_size(F.col(name))))
        .withColumn("new_type", F.when(is_kind("bullet"), text.type_of(F.col("_type_text"))))
        .withColumn("new_grain", F.when(is_kind("bullet") & F.col("grain").isNull(), text.bounded_weight(F.col(name))))
        .withColumn("new_caliber", F.when(is_kind("brass"), text.brass_category(F.col(name), F.col(brand))))
        .drop("_type_text")
    )


def fill_null_only(
    df: DataFrame, column: str = "bullet_type", url: str = "product_url", skip_retailers: Sequence[int] = (),
    ambiguous: str = types.AMBIGUOUS_TIP, table=None,
) -> DataFrame:
    """Proposals for missing types only, each row with its outcome.

    A text whose only hit is the ambiguous phrase stays NULL: the phrase is
    removed and the rest decides. Outcomes: kept, excluded_source, no_text,
    no_match, ambiguous_only, fill.
    """
    staged = (
        df.withColumn("_full", text.type_text(F.col(url)))
        .withColumn("_rest", text.type_text(F.regexp_replace(F.col(url), ambiguous, " ")))
        .withColumn("_ambiguous", F.coalesce(F.col(url).rlike(ambiguous), F.lit(False)))
    )
    staged = rules.settle(staged, {"_by_full": text.type_of(F.col("_full"), table)})
    by_rest = F.when(F.col("_ambiguous"), text.type_of(F.col("_rest"), table)).otherwise(F.col("_by_full"))
    staged = rules.settle(staged, {"_by_rest": by_rest})
    outcome = (
        F.when(F.col(column).isNotNull(), "kept")
        .when(F.col("retailer_id").isin(list(skip_retailers)), "excluded_source")
        .when(text.truthy(F.col(url)).isNull(), "no_text")
        .when(F.col("_by_full").isNull(), "no_match")
        .when(F.col("_by_rest").isNull(), "ambiguous_only")
        .otherwise("fill")
    )
    staged = staged.withColumn("outcome", outcome)
    value = F.when(F.col("outcome") == "fill", F.col("_by_rest")).otherwise(F.col(column))
    return staged.withColumn(column, value).drop("_full", "_rest", "_ambiguous", "_by_full", "_by_rest")


def fill_component_types(df: DataFrame, name: str = "product_name") -> DataFrame:
    """Proposals for bullet components without a type, no source skipped."""
    staged = df.where((F.col("category") == "bullet") & F.col("bullet_type").isNull()).withColumn(
        "_type_text", text.type_text(F.col(name))
    )
    named = rules.settle(staged, {"bullet_type": text.type_of(F.col("_type_text"))})
    return named.drop("_type_text").where(F.col("bullet_type").isNotNull())


def fill_brands(df: DataFrame) -> DataFrame:
    """Rows without a maker get one from url and category text, or 'Unknown'."""
    blank = df.where(F.col("manufacturer").isNull()).withColumn(
        "_both", F.concat_ws(" ", text.filled(F.col("product_url")), text.filled(F.col("caliber")))
    )
    return enrich_brand(blank.drop("manufacturer"), "_both").drop("_both")


def reparse_changes(
    df: DataFrame, triggers: Sequence[str] | None = None, url: str = "product_url", column: str = "manufacturer",
    aliases=None,
) -> DataFrame:
    """Rows whose brand, parsed again from the url, differs from the stored.

    An unparsable url keeps its value. With ``triggers`` only changes away
    from those brands and fills of missing ones remain.
    """
    parsed = enrich_brand(df, url, None, "new_value", aliases, default=None)
    old, new = F.col(column), F.col("new_value")
    changed = parsed.where(new.isNotNull() & ~new.eqNullSafe(old))
    if triggers is not None:
        gap = old.isNull() | old.isin("", brands.UNKNOWN_BRAND)
        changed = changed.where(F.coalesce(old.isin(list(triggers)), F.lit(False)) | (gap & (new != brands.UNKNOWN_BRAND)))
    return changed.withColumn("old_value", old)


def bulk_relabel(
    df: DataFrame, statements: Sequence[tuple[str, str | None, str]], column: str = "manufacturer",
    url: str = "product_url",
) -> DataFrame:
    """Ordered (from, url pattern, to) statements on already changed rows.

    The pattern is an ILIKE pattern or None. Each statement reads what the
    ones before it left; runs of statements whose targets no later statement
    of the run reads become one expression.
    """
    out, run, written = df, [], set()

    def flush(frame, batch):
        if not batch:
            return frame
        chain = None
        for old, pattern, new in batch:
            test = F.col(column) == old
            if pattern is not None:
                test = test & F.col(url).ilike(pattern)
            chain = F.when(test, F.lit(new)) if chain is None else chain.when(test, F.lit(new))
        return frame.withColumn(column, chain.otherwise(F.col(column)))

    for statement in statements:
        if statement[0] in written:
            out, run, written = flush(out, run), [], set()
        run.append(statement)
        written.add(statement[2])
    return flush(out, run)


def gated_prices(df: DataFrame, bounds: DataFrame, loose: DataFrame | None = None,
                 default: tuple[float, float] = (0.15, 3.00)) -> DataFrame:
    """Add gate_reason from the category's bounds (see ``prices.gate_reason``)."""
    from farthing.operators.audit import bound_lookup

    staged = bound_lookup(df, bounds, loose, default=default)
    reason = prices.gate_reason(
        F.col("price_per_round"), F.col("base_price"), F.col("total_rounds"), F.col("lo"), F.col("hi")
    )
    return staged.withColumn("gate_reason", reason)


def derive_unit_price(df: DataFrame, mode: str = "derive", minimum: int = 1) -> DataFrame:
    """Unit price and pack size from what a card shows.

    ``derive`` uses price / count where the count is known, else the count
    implied by the displayed unit price, then price / count again. ``keep``
    keeps the displayed unit price. ``minimum`` is the smallest implied count.
    """
    count = F.nullif(F.col("total_rounds").cast("bigint"), F.lit(0))
    implied = prices.derived_count(F.col("base_price"), F.col("display_ppr"), minimum)
    staged = df.withColumn("_count", F.coalesce(count, implied))
    unit = prices.unit_price(F.col("base_price"), F.col("_count"))
    if mode == "keep":
        unit = F.coalesce(F.nullif(F.col("display_ppr"), F.lit(0.0)), unit)
    return staged.withColumn("total_rounds", F.col("_count")).withColumn("price_per_round", unit).drop("_count")


def pick_variant(products: DataFrame, variants: str = "variants", low: int = 10, high: int = 10000,
                 mode: str = "smallest") -> DataFrame:
    """One or more sellable variants per product.

    A variant counts with its option, else its title, else its SKU tail as
    pack size within [low, high], and a positive price. ``smallest`` keeps
    the smallest pack (the first of equals), ``first`` the first variant,
    ``each`` every variant under ``handle-variant`` ids.
    """
    if mode not in ("smallest", "first", "each"):
        raise ValueError(f"mode must be smallest, first or each, got {mode!r}")

    def bounded(value):
        number = value.try_cast("int")
        return F.when(number.between(low, high), number)

    def size(v):
        return F.coalesce(
            bounded(F.regexp_extract(v["option1"], r"^\s*(\d{1,5})\s*$", 1)),
            bounded(F.regexp_extract(v["title"], r"(?U)\b(\d{1,5})\b", 1)),
            bounded(F.regexp_extract(v["sku"], r"-(\d{1,5})$", 1)),
        )

    sized = F.transform(
        F.col(variants),
        lambda v, i: F.struct(
            size(v).alias("rounds"), i.alias("at"), v["price"].try_cast("double").alias("price"),
            v["available"].alias("available"), v["id"].alias("variant_id"),
        ),
    )
    able = F.filter(sized, lambda v: v["rounds"].isNotNull() & (v["price"] > 0))
    rest = [c for c in products.columns if c != variants]
    if mode == "each":
        flat = products.select(*rest, F.explode(able).alias("v"))
        key = F.concat_ws("-", F.col("handle"), F.col("v.variant_id").cast("string"))
    else:
        # Array order is (rounds, position): the smallest pack, first of equals.
        chosen = F.array_min(able) if mode == "smallest" else F.get(able, F.lit(0))
        flat = products.select(*rest, chosen.alias("v")).where(F.col("v").isNotNull())
        key = F.col("handle")
    return flat.select(
        *rest, key.alias("retailer_product_id"), F.col("v.rounds").alias("total_rounds"),
        F.col("v.price").alias("base_price"), F.col("v.available").alias("in_stock"),
        prices.unit_price(F.col("v.price"), F.col("v.rounds")).alias("price_per_round"),
    )


def smallest_label(labels: Column, rule_set: str = "label") -> Column:
    """Smallest credible pack count among option labels."""
    return F.array_min(F.filter(F.transform(labels, lambda s: text.first_match_pack(s, rule_set)),
                                lambda n: n.isNotNull()))


def pack_from_signals(labels: Column, title: Column, sku: Column, rule_set: str = "simple") -> Column:
    """Labels first, then the title, then the SKU's tail."""
    return F.coalesce(
        smallest_label(labels), text.pack_count(title, rule_set), text.pack_count(sku, packs.PACK_RULES["sku_tail"])
    )
