"""Joins of listings with offers, specifications and dimension tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farthing.functions import rules, text
from farthing.operators.spread import block_join, cheapest
from farthing.operators.substring import containing
from farthing.rulebook import categories, packs
from farthing.sources.scratch import stored

KEY = ("brand", "caliber_normalized", "grain", "bullet_type")


def orphans(history: DataFrame, listings: DataFrame) -> DataFrame:
    """History rows without a listing; reported, never deleted."""
    return history.join(listings.select(F.col("id").alias("listing_id")), "listing_id", "left_anti")


def members_only(history: DataFrame, pool: DataFrame) -> DataFrame:
    """History rows whose listing is in the pool."""
    return history.join(pool.select(F.col("id").alias("listing_id")), "listing_id", "left_semi")


def dedupe_min_id(df: DataFrame, keys: Sequence[str], id_col: str = "id") -> DataFrame:
    """One row per key, the one with the smallest id."""
    return cheapest(df, keys, [id_col], 1).drop("_rank")


def first_seen(df: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """First row per key in crawl order (``dropDuplicates`` keeps any row)."""
    return cheapest(df, keys, [seq], 1).drop("_rank")


def discovery_overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """How many keys two discovery lists share, and how many each has alone."""
    a = left.select(F.col(key)).distinct().withColumn("_l", F.lit(1))
    b = right.select(F.col(key)).distinct().withColumn("_r", F.lit(1))
    return a.join(b, key, "full").agg(
        F.count_if(F.col("_l").isNotNull() & F.col("_r").isNotNull()).alias("shared"),
        F.count_if(F.col("_r").isNull()).alias("only_left"),
        F.count_if(F.col("_l").isNull()).alias("only_right"),
    )


def with_label(
    df: DataFrame, dim: DataFrame, key: str, dim_key: str = "id", label: str = "slug", out: str = "slug"
) -> DataFrame:
    """Dimension label by id; an unknown id reads ``id:<n>``."""
    small = dim.select(F.col(dim_key).alias("_dim"), F.col(label).alias("_label"))
    joined = df.join(small, F.col(key) == F.col("_dim"), "left")
    default = F.concat(F.lit("id:"), F.col(key).cast("string"))
    return joined.withColumn(out, F.coalesce("_label", default)).drop("_dim", "_label")


def lateral_top1(
    bounds: DataFrame,
    catalog: DataFrame,
    case_material: str = "Brass",
    condition: str = "New",
) -> DataFrame:
    """Per (cal, lo, hi) row the cheapest in-stock listing inside the bounds.

    Ties go to the smaller id. Each map task ships at most one row per row of
    ``bounds``.
    """
    stocked = catalog.where(
        F.col("in_stock") & (F.col("case_material") == case_material) & (F.col("condition_type") == condition)
    )
    price = F.col("price_per_round").cast("double")
    hit = (F.col("cal") == F.col("caliber_normalized")) & (price >= F.col("lo")) & (price <= F.col("hi"))
    return cheapest(stocked.join(bounds, hit), ["cal", "lo", "hi"], [price, F.col("id")], 1).drop("_rank")


def cascade_evict(
    retailers: DataFrame, listings: DataFrame, history: DataFrame, retailer_id: int
) -> dict[str, DataFrame]:
    """Take a retailer out: its listings, their history, its active flag.

    ``evicted`` counts the rows that go. ``evict_remains`` counts what is left of the
    retailer in the tables as they were written.
    """
    gone = listings.where(F.col("retailer_id") == retailer_id).select(F.col("id").alias("listing_id"))
    kept_listings = listings.where(~F.coalesce(F.col("retailer_id") == retailer_id, F.lit(False)))
    kept_history = history.join(gone, "listing_id", "left_anti")
    parked = retailers.withColumn(
        "is_active", F.when(F.col("id") == retailer_id, F.lit(False)).otherwise(F.col("is_active"))
    )
    evicted = _counted({"listings_evicted": gone, "history_evicted": history.join(gone, "listing_id", "left_semi")})
    return {"retailers": parked, "listings": kept_listings, "history": kept_history, "evicted": evicted}


def evict_remains(before: DataFrame, listings: DataFrame, history: DataFrame, retailer_id: int) -> DataFrame:
    """How many rows of the retailer two written tables still hold; ``before`` are the listings as they were."""
    gone = before.where(F.col("retailer_id") == retailer_id).select(F.col("id").alias("listing_id"))
    left = listings.where(F.col("retailer_id") == retailer_id)
    return _counted({"listings_remaining": left, "history_remaining": history.join(gone, "listing_id", "left_semi")})


def _counted(tables: dict[str, DataFrame]) -> DataFrame:
    """One row with the number of rows of each."""
    tagged = [df.select(F.lit(name).alias("what")) for name, df in tables.items()]
    every = tagged[0]
    for more in tagged[1:]:
        every = every.unionByName(more)
    return every.agg(*[F.count_if(F.col("what") == n).alias(n) for n in tables])


# -- rebates --------------------------------------------------------------------

def _class_gate(kind: Column, category: Column, product_type: Column, classes: dict, prefixes, types) -> Column:
    shot = product_type.isin(list(types))
    for prefix in prefixes:
        shot = shot | category.startswith(prefix)
    gate = F.when(kind == "shotshell", F.coalesce(shot, F.lit(False)))
    for name, members in classes.items():
        gate = gate.when(kind == name, F.coalesce(category.isin(list(members)), F.lit(False)))
    return gate.otherwise(F.lit(True))


def keyword_match_best(
    rebates: DataFrame,
    eligible: DataFrame,
    listings: DataFrame,
    classes: dict | None = None,
    prefixes: Sequence[str] = tuple(categories.SHOTSHELL_CATEGORY_PREFIXES),
    types: Sequence[str] = tuple(categories.SHOTSHELL_TYPES),
) -> DataFrame:
    """Best amount per (rebate, listing) over the rebate's product lines.

    A line matches listings of the rebate's brand whose url contains its
    keyword, subject to the rebate's class. Lines of one keyword and class
    are looked up once, through an index of trigrams. Ties go to the first
    line (``line_no``).
    """
    classes = classes or categories.REBATE_CLASS_CATEGORIES
    offer = rebates.select(
        F.col("id").alias("rebate_id"), "brand", F.col("firearm_type").alias("kind"), "amount_max_per_unit"
    )
    amount = F.coalesce(F.col("amount_override"), F.col("amount_max_per_unit")).cast("double")
    keyword = F.coalesce(
        text.truthy(F.col("match_pattern")), F.replace(F.lower(F.col("product_line")), F.lit(" "), F.lit("-"))
    )
    lines = (
        eligible.join(offer, "rebate_id")
        .select("rebate_id", F.col("brand").alias("manufacturer"), "kind", "line_no", amount.alias("amount"), keyword.alias("keyword"))
        .where(F.col("amount").isNotNull() & F.col("keyword").isNotNull())
    )
    # Of a rebate's lines with one keyword, the best is the same for every listing.
    best = F.max_by(F.struct("amount", "line_no", "keyword"), F.struct(F.col("amount"), -F.col("line_no")))
    offers = lines.groupBy("rebate_id", "manufacturer", "kind", F.lower("keyword").alias("_word")).agg(best.alias("_line"))
    chosen = listings.select(
        F.col("id").alias("listing_id"), F.col("manufacturer"), F.lower("product_url").alias("_url"),
        "caliber_normalized", "bullet_type",
    )
    gate = _class_gate(F.col("kind"), F.col("caliber_normalized"), F.col("bullet_type"), classes, prefixes, types)
    met = containing(chosen, offers, ["manufacturer"], "_url", "_word", "listing_id").where(gate)
    word = F.col("_best.keyword")
    reason = F.concat(
        F.lit("url_contains:"), word,
        F.when(text.truthy(F.col("kind")).isNotNull(), F.concat(F.lit(";firearm_type:"), F.col("kind"))).otherwise(""),
    )
    top = F.max_by("_line", F.struct(F.col("_line.amount"), -F.col("_line.line_no")))
    pairs = met.groupBy("rebate_id", "listing_id", "kind").agg(top.alias("_best"))
    return pairs.select("rebate_id", "listing_id", F.col("_best.amount").alias("amount"), reason.alias("match_reason"))


def amount_rollup(matches: DataFrame, by: str = "rebate_id") -> DataFrame:
    """Highest amount and number of matches per parent."""
    return matches.groupBy(by).agg(F.max("amount").alias("amount_max"), F.count(F.lit(1)).alias("match_count"))


def match_counts(matches: DataFrame) -> DataFrame:
    """Matches per (amount, reason)."""
    return matches.groupBy("amount", "match_reason").agg(F.count(F.lit(1)).alias("match_count"))


# -- specifications -------------------------------------------------------------

def _squeezed(value: Column) -> Column:
    return F.regexp_replace(F.lower(text.filled(value)), "[^a-z0-9]", "")


def _expand(value: Column, aliases: dict[str, Sequence[str]]) -> Column:
    chain = None
    for name, others in aliases.items():
        listed = F.array(*[F.lit(o) for o in others])
        chain = F.when(value == name, listed) if chain is None else chain.when(value == name, listed)
    own = F.array(value)
    return own if chain is None else chain.otherwise(own)


def _usable_spec(spec: DataFrame) -> DataFrame:
    """Specification rows with a whole key."""
    usable = spec.where(
        text.truthy(F.col("brand")).isNotNull()
        & text.truthy(F.col("caliber_normalized")).isNotNull()
        & F.col("grain").isNotNull()
        & text.truthy(F.col("bullet_type")).isNotNull()
    )
    return usable.withColumn("_type", F.upper(F.trim("bullet_type")))


def _spec_keys(spec: DataFrame, brand_aliases: dict, type_aliases: dict) -> DataFrame:
    """Specification keys with one row per listing spelling they reach."""
    return (
        _usable_spec(spec)
        .withColumn("_l_brand", F.explode(_expand(F.col("brand"), brand_aliases)))
        .withColumn("_l_type", F.explode(_expand(F.col("_type"), type_aliases)))
    )


def _one_value(value: str) -> Column:
    """Whether the rows of a group carry one value; NULL is a value."""
    known = F.count(value)
    return (known == 0) | ((known == F.count(F.lit(1))) & (F.min(value) == F.max(value)))


def _listing_keys(listings: DataFrame) -> DataFrame:
    return listings.select(
        F.col("id").alias("listing_id"),
        F.trim(text.filled(F.col("manufacturer"))).alias("_m"),
        F.col("caliber_normalized").alias("_c"),
        F.col("grain").alias("_g"),
        F.upper(F.trim("bullet_type")).alias("_t"),
        F.concat(_squeezed(F.col("product_url")), _squeezed(F.col("retailer_product_id"))).alias("_blob"),
    )


#: Key columns of the listings' side.
REACHED = ["_m", "_c", "_g", "_t"]


def _reaching(keys: DataFrame) -> DataFrame:
    """Specification keys under the names of the listings' key columns."""
    names = dict(zip(["_l_brand", "caliber_normalized", "grain", "_l_type"], REACHED))
    return keys.select("*", *[F.col(k).alias(n) for k, n in names.items()]).drop("_l_brand", "_l_type")


def alias_join(
    spec: DataFrame, listings: DataFrame, brand_aliases: dict | None = None, type_aliases: dict | None = None
) -> DataFrame:
    """Specification rows × listings with equal keys under the aliases.

    Aliases are exploded on the specification side, so the join stays an
    equality join of four columns; keys with very many rows on both sides
    are joined block by block. Listing ids are taken to be unique.
    """
    keys = _spec_keys(
        spec,
        packs.LINE_BRAND_ALIASES if brand_aliases is None else brand_aliases,
        packs.LINE_TYPE_ALIASES if type_aliases is None else type_aliases,
    )
    reach = _reaching(keys).select(F.col("id").alias("spec_id"), *REACHED).distinct()
    rows = _listing_keys(listings).select("listing_id", *REACHED)
    return block_join(rows, reach, REACHED, "listing_id", "spec_id").select("spec_id", "listing_id")


def _colliding(keys: DataFrame, value: str) -> DataFrame:
    """Keys whose rows carry two or more distinct values (NULL is a value)."""
    group = ["brand", "caliber_normalized", "grain", "_type"]
    return (
        keys.groupBy(*group)
        .agg((~_one_value(value)).alias("_collides"), F.min("id").alias("_key_ord"))
    )


def _tokens(rows: DataFrame, value: str, stop: Sequence[str]) -> DataFrame:
    """Tokens of a colliding key that stand for exactly one value.

    A token is a squeezed SKU of four or more characters or a line word of
    three or more outside the stop list.
    """
    group = ["brand", "caliber_normalized", "grain", "_type"]
    sku = _squeezed(F.col("sku"))
    words = F.filter(
        F.split(F.lower(text.filled(F.col("product_line"))), "[^a-z0-9]+"),
        lambda w: (F.length(w) >= 3) & ~w.isin(list(stop)),
    )
    listed = F.concat(
        F.when(F.length(sku) >= 4, F.array(F.struct(sku.alias("token"), F.lit(True).alias("is_sku")))).otherwise(
            F.array().cast("array<struct<token:string,is_sku:boolean>>")
        ),
        F.transform(words, lambda w: F.struct(w.alias("token"), F.lit(False).alias("is_sku"))),
    )
    flat = rows.select(*group, "id", "sku", F.col(value).alias("_value"), F.posexplode(listed).alias("_at", "_tok"))
    first = F.struct("id", "_at")
    return (
        flat.groupBy(*group, F.col("_tok.token").alias("token"))
        .agg(
            _one_value("_value").alias("_one"),
            F.max("_tok.is_sku").alias("is_sku"),
            F.min(first).alias("_first"),
            F.min_by(F.struct(F.col("id").alias("spec_id"), "sku", "_value"), first).alias("_row"),
        )
        .where("_one")
        .select(
            *group, "token", "is_sku",
            F.struct(
                (-F.length("token")).alias("neg_len"), F.col("_first.id").alias("row"), F.col("_first._at").alias("at"),
                F.col("token").alias("token"), F.col("_row._value").alias("value"),
                F.col("_row.spec_id").alias("spec_id"), F.col("_row.sku").alias("sku"),
            ).alias("entry"),
        )
    )


def resolve_lines(
    spec: DataFrame,
    listings: DataFrame,
    value: str = "muzzle_velocity_fps",
    stop: Sequence[str] = tuple(packs.LINE_STOP_WORDS),
    brand_aliases: dict | None = None,
    type_aliases: dict | None = None,
) -> DataFrame:
    """Per (colliding key, listing): resolved by SKU or word, or held.

    A token counts when it occurs in the listing's squeezed url and product
    id; a token inside a longer counting token is dropped. One distinct value
    left resolves the listing to the row that introduced the longest token;
    several hold it as ambiguous; none tries the words after the SKUs, then
    holds it without a line.
    """
    brand_aliases = packs.LINE_BRAND_ALIASES if brand_aliases is None else brand_aliases
    type_aliases = packs.LINE_TYPE_ALIASES if type_aliases is None else type_aliases
    group = ["brand", "caliber_normalized", "grain", "_type"]
    keys = _spec_keys(spec, brand_aliases, type_aliases)
    plain = _usable_spec(spec)
    colliding = _colliding(plain, value).where("_collides")
    tokens = _tokens(plain.join(colliding.select(*group), group, "left_semi"), value, stop)
    reach = _reaching(keys.select(*group, "_l_brand", "_l_type").distinct().join(colliding.select(*group, "_key_ord"), group))
    # A listing has one spelling, so it meets a key once.
    candidates = stored(_listing_keys(listings).join(reach, REACHED).select("listing_id", "_blob", *group, "_key_ord"), "candidates")
    usable = ~F.col("is_sku") | F.col("token").rlike("[a-z]") | (F.length("token") >= 5)
    met = containing(candidates, tokens.where(usable), group, "_blob", "token", "listing_id")
    row = ["listing_id", *group, "_key_ord"]
    none = tokens.schema["entry"].dataType
    found = met.select(*row, "is_sku", "entry").unionByName(
        candidates.select(*row, F.lit(None).cast("boolean").alias("is_sku"), F.lit(None).cast(none).alias("entry"))
    )
    per = found.groupBy(*row).agg(
        F.array_sort(F.collect_list(F.when(F.col("is_sku"), F.col("entry")))).alias("_sku"),
        F.array_sort(F.collect_list(F.when(~F.col("is_sku"), F.col("entry")))).alias("_word"),
    )

    def outermost(entries):
        return F.filter(
            entries,
            lambda e: ~F.exists(
                entries, lambda o: (F.length(o["token"]) > F.length(e["token"])) & F.contains(o["token"], e["token"])
            ),
        )

    def values(entries):
        # A struct keeps NULL as a value of its own.
        return F.size(F.array_distinct(F.transform(entries, lambda e: F.struct(e["value"]))))

    per = per.withColumn("_sku", outermost(F.col("_sku"))).withColumn("_word", outermost(F.col("_word")))
    by_sku, by_word = values(F.col("_sku")), values(F.col("_word"))
    status = (
        F.when(by_sku == 1, "sku").when(by_sku >= 2, "ambiguous")
        .when(by_word == 1, "word").when(by_word >= 2, "ambiguous").otherwise("no_line")
    )
    chosen = F.when(F.col("status") == "sku", F.get("_sku", F.lit(0))).when(
        F.col("status") == "word", F.get("_word", F.lit(0))
    )
    staged = per.withColumn("status", status).withColumn("_pick", chosen)
    reason = F.when(
        F.col("status") == "sku", F.concat(F.lit("line-resolved sku="), F.coalesce(F.col("_pick.sku"), F.lit("None")))
    ).when(F.col("status") == "word", F.concat(F.lit("line-resolved kw="), F.col("_pick.token")))
    return staged.select(
        "listing_id", *group[:3], F.col("_type").alias("bullet_type"), "_key_ord", "status",
        F.col("_pick.spec_id").alias("spec_id"), reason.alias("match_reason"),
    )


def specification_matches(
    spec: DataFrame,
    listings: DataFrame,
    value: str = "muzzle_velocity_fps",
    brand_aliases: dict | None = None,
    type_aliases: dict | None = None,
) -> DataFrame:
    """All matches: every candidate of an unambiguous key, the resolved ones
    of a colliding key (a listing under several keys follows the last one)."""
    brand_aliases = packs.LINE_BRAND_ALIASES if brand_aliases is None else brand_aliases
    type_aliases = packs.LINE_TYPE_ALIASES if type_aliases is None else type_aliases
    group = ["brand", "caliber_normalized", "grain", "_type"]
    plain = _usable_spec(spec)
    clear = plain.join(_colliding(plain, value).where(~F.col("_collides")).select(*group), group, "left_semi")
    reason = F.concat(
        F.lit("brand="), "brand", F.lit(" cal="), "caliber_normalized", F.lit(" gr="), F.col("grain").cast("string"),
        F.lit(" bullet="), "bullet_type",
    )
    named = clear.select(F.col("id").alias("spec_id"), reason.alias("match_reason"))
    one = alias_join(clear.select(*spec.columns), listings, brand_aliases, type_aliases).join(named, "spec_id")
    lines = resolve_lines(spec, listings, value, brand_aliases=brand_aliases, type_aliases=type_aliases)
    settled = cheapest(lines.where(F.col("spec_id").isNotNull()), ["listing_id"], [F.col("_key_ord").desc()], 1)
    return one.select("spec_id", "listing_id", "match_reason").unionByName(
        settled.select("spec_id", "listing_id", "match_reason")
    )


def match_coverage(listings: DataFrame, matches: DataFrame, brands: Sequence[str], by: Sequence[str]) -> DataFrame:
    """In-stock, non-component listings of the brands per key: matched or held."""
    scope = listings.where(
        F.col("in_stock") & ~F.coalesce(F.col("is_component"), F.lit(False))
        & F.trim("manufacturer").isin(list(brands))
    )
    seen = matches.select(F.col("listing_id").alias("id"), F.lit(1).alias("_hit")).dropDuplicates(["id"])
    return scope.join(seen, "id", "left").groupBy(*by).agg(
        F.count(F.lit(1)).alias("candidates"),
        F.count("_hit").alias("resolved"),
        F.count_if(F.col("_hit").isNull()).alias("held"),
    )
