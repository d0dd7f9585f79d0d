"""Data-quality audits, alarms and rollups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farthing.operators.pool import small_table
from farthing.operators.spread import cheapest
from farthing.rulebook import categories

SAMPLES = 5


def bound_lookup(
    df: DataFrame,
    bounds: DataFrame,
    loose: DataFrame | None = None,
    category: str = "caliber_normalized",
    default: tuple[float, float] = (0.15, 3.00),
) -> DataFrame:
    """Add lo and hi: the category's bounds, by slug, then by loose name.

    ``bounds`` has (category, lo, hi), ``loose`` (name, category). Both are
    joined as one prepared table.
    """
    table = bounds.toDF("_cat", "_lo", "_hi")
    if loose is not None:
        names = loose.toDF("_name", "_cat").join(table, "_cat").select(F.col("_name").alias("_cat"), "_lo", "_hi")
        table = table.unionByName(names)
    joined = df.join(table, F.col(category) == F.col("_cat"), "left")
    return (
        joined.withColumn("lo", F.coalesce("_lo", F.lit(default[0])))
        .withColumn("hi", F.coalesce("_hi", F.lit(default[1])))
        .drop("_cat", "_lo", "_hi")
    )


def category_audit(
    listings: DataFrame,
    expected: DataFrame | None = None,
    category: str = "caliber_normalized",
    price: str = "price_per_round",
    min_count: int = 5,
    low: float = 0.05,
    high: float = 5.0,
    mult: float = 3.0,
    default: tuple[float, float] = categories.DEFAULT_EXPECTED_RANGE,
) -> DataFrame:
    """Count, minimum, maximum, mean and severity per category.

    Without ``expected`` the ranges of the tracked catalogue hold.
    """
    if expected is None:
        expected = small_table(listings.sparkSession, categories.EXPECTED_RANGES, "category string, lo double, hi double")
    value = F.col(price).try_cast("double")
    usable = listings.where(F.col(category).isNotNull() & (F.col(category) != "") & (value > 0))
    # The mean is a sum of exact decimals, equal on every partitioning.
    stats = usable.groupBy(category).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(value).alias("min_price"),
        F.max(value).alias("max_price"),
        (F.sum(value.cast("decimal(28,10)")).cast("double") / F.count(F.lit(1))).alias("avg_price"),
    )
    limits = expected.toDF("_cat", "_lo", "_hi")
    joined = stats.join(limits, F.col(category) == F.col("_cat"), "left")
    top = F.coalesce(F.col("_hi"), F.lit(default[1]))
    few, under = F.col("n") < min_count, F.col("min_price") < low
    over, dear = F.col("max_price") > high, F.col("avg_price") > top * mult
    flags = F.array_compact(
        F.array(
            F.when(few, F.lit("few_listings")),
            F.when(under, F.lit("min_below_floor")),
            F.when(over, F.lit("max_above_ceiling")),
            F.when(dear, F.lit("avg_above_expected")),
        )
    )
    severity = F.when(under | over | dear, "CRITICAL").when(few, "WARNING").otherwise("HEALTHY")
    order = F.when(F.col("severity") == "CRITICAL", 0).when(F.col("severity") == "WARNING", 1).otherwise(2)
    return (
        joined.select(category, "n", "min_price", "max_price", "avg_price", severity.alias("severity"),
                      F.array_join(flags, ",").alias("flags"))
        .withColumn("severity_rank", order)
    )


def over_ceiling(
    history: DataFrame,
    listings: DataFrame,
    bounds: DataFrame,
    default: tuple[float, float] = (0.15, 3.00),
    loose: DataFrame | None = None,
) -> DataFrame:
    """History rows above their category's ceiling, with category and bound.

    Rows without a listing are not judged; see ``matching.orphans``.
    """
    known = bound_lookup(
        listings.select(F.col("id").alias("listing_id"), "caliber_normalized"), bounds, loose, default=default
    ).drop("lo")
    value = F.col("price_per_round").cast("double")
    return history.join(known, "listing_id").where(value > F.col("hi"))


def over_ceiling_report(rows: DataFrame, samples: int = SAMPLES) -> tuple[DataFrame, DataFrame]:
    """Counts per category and a few sample rows each (lowest ids)."""
    named = rows.withColumn(
        "category", F.coalesce(F.nullif("caliber_normalized", F.lit("")), F.lit("(null category)"))
    )
    counts = named.groupBy("category", "hi").agg(F.count(F.lit(1)).alias("over_count"))
    return counts, cheapest(named, ["category"], ["id"], samples)


def distinct_members(
    history: DataFrame, listings: DataFrame, start: Column, end: Column, by: str = "retailer_id"
) -> DataFrame:
    """Distinct listings seen in [start, end) per group.

    Listings are deduplicated before the count, so a hot group is counted
    from partial results.
    """
    window = history.where((F.col("recorded_at") >= start) & (F.col("recorded_at") < end))
    seen = window.select("listing_id").where(F.col("listing_id").isNotNull()).distinct()
    known = listings.select(F.col("id").alias("listing_id"), by).where(F.col(by).isNotNull())
    return seen.join(known, "listing_id").groupBy(by).agg(F.count(F.lit(1)).alias("listing_count"))


def written_in_window(listings: DataFrame, cutoff: Column, by: Sequence[str] = ("retailer_id", "caliber_normalized")):
    """Rows written since the cutoff per (retailer, category) and per retailer.

    The coarse count rolls up the fine one.
    """
    fine = listings.where(F.col("last_updated") >= cutoff).groupBy(*by).agg(F.count(F.lit(1)).alias("written"))
    return fine, fine.groupBy(by[0]).agg(F.sum("written").alias("written"))


def coverage_counters(
    listings: DataFrame, by: str, column: str, derived: Column, samples: int = SAMPLES
) -> tuple[DataFrame, DataFrame]:
    """Totals, in-stock, missing and missing-but-derivable per group, plus a
    few derivable sample rows."""
    stocked = F.coalesce(F.col("in_stock"), F.lit(False))
    missing = F.col(column).isNull()
    staged = listings.withColumn("_derived", derived)
    able = missing & F.col("_derived").isNotNull()
    counters = staged.groupBy(by).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(stocked).alias("in_stock_count"),
        F.count_if(missing).alias("null_total"),
        F.count_if(missing & stocked).alias("null_in_stock"),
        F.count_if(able).alias("derivable_total"),
        F.count_if(able & stocked).alias("derivable_in_stock"),
    )
    counters = counters.withColumn(
        "null_pct_in_stock", F.try_divide(F.col("null_in_stock") * 100.0, F.col("in_stock_count"))
    )
    examples = cheapest(staged.where(able), [by], ["id"], samples)
    return counters, examples


def value_distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first and NULL last."""
    stocked = F.coalesce(F.col("in_stock"), F.lit(False))
    return (
        df.groupBy(column)
        .agg(F.count(F.lit(1)).alias("total"), F.count_if(stocked).alias("in_stock_count"))
        .orderBy(F.col(column).isNull(), F.col("total").desc(), F.col(column))
    )


def transition_matrix(changes: DataFrame, old: str = "old_value", new: str = "new_value") -> DataFrame:
    return changes.groupBy(old, new).agg(F.count(F.lit(1)).alias("rows"))


def transition_report(
    changes: DataFrame, by: str = "retailer_id", old: str = "old_value", new: str = "new_value",
    per_group: int = 3, overall: int = 30, per_pair: int = 2,
) -> dict[str, DataFrame]:
    """Top transitions per group and overall, and varied sample rows."""
    fine = changes.groupBy(by, old, new).agg(F.count(F.lit(1)).alias("rows"))
    order = [F.col("rows").desc(), F.col(old), F.col(new)]
    top = cheapest(fine, [by], order, per_group, "rank")
    total = fine.groupBy(old, new).agg(F.sum("rows").alias("rows")).orderBy(*order).limit(overall)
    return {"per_group": top, "overall": total, "samples": cheapest(changes, [old, new], ["id"], per_pair)}


def top_values(df: DataFrame, by: Sequence[str], column: str, k: int) -> DataFrame:
    """The k most common values per group (ties by value)."""
    counted = df.groupBy(*by, column).agg(F.count(F.lit(1)).alias("rows"))
    return cheapest(counted, by, [F.col("rows").desc(), F.col(column)], k, "rank")


def freshness_rollup(listings: DataFrame, by: Sequence[str], as_of: Column) -> DataFrame:
    """Rows, in-stock rows, newest update and its age in hours per group."""
    age = (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(F.col("newest").cast("timestamp"))) / F.lit(3.6e9)
    return (
        listings.groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.coalesce(F.col("in_stock"), F.lit(False))).alias("in_stock_count"),
            F.max("last_updated").alias("newest"),
        )
        .withColumn("age_hours", age)
    )


def failure_cause(verdict: Column, status: Column, redirect: Column, n_products: Column) -> Column:
    """First cause of a FAIL verdict."""
    cause = (
        F.when(status.isNull(), F.lit("UNREACHABLE"))
        .when(status >= 400, F.concat(F.lit("HTTP_"), status.cast("string")))
        .when(redirect, F.lit("REDIRECT"))
        .when(n_products == 0, F.lit("ZERO_PRODUCTS"))
        .otherwise(F.lit("LOW_GATE_WITH_CARDS"))
    )
    return F.when(verdict == "FAIL", cause)


def verdict_rollup(results: DataFrame, by: str = "retailer") -> tuple[DataFrame, DataFrame]:
    """Verdicts per source, and failures per (source, cause)."""
    verdicts = ["PASS", "NEEDS_REVIEW", "FAIL"]
    counts = results.groupBy(by).agg(
        *[F.count_if(F.col("verdict") == v).alias(v.lower()) for v in verdicts]
    )
    counts = counts.withColumn("no_pass", F.col("pass") == 0)
    cause = failure_cause(F.col("verdict"), F.col("status"), F.col("redirect"), F.col("n_products"))
    causes = (
        results.withColumn("cause", cause).where(F.col("cause").isNotNull())
        .groupBy(by, "cause").agg(F.count(F.lit(1)).alias("rows"))
    )
    return counts, causes


def request_priority(requests: DataFrame, name: str = "retailer_name") -> DataFrame:
    """Requests per name, most wanted first."""
    return requests.groupBy(name).agg(F.count(F.lit(1)).alias("requests")).orderBy(F.col("requests").desc(), name)


def run_over_run(current: DataFrame, previous: DataFrame, key: str = "retailer_id", base: int = 5, drop: float = 0.5):
    """CRITICAL when a real baseline fell to zero, WARN when it lost more than
    ``drop``. Both inputs are (key, n) counts."""
    now = current.toDF(key, "current_count")
    before = previous.toDF(key, "previous_count")
    joined = before.where(F.col("previous_count") >= base).join(now, key, "left")
    joined = joined.withColumn("current_count", F.coalesce("current_count", F.lit(0).cast("bigint")))
    severity = F.when(F.col("current_count") == 0, "CRITICAL").when(
        F.col("current_count") < F.col("previous_count") * (1 - drop), "WARN"
    )
    return joined.withColumn("severity", severity).where(F.col("severity").isNotNull())


def coverage_gap(
    expected: DataFrame, observed: DataFrame, retailers: DataFrame, window_start: Column,
    key: str = "retailer_id", category: str = "caliber_normalized", exempt: Sequence[int] = (),
) -> DataFrame:
    """Expected categories without a row, per retailer that finished a run in
    the window and saved something."""
    finished = retailers.where(F.col("last_scraped_at") >= window_start).select(F.col("id").alias(key))
    if exempt:
        finished = finished.where(~F.col(key).isin(list(exempt)))
    saved = observed.groupBy(key).agg(F.sum("written").alias("saved")).where(F.col("saved") > 0)
    wanted = expected.select(key, category).distinct().join(finished, key, "left_semi")
    sizes = wanted.groupBy(key).agg(F.count(F.lit(1)).alias("expected"))
    missing = wanted.join(observed.where(F.col("written") > 0).select(key, category), [key, category], "left_anti")
    return (
        missing.groupBy(key)
        .agg(F.count(F.lit(1)).alias("missing"), F.array_join(F.sort_array(F.collect_set(category)), ", ").alias("categories"))
        .join(sizes, key)
        .join(saved, key)
    )


def stale_alarm(
    retailers: DataFrame, as_of: Column, hours: float = 8, slow: Sequence[str] = (), slow_hours: float = 72
) -> DataFrame:
    """Retailers whose last success is older than their threshold; a missing
    stamp never alarms."""
    age = (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(F.col("last_scraped_at").cast("timestamp"))) / F.lit(3.6e9)
    limit = F.when(F.col("slug").isin(list(slow)), F.lit(float(slow_hours))).otherwise(F.lit(float(hours)))
    staged = retailers.withColumn("age_hours", age).withColumn("threshold_hours", limit)
    return staged.where(F.col("age_hours") > F.col("threshold_hours")).withColumn("severity", F.lit("CRITICAL"))


def cache_alarm(cache: DataFrame, as_of: Column, hours: float = 6) -> DataFrame:
    """One row when a materialised table is empty or too old, else none."""
    newest = cache.agg(F.max("refreshed_at").alias("newest"))
    age = (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(F.col("newest").cast("timestamp"))) / F.lit(3.6e9)
    staged = newest.withColumn("age_hours", age)
    reason = F.when(F.col("newest").isNull(), "empty").when(F.col("age_hours") > hours, "stale")
    return staged.withColumn("reason", reason).where(F.col("reason").isNotNull()).withColumn(
        "severity", F.lit("CRITICAL")
    )


def empty_source_alarm(results: DataFrame, key: str = "retailer", threshold: int = 3) -> DataFrame:
    """Sources with at least ``threshold`` empty first pages; fewer is a WARN."""
    empty = (F.col("page_no") == 1) & (F.col("n_products") == 0)
    counted = results.groupBy(key).agg(F.count_if(empty).alias("empty_pages")).where(F.col("empty_pages") > 0)
    return counted.withColumn("severity", F.when(F.col("empty_pages") >= threshold, "FAIL").otherwise("WARN"))


def constraint_audit(df: DataFrame, checks: dict[str, Column], unique: Sequence[Sequence[str]] = ()) -> DataFrame:
    """Violations per rule: rows failing a check, surplus rows of a key.

    A check that is NULL passes, as in SQL. All row checks share one scan.
    """
    row = df.agg(*[F.count_if(~c).alias(name) for name, c in checks.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"`{n}`").alias("violations")) for n in checks])
    out = row.select(F.explode(pairs).alias("_p")).select("_p.rule", "_p.violations")
    for keys in unique:
        present = df
        for k in keys:
            present = present.where(F.col(k).isNotNull())
        twins = present.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(
            F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n") - 1)), F.lit(0)).alias("violations")
        )
        out = out.unionByName(twins.select(F.lit("unique(" + ",".join(keys) + ")").alias("rule"), "violations"))
    return out


# -- comparisons ----------------------------------------------------------------

def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of one side only, tagged; NULLs compare as equal."""
    only_left = left.subtract(right).withColumn("side", F.lit("left"))
    return only_left.unionByName(right.subtract(left).withColumn("side", F.lit("right")))


def additive_diff(before: DataFrame, after: DataFrame, key: str, value: str, allowed: Sequence[str]) -> DataFrame:
    """Changed verdicts: a flip fails, NULL → allowed is a pickup, NULL →
    anything else fails."""
    old = before.select(F.col(key).alias("_key"), F.col(value).alias("before"))
    new = after.select(F.col(key).alias("_new"), F.col(value).alias("after"))
    joined = old.join(new, F.col("_key").eqNullSafe(F.col("_new")), "right")
    changed = joined.where(~F.col("before").eqNullSafe(F.col("after")))
    outcome = (
        F.when(F.col("before").isNotNull(), "flip")
        .when(F.col("after").isin(list(allowed)), "pickup")
        .otherwise("unexpected")
    )
    return changed.select(F.col("_new").alias(key), "before", "after", outcome.alias("outcome"))


def table_compare(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """Keys whose value differs or that exist on one side only."""
    a = left.select(F.col(key), F.col(value).alias("left_value"), F.lit(True).alias("_l"))
    b = right.select(F.col(key), F.col(value).alias("right_value"), F.lit(True).alias("_r"))
    joined = a.join(b, key, "full")
    status = (
        F.when(F.col("_r").isNull(), "only_left").when(F.col("_l").isNull(), "only_right").otherwise("differs")
    )
    differs = F.col("_l").isNull() | F.col("_r").isNull() | ~F.col("left_value").eqNullSafe(F.col("right_value"))
    return joined.where(differs).select(key, "left_value", "right_value", status.alias("status"))


def change_of_record(stored: DataFrame, fresh: DataFrame, keys: Sequence[str], measured: Sequence[str]) -> DataFrame:
    """Fresh records that are new or differ in a measured field.

    Stamp fields are not measured, so an unchanged measurement writes nothing.
    """
    old = stored.select(*[F.col(k).alias(f"_o_{k}") for k in keys], F.struct(*measured).alias("_old"))
    on = [F.col(k).eqNullSafe(F.col(f"_o_{k}")) for k in keys]
    joined = fresh.join(old, on, "left")
    return joined.where(~F.struct(*measured).eqNullSafe(F.col("_old"))).select(*fresh.columns)
