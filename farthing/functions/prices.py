"""Price arithmetic and plausibility gates as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from farthing.rulebook import categories as fixed


def positive(price: Column, finite: bool = False) -> Column:
    """Present, not NaN and above zero (``finite`` also excludes infinity).

    Spark orders NaN above every number, so NaN needs its own test.
    """
    value = price.cast("double")
    test = price.isNotNull() & ~F.isnan(value) & (value > 0)
    return test & (value < float("inf")) if finite else test


def half_even(value: Column, digits: int) -> Column:
    """Round to ``digits`` decimals, exact ties of the binary value to even.

    ``bround`` decides on the shortest decimal text of a double, so 2.675
    (which is a little less than that) would round up. Here the product with
    the power of ten is split into its rounded value and its exact error
    (Dekker's product); only an exact half without error is a tie.
    """
    x = value.cast("double")
    if digits == 0:
        return F.rint(x)
    scale = 10.0**digits
    product = x * scale

    def split(v):
        big = v * 134217729.0
        high = big - (big - v)
        return high, v - high

    high, low = split(x)
    big = scale * 134217729.0
    scale_high = big - (big - scale)
    scale_low = scale - scale_high
    error = ((high * scale_high - product) + high * scale_low + low * scale_high) + low * scale_low
    half = product - F.floor(product) == 0.5
    nearest = (
        F.when(half & (error > 0), F.floor(product) + 1)
        .when(half & (error < 0), F.floor(product))
        .otherwise(F.rint(product))
    )
    return nearest.cast("double") / scale


def unit_price(total: Column, count: Column, digits: int = 4) -> Column:
    return half_even(F.try_divide(total.cast("double"), count.cast("double")), digits)


def derived_count(total: Column, unit: Column, minimum: int = 1) -> Column:
    """Pack size implied by total and unit price.

    ``minimum`` 1 lifts a zero result to one; a higher minimum rejects smaller
    results instead (a card that shows only its unit price is not a pack).
    """
    shown = F.when(unit.cast("double") > 0, unit.cast("double"))
    raw = half_even(total.cast("double") / shown, 0).cast("bigint")
    if minimum <= 1:
        return F.when(raw < 1, F.lit(1)).otherwise(raw)
    return F.when(raw >= minimum, raw)


def cents(text: Column) -> Column:
    """Unit price printed as a number followed by a cent sign."""
    found = F.nullif(F.regexp_extract(text, "(\\d+\\.?\\d*)¢", 1), F.lit(""))
    return found.try_cast("double") / 100


def inconsistent(
    unit: Column,
    total: Column,
    count: Column,
    relative: float = fixed.INCONSISTENT_RELATIVE,
    absolute: float = fixed.INCONSISTENT_ABSOLUTE,
) -> Column:
    """Unit price off from total/count by both margins; false if unknowable."""
    base, packs = total.try_cast("double"), count.try_cast("double")
    known = (base > 0) & (packs > 0)
    expected = F.try_divide(base, F.nullif(packs, F.lit(0.0)))
    gap = F.abs(unit.cast("double") - expected)
    off = (F.try_divide(gap, F.nullif(expected, F.lit(0.0))) > relative) & (gap > absolute)
    return F.coalesce(known & off, F.lit(False))


def gate_reason(
    unit: Column,
    total: Column,
    count: Column,
    low: Column,
    high: Column,
    absolute: tuple[float, float] = (fixed.ABSOLUTE_LOW, fixed.ABSOLUTE_HIGH),
) -> Column:
    """Why a price is rejected, or 'ok'. The first failing test names it."""
    value = unit.try_cast("double")
    return (
        F.when(value.isNull(), F.lit("null"))
        .when((value < absolute[0]) | (value > absolute[1]), F.lit("absolute"))
        .when(value < low, F.lit("floor"))
        .when(value > high, F.lit("ceiling"))
        .when(inconsistent(value, total, count), F.lit("inconsistent"))
        .otherwise(F.lit("ok"))
    )


def amount(text: Column) -> Column:
    """Number of a money text such as ``$1,299.50``; NULL when unreadable."""
    return F.regexp_replace(text, "[$,]", "").try_cast("double")


def split_decimal_price(text: Column) -> Column:
    """``$11 99`` (dollars and cents apart), else ``$11.99``."""
    apart = r"(?U)\$\s*(\d{1,4}(?:,\d{3})*)\s+(\d{2})\b"
    dollars = F.regexp_replace(F.regexp_extract(text, apart, 1), ",", "").try_cast("double")
    cents_part = F.regexp_extract(text, apart, 2).try_cast("double")
    joined = F.regexp_extract(F.replace(text, F.lit(","), F.lit("")), r"\$\s*(\d{1,4}\.\d{1,2})", 1)
    return F.coalesce(dollars + cents_part / 100.0, joined.try_cast("double"))


def _amounts(text: Column, pattern: str) -> Column:
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    return F.filter(F.transform(found, lambda s: F.regexp_replace(s, ",", "").try_cast("double")),
                    lambda v: v.isNotNull())


def lowest_price(text: Column) -> Column:
    """Lowest dollar amount of a text (a sale price undercuts the regular)."""
    return F.array_min(_amounts(text, r"\$\s*(\d{1,5}(?:,\d{3})*(?:\.\d{1,2})?)"))


def sale_or_regular(sale: Column, regular: Column, block: Column) -> Column:
    """Sale price, then the regular one, then the lowest of the price block."""
    one = r"\$?\s*(\d{1,5}(?:,\d{3})*(?:\.\d{1,2})?)"

    def read(text):
        return F.regexp_replace(F.regexp_extract(text, one, 1), ",", "").try_cast("double")

    return F.coalesce(read(sale), read(regular), lowest_price(block))


def split_by_size(text: Column) -> Column:
    """Amounts below 1 are unit prices, above 1 totals: (unit_price, total).

    The first unit price and the lowest total; both NULL when either is
    missing.
    """
    every = _amounts(text, r"\$(\d+\.?\d*)")
    unit = F.get(F.filter(every, lambda v: v < 1), F.lit(0))
    total = F.array_min(F.filter(every, lambda v: v > 1))
    return F.when(unit.isNotNull() & total.isNotNull(), F.struct(unit.alias("unit_price"), total.alias("total")))


def single_price(text: Column) -> Column:
    """First amount of a card; NULL when the card shows a price range."""
    found = F.regexp_extract_all(text, F.lit(r"\$(\d{1,4}(?:,\d{3})*(?:\.\d{1,2})?)"), F.lit(1))
    first, second = F.get(found, F.lit(0)), F.get(found, F.lit(1))
    value = F.regexp_replace(first, ",", "").try_cast("double")
    return F.when((second.isNull() | (first == second)) & (value > 0), value)


def ordered_mean(values: Column) -> Column:
    """Mean of an array added strictly left to right.

    Equal bits on every partitioning, unlike ``avg``; NULL for an empty array.
    """
    total = F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)
    return F.try_divide(total, F.size(values))
