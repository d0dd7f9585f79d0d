"""Filter predicates of the listing pool."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

TRIM_SET = " \t\n\r\f\x0b"


def is_component(flag: Column) -> Column:
    """NULL counts as not flagged."""
    return F.coalesce(flag, F.lit(False))


def bucket_match(value: Column, atoms: Sequence[tuple[str, float]] | None, negate: bool = False) -> Column:
    """Any of the (lt|eq|gt, number) atoms, flipped by ``negate``.

    No filter (None) matches all; NULL never matches; NaN fails every atom, so
    it matches exactly when negated.
    """
    if atoms is None:
        return F.lit(True)
    number = value.cast("double")
    hit = F.lit(False)
    for op, bound in atoms:
        test = {"lt": number < bound, "eq": number == bound, "gt": number > bound}.get(op)
        if test is not None:
            hit = hit | test
    answer = ~hit if negate else hit
    return F.when(number.isNull(), F.lit(False)).when(F.isnan(number), F.lit(negate)).otherwise(answer)


def brand_match(
    maker: Column,
    url: Column,
    brand: str,
    own_aliases: Sequence[str],
    all_aliases: Sequence[str],
    brand_list: Sequence[str],
) -> Column:
    """Does a listing belong to ``brand``?

    A present maker decides alone: an alias key maps it, any other spelling
    must equal the brand. Without a maker, the first brand of the ordered list
    that occurs in the url decides.
    """
    bare = F.trim(maker, F.lit(TRIM_SET))
    key = F.lower(bare)
    by_maker = F.when(key.isin(list(all_aliases)), key.isin(list(own_aliases))).otherwise(bare == brand)
    link = F.lower(url)
    by_url = F.lit(False)
    chain = None
    for name in brand_list:
        test, answer = link.contains(name.lower()), F.lit(name == brand)
        chain = F.when(test, answer) if chain is None else chain.when(test, answer)
    if chain is not None:
        by_url = F.coalesce(chain, F.lit(False))
    return (
        F.when(maker.isNotNull() & (maker != ""), by_maker)
        .when(url.isNotNull() & (url != ""), by_url)
        .otherwise(F.lit(False))
    )


def cart_reaches(unit: Column, count: Column, threshold: Column, target: int = 0) -> Column:
    """Does a cart of ``target`` units reach the free-shipping threshold?

    Unknown carts (no price; no pack size while a target is set) are kept, and
    so is any threshold of zero or less.
    """
    missing = count.isNull() | (count <= 0)
    boxes = F.ceil(F.lit(float(target)) / F.nullif(count.cast("double"), F.lit(0.0))) if target > 0 else F.lit(1.0)
    cart = F.when(missing, F.lit(0.0)).otherwise((unit.cast("double") * count.cast("double")) * boxes)
    unknown = unit.isNull() | (missing if target > 0 else F.lit(False))
    return (threshold <= 0) | unknown | (cart >= threshold)
