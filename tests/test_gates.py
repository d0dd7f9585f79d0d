import random

import pytest
from pyspark.sql import functions as F

from farthing.functions import prices
from farthing.operators import enrich
from farthing.rulebook import categories

CASES = [
    ("308win", 1.08, 500, 1.08, "inconsistent"), ("9mm", 28.39, 50, 1.42, "inconsistent"),
    ("22lr", 245.0, 100, 0.123, "inconsistent"), ("300blk", 110.0, 50, 0.88, "inconsistent"),
    ("223-556", 259.0, 20, 12.95, "absolute"), ("357mag", 58.82, 499, 0.1179, "floor"),
    ("38spl", 88.26, 501, 0.1762, "floor"), ("357mag", 14.91, 200, 0.0746, "floor"),
    ("22lr", 11.0, 100, 0.10, "ok"), ("357mag", 34.99, 50, 0.66, "ok"), ("223-556", 12.0, 20, 0.55, "ok"),
    ("22lr", 13.0, 100, 0.10, "ok"), (None, 88.26, 501, 0.1762, "ok"), ("9mm", None, 50, 0.30, "ok"),
    ("9mm", 15.0, None, 0.30, "ok"), ("9mm", 0.0, 50, 0.30, "ok"), ("9mm", 15.0, 0, 0.30, "ok"),
    ("9mm", 15.0, 50, None, "null"), ("9mm", 100.0, 50, 2.0, "ceiling"), ("223", 5.0, 50, 0.1, "floor"),
]


@pytest.fixture(scope="module")
def bounds(spark):
    return (
        spark.createDataFrame(categories.CAPTURE_BOUNDS, "category string, lo double, hi double"),
        spark.createDataFrame(list(categories.LOOSE_CATEGORY_KEYS.items()), "name string, category string"),
    )


def test_gate_literal_cases(spark, bounds):
    rows = [(i, *c) for i, c in enumerate(CASES)]
    df = spark.createDataFrame(
        rows, "i int, caliber_normalized string, base_price double, total_rounds int, price_per_round double, want string"
    )
    got = enrich.gated_prices(df, *bounds).select("i", "want", "gate_reason").collect()
    assert [(r.i, r.want, r.gate_reason) for r in got if r.want != r.gate_reason] == []
    assert len(got) == len(CASES)


def test_half_even_is_exact(spark):
    rnd = random.Random(5)
    values = [2.675, 0.125, 625.34625, 1.00005, 0.0] + [rnd.randint(0, 10**8) / rnd.choice([1e5, 2e4, 64, 3]) for _ in range(5000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for digits in (0, 1, 2, 4):
        got = [r[0] for r in df.select(prices.half_even(F.col("x"), digits)).collect()]
        assert got == [float(round(v, digits)) for v in values]


def test_derive_unit_price(spark):
    df = spark.createDataFrame(
        [(10.49, 100, 0.10), (10.49, None, 0.10), (0.2, None, 0.9), (5.0, None, None), (10.0, 0, 0.5)],
        "base_price double, total_rounds int, display_ppr double",
    )
    got = [(r.total_rounds, r.price_per_round) for r in enrich.derive_unit_price(df).collect()]
    assert got == [(100, 0.1049), (105, 0.0999), (1, 0.2), (None, None), (20, 0.5)]
    kept = [(r.total_rounds, r.price_per_round) for r in enrich.derive_unit_price(df, "keep", 2).collect()]
    assert kept == [(100, 0.10), (105, 0.10), (None, 0.9), (None, None), (20, 0.5)]


def test_pick_variant(spark):
    kind = "handle string, variants array<struct<option1:string,title:string,sku:string,price:string,available:boolean,id:bigint>>"
    df = spark.createDataFrame(
        [
            ("a", [("100", "x", None, "30", True, 1), ("50", "x", None, "20", False, 2), ("50", "y", None, "19", True, 3)]),
            ("b", [(None, "Box 20", None, "9.5", True, 4), (None, "x", "S-1000", "0", True, 5)]),
            ("c", [("5", "x", "S-9", "9", True, 6)]),
            ("d", []),
        ],
        kind,
    )
    got = {r.handle: (r.total_rounds, r.base_price, r.in_stock) for r in enrich.pick_variant(df).collect()}
    assert got == {"a": (50, 20.0, False), "b": (20, 9.5, True)}
    each = sorted(r.retailer_product_id for r in enrich.pick_variant(df, mode="each").collect())
    assert each == ["a-1", "a-2", "a-3", "b-4"]
    first = {r.handle: r.total_rounds for r in enrich.pick_variant(df, mode="first").collect()}
    assert first == {"a": 100, "b": 20}


def test_variant_ids_are_whole(spark):
    kind = "handle string, variants array<struct<option1:string,title:string,sku:string,price:string,available:boolean,id:bigint>>"
    handle = "h" * 110
    df = spark.createDataFrame([(handle, [("50", None, None, "5", True, 1), ("100", None, None, "9", True, 2)])], kind)
    assert sorted(r.retailer_product_id for r in enrich.pick_variant(df, mode="each").collect()) == [f"{handle}-1", f"{handle}-2"]
