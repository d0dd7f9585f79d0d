"""Joins of many with many, the trigram index, and automatic slices, against plain loops."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from farthing.operators import matching, series, spread, stats, substring


def counted(df):
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("pairs", [1, 40, 3000, 10**9])
def test_block_join(spark, pairs):
    """Some keys on one side only, one key with most rows of both."""
    rnd = random.Random(2)
    keys = ["hot"] * 60 + ["a", "b", "c", None]
    left = [(rnd.choice(keys), i) for i in range(150)]
    right = [(rnd.choice(keys + ["d"]), f"r{i}") for i in range(90)]
    want = Counter((k, i, j) for k, i in left for o, j in right if k is not None and k == o)
    got = spread.block_join(
        spark.createDataFrame(left, "k string, i int"), spark.createDataFrame(right, "k string, j string"), ["k"], "i", "j", pairs=pairs)
    assert got.columns == ["k", "i", "j"] and counted(got) == want


def test_hot_key_is_many_blocks(spark):
    """A third of both sides under one key: no task holds more than a few hundredths of the pairs."""
    left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("i"))
    right = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(-F.col("id")).alias("k"), F.col("id").alias("j"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        met = spread.block_join(left, right, ["k"], "i", "j", pairs=4000)
        sizes = [r["count"] for r in met.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 1_000_000 and max(sizes) < 50_000 and len(sizes) > 50


@pytest.mark.parametrize("few", [0, 3, 10**6])
def test_containing(spark, few):
    rnd = random.Random(5)
    letters = "abcé-"
    texts = [(rnd.choice(["x", "y", "z", None]), i, "".join(rnd.choice(letters) for _ in range(rnd.randrange(0, 14)))) for i in range(120)]
    texts += [("x", 900, None), ("x", 901, "a😀bc"), ("y", 902, "line\nbreak")]
    words = [(rnd.choice(["x", "y", "w", None]), "".join(rnd.choice(letters) for _ in range(rnd.randrange(0, 6))), i) for i in range(60)]
    words += [("x", None, 900), ("x", "😀bc", 901), ("y", "e\nb", 902), ("x", "abc", 903), ("x", "abc", 904)]
    want = Counter((k, i, t, w, n) for k, i, t in texts for o, w, n in words if k is not None and k == o and t is not None and w is not None and w in t)
    got = substring.containing(
        spark.createDataFrame(texts, "k string, i int, t string"), spark.createDataFrame(words, "k string, w string, n int"), ["k"], "t", "w", "i", few=few)
    assert counted(got.select("k", "i", "t", "w", "n")) == want and len(want) > 300
    none = substring.containing(spark.createDataFrame(texts, "k string, i int, t string"), spark.createDataFrame([], "k string, w string, n int"), ["k"], "t", "w", "i")
    assert none.count() == 0


def test_index_proposes_few_pairs(spark):
    """Looked up under its rarest trigram, a word meets few texts that do not contain it."""
    rnd = random.Random(1)
    names = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(300)]
    texts = [("k", i, f"https://www.shop.example.com/{rnd.choice(names)}-{rnd.choice(names)}-{i}") for i in range(2000)]
    df = spark.createDataFrame(texts, "k string, i int, t string")
    words = spark.createDataFrame([("k", n) for n in names] + [("k", "com/")], "k string, w string")
    rare = substring.rarest_grams(df, words, ["k"], "t", "w")
    tested = rare.agg(F.sum("_texts")).first()[0]
    matches = sum(n in t for _, _, t in texts for n in [*names, "com/"])
    assert matches <= tested <= 3 * matches


def test_alias_join_with_a_hot_key(spark, monkeypatch):
    listing = "id long, manufacturer string, caliber_normalized string, grain int, bullet_type string, product_url string, retailer_product_id string"
    listings = spark.createDataFrame([(i, "Fed", "9mm", 115, "FMJ", "u", "p") for i in range(200)] + [(900, "CCI", "9mm", 115, "FMJ", "u", "p")], listing)
    spec = spark.createDataFrame([(i, "Fed", "9mm", 115, "FMJ", "s", "l", 1) for i in range(50)] + [(90, "Maker", "9mm", 115, "FMJ", "s", "l", 1)],
                                 "id long, brand string, caliber_normalized string, grain int, bullet_type string, sku string, product_line string, muzzle_velocity_fps int")
    whole = spread.block_join
    monkeypatch.setattr(matching, "block_join", lambda *a, **k: whole(*a, **k, pairs=500))
    got = counted(matching.alias_join(spec, listings, {"Maker": ["CCI", "Maker"]}, {}))
    assert got == Counter([(s, i) for s in range(50) for i in range(200)] + [(90, 900)])


NAN, INF = float("nan"), float("inf")


def test_slices_keep_the_order(spark):
    """Cut or not, a key's rows are scanned alike; nulls, infinities and NaN come where Spark sorts them."""
    rnd = random.Random(9)
    data = [("a", rnd.choice([rnd.uniform(-9, 9), None, NAN, INF, -INF, 3.0]), i, rnd.choice([None, None, i])) for i in range(400)]
    data += [("b", 1.0, i, i if i % 7 == 0 else None) for i in range(60)] + [(None, float(i), i, None if i % 3 else i) for i in range(90)]
    df = spark.createDataFrame(data, "k string, t double, i int, v int")
    plain = series.locf(df, ["k"], ["t", "i"], "v")
    cut = spread.auto_slices(df, ["k"], "t", hot_rows=20)
    assert cut.where("k = 'a'").select("_slice").distinct().count() > 15
    assert cut.where("k = 'b'").select("_slice").distinct().count() == 1
    assert counted(series.locf(df, ["k"], ["t", "i"], "v", hot_rows=20).select("k", "i", "v")) == counted(plain.select("k", "i", "v"))
    starts = F.coalesce(F.col("v") % 2 == 0, F.lit(False))
    one, many = (series.islands(df, ["k"], ["t", "i"], starts, hot_rows=n).select("k", "i", "island") for n in (10**9, 20))
    assert counted(one) == counted(many)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "string", "decimal(12,3)"])
def test_slices_of_other_types(spark, kind):
    base = {"decimal(12,3)": "cast(id as decimal(12,3))", "string": "cast(id as string)"}.get(kind, f"cast(date_add(DATE '2024-01-01', cast(id as int)) as {kind})")
    df = spark.range(100).select(F.lit("a").alias("k"), F.expr(base).alias("t"), F.col("id"))
    cut = spread.auto_slices(df, ["k"], "t", hot_rows=10)
    assert cut.select("_slice").distinct().count() == (1 if kind == "string" else 10)
    assert cut.groupBy("_slice").agg(F.min("id").alias("a"), F.max("id").alias("b")).orderBy("_slice").collect() == sorted(
        cut.groupBy("_slice").agg(F.min("id").alias("a"), F.max("id").alias("b")).collect(), key=lambda r: r.a)


def test_order_statistics_of_any_sign(spark):
    rnd = random.Random(4)
    groups = {
        "mixed": [rnd.uniform(-5, 5) for _ in range(301)], "three": [-1.0, 0.0, 2.0], "low": [-3.0], "zero": [0.0, -0.0, 0.0],
        "crowded": [1e9 + rnd.random() for _ in range(500)], "edges": [-INF, INF, NAN, 1e-320, -1e300, 1e308], "ties": [7.0] * 40 + [-7.0] * 41,
    }
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in [*vs, None]], "k string, v double").repartition(5)
    got = {r.k: (r.n, r.median) for r in stats.upper_median(df, ["k"], "v").collect()}
    order = lambda v: (v != v, v if v == v else 0.0)
    assert got == {k: (len(v), sorted(v, key=order)[len(v) // 2]) for k, v in groups.items()}
    middle = {r.k: r.median for r in stats.interpolated_median(df.where("k <> 'edges'"), ["k"], "v").collect()}
    for k, v in groups.items():
        if k != "edges":
            s = sorted(v)
            assert middle[k] == pytest.approx((s[(len(v) - 1) // 2] + s[len(v) // 2]) / 2, rel=1e-12)
    whole = spark.createDataFrame([("a", i - 50) for i in range(101)], "k string, v int")
    assert stats.upper_median(whole, ["k"], "v").first().median == 0


def test_cells_rise_with_the_value(spark):
    values = sorted([0.0, 1e-320, 1.0, 1.0000001, 2.5, 1e308, INF, -1e-320, -1.0, -2.5, -1e308, -INF])
    df = spark.createDataFrame([(v,) for v in [*values, NAN]], "v double").withColumn("cell", stats.signed_cell(F.col("v")))
    cells = [r.cell for r in df.collect()]
    assert cells == sorted(cells) and len(set(cells)) >= len(cells) - 1


def test_lookup_asks_for_few_stretches(spark):
    """Numbers that share their trigrams: every pair that the lookup makes is a hit."""
    texts = spark.createDataFrame([("k", i, f"https://shop.example.com/ring-{i:06d}") for i in range(3000)], "k string, i int, t string")
    words = spark.createDataFrame([("k", f"-{i:06d}") for i in range(3000)], "k string, w string")
    assert substring.stretches(texts, words, ["k"], "t", "w").count() == 3000
    got = substring.containing(texts, words, ["k"], "t", "w", "i", few=0)
    assert {(r.i, r.w) for r in got.collect()} == {(i, f"-{i:06d}") for i in range(3000)} and got.count() == 3000
