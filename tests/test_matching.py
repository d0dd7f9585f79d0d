from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from farthing.functions import clock
from farthing.operators import audit, enrich, matching, pool
from farthing.sources import sinks, tables

LISTING = ("id long, manufacturer string, caliber_normalized string, grain int, bullet_type string, product_url string, "
           "retailer_product_id string")
SPEC = "id long, brand string, caliber_normalized string, grain int, bullet_type string, sku string, product_line string, muzzle_velocity_fps int"


def test_line_resolution(spark):
    spec = spark.createDataFrame(
        [
            (1, "Federal", "9mm", 124, "JHP", "P9HST1", "Personal Defense HST", 1150),
            (2, "Federal", "9mm", 124, "JHP", "9BP", "Hydra Shok", 1120),
            (3, "Federal", "9mm", 124, "JHP", "12345", "Hydra Deep", 1030),
            (4, "CCI", "9mm", 115, "FMJ", "5200", "Blazer Brass", 1145),
            (5, "CCI", None, 115, "FMJ", "x", "y", 1),
        ],
        SPEC,
    )
    rows = [
        (1, "Federal", "9mm", 124, "HP", "https://x/federal-p9hst1-hst", "k"), (2, "Federal ", "9mm", 124, "jhp", "https://x/hydra-shok", "k"),
        (3, "Federal", "9mm", 124, "JHP", "https://x/deep-12345", "k"), (4, "Federal", "9mm", 124, "JHP", "https://x/hst-and-shok", "k"),
        (5, "Federal", "9mm", 124, "JHP", "https://x/plain", "k"), (6, "Blazer", "9mm", 115, "FMJ", "https://x/b", "k"),
        (7, "Federal", "9mm", 124, "FMJ", "https://x/p9hst1", "k"),
    ]
    listings = spark.createDataFrame(rows, LISTING)
    out = {r.listing_id: (r.status, r.spec_id, r.match_reason) for r in matching.resolve_lines(spec, listings).collect()}
    assert out == {
        1: ("sku", 1, "line-resolved sku=P9HST1"), 2: ("word", 2, "line-resolved kw=shok"), 3: ("sku", 3, "line-resolved sku=12345"),
        4: ("ambiguous", None, None), 5: ("no_line", None, None),
    }
    every = {(r.spec_id, r.listing_id) for r in matching.specification_matches(spec, listings).collect()}
    assert every == {(1, 1), (2, 2), (3, 3), (4, 6)}


def test_contained_token_is_suppressed(spark):
    spec = spark.createDataFrame(
        [(1, "A", "c", 1, "T", None, "gold", 100), (2, "A", "c", 1, "T", None, "golden", 200)], SPEC)
    listings = spark.createDataFrame([(1, "A", "c", 1, "t", "x/golden", ""), (2, "A", "c", 1, "t", "x/gold", "")], LISTING)
    out = {r.listing_id: r.spec_id for r in matching.resolve_lines(spec, listings).collect()}
    assert out == {1: 2, 2: 1}


def test_rebate_best_amount(spark):
    rebates = spark.createDataFrame([(1, "Fed", 5.0, "handgun"), (2, "Fed", None, None), (3, "Fed", 1.0, "shotshell")], "id long, brand string, amount_max_per_unit double, firearm_type string")
    lines = spark.createDataFrame(
        [(1, 0, "Gold Dot", None, 3.0), (1, 1, "x", "gold", None), (1, 2, "dot", "", 5.0), (2, 0, "gold", None, None), (3, 0, "gold", None, None)],
        "rebate_id long, line_no int, product_line string, match_pattern string, amount_override double")
    listings = spark.createDataFrame(
        [(1, "Fed", "HTTP://x/Gold-Dot", "9mm", None), (2, "Fed", "x/gold", "12ga-3", None), (3, "Fed", "x/gold", None, "Slug"), (4, "Other", "x/gold", "9mm", None)],
        "id long, manufacturer string, product_url string, caliber_normalized string, bullet_type string")
    got = {(r.rebate_id, r.listing_id): (r.amount, r.match_reason) for r in matching.keyword_match_best(rebates, lines, listings).collect()}
    assert got == {
        (1, 1): (5.0, "url_contains:gold;firearm_type:handgun"), (3, 2): (1.0, "url_contains:gold;firearm_type:shotshell"),
        (3, 3): (1.0, "url_contains:gold;firearm_type:shotshell")}


def test_first_seen_is_crawl_order(spark):
    rows = [("r", "a", 3, "late"), ("r", "a", 1, "first"), ("r", "b", 2, "only"), ("s", "a", 9, "other")]
    df = spark.createDataFrame(rows, "r string, p string, seq int, v string").repartition(5)
    assert sorted(r.v for r in matching.first_seen(df, ["r", "p"], "seq").collect()) == ["first", "only", "other"]


def test_upsert_and_children(spark):
    target = spark.createDataFrame([(1, "a", 1.0, "s1"), (2, "b", 2.0, "s2")], "id int, name string, price double, seen string")
    updates = spark.createDataFrame([(2, None, None), (3, 9.0, "s9")], "id int, price double, seen string")
    got = sorted(map(tuple, sinks.upsert(target, updates, ["id"], sparse=["seen"]).collect()))
    assert got == [(1, "a", 1.0, "s1"), (2, "b", None, "s2"), (3, None, 9.0, "s9")]
    old = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "p int, v string")
    touched = spark.createDataFrame([(1,), (2,)], "p int")
    new = spark.createDataFrame([(1, "n")], "p int, v string")
    assert sorted(map(tuple, sinks.replace_children(old, touched, new, "p").collect())) == [(1, "n"), (3, "z")]


def test_refresh_and_append(spark, tmp_path):
    now = clock.instant("2024-01-01 00:00:00")
    target = str(tmp_path / "cache")
    df = spark.range(5)
    assert sinks.refresh_materialized(df, target, now, first=True) == 5
    assert sinks.refresh_materialized(df.where("id < 2"), target, now) == 2
    with pytest.raises(ValueError):
        sinks.refresh_materialized(df.where("id < 0"), target, now)
    assert sinks.read_materialized(spark, target).count() == 2
    rows = spark.createDataFrame([(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 2))], "listing_id int, recorded_at timestamp_ntz")
    path = str(tmp_path / "history")
    sinks.append_observations(rows, path)
    sinks.append_observations(rows, path)
    back = spark.read.parquet(path)
    assert back.count() == 4 and "PartitionFilters: [isnotnull(day" in back.where("day = '2024-01-01'")._jdf.queryExecution().toString()


def test_telemetry_and_bounds(spark, tmp_path):
    folder = tmp_path / "t"
    folder.mkdir()
    (folder / "a.jsonl").write_text('{"retailer":"r","verdict":"PASS","status":200}\n{bad\n')
    (folder / "b.jsonl").write_text('{"retailer":"s","verdict":"FAIL"}\n')
    good, bad = tables.read_telemetry(spark, str(folder))
    assert sorted(r.retailer for r in good.collect()) == ["r", "s"]
    assert [(r.file.rsplit("/", 1)[-1], r.bad_lines) for r in bad.collect()] == [("a.jsonl", 1)]
    (tmp_path / "b.json").write_text('{"calibers":[{"slug":"9mm","bounds":{"lo":0.1,"hi":2}}]}')
    (tmp_path / "b.csv").write_text("category,lo,hi\n9mm,0.1,2\n")
    for name in ("b.json", "b.csv"):
        assert [tuple(r) for r in tables.read_bounds(spark, str(tmp_path / name)).collect()] == [("9mm", 0.1, 2.0)]
    sinks.append_jsonl(good, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 2


def test_scan_pushdown(spark, tmp_path):
    rows = spark.createDataFrame([(i, datetime(2024, 1, 1) + timedelta(days=i), float(i)) for i in range(10)], "id long, recorded_at timestamp_ntz, price double")
    rows.write.parquet(str(tmp_path / "h"))
    plan = tables.incremental_read(spark.read.parquet(str(tmp_path / "h")), clock.instant("2024-01-05 00:00:00"), ["id"])._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(recorded_at" in plan and "ReadSchema: struct<id:bigint,recorded_at:timestamp_ntz>" in plan


def test_alarms(spark):
    now = clock.instant("2024-01-02 00:00:00")
    at = lambda h: datetime(2024, 1, 2) - timedelta(hours=h)
    dim = spark.createDataFrame([(1, "a", at(9)), (2, "b", at(8)), (3, "w", at(70)), (4, "w2", at(80)), (5, "n", None)], "id int, slug string, last_scraped_at timestamp_ntz")
    assert sorted(r.id for r in audit.stale_alarm(dim, now, 8, ["w", "w2"], 72).collect()) == [1, 4]
    cache = lambda rows: spark.createDataFrame(rows, "refreshed_at timestamp_ntz")
    assert audit.cache_alarm(cache([]), now).first().reason == "empty"
    assert audit.cache_alarm(cache([(at(7),)]), now).first().reason == "stale"
    assert audit.cache_alarm(cache([(at(5),)]), now).count() == 0
    count = lambda rows: spark.createDataFrame(rows, "k int, n long")
    got = {r.retailer_id: r.severity for r in audit.run_over_run(count([(2, 4), (3, 5)]), count([(1, 9), (2, 10), (3, 10), (4, 4)])).collect()}
    assert got == {1: "CRITICAL", 2: "WARN"}


def test_comparisons(spark):
    t = lambda rows: spark.createDataFrame(rows, "k string, v string")
    before, after = t([("a", "1"), ("b", None), ("c", None), ("d", None)]), t([("a", "2"), ("b", "x"), ("c", "y"), ("d", None)])
    got = {r.k: r.outcome for r in audit.additive_diff(before, after, "k", "v", ["x"]).collect()}
    assert got == {"a": "flip", "b": "pickup", "c": "unexpected"}
    diff = {r.k: r.status for r in audit.table_compare(t([("a", "1"), ("b", None)]), t([("b", None), ("c", "1")]), "k", "v").collect()}
    assert diff == {"a": "only_left", "c": "only_right"}
    stamp = lambda rows: spark.createDataFrame(rows, "k string, m int, at int")
    changed = audit.change_of_record(stamp([("a", 1, 1), ("b", None, 1)]), stamp([("a", 1, 9), ("b", None, 9), ("c", 1, 9), ("d", None, 9)]), ["k"], ["m"])
    assert sorted(r.k for r in changed.collect()) == ["c", "d"]
    causes = spark.createDataFrame([("FAIL", None, None, None), ("FAIL", 404, None, None), ("FAIL", 200, True, 3), ("FAIL", 200, False, 0), ("FAIL", 200, False, 9), ("PASS", 200, False, 9)], "verdict string, status int, redirect boolean, n int")
    got = [r[0] for r in causes.select(audit.failure_cause(*[F.col(c) for c in causes.columns])).collect()]
    assert got == ["UNREACHABLE", "HTTP_404", "REDIRECT", "ZERO_PRODUCTS", "LOW_GATE_WITH_CARDS", None]


def test_filters_on_windows_and_ids(spark):
    now = clock.instant("2024-01-02 00:00:00")
    rows = spark.createDataFrame([(1, True, datetime(2024, 1, 1)), (2, False, datetime(2024, 1, 1)), (3, True, datetime(2024, 1, 2))], "id long, in_stock boolean, last_updated timestamp_ntz")
    assert [r.id for r in pool.stale_in_stock(rows, now, 12).collect()] == [1]
    many = spark.range(3000)
    assert pool.exclude_ids(many, list(range(2999))).count() == 1 and pool.exclude_ids(many, []).count() == 3000


def test_source_defaults(spark):
    df = spark.createDataFrame([("h", "Unknown", 0, None, " Vend "), ("h", "CCI", 50, "X", None), ("z", "Unknown", None, None, None)], "source string, manufacturer string, total_rounds long, country_of_origin string, vendor string")
    profile = [("h", "House", 20, "USA")]
    got = [(r.manufacturer, r.total_rounds, r.country_of_origin) for r in enrich.source_defaults(df, profile, "vendor").collect()]
    assert got == [("Vend", 20, "USA"), ("CCI", 50, "USA"), ("Unknown", None, None)]
    assert enrich.source_defaults(df, profile).first().manufacturer == "House"


def test_upsert_takes_the_last_update_of_a_key(spark):
    target = spark.createDataFrame([(1, 5.0), (2, 6.0)], "id int, price double")
    updates = spark.createDataFrame([(1, 7.0, 1), (1, 8.0, 2), (3, 1.0, 1), (3, None, 2), (None, 9.0, 1)], "id int, price double, seq int")
    got = sorted((r.id, r.price) for r in sinks.upsert(target, updates, ["id"], order=["seq"]).collect())
    assert got == [(1, 8.0), (2, 6.0), (3, None)]
    assert [r.price for r in sinks.null_keys(updates, ["id"]).collect()] == [9.0]
    assert sinks.upsert(target, updates.limit(0), ["id"]).count() == 2
