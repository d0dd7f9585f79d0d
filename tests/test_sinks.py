"""Bucketed upserts, versions of a materialised table, thinning by day, evictions, pages by card rows."""

import threading
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from farthing.functions import clock
from farthing.operators import matching, pages
from farthing.plans import flows
from farthing.sources import scratch, sinks


def files(folder):
    return {str(p.relative_to(folder)) for p in Path(folder).rglob("*.parquet")}


def test_upsert_touches_its_buckets_only(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(400).select(F.col("id").cast("int").alias("id"), (F.col("id") * 2).alias("v"), F.lit("old").alias("s"))
    sinks.create_buckets(rows, path, ["id"], 16)
    before = files(path)
    updates = spark.createDataFrame([(5, -1, None, 1), (5, -2, None, 2), (7, -3, "new", 1), (9001, -4, "new", 1), (None, 1, "x", 1)], "id long, v long, s string, seq int")
    touched = sinks.upsert_buckets(updates, path, ["id"], 16, ["seq"], sparse=["s"])
    after = files(path)
    kept = {f for f in before if int(f.split("bucket=")[1].split("/")[0]) not in touched}
    assert kept <= after and kept and not (before - kept) & after
    got = {r.id: (r.v, r.s) for r in spark.read.parquet(path).collect()}
    want = {i: (i * 2, "old") for i in range(400)} | {5: (-2, "old"), 7: (-3, "new"), 9001: (-4, "new")}
    assert got == want
    assert sinks.upsert_buckets(updates.where("id is null"), path, ["id"], 16, ["seq"]) == [] and files(path) == after


def test_refreshes_at_once_take_different_versions(spark, tmp_path):
    target, now = str(tmp_path / "cache"), clock.instant("2024-01-01 00:00:00")
    gate = threading.Barrier(4)
    plain = scratch.create_exclusively
    seen = []

    def together(session, path, text):
        if path.endswith("000000000001.json"):
            gate.wait(60)  # all four have read the log before any announces
        made = plain(session, path, text)
        seen.append((path, made))
        return made

    sinks.scratch.create_exclusively = together
    try:
        runs = [threading.Thread(target=lambda n=n: sinks.refresh_materialized(spark.range(n + 1), target, now)) for n in range(4)]
        for r in runs:
            r.start()
        for r in runs:
            r.join()
    finally:
        sinks.scratch.create_exclusively = plain
    known = sorted((r.version, r.rows) for r in sinks.versions(spark, target).collect())
    assert [v for v, _ in known] == [1, 2, 3, 4] and sorted(n for _, n in known) == [1, 2, 3, 4]
    assert sum(made for _, made in seen) == 4 and len(seen) > 4
    for version, rows in known:
        assert sinks.read_materialized(spark, target, version).count() == rows
    assert sinks.read_materialized(spark, target).count() == dict(known)[4]
    with pytest.raises(ValueError):
        sinks.refresh_materialized(spark.range(1), target, now, first=True)
    with pytest.raises(ValueError):
        sinks.read_materialized(spark, target, 9)


LISTING = "id long, caliber_normalized string"
HISTORY = "id long, listing_id long, price double, price_per_round double, in_stock boolean, recorded_at timestamp_ntz"


def test_thin_days_rewrites_old_days_only(spark, tmp_path):
    rows = [(d * 100 + i, 1, 5.0, 1.0 + i, True, datetime(2024, 1, d, i)) for d in (1, 2, 20) for i in range(5)]
    rows += [(300 + i, 1, 5.0, 1.0, False, datetime(2024, 1, 3, i)) for i in range(2)] + [(401, 1, 5.0, 1.0, True, datetime(2024, 1, 4, 0))]
    history, path = spark.createDataFrame(rows, HISTORY), str(tmp_path / "h")
    sinks.append_observations(history, path)
    before = files(path)
    listings = spark.createDataFrame([(1, "9mm")], LISTING)
    floors = spark.createDataFrame([("9mm", 0.1)], "c string, f double")
    days = flows.thin_days(path, listings, floors, "2024-01-22 00:00:00", str(tmp_path / "d"), retention_days=5, expiry_days=10, max_share=1.0)
    assert days == ["2024-01-01", "2024-01-02", "2024-01-03"]
    untouched = {f for f in before if "2024-01-20" in f or "2024-01-04" in f}
    assert untouched <= files(path) and len(untouched) >= 2
    left = {r.id for r in spark.read.parquet(path).collect()}
    assert left == {100, 200, 401, *range(2000, 2005)} and "day=2024-01-03" not in "".join(files(path))
    again = flows.thin_days(path, listings, floors, "2024-01-22 00:00:00", str(tmp_path / "e"), retention_days=5, expiry_days=10)
    assert again == []


def test_second_plan_is_made_from_the_data_as_it_is(spark, tmp_path):
    rows = [(i, 1, 5.0, 1.0 + i, True, datetime(2024, 1, 1, i)) for i in range(5)]
    listings, floors = spark.createDataFrame([(1, "9mm")], LISTING), spark.createDataFrame([("9mm", 0.1)], "c string, f double")
    first, path = spark.createDataFrame(rows, HISTORY), str(tmp_path / "d")
    later = spark.createDataFrame([*rows, (9, 1, 5.0, 0.5, True, datetime(2024, 1, 1, 9))], HISTORY)
    with pytest.raises(ValueError, match="no longer matches"):
        flows.thin_history(first, listings, floors, "2024-03-01 00:00:00", path, max_share=1.0, again=later)
    assert {r.id for r in flows.thin_history(first, listings, floors, "2024-03-01 00:00:00", path, max_share=1.0, again=first).collect()} == {0}


def test_what_an_eviction_leaves_is_counted_on_the_tables(spark):
    listings = spark.createDataFrame([(1, 4), (2, 5), (3, None)], "id long, retailer_id int")
    history = spark.createDataFrame([(10, 1), (11, 2), (12, 1)], "id long, listing_id long")
    retailers = spark.createDataFrame([(4, True), (5, True)], "id int, is_active boolean")
    out = matching.cascade_evict(retailers, listings, history, 4)
    assert tuple(out["evicted"].first()) == (1, 2)
    assert tuple(matching.evict_remains(listings, out["listings"], out["history"], 4).first()) == (0, 0)
    assert tuple(matching.evict_remains(listings, listings, history.where("id < 12"), 4).first()) == (1, 1)


def test_cards_as_rows_judge_like_cards_in_arrays(spark):
    """Pages of all stages, with a title filter, empty cards and cards of no category."""
    titles = [["9mm Luger FMJ"] * 7 + ["Brush"], [], [" ", None, "9mm"], ["45 ACP"] * 9 + ["9mm x"], ["9mm a"] * 4 + ["45 ACP"] * 4, ["zz"] * 6, ["9mm Luger"] * 3]
    rows = []
    for n, cards in enumerate(titles):
        for kind, status, title, pattern in (("caliber", 200, "9mm deals", None), ("parent", 200, "Shop", None), ("caliber", 404, "9mm", None),
                                             ("caliber", 200, "45 ACP deals", None), ("caliber", None, "9mm", None), ("caliber", 200, "9mm Luger", "luger|brush")):
            rows.append((len(rows), "9mm", kind, status, f"https://a.com/{n}", f"https://a.com/{n}/", title, pattern, cards))
    schema = "page int, category string, kind string, status int, requested_url string, landed_url string, title string, title_filter string, card_titles array<string>"
    whole = spark.createDataFrame(rows, schema)
    want = pages.page_verdicts(whole)
    cards = whole.select("page", F.explode("card_titles").alias("card_title"))
    got = pages.card_verdicts(whole.drop("card_titles"), cards, ["page"])
    order = want.columns
    assert sorted(map(str, got.select(*order).collect())) == sorted(map(str, want.select(*order).collect()))


def test_shared_folder_must_be_named_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://elsewhere:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = {}, Context()

    with pytest.raises(ValueError, match="share"):
        scratch.shared_folder(Session())
