from datetime import datetime, timedelta
import random

import pytest

from farthing.operators import retention
from farthing.plans import flows
from farthing.sources import sinks

SCHEMA = "id long, listing_id long, price_per_round double, in_stock boolean, recorded_at timestamp_ntz"
AS_OF = "2024-06-01 00:00:00"


def frames(spark, rows):
    listings = spark.createDataFrame([(1, "9mm"), (2, None), (3, "zzz")], "id long, caliber_normalized string")
    floors = spark.createDataFrame([("9mm", 0.10)], "category string, floor double")
    return spark.createDataFrame(rows, SCHEMA), listings, floors


def actions(spark, rows, **kwargs):
    return {r.id: r.action for r in retention.retention_plan(*frames(spark, rows), AS_OF, **kwargs).collect()}


def test_literal_cases(spark):
    t = lambda h, day=1, month=4: datetime(2024, month, day, h)
    rows = [
        (1, 1, 0.2, True, t(2)), (2, 1, 0.2, True, t(1)), (3, 1, 0.2, True, t(1)), (4, 1, 0.3, True, t(3)),
        (10, 1, 0.05, True, t(1, 2)), (11, 1, 0.15, True, t(2, 2)), (12, 1, 0.5, True, t(3, 2)),
        (20, 1, None, True, t(1, 3)), (21, 1, 0.1, False, t(2, 3)),
        (30, 1, 0.1, False, t(1, 1, 1)), (31, 1, 0.1, False, t(2, 1, 1)),
        (40, 99, 0.1, True, t(1)), (41, None, 0.1, True, t(1)), (50, 1, 0.1, True, datetime(2024, 5, 20)),
        (60, 2, 0.01, True, t(1)), (61, 2, float("nan"), True, t(2)), (62, 2, float("inf"), True, t(3)),
    ]
    got = actions(spark, rows)
    assert got == {
        1: "tier1", 2: "keep", 3: "tier1", 4: "tier1", 10: "keep", 11: "keep", 12: "tier1", 20: "tier1", 21: "keep",
        30: "tier2", 31: "tier2", 40: "orphan", 41: "orphan", 60: "keep", 61: "tier1", 62: "tier1",
    }


def random_rows(n=2000):
    rnd = random.Random(2)
    return [
        (i, rnd.choice([1, 1, 1, 2, 3, 8]), rnd.choice([None, 0.05, 0.1, 0.2, 0.3]), rnd.choice([True, False, None]),
         datetime(2024, 1, 1) + timedelta(hours=rnd.randint(0, 3000)))
        for i in range(n)
    ]


def test_hot_groups_change_nothing(spark):
    rows = random_rows()
    assert actions(spark, rows) == actions(spark, rows, hot_rows=3)


def test_invariants_hold_and_catch_a_broken_plan(spark):
    plan = retention.retention_plan(*frames(spark, random_rows()), AS_OF)
    report = retention.retention_invariants(plan, max_share=0.99).first().asDict()
    zero = [k for k in report if k not in ("examined", "deletes", "keeps", "orphans")]
    assert all(report[k] == 0 for k in zero)
    assert report["deletes"] + report["keeps"] + report["orphans"] == report["examined"]
    from pyspark.sql import functions as F

    broken = plan.withColumn("action", F.when(F.col("action") == "keep", "tier2").otherwise(F.col("action")))
    bad = retention.retention_invariants(broken).first()
    assert bad.group_min_lost > 0 and bad.expired_in_stock > 0 and bad.over_band == 1


def test_delete_set_round_trip(spark, tmp_path):
    rows = random_rows(600)
    history, listings, floors = frames(spark, rows)
    plan = retention.retention_plan(history, listings, floors, AS_OF)
    path = str(tmp_path / "ids")
    counts = {r.action: r.rows for r in sinks.write_delete_set(retention.delete_ids(plan), path).collect()}
    left = sinks.execute_delete_set(history, plan, path)
    assert left.count() == len(rows) - sum(counts.values())
    other = retention.retention_plan(history.where("id > 5"), listings, floors, AS_OF)
    with pytest.raises(ValueError):
        sinks.execute_delete_set(history, other, path)
    with pytest.raises(ValueError):
        flows.thin_history(history, listings, floors, AS_OF, path)


def test_open_days_are_not_touched(spark):
    """A run in the middle of a day leaves that day's rows of the month before alone."""
    rows = [(i, 1, p, True, datetime(2024, 1, 1, h)) for i, (h, p) in enumerate([(9, 0.5), (10, 0.6), (18, 0.4)])]
    rows += [(9, 1, 0.3, True, datetime(2023, 12, 31, 23, 59))]
    plan = retention.retention_plan(*frames(spark, rows), "2024-01-31 12:00:00")
    assert [(r.id, r.action) for r in plan.collect()] == [(9, "keep")]


def test_absolute_limit_is_an_argument(spark):
    plan = retention.retention_plan(*frames(spark, random_rows(300)), AS_OF)
    assert retention.retention_invariants(plan, max_share=1.0).first().over_band == 0
    assert retention.retention_invariants(plan, max_deletes=1, max_share=1.0).first().over_band == 1


def test_observations_have_ids_of_their_own(spark):
    from farthing.functions import clock

    listings = spark.createDataFrame([(1, 5.0, 0.1, True), (2, 5.0, 0.2, True)], "id long, base_price double, price_per_round double, in_stock boolean")
    ids = [r.id for day in ("2024-01-01 00:00:00", "2024-01-02 00:00:00") for r in flows.observations_to_write(listings, clock.instant(day)).collect()]
    assert len(set(ids)) == 4
