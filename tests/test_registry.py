"""Every registered query against its SQL check on the smallest tables."""

import pytest

duckdb = pytest.importorskip("duckdb")
import pandas as pd  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from farthing.plans.fixtures import TABLES  # noqa: E402
from farthing.plans.oracles import oracles  # noqa: E402
from farthing.plans.queries import REGISTRY  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
# One query per operator family keeps the suite short; the rest run in the correctness check.
SAMPLED = ["segment_floor", "segment_trimmed_mean", "daily_floor_by_retailer", "bucket_floor_locf", "asof_latest",
           "store_on_change_baseline", "retention_invariants", "collision_resolution", "keyword_match_best", "page_verdict",
           "variant_each", "delete_set", "upsert_merge", "sql_pool", "reconcile_stock", "pack_count", "type_url_fallback", "free_shipping", "coverage_gap", "variant_pick",
           "upper_median_signed", "substring_index", "upsert_buckets", "refresh_materialized", "read_telemetry", "thin_days", "sql_bucket_floors", "store_on_change_stream"]


def plain(value):
    if pd.isna(value):
        return None
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, bool) or isinstance(value, str):
        return value
    return float(value) if isinstance(value, (int, float)) else str(value)


def table(frame):
    names = sorted(frame.columns)
    rows = [tuple(plain(v) for v in row) for row in frame[names].astype(object).itertuples(index=False)]
    return names, sorted(rows, key=repr)


@pytest.fixture(scope="module")
def con():
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{FOLDER}/{name}.parquet')")
    return db


def test_every_query_has_a_check():
    """Of the library's own queries; those of the corpus part are tested with it."""
    assert set(REGISTRY) == set(oracles())
    assert set(REGISTRY) <= set(entry.queries()) and set(oracles()) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).columns[:3] == ["caliber_normalized", "bullet_type", "case_material"]


@pytest.mark.parametrize("name", SAMPLED)
def test_against_sql(spark, con, name):
    got = table(entry.queries()[name](spark, FOLDER).toPandas())
    want = table(con.execute(entry.oracle_sql()[name]).df())
    assert got == want


@pytest.mark.parametrize("name", ["segment_floor", "store_on_change", "upper_median"])
def test_result_does_not_depend_on_partitioning(spark, name):
    query = entry.queries()[name]
    want = table(query(spark, FOLDER).toPandas())
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        assert table(query(spark, FOLDER).toPandas()) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_no_pairwise_plans(spark):
    """No operator falls back to comparing all pairs of rows."""
    for name in ("segment_floor", "asof_latest", "keyword_match_best", "collision_resolution", "retention_plan", "store_on_change"):
        plan = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
