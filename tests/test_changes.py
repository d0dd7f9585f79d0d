import random
from collections import defaultdict
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from farthing.functions import clock
from farthing.operators import changes, spread
from farthing.streaming.store_on_change import store_on_change_stream, write_changes

SCHEMA = "id long, listing_id long, price double, price_per_round double, in_stock boolean, recorded_at timestamp_ntz"


def brute(rows, baseline=()):
    """Sequential fold per listing and day, the definition of the rule."""
    last, written = {}, []
    for r in baseline:
        last[(r[1], r[5].date())] = r
    for r in sorted(rows, key=lambda r: (r[5], r[0])):
        key, prev = (r[1], r[5].date()), last.get((r[1], r[5].date()))

        def same(a, b, tol):
            if a is None or b is None:
                return a is None and b is None
            return abs(a - b) < tol

        if prev and same(prev[2], r[2], 0.005) and same(prev[3], r[3], 0.00005) and bool(prev[4]) == bool(r[4]):
            continue
        last[key] = r
        written.append(r[0])
    return sorted(written)


def drifting(n=3000, seed=3):
    rnd, price, rows = random.Random(seed), 10.0, []
    start = datetime(2024, 1, 1)
    for i in range(n):
        price += rnd.choice([0, 0, 0, 0.002, -0.003, 0.004, 0.02])
        missing = rnd.random() < 0.03
        nan = rnd.random() < 0.01
        listing = 1 if rnd.random() < 0.5 else rnd.randint(2, 5)
        rows.append((
            i, listing, None if missing else float("nan") if nan else round(price, 4), 0.2 + (i // 400) * 0.00003,
            rnd.random() > 0.02 if rnd.random() > 0.01 else None, start + timedelta(seconds=i * 70 + rnd.randint(0, 60)),
        ))
    return rows


def test_literal_cases(spark):
    day = lambda h: datetime(2024, 1, 1, h)
    rows = [(1, 1, 1.000, 0.5, True, day(1)), (2, 1, 1.004, 0.5, True, day(2)), (3, 1, 1.008, 0.5, True, day(3)),
            (4, 1, 1.008, 0.5, True, day(4)), (5, 1, 1.008, 0.5, False, day(5)),
            (6, 1, 1.008, 0.5, False, datetime(2024, 1, 2)), (7, 2, None, None, None, day(1)), (8, 2, None, None, False, day(2))]
    got = changes.store_on_change(spark.createDataFrame(rows, SCHEMA))
    assert sorted(r.id for r in got.collect()) == [1, 3, 5, 6, 7]


def test_matches_sequential_fold_at_any_slicing(spark):
    rows = drifting()
    want = brute(rows)
    assert len(want) < len(rows)
    for slice_minutes, parts in ((15, 1), (240, 7), (1440, 3)):
        df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
        got = changes.store_on_change(df, slice_micros=slice_minutes * 60 * clock.SECOND)
        assert sorted(r.id for r in got.collect()) == want


def test_baseline_and_fail_open(spark):
    rows = drifting(400, 9)
    day = rows[0][5].date()
    today = [r for r in rows if r[5].date() == day]
    early, late = today[: len(today) // 2], today[len(today) // 2 :]
    df = lambda data: spark.createDataFrame(data, SCHEMA)
    base = changes.day_baseline(df(early), f"{day} 00:00:00")
    latest = defaultdict(lambda: None)
    for r in sorted(early, key=lambda r: (r[5], r[0])):
        latest[r[1]] = r
    got = sorted(r.id for r in changes.store_on_change(df(late), base).collect())
    assert got == brute(late, latest.values())
    assert changes.store_on_change(df(late), None, fail_open=True).count() == len(late)


def test_stream_equals_batch(spark, tmp_path):
    rows = drifting(1200, 4)
    source, third = tmp_path / "in", len(rows) // 3
    for k in range(3):
        part = rows[k * third : (k + 1) * third] if k < 2 else rows[2 * third :]
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(source / f"f{k}"))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(source))
    query = (
        store_on_change_stream(stream).writeStream.format("memory").queryName("written").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "cp")).start()
    )
    query.processAllAvailable()
    query.stop()
    got = sorted(r.id for r in spark.table("written").collect())
    batch = sorted(r.id for r in changes.store_on_change(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == batch == brute(rows)
    odd = {r[0] for r in rows if r[2] is not None and r[2] != r[2]}
    assert odd and odd == {r.id for r in spark.table("written").where("isnan(price)").collect()}
    kept = changes.store_on_change(spark.createDataFrame(rows, SCHEMA))
    assert odd == {r.id for r in kept.where("isnan(price)").collect()}


def test_batched_stream_equals_batch(spark, tmp_path):
    rows = drifting(900, 6)
    source, target = tmp_path / "in", str(tmp_path / "out")
    for k in range(3):
        spark.createDataFrame(rows[k * 300 : (k + 1) * 300], SCHEMA).coalesce(1).write.mode("append").parquet(str(source / f"f{k}"))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(source))
    query = stream.writeStream.foreachBatch(write_changes(target)).option("checkpointLocation", str(tmp_path / "cp")).start()
    query.processAllAvailable()
    query.stop()
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == brute(rows)


def test_stream_of_shuffled_rows_equals_batch(spark, tmp_path):
    """Rows in any order within the lateness: the same rows as the batch form."""
    rows = drifting(900, 8)
    mixed = list(rows)
    rnd = random.Random(1)
    for k in range(0, len(mixed), 150):  # shuffled inside stretches shorter than the lateness
        part = mixed[k : k + 150]
        rnd.shuffle(part)
        mixed[k : k + 150] = part
    span = max((max(p) - min(p)) for p in ([r[5] for r in mixed[k : k + 300]] for k in range(0, len(mixed), 300)))
    end = max(r[5] for r in rows)
    source = tmp_path / "in"
    last = [(10**9, 10**6, 1.0, 1.0, True, end + 10 * span)]
    for k in range(0, len(mixed), 150):
        spark.createDataFrame(mixed[k : k + 150], SCHEMA).coalesce(1).write.mode("append").parquet(str(source / f"f{k:05d}"))
    spark.createDataFrame(last, SCHEMA).coalesce(1).write.mode("append").parquet(str(source / "g"))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(source))
    query = (
        store_on_change_stream(stream, f"{int(span.total_seconds()) + 1} seconds", wait=True).writeStream.format("memory").queryName("shuffled")
        .outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).start()
    )
    query.processAllAvailable()
    query.stop()
    assert sorted(r.id for r in spark.table("shuffled").collect()) == brute(rows)


def test_batched_stream_restarts_on_a_fresh_target(spark, tmp_path):
    rows = drifting(300, 9)
    target, store = str(tmp_path / "out"), write_changes(str(tmp_path / "out"))
    df = spark.createDataFrame(rows, SCHEMA)
    store(df, 7)
    store(df, 7)  # the same batch again
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == brute(rows)


def test_stamps(spark):
    now = clock.instant("2024-01-02 00:00:00")
    old = datetime(2024, 1, 1)
    dim = spark.createDataFrame([(1, old), (2, old), (3, None)], "id int, last_scraped_at timestamp_ntz")
    runs = spark.createDataFrame([(1, 5), (2, 0)], "retailer_id int, saved int")
    got = {r.id: r.last_scraped_at for r in changes.stamp_on_success(dim, runs, now).collect()}
    assert got == {1: datetime(2024, 1, 2), 2: old, 3: None}
    rows = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, in_stock boolean")
    stamped = [tuple(r) for r in changes.stock_stamps(rows, now).orderBy("id").collect()]
    assert [r[3] for r in stamped] == [datetime(2024, 1, 2), None, None] and [r[1] for r in stamped] == [True, False, False]


def test_carry_forward_across_empty_slices(spark):
    df = spark.createDataFrame([("a", 0, 1, 5), ("a", 0, 2, None), ("a", 3, 3, None), ("a", 7, 4, 6), ("a", 7, 5, None), ("b", 0, 1, None)],
                               "k string, s int, o int, v int")
    out = spread.carry_forward(df, ["k"], "s", ["o"], F.col("v"), "prev").orderBy("k", "o").collect()
    assert [r.prev for r in out] == [None, 5, 5, 5, 6, None]
    total = spread.running_sum(df, ["k"], "s", ["o"], F.lit(1), "t").orderBy("k", "o").collect()
    assert [r.t for r in total] == [1, 2, 3, 4, 5, 1]
