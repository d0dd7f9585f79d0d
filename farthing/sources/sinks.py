"""Writing results: upserts, child replacement, appends, atomic refresh.

There is no transactional table format here. Updates are expressed as joins
that produce the new state, of a whole table or of the partitions that an update
touches; a refresh writes a new version folder and becomes visible by one
small file, whose exclusive creation decides between refreshes at once.
"""

from __future__ import annotations

import functools
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farthing.sources import scratch


def last_per_key(updates: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The last update of each key by ``order``, then by all other columns.

    Aggregated before the shuffle, so a key with very many updates is not one task.
    """
    rest = [c for c in updates.columns if c not in keys]
    if not rest:
        return updates.distinct()
    rank = F.struct(*order, *[c for c in rest if c not in order])
    last = updates.groupBy(*keys).agg(F.max(rank).alias("_last"))
    return last.select(*[F.col(c) if c in keys else F.col(f"_last.{c}").alias(c) for c in updates.columns])


def null_keys(updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Updates that name no row: some key is NULL. ``upsert`` leaves them out."""
    return updates.where(functools.reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys]))


def upsert(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], sparse: Sequence[str] = (), order: Sequence[str] = ()
) -> DataFrame:
    """The target after inserting or updating by business key.

    Columns the update does not have keep their stored value; ``sparse``
    columns keep it where the update is NULL. Of several updates of a key the
    last by ``order`` counts; those with a NULL key are reported by ``null_keys``.
    """
    updates = last_per_key(updates.dropna(subset=list(keys)), keys, order)
    given = [c for c in updates.columns if c not in keys]
    new = updates.select(*keys, F.lit(True).alias("_new"), *[F.col(c).alias(f"_n_{c}") for c in given])
    joined = target.join(new, list(keys), "full")
    out = []
    for name in target.columns:
        if name in keys or name not in given:
            out.append(F.col(name))
        elif name in sparse:
            out.append(F.coalesce(F.col(f"_n_{name}"), F.col(name)).alias(name))
        else:
            out.append(F.when(F.col("_new"), F.col(f"_n_{name}")).otherwise(F.col(name)).alias(name))
    return joined.select(*out)


BUCKET = "bucket"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _by_partition(df: DataFrame, column: str):
    """A writer that replaces only the partitions that ``df`` has rows for."""
    spread = df.hint("rebalance", column)
    return spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column)


def create_buckets(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """A table in ``buckets`` partitions by its business key, for ``upsert_buckets``."""
    df.withColumn(BUCKET, bucket_of(keys, buckets)).hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(path)


def upsert_buckets(
    updates: DataFrame, path: str, keys: Sequence[str], buckets: int, order: Sequence[str], sparse: Sequence[str] = ()
) -> list[int]:
    """``upsert`` into a bucketed table on storage; returns the buckets that were rewritten.

    Only the buckets of the updates' keys are read, joined and replaced; the files of all
    others stay as they are. The numbers of touched buckets, ``buckets`` at most, reach the driver.
    """
    spark = updates.sparkSession
    stored = spark.read.parquet(path)
    typed = updates.dropna(subset=list(keys)).withColumns({k: F.col(k).cast(stored.schema[k].dataType) for k in keys})
    touched = sorted(r[0] for r in typed.select(bucket_of(keys, buckets)).distinct().collect())
    if not touched:
        return []
    old = stored.where(F.col(BUCKET).isin(touched)).drop(BUCKET)
    merged = upsert(old, typed, keys, sparse, order)
    _by_partition(merged.withColumn(BUCKET, bucket_of(keys, buckets)), BUCKET).parquet(path)
    return touched


def replace_children(existing: DataFrame, touched: DataFrame, rows: DataFrame, parent: str) -> DataFrame:
    """Children after replacing those of every touched parent, also with none."""
    keep = existing.join(touched.select(parent).distinct(), parent, "left_anti")
    return keep.select(*existing.columns).unionByName(rows.select(*existing.columns))


def append_observations(df: DataFrame, path: str, ts: str = "recorded_at") -> None:
    """Append to the history, one folder per day.

    Rows are rebalanced by day: adaptive execution merges small days and splits
    a busy one by its measured size.
    """
    day = df.withColumn("day", F.to_date(ts))
    spread = day.hint("rebalance", "day")
    spread.write.mode("append").partitionBy("day").parquet(path)


def append_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


VERSION_SCHEMA = "version bigint, rows bigint, refreshed_at timestamp_ntz, folder string"


def versions(spark: SparkSession, target: str) -> DataFrame:
    """All announced versions of a materialised table."""
    log = f"{target}/versions"
    if not scratch.exists(spark, log):
        return spark.createDataFrame([], VERSION_SCHEMA)
    return spark.read.schema(VERSION_SCHEMA).json(log)


def refresh_materialized(query: DataFrame, target: str, as_of: Column, first: bool = False) -> int:
    """Rebuild a materialised table atomically; returns its row count.

    The new version is complete in a folder of its own before it is announced. Announcing
    creates the file of the next version's number, which only one of several
    refreshes at once can do; the others take the numbers after it, so
    readers see every version, in order. An empty result raises without
    announcing anything. ``first`` says that the table is new, and raises if it is not.
    """
    spark = query.sparkSession
    if first and not versions(spark, target).isEmpty():
        raise ValueError(f"{target} has versions already")
    folder = f"{target}/data/{uuid.uuid4().hex}"
    query.withColumn("refreshed_at", as_of).write.mode("overwrite").parquet(folder)
    written = spark.read.parquet(folder).agg(F.count(F.lit(1)), F.date_format(F.max("refreshed_at"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).first()
    if written[0] == 0:
        raise ValueError(f"refresh of {target} produced no rows")
    version = (versions(spark, target).agg(F.max("version")).first()[0] or 0) + 1
    told = {"rows": written[0], "refreshed_at": written[1], "folder": folder}
    while not scratch.create_exclusively(spark, f"{target}/versions/{version:012d}.json", json.dumps({"version": version, **told}) + "\n"):
        version += 1
    return written[0]


def read_materialized(spark: SparkSession, target: str, version: int | None = None) -> DataFrame:
    """The latest announced version, or the one of a given number."""
    known = versions(spark, target)
    if version is not None:
        known = known.where(F.col("version") == version)
    latest = known.agg(F.max_by("folder", "version")).first()[0]
    if latest is None:
        raise ValueError(f"{target} has no such version")
    return spark.read.parquet(latest)


def delete_from_days(deletes: DataFrame, path: str) -> list[str]:
    """Take rows (id, day) out of a history that is stored by day; returns the days that were rewritten.

    Only the partitions of those days are read and replaced, and a day that loses all its
    rows goes. The names of the touched days, one per calendar day, reach the driver.
    """
    spark = deletes.sparkSession
    days = sorted(str(r[0]) for r in deletes.select("day").distinct().collect())
    if not days:
        return []
    stored = spark.read.parquet(path).where(F.col("day").isin(days))
    left = stored.join(deletes.select("id", F.col("day").cast("date").alias("day")), ["id", "day"], "left_anti").select(*stored.columns)
    full = {str(r[0]) for r in left.select("day").distinct().collect()}
    _by_partition(left, "day").parquet(path)
    for day in sorted(set(days) - full):
        scratch.remove(spark, f"{path}/day={day}")
    return days


def write_delete_set(ids: DataFrame, path: str) -> DataFrame:
    """Persist planned ids; returns the count per tier."""
    ids.write.mode("overwrite").parquet(path)
    saved = ids.sparkSession.read.parquet(path)
    return saved.groupBy("action").agg(F.count(F.lit(1)).alias("rows"))


def execute_delete_set(history: DataFrame, fresh_plan: DataFrame, path: str) -> DataFrame:
    """History without exactly the persisted ids.

    Raises when the fresh plan and the persisted set differ in any id.
    """
    from farthing.operators import retention

    saved = history.sparkSession.read.parquet(path)
    different = retention.plan_difference(retention.delete_ids(fresh_plan), saved)
    if not different.isEmpty():
        raise ValueError(f"the plan no longer matches the delete set at {path}")
    return retention.apply_deletes(history, saved)


def content_hash(value: Column) -> Column:
    return F.sha2(value, 256)
