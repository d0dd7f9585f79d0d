"""Reading snapshots, windows, rule files and telemetry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_tables(spark: SparkSession, folder: str, names: Sequence[str]) -> dict[str, DataFrame]:
    """Parquet tables of one folder, by name."""
    return {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in names}


def incremental_read(df: DataFrame, since: Column, columns: Sequence[str], ts: str = "recorded_at") -> DataFrame:
    """Rows since a literal time, projected; both reach the Parquet scan."""
    return df.where(F.col(ts) >= since).select(*columns)


def keyset_slice(df: DataFrame, after_id: int, limit: int, id_col: str = "id") -> DataFrame:
    """The next ``limit`` rows after an id, in id order (a top-k)."""
    return df.where(F.col(id_col) > after_id).orderBy(id_col).limit(limit)


def read_bounds(spark: SparkSession, path: str) -> DataFrame:
    """(category, lo, hi) from a JSON registry or a CSV of bounds.

    The registry holds one object per category with ``slug`` and a ``bounds``
    object; a CSV has the three columns and a header.
    """
    if path.endswith(".csv"):
        return spark.read.schema("category string, lo double, hi double").csv(path, header=True)
    schema = "calibers array<struct<slug:string,bounds:struct<lo:double,hi:double>>>"
    flat = spark.read.schema(schema).json(path, multiLine=True).select(F.explode("calibers").alias("c"))
    return flat.select(F.col("c.slug").alias("category"), "c.bounds.lo", "c.bounds.hi")


TELEMETRY = (
    "timestamp string, retailer string, caliber string, url string, verdict string, status int, redirect boolean, "
    "title_match boolean, gate_pass_pct double, n_products bigint, note string, _corrupt_record string"
)


def read_telemetry(spark: SparkSession, path: str, schema: str = TELEMETRY) -> tuple[DataFrame, DataFrame]:
    """Records of many JSON-lines files, and the files with unreadable lines."""
    lines = spark.read.text(path).where(F.trim("value") != "").withColumn("file", F.input_file_name())
    record = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    tagged = lines.select("file", record.alias("r"))
    bad = F.col("r._corrupt_record").isNotNull()
    unreadable = tagged.where(bad).groupBy("file").agg(F.count(F.lit(1)).alias("bad_lines"))
    return tagged.where(~bad).select("r.*", "file").drop("_corrupt_record"), unreadable


def processed_and_excluded(processed: DataFrame, excluded: DataFrame) -> DataFrame:
    """One table of both, missing columns as NULL."""
    return processed.unionByName(excluded, allowMissingColumns=True)
