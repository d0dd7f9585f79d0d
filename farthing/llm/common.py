"""Shared storage, Arrow batches and small Spark helpers of the subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

Work = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

CHECKPOINT_KEY = "spark.checkpoint.dir"

#: Bytes of text that one numpy step holds at once, however long a batch is.
STEP_BYTES = 1 << 21


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, as ``spark.checkpoint.dir`` names it.

    Only a local session without the setting, as in tests, gets a folder of its own.
    """
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_KEY, None) or context.getConf().get(CHECKPOINT_KEY)
    if not named:
        named = context.getCheckpointDir()
    if not named:
        if context.master.split("[")[0] != "local":
            raise ValueError(f"{CHECKPOINT_KEY} must name a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="farthing-llm-"))
        named = context.getCheckpointDir()
    return named.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage.

    Committed files outlive executors, and statistics of the written table let
    Spark decide by size whether a join may broadcast it.
    """
    spark, path = df.sparkSession, new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: What a worker keeps between tasks, by name.
_KEPT: dict[str, Any] = {}


def kept(name: str, make: Callable[[], Any]) -> Any:
    """An object that later tasks of this worker use again."""
    if name not in _KEPT:
        _KEPT[name] = make()
    return _KEPT[name]


def _forget(but: str) -> None:
    """Drop what other operators have kept in this worker."""
    for name in [n for n in _KEPT if n != but]:
        del _KEPT[name]
    _give_back()


def _give_back() -> None:
    """Freed memory goes back to the system, as workers live through many operators."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def in_batches(df: DataFrame, work: Work, schema: str | StructType, keeps: str = "") -> DataFrame:
    """``mapInArrow``; the work sees whole batches, never all rows.

    A task first drops what other operators have kept in its worker, but for ``keeps``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _forget(keeps)
        try:
            yield from work(batches)
        finally:
            _give_back()

    return df.mapInArrow(run, schema)


def utf8(column: str = "text") -> Column:
    """The text as UTF-8 bytes; null stays null."""
    return F.encode(F.col(column), "UTF-8").alias(column)


def pieces(batch: pa.RecordBatch, column: str, limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch whose ``column`` holds about ``limit`` bytes each.

    A row longer than the limit is a range of its own; no row is cut.
    """
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = held = 0
    for i, n in enumerate(sizes):
        if i > start and held + n > limit:
            yield start, i
            start, held = i, 0
        held += n
    if len(sizes) > start:
        yield start, len(sizes)


def gathered(df: DataFrame) -> list[np.ndarray]:
    """The columns of a result of bounded size, as arrays; no row objects are made on the driver."""
    rows = df.toArrow()
    return [c.to_numpy() for c in rows.columns]


def fan_out(df: DataFrame, rows: int) -> DataFrame:
    """Deal the few rows of a manifest over that many tasks, one each or so."""
    return df.repartition(max(1, rows))
