"""Folders that all executors share, and small files in them, through Spark's own file systems."""

from __future__ import annotations

import os
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a local session without it gets one of its own."""
    named = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY) or spark.sparkContext.getCheckpointDir()
    if not named:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError(f"{CHECKPOINT_KEY} must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="farthing-"))
        named = spark.sparkContext.getCheckpointDir()
    return named.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path that no other run uses."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts the lineage."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.delete(where, True)


def create_exclusively(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file; False if it is there already. Atomic on local disks, and where the file system's ``create`` is."""
    fs, where = _at(spark, path)
    if fs.getScheme() == "file":  # Hadoop's own create looks first and creates then
        local = where.toUri().getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        try:
            with open(local, "x", encoding="utf-8") as out:
                out.write(text)
        except FileExistsError:
            return False
        return True
    try:
        out = fs.create(where, False)
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" in str(e.java_exception.getClass().getName()) or fs.exists(where):
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True
