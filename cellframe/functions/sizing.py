"""Measured sizes, for choosing a broadcast, and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Bytes a hash relation needs per row besides the text of its key.
ROW_OVERHEAD = 64

# Codec of written tables, which are full of repetitive texts.
PACKED = "zstd"


def broadcast_limit(spark: SparkSession) -> int:
    """`spark.sql.autoBroadcastJoinThreshold` in bytes; -1 when switched off."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10MB").lower()
    match = re.fullmatch(r"(-?\d+)\s*([kmgt]?)b?", text.strip())
    if match is None:
        raise ValueError(f"cannot read the broadcast threshold: {text!r}")
    return int(match[1]) * 1024 ** " kmgt".index(match[2] or " ")


def fits_broadcast(spark: SparkSession, rows: int, text_bytes: int | None) -> bool:
    """Whether a measured side is small enough to be sent to every executor."""
    return rows * ROW_OVERHEAD + (text_bytes or 0) <= broadcast_limit(spark)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path for a written intermediate table.

    On a cluster this lies in the shared folder of `spark.checkpoint.dir`, so
    that it outlives any executor. Only a local session may fall back to a
    temporary folder of the machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        shared = tempfile.mkdtemp(prefix="cellframe-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _located(spark: SparkSession, path: str):
    """(file system, path) of a folder, wherever it lies."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def remove(spark: SparkSession, path: str) -> None:
    """Delete a written folder."""
    system, at = _located(spark, path)
    system.delete(at, True)


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its file system, the same however it was written."""
    system, at = _located(spark, path)
    return system.makeQualified(at).toString()


def is_folder(spark: SparkSession, path: str) -> bool:
    system, at = _located(spark, path)
    return system.exists(at)


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Move a folder inside its file system, into folders that are made as needed."""
    system, at = _located(spark, path)
    target = _located(spark, to)[1]
    system.mkdirs(target.getParent())
    if not system.rename(at, target):
        raise OSError(f"cannot move {path} to {to}")


@contextmanager
def scratch(spark: SparkSession, df: DataFrame, name: str) -> Iterator[DataFrame]:
    """`df` written once and read from there; deleted at the end, whatever happens."""
    path = scratch_dir(spark, name)
    try:
        df.write.option("compression", PACKED).parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove(spark, path)


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared scratch folder and read it from there.

    For results that are read later; `scratch` is for what one action reads.
    """
    path = scratch_dir(spark, name)
    df.write.option("compression", PACKED).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
