"""Readers: sales lines, prepared parquet, row-key lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellframe.model import SALES_COLUMNS


def read_sales_csv(spark: SparkSession, path: str) -> DataFrame:
    """Sales lines from CSV with a header: all strings, empty field is null.

    Columns are taken by name. Part files whose header disagrees with the
    first one fail the read instead of binding by position.
    """
    lines = (
        spark.read.option("header", True).option("enforceSchema", False).csv(path)
    )
    missing = [c for c in SALES_COLUMNS if c not in lines.columns]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}")
    return lines.select(*[f"`{c}`" for c in SALES_COLUMNS]).withColumnRenamed(
        "Customer ID", "Customer_ID"
    )


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    """Prepared rows (for example the result of an earlier scan)."""
    return spark.read.parquet(path)


def read_keys(spark: SparkSession, path: str) -> DataFrame:
    """Row keys, one per line: untrimmed, duplicates and blank lines kept."""
    return spark.read.text(path).select(F.col("value").alias("row_key"))
