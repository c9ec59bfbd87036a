"""Schemas and fixed values shared by the whole package."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

# Input columns of a sales line and the fields nested per line.
SALES_COLUMNS = [
    "Invoice", "StockCode", "Description", "Quantity",
    "InvoiceDate", "Price", "Customer ID", "Country",
]
ORDER_FIELDS = [
    "StockCode", "Description", "Quantity", "InvoiceDate",
    "Price", "Customer_ID", "Country",
]
INVOICE_COLUMNS = ["Invoice", "orders"]

# Column family, region split points, request ceiling, pause.
FAMILY = "order"
REGION_BOUNDS = [
    498580, 507666, 516719, 525728, 534908,
    544913, 553856, 563095, 572483, 581587,
]
MAX_RATE = 2000
PAUSE_SECONDS = 0.5

PUT = "P"
TOMBSTONE = "D"

# The cell log. `ts` is epoch milliseconds, `seq` orders commits within one
# millisecond; qualifier and value are null for a row tombstone.
CELL_SCHEMA = T.StructType([
    T.StructField("row_key", T.StringType()),
    T.StructField("family", T.StringType()),
    T.StructField("qualifier", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("ts", T.LongType()),
    T.StructField("seq", T.LongType()),
    T.StructField("kind", T.StringType()),
    T.StructField("region", T.IntegerType()),
])

# `kind` comes first so that reading tombstones touches only their files.
PARTITION_COLUMNS = ["kind", "region"]


def column_list(columns: str | Sequence[str]) -> list[str]:
    """Accept ``"Invoice, orders"``, whose names are trimmed, or a list of names
    that are taken as they are."""
    if isinstance(columns, str):
        names = [name.strip() for name in columns.split(",")]
    else:
        names = list(columns)
    if not names or any(not name for name in names):
        raise ValueError(f"column list has an empty name: {columns!r}")
    return names
