"""Sales lines -> one JSON document per invoice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellframe.model import INVOICE_COLUMNS, ORDER_FIELDS


def order_lines(lines: DataFrame, dealt_by: Sequence[str] = ()) -> DataFrame:
    """(Invoice, Orders): the distinct lines of each invoice as sorted structs.

    `collect_set` drops repeats within each map task before the shuffle, so a
    heavily repeated invoice crosses the network once per task and distinct
    line. What is gathered per invoice is exactly what its document holds.

    `dealt_by` names columns that each invoice has one value of. Lines that a join has
    dealt by them are not shuffled again: they are grouped by them, too.
    """
    packed = lines.select("Invoice", *dealt_by, F.struct(*ORDER_FIELDS).alias("Order"))
    return packed.groupBy("Invoice", *dealt_by).agg(
        F.sort_array(F.collect_set("Order")).alias("Orders")
    ).drop(*dealt_by)


def nest_orders(lines: DataFrame, dealt_by: Sequence[str] = ()) -> DataFrame:
    """(Invoice, orders): the order lines of each invoice as JSON text.

    Every value is a quoted string, null fields are left out, and a null
    invoice is a group of its own.
    """
    documents = order_lines(lines, dealt_by).select(
        "Invoice", F.to_json("Orders", {"ignoreNullFields": "true"}).alias("orders")
    )
    return check_invoices(documents)


def check_invoices(documents: DataFrame) -> DataFrame:
    """The typed view of an invoice document: exactly its two columns."""
    if documents.columns != INVOICE_COLUMNS:
        raise ValueError(f"expected {INVOICE_COLUMNS}, got {documents.columns}")
    return documents
