"""The inputs of the catalogue queries, derived from the given tables.

FIXTURES.md describes them. Every fixture reads its tables whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellframe.model import CELL_SCHEMA, FAMILY, PUT, TOMBSTONE
from cellframe.operators.nest import nest_orders

# Points in the time span of the events, epoch milliseconds.
RANGE_START = SNAPSHOT_AT = 1705367014557
RANGE_END = 1706578134080
# After the last event: 2024-02-01, UTC.
DELETE_AT = 1706745600000

# The columns read of each given table. A given schema saves the
# job that would read file footers for it.
TABLES = {
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, "
              "o_orderdate TIMESTAMP_NTZ",
    "customer": "c_custkey BIGINT, c_nationkey INT",
    "part": "p_partkey BIGINT, p_name STRING",
    "nation": "n_nationkey INT, n_name STRING",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, "
              "event_type STRING, value DOUBLE",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def sales_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoice lines; the first line of every order occurs twice."""
    return _order_lines(spark, sf_dir).drop("o_orderkey")


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines with the key of their order, by which the last join deals them."""
    lineitem = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    part = table(spark, sf_dir, "part")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")

    # Customers meet the orders, not the far more numerous lines, and what
    # belongs to an order is spelled out once per order.
    buyers = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    prefix = F.when(F.col("o_orderstatus") == "P", "C").otherwise("")
    customer_id = F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey"))
    headers = orders.join(buyers, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey",
        F.concat(prefix, (F.col("o_orderkey") * 7 + 489434).cast("string")).alias(
            "Invoice"
        ),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("InvoiceDate"),
        customer_id.cast("string").alias("Customer_ID"),
        F.col("n_name").alias("Country"),
    )
    joined = lineitem.join(part, F.col("l_partkey") == F.col("p_partkey")).join(
        headers, F.col("l_orderkey") == F.col("o_orderkey")
    )
    times = F.when(F.col("l_linenumber") == 1, F.array(F.lit(1), F.lit(2)))
    return joined.select(
        "o_orderkey",
        "Invoice",
        F.col("l_partkey").cast("string").alias("StockCode"),
        F.col("p_name").alias("Description"),
        F.col("l_quantity").cast("int").cast("string").alias("Quantity"),
        "InvoiceDate",
        F.col("l_extendedprice").cast("decimal(12,2)").cast("string").alias("Price"),
        "Customer_ID",
        "Country",
        F.explode(F.coalesce(times, F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per invoice; an invoice has the number of one order in it."""
    return nest_orders(_order_lines(spark, sf_dir), ["o_orderkey"])


def sparse_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoices of which some lack a document."""
    return invoices(spark, sf_dir).withColumn(
        "orders", F.when(~F.col("Invoice").endswith("3"), F.col("orders"))
    )


def cell_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a log row; costly errors are row tombstones."""
    gone = (F.col("event_type") == "error") & (F.col("value") > 100)
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("row_key"),
        F.lit(FAMILY).alias("family"),
        F.when(~gone, F.col("event_type")).alias("qualifier"),
        F.when(~gone, F.col("value").cast("decimal(12,2)").cast("string")).alias(
            "value"
        ),
        # As UTC, whatever the session's time zone.
        F.expr(
            "unix_millis(CAST(convert_timezone('UTC', current_timezone(), ts) AS TIMESTAMP))"
        ).alias("ts"),
        F.col("event_id").alias("seq"),
        F.when(gone, TOMBSTONE).otherwise(PUT).alias("kind"),
        F.least((F.col("user_id") / 14).cast("int"), F.lit(10)).alias("region"),
    ).to(CELL_SCHEMA)


def key_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The buyer of every purchase, repeats kept, and keys never stored."""
    events = table(spark, sf_dir, "events")
    buyer = F.when(F.col("event_type") == "purchase", F.col("user_id").cast("string"))
    unknown = F.when(
        (F.col("event_type") == "signup") & (F.col("value") > 100),
        F.concat(F.lit("missing-"), F.col("event_id").cast("string")),
    )
    return events.select(F.coalesce(buyer, unknown).alias("row_key")).where(
        "row_key IS NOT NULL"
    )


def buyers_above(spark: SparkSession, sf_dir: str, value: int) -> DataFrame:
    """Users with a purchase above `value`, one key per such purchase."""
    return (
        table(spark, sf_dir, "events")
        .where((F.col("event_type") == "purchase") & (F.col("value") > value))
        .select(F.col("user_id").cast("string").alias("row_key"))
    )


def delete_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return buyers_above(spark, sf_dir, 200)
