"""The query catalogue: one callable per query, ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellframe import fixtures as X
from cellframe.functions.regions import bounds_from, region_of
from cellframe.functions.sizing import scratch_dir, written
from cellframe.model import INVOICE_COLUMNS, MAX_RATE, ORDER_FIELDS, REGION_BOUNDS
from cellframe.operators import scan
from cellframe.operators.cells import record_to_cells, row_to_cells, stamp
from cellframe.operators.chunks import chunk_cells, nest_chunks, whole_documents
from cellframe.operators.nest import nest_orders
from cellframe.operators.pacing import batch_size, fetch, send_partitions, sending_tasks
from cellframe.sinks.results import save_result
from cellframe.sinks.table import CellTable, bulk_files
from cellframe.sources.files import read_keys, read_rows, read_sales_csv

# Requested columns, versions per cell, sending tasks, regions,
# lines of a chunk, files that a layout is cut into and the most bytes of one, keys asked of
# an outside store in a second.
SCAN_COLUMNS = "user_id, click, error, purchase, signup, view"
SUBSET_COLUMNS = "user_id, click"
VERSION_COLUMNS = "user_id, click, purchase"
VERSIONS = 3
WORKERS = 4
BATCH = batch_size(MAX_RATE, sending_tasks(MAX_RATE, WORKERS))
REGIONS = 11
CHUNK = 2
FILES, FILE_LIMIT = 40, 32 << 20
ASKED = 1_000_000

Query = Callable[[SparkSession, str], DataFrame]

# The client below goes to the workers along with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def q_nest_orders(spark: SparkSession, sf: str) -> DataFrame:
    return nest_orders(X.sales_lines(spark, sf))


def q_nest_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return X.sales_lines(spark, sf).groupBy("Invoice").agg(
        F.count_distinct(F.struct(*ORDER_FIELDS)).alias("n_lines")
    )


def q_nest_null_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Lines per document, and those that have the field; null ones leave it out."""
    def found(field: str):
        return F.regexp_count("orders", F.lit(f'"{field}":')).cast("long")

    return nest_orders(X.sales_lines(spark, sf)).select(
        "Invoice", found("StockCode").alias("n_lines"),
        found("Customer_ID").alias("n_customers"),
    )


def q_nest_chunked(spark: SparkSession, sf: str) -> DataFrame:
    """Documents stored in chunks of two lines and put together again."""
    lines = written(spark, X.sales_lines(spark, sf), "lines")
    table = CellTable.create(
        spark, scratch_dir(spark, "chunked"), bounds_from(lines, "Invoice", REGIONS)
    )
    chunks = chunk_cells(nest_chunks(lines, CHUNK))
    table.append_ranges(stamp(chunks, 1000, 1, table.region()))
    return whole_documents(table.cells())


def q_csv_source(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "sales-csv")
    X.sales_lines(spark, sf).withColumnRenamed("Customer_ID", "Customer ID").write.csv(
        path, header=True
    )
    return read_sales_csv(spark, path)


def q_key_list_source(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "keys")
    X.key_list(spark, sf).write.text(path)
    return read_keys(spark, path)


def q_record_to_cells(spark: SparkSession, sf: str) -> DataFrame:
    return record_to_cells(X.invoices(spark, sf), "Invoice")


def q_put_upsert(spark: SparkSession, sf: str) -> DataFrame:
    documents = written(spark, X.invoices(spark, sf), "invoices")
    table = CellTable.create(
        spark, scratch_dir(spark, "put"), bounds_from(documents, "Invoice", REGIONS)
    )
    table.put(documents, "Invoice", ts=1000, seq=1)
    again = documents.where(F.col("Invoice").startswith("C")).withColumn(
        "orders", F.concat(F.lit("again "), "Invoice")
    )
    table.put(again, "Invoice", ts=2000, seq=2)
    return scan.latest(table.cells(), INVOICE_COLUMNS)


def q_put_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Stored documents, and the records that had no usable key."""
    end = F.right("Invoice", F.lit(1))
    documents = written(spark, X.invoices(spark, sf).withColumn(
        "Invoice", F.when(end == "9", "").when(end != "7", F.col("Invoice"))
    ), "invoices")
    table = CellTable.create(
        spark, scratch_dir(spark, "rejects"), bounds_from(documents, "Invoice", REGIONS)
    )
    rejects = scratch_dir(spark, "rejected")
    table.put(documents, "Invoice", ts=1000, seq=1, rejects_path=rejects)
    stored = scan.latest(table.cells(), INVOICE_COLUMNS)
    return stored.withColumn("rejected", F.lit(False)).union(
        read_rows(spark, rejects).withColumn("rejected", F.lit(True))
    )


def q_scan_latest(spark: SparkSession, sf: str) -> DataFrame:
    return scan.latest(X.cell_log(spark, sf), SCAN_COLUMNS)


def q_scan_latest_subset(spark: SparkSession, sf: str) -> DataFrame:
    return scan.latest(X.cell_log(spark, sf), SUBSET_COLUMNS)


def q_scan_time_range(spark: SparkSession, sf: str) -> DataFrame:
    return scan.time_range(
        X.cell_log(spark, sf), SCAN_COLUMNS, X.RANGE_START, X.RANGE_END
    )


def q_scan_as_of(spark: SparkSession, sf: str) -> DataFrame:
    return scan.as_of(X.cell_log(spark, sf), SCAN_COLUMNS, X.SNAPSHOT_AT)


def q_scan_versions(spark: SparkSession, sf: str) -> DataFrame:
    return scan.versions(X.cell_log(spark, sf), VERSIONS)


def q_scan_versions_range(spark: SparkSession, sf: str) -> DataFrame:
    return scan.versions(
        X.cell_log(spark, sf), VERSIONS, VERSION_COLUMNS, X.RANGE_START, X.RANGE_END
    )


def _stored_log(spark: SparkSession, sf: str) -> CellTable:
    """The cell log as a table, written in three runs, one after the other in time."""
    log = X.cell_log(spark, sf)
    table = CellTable.create(
        spark, scratch_dir(spark, "stored"), bounds_from(log, "row_key", REGIONS)
    )
    for run in (
        f"ts < {X.RANGE_START}",
        f"ts >= {X.RANGE_START} AND ts < {X.RANGE_END}",
        f"ts >= {X.RANGE_END}",
    ):
        table.append_log(log.where(run))
    return table


def q_stored_time_range(spark: SparkSession, sf: str) -> DataFrame:
    log = _stored_log(spark, sf).cells()
    return scan.time_range(log, SCAN_COLUMNS, X.RANGE_START, X.RANGE_END)


def q_stored_as_of(spark: SparkSession, sf: str) -> DataFrame:
    return scan.as_of(_stored_log(spark, sf).cells(), SCAN_COLUMNS, X.SNAPSHOT_AT)


def q_scan_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """An image stays as it was, also after a put that is stamped back in time and the
    adoption of files that are older than it."""
    table = _stored_log(spark, sf)
    late = X.buyers_above(spark, sf, 300).distinct()
    files = scratch_dir(spark, "older-files")
    bulk_files(
        late.withColumn("view", F.lit("older")), files, "row_key", "view", table.bounds,
        ts=X.SNAPSHOT_AT, seq=1,
    )
    commit = table.last_commit()
    table.put(late.withColumn("click", F.lit("late")), "row_key", "click",
              ts=X.SNAPSHOT_AT, seq=commit + 1)
    table.adopt(files)
    return scan.snapshot(table.cells(), SCAN_COLUMNS, commit)


def q_scan_after_adoption(spark: SparkSession, sf: str) -> DataFrame:
    """The same table with all of its commits: what was put and what was adopted."""
    table = _stored_log(spark, sf)
    late = X.buyers_above(spark, sf, 300).distinct()
    files = scratch_dir(spark, "newer-files")
    bulk_files(
        late.withColumn("view", F.lit("adopted")), files, "row_key", "view", table.bounds,
        ts=X.DELETE_AT,
    )
    table.adopt(files)
    return scan.latest(table.cells(), SCAN_COLUMNS)


def q_get_rows(spark: SparkSession, sf: str) -> DataFrame:
    table = _stored_log(spark, sf)
    return scan.get_rows(
        table.cells(), X.key_list(spark, sf), SCAN_COLUMNS, bounds=table.bounds
    )


def q_scan_to_parquet(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "result")
    save_result(q_scan_latest(spark, sf), SCAN_COLUMNS, path)
    return read_rows(spark, path)


def _deleted_table(spark: SparkSession, sf: str) -> CellTable:
    log = X.cell_log(spark, sf)
    table = CellTable.create(
        spark, scratch_dir(spark, "delete"), bounds_from(log, "row_key", REGIONS)
    )
    table.append_log(log)
    table.delete(X.delete_keys(spark, sf), ts=X.DELETE_AT)
    return table


def q_delete_rows(spark: SparkSession, sf: str) -> DataFrame:
    return scan.latest(_deleted_table(spark, sf).cells(), SCAN_COLUMNS)


def q_delete_then_put(spark: SparkSession, sf: str) -> DataFrame:
    table = _deleted_table(spark, sf)
    again = X.buyers_above(spark, sf, 300).distinct()
    table.put(
        again.withColumn("click", F.lit("again")), "row_key", "click",
        ts=X.DELETE_AT + 1,
    )
    return scan.latest(table.cells(), SCAN_COLUMNS)


def _regions(spark: SparkSession, sf: str, overflow: str) -> DataFrame:
    return X.invoices(spark, sf).select(
        "Invoice", region_of("Invoice", REGION_BOUNDS, overflow).alias("region")
    )


def q_region_assign(spark: SparkSession, sf: str) -> DataFrame:
    return _regions(spark, sf, "reference")


def q_region_assign_strict(spark: SparkSession, sf: str) -> DataFrame:
    return _regions(spark, sf, "strict")


def q_bulk_cells(spark: SparkSession, sf: str) -> DataFrame:
    rows = written(spark, X.sparse_invoices(spark, sf), "bulk-input")
    return row_to_cells(rows, "Invoice", INVOICE_COLUMNS).withColumn(
        "region", region_of("row_key", REGION_BOUNDS)
    )


def _bulk_path(spark: SparkSession, sf: str) -> str:
    rows = written(spark, X.sparse_invoices(spark, sf), "bulk-input")
    path = scratch_dir(spark, "bulk-files")
    bulk_files(
        rows, path, "Invoice", INVOICE_COLUMNS, REGION_BOUNDS, ts=1000, seq=1
    )
    return path


def q_bulk_region_layout(spark: SparkSession, sf: str) -> DataFrame:
    in_file = Window.partitionBy("region", "file").orderBy("position")
    place = F.struct("row_key", "family", "qualifier")
    rows = written(spark, X.sparse_invoices(spark, sf), "bulk-input")
    size = rows.agg(F.sum(
        2 * F.octet_length("Invoice") + F.coalesce(F.octet_length("orders"), F.lit(0))
    )).first()[0]
    path = scratch_dir(spark, "bulk-files")
    bulk_files(rows, path, "Invoice", INVOICE_COLUMNS, REGION_BOUNDS, ts=1000, seq=1,
               file_bytes=max(1, min(size // FILES, FILE_LIMIT)))
    stored = read_rows(spark, f"{path}/cells").select(
        "region",
        place.alias("place"),
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.row_index").alias("position"),
    )
    files = (
        stored.withColumn("before", F.lag("place").over(in_file))
        .groupBy("region", "file")
        .agg(
            F.count("*").alias("cells"),
            F.min("place.row_key").alias("low"),
            F.max("place.row_key").alias("high"),
            F.bool_and(
                F.col("before").isNull() | (F.col("before") <= F.col("place"))
            ).alias("in_order"),
        )
    )
    in_region = Window.partitionBy("region").orderBy("low")
    return (
        files.withColumn("before", F.lag("high").over(in_region))
        .groupBy("region")
        .agg(
            F.sum("cells").alias("cells"),
            F.min("low").alias("min_key"),
            F.max("high").alias("max_key"),
            F.bool_and("in_order").alias("in_order"),
            F.bool_or(F.coalesce(F.col("low") <= F.col("before"), F.lit(False))).alias(
                "overlapping"
            ),
        )
    )


def q_bulk_then_scan(spark: SparkSession, sf: str) -> DataFrame:
    table = CellTable.create(spark, scratch_dir(spark, "bulk-table"), REGION_BOUNDS)
    table.adopt(_bulk_path(spark, sf))
    return scan.latest(table.cells(), INVOICE_COLUMNS)


class _Outside:
    """A store outside Spark, as its clients see it: takes all rows, knows all keys
    but those that say that they are missing."""

    def send(self, batch: list) -> None:
        pass

    def get(self, keys: list[str]) -> dict[str, dict[str, str]]:
        return {k: {"name": f"user {k}"} for k in keys if not k.startswith("missing")}

    def close(self) -> None:
        pass


def q_batch_plan(spark: SparkSession, sf: str) -> DataFrame:
    """Records, batches and pauses of each region's task, counted as they are sent."""
    last = len(REGION_BOUNDS) + 2
    by_region = _regions(spark, sf, "strict").repartitionById(last, "region")
    return send_partitions(by_region, _Outside, BATCH).groupBy("task").agg(
        F.sum("records").alias("records"), F.count("*").alias("batches"),
        F.sum(F.col("paused").cast("long")).alias("pauses"),
    ).withColumnRenamed("task", "region")


def q_paced_get(spark: SparkSession, sf: str) -> DataFrame:
    """Every requested key, asked of a store outside Spark in paced batches."""
    return fetch(
        X.key_list(spark, sf), _Outside, "user_id, name", rate=ASKED, max_rate=ASKED,
    )


def queries() -> dict[str, Query]:
    return {
        name.removeprefix("q_"): query
        for name, query in globals().items()
        if name.startswith("q_")
    }
