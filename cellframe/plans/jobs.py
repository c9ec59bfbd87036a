"""The jobs a user runs: create, write, read, snapshot, bulk load, delete."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from cellframe.functions.regions import bounds_from, text_bounds_from
from cellframe.functions.sizing import scratch
from cellframe.model import INVOICE_COLUMNS
from cellframe.operators import scan
from cellframe.operators.cells import split_rejects, usable_key
from cellframe.operators.layout import FILE_BYTES
from cellframe.operators.nest import nest_orders
from cellframe.sinks.results import save_result
from cellframe.sinks.table import CellTable, bulk_files
from cellframe.sources.files import read_keys, read_rows, read_sales_csv


def create_table(
    spark: SparkSession,
    table_path: str,
    sample_path: str | None = None,
    key: str = "Invoice",
    regions: int = 11,
    bounds: str | Sequence[int] | None = None,
    text_keys: bool = False,
) -> None:
    """A new, empty table.

    Its region bounds are cut from the keys of the rows at `sample_path` (as
    numbers, or with `text_keys` as text), or are given ("498580, 507666").
    """
    if (sample_path is None) == (bounds is None):
        raise ValueError("either sample_path or bounds must be given")
    if sample_path is not None:
        cut = text_bounds_from if text_keys else bounds_from
        bounds = cut(read_rows(spark, sample_path), key, regions)
    elif isinstance(bounds, str):
        bounds = [b.strip() if text_keys else int(b) for b in bounds.split(",")]
    CellTable.create(spark, table_path, bounds)


def write_sales(
    spark: SparkSession,
    source_path: str,
    table_path: str,
    ts: int | None = None,
    allow_rejects: bool = False,
    rejects_path: str | None = None,
    file_bytes: int = FILE_BYTES,
) -> int:
    """Sales CSV -> one document per invoice -> table.

    Lines without an invoice are an error, raised before anything is stored, unless
    `allow_rejects` leaves them out or `rejects_path` takes them as parquet. Returns
    their number, which is counted while the lines are nested. The documents are
    written once to the shared scratch folder, for the two passes of the put, and
    deleted after it; only rejected lines that are to be kept are read again.
    """
    table = CellTable.open(spark, table_path)
    lines = read_sales_csv(spark, source_path)
    seen = Observation()
    counted = lines.observe(
        seen, F.count_if(~usable_key(F.col("Invoice"))).alias("rejects")
    )
    stored, _ = split_rejects(counted, "Invoice")
    with scratch(spark, nest_orders(stored), "invoices") as invoices:
        count = seen.get["rejects"]
        if count and not allow_rejects and rejects_path is None:
            raise ValueError(f"{count} lines have a null or empty Invoice")
        if rejects_path is not None:
            split_rejects(lines, "Invoice")[1].write.parquet(rejects_path)
        table.put(invoices, "Invoice", ts=ts, file_bytes=file_bytes)
    return count


def read_table(
    spark: SparkSession,
    table_path: str,
    scan_dir: str,
    range_dir: str,
    get_dir: str,
    keys_path: str,
    start: int,
    end: int,
    columns: str | Sequence[str] = INVOICE_COLUMNS,
    max_versions: int = 1,
    versions_dir: str | None = None,
) -> int:
    """Full scan, time-range scan and multi-get, each saved as parquet.

    With `versions_dir`, also up to `max_versions` versions of every requested
    cell in the range. Returns how many keys of the list are blank; those are not
    asked for.
    """
    table = CellTable.open(spark, table_path)
    log, family = table.cells(), table.family
    keys = read_keys(spark, keys_path)
    # All three plans are checked before the first one writes.
    in_range = scan.time_range(log, columns, start, end, family)
    fetched = scan.get_rows(log, keys, columns, family, bounds=table.bounds)
    if versions_dir is not None:
        found = scan.versions(log, max_versions, columns, start, end, family)
        found.write.mode("overwrite").parquet(versions_dir)
    save_result(scan.latest(log, columns, family), columns, scan_dir)
    save_result(in_range, columns, range_dir)
    save_result(fetched, columns, get_dir)
    return keys.where(~usable_key(F.col("row_key"))).count()


def read_snapshot(
    spark: SparkSession,
    table_path: str,
    save_dir: str,
    at: int | None = None,
    commit: int | None = None,
    columns: str | Sequence[str] = INVOICE_COLUMNS,
) -> None:
    """The table as it stood at the time `at`, or after a commit, saved as parquet."""
    if (at is None) == (commit is None):
        raise ValueError("either at or commit must be given")
    table = CellTable.open(spark, table_path)
    if commit is None:
        rows = scan.as_of(table.cells(), columns, at, table.family)
    else:
        rows = scan.snapshot(table.cells(), columns, commit, table.family)
    save_result(rows, columns, save_dir)


def bulk_load(
    spark: SparkSession,
    input_dir: str,
    files_dir: str,
    table_path: str,
    fields: str | Sequence[str] = INVOICE_COLUMNS,
    key: str = "Invoice",
    ts: int | None = None,
    adopt: bool = True,
    file_bytes: int = FILE_BYTES,
) -> None:
    """Prepared rows -> sorted region files -> (unless told not to) the table.

    `files_dir` must be new. Once adopted, it belongs to the table.
    """
    table = CellTable.open(spark, table_path)
    bulk_files(
        read_rows(spark, input_dir), files_dir, key, fields, table.bounds,
        table.family, ts=ts, file_bytes=file_bytes,
    )
    if adopt:
        table.adopt(files_dir)


def delete_rows(
    spark: SparkSession, table_path: str, keys_path: str, ts: int | None = None
) -> int:
    """Delete the rows named in a key list; returns how many keys are blank."""
    return CellTable.open(spark, table_path).delete(read_keys(spark, keys_path), ts=ts)
