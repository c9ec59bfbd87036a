"""What the plans must look like, whatever the data."""

import contextlib
import io
import re

import pytest

from cellframe.model import REGION_BOUNDS
from cellframe.operators import scan
from cellframe.operators.cells import row_to_cells
from cellframe.operators.nest import nest_orders
from cellframe.plans.queries import queries
from cellframe.sinks.table import CellTable
from conftest import SMALL


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "table")
    table = CellTable.create(spark, path, REGION_BOUNDS)
    rows = spark.createDataFrame([("1", "x"), ("2", "y")], "id string, a string")
    table.put(rows, "id", ts=5)
    table.delete(spark.createDataFrame([("2",)], "row_key string"), ts=6)
    return table


def test_scan_is_one_exchange_with_map_side_combine(log):
    text = plan(scan.latest(log.cells(), "id, a"))
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_max" in text
    assert "Window" not in text and "Join" not in text


def test_time_filters_reach_parquet(log):
    text = plan(scan.as_of(log.cells(), "id, a", 9))
    pushed = re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", text)
    assert len(pushed) == 1 and "LessThanOrEqual(ts,9)" in pushed[0]
    assert text.count("Exchange hashpartitioning") == 1


def test_both_ends_of_a_range_reach_the_puts(log):
    text = plan(scan.time_range(log.cells(), "id, a", 3, 9))
    puts, stones = re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", text)
    assert "GreaterThanOrEqual(ts,3)" in puts and "LessThan(ts,9)" in puts
    assert "GreaterThanOrEqual(ts,3)" in stones and "LessThan(" not in stones
    assert text.count("Exchange hashpartitioning") == 1


def test_tombstones_read_only_their_folder(log):
    text = plan(scan.versions(log.cells(), 1))
    assert re.search(r"PartitionFilters: \[isnotnull\(kind#\d+\), \(kind#\d+ = D\)", text)
    assert re.search(r"PartitionFilters: \[isnotnull\(kind#\d+\), \(kind#\d+ = P\)", text)


def test_versions_are_trimmed_before_the_shuffle(log):
    text = plan(scan.versions(log.cells(), 3))
    assert re.search(r"WindowGroupLimit .*row_number\(\), 3, Partial", text)


def test_get_prunes_regions_and_key_range(spark, log):
    keys = spark.createDataFrame([("1",)], "row_key string")
    text = plan(scan.get_rows(log.cells(), keys, "id, a", bounds=log.bounds))
    assert re.search(r"PartitionFilters: \[[^\]]*region#\d+ = 0", text) or re.search(
        r"PartitionFilters: \[[^\]]*region#\d+ IN \(0\)", text
    )
    # One key is looked up; a list too long to be looked up is a range.
    assert "EqualTo(row_key,1)" in text
    many = spark.range(1000).selectExpr("cast(id as string) AS row_key")
    text = plan(scan.get_rows(log.cells(), many, "id, a", bounds=log.bounds))
    assert "GreaterThanOrEqual(row_key,0)" in text and "LessThanOrEqual(row_key,999)" in text


def test_a_large_key_list_still_filters_the_cells(spark, log):
    keys = spark.createDataFrame([("1",), ("2",)], "row_key string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        text = plan(scan.get_rows(log.cells(), keys, "id, a", bounds=log.bounds))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "LeftSemi" in text and text.index("partial_max") < text.index("LeftSemi")


@pytest.mark.parametrize("threshold, trimmed", [(1000, True), (2, False)])
def test_the_trim_setting_is_read(spark, log, threshold, trimmed):
    setting = scan.TRIM_SETTING
    before = spark.conf.get(setting)
    try:
        spark.conf.set(setting, str(threshold))
        text = plan(scan.versions(log.cells(), 3))
    finally:
        spark.conf.set(setting, before)
    assert ("WindowGroupLimit" in text) == trimmed
    assert ("part#" in text or "part " in text) or trimmed


def test_a_stored_log_prunes_folders_and_runs(spark):
    from cellframe.plans.queries import q_stored_time_range

    text = plan(q_stored_time_range(spark, SMALL))
    puts, stones = re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", text)
    assert "LessThan(ts," in puts and "GreaterThanOrEqual(ts," in stones
    assert re.search(r"PartitionFilters: \[isnotnull\(kind#\d+\), \(kind#\d+ = P\)", text)


def test_nesting_is_one_exchange_over_only_the_needed_columns(spark):
    lines = spark.read.parquet(f"{SMALL}/orders.parquet").selectExpr(
        "cast(o_orderkey as string) Invoice", *[
            f"cast(o_custkey as string) {c}" for c in (
                "StockCode", "Description", "Quantity", "InvoiceDate", "Price",
                "Customer_ID", "Country")
        ], "o_orderpriority extra",
    )
    text = plan(nest_orders(lines))
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_collect_set" in text
    assert "o_orderpriority" not in text


def test_explosion_to_cells_is_narrow(spark):
    rows = spark.createDataFrame([("1", "x")], "id string, a string")
    assert "Exchange" not in plan(row_to_cells(rows, "id", "id, a"))


def test_no_python_but_in_traffic_with_a_store(spark):
    for name in ("nest_orders", "scan_latest", "scan_versions", "get_rows", "region_assign"):
        text = plan(queries()[name](spark, SMALL))
        assert "Python" not in text and "InPandas" not in text
        assert "CartesianProduct" not in text and "NestedLoop" not in text
