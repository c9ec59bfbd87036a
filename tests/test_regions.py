"""Key -> region and the layout of written files."""

import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cellframe.functions.regions import (
    bounds_from, region_count, region_of, text_bounds_from,
)
from cellframe.model import REGION_BOUNDS
from cellframe.operators.layout import by_region, region_sizes
from cellframe.sinks.table import CellTable, bulk_files
from conftest import SMALL, rows

EDGES = ["498579", "498580", "581586", "581587", "999999", "99", "-5", "C489449", "",
         "99999999999", None, "007", "9" * 25]


def regions(keys_of, **options):
    df = keys_of(*EDGES).select(
        "row_key", region_of("row_key", **options).alias("region")
    )
    return {r["row_key"]: r["region"] for r in df.collect()}


def test_reference_overflow(keys_of):
    found = regions(keys_of, overflow="reference")
    assert found == {
        "498579": 0, "498580": 1, "581586": 9, "581587": 0, "999999": 0, "99": 0,
        "-5": 10, "C489449": 10, "": None, "99999999999": None, None: None, "007": 0,
        "9" * 25: None,
    }


def test_strict_overflow_places_every_usable_key(keys_of):
    found = regions(keys_of, overflow="strict")
    assert found == {
        "498579": 0, "498580": 1, "581586": 9, "581587": 10, "999999": 10, "99": 0,
        "-5": 11, "C489449": 11, "": None, "99999999999": 10, None: None, "007": 0,
        "9" * 25: 10,
    }


@pytest.mark.parametrize("bounds", [[5], [5, 9], list(range(10, 1000, 7))])
def test_any_number_of_bounds(spark, bounds):
    keys = spark.range(0, 1010).select(F.col("id").cast("string").alias("k"))
    for key, region in keys.select("k", region_of("k", bounds)).collect():
        assert region == sum(int(key) >= b for b in bounds)
    assert region_count(bounds) == len(bounds) + 2
    assert region_count(bounds, "reference") == len(bounds) + 1


def test_thousands_of_regions(spark):
    bounds = list(range(1000, 61_000, 20))
    keys = spark.range(0, 70_000, 7).select(F.col("id").cast("string").alias("k"))
    placed = keys.select("k", region_of("k", bounds).alias("r"))
    wrong = placed.where(
        "r <> CASE WHEN k < 1000 THEN 0 ELSE least((CAST(k AS INT) - 1000) div 20 + 1, 3000) END"
    )
    assert len(bounds) == 3000 and wrong.count() == 0


def test_text_bounds_follow_text_order(keys_of):
    found = regions(keys_of, bounds=["5", "C"])
    assert found["99"] == 1 and found["498579"] == 0 and found["C489449"] == 2
    assert found["-5"] == 0 and found[""] is None
    assert region_count(["5", "C"]) == 3


def test_bad_arguments():
    for bounds in ([], [2, 1], [1, 1]):
        with pytest.raises(ValueError):
            region_of("k", bounds)
    with pytest.raises(ValueError):
        region_of("k", overflow="other")


def test_bounds_from_data_cut_evenly(spark):
    keys = spark.range(100_000).select((F.col("id") * 3).cast("string").alias("k"))
    bounds = bounds_from(keys, "k", 8)
    assert len(bounds) == 7
    sizes = region_sizes(keys.select(region_of("k", bounds).alias("region")))
    counts = [s.rows for s in sizes.values()]
    assert max(counts) < 1.1 * min(counts)
    with pytest.raises(ValueError):
        bounds_from(spark.createDataFrame([("x",)], "k string"), "k", 4)


def records(spark, n):
    """Every third key is in one region; one key has a third of all rows."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "500000")
        .when(F.col("id") % 3 == 1, (F.col("id") + 489434).cast("string"))
        .otherwise(F.concat(F.lit("C"), "id")).alias("Invoice"),
        F.concat(F.lit("doc "), "id").alias("orders"),
    )


def files_in_order(spark, path):
    place = F.struct("row_key", "family", "qualifier")
    in_file = Window.partitionBy("file").orderBy("position")
    return (
        spark.read.parquet(path)
        .select("region", place.alias("place"),
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.row_index").alias("position"))
        .withColumn("before", F.lag("place").over(in_file))
        .groupBy("region", "file")
        .agg(F.count("*").alias("cells"),
             F.bool_and(F.col("before").isNull() | (F.col("before") <= F.col("place")))
             .alias("in_order"))
        .collect()
    )


def test_one_sorted_file_per_region(spark, tmp_path):
    path = str(tmp_path / "files")
    bulk_files(records(spark, 3000).repartition(5), path, "Invoice", None, REGION_BOUNDS, ts=1)
    files = files_in_order(spark, f"{path}/cells")
    assert all(f["in_order"] for f in files)
    assert len({f["region"] for f in files}) == len(files)
    assert sum(f["cells"] for f in files) == 6000


def test_big_region_is_split_into_sorted_files(spark, tmp_path):
    path = str(tmp_path / "files")
    bulk_files(records(spark, 6000).repartition(8), path, "Invoice", None, REGION_BOUNDS,
               ts=1, file_bytes=8000)
    files = files_in_order(spark, f"{path}/cells")
    assert all(f["in_order"] for f in files)
    assert sum(f["cells"] for f in files) == 12000
    # The hot key alone has 4000 cells; no file holds nearly that many.
    assert max(f["cells"] for f in files) < 1500


def test_files_of_a_big_region_are_key_ranges(spark, tmp_path):
    path = str(tmp_path / "files")
    docs = spark.range(5000).selectExpr("CAST(500000 + id AS STRING) AS k", "repeat('x', 50) AS v")
    bulk_files(docs.repartition(6), path, "k", None, [100, 900000], ts=1, file_bytes=40_000)
    ranges = sorted(
        (r["low"], r["high"]) for r in spark.read.parquet(f"{path}/cells")
        .groupBy(F.col("_metadata.file_path")).agg(
            F.min("row_key").alias("low"), F.max("row_key").alias("high")).collect()
    )
    assert len(ranges) > 5
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_one_row_in_a_table_of_thousands_of_regions(spark, tmp_path):
    import time

    table = CellTable.create(spark, str(tmp_path / "t"), list(range(1000, 61_000, 20)))
    row = spark.createDataFrame([("60970", "x")], "k string, v string")
    start = time.time()
    table.put(row, "k", ts=1)
    assert time.time() - start < 6
    assert table.cells().select("region").distinct().collect()[0][0] == 2999
    from cellframe.sinks.table import prepare_cells

    cells, _ = prepare_cells(row, "k", table.bounds)
    assert cells.rdd.getNumPartitions() == 1


def test_text_bounds_from_data(spark):
    keys = spark.range(5000).select(F.concat(F.lit("k"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("k"))
    bounds = text_bounds_from(keys, "k", 100)
    assert len(bounds) == 99 and bounds == sorted(bounds)
    counts = keys.groupBy(region_of("k", bounds).alias("r")).count().collect()
    assert len(counts) == 100 and max(r["count"] for r in counts) < 3 * 50
    for key, region in keys.limit(200).select("k", region_of("k", bounds)).collect():
        assert region == sum(key >= b for b in bounds)

@pytest.mark.parametrize("absent", [[], [0, 3]])
def test_a_task_for_each_region_that_is_there(spark, absent):
    cells = records(spark, 900).select(
        F.col("Invoice").alias("row_key"), F.lit("q").alias("qualifier"),
        region_of("Invoice").alias("region"),
    ).where(~F.col("region").isin(absent))
    placed = by_region(cells, region_sizes(cells))
    found = placed.select("region", F.spark_partition_id().alias("task")).distinct().collect()
    present = sorted(r["region"] for r in found)
    assert len(found) == len(set(present)) == placed.rdd.getNumPartitions()
    assert all(present[r["task"]] == r["region"] for r in found)


def test_bad_keys_are_reported_and_can_be_left_out(spark, tmp_path):
    bad = spark.createDataFrame(
        [("1", "a"), ("", "b"), (None, "c")], "Invoice string, orders string"
    )
    table = CellTable.create(spark, str(tmp_path / "t"), REGION_BOUNDS)
    with pytest.raises(ValueError, match="2 rows"):
        table.put(bad, "Invoice", ts=1)
    assert table.cells().count() == 0
    table.put(bad, "Invoice", ts=1, allow_rejects=True)
    assert rows(table.cells().select("row_key").distinct()) == [("1",)]


def test_files_lie_in_kind_and_region_folders(spark, tmp_path, keys_of):
    table = CellTable.create(spark, str(tmp_path / "t"), REGION_BOUNDS)
    table.put(records(spark, 30), "Invoice", ts=1)
    table.delete(keys_of("500000"), ts=2)
    folders = set(os.listdir(tmp_path / "t" / "cells"))
    assert {"kind=P", "kind=D"} <= folders
    assert any(d.startswith("region=") for d in os.listdir(tmp_path / "t/cells/kind=D"))


def test_a_layout_file_has_a_limit_whatever_the_input(spark, monkeypatch):
    """A task sorts one file, so a file must not grow with the table."""
    from cellframe.plans import queries

    asked = []

    def recorded(*args, **options):
        asked.append(options["file_bytes"])
        return bulk_files(*args, **options)

    monkeypatch.setattr(queries, "bulk_files", recorded)
    whole = rows(queries.q_bulk_region_layout(spark, SMALL))
    monkeypatch.setattr(queries, "FILE_LIMIT", asked[0] // 4, raising=False)
    assert rows(queries.q_bulk_region_layout(spark, SMALL)) == whole
    assert asked[1] == asked[0] // 4
