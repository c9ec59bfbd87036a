"""Documents in chunks against documents in one piece."""

import pytest
from pyspark.sql import functions as F

from cellframe.model import INVOICE_COLUMNS, ORDER_FIELDS, REGION_BOUNDS
from cellframe.operators import chunks, scan
from cellframe.operators.cells import stamp
from cellframe.operators.chunks import chunk_cells, nest_chunks, whole_documents
from cellframe.operators.nest import nest_orders
from cellframe.sinks.table import CellTable
from conftest import rows
from test_plans import plan
from test_regions import files_in_order


@pytest.fixture(scope="module")
def lines(spark):
    """Invoice 500000 has a third of all lines; every line stands there twice."""
    fields = [F.expr(f"cast((id * {i + 3}) % 97 as string)").alias(f) for i, f in enumerate(ORDER_FIELDS)]
    one = spark.range(6000).select(
        F.expr("IF(id % 3 = 0, '500000', cast(490000 + id % 400 as string))").alias("Invoice"),
        *fields[:-1], F.expr("IF(id % 5 = 0, NULL, cast(id as string))").alias(ORDER_FIELDS[-1]),
    )
    return one.union(one).repartition(7)


@pytest.mark.parametrize("size", [1, 7, 100, 100_000])
def test_chunks_put_together_are_the_document(spark, tmp_path, lines, size):
    chunks = nest_chunks(lines, size)
    assert chunks.where(F.size(F.from_json("orders", "array<string>")) > size).count() == 0
    table = CellTable.create(spark, str(tmp_path / "t"), REGION_BOUNDS)
    table.append_log(stamp(chunk_cells(chunks), 5, 1, table.region()))
    assert rows(whole_documents(table.cells())) == rows(nest_orders(lines))
    assert scan.latest(table.cells(), "Invoice").count() == lines.select("Invoice").distinct().count()


def test_a_hot_invoice_is_gathered_by_several_tasks(spark, lines):
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")  # these few rows would be merged into one task
    try:
        chunks = nest_chunks(lines, 100).withColumn("task", F.spark_partition_id())
        hot = chunks.where("Invoice = '500000'").groupBy("task").count().collect()
    finally:
        spark.conf.unset(setting)
    held = lines.where("Invoice = '500000'").distinct().count()
    assert sum(r["count"] for r in hot) == -(-held // 100) > 10 and len(hot) > 1


def test_a_shorter_document_leaves_nothing_behind(spark, tmp_path, lines, keys_of):
    table = CellTable.create(spark, str(tmp_path / "t"), REGION_BOUNDS)
    table.append_log(stamp(chunk_cells(nest_chunks(lines, 50)), 5, 1, table.region()))
    few = lines.where("StockCode < '3'")
    table.append_log(stamp(chunk_cells(nest_chunks(few, 50)), 6, 2, table.region()))
    expected = {r[0]: r[1] for r in nest_orders(lines).collect()}
    expected.update({r[0]: r[1] for r in nest_orders(few).collect()})
    assert dict(rows(whole_documents(table.cells()))) == expected
    table.delete(keys_of("500000"), ts=6)
    assert "500000" not in dict(rows(whole_documents(table.cells())))
    assert whole_documents(table.cells()).columns == INVOICE_COLUMNS


def test_no_lines(lines):
    assert nest_chunks(lines.limit(0), 5).count() == 0


def test_lines_cross_one_exchange(monkeypatch, lines):
    monkeypatch.setattr(chunks, "TASK_BYTES", 10_000)
    short = lines.where("Invoice <> '500000'").localCheckpoint()
    text = plan(nest_chunks(short, 2))
    assert text.count("Exchange ") == text.count("Exchange rangepartitioning") == 1


def test_texts_cross_one_exchange_when_read(spark, tmp_path, lines):
    table = CellTable.create(spark, str(tmp_path / "t"), REGION_BOUNDS)
    table.append_ranges(stamp(chunk_cells(nest_chunks(lines, 7)), 5, 1, table.region()))
    # The other one is of tombstones.
    assert plan(whole_documents(table.cells())).count("Exchange hashpartitioning") == 2


@pytest.mark.parametrize("size", [7, 5000])
def test_ranges_are_written_where_they_are(spark, tmp_path, lines, size):
    """As a measured append stores them, in files that are sorted and don't overlap."""
    stored = []
    for name in ("append_log", "append_ranges"):
        table = CellTable.create(spark, str(tmp_path / name), REGION_BOUNDS)
        cells = stamp(chunk_cells(nest_chunks(lines, size)), 5, 1, table.region())
        getattr(table, name)(cells)
        stored.append(rows(table.cells()))
        assert table.commits().first()["cells"] == len(stored[-1])
    assert stored[0] == stored[1]
    assert all(f["in_order"] for f in files_in_order(spark, f"{table.path}/cells"))
    spans = table.cells().groupBy("region", F.col("_metadata.file_path")).agg(
        F.min("row_key").alias("low"), F.max("row_key").alias("high")
    ).collect()
    for region in {f["region"] for f in spans}:
        places = sorted((f["low"], f["high"]) for f in spans if f["region"] == region)
        assert all(a[1] <= b[0] for a, b in zip(places, places[1:]))


def test_a_null_invoice_is_one_of_its_own_but_no_row(spark, tmp_path, lines):
    """Short or long: a part of the nested lines, refused by the table."""
    table = CellTable.create(spark, str(tmp_path / "t"), REGION_BOUNDS)
    for n in (5, 1500):
        null = lines.limit(0).unionByName(spark.range(n).select(
            F.lit(None).cast("string").alias("Invoice"),
            *[F.col("id").cast("string").alias(f) for f in ORDER_FIELDS],
        ))
        chunks = nest_chunks(null.union(lines.where("Invoice = '490001'")).union(null), 4)
        assert chunks.where("Invoice IS NULL").count() == -(-n // 4)
        assert chunks.where("Invoice IS NOT NULL").count() > 0
        with pytest.raises(Exception, match="null or empty row key"):
            table.append_ranges(stamp(chunk_cells(chunks), 5, 1, table.region()))
        assert table.cells().count() == 0 and table.last_commit() == 0


def test_a_tombstone_is_no_range_of_puts(spark, tmp_path, log_of):
    table = CellTable.create(spark, str(tmp_path / "t"), REGION_BOUNDS)
    with pytest.raises(Exception, match="no puts"):
        table.append_ranges(log_of(("500000", "orders", "[]", 5), ("500001", None, None, 6)))
    assert table.cells().count() == 0
    table.append_ranges(log_of(("500000", "orders", "[]", 5)))
    assert [r["region"] for r in table.cells().collect()] == [1]
