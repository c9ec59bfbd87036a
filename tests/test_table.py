"""The stored table: upsert, delete, bulk load, and the whole job chain."""

import pytest

from cellframe import __main__ as cli
from cellframe.model import REGION_BOUNDS
from cellframe.operators import scan
from cellframe.plans import jobs
from cellframe.sinks.table import CellTable, bulk_files
from conftest import rows
from test_cells_and_sources import csv

DOCS = [("498579", "a"), ("498580", "b"), ("C1", "c"), ("700000", None)]
COLS = "Invoice, orders"


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(DOCS, "Invoice string, orders string")


@pytest.fixture
def table(spark, tmp_path):
    return CellTable.create(spark, str(tmp_path / "table"), REGION_BOUNDS)


def blanked(records):
    return sorted((k, v or "") for k, v in records)


def test_new_table_is_empty_and_never_replaced(spark, table):
    assert rows(scan.latest(table.cells(), COLS)) == []
    with pytest.raises(Exception, match="(?i)exist"):
        CellTable.create(spark, table.path, REGION_BOUNDS)
    assert CellTable.open(spark, table.path) == table


def test_put_twice_is_put_once_on_scan(table, docs):
    table.put(docs, "Invoice", ts=5, seq=1)
    table.put(docs, "Invoice", ts=5, seq=2)
    assert rows(scan.latest(table.cells(), COLS)) == blanked(DOCS)
    assert scan.versions(table.cells(), 9).count() == 7


def test_upsert_delete_revive(spark, table, docs, keys_of):
    table.put(docs, "Invoice", ts=5)
    table.put(spark.createDataFrame([("C1", "new")], docs.schema), "Invoice", ts=6)
    assert table.delete(keys_of("C1", "C1", "unknown", "", None), ts=7) == 2
    assert rows(scan.latest(table.cells(), COLS)) == blanked(
        r for r in DOCS if r[0] != "C1"
    )
    assert rows(scan.as_of(table.cells(), "Invoice, orders", 6)) == blanked(
        [r for r in DOCS if r[0] != "C1"] + [("C1", "new")]
    )
    table.put(spark.createDataFrame([("C1", "back")], docs.schema), "Invoice", "orders", ts=8)
    assert ("C1", "back") in rows(scan.latest(table.cells(), COLS))


def test_delete_of_an_empty_list_is_an_error(table, keys_of):
    with pytest.raises(ValueError):
        table.delete(keys_of())
    assert table.delete(keys_of("")) == 1


def test_delete_equals_anti_join(table, docs, keys_of):
    table.put(docs, "Invoice", ts=5)
    scanned = scan.latest(table.cells(), COLS)
    gone = keys_of("498579", "C1", "nope")
    expected = rows(scan.without_rows(scanned, gone, "Invoice"))
    table.delete(gone, ts=6)
    assert rows(scan.latest(table.cells(), COLS)) == expected


def test_bulk_load_equals_put(spark, tmp_path, table, docs):
    bulk_files(docs, str(tmp_path / "files"), "Invoice", COLS, REGION_BOUNDS, ts=5)
    assert scan.latest(table.cells(), COLS).count() == 0
    table.adopt(str(tmp_path / "files"))
    put = CellTable.create(spark, str(tmp_path / "put"), REGION_BOUNDS)
    put.put(docs, "Invoice", COLS, ts=5)
    assert rows(table.cells().drop("seq")) == rows(put.cells().drop("seq"))


def test_files_for_other_bounds_are_refused(spark, tmp_path, table, docs):
    path = str(tmp_path / "files")
    bulk_files(docs, path, "Invoice", COLS, [600000], ts=5)
    with pytest.raises(ValueError, match="other region bounds"):
        table.adopt(path)
    with pytest.raises(Exception, match="(?i)exist"):
        bulk_files(docs, path, "Invoice", COLS, [600000], ts=5)
    assert table.cells().count() == 0


def test_files_of_another_family_are_refused(spark, tmp_path, table, docs):
    bulk_files(docs, str(tmp_path / "f"), "Invoice", COLS, REGION_BOUNDS, "other", ts=5)
    with pytest.raises(ValueError, match="family"):
        table.adopt(str(tmp_path / "f"))


def test_adoption_reads_and_writes_no_cell(spark, tmp_path, table, docs):
    from test_regions import files_in_order, records

    path = str(tmp_path / "f")
    bulk_files(records(spark, 4000).repartition(4), path, "Invoice", None, REGION_BOUNDS,
               ts=1, file_bytes=7000)
    files = files_in_order(spark, f"{path}/cells")
    assert sum(f["cells"] for f in files) == 8000
    assert all(f["in_order"] for f in files)
    table.put(docs, "Invoice", ts=2)
    table.adopt(path)
    assert table.adopted() == [path]
    moved = files_in_order(spark, f"{table.path}/bulk")
    assert all(f["in_order"] for f in moved) and table.cells().count() == 8000 + 7
    assert spark.read.parquet(f"{table.path}/cells").count() == 7
    with pytest.raises(ValueError, match="before"):
        table.adopt(path)
    table.delete(spark.createDataFrame([("500000",)], "row_key string"), ts=3)
    keys = {r[0] for r in scan.latest(table.cells(), "Invoice").collect()}
    assert "500000" not in keys and "498579" in keys


def test_rejected_records_are_returned(spark, tmp_path, table):
    records = spark.createDataFrame([("1", "a"), ("", "b"), (None, "c")], "k string, v string")
    with pytest.raises(ValueError, match="2 rows"):
        table.put(records, "k")
    assert table.put(records, "k", rejects_path=str(tmp_path / "r"), ts=1) == 2
    assert rows(spark.read.parquet(str(tmp_path / "r"))) == [("", "b"), (None, "c")]
    assert rows(scan.latest(table.cells(), "k, v")) == [("1", "a")]


def test_a_snapshot_does_not_change(spark, table, docs):
    assert table.last_commit() == 0
    table.put(docs, "Invoice", ts=50, seq=7)
    image = rows(scan.snapshot(table.cells(), COLS, table.last_commit()))
    late = spark.createDataFrame([("C1", "back-dated"), ("9", "new")], docs.schema)
    table.put(late, "Invoice", ts=60, seq=8)
    table.put(late, "Invoice", ts=20, seq=9)
    assert rows(scan.snapshot(table.cells(), COLS, 7)) == image == blanked(DOCS)
    assert rows(scan.as_of(table.cells(), COLS, 50)) != image


def test_adoption_leaves_snapshots_as_they_are(spark, tmp_path, table, docs):
    """Files that are older than a commit, adopted after it, are not in its image."""
    for name, value in (("a", "older"), ("b", "oldest")):
        late = spark.createDataFrame([("C1", value), ("new", value)], docs.schema)
        bulk_files(late, str(tmp_path / name), "Invoice", COLS, REGION_BOUNDS, ts=90, seq=1)
    table.put(docs, "Invoice", ts=50)
    first = table.last_commit()
    image = rows(scan.snapshot(table.cells(), COLS, first))
    table.adopt(str(tmp_path / "a"))
    second = table.last_commit()
    assert second > first
    with_a = rows(scan.snapshot(table.cells(), COLS, second))
    assert ("new", "older") in with_a and ("C1", "older") in with_a
    table.adopt(f"{tmp_path}/b/")
    assert rows(scan.snapshot(table.cells(), COLS, first)) == image == blanked(DOCS)
    assert rows(scan.snapshot(table.cells(), COLS, second)) == with_a
    assert scan.latest(table.cells(), COLS).count() == 5


def test_a_folder_is_adopted_once_however_it_is_written(spark, tmp_path, table, docs):
    path = str(tmp_path / "f")
    bulk_files(docs, path, "Invoice", COLS, REGION_BOUNDS, ts=5)
    table.adopt(f"{path}/")
    for again in (path, f"file:{path}", f"{tmp_path}/./f"):
        with pytest.raises(ValueError, match="before"):
            table.adopt(again)
    assert table.cells().count() == 7


def test_an_adoption_that_broke_off_is_unseen_and_can_be_finished(
    spark, tmp_path, table, docs, monkeypatch
):
    path = str(tmp_path / "f")
    bulk_files(docs, path, "Invoice", COLS, REGION_BOUNDS, ts=5)
    commit = CellTable._commit

    def fails(*args, **said):
        raise OSError("gone")

    monkeypatch.setattr(CellTable, "_commit", fails)
    with pytest.raises(OSError):
        table.adopt(path)
    monkeypatch.setattr(CellTable, "_commit", commit)
    assert table.cells().count() == 0 and table.adopted() == []
    table.adopt(path)
    assert table.cells().count() == 7


def test_many_adoptions_are_one_scan(spark, tmp_path, table, docs):
    from test_plans import plan

    for i in range(5):
        bulk_files(docs, str(tmp_path / str(i)), "Invoice", COLS, REGION_BOUNDS, ts=i)
        table.adopt(str(tmp_path / str(i)))
    text = plan(scan.snapshot(table.cells(), COLS, 3))
    assert text.count("FileScan parquet") == 2
    assert "commit#" in text.split("PartitionFilters")[2]
    assert rows(scan.snapshot(table.cells(), COLS, 3)) == blanked(DOCS)
    assert scan.versions(table.cells(), 9).count() == 5 * 7


def test_commits_only_grow(table, docs):
    table.put(docs, "Invoice", ts=5, seq=7)
    for seq in (7, 3):
        with pytest.raises(ValueError, match="not above"):
            table.put(docs, "Invoice", ts=6, seq=seq)
    assert table.last_commit() == 7 and table.cells().count() == 7


def test_the_manifest_counts_what_was_written(spark, tmp_path, table, docs, keys_of):
    odd = spark.createDataFrame([("", "x"), (None, "y")], docs.schema)
    table.put(docs.union(odd), "Invoice", ts=5, allow_rejects=True)
    table.delete(keys_of("C1", "C1", "nope", ""), ts=6)
    bulk_files(docs, str(tmp_path / "f"), "Invoice", COLS, REGION_BOUNDS, ts=7)
    table.adopt(str(tmp_path / "f"))
    table.append_log(table.cells().limit(3))
    got = [tuple(r) for r in table.commits().orderBy("commit").collect()]
    assert [g[:2] for g in got] == [(1, "put"), (2, "delete"), (3, "adopt"), (4, "append")]
    assert got[0][2:6] == (5, 4, 7, 2) and got[1][2:6] == (6, 3, 2, 1)
    assert got[2][6] == str(tmp_path / "f") and got[3][4] == 3


def test_odd_column_names(spark, tmp_path, table):
    from cellframe.sinks.results import save_result

    records = spark.createDataFrame([("1", "x", "y")], "k string, ` a ` string, `b``c` string")
    table.put(records, "k", [" a ", "b`c"], ts=1)
    found = scan.latest(table.cells(), ["k", " a ", "b`c", " a "])
    assert rows(found) == [("1", "x", "y", "x")]
    save_result(found, ["k", " a ", "b`c", " a "], str(tmp_path / "r"))
    assert rows(spark.read.parquet(str(tmp_path / "r"))) == [("1", "x", "y")]


def test_get_uses_the_regions_of_the_table(table, docs, keys_of):
    table.put(docs, "Invoice", ts=5)
    found = scan.get_rows(
        table.cells(), keys_of("C1", "C1", "498580", "1"), COLS, bounds=table.bounds
    )
    assert rows(found) == [("", ""), ("498580", "b"), ("C1", "c"), ("C1", "c")]


def test_the_whole_chain_by_command_line(spark, tmp_path):
    """CSV -> put -> scan -> bulk files -> adopt -> snapshot -> delete -> get."""
    source = csv(
        tmp_path, "489434,A,d,1,t,2,7,UK", "489434,A,d,1,t,2,7,UK", "C500,B,e,1,t,3,,FR",
        "999999,C,f,9,t,1,8,DE",
    )
    (tmp_path / "keys").write_text("C500\nC500\nmissing\n\n")
    path = {
        n: str(tmp_path / n)
        for n in "table scan range get snap files loaded get2 scan2 range2".split()
    }
    keys = str(tmp_path / "keys")

    def read_all(table, s, r, g):
        cli.main(["read-table", "--table-path", path[table], "--scan-dir", path[s],
                  "--range-dir", path[r], "--get-dir", path[g], "--keys-path", keys,
                  "--start", "0", "--end", "2000"])

    # main() joins the running session.
    cli.main(["create-table", "--table-path", path["table"],
              "--bounds", "490000, 500000"])
    cli.main(["write-sales", "--source-path", source, "--table-path", path["table"],
              "--ts", "1000"])
    read_all("table", "scan", "range", "get")
    scanned = rows(spark.read.parquet(path["scan"]))
    assert [k for k, _ in scanned] == ["489434", "999999", "C500"]
    assert scanned == rows(spark.read.parquet(path["range"]))
    assert rows(spark.read.parquet(path["get"])) == [("", "")] + [scanned[2]] * 2

    cli.main(["create-table", "--table-path", path["loaded"],
              "--sample-path", path["scan"], "--regions", "2"])
    assert len(CellTable.open(spark, path["loaded"]).bounds) == 1
    cli.main(["bulk-load", "--input-dir", path["scan"], "--files-dir", path["files"],
              "--table-path", path["loaded"], "--ts", "1500"])
    cli.main(["delete-rows", "--table-path", path["loaded"], "--keys-path", keys,
              "--ts", "1600"])
    cli.main(["read-snapshot", "--table-path", path["loaded"], "--at", "1599",
              "--save-dir", path["snap"]])
    assert rows(spark.read.parquet(path["snap"])) == scanned
    read_all("loaded", "scan2", "range2", "get2")
    assert rows(spark.read.parquet(path["scan2"])) == scanned[:2]
    assert rows(spark.read.parquet(path["get2"])) == [("", "")] * 3


def test_read_job_checks_its_range_before_it_writes(spark, tmp_path, table):
    (tmp_path / "keys").write_text("1\n")
    with pytest.raises(ValueError):
        jobs.read_table(spark, table.path, str(tmp_path / "s"), str(tmp_path / "r"),
                        str(tmp_path / "g"), str(tmp_path / "keys"), 10, 5)
    assert not (tmp_path / "s").exists()


def test_null_invoice_is_rejected_by_the_write_job(spark, tmp_path, table):
    source = csv(tmp_path, ",A,d,1,t,2,7,UK", "1,B,e,1,t,3,,FR")
    with pytest.raises(ValueError, match="1 lines"):
        jobs.write_sales(spark, source, table.path)
    left = str(tmp_path / "left")
    assert jobs.write_sales(spark, source, table.path, rejects_path=left) == 1
    assert rows(spark.read.parquet(left).select("Invoice", "StockCode")) == [(None, "A")]
    assert rows(scan.latest(table.cells(), COLS).select("Invoice")) == [("1",)]


def test_lines_without_invoice_are_never_nested(spark, tmp_path, table, monkeypatch):
    """What is written in between holds no null group, and is gone afterwards."""
    source = csv(tmp_path, *[f",A,d,{i},t,2,7,UK" for i in range(50)], "1,B,e,1,t,3,,FR")
    shared = tmp_path / "shared"
    monkeypatch.setattr("cellframe.functions.sizing.scratch_dir", lambda _, name: f"{shared}/{name}")
    shared.mkdir()
    seen = []
    put = CellTable.put

    def spy(self, records, *args, **options):
        assert len(list(shared.iterdir())) == 1
        seen.append(rows(records.select("Invoice")))
        return put(self, records, *args, **options)

    monkeypatch.setattr(CellTable, "put", spy)
    assert jobs.write_sales(spark, source, table.path, allow_rejects=True) == 50
    assert seen == [[("1",)]]
    assert list(shared.iterdir()) == []


def test_a_put_reads_its_source_twice(spark, table):
    """Once to measure regions, keys and heavy keys, once to write."""
    read = spark.sparkContext.accumulator(0)

    def seen(row):
        read.add(1)
        return row

    n = 4000
    source = spark.createDataFrame(
        spark.sparkContext.range(n, numSlices=4)
        .map(lambda i: (str(500_000 + (i if i % 3 else 7)), "x" * (1 + i % 40))).map(seen),
        "Invoice string, orders string",
    )
    table.put(source, "Invoice", ts=1, file_bytes=9000)
    assert read.value == 2 * n
    assert table.commits().first()["records"] == n


def test_files_are_equal_in_bytes(spark, tmp_path):
    """A few documents hold most of the bytes; files go by bytes, not by rows."""
    docs = spark.range(4000).selectExpr(
        "CAST(500000 + id AS STRING) AS k", "repeat('x', IF(id < 400, 1000, 10)) AS v"
    ).repartition(6)
    path = str(tmp_path / "f")
    bulk_files(docs, path, "k", None, [100, 900000], ts=1, file_bytes=40_000)
    files = spark.read.parquet(f"{path}/cells").selectExpr(
        "_metadata.file_path AS file", "octet_length(row_key) + octet_length(value) AS size"
    ).groupBy("file").sum("size").collect()
    sizes = sorted(r[1] for r in files)
    assert len(sizes) >= 10 and sizes[-1] < 2.5 * 40_000


def test_a_get_skips_what_holds_none_of_its_keys(spark, tmp_path):
    """Scattered keys: row groups are skipped by their statistics and Bloom filters."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("parquet.block.size", "65536")
    try:
        table = CellTable.create(spark, str(tmp_path / "t"), ["5"])
        docs = spark.range(10_000).selectExpr("md5(cast(id as string)) k", "repeat('x', 100) v")
        for i in range(3):
            table.put(docs.selectExpr(f"concat(k, '{i}') AS k", "v"), "k", ts=i)
    finally:
        hadoop.unset("parquet.block.size")
    keys = docs.selectExpr("concat(k, '1') AS row_key").limit(30)
    found = scan.get_rows(table.cells(), keys, "k, v", bounds=table.bounds)
    assert found.count() == 30 and found.where("v = ''").count() == 0
    found.collect()

    def scanned(plan):
        name = plan.nodeName()
        if "Scan parquet" in name:
            return plan.metrics().apply("numOutputRows").value()
        inner = [plan.plan()] if "QueryStage" in name else []
        if "AdaptiveSparkPlan" in name:
            inner = [plan.executedPlan()]
        children = plan.children()
        inner += [children.apply(i) for i in range(children.size())]
        return sum(scanned(p) for p in inner)

    read = scanned(found._jdf.queryExecution().executedPlan())
    assert 60 <= read < 60_000 / 3
