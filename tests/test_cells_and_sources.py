"""Rows to cells, nesting, readers, result files."""

import json

import pytest
from pyspark.sql import functions as F

from cellframe.model import ORDER_FIELDS
from cellframe.operators.cells import record_to_cells, row_to_cells, split_rejects
from cellframe.operators.nest import check_invoices, nest_orders
from cellframe.sinks.results import save_result
from cellframe.sources.files import read_keys, read_sales_csv
from conftest import rows

HEADER = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"


def csv(tmp_path, *lines, name="sales.csv", header=HEADER):
    (tmp_path / name).write_text(header + "".join(line + "\n" for line in lines))
    return str(tmp_path / name)


def test_csv_all_strings_by_name_empty_is_null(spark, tmp_path):
    header = "Country,Invoice,Extra,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID\n"
    path = csv(tmp_path, "UK,1,e,S,\"D, d\",007,2020-01-01 00:00:00,1.50,", header=header)
    lines = read_sales_csv(spark, path)
    assert {t for _, t in lines.dtypes} == {"string"}
    assert rows(lines) == [
        ("1", "S", "D, d", "007", "2020-01-01 00:00:00", "1.50", None, "UK")
    ]


def test_csv_missing_column_raises(spark, tmp_path):
    path = csv(tmp_path, "1,2", header="Invoice,StockCode\n")
    with pytest.raises(ValueError, match="Customer ID"):
        read_sales_csv(spark, path)


def test_csv_part_files_with_other_headers_fail(spark, tmp_path):
    csv(tmp_path, "1,S,D,1,t,1,9,UK", name="a.csv")
    other = "StockCode,Invoice" + HEADER[len("Invoice,StockCode"):]
    csv(tmp_path, "S,1,D,1,t,1,9,UK", name="b.csv", header=other)
    with pytest.raises(Exception, match="(?i)header"):
        read_sales_csv(spark, str(tmp_path)).collect()


def test_csv_reads_single_columns_over_several_files(spark, tmp_path):
    csv(tmp_path, "1,S,D,1,t,1,9,UK", name="a.csv")
    csv(tmp_path, "2,S,D,1,t,1,,FR", name="b.csv")
    (tmp_path / "empty.csv").write_text("")
    lines = read_sales_csv(spark, str(tmp_path))
    assert rows(lines.select("Country")) == [("FR",), ("UK",)]
    assert rows(lines.select("Customer_ID", "Invoice")) == [("9", "1"), (None, "2")]
    assert lines.count() == 2


def test_key_list_is_untrimmed_with_blanks_and_repeats(spark, tmp_path):
    (tmp_path / "keys").write_text("1\n 2 \n\n1\n")
    keys = [r["row_key"] for r in read_keys(spark, str(tmp_path / "keys")).collect()]
    assert sorted(keys) == ["", " 2 ", "1", "1"]


def test_nest_collapses_repeats_and_leaves_nulls_out(spark):
    lines = spark.createDataFrame(
        [
            ("1", "B", "d", "1", "t", "2.50", None, "UK"),
            ("1", "A", 'q "x" \u00e9\n', "1", "t", "2.50", None, "UK"),
            ("1", "B", "d", "1", "t", "2.50", None, "UK"),
            (None, "Z", None, "3", "t", "1", "7", "FR"),
        ],
        ", ".join(f"{c} string" for c in ["Invoice", *ORDER_FIELDS]),
    )
    documents = nest_orders(lines)
    found = {r["Invoice"]: json.loads(r["orders"]) for r in documents.collect()}
    line = {"Quantity": "1", "InvoiceDate": "t", "Price": "2.50", "Country": "UK"}
    assert found == {
        "1": [{"StockCode": "A", "Description": 'q "x" \u00e9\n', **line},
              {"StockCode": "B", "Description": "d", **line}],
        None: [{"StockCode": "Z", "Quantity": "3", "InvoiceDate": "t", "Price": "1",
                "Customer_ID": "7", "Country": "FR"}],
    }
    with pytest.raises(ValueError):
        check_invoices(documents.withColumn("more", F.lit(1)))


def test_record_and_row_to_cells(spark):
    df = spark.createDataFrame(
        [("1", "x", 5), ("2", None, 6)], "row_key string, `a.b` string, n int"
    )
    assert rows(record_to_cells(df, "row_key")) == [
        ("1", "a.b", "x"), ("1", "n", "5"), ("1", "row_key", "1"),
        ("2", "n", "6"), ("2", "row_key", "2"),
    ]
    assert rows(row_to_cells(df, "row_key", ["a.b"])) == [("1", "a.b", "x")]


def test_split_rejects(spark):
    df = spark.createDataFrame([("1",), ("",), (None,)], "k string")
    valid, rejected = split_rejects(df, "k")
    assert rows(valid) == [("1",)]
    assert rows(rejected) == [("",), (None,)]


def test_save_result_overwrites_with_all_strings(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([("1", 2)], "id string, a int")
    save_result(df, "id, a", path)
    save_result(df, " a , id", path)
    back = spark.read.parquet(path)
    assert back.dtypes == [("a", "string"), ("id", "string")]
    assert rows(back) == [("2", "1")]
