"""Inputs of the catalogue queries: invoices that are grouped where their lines were joined."""

import datetime

import pytest
from pyspark.sql import functions as F

from cellframe import fixtures as X
from cellframe.model import ORDER_FIELDS
from cellframe.operators.nest import nest_orders
from conftest import SMALL, rows
from test_plans import plan

SETTING = "spark.sql.autoBroadcastJoinThreshold"


@pytest.fixture(params=["-1", "10MB"])
def joins(spark, request):
    before = spark.conf.get(SETTING)
    spark.conf.set(SETTING, request.param)
    yield request.param
    spark.conf.set(SETTING, before)


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Orders that come twice, with other states, and null keys everywhere."""
    folder = str(tmp_path_factory.mktemp("odd"))
    day = datetime.datetime(2020, 1, 2)
    tables = {
        "orders": [(1, 1, "P", day), (1, 1, "O", day), (1, 2, "O", day), (1, 2, "O", day),
                   (2, 2, None, None), (None, 1, "O", day), (3, None, "P", day)],
        "lineitem": [(k, p, n, q, 1.5) for k in (1, 2, 3, None) for p in (1, 2, None)
                     for n, q in ((1, 2.0), (2, None), (2, None))],
        "customer": [(1, 1), (2, 1), (None, 1), (2, None)],
        "part": [(1, "one"), (1, None), (2, "two"), (None, "none")],
        "nation": [(1, "N"), (None, "none")],
    }
    for name, some in tables.items():
        spark.createDataFrame(some, X.TABLES[name]).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_lines_are_nested_where_they_were_joined(joins, spark):
    if joins == "-1":
        nested, lines = (plan(f(spark, SMALL)) for f in (X.invoices, X.sales_lines))
        assert nested.count("Exchange hash") == lines.count("Exchange hash") > 3
    assert rows(X.invoices(spark, SMALL)) == rows(nest_orders(X.sales_lines(spark, SMALL)))


def test_odd_orders_make_the_same_invoices(joins, spark, odd):
    lines = X.sales_lines(spark, odd)
    assert lines.columns == ["Invoice", *ORDER_FIELDS]
    nested = rows(X.invoices(spark, odd))
    assert nested == rows(nest_orders(lines)) and len(nested) == 3
    assert X.invoices(spark, odd).where(F.col("Invoice").startswith("C")).count() == 1
