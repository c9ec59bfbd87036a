"""Every catalogue query against its SQL twin on the whole sf0.01 tables."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_points
from cellframe.plans.oracle import oracle_sql
from cellframe.plans.queries import queries
from conftest import CHECK, SMALL

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()
TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM '{CHECK}/{name}.parquet'"
        )
    return connection


def test_catalogue_and_oracle_have_the_same_keys():
    assert queries().keys() == oracle_sql().keys()
    assert len(queries()) == 30
    assert queries().keys() <= entry_points.queries().keys()
    assert oracle_sql().items() <= entry_points.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, duck, name):
    ours = queries()[name](spark, CHECK)
    theirs = duck.sql(oracle_sql()[name])
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    theirs_types = dict(zip(theirs.columns, map(str, theirs.types)))
    assert {c: TYPES[t] for c, t in ours.dtypes} == theirs_types
    expected = Counter(theirs.select(*[f'"{c}"' for c in columns]).fetchall())
    assert sum(expected.values()) > 0
    assert Counter(tuple(r) for r in ours.select(*columns).collect()) == expected


def test_entry(spark):
    result = entry_points.entry(spark)
    assert result.columns == ["Invoice", "orders"]
    assert result.count() > 0
    assert SMALL == entry_points.ENTRY_DIR
