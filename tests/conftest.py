import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"
CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def log_of(spark):
    """Build a cell log from (row_key, qualifier, value, ts[, seq[, family]])."""
    from cellframe.model import CELL_SCHEMA

    def build(*rows):
        full = []
        for i, row in enumerate(rows):
            key, qualifier, value, ts, *rest = row
            seq = rest[0] if rest else i
            family = rest[1] if len(rest) > 1 else "order"
            kind = "D" if qualifier is None else "P"
            full.append((key, family, qualifier, value, ts, seq, kind, 0))
        return spark.createDataFrame(full, CELL_SCHEMA)

    return build


@pytest.fixture
def keys_of(spark):
    def build(*keys):
        return spark.createDataFrame([(k,) for k in keys], "row_key string")

    return build


def rows(df):
    """All rows as sorted tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
