"""Measured broadcast sizes and the scratch folder."""

import pytest

from cellframe.functions.sizing import (
    ROW_OVERHEAD, broadcast_limit, fits_broadcast, scratch_dir, written,
)
from conftest import rows


class Session:
    """Stands in for a session with the given settings and master."""

    def __init__(self, settings, master="local[2]"):
        self.settings = settings
        self.conf = self
        self.sparkContext = self
        self.master = master

    def get(self, name, default=None):
        return self.settings.get(name, default)


@pytest.mark.parametrize("text, size", [
    ("10MB", 10 * 2**20), ("10485760b", 10 * 2**20), ("10485760", 10 * 2**20),
    ("512k", 512 * 1024), ("1g", 2**30), ("-1", -1),
])
def test_broadcast_limit(text, size):
    assert broadcast_limit(
        Session({"spark.sql.autoBroadcastJoinThreshold": text})
    ) == size


def test_fits_broadcast_counts_rows_and_text():
    session = Session({"spark.sql.autoBroadcastJoinThreshold": str(ROW_OVERHEAD * 10)})
    assert fits_broadcast(session, 10, 0)
    assert not fits_broadcast(session, 10, 1)
    assert fits_broadcast(session, 0, None)
    off = Session({"spark.sql.autoBroadcastJoinThreshold": "-1"})
    assert not fits_broadcast(off, 0, None)


def test_scratch_lies_in_the_shared_folder():
    cluster = Session({"spark.checkpoint.dir": "hdfs://host/shared/"}, "yarn")
    first, second = scratch_dir(cluster, "x"), scratch_dir(cluster, "x")
    assert first.startswith("hdfs://host/shared/x-") and first != second
    with pytest.raises(ValueError):
        scratch_dir(Session({}, "yarn"), "x")
    assert scratch_dir(Session({}), "x").startswith("/")


def test_written_keeps_rows_and_schema(spark):
    df = spark.createDataFrame([("1", None), ("2", "x")], "a string, b string")
    back = written(spark, df, "check")
    assert back.schema == df.schema
    assert rows(back) == rows(df)
