"""What the operators share: words, Arrow batches, written intermediates."""

from __future__ import annotations

import os
import threading
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from cellframe.functions.sizing import remove, scratch_dir

# A word: a run of characters other than the six ASCII white spaces. On bytes
# this is exactly what `bytes.split()` gives.
WORD = r"[^\x20\x09-\x0D]+"

# Rows that are Python objects at a time.
BATCH_ROWS = 4096


def words_of(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8; none for null."""
    return text.encode().split() if text else []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def same(left: Column, right: Column) -> Column:
    """Equality for join keys that may be null."""
    return left.eqNullSafe(right)


def map_arrow(df: DataFrame, function: Callable, schema: StructType | str) -> DataFrame:
    """`mapInArrow` whose workers find this package where the driver found it,
    on a machine or file system that they share; elsewhere it comes by --py-files."""
    home = str(Path(__file__).resolve().parents[2])
    environment = df.sparkSession.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if home not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*filter(None, paths), home])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        # A worker goes on to other tasks and must not keep this one's buffers.
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def map_columns(
    df: DataFrame, schema: str, function: Callable[..., list[list]], caches: Sequence = ()
) -> DataFrame:
    """Run `function` on Arrow batches: one list per input column goes in, one
    list per column of `schema` comes out; the lengths in and out may differ.
    `caches` of the function live as long as a task and are cleared after it."""
    struct = _parse_datatype_string(schema)
    assert isinstance(struct, StructType)
    arrow = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                columns = function(*[c.to_pylist() for c in part.columns])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow
                )
        for cache in caches:
            cache.clear()

    return map_arrow(df, run, struct)


class _Written(threading.local):
    """Paths of the intermediate tables, in the order of writing."""

    def __init__(self):
        self.paths: list[str] = []


class Scratch:
    """Intermediate tables in the shared folder. `drop` removes one of them, `release`
    all that this thread has written since a `mark` and that nothing reads any more."""

    _written = _Written()

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name
        self.paths: dict[int, str] = {}

    def write(self, df: DataFrame, part: str) -> DataFrame:
        path = scratch_dir(self.spark, f"{self.name}-{part}")
        Scratch._written.paths.append(path)
        df.write.parquet(path)
        read = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(read)] = path
        return read

    def path(self, df: DataFrame) -> str:
        """Where a table of this scratch lies."""
        return self.paths[id(df)]

    def drop(self, df: DataFrame) -> None:
        remove(self.spark, quote(self.path(df), safe="/:"))

    @classmethod
    def mark(cls) -> int:
        return len(cls._written.paths)

    @classmethod
    def release(cls, spark: SparkSession, mark: int, keep: Sequence[str] = ()) -> None:
        """Remove what was written since the mark, by any operator, but for `keep`."""
        written = cls._written.paths
        for path in written[mark:]:
            if path not in keep:
                remove(spark, quote(path, safe="/:"))
        written[mark:] = [p for p in written[mark:] if p in keep]


def row_digest() -> Column:
    """64 bits of a document's source and text. Beside doc_id it tells rows apart that
    only share an id."""
    return F.xxhash64(F.col("source").isNull(), "source", F.col("text").isNull(), "text")


def word_count(text: str) -> Column:
    """Number of words of a text column, natively; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
