"""The cell log on disk: create, put, bulk-load, delete.

A table is a folder with `cells/` (append-only parquet, partitioned by kind
and region), `bulk/` (the cells of bulk loads, a folder for each adoption), `commits/`
(the manifest: a line for every operation that took effect, with its number and
what it wrote) and `meta/` (region bounds and family, fixed for the table's life).
One writer at a time; each operation is one committed Spark write and then its line.
"""

from __future__ import annotations

import json
import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellframe.functions.regions import Bounds, region_of
from cellframe.functions.sizing import PACKED, is_folder, qualified, rename
from cellframe.functions.text import named
from cellframe.model import (
    CELL_SCHEMA, FAMILY, PARTITION_COLUMNS, PUT, TOMBSTONE, column_list,
)
from cellframe.operators import cells as C
from cellframe.operators.layout import (
    FILE_BYTES, Measured, RegionSize, by_region, octets, region_sizes, sorted_for_files,
)

# A stored cell also has the number of the commit that made it part of the table.
STORED_SCHEMA = T.StructType([*CELL_SCHEMA, T.StructField("commit", T.LongType())])

# A line of the manifest. `folder` is where an adopted load was prepared; the counts
# are null where nothing counted them (the cells of an adoption are not read).
COMMIT_SCHEMA = T.StructType([
    T.StructField("commit", T.LongType()),
    T.StructField("operation", T.StringType()),
    T.StructField("ts", T.LongType()),
    T.StructField("records", T.LongType()),
    T.StructField("cells", T.LongType()),
    T.StructField("rejects", T.LongType()),
    T.StructField("folder", T.StringType()),
])


def now_ms() -> int:
    return time.time_ns() // 1_000_000


@dataclass(frozen=True)
class CellTable:
    """A cell log at `path`; reads are plain DataFrames from `cells()`."""

    spark: SparkSession
    path: str
    bounds: tuple
    family: str

    @classmethod
    def create(
        cls,
        spark: SparkSession,
        path: str,
        bounds: Bounds,
        family: str = FAMILY,
    ) -> CellTable:
        """A new, empty table; an existing one is never replaced.

        `bounds` are the split points of its regions: `bounds_from` and
        `text_bounds_from` cut them from data.
        """
        region_of("row_key", bounds)  # checks the bounds
        _write_meta(spark, path, bounds, family)
        empty = spark.range(0).select(
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in STORED_SCHEMA]
        )
        _append(empty, f"{path}/cells")
        spark.createDataFrame([], COMMIT_SCHEMA).write.mode("append").json(f"{path}/commits")
        return cls(spark, path, tuple(bounds), family)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> CellTable:
        return cls(spark, path, *_read_meta(spark, path))

    def cells(self) -> DataFrame:
        """The whole log, with the commit of every cell: one scan of what was put and,
        if there is any, one of what was adopted. The schema is given, so no footer is
        read for it. Adopted folders are pruned by commit like any partition; one that
        has no line in the manifest is not part of the table."""
        read = self.spark.read.schema(STORED_SCHEMA)
        own = read.parquet(f"{self.path}/cells").select(*STORED_SCHEMA.names)
        adopted = [r["commit"] for r in self._adoptions()]
        if not adopted:
            return own
        loaded = read.parquet(f"{self.path}/bulk").where(F.col("commit").isin(adopted))
        return own.unionByName(loaded)  # in the order of the schema

    def commits(self) -> DataFrame:
        """The manifest: (commit, operation, ts, records, cells, rejects, folder)."""
        return self.spark.read.schema(COMMIT_SCHEMA).json(f"{self.path}/commits")

    def _adoptions(self) -> list:
        return self.commits().where("operation = 'adopt'").collect()

    def adopted(self) -> list[str]:
        """Folders that the bulk loads of the table were prepared in."""
        return sorted(r["folder"] for r in self._adoptions())

    def last_commit(self) -> int:
        """The greatest commit number so far; 0 for an empty table."""
        return self.commits().agg(F.max("commit")).first()[0] or 0

    def _next(self, number: int | None = None) -> int:
        """The number of the next commit: above all before it."""
        last = self.last_commit()
        if number is not None and number <= last:
            raise ValueError(f"commit {number} is not above the last one, {last}")
        return last + 1 if number is None else number

    def _commit(self, number: int, operation: str, **said) -> None:
        """The line that makes an operation take effect."""
        line = {"commit": number, "operation": operation, **said}
        row = [line.get(f.name) for f in COMMIT_SCHEMA]
        self.spark.createDataFrame([row], COMMIT_SCHEMA).write.mode("append").json(
            f"{self.path}/commits"
        )

    def _store(self, cells: DataFrame, number: int, kind: str | None = None) -> int:
        """Append placed cells under a commit; returns how many there were, counted by
        the writing tasks."""
        return _append(cells.withColumn("commit", F.lit(number).cast("long")),
                       f"{self.path}/cells", kind)

    def region(self) -> Column:
        """Region of the rows of any DataFrame with a `row_key`."""
        return region_of("row_key", self.bounds)

    def put(
        self,
        records: DataFrame,
        key: str,
        fields: str | Sequence[str] | None = None,
        ts: int | None = None,
        seq: int | None = None,
        allow_rejects: bool = False,
        file_bytes: int = FILE_BYTES,
        rejects_path: str | None = None,
    ) -> int:
        """Upsert: each non-null field becomes a cell stamped `ts`.

        A null or empty row key is an error, raised before anything is written,
        unless `allow_rejects` leaves such rows out or `rejects_path` takes them
        as parquet. Returns their number.
        """
        number = self._next(seq)
        ts, seq = _stamp(ts, seq)
        prepared, sizes, rejects = _prepared(
            records, key, self.bounds, fields, self.family, ts, seq,
            allow_rejects or rejects_path is not None, file_bytes,
        )
        if rejects_path is not None:
            C.split_rejects(records, key)[1].write.parquet(rejects_path)
        cells = self._store(prepared, number, PUT)
        self._commit(number, "put", ts=ts, records=sum(s.rows for s in sizes.values()),
                     cells=cells, rejects=rejects)
        return rejects

    def delete(
        self, keys: DataFrame, ts: int | None = None, seq: int | None = None
    ) -> int:
        """Row tombstones for `keys` (column row_key); unknown keys are harmless.

        An empty list is an error. Null and empty keys name no row: they are
        left out and their number is returned.
        """
        number = self._next(seq)
        region = self.region()
        sizes = region_sizes(keys.select(
            region.alias("region"), "row_key", octets([F.col("row_key")]).alias("bytes")
        ))
        if not sizes:
            raise ValueError("no row keys to delete")
        blank = sizes.pop(None, RegionSize(0, 0)).rows
        named = keys.where(C.usable_key(F.col("row_key")))
        ts, seq = _stamp(ts, seq)
        stamped = C.tombstones(named, ts, seq, region)
        cells = self._store(by_region(stamped, sizes), number, TOMBSTONE)
        self._commit(number, "delete", ts=ts, records=sum(s.rows for s in sizes.values()),
                     cells=cells, rejects=blank)
        return blank

    def adopt(self, prepared_path: str) -> None:
        """Make prepared bulk-load files part of the table.

        The folder of cells is renamed into the table, in one step on a file system,
        and from its line in the manifest on it belongs to it, under a commit of its own:
        no cell is read or written, and snapshots of earlier commits stay as they were.
        Files for other bounds or another family are refused. Where an adoption broke
        off before its line was written, the same call finishes it.
        """
        folder = qualified(self.spark, prepared_path)
        bounds, family = _read_meta(self.spark, folder)
        if bounds != self.bounds:
            raise ValueError("files were prepared for other region bounds")
        if family != self.family:
            raise ValueError(f"files were prepared for the family {family!r}")
        if folder in [qualified(self.spark, f) for f in self.adopted()]:
            raise ValueError(f"{prepared_path} was adopted before")
        number = self._next()
        target = f"{self.path}/bulk/commit={number}"
        if is_folder(self.spark, f"{folder}/cells"):
            rename(self.spark, f"{folder}/cells", target)
        elif not is_folder(self.spark, target):
            raise ValueError(f"{prepared_path} holds no cells")
        self._commit(number, "adopt", folder=prepared_path.rstrip("/"))

    def append_log(self, log: DataFrame, file_bytes: int = FILE_BYTES) -> None:
        """Append ready log rows (puts and tombstones); regions are set here."""
        number = self._next()
        placed = log.withColumn("region", self.region()).to(CELL_SCHEMA)
        size = octets([F.col("row_key"), F.col("value")])
        sizes = region_sizes(placed.select("region", "row_key", size.alias("bytes")), file_bytes)
        if None in sizes:
            raise ValueError(f"{sizes[None].rows} log rows have a null or empty row key")
        cells = self._store(by_region(placed, sizes, file_bytes), number)
        self._commit(number, "append", records=cells, cells=cells)

    def append_ranges(self, puts: DataFrame) -> None:
        """Append ready put rows whose tasks hold ranges of keys already, as they are left
        by a range exchange: they are sorted and written where they are.

        They are neither measured nor dealt again, so they are read once. A null or empty
        row key or a tombstone fails the write, which leaves nothing behind.
        """
        number = self._next()
        wrong = F.raise_error(F.lit("log rows have a null or empty row key or are no puts"))
        region = F.coalesce(F.when(F.col("kind") == PUT, self.region()), wrong.cast("int"))
        cells = self._store(puts.withColumn("region", region).to(CELL_SCHEMA), number, PUT)
        self._commit(number, "append", records=cells, cells=cells)


def prepare_cells(
    records: DataFrame,
    key: str,
    bounds: Bounds,
    fields: str | Sequence[str] | None = None,
    family: str = FAMILY,
    ts: int | None = None,
    seq: int | None = None,
    allow_rejects: bool = False,
    file_bytes: int = FILE_BYTES,
) -> tuple[DataFrame, int]:
    """Records as log rows, placed by region, and the number of rejected records.

    A first pass measures the regions and counts the records without a usable
    key; the second explodes and places. `fields` defaults to every column.
    """
    cells, _, rejects = _prepared(
        records, key, bounds, fields, family, *_stamp(ts, seq), allow_rejects, file_bytes
    )
    return cells, rejects


def _prepared(
    records: DataFrame,
    key: str,
    bounds: Bounds,
    fields: str | Sequence[str] | None,
    family: str,
    ts: int,
    seq: int,
    allow_rejects: bool,
    file_bytes: int,
) -> tuple[DataFrame, Measured, int]:
    names = column_list(fields or records.columns)
    if key not in records.columns:
        raise ValueError(f"no key column {key!r} in {records.columns}")
    row_key = F.col(named(key)).cast("string")
    # Every cell repeats the key.
    size = octets([F.col(named(name)) for name in names]) + octets([row_key]) * len(names)
    measured = records.select(row_key.alias("row_key"), size.alias("bytes"))
    sizes = region_sizes(
        measured.select(region_of("row_key", bounds).alias("region"), "row_key", "bytes"),
        file_bytes,
    )
    rejects = sizes.pop(None, RegionSize(0, 0)).rows
    if rejects and not allow_rejects:
        raise ValueError(f"{rejects} rows have a null or empty row key")
    storable, _ = C.split_rejects(records, key)
    cells = C.stamp(
        C.row_to_cells(storable, key, names), ts, seq, region_of("row_key", bounds), family
    )
    return by_region(cells, sizes, file_bytes), sizes, rejects


def bulk_files(
    records: DataFrame,
    path: str,
    key: str,
    fields: str | Sequence[str] | None,
    bounds: Bounds,
    family: str = FAMILY,
    **options,
) -> int:
    """Write the files of a bulk load: a sorted file set per region, in a new folder.

    Further arguments as in `prepare_cells`. Bounds and family are kept beside the
    files; nothing reads them until they are adopted. Returns the number of
    rejected records.
    """
    prepared, rejects = prepare_cells(records, key, bounds, fields, family, **options)
    _write_meta(records.sparkSession, path, bounds, family)
    _append(prepared, f"{path}/cells", PUT)
    return rejects


def _write_meta(spark: SparkSession, path: str, bounds: Bounds, family: str) -> None:
    """What a folder was made for; an existing folder is an error."""
    meta = json.dumps({"bounds": list(bounds), "family": family})
    spark.range(1).select(F.lit(meta).alias("value")).write.mode("error").text(f"{path}/meta")


def _read_meta(spark: SparkSession, path: str) -> tuple[tuple, str]:
    meta = json.loads(spark.read.text(f"{path}/meta").first()["value"])
    return tuple(meta["bounds"]), meta["family"]


def _stamp(ts: int | None, seq: int | None) -> tuple[int, int]:
    """One timestamp and one commit number per run."""
    return (
        now_ms() if ts is None else ts,
        time.time_ns() if seq is None else seq,
    )


def _append(cells: DataFrame, path: str, kind: str | None = None) -> int:
    """Sort and commit log rows; rows of one known kind go to its folder. Returns their
    number, observed in the write itself.

    Such a `kind` is a constant. As a partition column it would be dropped
    from the sort by the optimizer and make the writer sort again without the
    row key. A Bloom filter of the row keys lets a get skip what its keys are not in.
    """
    columns = PARTITION_COLUMNS
    if kind is not None:
        cells, path, columns = cells.drop("kind"), f"{path}/kind={kind}", ["region"]
    seen = Observation()
    counted = cells.observe(seen, F.count(F.lit(1)).alias("cells"))
    ordered = sorted_for_files(counted, columns)
    (
        ordered.write.mode("append").partitionBy(*columns)
        .option("parquet.bloom.filter.enabled#row_key", "true")
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .option("compression", PACKED)
        .parquet(path)
    )
    return seen.get["cells"]
