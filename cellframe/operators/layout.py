"""Region layout: which task writes which cells, and in which order."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellframe.functions.text import quoted

# Bytes of keys and values in one written file before its region takes several. One task
# sorts it, and short cells take several times their bytes as rows.
FILE_BYTES = 64 << 20

# Sample keys in the bytes of a file; cuts that one search step looks at.
POINTS, STEP = 32, 64


def sorted_for_files(cells: DataFrame, partition_columns: list[str]) -> DataFrame:
    """Sort each partition by key for a writer that partitions its output.

    The writer's partition columns lead: otherwise it sorts again, by those
    alone, and the key order inside the files is lost.
    """
    return cells.sortWithinPartitions(
        *partition_columns, "row_key", "family", "qualifier", F.desc("ts"),
        F.desc("seq"),
    )


@dataclass(frozen=True)
class RegionSize:
    rows: int
    bytes: int


class Measured(dict):
    """`RegionSize` by region (None: no usable key), and in `samples` for each region
    the sampled keys, each with the bytes that it stands for."""

    def __init__(self):
        super().__init__()
        self.samples: dict[int, list[tuple[str, int]]] = {}


def octets(columns: list[Column]) -> Column:
    """Bytes of the text of some columns; null counts as none."""
    lengths = [F.coalesce(F.octet_length(c.cast("string")), F.lit(0)) for c in columns]
    return sum(lengths[1:], lengths[0]).cast("long")


def region_sizes(rows: DataFrame, file_bytes: int = FILE_BYTES) -> Measured:
    """Rows and bytes per region, and a sample of keys by bytes, in one pass.

    From `region` and, where there are such columns, `bytes` and `row_key`. A row is
    picked with a chance of its bytes over a `POINTS`-th of a file, and stands for so
    many bytes. All that is not picked is one group a region; picks of one key fold,
    on the map side already, into the estimated bytes of that key, so heavy keys need
    no pass of their own. What comes back grows with the number of files, not rows.
    """
    step = max(1, file_bytes // POINTS)
    size = F.col("bytes") if "bytes" in rows.columns else F.lit(0).cast("long")
    key = F.col("row_key") if "row_key" in rows.columns else F.lit(None).cast("string")
    picked = rows.select(
        "region", key.alias("key"), size.alias("bytes"), (F.rand(5) * step < size).alias("picked")
    )
    groups = picked.groupBy("region", F.when(F.col("picked"), F.col("key")).alias("key")).agg(
        F.count("*").alias("rows"), F.sum("bytes").alias("bytes"),
        F.sum(F.when(F.col("picked"), F.greatest("bytes", F.lit(step)))).alias("weight"),
    )
    found = Measured()
    for r in groups.collect():
        before = found.get(r["region"], RegionSize(0, 0))
        found[r["region"]] = RegionSize(
            before.rows + r["rows"], before.bytes + (r["bytes"] or 0)
        )
        if r["key"] is not None and r["region"] is not None:
            found.samples.setdefault(r["region"], []).append((r["key"], r["weight"]))
    return found


def cuts(sizes: Measured, file_bytes: int) -> list[tuple[int, str, int]]:
    """(region, lowest key, tasks) of every range of keys, in order.

    A region takes as many ranges as files, about equal in bytes; a key that alone
    exceeds a file is a range of its own, for several tasks.
    """
    out = []
    for region in sorted(r for r in sizes if r is not None):
        out.append((region, "", 1))
        total = sizes[region].bytes
        if total <= file_bytes:
            continue
        share, held = total / -(-total // file_bytes), 0.0
        for key, weight in sorted(sizes.samples.get(region, ())):
            if weight > file_bytes:
                out += [(region, key, -(-weight // file_bytes)), (region, f"{key}\0", 1)]
                held = 0.0
                continue
            if held and held + weight / 2 > share:
                out.append((region, key, 1))
                held = 0.0
            held += weight
    # Two heavy keys may follow each other with nothing in between.
    last = {(region, low): tasks for region, low, tasks in out}
    return [(*place, tasks) for place, tasks in sorted(last.items())]


def by_region(
    cells: DataFrame, sizes: Measured, file_bytes: int = FILE_BYTES
) -> DataFrame:
    """Deal cells to writing tasks: a task per small region, several per big one.

    `sizes` holds the regions that are present, so empty ones cost nothing. Tasks are
    ranges of (region, key) and their ids are passed straight through (no hash), so no
    two collide, no further pass samples keys, and a read can skip files by key. Only
    the cells of a key that alone exceeds a file are spread over its tasks, by a hash
    that includes the reading task, so that not even copies of one cell gather.
    """
    ranges = cuts(sizes, file_bytes)
    if not ranges:
        return cells
    points = [_place(region, low) for region, low, _ in ranges]
    dealt = cells.withColumn(
        "place", F.concat(F.lpad(F.col("region").cast("string"), 10, "0"), "row_key")
        if any(low for _, low, _ in ranges) else F.lpad(F.col("region").cast("string"), 10, "0")
    )
    dealt = _ranked(dealt, points)
    if all(tasks == 1 for _, _, tasks in ranges):
        count, task = len(ranges), F.col("slot")
    else:
        first = [0]
        for _, _, tasks in ranges:
            first.append(first[-1] + tasks)
        count = first.pop()
        spread = F.xxhash64("row_key", "qualifier", F.spark_partition_id())
        dealt = dealt.withColumn(
            "width", F.element_at(_constant([str(t) for *_, t in ranges], "INT"), F.col("slot") + 1)
        )
        task = F.element_at(_constant([str(f) for f in first], "INT"), F.col("slot") + 1) + F.when(
            F.col("width") > 1, F.pmod(spread, F.col("width")).cast("int")
        ).otherwise(0)
    return (
        dealt.withColumn("task", task.cast("int"))
        .repartitionById(count, "task")
        .select(*cells.columns)
    )


def _place(region: int, key: str) -> str:
    """Region and key as one text, in the order of both."""
    return f"{region:010d}{key}"


def _constant(items: list[str], element: str) -> Column:
    """One folded literal, however many items; the separator is in none of them."""
    mark = uuid.uuid4().hex
    return F.expr(f"CAST(split({quoted(mark.join(items))}, '{mark}') AS ARRAY<{element}>)")


def _ranked(cells: DataFrame, points: list[str]) -> DataFrame:
    """The number of the range that `place` is in, as `slot`: a search in steps."""
    widths = [1]
    while widths[-1] * STEP < len(points):
        widths.append(widths[-1] * STEP)
    cells = cells.withColumn("slot", F.lit(0))
    for width in reversed(widths):
        # Every width-th point; behind the first step only those after the last hit.
        known = _constant(points[::width], "STRING")
        if width != widths[-1]:
            known = F.slice(known, F.col("slot") * STEP + 1, F.lit(STEP))
        passed = F.size(F.filter(known, lambda p: p <= F.col("place")))
        base = F.col("slot") * STEP if width != widths[-1] else F.lit(0)
        cells = cells.withColumn("slot", base + F.greatest(passed - 1, F.lit(0)))
    return cells
