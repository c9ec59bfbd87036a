"""Reads of the cell log: latest, time range, as-of, versions, multi-get.

A tombstone masks every put of its row with a timestamp at or below its own.
Masking is therefore a threshold on time, and two facts follow that keep the
plans small:

* the newest live value of a cell is its newest value or nothing, so a scan
  is one aggregation with map-side combine: no window, no join;
* the newest n live versions are what remains of the newest n versions, so
  versions are ranked before they are masked.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellframe.functions.regions import Bounds, region_of
from cellframe.functions.sizing import fits_broadcast
from cellframe.functions.text import named, quoted
from cellframe.model import FAMILY, PUT, TOMBSTONE, column_list
from cellframe.operators.cells import usable_key

CELL_KEY = ["row_key", "family", "qualifier"]

# Up to this many versions Spark trims groups before the shuffle.
TRIM_SETTING = "spark.sql.optimizer.windowGroupLimitThreshold"

# Versions of a cell that are ranked by one task when many are asked for.
PART_ROWS = 100_000

# Up to this many keys a get has the scan look them up in statistics and Bloom filters
# of the files; so many of them make one filter.
LOOKUPS, LOOKUP_FILTER = 500, 10

# Output rows that one copy-expanding task may emit for one key of a get.
COPIES_PER_TASK = 100_000


def _is(kind: str) -> Column:
    return F.col("kind") == kind


def _rows(log: DataFrame, columns: str | Sequence[str], family: str) -> DataFrame:
    """One row per row key with a live cell; absent values are "".

    The first name only names the key column. Rows whose live cells are all
    outside the requested columns stay.
    """
    names = column_list(columns)
    wanted = list(dict.fromkeys(names[1:]))
    slots = " ".join(f"WHEN {quoted(name)} THEN {i}" for i, name in enumerate(wanted))
    slot = f"CASE qualifier {slots} END" if wanted else "CAST(NULL AS INT)"
    # Only what is asked for travels on: unrequested values are dropped here.
    cells = log.selectExpr(
        "row_key", "ts", "seq", "value",
        f"IF(kind = '{PUT}', ts, NULL) AS put_ts",
        f"IF(kind = '{TOMBSTONE}', ts, NULL) AS deleted_ts",
        f"IF(kind = '{PUT}' AND family = {quoted(family)}, {slot}, NULL) AS slot",
    ).selectExpr(
        "row_key", "put_ts", "deleted_ts", "slot",
        "IF(slot IS NOT NULL, struct(ts, seq, value), NULL) AS version",
    )
    state = cells.groupBy("row_key").agg(
        F.max("put_ts").alias("put_ts"),
        F.max("deleted_ts").alias("deleted_ts"),
        *[
            F.expr(f"max(version) FILTER (WHERE slot = {i}) AS cell_{i}")
            for i in range(len(wanted))
        ],
    )

    def value(name: str) -> str:
        cell = f"cell_{wanted.index(name)}"
        visible = f"(deleted_ts IS NULL OR {cell}.ts > deleted_ts)"
        return f"coalesce(IF({visible}, {cell}.value, NULL), '') AS {named(name)}"

    # A row is there when its newest put is live.
    return state.where(
        "put_ts IS NOT NULL AND (deleted_ts IS NULL OR put_ts > deleted_ts)"
    ).selectExpr(
        f"row_key AS {named(names[0])}", *[value(name) for name in names[1:]]
    )


def latest(
    log: DataFrame, columns: str | Sequence[str], family: str = FAMILY
) -> DataFrame:
    """Full scan: the newest live value of each requested column per row."""
    return _rows(log, columns, family)


def time_range(
    log: DataFrame,
    columns: str | Sequence[str],
    start: int,
    end: int,
    family: str = FAMILY,
) -> DataFrame:
    """Scan of the puts in ``[start, end)``; every later tombstone still masks.

    Tombstones before `start` cannot mask a put at or after it, so the lower
    end applies to both kinds. Read kind by kind, both ends reach the parquet
    scan: files of puts written after the range are skipped.
    """
    if start < 0 or end < start:
        raise ValueError(f"bad time range [{start}, {end})")
    since = log.where(F.col("ts") >= start)
    puts = since.where(_is(PUT) & (F.col("ts") < end))
    return _rows(puts.unionByName(since.where(_is(TOMBSTONE))), columns, family)


def as_of(
    log: DataFrame, columns: str | Sequence[str], at: int, family: str = FAMILY
) -> DataFrame:
    """The table as it stood at `at`: later puts and tombstones are unseen.

    By cell time: a put that is later stamped back into that time is seen.
    """
    return _rows(log.where(F.col("ts") <= at), columns, family)


def snapshot(
    log: DataFrame, columns: str | Sequence[str], commit: int, family: str = FAMILY
) -> DataFrame:
    """The table after the commit numbered `commit`, the same whenever it is read.

    A stored cell has the number of the commit that made it part of the table, and
    these only grow; so neither a later put, whatever its time, nor the adoption of
    older files changes the image. `CellTable.last_commit` gives the number to keep.
    In a log that was never stored commits are told by `seq`.
    """
    number = "commit" if "commit" in log.columns else "seq"
    return _rows(log.where(F.col(number) <= commit), columns, family)


def versions(
    log: DataFrame,
    n: int = 1,
    columns: str | Sequence[str] | None = None,
    start: int | None = None,
    end: int | None = None,
    family: str | None = None,
) -> DataFrame:
    """Up to `n` newest live versions of every cell, newest as version 1.

    `columns` (the key's name first, as in the other scans) and `family` choose
    cells; ``[start, end)`` chooses puts by time, while later tombstones still
    mask them. Two puts of a cell in one millisecond are one version; `seq`
    decides. Repeats fold into one row before the shuffle, and groups are trimmed
    to `n` before the next one. Past what Spark trims by itself big cells are ranked
    in parts of time, a task each.
    """
    if n < 1:
        raise ValueError("at least one version must be asked for")
    puts = log.where(_is(PUT))
    if columns is not None:
        puts = puts.where(F.col("qualifier").isin(column_list(columns)[1:]))
    if family is not None:
        puts = puts.where(F.col("family") == family)
    if start is not None:
        # Older tombstones cannot mask what is left.
        log, puts = log.where(F.col("ts") >= start), puts.where(F.col("ts") >= start)
    if end is not None:
        puts = puts.where(F.col("ts") < end)
    if n == 1:
        ranked = (
            puts.groupBy(*CELL_KEY)
            .agg(F.max(F.struct("ts", "seq", "value")).alias("v"))
            .select(*CELL_KEY, F.lit(1).alias("version"), "v.ts", "v.value")
        )
    else:
        folded = (
            puts.groupBy(*CELL_KEY, "ts")
            .agg(F.max(F.struct("seq", "value")).alias("v"))
            .select(*CELL_KEY, "ts", "v.value")
        )
        if n > int(log.sparkSession.conf.get(TRIM_SETTING)):
            ranked = _ranked_by_parts(folded, n)
        else:
            newest_first = Window.partitionBy(*CELL_KEY).orderBy(F.desc("ts"))
            ranked = folded.select(
                *CELL_KEY,
                F.row_number().over(newest_first).alias("version"),
                "ts",
                "value",
            ).where(F.col("version") <= n)
    return _unmasked(ranked, log)


def _ranked_by_parts(folded: DataFrame, n: int) -> DataFrame:
    """The newest `n` of each cell with their numbers, a big cell by many tasks.

    Cells of more than `PART_ROWS` versions are cut into parts of time, newest first.
    The versions of each part are counted, running totals give the rank at which a part
    begins, and parts that begin behind `n` are dropped before anything is sorted. So
    no task sorts more than a part, whatever the cell and `n`. A millisecond has one
    version, so a part of time is bounded, too.
    """
    big = folded.groupBy(*CELL_KEY).agg(
        F.count("*").alias("n"), F.min("ts").alias("first"), F.max("ts").alias("last")
    ).where(F.col("n") > PART_ROWS)
    same_cell = [F.col(k).eqNullSafe(F.col(f"big_{k}")) for k in CELL_KEY]
    big = big.withColumnsRenamed({k: f"big_{k}" for k in CELL_KEY})
    # Part 0 is the newest; cells that are not big have only that.
    part = F.expr(f"""
        coalesce(CAST(floor((last - ts) / (last - first + 1D) * ceil(n / {PART_ROWS}D)) AS LONG), 0L)
    """)
    parted = folded.join(big, same_cell, "left").select(
        *folded.columns, part.alias("part"), F.col("n").isNotNull().alias("is_big")
    )
    in_cell = Window.partitionBy(*CELL_KEY).orderBy("part")
    before = F.sum("held").over(in_cell.rowsBetween(Window.unboundedPreceding, -1))
    starts = (
        parted.where("is_big").groupBy(*CELL_KEY, "part").agg(F.count("*").alias("held"))
        .withColumn("start", F.coalesce(before, F.lit(0)))
        .where(F.col("start") < n)
        .drop("held")
        .withColumnsRenamed({k: f"big_{k}" for k in CELL_KEY})
        .withColumnRenamed("part", "big_part")
    )
    parted = parted.join(
        starts, [*same_cell, F.col("part") == F.col("big_part")], "left"
    ).where("NOT is_big OR start IS NOT NULL")
    newest_first = Window.partitionBy(*CELL_KEY, "part").orderBy(F.desc("ts"))
    version = F.row_number().over(newest_first) + F.coalesce("start", F.lit(0))
    return parted.select(
        *CELL_KEY, version.cast("int").alias("version"), "ts", "value"
    ).where(F.col("version") <= n)


def _unmasked(ranked: DataFrame, log: DataFrame) -> DataFrame:
    """Drop the versions that a tombstone of their row masks.

    Tombstones fold to one row per row key. Measured small, they are sent to
    every executor; otherwise it is a join by row key, which AQE splits where
    a row has very many versions.
    """
    spark = ranked.sparkSession
    deleted = (
        log.where(_is(TOMBSTONE))
        .groupBy("row_key")
        .agg(F.max("ts").alias("deleted_ts"))
    )
    rows, text = deleted.agg(
        F.count("*"), F.sum(F.octet_length("row_key"))
    ).first()
    if rows == 0:
        return ranked
    if fits_broadcast(spark, rows, text):
        deleted = F.broadcast(deleted)
    joined = ranked.join(deleted, "row_key", "left")
    live = F.col("deleted_ts").isNull() | (F.col("ts") > F.col("deleted_ts"))
    return joined.where(live).select(*ranked.columns)


def get_rows(
    log: DataFrame,
    keys: DataFrame,
    columns: str | Sequence[str],
    family: str = FAMILY,
    on_missing: str = "blank",
    bounds: Bounds | None = None,
) -> DataFrame:
    """Keyed multi-get: one output row per requested key, repeats kept.

    A key with no live row gives a row of "" in every column, the key column
    too (``on_missing="blank"``); ``"keep_key"`` keeps the key's text and
    ``"skip"`` leaves the row out. Null and empty keys are not asked for.

    Repeats are counted before the shuffle and expanded at the end. One small
    job measures the key list; its key range (and regions, given the `bounds` of
    the table) go to the log scan, and only cells of requested keys are
    aggregated: a list that fits is sent to the scan, a larger one is joined by
    key, with Spark's runtime filters and skew handling. Up to `LOOKUPS` keys are
    written into the scan itself, which skips row groups that hold none of them, by
    their statistics and the Bloom filters of stored cells.
    """
    if on_missing not in ("blank", "keep_key", "skip"):
        raise ValueError(f"unknown on_missing: {on_missing!r}")
    names = column_list(columns)
    wanted = (
        keys.where(usable_key(F.col("row_key")))
        .groupBy("row_key")
        .agg(F.count("*").alias("copies"))
    )
    measures = [
        F.count("*").alias("rows"),
        F.sum(F.octet_length("row_key")).alias("text"),
        F.max("copies").alias("most"),
        F.min("row_key").alias("first"),
        F.max("row_key").alias("last"),
    ]
    if bounds is not None:
        measures.append(F.collect_set(region_of("row_key", bounds)).alias("regions"))
    size = wanted.agg(*measures).first()

    if size["rows"]:
        log = log.where(F.col("row_key").between(size["first"], size["last"]))
        if bounds is not None:
            log = log.where(F.col("region").isin(size["regions"]))
    asked = wanted.select("row_key")
    if 0 < size["rows"] <= LOOKUPS:
        log = log.where(_one_of([r["row_key"] for r in asked.collect()]))
    if fits_broadcast(keys.sparkSession, size["rows"], size["text"]):
        asked = F.broadcast(asked)
    log = log.join(asked, "row_key", "left_semi")

    cells = [f"cell_{i}" for i in range(len(names) - 1)]
    found = _rows(log, ["found_key", *names[1:]], family).toDF("found_key", *cells)
    how = "inner" if on_missing == "skip" else "left"
    answers = wanted.join(found, F.col("row_key") == F.col("found_key"), how)
    answers = _repeat(answers, size["most"] or 0)
    key = "row_key" if on_missing == "keep_key" else "found_key"
    return answers.selectExpr(
        *[
            f"coalesce({source}, '') AS {named(name)}"
            for source, name in zip([key, *cells], names)
        ]
    )


def _one_of(keys: list[str]) -> Column:
    """Whether the row key is one of these, in pieces that are small enough for the
    scan to test each key; a long list would only reach it as a range."""
    ordered = sorted(keys)
    return reduce(Column.__or__, [
        F.col("row_key").isin(ordered[i : i + LOOKUP_FILTER])
        for i in range(0, len(ordered), LOOKUP_FILTER)
    ])


def _repeat(answers: DataFrame, most: int) -> DataFrame:
    """Emit each row `copies` times; a much-asked key is spread over tasks."""
    if most <= 1:
        return answers
    if most > COPIES_PER_TASK:
        step = F.lit(COPIES_PER_TASK)
        answers = (
            answers.withColumn(
                "chunk",
                F.explode(F.expr(f"sequence(0L, (copies - 1) div {COPIES_PER_TASK})")),
            )
            .withColumn(
                "copies", F.least(step, F.col("copies") - F.col("chunk") * step)
            )
            .repartition("row_key", "chunk")
        )
    return answers.withColumn("copy", F.explode(F.expr("sequence(1L, copies)")))


def without_rows(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """A delete in one shot: the scanned rows whose key is not in the list."""
    gone = keys.select("row_key").distinct()
    return rows.join(gone, rows[key] == gone["row_key"], "left_anti")
