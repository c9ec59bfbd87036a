"""Wide rows -> cells, and tombstones for row keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellframe.functions.text import named, quoted
from cellframe.model import CELL_SCHEMA, FAMILY, PUT, TOMBSTONE, column_list


def usable_key(key: Column) -> Column:
    """A row key must be present and not empty."""
    return F.coalesce(key != "", F.lit(False))


def split_rejects(rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows that can be stored, rows whose key is null or empty)."""
    usable = usable_key(F.col(named(key)).cast("string"))
    return rows.where(usable), rows.where(~usable)


def row_to_cells(
    rows: DataFrame, key: str, fields: str | Sequence[str]
) -> DataFrame:
    """(row_key, qualifier, value) for each named field that is not null.

    The key may be one of the fields. Narrow: each row expands in place.
    """
    names = column_list(fields)
    pairs = ", ".join(
        f"{quoted(name)}, CAST({named(name)} AS STRING)" for name in names
    )
    return rows.selectExpr(
        f"CAST({named(key)} AS STRING) AS row_key",
        f"stack({len(names)}, {pairs}) AS (qualifier, value)",
    ).where("value IS NOT NULL")


def record_to_cells(records: DataFrame, key: str) -> DataFrame:
    """Every field of a record becomes a cell, the key field too."""
    return row_to_cells(records, key, records.columns)


def stamp(
    cells: DataFrame, ts: int, seq: int, region: Column, family: str = FAMILY
) -> DataFrame:
    """Cells as put rows of the log."""
    return cells.select(
        "row_key",
        F.lit(family).alias("family"),
        "qualifier",
        "value",
        F.lit(ts).cast("long").alias("ts"),
        F.lit(seq).cast("long").alias("seq"),
        F.lit(PUT).alias("kind"),
        region.alias("region"),
    ).to(CELL_SCHEMA)


def tombstones(keys: DataFrame, ts: int, seq: int, region: Column) -> DataFrame:
    """One row tombstone per distinct key, masking every cell up to `ts`."""
    nothing = F.lit(None).cast("string")
    return keys.select("row_key").distinct().select(
        "row_key",
        nothing.alias("family"),
        nothing.alias("qualifier"),
        nothing.alias("value"),
        F.lit(ts).cast("long").alias("ts"),
        F.lit(seq).cast("long").alias("seq"),
        F.lit(TOMBSTONE).alias("kind"),
        region.alias("region"),
    ).to(CELL_SCHEMA)
