"""Result files of a scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellframe.model import column_list


def as_result(rows: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """The requested columns in the caller's order, all strings, each once."""
    names = dict.fromkeys(column_list(columns))
    # By place: a name that was asked for twice stands there twice.
    place = {name: i for i, name in reversed(list(enumerate(rows.columns)))}
    numbered = rows.toDF(*[f"c{i}" for i in range(len(rows.columns))])
    return numbered.select(
        *[F.col(f"c{place[name]}").cast("string").alias(name) for name in names]
    )


def save_result(rows: DataFrame, columns: str | Sequence[str], path: str) -> None:
    """Write a scan result as parquet, replacing what is there."""
    as_result(rows, columns).write.mode("overwrite").parquet(path)
