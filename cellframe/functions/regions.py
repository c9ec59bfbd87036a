"""Row key -> region, as a column expression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellframe.functions.text import named, quoted
from cellframe.model import REGION_BOUNDS

Bounds = Sequence[int] | Sequence[str]

# Bounds that a tree of comparisons holds; entries of a search step beyond that.
TREE, STEP = 64, 64


def region_count(bounds: Bounds, overflow: str = "strict") -> int:
    """Number of regions that `region_of` can return."""
    text = isinstance(bounds[0], str)
    return len(bounds) + (1 if text or overflow == "reference" else 2)


def region_of(
    key: str, bounds: Bounds = REGION_BOUNDS, overflow: str = "strict"
) -> Column:
    """Region number of the row key in column `key`.

    Region i holds ``bounds[i-1] <= key < bounds[i]``. Integer bounds compare
    keys as numbers; text bounds compare them as text, which is also the sort
    order inside a region.

    ``overflow="strict"``: keys at or above the last bound go to the last
    numeric region and keys with a non-digit to one region more; every key
    that is not null or empty has a region.

    ``overflow="reference"``: keys at or above the last bound go to region 0
    and keys with a non-digit to the last region; a key that does not fit an
    int (or is empty) gets null, for the caller to report.

    One SQL text. Up to `TREE` bounds it is a tree of comparisons; more are one
    constant array, searched in two levels, so that a table with thousands of
    regions plans and compiles at once.
    """
    if overflow not in ("strict", "reference"):
        raise ValueError(f"unknown overflow mode: {overflow!r}")
    if not bounds or list(bounds) != sorted(set(bounds)):
        raise ValueError("bounds must be given, ascending and distinct")
    last, name = len(bounds), named(key)
    if isinstance(bounds[0], str):
        points = [quoted(b) for b in bounds]
        return F.expr(f"CASE WHEN {name} <> '' THEN {_passed(name, points, 0)} END")

    points = [str(b) for b in bounds]
    non_numeric = f"{name} RLIKE '[^0-9]'"
    if overflow == "reference":
        number = f"try_cast({name} AS INT)"
        return F.expr(
            f"""CASE WHEN {non_numeric} THEN {last}
                WHEN {number} >= {points[-1]} THEN 0
                WHEN {number} IS NOT NULL THEN {_passed(number, points, 0)} END"""
        )
    number = f"try_cast({name} AS BIGINT)"
    return F.expr(
        f"""CASE WHEN {name} IS NULL OR {name} = '' THEN NULL
            WHEN {non_numeric} THEN {last + 1}
            WHEN {number} IS NULL THEN {last}
            ELSE {_passed(number, points, 0)} END"""
    )


def _passed(value: str, points: list[str], below: int) -> str:
    """How many points are <= value: a balanced tree, log2(n) tests per row."""
    if len(points) > TREE:
        return _searched(value, points)
    if not points:
        return str(below)
    mid = len(points) // 2
    left = _passed(value, points[:mid], below)
    right = _passed(value, points[mid + 1:], below + mid + 1)
    return f"IF({value} < {points[mid]}, {left}, {right})"


def _searched(value: str, points: list[str]) -> str:
    """The same for many points: find the step, then look inside it."""
    text = points[0].startswith("'")
    plain = [p[1:-1] if text else p for p in points]
    element = "STRING" if text else "BIGINT"

    def constant(some: list[str]) -> str:
        # One folded literal; the separator is in no key.
        listed = "\x01".join(some)
        return f"CAST(split('{listed}', '\x01') AS ARRAY<{element}>)"

    steps = f"size(filter({constant(plain[::STEP])}, b -> b <= {value}))"
    inside = (
        f"size(filter(slice({constant(plain)}, {STEP} * ({steps} - 1) + 1, {STEP}), "
        f"b -> b <= {value}))"
    )
    return f"IF({value} < {points[0]}, 0, {STEP} * ({steps} - 1) + {inside})"


def text_bounds_from(
    df: DataFrame, key: str, regions: int, sample: int = 20_000
) -> list[str]:
    """Split points of text keys, in text order, from the keys of `sample` rows.

    The rows are those with the smallest hashes of their keys: one pass, and at
    most `sample` keys on the driver.
    """
    keys = df.select(F.col(named(key)).cast("string").alias("k")).where("k <> ''")
    chosen = sorted(
        r["k"] for r in keys.orderBy(F.xxhash64("k"), "k").limit(sample).collect()
    )
    if not chosen or regions < 2:
        raise ValueError("no keys to take bounds from, or fewer than two regions")
    return sorted({chosen[len(chosen) * i // regions] for i in range(1, regions)})


def bounds_from(
    df: DataFrame, key: str, regions: int, error: float | None = None
) -> list[int]:
    """Split points that cut the numeric keys into about equal regions.

    One pass over the key column; quantile sketches merge per task. The rank
    error is a tenth of a region unless given, 0.001 at most. Keys with a
    non-digit have their own region and do not count here.
    """
    if error is None:
        error = min(0.001, 0.1 / regions)
    if regions < 2:
        raise ValueError("at least two regions are needed for a bound")
    numbers = df.select(
        F.when(~F.col(key).rlike("[^0-9]"), F.col(key).try_cast("bigint"))
        .cast("double").alias("n")
    ).where("n IS NOT NULL")
    steps = [i / regions for i in range(1, regions)]
    points = numbers.approxQuantile("n", steps, error)
    if not points:
        raise ValueError("no numeric keys to take bounds from")
    return sorted({int(p) for p in points})
