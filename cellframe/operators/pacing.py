"""Batched, paced traffic with a store outside Spark: rows sent, rows fetched by key."""

from __future__ import annotations

import sys
import time
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from cellframe.model import MAX_RATE, PAUSE_SECONDS, column_list
from cellframe.operators.cells import usable_key

# Workers get the functions of this module along with a task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BATCHES = "task int, batch long, records long, paused boolean"


def sending_tasks(rate: int, workers: int, max_rate: int = MAX_RATE) -> int:
    """Tasks that may send at once: never more than rows a second."""
    if rate < 1:
        raise ValueError("at least one row a second must be allowed")
    if rate > max_rate:
        raise ValueError(f"rate {rate}/s is above the limit of {max_rate}/s")
    return max(1, min(workers, rate))


def batch_size(rate: int, tasks: int) -> int:
    """Requests per batch of one task: a second's share of the rate."""
    return max(1, rate // max(1, tasks))


def batch_seconds(rate: int, tasks: int, size: int) -> float:
    """How long a task's batch must last for all tasks to keep the rate."""
    return size * tasks / rate


def paced(
    rows: Iterable[Any],
    call: Callable[[list], Any],
    size: int,
    pause: float = PAUSE_SECONDS,
    sleep: Callable[[float], None] = time.sleep,
    seconds: float = 0.0,
    clock: Callable[[], float] = time.monotonic,
) -> Iterator[tuple[list, Any, bool]]:
    """(batch, answer, paused) for each batch of rows in arrival order, as it is made.

    `size` rows are a batch, the last one may be short. After a full batch comes a
    pause of `pause` seconds, and longer where the batch, the call included, would
    otherwise take less than `seconds`. What is yielded is handed on before the pause.
    """
    batch: list[Any] = []
    since = clock()
    for row in rows:
        batch.append(row)
        if len(batch) == size:
            yield batch, call(batch), True
            batch = []
            sleep(max(pause, since + seconds - clock()))
            since = clock()
    if batch:
        yield batch, call(batch), False


def send_in_batches(
    rows: Iterable[Any],
    connect: Callable[[], Any],
    size: int,
    pause: float = PAUSE_SECONDS,
    sleep: Callable[[float], None] = time.sleep,
    seconds: float = 0.0,
    clock: Callable[[], float] = time.monotonic,
) -> tuple[int, int, int]:
    """Send rows in arrival order, `size` at a time, pausing after full batches.

    Pauses as in `paced`. `connect()` returns an object with ``send(rows)`` and
    ``close()``; it is closed whatever happens. Returns (records, batches, pauses).
    """
    records = batches = pauses = 0
    sink = connect()
    try:
        for batch, _, waited in paced(rows, sink.send, size, pause, sleep, seconds, clock):
            records, batches, pauses = records + len(batch), batches + 1, pauses + waited
    finally:
        sink.close()
    return records, batches, pauses


def _rows_of(chunks: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for chunk in chunks:
        yield from chunk.to_pylist()


def _tasks_at_once() -> int:
    """How many tasks of this stage run together; all of a barrier stage do."""
    from pyspark import BarrierTaskContext, TaskContext

    context = TaskContext.get()
    return len(context.getTaskInfos()) if isinstance(context, BarrierTaskContext) else 0


def _sent(
    connect: Callable[[], Any], size: int | None, rate: int, tasks: int, pause: float
) -> Callable:
    """Function for `mapInArrow`: sends a task's rows, yields a row for every batch as
    it was sent. Without a `size` the tasks that really run share the rate."""

    def run(chunks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        sharing = _tasks_at_once() or tasks
        each = size or batch_size(rate, sharing)
        seconds = 0.0 if size else batch_seconds(rate, sharing, each)
        task = TaskContext.get().partitionId()
        sink = connect()
        try:
            calls = paced(_rows_of(chunks), sink.send, each, pause, seconds=seconds)
            for number, (batch, _, waited) in enumerate(calls):
                yield pa.RecordBatch.from_pydict({
                    "task": pa.array([task], pa.int32()), "batch": pa.array([number]),
                    "records": pa.array([len(batch)]), "paused": pa.array([waited]),
                })
        finally:
            sink.close()

    return run


def send_partitions(
    rows: DataFrame, connect: Callable[[], Any], size: int, pause: float = 0.0
) -> DataFrame:
    """Send every partition as it is, `size` rows at a time, and return a row for each
    batch that was sent: (task, batch, records, paused). Nothing is sent before the
    result is read, and all of it again if it is read twice."""
    if size < 1:
        raise ValueError("a batch holds at least one row")
    return rows.mapInArrow(_sent(connect, size, 0, 0, pause), BATCHES)


def _shared(rows: DataFrame, rate: int, workers: int | None, max_rate: int) -> tuple[DataFrame, int]:
    """Rows dealt evenly to as many tasks as may work at once, and their number."""
    parallelism = rows.sparkSession.sparkContext.defaultParallelism
    tasks = sending_tasks(rate, min(workers or parallelism, parallelism), max_rate)
    return rows.repartition(tasks), tasks


def deliver(
    rows: DataFrame,
    connect: Callable[[], Any],
    rate: int = MAX_RATE,
    workers: int | None = None,
    pause: float = 0.0,
    max_rate: int = MAX_RATE,
) -> Row:
    """Send a DataFrame to an outside store, at `rate` rows a second.

    Rows are dealt evenly to as many tasks as may send at once, `workers` or the
    default parallelism and never more than `rate`, whatever partitions they come in. They run as
    one barrier stage, so each knows how many really send and takes its share:
    together they reach the rate and don't exceed it. (With dynamic allocation, which
    has no barrier stages, the share is by the number of tasks: fewer at once send
    less.) A task sends its share of a second, then waits for the rest of the second.
    Each streams through one connection; rows arrive as dicts. A task that is run again
    sends its rows again, so `send` must be idempotent, as puts and deletes are.
    Returns the totals of records, batches, pauses, counted where they were sent.
    """
    spread, tasks = _shared(rows, rate, workers, max_rate)
    elastic = rows.sparkSession.conf.get("spark.dynamicAllocation.enabled", "false") == "true"
    run = _sent(connect, None, rate, tasks, pause)
    sent = spread.mapInArrow(run, BATCHES, barrier=not elastic)
    return sent.agg(
        F.coalesce(F.sum("records"), F.lit(0)).alias("records"),
        F.count("*").alias("batches"),
        F.coalesce(F.sum(F.col("paused").cast("long")), F.lit(0)).alias("pauses"),
    ).first()


def fetch(
    keys: DataFrame,
    connect: Callable[[], Any],
    columns: str | Sequence[str],
    rate: int = MAX_RATE,
    workers: int | None = None,
    pause: float = 0.0,
    max_rate: int = MAX_RATE,
    on_missing: str = "blank",
) -> DataFrame:
    """Keyed multi-get from an outside store: one row per requested key, repeats kept.

    `connect()` returns an object with ``get(keys)`` and ``close()``; `get` takes a list
    of keys and returns a mapping of those it has to mappings of column to text. The
    first of `columns` names the key. Keys go out in batches, and a batch's answers
    are handed on when they arrive, so a task holds one batch, however many keys it has.
    A key that a batch repeats is asked for once. `on_missing` is as in
    `scan.get_rows`, and blank keys are not asked for.

    The tasks are dealt and paced as in `deliver`, by the number of tasks: the result
    can go on in any plan, which a barrier stage could not. A task that is run again
    asks again. The connection is closed at the end, also when a get fails.
    """
    if on_missing not in ("blank", "keep_key", "skip"):
        raise ValueError(f"unknown on_missing: {on_missing!r}")
    names = column_list(columns)
    wanted = keys.where(usable_key(F.col("row_key"))).select("row_key")
    spread, tasks = _shared(wanted, rate, workers, max_rate)
    size = batch_size(rate, tasks)
    seconds = batch_seconds(rate, tasks, size)

    def answers(batch: list[str], found: dict) -> list[list[str]]:
        out = []
        for key in batch:
            row = found.get(key)
            if row is not None:
                out.append([key, *(row.get(name) or "" for name in names[1:])])
            elif on_missing != "skip":
                kept = key if on_missing == "keep_key" else ""
                out.append([kept, *[""] * (len(names) - 1)])
        return out

    def run(chunks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = (key for chunk in chunks for key in chunk.column(0).to_pylist())
        client = connect()
        try:
            calls = paced(
                asked, lambda batch: client.get(list(dict.fromkeys(batch))), size, pause,
                seconds=seconds,
            )
            for batch, found, _ in calls:
                columns = list(zip(*answers(batch, found))) or [()] * len(names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.string()) for c in columns],
                    names=[f"c{i}" for i in range(len(names))],
                )
        finally:
            client.close()

    fetched = spread.mapInArrow(run, ", ".join(f"c{i} string" for i in range(len(names))))
    return fetched.select(*[F.col(f"c{i}").alias(name) for i, name in enumerate(names)])
