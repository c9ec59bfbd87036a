"""Shuffles of numpy arrays: what a batch of documents says, packed by bucket.

A row holds all entries of one batch for one bucket: the documents, the number of
entries of each, and the entries' bytes. So an entry costs its own bytes and a
small share of its document's number, and buckets are sorted with numpy. The
number of buckets follows the number of entries, so a bucket fits one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellframe.llm.common import map_arrow

SCHEMA = "bucket int, owners binary, counts binary, entries binary"


def pack(
    bucket: np.ndarray, owner: np.ndarray, numbers: np.ndarray, entries: np.ndarray,
    brief: bool = False,
) -> list[list]:
    """Columns of `SCHEMA`. `owner` indexes `numbers`, one or a row of several for each
    document; `entries` is a byte matrix. `brief`: a number's lowest 32 bits are sent,
    and counts byte by byte, so that their zeros shrink in the shuffle."""
    out: list[list] = [[], [], [], []]
    order = np.argsort(owner.astype(np.uint32), kind="stable")
    # Small integers sort by radix.
    small = bucket.astype(np.uint16) if bucket.max(initial=0) < 1 << 16 else bucket
    order = order[np.argsort(small[order], kind="stable")]
    bucket, owner, entries = bucket[order], owner[order], entries[order]
    start = 0
    for end in (np.flatnonzero(np.diff(bucket)) + 1).tolist() + [len(bucket)]:
        if end > start:
            who, counts = np.unique(owner[start:end], return_counts=True)
            out[0].append(int(bucket[start]))
            counts = counts.astype(np.uint32)
            if brief:
                out[1].append(numbers[who].astype(np.uint32).tobytes())
                out[2].append(counts.view(np.uint8).reshape(-1, 4).T.tobytes())
            else:
                out[1].append(numbers[who].astype(np.int64).tobytes())
                out[2].append(counts.tobytes())
            out[3].append(np.ascontiguousarray(entries[start:end]).tobytes())
        start = end
    return out


def each_bucket(
    packed: DataFrame,
    buckets: int,
    width: int,
    function: Callable[[np.ndarray, np.ndarray], Iterator[list]],
    schema: str,
    brief: bool = False,
) -> DataFrame:
    """One task per bucket: `function(numbers, entries)` gets all of it, a document's
    number or numbers and `width` bytes for each entry, and yields lists of columns.
    `brief`: as packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, entries = [], []
        for batch in batches:
            for who, counts, data in zip(*(c.to_pylist() for c in batch.columns[1:])):
                times = np.frombuffer(counts, np.uint32)
                own = np.frombuffer(who, np.int64) if not brief else (
                    np.frombuffer(who, np.uint32).astype(np.int64)
                )
                if brief:
                    planes = np.frombuffer(counts, np.uint8).reshape(4, -1)
                    times = np.ascontiguousarray(planes.T).view(np.uint32).ravel()
                if len(own) > len(times):
                    own = own.reshape(len(times), -1)
                numbers.append(np.repeat(own, times, axis=0))
                entries.append(np.frombuffer(data, np.uint8).reshape(-1, width))
        if numbers:
            whole = np.concatenate(numbers), np.concatenate(entries)
            numbers.clear()
            entries.clear()
            for columns in function(*whole):
                arrays = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns]
                yield pa.RecordBatch.from_arrays(
                    arrays, names=[f"c{i}" for i in range(len(arrays))]
                )

    return map_arrow(packed.repartitionById(buckets, "bucket"), run, schema)


# Size of a filter of ids: 8 MB, whatever the number of ids.
FILTER_BITS = 1 << 26


def id_filter(ids: DataFrame) -> np.ndarray:
    """A bit set over the hashed `id` column of a table. Its size is fixed; the more
    ids there are, the more others pass it, so it saves work and decides nothing."""
    place = F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS))
    words = ids.select(place.alias("p")).groupBy(F.expr("p div 64").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(p % 64 AS INT))")).alias("bits")
    ).toArrow()
    found = np.zeros(FILTER_BITS // 64, np.int64)
    found[words["word"].to_numpy()] = words["bits"].to_numpy()
    return found


def passes(filter_bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Whether the ids with these places, pmod(xxhash64(id), FILTER_BITS), may be in."""
    return (filter_bits[places >> 6] >> (places & 63)) & 1 == 1


def matching(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """The rows of a table that may have one of the `id`s, told before any shuffle."""
    sent = df.sparkSession.sparkContext.broadcast(id_filter(ids))
    place = F.pmod(F.xxhash64(column), F.lit(FILTER_BITS)).alias("filter_place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mask = passes(sent.value, batch.column(batch.num_columns - 1).to_numpy())
            kept = batch.filter(pa.array(mask))
            yield pa.RecordBatch.from_arrays(kept.columns[:-1], names=kept.schema.names[:-1])

    return map_arrow(df.select(*df.columns, place), run, df.schema)


def low_bytes(values: np.ndarray, count: int) -> np.ndarray:
    """The lowest `count` bytes of 64-bit numbers, one row each."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :count]


def from_low_bytes(entries: np.ndarray) -> np.ndarray:
    """The way back."""
    wide = np.zeros((len(entries), 8), np.uint8)
    wide[:, : entries.shape[1]] = entries
    return wide.view("<u8").ravel()
