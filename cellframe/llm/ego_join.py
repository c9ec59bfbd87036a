"""Embedding near-duplicates: an epsilon grid order join of unit vectors.

Cosine c of unit vectors is their distance sqrt(2 - 2c), so all pairs within that
epsilon are wanted. Vectors are projected on a few leading principal dimensions,
which only shortens distances, laid on a grid of epsilon cells and sorted by
cell: the epsilon grid order. The sequence is cut into blocks with their bounding
boxes. Starting with the whole sequence against itself, pairs of intervals are
replaced by pairs of their parts while their boxes are within epsilon of each
other; what is left at the level of blocks is compared, all components in double
precision. Every link is found, none is guessed: the sample that gives the
principal dimensions (`SAMPLE_VECTORS`) only decides how much is skipped.

Equal vectors are one node with a number of copies. A task compares a run of
blocks with the blocks paired with it and returns link counts and, instead of
links, the smallest node of every linked group it saw; so a dense cloud costs
multiplications, not rows.

Vectors that are null, empty or zero, or hold null or non-finite components, link
with nothing, and so do rows without a vec_id; their component is their own
vec_id. Vectors of different lengths never link. Rows that repeat a vec_id and
its vector are vectors of their own. An empty table gives none.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellframe.llm.common import Scratch, map_arrow, map_columns
from cellframe.llm.components import connected_components

COSINE = 0.95
SAMPLE_VECTORS = 5_000
DIMENSIONS = 8
# Vectors of a block; blocks of a run that one task holds against others; blocks
# that a run meets in one task.
BLOCK, RUN, CHUNK = 256, 16, 128
# Parts of an interval at the next level.
FANOUT = 32
# What rounding may add to a squared distance.
SLACK = 1e-9


def _unit(values: list | None) -> np.ndarray | None:
    """The vector at unit length in double precision; None if it has no direction."""
    if not values or None in values:
        return None
    vector = np.array(values, np.float64) + 0.0
    most = np.abs(vector).max()
    if not (math.isfinite(most) and most > 0):
        return None
    vector /= most
    return vector / math.sqrt(float(vector @ vector))


def unit_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, key, unit); key and unit are null for what links with nothing."""

    def run(ids: list, vectors: list) -> list[list]:
        keys, units = [], []
        for vec_id, values in zip(ids, vectors):
            unit = None if vec_id is None else _unit(values)
            raw = None if unit is None else (np.array(values, np.float64) + 0.0).tobytes()
            keys.append(None if unit is None else hashlib.blake2b(raw, digest_size=16).digest())
            units.append(None if unit is None else unit.tobytes())
        return [ids, keys, units]

    return map_columns(
        embeddings.select(F.col("vec_id").cast("long"), "embedding"),
        "vec_id long, key binary, unit binary",
        run,
    )


def principal_dimensions(nodes: DataFrame) -> np.ndarray:
    """Leading principal directions of a sample: the first by their keys, which
    are hashes; vectors of other lengths than the longest count as padded."""
    sample = nodes.orderBy("key").limit(SAMPLE_VECTORS).select("unit").toArrow()
    units = [np.frombuffer(u) for u in sample["unit"].to_pylist()]
    if not units:
        return np.zeros((1, 1))
    length = max(map(len, units))
    matrix = np.zeros((len(units), length))
    for row, unit in zip(matrix, units):
        row[: len(unit)] = unit
    matrix -= matrix.mean(axis=0)
    _, vectors = np.linalg.eigh(matrix.T @ matrix)
    return vectors[:, ::-1][:, :DIMENSIONS].copy()


def grid_blocks(nodes: DataFrame, directions: np.ndarray, epsilon: float) -> DataFrame:
    """Nodes in epsilon grid order, cut into blocks of one vector length each:
    (part, seq, size, reps, copies, units, low, high)."""
    p = directions.shape[1]

    def place(reps: list, copies: list, units: list) -> list[list]:
        lengths, spots, cells = [], [], []
        for raw in units:
            unit = np.frombuffer(raw)
            n = min(len(unit), len(directions))
            spot = unit[:n] @ directions[:n]
            lengths.append(len(unit))
            spots.append(spot.tolist())
            cells.append(np.floor(spot / epsilon).astype(np.int32).tolist())
        return [reps, copies, units, lengths, spots, cells]

    placed = map_columns(
        nodes.select("rep", "copies", "unit"),
        "rep long, copies long, unit binary, length int, spot array<double>, cell array<int>",
        place,
    )
    order = ["length", *[F.col("cell")[i] for i in range(p)], "rep"]
    schema = (
        "part int, seq int, length int, reps binary, copies binary, units binary, "
        "low array<double>, high array<double>"
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0

        def block(rows: list) -> pa.RecordBatch:
            nonlocal seq
            spots = np.array([r[4] for r in rows])
            columns = [
                [part], [seq], [rows[0][3]],
                [np.array([r[0] for r in rows], np.int64).tobytes()],
                [np.array([r[1] for r in rows], np.int64).tobytes()],
                [b"".join(r[2] for r in rows)],
                [spots.min(axis=0).tolist()], [spots.max(axis=0).tolist()],
            ]
            seq += 1
            types = [pa.int32()] * 3 + [pa.binary()] * 3 + [pa.list_(pa.float64())] * 2
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                names=[f.split(" ")[0] for f in schema.split(", ")],
            )

        rows: list = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if rows and (len(rows) == BLOCK or rows[0][3] != row[3]):
                    yield block(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield block(rows)

    ordered = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    return map_arrow(ordered, cut, schema)


def _numbered(blocks: DataFrame) -> DataFrame:
    """Blocks numbered along the sequence; the window sees one row per task."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.groupBy("part").agg(F.count("*").alias("n")).select(
        F.col("part").alias("of_part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("at")
    )
    return blocks.join(offsets, F.col("part") == F.col("of_part")).withColumn(
        "block", F.col("at") + F.col("seq")
    )


def _near(left: str, right: str, p: int, epsilon: float) -> str:
    """SQL: boxes of two intervals come within epsilon of each other."""
    gaps = [
        f"pow(greatest(0D, {left}_low[{i}] - {right}_high[{i}], "
        f"{right}_low[{i}] - {left}_high[{i}]), 2)"
        for i in range(p)
    ]
    return f"{' + '.join(gaps)} <= {epsilon**2 + SLACK!r}"


def near_blocks(boxes: DataFrame, blocks: int, p: int, epsilon: float) -> DataFrame:
    """(l, r), l <= r: pairs of blocks whose boxes are near, by recursion from the
    whole sequence. `boxes`: block, length, low, high."""
    levels = 0
    while FANOUT**levels < blocks:
        levels += 1
    spark = boxes.sparkSession
    pairs = spark.range(1).select(F.lit(0).cast("long").alias("l"), F.lit(0).cast("long").alias("r"))
    for level in range(levels - 1, -1, -1):
        width = FANOUT**level
        nodes = boxes.groupBy(F.expr(f"block div {width}").alias("node")).agg(
            F.array(*[F.min(F.col("low")[i]) for i in range(p)]).alias("low"),
            F.array(*[F.max(F.col("high")[i]) for i in range(p)]).alias("high"),
            F.min("length").alias("shortest"), F.max("length").alias("longest"),
        ).withColumn("above", F.expr(f"node div {FANOUT}"))
        left = nodes.select(*[F.col(c).alias(f"l_{c}") for c in nodes.columns])
        right = nodes.select(*[F.col(c).alias(f"r_{c}") for c in nodes.columns])
        pairs = (
            pairs.join(left, F.col("l") == F.col("l_above"))
            .join(right, F.col("r") == F.col("r_above"))
            .where("l_node <= r_node")
            .where("l_shortest <= r_longest AND r_shortest <= l_longest")
            .where(_near("l", "r", p, epsilon))
            .select(F.col("l_node").alias("l"), F.col("r_node").alias("r"))
        )
    return pairs


def _groups(linked: np.ndarray) -> np.ndarray:
    """Labels of a square or bipartite link matrix's nodes: rows first, then
    columns; linked ones share the smallest index among them."""
    n, m = linked.shape
    rows, columns = np.arange(n), np.arange(n, n + m)
    while True:
        far = n + m
        columns_new = np.minimum(columns, np.where(linked, rows[:, None], far).min(axis=0))
        rows_new = np.minimum(rows, np.where(linked, columns_new[None, :], far).min(axis=1))
        if (rows_new == rows).all() and (columns_new == columns).all():
            return np.concatenate([rows, columns])
        rows, columns = rows_new, columns_new


class _Run:
    """A run of blocks and what it found so far."""

    def __init__(self, threshold: float):
        self.threshold = threshold
        self.blocks: list[tuple] = []
        self.links: dict[int, int] = {}
        self.edges: set[tuple[int, int]] = set()

    def meet(self, right: tuple) -> None:
        number, length, reps, copies, units, low, high = right
        limit = 2 - 2 * self.threshold + SLACK
        for own in self.blocks:
            if own[0] > number or own[1] != length:
                continue
            gap = np.maximum(0, np.maximum(own[5] - high, low - own[6]))
            if gap @ gap > limit:
                continue
            linked = own[4] @ units.T >= self.threshold
            if own[0] == number:
                linked = np.triu(linked, 1)
            if linked.any():
                self._count(own[2], linked @ copies)
                self._count(reps, own[3] @ linked)
                names = np.concatenate([own[2], reps])
                labels = _groups(linked)
                moved = np.flatnonzero(labels != np.arange(len(labels)))
                self.edges.update(zip(names[moved].tolist(), names[labels[moved]].tolist()))

    def _count(self, reps: np.ndarray, found: np.ndarray) -> None:
        for i in np.flatnonzero(found).tolist():
            rep = int(reps[i])
            self.links[rep] = self.links.get(rep, 0) + int(found[i])

    def rows(self) -> pa.RecordBatch:
        counts, edges = list(self.links.items()), list(self.edges)
        return pa.RecordBatch.from_arrays([
            pa.array([r for r, _ in counts] + [a for a, _ in edges], pa.int64()),
            pa.array([n for _, n in counts] + [0] * len(edges), pa.int64()),
            pa.array([None] * len(counts) + [b for _, b in edges], pa.int64()),
        ], names=["rep", "links", "other"])


def _compare(blocks: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """(rep, links, other): links counted by node, and links between groups."""
    meetings = pairs.selectExpr(
        f"l div {RUN} AS run", f"r div {CHUNK} AS chunk", "r"
    ).distinct()
    content = ["block", "length", "reps", "copies", "units", "low", "high"]
    own = meetings.select("run", "chunk").distinct().join(
        blocks.withColumn("own_run", F.expr(f"block div {RUN}")), F.col("run") == F.col("own_run")
    ).select("run", "chunk", F.lit(0).alias("side"), *content)
    met = meetings.join(blocks, F.col("r") == F.col("block")).select(
        "run", "chunk", F.lit(1).alias("side"), *content
    )
    dealt = own.unionByName(met).repartition("run", "chunk").sortWithinPartitions(
        "run", "chunk", "side", "block"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, now = None, _Run(threshold)
        for batch in batches:
            for run_no, chunk, side, number, length, reps, copies, units, low, high in zip(
                *(c.to_pylist() for c in batch.columns)
            ):
                if (run_no, chunk) != at:
                    yield now.rows()
                    at, now = (run_no, chunk), _Run(threshold)
                block = (
                    number, length, np.frombuffer(reps, np.int64),
                    np.frombuffer(copies, np.int64),
                    np.frombuffer(units).reshape(-1, length), np.array(low), np.array(high),
                )
                if side == 0:
                    now.blocks.append(block)
                else:
                    now.meet(block)
        yield now.rows()

    return map_arrow(dealt, run, "rep long, links long, other long")


def near_duplicates(embeddings: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector."""
    spark = embeddings.sparkSession
    scratch = Scratch(spark, "ego")
    epsilon = math.sqrt(2 - 2 * cosine)
    vectors = unit_vectors(embeddings)
    nodes = scratch.write(
        vectors.where("key IS NOT NULL").groupBy("key").agg(
            F.min("vec_id").alias("rep"), F.count("*").alias("copies"),
            F.max("unit").alias("unit"),
        ),
        "nodes",
    )
    directions = principal_dimensions(nodes)
    blocks = _numbered(scratch.write(grid_blocks(nodes, directions, epsilon), "blocks"))
    boxes = blocks.select("block", "length", "low", "high")
    count = boxes.count()
    pairs = near_blocks(boxes, count, directions.shape[1], epsilon)
    found = scratch.write(_compare(blocks, pairs, cosine), "found")
    links = found.where("other IS NULL").groupBy("rep").agg(F.sum("links").alias("links"))
    components = connected_components(found.where("other IS NOT NULL").select("rep", "other"))
    known = (
        nodes.select("key", "rep", "copies")
        .join(links.withColumnRenamed("rep", "link_rep"), F.col("rep") == F.col("link_rep"), "left")
        .join(components, F.col("rep") == F.col("node"), "left")
        .select(
            F.col("key").alias("node_key"),
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    return vectors.select("vec_id", "key").join(
        known, F.col("key") == F.col("node_key"), "left"
    ).select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("component_id") == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
