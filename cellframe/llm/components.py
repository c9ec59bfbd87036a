"""Connected components of a link table, by alternating stars.

Every task first replaces the links it reads by a spanning forest of them. Then
large and small star steps alternate until nothing moves: each node hands its
neighbours the smallest node it knows, so the links of a component shrink to a
star around its smallest node. The large step is an aggregation with map-side
combine and an equi-join; unless the smallest neighbours are few enough to be sent
round, the links of one node meet in one task there. The small step is one
aggregation: a node has few distinct smaller neighbours, at first one for each
task, as the forests are stars around their smallest nodes. A link that it makes
several times is one again in the next round's. Links and labels never leave the
executors. Each round is written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellframe.llm.common import Scratch, map_arrow


class Forest:
    """Union-find over the links one task has seen."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, node: int) -> int:
        parent = self.parent
        root = node
        while (above := parent.get(root, root)) != root:
            root = above
        while node != root:
            parent[node], node = root, parent[node]
        return root

    def join(self, a: int, b: int) -> bool:
        """Whether the two were apart until now."""
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        low, high = min(a, b), max(a, b)
        self.parent[high] = low
        return True

    def edges(self) -> list[tuple[int, int]]:
        return [(n, self.find(n)) for n in list(self.parent) if self.find(n) != n]


def _forest(links: DataFrame) -> DataFrame:
    """(u, v), u > v: a spanning forest of the links of each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        for batch in batches:
            for a, b in zip(*(c.to_pylist() for c in batch.columns)):
                forest.join(a, b)
        edges = forest.edges()
        yield pa.RecordBatch.from_arrays(
            [pa.array([e[i] for e in edges], pa.int64()) for i in (0, 1)],
            names=["u", "v"],
        )

    return map_arrow(links, run, "u long, v long")


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of every node that is not the smallest of its component.

    `links` has two long columns; order, repeats and loops do not matter.
    """
    scratch = Scratch(links.sparkSession, "components")
    a, b = (F.col(f"`{c}`").cast("long") for c in links.columns[:2])
    edges = scratch.write(
        _forest(links.select(a.alias("a"), b.alias("b")).where("a <> b")).distinct(),
        "links",
    )
    before = None
    while True:
        both = edges.union(edges.select("v", "u").toDF("u", "v"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("n"), F.least("u", "m").alias("m")
        )
        large = both.where("v > u").join(least, F.col("u") == F.col("n")).select(
            F.col("v").alias("u"), F.col("m").alias("v")
        )
        # The node itself goes to its smallest neighbour, and so do the others of them.
        small = large.groupBy("u").agg(F.collect_set("v").alias("all")).selectExpr(
            "u", "all", "array_min(all) AS m"
        ).selectExpr("inline(transform(all, x -> struct(if(x = m, u, x) AS u, m AS v)))")
        after = scratch.write(small, "round")
        scratch.drop(edges)
        state = after.agg(
            F.count("*").alias("rows"),
            F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("sum"),
        ).first()
        edges = after
        if state == before or state["rows"] == 0:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = state
