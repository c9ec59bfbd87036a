"""The trie of conversation prefixes, by a skeleton of splitter paths.

A conversation is a path: 16 bytes for each of its turns, a digest of role and
text. Sorted by path, conversations that share their first turns lie side by
side, so one pass over a sorted run with a stack finishes every node whose
members are all in the run. Sample paths cut the sorted line into shards, one
task each. A node with members in two shards is a prefix of the splitter between
them; so all such nodes are in the trie of the splitters, the skeleton, which
every task has. A shard gives its part of each skeleton node; a grouping by node
adds the parts up, and one pass over the skeleton, whose size is bounded, adds
what subtrees hand to their tops.

Hot groups: turns become digests before the first shuffle. Equal conversations of
one range of ids are one row before the second, with their ids as text, so a
conversation that is there a million times is as many rows as there are ranges.
SHA-256 reads the ids of one node in order, so the task that has the node streams
their text; it holds one row at a time. A splitter is cut behind the first turn
that tells it from the one before it.

A conversation is one row of 20 bytes for each of its turns. A task holds one open
path and the finished children of the nodes on it; these are at most the nodes of
its shard, about `SHARD_TURNS` turns.

Turns are ordered by `turn`, null first, equal ones by role and SHA-256 of the
text; null roles and texts are empty. Repeated rows are turns of their own. Rows
without a conv_id belong to no conversation. An empty table has no nodes, not
even a root.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellframe.llm.common import Scratch, map_arrow, word_count

# Bytes of a turn in a path and of its words; the base of a conversation is the
# first of BLOCK ids, of which it takes less than HEADS turns.
TOKEN, COUNT, BLOCK, HEADS = 16, 4, 20, 4

# Turns in a shard; paths in the sample that cuts shards, and bytes of splitters.
SHARD_TURNS = 500_000
SAMPLE_PATHS = 20_000
SKELETON_BYTES = 16 << 20

# Ids of equal conversations in one row.
IDS = 4096

PATHS = "path binary, words binary, n long, low long, ids string"
NODES = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string, node int, above int, "
    "words long, ended boolean"
)
EMPTY = hashlib.sha256().hexdigest()


def _turns(conversations: DataFrame) -> DataFrame:
    """(block, conv_id, turn, role, digest, token, words), without the texts."""
    text, role = (F.coalesce(F.col(c), F.lit("")) for c in ("text", "role"))
    read = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), role.alias("role"),
        text.alias("text"),
    )
    token = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    return read.select(
        (F.col("conv_id") - F.col("conv_id") % BLOCK).alias("block"),
        "conv_id", "turn", "role", F.sha2("text", 256).alias("digest"),
        F.substring(F.unhex(token), 1, TOKEN).alias("token"),
        word_count("text").alias("words"),
        F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(HEADS)).cast("int").alias("head"),
    )


def _assemble(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns -> one path per conversation; a block's base comes first."""
    def turns():
        for batch in rows:
            yield from zip(*(c.to_pylist() for c in batch.columns))

    out: list[tuple] = []
    size = 0
    block, base = None, ([], [])
    for (at, conv, head), group in groupby(turns(), lambda r: r[:3]):
        tokens, words = [], []
        for _, _, _, token, n in group:
            tokens.append(token)
            words.append(n)
        if at != block:
            block, base = at, ([], [])
        if conv == at:
            base = tokens[:HEADS], words[:HEADS]
        path = b"".join(base[0][:head] + tokens[head:])
        counts = np.array(base[1][:head] + words[head:], "<u4").tobytes()
        out.append((conv, path, counts))
        size += len(path) + 64
        if size > 4 << 20:
            yield _batch(out, ["conv_id", "path", "words"])
            out, size = [], 0
    yield _batch(out, ["conv_id", "path", "words"])


TYPES = {
    "conv_id": pa.int64(), "path": pa.binary(), "words": pa.binary(), "n": pa.int64(),
    "low": pa.int64(), "ids": pa.string(),
}


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, TYPES[n]) for c, n in zip(columns, names)], names=names
    )


def _fold(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal paths, which lie side by side, become one row of up to IDS ids."""
    names = ["path", "words", "n", "low", "ids"]
    path, words, ids = None, None, []

    def row() -> tuple:
        return path, words, len(ids), ids[0], ",".join(map(str, ids))

    for batch in rows:
        out = []
        for conv, p, w in zip(*(c.to_pylist() for c in batch.columns)):
            if ids and (p != path or len(ids) == IDS):
                out.append(row())
                ids = []
            path, words = p, w
            ids.append(conv)
        yield _batch(out, names)
    yield _batch([row()] if ids else [], names)


def _shared(a: bytes, b: bytes) -> int:
    """Turns that two paths have in common from the start."""
    size = min(len(a), len(b)) // TOKEN
    if a[: size * TOKEN] == b[: size * TOKEN]:
        return size
    differ = np.frombuffer(a, "V16", size) != np.frombuffer(b, "V16", size)
    return int(differ.argmax())


def _cut(shards: int, total: int, limit: int):
    """Sorted sample paths of `total` turns -> splitters, about as many turns between
    any two neighbours."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, seen, kept, chosen = b"", 0, 0, []
        for batch in rows:
            for path in batch.column(0).to_pylist():
                seen += len(path) // TOKEN + 1
                if seen * shards >= total * (len(chosen) + 1) and path != before:
                    told = path[: (_shared(before, path) + 1) * TOKEN]
                    if kept + len(told) <= limit and (not chosen or told > chosen[-1]):
                        chosen.append(told)
                        kept += len(told)
                before = path
        yield pa.RecordBatch.from_arrays([pa.array(chosen, pa.binary())], names=["splitter"])

    return run


def splitters(paths: DataFrame, shards: int) -> list[bytes]:
    """Ascending splitters of the line of sorted paths: at most SAMPLE_PATHS of them,
    SKELETON_BYTES in all. The sample is the same whenever it is taken."""
    chosen = paths.select("path").orderBy(F.xxhash64("path", F.lit(7)), "path").limit(SAMPLE_PATHS)
    sample = Scratch(paths.sparkSession, "trie").write(chosen, "sample")
    total = sample.agg(F.sum((F.length("path") / TOKEN).cast("long") + 1)).first()[0] or 0
    ordered = sample.repartition(1).sortWithinPartitions("path")
    cut = map_arrow(ordered, _cut(shards, total, SKELETON_BYTES), "splitter binary")
    return [bytes(r[0]) for r in cut.collect()]


def skeleton(splits: list[bytes]) -> dict[bytes, int]:
    """Every prefix of a splitter, numbered; the root is 0."""
    nodes = {b"": 0}
    for split in splits:
        for end in range(TOKEN, len(split) + 1, TOKEN):
            nodes.setdefault(split[:end], len(nodes))
    return nodes


class _Node:
    """An open node: what its members so far add up to."""

    __slots__ = ("low", "n", "children", "leaves", "saved", "ends", "words", "number", "waiting")

    def __init__(self, low: int, words: int, number: int | None):
        self.low, self.words, self.number = low, words, number
        self.n = self.children = self.leaves = self.saved = 0
        self.ends = None
        self.waiting: list[tuple] = []


def _nodes(known):
    """Rows of one shard, sorted by path and lowest id -> finished nodes, and this
    shard's part of each skeleton node. `known` is the broadcast skeleton; what its
    nodes hand to each other is left to `_settled`."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: dict[bytes, int] = known.value
        out: list[tuple] = []
        stack: list[_Node] = []
        before = b""

        def close() -> None:
            node, depth = stack.pop(), len(stack)
            ends = node.ends.hexdigest() if node.ends else EMPTY
            above = stack[-1] if stack else None
            if node.number is None:
                node.saved += (node.n - 1) * node.words
                node.leaves += node.children == 0
                above.children += 1
                row = (node.n, node.children, node.leaves, node.saved, ends)
                if above.number is None:
                    above.waiting.append((node.low, depth, row))
                else:
                    out.append((node.low, depth, None, *row, None, above.number, None, None))
                # The parent of these is complete now.
                out.extend(
                    (low, at, node.low, *child, None, None, None, None)
                    for low, at, child in node.waiting
                )
            else:
                out.append((
                    node.low, depth, None, node.n, node.children, node.leaves, node.saved,
                    ends, node.number, None, node.words, node.ends is not None,
                ))
            if above is not None:
                above.low = min(above.low, node.low)
                if node.number is None:
                    above.leaves += node.leaves
                    above.saved += node.saved

        for batch in rows:
            for path, words, n, low, ids in zip(*(c.to_pylist() for c in batch.columns)):
                depth = len(path) // TOKEN
                shared = _shared(before, path) if stack else 0
                while len(stack) > shared + 1:
                    close()
                counts = np.frombuffer(words, "<u4")
                while len(stack) <= depth:
                    at = len(stack)
                    # A prefix can be in the skeleton only below one that is.
                    inside = not stack or stack[-1].number is not None
                    number = numbers.get(path[: at * TOKEN]) if inside else None
                    stack.append(_Node(low, int(counts[at - 1]) if at else 0, number))
                for node in stack:
                    node.n += n
                last = stack[-1]
                last.low = min(last.low, low)
                if last.ends is None:
                    last.ends = hashlib.sha256()
                else:
                    last.ends.update(b",")
                last.ends.update(ids.encode())
                before = path
                if len(out) > 20_000:
                    yield _node_batch(out)
                    out.clear()
        while stack:
            close()
        yield _node_batch(out)

    return run


NODE_TYPES = [
    pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(),
    pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.bool_(),
]
NODE_NAMES = [c.split()[0] for c in NODES.split(", ")]


def _node_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(NODE_NAMES)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, NODE_TYPES)], names=NODE_NAMES
    )


RESULT = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
    "saved_tokens", "ends_sha256",
]


def _settled(spark: SparkSession, parts: DataFrame, nodes: dict[bytes, int]) -> DataFrame:
    """The skeleton's nodes (with `node`): parts added up, then handed up to the top.
    One row per skeleton node, so its bound is that of the splitters."""
    sums = parts.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("words").alias("words"),
        # Only one shard has the conversations that end here.
        F.max(F.when(F.col("ended"), F.col("ends_sha256"))).alias("ends_sha256"),
    )
    found = {r["node"]: r.asDict() for r in sums.collect()}
    above = {number: nodes[p[:-TOKEN]] for p, number in nodes.items() if p}
    # Numbers grow downwards: children come before their parents in reverse.
    for number in sorted(found, reverse=True):
        node = found[number]
        node["ends_sha256"] = node["ends_sha256"] or EMPTY
        node["saved_tokens"] += (node["n_convs"] - 1) * node["words"]
        node["n_leaves"] += node["n_children"] == 0
        parent = found.get(above.get(number))
        node["parent_conv_id"] = parent["conv_id"] if parent else None
        if parent:
            parent["n_children"] += 1
            parent["n_leaves"] += node["n_leaves"]
            parent["saved_tokens"] += node["saved_tokens"]
    table = pa.table({
        name: pa.array([n[name] for n in found.values()], kind)
        for name, kind in zip([*RESULT, "node"], [pa.int64()] * 7 + [pa.string(), pa.int32()])
    })
    return spark.createDataFrame(table)


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations."""
    spark = conversations.sparkSession
    scratch = Scratch(spark, "trie")
    turns = scratch.write(_turns(conversations), "turns")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # A block's rows are in one task, its base first; ids grow from task to task.
    paths = map_arrow(
        turns.repartitionByRange(tasks, "block").sortWithinPartitions(
            "block", F.col("conv_id") != F.col("block"), "conv_id",
            F.asc_nulls_first("turn"), "role", "digest",
        ).select("block", "conv_id", "head", "token", "words"),
        _assemble, "conv_id long, path binary, words binary",
    )
    folded = scratch.write(
        map_arrow(paths.sortWithinPartitions("path", "conv_id"), _fold, PATHS), "paths"
    )
    size = folded.agg(F.sum(F.length("path") + TOKEN)).first()[0] or 0
    splits = splitters(folded, max(tasks, -(-size // (TOKEN * SHARD_TURNS)))) if size else []
    nodes = skeleton(splits)
    known, cuts = spark.sparkContext.broadcast(nodes), spark.sparkContext.broadcast(splits)

    def deal(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = cuts.value
        for batch in rows:
            at = [bisect_right(bounds, p) for p in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(at, pa.int32())], names=[*batch.schema.names, "shard"]
            )

    dealt = map_arrow(folded, deal, f"{PATHS}, shard int")
    sorted_shards = dealt.repartitionById(len(splits) + 1, "shard").sortWithinPartitions("path", "low")
    rows = scratch.write(
        map_arrow(sorted_shards.drop("shard"), _nodes(known), NODES), "nodes"
    )
    known.unpersist()
    cuts.unpersist()
    top = _settled(spark, rows.where("node IS NOT NULL"), nodes)
    parents = F.broadcast(
        top.select(F.col("node").alias("above"), F.col("conv_id").alias("above_id"))
    )
    below = rows.where("node IS NULL").join(parents, "above", "left")
    return below.withColumn(
        "parent_conv_id", F.coalesce("parent_conv_id", "above_id")
    ).select(*RESULT).unionByName(top.select(*RESULT))
