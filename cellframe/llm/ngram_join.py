"""N-gram Jaccard self-join by universe partition and the pigeonhole principle.

Two sets of sizes a <= b with Jaccard similarity of 3/4 or more differ in at
most H = (a + b) / 7 tokens. Sizes are cut into bands; for the pairs whose larger
set lies in a band, the universe of tokens is hashed into m segments. A token
that differs spoils one segment, so at least m - H segments hold the same
subset in both sets, and any H + 1 segments of a set contain one such.

Cost-based allocation: which H + 1 segments a set spends its budget on is up to
an order that depends on the subsets' content alone, so both sets of a pair
agree on it: subsets with many rare tokens first, those that many documents have
(heavy tokens only, or none at all) last. By the prefix principle the two
selections then share a subset. Where H is at most 1, one segment with its
one-deletion neighbourhood takes the place of them all.

Selections meet in buckets of their hash: numpy arrays travel, not rows, and a set
goes by 32 bits of its number; sets that share them are candidates too. A bucket
yields candidate pairs; a subset shared by more than `STAR` sets first yields a star
around one of them. The stars and one candidate of every other set
are verified first; after these links are known, all candidates and all pairs of
sets with a common subset that are not connected yet. So groups of near
copies never become all pairs, and no link between components is lost. Parities of
token counts in hashed cells bound the difference of two sets from below: what
they do not rule out is verified on the whole sets, which only then are made.
Both sides of the joins grow with the input, so they are merged; a side that turns
out small after its shuffle would take one more stage to be sent round.

Equal sets are one node from the start (two 64-bit sums; a clash of the first
is detected by the second and the run repeated with another seed).

Null or empty text: empty set, links with nothing. Rows without a doc_id take
part. Repeated rows are equal sets. Texts of any length are whole sets in one
task. An empty table gives none.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import islice
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellframe.llm.common import WORD, Scratch, map_arrow, map_columns, same
from cellframe.llm.components import connected_components
from cellframe.llm.exchange import (
    FILTER_BITS, SCHEMA, each_bucket, from_low_bytes, id_filter, low_bytes, matching, pack,
    passes,
)
from cellframe.llm.features import WordHash
from cellframe.llm.shingles import BLOCK_TEXTS, mix, shingle_sets

WIDTH = 5
# Similarity 3/4, that is 7 * common >= 3 * (a + b).
# Selected subsets in one bucket, a task's work.
BUCKET_SUBSETS = 1_500_000
# Bytes of a subset's hash besides its bucket; bytes of a token when sets are compared.
SHORT, TOKEN_BYTES = 5, 6
# Bits of a node, at most 32, by which sets meet: its short. Sets with one short meet as
# one; all of them are candidates then, and of each other.
SHORT_NODE = 0xFFFFFFFF
# Sets that may share a subset before it is paired in two rounds.
STAR = 16
# Members of a subset that are compared with each other at once; members of all
# subsets of a lot; comparisons of one task.
PART, LOT, LOT_PAIRS = 2048, 150_000, 4_000_000
# A token in this many documents of a batch counts as heavy; so many are kept.
# Heavy tokens steer the order only: results do not depend on them.
HEAVY_IN_BATCH = 8
HEAVY_TOKENS = 100_000


def _band_edges() -> list[int]:
    """Smallest size of every band; each starts at 4/3 of the one before."""
    edges = [1]
    while edges[-1] < 1 << 40:
        edges.append(max(edges[-1] + 1, -(-edges[-1] * 4 // 3)))
    return edges


EDGES = _band_edges()


@lru_cache(maxsize=256)
def _segments(m: int, band: int) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of m equal ranges of 64-bit numbers, and a number for each range."""
    cuts = [min(-(-(i << 64) // m), (1 << 64) - 1) for i in range(m + 1)]
    place = np.arange(m, dtype=np.uint64) + np.uint64(band << 32)
    return np.array(cuts, np.uint64), place * np.uint64(0xC2B2AE3D27D4EB4F)


def _running(values: np.ndarray, kind: type) -> np.ndarray:
    """Sums of the first 0, 1, 2, ... values."""
    total = np.zeros(len(values) + 1, kind)
    np.cumsum(values, out=total[1:])
    return total


def selections(sets: list[np.ndarray], heavy: np.ndarray) -> list[np.ndarray]:
    """For each set (sorted, distinct) hashes of the subsets that it is indexed by.

    Tokens are hashes, so a segment is a range of them, a slice of the set.
    """
    if not sets:
        return []
    tokens = np.concatenate(sets)
    spread = mix(tokens + np.uint64(77))
    total, rare = _running(spread, np.uint64), np.arange(len(tokens) + 1)
    if len(heavy) and len(tokens):
        at = np.searchsorted(heavy, tokens)
        rare = _running(heavy[np.minimum(at, len(heavy) - 1)] != tokens, np.int64)
    found: list[list] = [[] for _ in sets]
    jobs, lows, highs, places, base = [], [], [], [], 0
    for i, own_tokens in enumerate(sets):
        size = len(own_tokens)
        own = bisect_right(EDGES, size) - 1
        for band in (own, own + 1) if size else ():
            largest = EDGES[band + 1] - 1
            differ = (size + min(largest, 4 * size // 3)) // 7
            if differ == 0:
                continue  # only equal sets are similar
            most = 2 * largest // 7
            if most <= 1:
                whole = spread[base : base + size].sum(dtype=np.uint64, keepdims=True)
                subsets = np.append(whole - spread[base : base + size], whole)
                found[i].append(mix(subsets + np.uint64(band) * np.uint64(0x9E3779B9)))
                continue
            cuts, numbers = _segments(2 * (most + 1), band)
            bounds = np.searchsorted(own_tokens, cuts)
            bounds[-1] = size
            bounds += base
            jobs.append((i, differ, len(numbers)))
            lows.append(bounds[:-1])
            highs.append(bounds[1:])
            places.append(numbers)
        base += size
    if jobs:
        low, high = np.concatenate(lows), np.concatenate(highs)
        subsets = mix(total[high] - total[low] + np.concatenate(places))
        # Many rare tokens first, then many tokens.
        many = (np.minimum(rare[high] - rare[low], 255) << 8) + np.minimum(high - low, 255)
        key = (65535 - many).astype(np.uint64) << np.uint64(48) | subsets >> np.uint64(16)
        start = 0
        for i, differ, m in jobs:
            first = np.argpartition(key[start : start + m], differ)[: differ + 1]
            found[i].append(subsets[start : start + m][first])
            start += m
    none = np.zeros(0, np.uint64)
    return [np.concatenate(x) if x else none for x in found]


def selection(tokens: np.ndarray, heavy: np.ndarray) -> np.ndarray:
    """The same of one set."""
    return selections([tokens], heavy)[0]


def _sums(sets: list[np.ndarray], hashed: Callable[[np.ndarray], np.ndarray]) -> list[int]:
    """A sum over each set, as a signed 64-bit number."""
    if not sets:
        return []
    total = _running(hashed(np.concatenate(sets)), np.uint64)
    ends = np.cumsum([len(x) for x in sets])
    starts = np.append(0, ends[:-1])
    return (total[ends] - total[starts]).view(np.int64).tolist()


def _nodes(sets: list[np.ndarray], seed: int) -> list[int]:
    return _sums(sets, lambda tokens: mix(tokens * np.uint64(2 * seed + 1)))


def _checks(sets: list[np.ndarray]) -> list[int]:
    """Other sums of the same sets."""
    return _sums(sets, lambda tokens: mix(tokens + np.uint64(0xD6E8FEB86659FD93)))


def set_profiles(docs: DataFrame, seed: int) -> DataFrame:
    """A row per document (doc_id, digest, n, node, check, its parities, fewer of them)
    and, kept apart by `n` null, a row per heavy token of each batch (node: token,
    check: documents)."""
    known = WordHash()

    def run(ids: list, digests: list, texts: list) -> list[list]:
        tokens = list(shingle_sets(texts, known))
        bits = [parity(found) for found in tokens]
        out = [
            list(ids), list(digests), [len(found) for found in tokens],
            _nodes(tokens, seed), _checks(tokens), [x.tobytes() for x in bits],
            [folded(x, max(4, len(x) // 4)).tobytes() for x in bits],
        ]
        if tokens:
            each = np.sort(np.concatenate(tokens))
            starts = np.flatnonzero(np.append(True, each[1:] != each[:-1])[: len(each)])
            counts = np.diff(np.append(starts, len(each)))
            each = each[starts]
            often = counts >= HEAVY_IN_BATCH
            extra = each[often].astype(np.int64).tolist()
            for column, values in zip(out, (
                *[[None] * len(extra)] * 3, extra, counts[often].tolist(),
                *[[None] * len(extra)] * 2,
            )):
                column += values
        return out

    return map_columns(
        docs.select("doc_id", F.xxhash64("text"), "text"),
        "doc_id long, digest long, n long, node long, check long, bits binary, brief binary",
        run, [known],
    )


def _selections(docs: DataFrame, heavy: np.ndarray, buckets: int, seed: int) -> DataFrame:
    """The selections of every batch, packed by bucket. Sets go by the short of their
    node: the more buckets, the fewer entries share a number."""
    known, short_node = WordHash(), SHORT_NODE
    sent = docs.sparkSession.sparkContext.broadcast(heavy)

    def run(texts: list) -> list[list]:
        nodes, lists, seen = [], [], set()
        whole = shingle_sets(texts, known)
        while block := list(islice(whole, BLOCK_TEXTS)):
            fresh = []
            for node, tokens in zip(_nodes(block, seed), block):
                if len(tokens) and node not in seen:
                    seen.add(node)
                    nodes.append(node & short_node)
                    fresh.append(tokens)
            lists += selections(fresh, sent.value)
        if not lists:
            return [[], [], [], []]
        subsets = np.concatenate(lists)
        owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        bucket = (subsets % np.uint64(buckets)).astype(np.int64)
        # 40 bits within a bucket: a clash only makes one more candidate.
        short = low_bytes(subsets >> np.uint64(24), SHORT)
        return pack(bucket, owner, np.array(nodes, np.int64), short, brief=True)

    return map_columns(docs.select("text"), SCHEMA, run, [known])


def _meetings(node: np.ndarray, entries: np.ndarray) -> Iterator[list]:
    """The candidates of one bucket: (a, b, subset). Subset 0: a pair; 1: a pair of a
    star; b null: member a of a subset that is paired in two rounds.

    A star stands around the member that most large subsets of the bucket hold: the
    original of a group of near copies has all that any of them has kept.
    """
    subset = from_low_bytes(entries)
    order = np.lexsort((node, subset))
    node, subset = node[order], subset[order]
    fresh = np.append(True, (np.diff(node) != 0) | (np.diff(subset) != 0))
    node, subset = node[fresh], subset[fresh]
    starts = np.flatnonzero(np.append(True, np.diff(subset) != 0))
    sizes = np.diff(np.append(starts, len(subset)))
    pairs = [np.zeros((0, 2), np.int64)]
    for size in np.unique(sizes[(sizes > 1) & (sizes <= STAR)]).tolist():
        group = node[starts[sizes == size][:, None] + np.arange(size)]
        i, j = np.triu_indices(size, 1)
        pairs.append(np.stack([group[:, i].ravel(), group[:, j].ravel()], axis=1))
    groups = [node[starts[at] : starts[at] + sizes[at]] for at in np.flatnonzero(sizes > STAR)]
    stars = [np.zeros((0, 2), np.int64)]
    if groups:
        names, place, times = np.unique(
            np.concatenate(groups), return_inverse=True, return_counts=True
        )
        ends = np.cumsum([len(g) for g in groups])
        for group, places in zip(groups, np.split(times[place], ends[:-1])):
            centre = group[places.argmax()]
            rest = group[group != centre]
            stars.append(np.sort(np.stack([np.full(len(rest), centre), rest], axis=1), axis=1))
    for at, group in zip(np.flatnonzero(sizes > STAR).tolist(), groups):
        yield [
            group, pa.nulls(len(group), pa.int64()),
            np.full(len(group), subset[starts[at]].astype(np.int64)),
        ]
    for kind, some in ((0, pairs), (1, stars)):
        found = np.unique(np.concatenate(some), axis=0)
        yield [found[:, 0], found[:, 1], np.full(len(found), kind, np.int64)]


def parity(tokens: np.ndarray) -> np.ndarray:
    """A bit for each of 4 cells a token or more: whether the cell holds an odd
    number of tokens. Two sets differ in at least as many tokens as bits."""
    bits = max(256, 1 << (4 * len(tokens) - 1).bit_length())
    cells = (mix(tokens + np.uint64(99)) & np.uint64(bits - 1)).astype(np.int64)
    odd = np.bincount(cells, minlength=bits).astype(np.uint8) & 1
    return np.packbits(odd).view(np.uint64)


def folded(bits: np.ndarray, width: int) -> np.ndarray:
    """Parities over fewer cells."""
    while len(bits) > width:
        half = len(bits) // 2
        bits = bits[:half] ^ bits[half:]
    return bits


def _signatures(profiles: DataFrame, met: DataFrame) -> DataFrame:
    """(short, node, doc_id, n, bits, brief) of every set that has met another or shares
    its short with another: a row for each node, so a short may have several."""
    named = profiles.where("n > 0").withColumn("short", F.expr(f"node & {SHORT_NODE}L"))
    several = named.groupBy("short").agg(
        F.min("node").alias("low"), F.max("node").alias("high")
    ).where("low <> high").select("short")
    ends = met.select(F.explode(F.array("a", "b")).alias("short")).distinct()
    return (
        named.join(ends.unionByName(several).hint("merge"), "short", "left_semi")
        .groupBy("short", "node")
        .agg(*[F.min(c).alias(c) for c in ("doc_id", "n", "bits", "brief")])
    )


def _sets_of(docs: DataFrame, wanted: DataFrame, seed: int) -> DataFrame:
    """(node, tokens) of at least the nodes that the documents in `wanted` (id) have.

    A filter of fixed size goes to the scan, so texts are not shuffled.
    """
    known = WordHash()
    sent = docs.sparkSession.sparkContext.broadcast(id_filter(wanted))

    def run(places: list, texts: list) -> list[list]:
        out: list[list] = [[], []]
        maybe = passes(sent.value, np.array(places, np.int64))
        whole = shingle_sets((t for t, m in zip(texts, maybe.tolist()) if m), known)
        while block := list(islice(whole, BLOCK_TEXTS)):
            out[0] += _nodes(block, seed)
            out[1] += [low_bytes(tokens, TOKEN_BYTES).tobytes() for tokens in block]
        return out

    place = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    return map_columns(docs.select(place, "text"), "node long, tokens binary", run, [known])


def _both(pairs: DataFrame, sets: DataFrame, *columns: str) -> DataFrame:
    """Pairs (a, b and more) with columns of their sets."""
    own = pairs.columns
    for end in ("a", "b"):
        names = [end, *(f"{end}_{c}" for c in columns)]
        pairs = pairs.join(sets.select(sets.columns[0], *columns).toDF(*names).hint("merge"), end)
    return pairs.select(*own, *[f"{e}_{c}" for c in columns for e in ("a", "b")])


def _possible(pairs: DataFrame, signatures: DataFrame) -> DataFrame:
    """The pairs of nodes (a < b, star) among the pairs of shorts (a, b, star), and
    among the nodes of one short, that their parities do not rule out.

    There may be very many pairs, so they are joined with the fewer parities.
    """

    def run(a: list, b: list, star: list, m: list, n: list, x: list, y: list) -> list[list]:
        out: list[list] = [[], [], []]
        for i, j, s, size, bits, other in zip(a, b, star, map(sum, zip(m, n)), x, y):
            bits, other = np.frombuffer(bits, np.uint64), np.frombuffer(other, np.uint64)
            width = min(len(bits), len(other))
            differ = np.bitwise_count(folded(bits, width) ^ folded(other, width))
            if int(differ.sum(dtype=np.int64)) <= size // 7:
                for column, value in zip(out, (min(i, j), max(i, j), s)):
                    column.append(value)
        return out

    several = signatures.groupBy("short").agg(F.count("*").alias("sets")).where("sets > 1")
    alike = several.select(
        F.col("short").alias("a"), F.col("short").alias("b"), F.lit(0).cast("long").alias("star")
    )
    named = _both(pairs.unionByName(alike), signatures, "node", "n", "brief")
    return map_columns(
        named.where("a <> b OR a_node < b_node").drop("a", "b").select(
            "a_node", "b_node", "star", "a_n", "b_n", "a_brief", "b_brief"
        ),
        "a long, b long, star long", run,
    )


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are similar.

    Only sets that are in a pair are shuffled. Tokens are compared by 48 bits, a
    few thousand against a few thousand.
    """
    ends = pairs.select(F.explode(F.array("a", "b")).alias("id"))
    sets = matching(sets.select("node", "tokens"), "node", ends)

    def run(a: list, b: list, left: list, right: list) -> list[list]:
        out: list[list] = [[], []]
        for i, j, x, y in zip(a, b, left, right):
            both = from_low_bytes(np.frombuffer(x + y, np.uint8).reshape(-1, TOKEN_BYTES))
            both.sort()
            if 7 * int((both[1:] == both[:-1]).sum()) >= 3 * len(both):
                out[0].append(i)
                out[1].append(j)
        return out

    return map_columns(_both(pairs, sets, "tokens"), "a long, b long", run)


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components."""
    def label(end: str) -> DataFrame:
        return labels.toDF(f"{end}_node", f"{end}_of").hint("merge")

    return (
        pairs.join(label("a"), F.col("a") == F.col("a_node"), "left")
        .join(label("b"), F.col("b") == F.col("b_node"), "left")
        .where(F.coalesce("a_of", "a") != F.coalesce("b_of", "b"))
        .select("a", "b")
    )


def _between(left: list[tuple], right: list[tuple] | None) -> np.ndarray:
    """Possible pairs between members (node, component, n, bits) of two parts of a
    subset, or within one part, that are in different components.

    The members of the largest component are not compared with each other.
    """
    members = left + (right or [])
    width = min(len(m[3]) for m in members)
    bits = np.array([folded(m[3], width) for m in members])
    nodes, of, sizes = (np.array([m[i] for m in members]) for i in range(3))
    names, times = np.unique(of, return_counts=True)
    others = of != names[times.argmax()]
    every, first = np.arange(len(members)), len(left) if right is not None else 0
    rounds = [(every[others], every)]
    if right is not None:
        rounds = [
            (every[:first][others[:first]], every[first:]),
            (every[:first][~others[:first]], every[first:][others[first:]]),
        ]
    found = [np.zeros((0, 2), np.int64)]
    for rows, against in rounds:
        step = max(1, (1 << 22) // (max(1, len(against)) * width))
        for at in range(0, len(rows), step):
            some = rows[at : at + step]
            differ = np.bitwise_count(bits[some, None] ^ bits[None, against])
            good = differ.sum(2, dtype=np.int64) <= (sizes[some, None] + sizes[None, against]) // 7
            good &= of[some, None] != of[None, against]
            i, j = np.nonzero(good)
            found.append(np.stack([nodes[some[i]], nodes[against[j]]], axis=1))
    return np.unique(np.sort(np.concatenate(found), axis=1), axis=0)


def _later_pairs(
    members: DataFrame, labels: DataFrame, signatures: DataFrame, scratch: Scratch
) -> DataFrame:
    """Possible pairs between members (subset, short) of a subset that are still in
    different components; a pair may come several times.

    Subsets are dealt in lots: a member travels once a lot with its parities and
    the subsets it has there, and a pair that shares several of them comes out
    once a lot. There are as many lots as bound a task's comparisons. Where a subset is large, members are dealt in parts, part against part.
    """
    known = signatures.select("short", F.col("node").alias("a")).join(
        labels.hint("merge"), F.col("a") == F.col("node"), "left"
    ).select("short", "a", F.coalesce("component", "a").alias("component"))
    labelled = scratch.write(
        members.join(known.hint("merge"), "short").select("subset", "a", "component"), "members"
    )
    open_subsets = labelled.groupBy("subset").agg(
        F.min("component").alias("low"), F.max("component").alias("high"),
        F.count("*").alias("size"),
    ).where("low <> high")
    total, largest, squares = open_subsets.agg(
        F.sum("size"), F.max("size"), F.sum(F.col("size").cast("double") * F.col("size"))
    ).first()
    parts = -(-(largest or 0) // PART) or 1
    lots = max(-(-(total or 0) // LOT), ceil((squares or 0) / (LOT_PAIRS * parts**2)), 1)
    dealt = (
        labelled.join(open_subsets.select("subset").hint("merge"), "subset")
        .repartition("a")  # once, for the groups and the join with their parities
        .groupBy(F.pmod(F.xxhash64("subset"), F.lit(lots)).alias("lot"), "a", "component")
        .agg(F.collect_list("subset").alias("subsets"))
        .join(signatures.select(F.col("node").alias("a"), "n", "bits").hint("merge"), "a")
        .withColumn("part", F.pmod(F.xxhash64("a"), F.lit(parts)))
        .withColumn("other", F.explode(F.expr(f"sequence(0L, {parts - 1}L)")))
        .selectExpr(
            "lot", "least(part, other) AS low", "greatest(part, other) AS high",
            "part", "a", "component", "n", "bits", "subsets",
        )
    )
    keys = ["lot", "low", "high"]
    dealt = dealt.repartition(*keys).sortWithinPartitions(*keys, "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sides = None, ({}, {})

        def pairs() -> pa.RecordBatch:
            left, right = sides
            found = [np.zeros((0, 2), np.int64)]
            for subset, some in left.items():
                if at[1] == at[2]:
                    found.append(_between(some, None))
                elif subset in right:
                    found.append(_between(some, right[subset]))
            unique = np.unique(np.concatenate(found), axis=0)
            return pa.RecordBatch.from_arrays(
                [pa.array(unique[:, i]) for i in (0, 1)], names=["a", "b"]
            )

        for batch in batches:
            for *key, part, node, component, n, bits, subsets in zip(
                *(c.to_pylist() for c in batch.columns)
            ):
                if key != at:
                    if at is not None:
                        yield pairs()
                    at, sides = key, ({}, {})
                member = (node, component, n, np.frombuffer(bits, np.uint64))
                for subset in subsets:
                    sides[part != key[1]].setdefault(subset, []).append(member)
        if at is not None:
            yield pairs()

    return map_arrow(dealt, run, "a long, b long")


def _grouped(docs: DataFrame) -> DataFrame:
    """(doc_id, digest of the text, n, component) of every document; a component is
    known by one of its nodes."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "ngram")
    seed = 0
    while True:
        profiles = scratch.write(set_profiles(docs, seed), "profiles")
        sets = profiles.where("n > 0")
        nodes = sets.groupBy("node").agg(
            F.min("check").alias("low"), F.max("check").alias("high"),
        )
        if nodes.where("low <> high").isEmpty():
            break
        scratch.drop(profiles)
        seed += 1
    heavy = np.sort(np.array([
        r["node"] for r in profiles.where("n IS NULL").groupBy("node")
        .agg(F.sum("check").alias("times"))
        .orderBy(F.desc("times"), "node").limit(HEAVY_TOKENS).collect()
    ], np.int64).astype(np.uint64))
    total = sets.agg(F.sum("n")).first()[0] or 0
    buckets = max(16, int(0.7 * total) // BUCKET_SUBSETS)

    packed = _selections(docs, heavy, buckets, seed)
    met = scratch.write(each_bucket(
        packed, buckets, SHORT, _meetings, "a long, b long, subset long", brief=True
    ), "met")
    signatures = scratch.write(_signatures(profiles, met), "signatures")

    def tokens_of(pairs: DataFrame, part: str) -> DataFrame:
        """Written sets of the nodes in pairs (a, b)."""
        ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        wanted = signatures.join(ends.hint("merge"), "node", "left_semi").select(
            F.col("doc_id").alias("id")
        )
        return scratch.write(_sets_of(docs, wanted, seed), part)

    # First the stars, and every set against the smallest of its other candidates,
    # which unites most groups; then all pairs that this has left apart.
    pairs = met.where("b IS NOT NULL").groupBy("a", "b").agg(F.max("subset").alias("star"))
    pairs = scratch.write(_possible(pairs, signatures), "possible")
    first = scratch.write(pairs.where("star = 1").select("a", "b").unionByName(
        pairs.where("star = 0").groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    ), "first-pairs")
    tokens = tokens_of(first, "sets")
    found = scratch.write(_verified(first, tokens), "first-links")
    scratch.drop(tokens)
    labels = connected_components(found)
    members = met.where("b IS NULL").select("subset", F.col("a").alias("short"))
    later = scratch.write(
        _apart(pairs.select("a", "b"), labels)
        .unionByName(_later_pairs(members, labels, signatures, scratch)).distinct()
        .join(first.hint("merge"), ["a", "b"], "left_anti"),
        "later",
    )
    if not later.isEmpty():
        tokens = tokens_of(later, "later-sets")
        more = scratch.write(_verified(later, tokens), "second")
        if not more.isEmpty():
            labels = connected_components(labels.union(more))
        scratch.drop(tokens)
    scratch.drop(signatures)
    return profiles.where("n IS NOT NULL").join(
        labels.withColumnRenamed("node", "label_node"),
        (F.col("node") == F.col("label_node")) & (F.col("n") > 0), "left",
    ).select("doc_id", "digest", "n", F.coalesce("component", "node").alias("component"))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    grouped = _grouped(docs.select("doc_id", "text"))
    smallest = grouped.where("n > 0").groupBy("component").agg(
        F.min("doc_id").alias("component_id")
    ).withColumnRenamed("component", "of")
    return grouped.join(
        smallest, (F.col("component") == F.col("of")) & (F.col("n") > 0), "left"
    ).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each group of similar documents stays.

    It is the one with the smallest doc_id (null last), then the smallest digest of
    its text; of rows equal in both, that with the smallest digest of its other
    columns. Rows are told apart by doc_id and text, so a text unlike all others
    stays whatever row shares its doc_id. Texts without words are in no group:
    all of their rows stay.
    """
    grouped = _grouped(docs.select("doc_id", "text"))
    first = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "digest")
    chosen = grouped.where("n > 0").groupBy("component").agg(F.min(first).alias("first"))
    stay = chosen.select(
        F.col("first.doc_id").alias("stay_id"), F.col("first.digest").alias("stay_digest")
    )
    others = [c for c in docs.columns if c.lower() != "text"]
    own = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
        F.col("doc_id").alias("own_id"),
        F.xxhash64("text").alias("own_digest"),
        # Any type has a text; a map has no hash.
        F.xxhash64(F.to_json(F.struct(*[docs[f"`{c}`"] for c in others]))).alias("rest"),
        F.coalesce(F.regexp_like("text", F.lit(WORD)), F.lit(False)).alias("has_words"),
    )
    kept = (
        own.where("has_words")
        .join(stay, same(F.col("own_id"), F.col("stay_id"))
              & (F.col("own_digest") == F.col("stay_digest")), "left_semi")
        .groupBy("own_id", "own_digest")
        .agg(F.min_by("row", "rest").alias("row"))
    )
    return kept.select("row.*").unionByName(own.where("NOT has_words").select("row.*"))
