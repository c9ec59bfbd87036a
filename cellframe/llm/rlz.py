"""Substring dedup: spans of words that earlier documents hold, in the place of a
relative Lempel-Ziv parse.

No parse is made: what is asked for is the words that some earlier window covers,
whatever their sources, and a factor's source and longest match would need the
source's text where the document is. Equal windows are found by fingerprint
instead, which gives the same words; a span may join hits from several documents.

The reference is the whole corpus, cut into blocks by its own content: every
window of `WINDOW` words belongs to its anchor, the 5-word run with the smallest
hash in it, and the neighbouring windows of one anchor form a block of at most
`2 * WINDOW - 5` words. Equal text is cut equally wherever it stands. The index maps
a block, and where blocks of one anchor differ, each of their windows, to the
smallest doc_id that holds it; a span of a document runs on while the next block or
window is found in an earlier document. Spans end inside blocks, so windows are
looked up exactly there: in the first documents of blocks that share an anchor with
a different block. All spans have at least `WINDOW` words, and their union is what a
window by window comparison with all earlier documents would mark.

Blocks and windows travel as packed arrays; a batch sends each of them once, for
its smallest doc_id, and settles its other documents by itself, so what a third
of all documents share costs one entry a batch. Fingerprints have 100 bits or
more. Answers go to rows by a row number, which is written beside the texts
first; doc_ids only tell which of two rows is earlier. Rows of a batch that share
the smallest doc_id are linked to the one that was sent and get its answer, key
by key. So a row meets no more keys than its own text has, however many rows share
its doc_id or have none.

Null or empty text, or fewer than `WINDOW` words: nothing is removed. Repeated
rows have one doc_id, so none of them is earlier than the other: all keep their
words, and so do rows without a doc_id against each other, which come after all
others. Texts are whole in one task. An empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellframe.llm.common import Scratch, map_columns
from cellframe.llm.exchange import SCHEMA, each_bucket, from_low_bytes, low_bytes, pack
from cellframe.llm.features import WordHash
from cellframe.llm.shingles import mix, runs

WINDOW = 13
ANCHOR = 5
# Entries of one bucket, a task's work.
BUCKET_ENTRIES = 1_500_000
# Words for each block, on average: the anchors' density.
WORDS_PER_BLOCK = (WINDOW - ANCHOR + 2) / 2
LAST = (1 << 63) - 1

_C1, _C2, _C3 = (np.uint64(c) for c in (
    0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
))


class Blocks:
    """A document's windows and their blocks."""

    def __init__(self, hashes: np.ndarray):
        self.windows = runs(hashes, WINDOW)
        n = len(self.windows)
        if n == 0:
            self.starts = self.sizes = np.zeros(0, np.int64)
            self.anchors = self.blocks = np.zeros(0, np.uint64)
            return
        order = runs(hashes, ANCHOR, seed=2)
        place = sliding_window_view(order, WINDOW - ANCHOR + 1).argmin(axis=1)
        place += np.arange(n)
        self.starts = np.flatnonzero(np.diff(place, prepend=-1))
        self.sizes = np.diff(np.append(self.starts, n))
        at = place[self.starts]
        self.anchors = order[at]
        # First and last window and the anchor's place tell all words of a block.
        self.blocks = mix(
            self.windows[self.starts] * _C1
            + mix(self.windows[self.starts + self.sizes - 1] + _C2)
            + (at - self.starts).astype(np.uint64) * _C3
            + self.sizes.astype(np.uint64)
        )


def _firsts(keys: list[np.ndarray], docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by keys, then document; whether an entry is the first of its key."""
    order = np.lexsort((docs, *reversed(keys)))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= np.diff(key[order]) != 0
    return order, new


def _first_of(order: np.ndarray, new: np.ndarray) -> np.ndarray:
    """For each entry in order the first one of its key."""
    return order[np.flatnonzero(new)[np.cumsum(new) - 1]]


def _spans(ids: list[np.ndarray], keys: np.ndarray) -> tuple[list[np.ndarray], pa.Array]:
    """The distinct ids (one or several numbers) and the distinct keys of each."""
    order = np.lexsort((keys, *reversed(ids)))
    ids, keys = [i[order] for i in ids], keys[order]
    turn = np.zeros(len(keys), bool)
    turn[:1] = True
    for i in ids:
        turn[1:] |= np.diff(i) != 0
    fresh = turn.copy()
    fresh[1:] |= np.diff(keys) != 0
    ids, keys, turn = [i[fresh] for i in ids], keys[fresh], turn[fresh]
    starts = np.flatnonzero(turn)
    lists = [keys[a:b].tobytes() for a, b in zip(starts, np.append(starts[1:], len(keys)))]
    return [i[starts] for i in ids], pa.array(lists, pa.binary())


def _states(rows: np.ndarray, keys: np.ndarray, kind: int) -> list:
    """Columns (row, kind, keys) of entries, one per row."""
    (rows,), lists = _spans([rows], keys)
    return [rows, np.full(len(rows), kind, np.int32), lists]


STATE = "row long, kind int, keys binary"
# Packed entries have no `row`; the others say which keys of a row are settled, or
# with `sent`, which ones have the answer of that row.
ENTRIES = f"{SCHEMA}, row long, sent long"
COVERED_BLOCKS, OPEN_BLOCKS, COVERED_WINDOWS = 0, 1, 2


def _settle(
    keys: list[np.ndarray], name: np.ndarray, owner: np.ndarray, docs: list, rows: list,
    buckets: int,
) -> list[list]:
    """A batch's columns of `ENTRIES`: its entries for the exchange, the keys (by
    `name`) of rows that an earlier document of the batch settles, and those of
    rows whose doc_id is that of the row sent."""
    numbers = np.array([docs, rows], np.int64).T
    docs, rows = numbers[owner].T
    order, new = _firsts(keys, docs)
    first = _first_of(order, new)
    sent = order[new]
    bucket = (keys[0][sent] % np.uint64(buckets)).astype(np.int64)
    entries = np.concatenate([low_bytes(k[sent], 8) for k in keys], axis=1)
    packed = pack(bucket, owner[sent], numbers, entries)
    later = order[docs[order] > docs[first]]
    (settled,), settled_keys = _spans([rows[later]], name[later])
    tied = (docs[order] == docs[first]) & (owner[order] != owner[first])
    like, tied = first[tied], order[tied]
    (of, linked), linked_keys = _spans([rows[like], rows[tied]], name[tied])
    own = [*settled.tolist(), *linked.tolist()]
    rest = [
        [row % buckets for row in own], *[[None] * len(own)] * 2,
        settled_keys.to_pylist() + linked_keys.to_pylist(),
        own, [None] * len(settled) + of.tolist(),
    ]
    nothing = [None] * len(packed[0])
    return [a + b for a, b in zip([*packed, nothing, nothing], rest)]


def _index_blocks(docs: DataFrame, buckets: int) -> DataFrame:
    known = WordHash()

    def run(rows: list, ids: list, texts: list) -> list[list]:
        parsed = [Blocks(known.array(t.encode().split() if t else [])) for t in texts]
        owner = np.repeat(np.arange(len(ids)), [len(p.blocks) for p in parsed])
        if not len(owner):
            return [[], [], [], [], [], []]
        anchors = np.concatenate([p.anchors for p in parsed])
        blocks = np.concatenate([p.blocks for p in parsed])
        return _settle([anchors, blocks], blocks, owner, ids, rows, buckets)

    return map_columns(docs.select("row", "k", "text"), ENTRIES, run, [known])


def _owners(kind: int, opens: bool):
    """What a bucket finds: keys whose first document is an earlier one, and, with
    `opens`, the first documents' blocks of anchors that have several. Rows of the
    first doc_id are all first ones."""

    def run(numbers: np.ndarray, entries: np.ndarray) -> Iterator[list]:
        docs, rows = np.ascontiguousarray(numbers.T)
        keys = [from_low_bytes(entries[:, :8]), from_low_bytes(entries[:, 8:])]
        name = keys[1] if opens else keys[0]
        order, new = _firsts(keys, docs)
        is_later = docs[order] > docs[_first_of(order, new)]
        later = order[is_later]
        yield _states(rows[later], name[later], kind)
        if opens:
            anchor = keys[0][order[new]]
            edge = np.diff(anchor) == 0
            several = np.append(edge, False) | np.append(False, edge)
            chosen = order[several[np.cumsum(new) - 1] & ~is_later]
            yield _states(rows[chosen], name[chosen], OPEN_BLOCKS)

    return run


def _index_windows(docs: DataFrame, buckets: int) -> DataFrame:
    """Windows of open blocks; the second key is an independent fingerprint."""
    known = WordHash()

    def run(rows: list, ids: list, texts: list, opens: list) -> list[list]:
        first, second, sizes = [], [], []
        for text, blocks in zip(texts, opens):
            hashes = known.array(text.encode().split())
            own = Blocks(hashes)
            chosen = np.repeat(np.isin(own.blocks, _joined(blocks)), own.sizes)
            first.append(own.windows[chosen])
            second.append(runs(mix(hashes), WINDOW)[chosen])
            sizes.append(int(chosen.sum()))
        owner = np.repeat(np.arange(len(ids)), sizes)
        if not len(owner):
            return [[], [], [], [], [], []]
        keys = [np.concatenate(first), np.concatenate(second)]
        return _settle(keys, keys[0], owner, ids, rows, buckets)

    return map_columns(docs.select("row", "k", "text", "opens"), ENTRIES, run, [known])


def _joined(lists: list[bytes] | None) -> np.ndarray:
    return np.frombuffer(b"".join(lists or ()), np.uint64)


def _each_key(lists: DataFrame, *ids: str) -> DataFrame:
    """A row for each of the packed `keys`, as `key`, beside the ids."""

    def run(*columns: list) -> list[list]:
        *numbers, keys = columns
        sizes = [len(k) // 8 for k in keys]
        return [
            *(np.repeat(np.array(n, np.int64), sizes) for n in numbers),
            _joined(keys).view(np.int64),
        ]

    schema = ", ".join(f"{name} long" for name in (*ids, "key"))
    return map_columns(lists.select(*ids, "keys"), schema, run)


def _linked_states(links: DataFrame, met: DataFrame) -> DataFrame:
    """The answers of the rows sent, for the keys of the rows linked to them."""
    sent = links.select(F.col("sent").alias("row")).distinct()
    answers = _each_key(met.join(sent, "row", "left_semi"), "row", "kind").select(
        F.col("row").alias("sent"), "kind", "key"
    )
    lists = (
        _each_key(links, "sent", "row").join(answers, ["sent", "key"])
        .groupBy("row", "kind").agg(F.collect_list("key").alias("keys"))
    )

    def run(rows: list, kinds: list, keys: list) -> list[list]:
        return [rows, kinds, [np.array(k, np.int64).tobytes() for k in keys]]

    return map_columns(lists.select("row", "kind", "keys"), STATE, run)


def _resolved(
    scratch: Scratch, part: str, packed: DataFrame, buckets: int, kind: int, opens: bool
) -> DataFrame:
    """States of all rows from packed entries, settled and linked rows."""
    settled = packed.where("row IS NOT NULL AND sent IS NULL").select(
        "row", F.lit(kind).alias("kind"), F.col("entries").alias("keys")
    )
    met = each_bucket(
        packed.where("row IS NULL").select("bucket", "owners", "counts", "entries"),
        buckets, 16, _owners(kind, opens), STATE,
    )
    links = packed.where("sent IS NOT NULL").select(
        "sent", "row", F.col("entries").alias("keys")
    )
    if links.isEmpty():
        return met.unionByName(settled)
    met = scratch.write(met, part)
    return met.unionByName(settled).unionByName(_linked_states(links, met))


def factors(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, starts, lengths, kept_text) of every document: the
    spans, and the words outside of them."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "rlz")
    # Numbers that stay as they are: the table is written once with them.
    keyed = scratch.write(docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("k"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    ), "rows")
    # Letters per word do not vary much; this only sets the number of tasks.
    letters = keyed.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(16, int(letters / 6 / WORDS_PER_BLOCK) // BUCKET_ENTRIES)
    packed = scratch.write(_index_blocks(keyed, buckets), "blocks")
    states = scratch.write(
        _resolved(scratch, "met-blocks", packed, buckets, COVERED_BLOCKS, True), "states"
    )
    scratch.drop(packed)
    opens = states.where(f"kind = {OPEN_BLOCKS}").groupBy("row").agg(
        F.collect_list("keys").alias("opens")
    )
    windows = scratch.write(
        _index_windows(keyed.join(opens, "row"), buckets), "windows"
    )
    found = _resolved(scratch, "met-windows", windows, buckets, COVERED_WINDOWS, False)
    covered = states.where(f"kind = {COVERED_BLOCKS}").unionByName(found).groupBy("row").agg(
        F.collect_list(F.expr(f"IF(kind = {COVERED_BLOCKS}, keys, NULL)")).alias("blocks"),
        F.collect_list(F.expr(f"IF(kind = {COVERED_WINDOWS}, keys, NULL)")).alias("windows"),
    )
    known = WordHash()

    def run(ids: list, texts: list, blocks: list, windows: list) -> list[list]:
        out: list[list] = [ids, [], [], [], [], []]
        for text, block_keys, window_keys in zip(texts, blocks, windows):
            words = text.encode().split()
            starts, lengths, kept = [], [], words
            if block_keys or window_keys:
                own = Blocks(known.array(words))
                hit = np.repeat(np.isin(own.blocks, _joined(block_keys)), own.sizes)
                hit |= np.isin(own.windows, _joined(window_keys))
                starts, lengths, mask = greedy_factors(hit, len(words))
                kept = [w for w, gone in zip(words, mask.tolist()) if not gone]
            for column, value in zip(out[1:], (
                len(words), len(words) - len(kept), starts, lengths, b" ".join(kept).decode()
            )):
                column.append(value)
        return out

    return map_columns(
        keyed.join(covered, "row", "left")
        .select("doc_id", "text", "blocks", "windows"),
        "doc_id long, n_words long, n_removed long, starts array<long>, "
        "lengths array<long>, kept_text string",
        run,
        [known],
    )


def greedy_factors(hit: np.ndarray, n_words: int) -> tuple[list[int], list[int], np.ndarray]:
    """Spans from the windows found earlier: each runs from a found window as long
    as found windows follow, overlap or touch; and the mask of their words."""
    edge = np.zeros(n_words + 1, np.int64)
    at = np.flatnonzero(hit)
    edge[at] += 1
    edge[at + WINDOW] -= 1
    mask = np.cumsum(edge)[:n_words] > 0
    turns = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    starts, ends = turns[::2], turns[1::2]
    return starts.tolist(), (ends - starts).tolist(), mask


def substring_dedup(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256)."""
    return factors(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )
