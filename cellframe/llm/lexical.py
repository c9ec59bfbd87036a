"""Ranked lexical search: an inverted index of segments, read by Block-Max MaxScore.

`build_index` cuts the documents of each reading task into segments. A segment has
one row for each of its terms: the postings in blocks of `BLOCK` documents, each
block as byte planes of document gaps and counts, and a head per block with its
last document and greatest impact. An impact is the term's part of a score before
its weight, which the whole corpus decides; so heads hold it exactly.

`search` reads the rows of the query's terms alone. A task gets whole segments and
keeps, from one to the next, the best documents of every query. Lists are ordered by
their greatest possible part of a score over all segments (global bounds). Those
whose bounds together stay below the worst of the best are non-essential: a document
in no other list can't win. Candidates come from the essential lists only; along
the others, a candidate whose score so far, the maximum of the block it would be
in and the bounds of the lists left don't reach the worst of the best is dropped
before that block is unpacked. The tasks' best are merged by rank. All sums are whole numbers, so
the result is exact.

Queries are taken in blocks of at most `QUERIES` items and, but for one very long
item, `QUERY_TERMS` terms; a block and its terms are sent to every task. A segment holds at most `SEGMENT_DOCS` documents and, but for one very
long document, `SEGMENT_TERMS` terms; long texts are cut into terms in pieces.

Null and empty texts and texts without a term are in no list. Equal scores are
ordered by doc_id, null last. Repeated rows are documents of their own and take a
rank each, and so are repeated items, whose ranks start anew. An item without terms
has no rows; an empty table gives none.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from cellframe.llm.common import Scratch, map_arrow

# Characters outside of terms, as in the contract of the search.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

BLOCK = 128
SEGMENT_DOCS, SEGMENT_TERMS = 16_384, 1_000_000
PIECE = 1 << 20
QUERIES, QUERY_TERMS = 1_000, 100_000
TOP = 50

# Bytes to blanks (all that no term has) and small letters.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)

HEAD = np.dtype([
    ("last", "<u2"), ("top", "<u4"), ("at", "<u4"), ("gap_planes", "u1"),
    ("tf_planes", "u1"), ("n", "<u2"),
])
INDEX = "segment string, term binary, df int, top long, heads binary, body binary"


def pieces(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text as UTF-8, in lists of bounded size (one list for most)."""
    folded = (text or "").encode().translate(_FOLD)
    start = 0
    while len(folded) - start > PIECE:
        end = folded.rfind(b" ", start, start + PIECE)
        if end <= start:
            end = folded.find(b" ", start + PIECE)
            if end < 0:
                break
        yield folded[start:end].split()
        start = end
    yield folded[start:].split()


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """A term's part of a score before its weight."""
    tf = tf.astype(np.int64)
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


class _Segment:
    """Documents on their way into a segment."""

    def __init__(self):
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.vocabulary: dict[bytes, int] = {}
        self.terms: list[np.ndarray] = []
        self.docs: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.size = 0
        # Terms of short documents, looked up together.
        self.waiting: list[bytes] = []
        self.owners: list[int] = []

    def add(self, doc_id: int | None, text: str | None) -> None:
        number, length, long_counts = len(self.ids), 0, None
        for found in pieces(text):
            length += len(found)
            if long_counts is None and len(found) < 100_000:
                self.waiting += found
                self.owners += [number] * len(found)
                if len(self.waiting) > 100_000:
                    self.flush()
            else:
                long_counts = long_counts or Counter()
                long_counts.update(found)
        if length == 0:
            return
        if long_counts:
            self.flush()
            self._keep(list(long_counts), np.full(len(long_counts), number),
                       np.fromiter(long_counts.values(), np.int64, len(long_counts)))
        self.ids.append(doc_id)
        self.lengths.append(length)
        self.size += length

    def flush(self) -> None:
        if self.waiting:
            owners = np.array(self.owners, np.int64)
            self._keep(self.waiting, owners, np.ones(len(owners), np.int64))
            self.waiting, self.owners = [], []

    def _keep(self, terms: list[bytes], owners: np.ndarray, counts: np.ndarray) -> None:
        """(term, document, count) with repeats added up."""
        coded = pa.array(terms, pa.binary()).dictionary_encode()
        number = self.vocabulary.setdefault
        known = np.array(
            [number(t, len(self.vocabulary)) for t in coded.dictionary.to_pylist()], np.int64
        )
        pair = known[coded.indices.to_numpy()] << 16 | owners
        pair, place = np.unique(pair, return_inverse=True)
        self.terms.append((pair >> 16).astype(np.int32))
        self.docs.append((pair & 0xFFFF).astype(np.uint16))
        self.counts.append(np.bincount(place, counts).astype(np.int32))

    def full(self) -> bool:
        return len(self.ids) >= SEGMENT_DOCS or self.size >= SEGMENT_TERMS

    def rows(self, name: str, n_docs: int, n_terms: int) -> Iterator[pa.RecordBatch]:
        """The documents as a row without a term, then one row per term."""
        self.flush()
        if not self.ids:
            return
        lengths = np.array(self.lengths, np.int64)
        m = 100 - 50 + 50 * lengths * n_docs // n_terms
        missing = np.array([i is None for i in self.ids])
        ids = np.array([0 if i is None else i for i in self.ids], np.int64)
        yield _batch(
            name, [b""], [len(ids)], [0], [missing.tobytes()], [ids.tobytes() + m.tobytes()]
        )

        pair = np.concatenate(self.terms).astype(np.int64) << 16 | np.concatenate(self.docs)
        pair, place = np.unique(pair, return_inverse=True)
        tf = np.bincount(place, np.concatenate(self.counts)).astype(np.int64)
        term, doc = pair >> 16, pair & 0xFFFF
        packed = pack(term, doc, tf, impact(tf, m[doc]))
        words = list(self.vocabulary)  # in order of their numbers
        for start in range(0, len(words), 50_000):
            part = slice(start, start + 50_000)
            yield _batch(name, words[part], *(column[part] for column in packed))


def _batch(name: str, term, df, top, heads, body) -> pa.RecordBatch:
    columns = [
        pa.array([name] * len(term), pa.string()), pa.array(term, pa.binary()),
        pa.array(df, pa.int32()), pa.array(top, pa.int64()),
        pa.array(heads, pa.binary()), pa.array(body, pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(
        columns, names=["segment", "term", "df", "top", "heads", "body"]
    )


def pack(term: np.ndarray, doc: np.ndarray, tf: np.ndarray, parts: np.ndarray) -> tuple:
    """Postings sorted by (term, doc) -> (df, top, heads, body) of each term.

    A block's body has one plane of bytes for each byte that its widest gap needs,
    then as many for its widest count."""
    first = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
    df = np.diff(np.r_[first, len(term)])
    inside = np.arange(len(term)) - np.repeat(first, df)
    opens = np.flatnonzero(inside % BLOCK == 0)
    n = np.diff(np.r_[opens, len(term)])
    gap = doc - np.r_[0, doc[:-1]]
    gap[first] = doc[first]
    heads = np.zeros(len(opens), HEAD)
    heads["n"] = n
    heads["last"] = doc[opens + n - 1]
    heads["top"] = np.maximum.reduceat(parts, opens)
    heads["gap_planes"] = 1 + (np.maximum.reduceat(gap, opens) > 255)
    widest = np.maximum.reduceat(tf, opens)
    heads["tf_planes"] = 1 + (widest > 255) + (widest > 65_535) + (widest > 16_777_215)
    planes = heads["gap_planes"].astype(np.int64) + heads["tf_planes"]
    start = np.cumsum(np.r_[0, n * planes])
    body = np.zeros(start[-1], np.uint8)
    block = np.repeat(np.arange(len(opens)), n)
    at = start[block] + np.arange(len(term)) - opens[block]
    for values, count, before in (
        (gap, heads["gap_planes"], np.zeros(len(opens), np.int64)),
        (tf, heads["tf_planes"], heads["gap_planes"].astype(np.int64)),
    ):
        for plane in range(int(count.max(initial=0))):
            has = count[block] > plane
            here = block[has]
            body[at[has] + (before[here] + plane) * n[here]] = values[has] >> 8 * plane & 255
    # Blocks and bytes of each term.
    block_of = np.searchsorted(opens, first)
    byte_of = np.r_[start[block_of], start[-1]]
    heads["at"] = start[:-1] - np.repeat(byte_of[:-1], np.diff(np.r_[block_of, len(opens)]))
    head_bytes, body_bytes = heads.tobytes(), body.tobytes()
    ends = np.r_[block_of, len(opens)] * HEAD.itemsize
    return (
        df, np.maximum.reduceat(parts, first),
        [head_bytes[a:b] for a, b in zip(ends[:-1], ends[1:])],
        [body_bytes[a:b] for a, b in zip(byte_of[:-1], byte_of[1:])],
    )


def unpack(heads: np.ndarray, body: bytes, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents and counts of block `i` of a list."""
    head = heads[i]
    n, gaps, counts = int(head["n"]), int(head["gap_planes"]), int(head["tf_planes"])
    planes = np.frombuffer(body, np.uint8, n * (gaps + counts), int(head["at"]))
    planes = planes.reshape(gaps + counts, n).astype(np.int64)
    gap = planes[0] + (planes[1] << 8) if gaps == 2 else planes[0]
    tf = planes[gaps]
    for j in range(1, counts):
        tf = tf + (planes[gaps + j] << 8 * j)
    return np.cumsum(gap) + (int(heads[i - 1]["last"]) if i else 0), tf


def build_index(docs: DataFrame) -> tuple[DataFrame, int, int]:
    """The written index of all documents, and the numbers N of documents and L of
    terms that impacts are made with. The text is read twice: counted, then cut."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [sum(map(len, pieces(t.as_py()))) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([sum(n > 0 for n in sizes)]), pa.array([sum(sizes)])],
                names=["docs", "terms"],
            )

    n_docs, n_terms = map_arrow(docs.select("text"), count, "docs long, terms long").agg(
        F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("terms"), F.lit(0))
    ).first()
    read = docs.select(F.col("doc_id").cast("long"), F.col("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, made, segment = TaskContext.get().partitionId(), 0, _Segment()
        for batch in batches:
            for doc_id, text in zip(*batch.columns):
                segment.add(doc_id.as_py(), text.as_py())
                if segment.full():
                    yield from segment.rows(f"{part}-{made}", n_docs, n_terms)
                    made, segment = made + 1, _Segment()
        yield from segment.rows(f"{part}-{made}", n_docs, n_terms)

    index = Scratch(docs.sparkSession, "lexical").write(map_arrow(read, run, INDEX), "index")
    return index, n_docs, n_terms


class _Best:
    """The best documents of one query so far."""

    def __init__(self, top: int):
        self.top = top
        self.scores = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int64)
        self.missing = np.zeros(0, bool)

    def worst(self) -> int:
        """What a document must reach; an equal score may still win by its id."""
        return int(self.scores[-1]) if len(self.scores) == self.top else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        scores = np.r_[self.scores, scores]
        ids, missing = np.r_[self.ids, ids], np.r_[self.missing, missing]
        best = np.lexsort((ids, missing, -scores))[: self.top]
        self.scores, self.ids, self.missing = scores[best], ids[best], missing[best]


class _List:
    """One term's postings in a segment; blocks are unpacked when asked for."""

    def __init__(self, heads: bytes, body: bytes):
        self.heads, self.body = np.frombuffer(heads, HEAD), body
        self.lasts = self.heads["last"]
        self.tops = self.heads["top"].astype(np.int64)
        self.blocks: dict[int, tuple] = {}

    def block(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        if i not in self.blocks:
            self.blocks[i] = unpack(self.heads, self.body, i)
        return self.blocks[i]

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        found = [self.block(i) for i in range(len(self.heads))]
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _search_segment(lists, query, best: _Best, m, ids, missing) -> None:
    """Offer a segment's documents to one query. `query` has (term, weight, bound) in
    ascending order of bound, the weight times the greatest impact anywhere."""
    here = [(lists[t], w, bound) for t, w, bound in query if t in lists]
    if not here:
        return
    worst = best.worst()
    bounds = np.cumsum([bound for _, _, bound in here])
    split = int(np.searchsorted(bounds, worst))  # lists below it are non-essential
    if split == len(here):
        return
    scores = np.zeros(len(m), np.int64)
    for postings, weight, _ in here[split:]:
        docs, tf = postings.all()
        scores[docs] += weight * impact(tf, m[docs])
    candidates = np.flatnonzero(scores)
    for i in range(split - 1, -1, -1):
        postings, weight, _ = here[i]
        left = int(bounds[i - 1]) if i else 0
        candidates = candidates[scores[candidates] + int(bounds[i]) >= worst]
        block = np.searchsorted(postings.lasts, candidates)
        inside = block < len(postings.lasts)
        part = np.where(inside, postings.tops[np.minimum(block, len(postings.tops) - 1)], 0)
        stays = scores[candidates] + weight * part + left >= worst
        candidates, block = candidates[stays], block[stays]
        for b in np.unique(block[block < len(postings.lasts)]).tolist():
            asked = candidates[block == b]
            docs, tf = postings.block(b)
            at = np.minimum(np.searchsorted(docs, asked), len(docs) - 1)
            hit = docs[at] == asked
            asked, at = asked[hit], at[hit]
            scores[asked] += weight * impact(tf[at], m[asked])
    candidates = candidates[(scores[candidates] >= worst) & (scores[candidates] > 0)]
    if len(candidates):
        best.add(scores[candidates], ids[candidates], missing[candidates])


def _search(queries, top: int):
    """Sorted rows of whole segments -> (query, score, doc_id) of a task's best.
    `queries` is the broadcast list of queries, for `_search_segment`."""

    def segments(batches):
        name, docs, lists = None, None, {}
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] != name:
                    if docs is not None:
                        yield docs, lists
                    name, docs, lists = row[0], None, {}
                if row[1] == b"":
                    docs = row[2:]
                else:
                    lists[row[1]] = _List(row[2], row[3])
        if docs is not None:
            yield docs, lists

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [_Best(top) for _ in queries.value]
        for (head, body), lists in segments(batches):
            missing, stored = np.frombuffer(head, bool), np.frombuffer(body, np.int64)
            ids, m = stored.reshape(2, -1)
            for query, best in zip(queries.value, found):
                _search_segment(lists, query, best, m, ids, missing)
        sizes = [len(b.scores) for b in found]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(np.arange(len(found), dtype=np.int32), sizes)),
            pa.array(np.concatenate([b.scores for b in found]), pa.int64()),
            pa.array(np.concatenate([b.ids for b in found]), pa.int64(),
                     mask=np.concatenate([b.missing for b in found])),
        ], names=["query", "score", "doc_id"])

    return run


def _query_blocks(items: DataFrame) -> Iterator[list[Row]]:
    """Items as (item_id, terms), terms once each, in blocks; the driver holds a part
    of the items at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [
                sorted(set().union(*pieces(text))) for text in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(terms, pa.list_(pa.binary()))],
                names=["item_id", "terms"],
            )

    read = items.select(F.col("item_id").cast("long"), F.col("text"))
    block, terms = [], 0
    for row in map_arrow(read, run, "item_id long, terms array<binary>").toLocalIterator():
        if block and (len(block) == QUERIES or terms + len(row["terms"]) > QUERY_TERMS):
            yield block
            block, terms = [], 0
        block.append(row)
        terms += len(row["terms"])
    if block:
        yield block


def search(
    index: DataFrame, n_docs: int, items: DataFrame, top: int = TOP
) -> DataFrame:
    """(item_id, rank, doc_id, score): the `top` best documents of every item."""
    spark = index.sparkSession
    scratch = Scratch(spark, "lexical")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    answers = [
        spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    ]
    for block in _query_blocks(items):
        terms = sorted({bytes(t) for row in block for t in row["terms"]})
        # Bounded by the block; b"" brings the documents of each segment along.
        asked = F.broadcast(spark.createDataFrame([(t,) for t in [b"", *terms]], "term binary"))
        lists = index.join(asked, "term", "left_semi")
        totals = lists.where(F.length("term") > 0).groupBy("term").agg(
            F.sum("df").alias("df"), F.max("top").alias("top")
        ).collect()
        weights = {
            bytes(r["term"]): (
                w := math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["df"] + 1))),
                w * r["top"],
            ) for r in totals
        }
        queries = spark.sparkContext.broadcast([
            sorted(((t, *weights[t]) for t in map(bytes, row["terms"]) if t in weights),
                   key=lambda list_: list_[2])
            for row in block
        ])
        in_segments = lists.select("segment", "term", "heads", "body").repartition(
            tasks, "segment"
        ).sortWithinPartitions("segment", "term")
        best = scratch.write(
            map_arrow(in_segments, _search(queries, top), "query int, score long, doc_id long"),
            "best",
        )
        queries.unpersist()
        order = Window.partitionBy("query").orderBy(
            F.desc("score"), F.asc_nulls_last("doc_id")
        )
        names = F.broadcast(spark.createDataFrame(
            [(i, row["item_id"]) for i, row in enumerate(block)], "query int, item_id long"
        ))
        answers.append(
            best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .join(names, "query").select("item_id", "rank", "doc_id", "score")
        )
    return reduce(DataFrame.unionAll, answers[1:] or answers)
