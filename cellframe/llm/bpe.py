"""Byte-level BPE: encoding by a monoid tree, decoding up the same tree.

A text is cut into pieces by the tokenizer's pattern; a piece is encoded by
halves. Two encoded neighbours are joined by encoding again a window around
their border, which doubles until the tokens outside it are stable. Merges go
by rank alone, so a sequence of tokens is the encoding of its bytes exactly
when every pair of neighbours is: `encode(a + b) == [a, b]`. Pairs inside either
side and inside the window hold already, so the two pairs at the window's ends
prove the whole. Empty sequences are the neutral element, and joining is
associative since its result depends on the bytes alone.

A text may be cut before any space that follows a character other than white
space: the pattern lets a space only begin a piece. Those chunks are what the
bounded cache of a task keeps.

Null text counts as empty: no tokens. Text of any length is one document in one
task; work and memory grow with its length, long pieces included.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Callable, Sequence

import numpy as np
import regex
from pyspark.sql import DataFrame

from cellframe.llm.common import map_columns

# Pieces up to this many bytes are merged directly, without halving.
LEAF_BYTES = 32
# Tokens decoded at once in a leaf of the decoding tree.
LEAF_TOKENS = 4096
# Entries kept of pieces and of chunks; a full cache starts anew. The second pair
# holds where the encoder is given back after each task.
PIECES_KEPT, CHUNKS_KEPT = 300_000, 200_000
PIECES_OF_TASK, CHUNKS_OF_TASK = 80_000, 50_000

Ranks = dict[bytes, int]


def read_ranks(path: str) -> Ranks:
    """A rank file: one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {
            base64.b64decode(token): int(rank)
            for token, rank in (line.split() for line in lines if line.strip())
        }


def merge(ranks: Ranks, data: bytes) -> list[bytes]:
    """Plain BPE: merge the lowest-ranked pair, the leftmost first."""
    if data in ranks:
        return [data]
    if len(data) > 4 * LEAF_BYTES:
        return _merge_queued(ranks, data)
    parts = [data[i : i + 1] for i in range(len(data))]
    pairs = [ranks.get(data[i : i + 2], _NONE) for i in range(len(data) - 1)]
    while pairs:
        best = min(pairs)
        if best == _NONE:
            break
        i = pairs.index(best)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], _NONE)
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], _NONE)
    return parts


_NONE = 1 << 62


def _merge_queued(ranks: Ranks, data: bytes) -> list[bytes]:
    """The same for long windows: a queue of pairs, n log n."""
    n = len(data)
    end = list(range(1, n + 1))  # part starting at i covers data[i:end[i]]
    before = list(range(-1, n - 1))
    queue = []

    def offer(i: int) -> None:
        if i >= 0 and end[i] < n:
            stop = end[end[i]]
            rank = ranks.get(data[i:stop])
            if rank is not None:
                heapq.heappush(queue, (rank, i, end[i], stop))

    for i in range(n - 1):
        offer(i)
    alive = bytearray(b"\1") * n
    while queue:
        _, i, middle, stop = heapq.heappop(queue)
        if not alive[i] or end[i] != middle or end[middle] != stop:
            continue
        alive[middle] = 0
        end[i] = stop
        if stop < n:
            before[stop] = i
        offer(i)
        offer(before[i])
    parts, i = [], 0
    while i < n:
        parts.append(data[i : end[i]])
        i = end[i]
    return parts


def join(ranks: Ranks, left: list[bytes], right: list[bytes]) -> list[bytes]:
    """The encoding of two encoded neighbours: the monoid's operation."""
    if not left or not right:
        return left + right

    def stable(a: Sequence[bytes], b: Sequence[bytes]) -> bool:
        return not a or not b or merge(ranks, a[-1] + b[0]) == [a[-1], b[0]]

    if stable(left, right):
        return left + right
    reach = 1
    while True:
        head, tail = left[:-reach], right[reach:]
        window = merge(ranks, b"".join(left[-reach:] + right[:reach]))
        if stable(head, window) and stable(window, tail):
            return head + window + tail
        reach *= 2


def encode_piece(ranks: Ranks, data: bytes) -> list[bytes]:
    """Tokens of one piece, by halves."""
    if len(data) <= LEAF_BYTES:
        return merge(ranks, data) if data else []
    middle = len(data) // 2
    return join(
        ranks, encode_piece(ranks, data[:middle]), encode_piece(ranks, data[middle:])
    )


def decode(tokens: Sequence[bytes], ids: Sequence[int]) -> bytes:
    """Bytes of a sequence of ids, concatenated up the tree."""
    if len(ids) <= LEAF_TOKENS:
        return b"".join([tokens[i] for i in ids])
    level = [
        b"".join([tokens[i] for i in ids[at : at + LEAF_TOKENS]])
        for at in range(0, len(ids), LEAF_TOKENS)
    ]
    while len(level) > 1:
        level = [b"".join(level[at : at + 2]) for at in range(0, len(level), 2)]
    return level[0]


class _Cache(dict):
    def __init__(self, make: Callable, most: int):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.make(key)
        return value


# A space may start a new chunk when anything but white space stands before it.
_CHUNK = re.compile(r"(?<=\S) ")


class Encoder:
    """Texts to ids, packed as little-endian unsigned 32-bit numbers."""

    def __init__(
        self, ranks: Ranks, pattern: str, pieces: int = PIECES_KEPT, chunks: int = CHUNKS_KEPT
    ):
        self.ranks = ranks
        self.tokens: list[bytes] = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self._split = regex.compile(pattern).findall
        self._packed = {t: r.to_bytes(4, "little") for t, r in ranks.items()}
        self._pieces = _Cache(self._piece, pieces)
        self._first = _Cache(self._chunk, chunks // 10)
        self._later = _Cache(lambda chunk: self._chunk(" " + chunk), chunks)

    def _piece(self, piece: str) -> bytes:
        parts = encode_piece(self.ranks, piece.encode())
        return b"".join([self._packed[part] for part in parts])

    def _chunk(self, chunk: str) -> bytes:
        return b"".join([self._pieces[piece] for piece in self._split(chunk)])

    def encode(self, text: str) -> bytes:
        chunks = _CHUNK.split(text)
        first = self._first[chunks[0]]
        del chunks[0]
        return first + b"".join(map(self._later.__getitem__, chunks))

    def decode(self, packed: bytes) -> bytes:
        return decode(self.tokens, np.frombuffer(packed, "<u4").tolist())


# The encoder that a worker process keeps from task to task, if asked to.
_kept: dict[tuple[str, str], Encoder] = {}


def _shared(
    docs: DataFrame, path: str, pattern: str, keep: bool = False
) -> tuple[Callable[[], Encoder], list]:
    """The tokenizer of a task, and the list that holds it until the task ends. The
    driver reads the file, whose size does not grow with the corpus, and sends its
    ranks. `keep` lets a worker keep it for its next tasks: faster, for its memory."""
    sent = docs.sparkSession.sparkContext.broadcast(read_ranks(path))
    own: list[Encoder] = []

    def encoder() -> Encoder:
        if not own:
            if keep:
                found = _kept.get((path, pattern)) or Encoder(sent.value, pattern)
                _kept[path, pattern] = found
            else:
                found = Encoder(sent.value, pattern, PIECES_OF_TASK, CHUNKS_OF_TASK)
            own.append(found)
        return own[0]

    return encoder, own


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, token_ids) of every document; whole texts."""
    encoder, own = _shared(docs, path, pattern)

    def run(ids: list, texts: list) -> list[list]:
        packed = [encoder().encode(text or "") for text in texts]
        numbers = [np.frombuffer(p, "<u4").astype(np.int32) for p in packed]
        return [ids, [len(n) for n in numbers], numbers]

    return map_columns(
        docs.select("doc_id", "text"),
        "doc_id long, n_tokens long, token_ids array<int>",
        run,
        [own],
    )


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, text) from (doc_id, token_ids): the way back."""
    encoder, own = _shared(encoded, path, pattern)

    def run(ids: list, tokens: list) -> list[list]:
        table = encoder().tokens
        return [ids, [decode(table, t or []).decode(errors="replace") for t in tokens]]

    return map_columns(
        encoded.select("doc_id", "token_ids"), "doc_id long, text string", run, [own]
    )


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode and decode in one pass: lengths and digests of ids and bytes."""
    encoder, own = _shared(docs, path, pattern, keep=True)

    def run(ids: list, texts: list) -> list[list]:
        tokenizer = encoder()
        counts, id_digests, byte_digests = [], [], []
        for text in texts:
            packed = tokenizer.encode(text or "")
            counts.append(len(packed) // 4)
            id_digests.append(hashlib.sha256(packed).hexdigest())
            byte_digests.append(hashlib.sha256(tokenizer.decode(packed)).hexdigest())
        return [ids, counts, id_digests, byte_digests]

    return map_columns(
        docs.select("doc_id", "text"),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
        run,
        [own],
    )
