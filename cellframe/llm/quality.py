"""Quality: a factorisation machine over words, structure and metadata.

A document is a sparse vector: its distinct words (hashed, lower case), its
structure statistics (each cut into bins, one feature a bin) and the bin of its
declared length. Score: sigmoid(w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j),
the pairs summed in linear time as (|sum v_i x_i|^2 - sum |v_i x_i|^2) / 2. Low rank makes
pairs that never met in training comparable: a symbol-ridden shape and a word
it likes have vectors of their own.

Words share unit length (value 1 / sqrt(count)), so the length of a text alone
moves nothing. Labels are learned from a bounded sample (`SAMPLE_ROWS`); its
features alone reach the driver. Labels, lang, source and doc_id are no inputs.

Null or empty text: no words and the lowest bins. Null n_chars: a bin of its own.
Repeated rows are scored alike. Without labels of both classes every score is
the base rate (0.5 when there is none). An empty table gives none.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame

from cellframe.llm.common import map_columns
from cellframe.llm.features import WordHash, labelled_sample

#: At most so many labelled rows are learned from, about 3 KB of features each.
SAMPLE_ROWS = 6_000
SLOT_BITS = 16
RANK = 8
EPOCHS = 8
RATE = 0.05
DECAY = 1e-4
THRESHOLD = 0.5

_LOWER = bytes(range(97, 123))
_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_SYMBOLS = b"#*$%&|<>"
_OTHER = bytes(c for c in range(33, 127)
               if c not in _LOWER + _UPPER + _DIGITS + _SYMBOLS)
# Structure statistics come first, each with its own slots; words come after.
BINS = 8
STATISTICS = 11
FIRST_WORD = (STATISTICS + 1) * BINS + BINS * 3
SIZE = FIRST_WORD + (1 << SLOT_BITS)
_WORD_MASK = np.uint64((1 << SLOT_BITS) - 1)
_WORD_SHIFT = np.uint64(64 - SLOT_BITS)


def _bin(ratio: float) -> int:
    """0 for nothing, then finer near 0 and near 1 by square root."""
    return 0 if ratio <= 0 else min(BINS - 1, 1 + int(math.sqrt(min(ratio, 1)) * (BINS - 1)))


def _log_bin(count: float, bins: int = BINS, step: float = 1.0) -> int:
    return min(bins - 1, int(math.log2(1 + max(count, 0)) / step))


def structure(text: str, words: list[bytes], distinct: int) -> list[int]:
    """The slot of every structure statistic of a text."""
    raw = text.encode()
    size = max(len(raw), 1)
    n = max(len(words), 1)

    def share(of: bytes) -> float:
        return (len(raw) - len(raw.translate(None, of))) / size

    lines = [line for line in text.split("\n") if line.strip()]
    same_lines = 1 - len(set(lines)) / len(lines) if lines else 0
    triples = len(words) - 2
    same_triples = (
        1 - len(set(zip(words, words[1:], words[2:]))) / triples if triples > 0 else 0
    )
    bins = [
        _bin(share(_SYMBOLS)), _bin(share(_UPPER)), _bin(share(_DIGITS)),
        _bin(share(_OTHER)), _bin(same_lines), _bin(same_triples),
        _bin(1 - distinct / n), _log_bin(len(words), step=2.0),
        _log_bin(len(lines)), _log_bin(size / n, step=0.7),
        _log_bin(len(words) / max(len(lines), 1)),
    ]
    return [place * BINS + b for place, b in enumerate(bins)]


def features(
    text: str | None, n_chars: int | None, hashes: WordHash
) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of a document."""
    text = text or ""
    words = text.encode().split()
    distinct = set(text.lower().encode().split())
    fixed = structure(text, words, len(distinct))
    declared = 0 if n_chars is None else 1 + _log_bin(n_chars, 3 * BINS - 1)
    fixed.append(STATISTICS * BINS + declared)
    hashed = np.unique((hashes.array(distinct) >> _WORD_SHIFT) & _WORD_MASK).astype(np.int64)
    at = np.concatenate([np.array(fixed, np.int64), hashed + FIRST_WORD])
    x = np.full(len(at), 1 / math.sqrt(max(len(hashed), 1)))
    x[: len(fixed)] = 1 / math.sqrt(len(fixed))
    return at, x


@dataclass(frozen=True)
class Machine:
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def raw(self, at: np.ndarray, x: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Score before the sigmoid; the weighted vectors and their sum."""
        parts = self.vectors[at] * x[:, None]
        total = parts.sum(axis=0)
        pairs = 0.5 * (total @ total - np.einsum("ij,ij->", parts, parts))
        return self.bias + float(self.weights[at] @ x) + float(pairs), parts, total

    def score(self, at: np.ndarray, x: np.ndarray) -> float:
        value = self.raw(at, x)[0]
        return 1 / (1 + math.exp(-min(max(value, -35.0), 35.0)))


def fit(samples: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS) -> Machine:
    """Adagrad over the log loss, one document at a time, in a seeded order."""
    seed = np.random.default_rng(11)
    weights = np.zeros(SIZE)
    vectors = seed.normal(0, 0.05, (SIZE, RANK))
    positive = sum(y for _, _, y in samples)
    rate = (positive + 0.5) / (len(samples) + 1)
    bias = math.log(rate / (1 - rate))
    if not 0 < positive < len(samples):
        return Machine(bias, weights, np.zeros((SIZE, RANK), np.float32))
    seen_w, seen_v = np.full(SIZE, 1e-2), np.full((SIZE, RANK), 1e-2)
    for _ in range(epochs):
        for i in seed.permutation(len(samples)):
            at, x, label = samples[i]
            value, parts, total = Machine(bias, weights, vectors).raw(at, x)
            slope = 1 / (1 + math.exp(-min(max(value, -35.0), 35.0))) - label
            bias -= 0.01 * slope
            step = slope * x + DECAY * weights[at]
            seen_w[at] += step * step
            weights[at] -= RATE * step / np.sqrt(seen_w[at])
            turn = slope * x[:, None] * (total - parts) + DECAY * vectors[at]
            seen_v[at] += turn * turn
            vectors[at] -= RATE * turn / np.sqrt(seen_v[at])
    return Machine(bias, weights.astype(np.float32), vectors.astype(np.float32))


def train(
    docs: DataFrame, labels: DataFrame, where: Column, rows: int = SAMPLE_ROWS
) -> Machine:
    """Learn `quality` from at most `rows` labelled documents that `where` admits."""

    def run(ids: list, marks: list, texts: list, lengths: list) -> list[list]:
        hashes = WordHash()
        found = [features(t, n, hashes) for t, n in zip(texts, lengths)]
        return [ids, marks, [a.astype(np.int32).tobytes() for a, _ in found],
                [x.astype(np.float32).tobytes() for _, x in found]]

    sample = labelled_sample(docs, labels, "quality", where, rows, ("text", "n_chars"))
    got = map_columns(
        sample.select("doc_id", "label", "text", "n_chars"),
        "doc_id long, label int, slots binary, x binary",
        run,
    ).orderBy("doc_id").toArrow()
    return fit([
        (np.frombuffer(a, np.int32).astype(np.int64), np.frombuffer(x, np.float32), y)
        for a, x, y in zip(*(got[c].to_pylist() for c in ("slots", "x", "label")))
    ])


def score(docs: DataFrame, model: Machine, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted) of every document; whole texts, one pass."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    hashes = WordHash()

    def run(ids: list, texts: list, lengths: list) -> list[list]:
        machine = sent.value
        scores = [machine.score(*features(t, n, hashes)) for t, n in zip(texts, lengths)]
        return [ids, scores, [int(s >= threshold) for s in scores]]

    return map_columns(
        docs.select("doc_id", "text", "n_chars"),
        "doc_id long, score double, predicted int",
        run,
        [hashes],
    )
