"""Toxicity: logistic regression by FTRL-proximal over hashed word n-grams.

Features are the presence of words, of their stems (the first `STEMS` bytes of a
longer word, so that inflections and compounds share evidence), of pairs and
triples of neighbours and of pairs with one word between them, hashed into 2**20
slots; slots that fewer than `MIN_DOCS` sampled documents hold are not learned. Every weight has its own
learning rate (from the sum of its squared gradients) and an L1 threshold that
leaves most weights exactly 0, so a long harmless text gathers no score and the
model sent to the tasks is a short list of slots and weights.

The parameters were chosen on a split of the training rows alone: a quarter of them by
crc32(doc_id and "v"), the others learned from. Rows outside of a caller's `where` had
no part in it.

Words are compared in lower case without ASCII punctuation. Labels are learned
from a bounded sample (`SAMPLE_ROWS` labelled rows), whose features alone reach the driver.

Null or empty text has no features: its score is that of the bias. Repeated rows
are scored alike. Without labels of both classes every score is the base rate
(0.5 when there is none). An empty table gives none.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame

from cellframe.llm.common import map_columns
from cellframe.llm.features import WordHash, labelled_sample

#: At most so many labelled rows are learned from, about 6 KB of slots each.
SAMPLE_ROWS = 10_000
SLOT_BITS = 20
ALPHA, BETA, L1, L2 = 0.5, 1.0, 15.0, 0.1
EPOCHS = 8
MIN_DOCS = 8
STEMS = (4, 6, 8)
THRESHOLD = 0.3

_PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_PLAIN = bytes(
    32 if c in _PUNCTUATION else c + 32 if 65 <= c <= 90 else c for c in range(256)
)
# Odd multipliers that tell the kinds of n-gram and their places apart.
_A, _B, _C, _D = (np.uint64(m) for m in (
    0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
))
_SHIFT = np.uint64(64 - SLOT_BITS)


def slots(text: str | None, hashes: WordHash) -> np.ndarray:
    """Slot of every n-gram of a text, repeats included."""
    words = text.encode().translate(_PLAIN).split() if text else []
    h = hashes.array(words)
    pairs = h[:-1] * _A + h[1:] * _B
    stems = [
        hashes.array([w[:n] for w in words if len(w) > n]) * _A + np.uint64(n)
        for n in STEMS
    ]
    grams = (h * _D, *(s * _B for s in stems), pairs * _C, (pairs[:-1] + h[2:] * _C) * _D, (h[:-2] * _B + h[2:] * _A) * _C)
    return (np.concatenate(grams) >> _SHIFT).astype(np.int64)


@dataclass(frozen=True)
class Weights:
    """The non-zero weights: sorted slots, their weights, the bias."""

    slots: np.ndarray
    values: np.ndarray
    bias: float

    def scorer(self):
        """A function text -> score for one worker."""
        dense = np.zeros(1 << SLOT_BITS, np.float32)
        dense[self.slots] = self.values
        hashes = WordHash()

        def score(text: str | None) -> float:
            found = slots(text, hashes)
            found = np.unique(found[dense[found] != 0])
            return float(_sigmoid(self.bias + dense[found].sum(dtype=np.float64)))

        return score


def _sigmoid(x: float) -> float:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit(samples: list[tuple[np.ndarray, int]], epochs: int = EPOCHS) -> Weights:
    """FTRL-proximal over (distinct slots, label), in the order given."""
    size = 1 << SLOT_BITS
    z, n = np.zeros(size + 1), np.zeros(size + 1)  # the last one is the bias
    l1 = np.full(size + 1, L1)
    l1[size] = 0.0
    positive = sum(y for _, y in samples)
    if not 0 < positive < len(samples):
        rate = (positive + 0.5) / (len(samples) + 1)
        empty = np.zeros(0, np.int64)
        return Weights(empty, np.zeros(0, np.float32), float(np.log(rate / (1 - rate))))

    held = np.bincount(np.concatenate([f for f, _ in samples]), minlength=size)
    samples = [(f[held[f] >= MIN_DOCS], y) for f, y in samples]

    def weights(at: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z[at]) * l1[at] - z[at]
        return np.where(
            np.abs(z[at]) <= l1[at], 0.0, shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        )

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(samples)):
            found, label = samples[i]
            at = np.append(found, size)
            w = weights(at)
            gradient = _sigmoid(w.sum()) - label
            rate = (np.sqrt(n[at] + gradient * gradient) - np.sqrt(n[at])) / ALPHA
            z[at] += gradient - rate * w
            n[at] += gradient * gradient
    used = np.flatnonzero(np.abs(z[:size]) > L1)
    values = weights(used)
    return Weights(used, values.astype(np.float32), float(weights(np.array([size]))[0]))


def train(
    docs: DataFrame, labels: DataFrame, where: Column, rows: int = SAMPLE_ROWS
) -> Weights:
    """Learn `toxic` from at most `rows` labelled documents that `where` admits."""

    def run(ids: list, marks: list, texts: list) -> list[list]:
        hashes = WordHash()
        found = [np.unique(slots(t, hashes)).astype(np.int32) for t in texts]
        return [ids, marks, [f.tobytes() for f in found]]

    sample = labelled_sample(docs, labels, "toxic", where, rows)
    got = map_columns(
        sample.select("doc_id", "label", "text"),
        "doc_id long, label int, slots binary",
        run,
    ).orderBy("doc_id").toArrow()
    return fit([
        (np.frombuffer(s, np.int32), y)
        for s, y in zip(got["slots"].to_pylist(), got["label"].to_pylist())
    ])


def score(docs: DataFrame, model: Weights, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted) of every document; whole texts, one pass."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    cached: list = []

    def run(ids: list, texts: list) -> list[list]:
        if not cached:
            cached.append(sent.value.scorer())
        scores = [cached[0](t) for t in texts]
        return [ids, scores, [int(s >= threshold) for s in scores]]

    return map_columns(
        docs.select("doc_id", "text"), "doc_id long, score double, predicted int", run, [cached]
    )
