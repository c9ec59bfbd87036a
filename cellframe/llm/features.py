"""Helpers of the two text classifiers: labelled samples, splits, hashing."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellframe.llm.common import same


def remainder(column: str, modulus: int) -> Column:
    """crc32 of a number's text modulo `modulus`; null for null."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(modulus))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, where: Column, rows: int,
    inputs: Sequence[str] = ("text",),
) -> DataFrame:
    """Up to `rows` labelled documents: (doc_id, label, the `inputs` of `docs`).

    They are the first by a hash of doc_id among the labels that `where` admits;
    the hash order makes them a random sample that every run repeats. The list
    of ids is bounded by `rows`, so it is sent to the scan of the documents. Of
    rows that share a doc_id one is taken, the first by a hash of its text, before
    and after the shuffle, so the sample is bounded whatever the table holds.
    """
    chosen = (
        labels.where(where & F.col(label).isin(0, 1))
        .groupBy("doc_id").agg(F.max(label).alias("marked"))
        .orderBy(F.xxhash64(F.col("doc_id"), F.lit(17)), "doc_id")
        .limit(rows)
        .select(F.col("doc_id").alias("marked_id"), "marked")
    )
    own = docs.select(
        F.col("doc_id").alias("own_id"), F.struct(*[docs[f"`{c}`"] for c in inputs]).alias("own")
    )
    return (
        own.join(F.broadcast(chosen), same(F.col("own_id"), F.col("marked_id")))
        .groupBy("own_id")
        .agg(
            F.min_by("own", F.xxhash64("own")).alias("own"),
            F.max("marked").alias("marked"),
        )
        .select(
            F.col("own_id").alias("doc_id"), F.col("marked").alias("label"),
            *[F.col(f"own.`{c}`") for c in inputs],
        )
    )


class WordHash(dict):
    """Word -> 64-bit hash; starts anew when full."""

    MOST = 150_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.MOST:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def array(self, words) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def auc(scores: np.ndarray, labels: np.ndarray) -> float:
    """Area under the ROC curve, ties counted half."""
    order = np.argsort(scores, kind="stable")
    _, start, count = np.unique(scores[order], return_index=True, return_counts=True)
    ranks = np.empty(len(scores))
    ranks[order] = np.repeat(start + (count + 1) / 2, count)
    positive = labels == 1
    n = positive.sum()
    return (ranks[positive].sum() - n * (n + 1) / 2) / (n * (len(labels) - n))
