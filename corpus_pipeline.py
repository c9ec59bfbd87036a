"""From raw documents to token ids, in stages that are written and reread."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cellframe.llm.bpe import encode_documents
from cellframe.llm.common import Scratch, table
from cellframe.llm.line_rules import keep_documents
from cellframe.llm.mixing import mix_documents
from cellframe.llm.ngram_join import one_of_each
from cellframe.llm.pii import replace_texts
from cellframe.llm.queries import BPE_RANKS

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or line frequency reject go; the others lose
    their frequent lines."""
    return keep_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones stays."""
    return one_of_each(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts become pseudonyms."""
    return replace_texts(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mix_documents(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix: (doc_id, n_tokens, token_ids)."""
    return encode_documents(
        docs, public_tokenizers.path(BPE_RANKS), public_tokenizers.PATTERN
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("PII", pii),
    ("mixing", mixing),
    ("byte-level BPE", encoding),
]

# No SQL engine has the Feistel permutations or the merges of stages 3 and 5: the
# tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each one's result is written, then reread. What a
    stage has written besides goes when its result is there, and that of the stage
    before it, too."""
    docs = table(spark, sf_dir, "documents")
    scratch, before = Scratch(spark, "pipeline"), Scratch.mark()
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        Scratch.release(spark, before, [scratch.path(docs)])
    return docs
