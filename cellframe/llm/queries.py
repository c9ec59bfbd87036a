"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellframe.llm import bpe, html_crf, lexical, quality, toxicity
from cellframe.llm.common import table
from cellframe.llm.ego_join import near_duplicates
from cellframe.llm.features import remainder
from cellframe.llm.line_rules import judge
from cellframe.llm.mixing import mix_plan
from cellframe.llm.ngram_join import jaccard_components
from cellframe.llm.pii import pseudonymise_documents
from cellframe.llm.prefix_trie import prefix_trie
from cellframe.llm.rlz import substring_dedup
from cellframe.llm.sharding import shard_plan

Query = Callable[[SparkSession, str], DataFrame]

BPE_RANKS = "byte_bpe_50k.tiktoken"


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded bytes of every document, as digests."""
    return bpe.round_trip(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path(BPE_RANKS),
        public_tokenizers.PATTERN,
    )


def _scored(spark: SparkSession, sf_dir: str, model, modulus: int, held: int) -> DataFrame:
    """Train on the labels outside the held-out fold, score every document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    learned = model.train(docs, labels, remainder("doc_id", modulus) != held)
    return model.score(docs, learned).select(
        "doc_id",
        F.coalesce(remainder("doc_id", modulus) == held, F.lit(False)).alias("held_out"),
        "score",
        "predicted",
    )


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return _scored(spark, sf_dir, quality, 3, 1)


def op3_embedding_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector at cosine 0.95 or more."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document."""
    return judge(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of every document by the mix."""
    return mix_plan(table(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text with pseudonyms in place of personal data."""
    return pseudonymise_documents(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that an earlier one has in the same 13-word window."""
    return substring_dedup(table(spark, sf_dir, "documents"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document."""
    return jaccard_components(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return _scored(spark, sf_dir, toxicity, 4, 2)


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages")
    return html_crf.extract(pages, html_crf.train(pages)).select(
        "page_id", "url", "text", "n_chars"
    )


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents for every benchmark item."""
    index, n_docs, _ = lexical.build_index(table(spark, sf_dir, "documents"))
    return lexical.search(index, n_docs, table(spark, sf_dir, "benchmark"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations."""
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    return shard_plan(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_byte_bpe, op2_quality, op3_embedding_join, op4_line_rules, op5_mixing, op6_pii,
        op7_substring_dedup, op8_ngram_join, op9_toxicity, op10_html_text,
        op11_lexical_search, op12_prefix_trie, op13_sharding,
    )}
