"""The registered queries over whole tables, and the pipeline."""

import hashlib
import struct
from collections import Counter

import duckdb
import plain
import public_tokenizers
import pytest
import tiktoken

import __spark_entry__ as entry_points
import corpus_pipeline
from cellframe.llm import bpe, oracle, pii, queries
from cellframe.llm.features import remainder

TINY, SMALL = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def reference():
    ranks = bpe.read_ranks(public_tokenizers.path(queries.BPE_RANKS))
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def texts(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] for r in rows}


def test_all_are_registered():
    found = entry_points.queries()
    numbers = sorted(int(n[2:].split("_")[0]) for n in found if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in found
    assert set(entry_points.oracle_sql()) <= set(found)


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_sql_twins(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark", "conversations", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    theirs = duck.sql(oracle.SQL[name])
    ours = queries.queries()[name](spark, SMALL)
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    expected = Counter(theirs.select(*[f'"{c}"' for c in columns]).fetchall())
    assert Counter(tuple(r) for r in ours.select(*columns).collect()) == expected


def test_op1(spark, reference):
    docs = texts(spark, TINY)
    rows = queries.op1_byte_bpe(spark, TINY).collect()
    assert len(rows) == len(docs)
    for r in rows:
        text = docs[r["doc_id"]] or ""
        ids = reference.encode_ordinary(text)
        packed = b"".join(struct.pack("<I", i) for i in ids)
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(text.encode()).hexdigest()
        )


@pytest.mark.parametrize("query, label, modulus, held", [
    (queries.op2_quality, "quality", 3, 1), (queries.op9_toxicity, "toxic", 4, 2),
])
def test_op2_op9(spark, query, label, modulus, held):
    rows = query(spark, SMALL).collect()
    assert len(rows) == len(texts(spark, SMALL))
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").withColumn("r", remainder("doc_id", modulus))
    marks = {r["doc_id"]: (r[label], r["r"] == held) for r in labels.collect()}
    right = [
        r["predicted"] == marks[r["doc_id"]][0] for r in rows
        if r["held_out"] and r["doc_id"] in marks
    ]
    assert all(r["held_out"] == marks[r["doc_id"]][1] for r in rows if r["doc_id"] in marks)
    assert sum(right) > 0.9 * len(right)


def test_op3(spark):
    table = spark.read.parquet(f"{TINY}/embeddings.parquet").collect()
    expected = plain.vector_links({r["vec_id"]: list(r["embedding"]) for r in table})
    rows = queries.op3_embedding_join(spark, TINY).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in rows} == expected


def test_op6_leaves_nothing_of_what_it_finds(spark):
    docs = texts(spark, TINY)
    for r in queries.op6_pii(spark, TINY).collect():
        old, new = docs[r["doc_id"]], r["text"]
        if r["n_found"] == 0:
            assert old == new
            continue
        for span in r["kinds"]:
            kind, start, size = span.split(":")
            assert new[int(start) : int(start) + int(size)] not in old


def test_op7(spark):
    rows = queries.op7_substring_dedup(spark, SMALL).collect()
    assert {r[0]: tuple(r[1:]) for r in rows} == plain.substring_dedup(texts(spark, SMALL))


def test_op8(spark):
    rows = queries.op8_ngram_join(spark, TINY).collect()
    assert {r[0]: tuple(r[1:]) for r in rows} == plain.jaccard_components(texts(spark, TINY))


def test_op10(spark):
    rows = queries.op10_html_text(spark, TINY).collect()
    assert len(rows) == spark.read.parquet(f"{TINY}/pages.parquet").count()
    assert all(r["n_chars"] == len(r["text"]) for r in rows)


def test_stages_keep_the_columns(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "n-gram Jaccard join", "PII", "mixing", "byte-level BPE",
    ]
    none = spark.read.parquet(f"{TINY}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, none, TINY)
        assert found.columns == none.columns and found.count() == 0


def test_pipeline_against_a_plain_one(spark, reference):
    docs = spark.read.parquet(f"{TINY}/documents.parquet").collect()
    rows = [(r["doc_id"], r["source"], r["text"]) for r in docs]
    kept = plain.line_verdicts(rows, 20, 0.01, 0.5)
    rows = [(i, s, plain.without_lines(rows, i, 20, 0.01)) for i, s, _ in rows if kept[i]]
    groups = plain.jaccard_components({i: t for i, _, t in rows})
    rows = [r for r in rows if groups[r[0]][1] == r[0]]
    rows = [(i, s, pii.pseudonymise(t, pii.session_key(spark))[0]) for i, s, t in rows]
    duck = duckdb.connect()
    duck.execute("CREATE TABLE left_over (doc_id BIGINT, source VARCHAR, text VARCHAR)")
    duck.executemany("INSERT INTO left_over VALUES (?, ?, ?)", rows)
    plan = duck.sql(
        f"SELECT doc_id, size, taken FROM ({oracle.mixing_sql('left_over')})"
    ).fetchall()
    text = {i: t for i, _, t in rows}
    expected = Counter()
    for i, size, taken in plan:
        ids = tuple(reference.encode_ordinary(text[i]))
        copies = int(taken / size + 0.5) if size else 0
        expected += Counter({(i, len(ids), ids): copies})
    got = corpus_pipeline.run(spark, TINY).collect()
    assert Counter((r["doc_id"], r["n_tokens"], tuple(r["token_ids"])) for r in got) == expected
