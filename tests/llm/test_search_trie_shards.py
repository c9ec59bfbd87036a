import random
from collections import Counter, defaultdict

import numpy as np
import plain
import pytest

from cellframe.llm import lexical, prefix_trie, sharding


# -- ranked lexical search ----------------------------------------------------------


def test_pieces_are_the_terms_of_the_whole_text(monkeypatch):
    text = "Ab-c1 ÉA_b\n0x\x7f¡z" * 50
    whole = [t for p in lexical.pieces(text) for t in p]
    for size in (1, 5, 30):
        monkeypatch.setattr(lexical, "PIECE", size)
        assert [t for p in lexical.pieces(text) for t in p] == whole
    assert Counter(whole) == Counter(
        t.encode() for t in ["ab", "c1", "Éa", "b", "0x"] for _ in range(50)
    ) - Counter({b"ab": 49}) + Counter({"¡zab".encode(): 49, "¡z".encode(): 1})
    assert list(lexical.pieces(None)) == [[]]


@pytest.mark.parametrize("block", [1, 3, 128])
def test_pack_and_unpack(monkeypatch, block):
    monkeypatch.setattr(lexical, "BLOCK", block)
    pick = np.random.default_rng(block)
    lists = [np.sort(pick.choice(60_000, n, replace=False)) for n in (1, 2, 3, 400, 5000)]
    term = np.repeat(np.arange(5), [len(x) for x in lists])
    doc = np.concatenate(lists)
    tf = pick.choice([1, 2, 255, 256, 70_000, 1 << 25], len(doc))
    df, top, heads, body = lexical.pack(term, doc, tf, tf)
    assert df.tolist() == [len(x) for x in lists]
    for t in range(5):
        docs, counts = lexical._List(heads[t], body[t]).all()
        assert (docs == lists[t]).all() and (counts == tf[term == t]).all()
        assert top[t] == tf[term == t].max()


def corpus(seed, n):
    pick = random.Random(seed)
    words = [f"w{i}" for i in range(120)]
    weights = [1 / (i + 1) for i in range(120)]
    docs = [
        (pick.choice([i, i, i, None, 7]),
         " ".join(pick.choices(words, weights, k=pick.choice([1, 5, 40, 300]))))
        for i in range(n)
    ] + [(n, None), (n + 1, ""), (n + 2, "- ."), (n + 3, "W1 w2,W3")]
    items = [(i, " ".join(pick.choices(words, k=pick.randint(1, 12)))) for i in range(25)]
    return docs, items + [(25, None), (26, "--"), (27, "unknown"), (28, " ".join(words))]


@pytest.mark.parametrize("seed, docs, block, top", [(1, 50, 4, 5), (2, 7, 2, 50), (3, 400, 16, 3)])
def test_search(spark, monkeypatch, seed, docs, block, top):
    monkeypatch.setattr(lexical, "SEGMENT_DOCS", docs)
    monkeypatch.setattr(lexical, "BLOCK", block)
    monkeypatch.setattr(lexical, "QUERIES", 10)
    rows, items = corpus(seed, 300)
    table = spark.createDataFrame(
        [(*r, "x") for r in rows], "doc_id long, text string, term string"
    ).repartition(3)
    asked = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, score int")
    index, n_docs, _ = lexical.build_index(table)
    got = defaultdict(list)
    for r in lexical.search(index, n_docs, asked, top).orderBy("item_id", "rank").collect():
        got[r["item_id"]].append((r["doc_id"], r["score"]))
        assert r["rank"] == len(got[r["item_id"]])
    expected = plain.search(rows, items, top)
    assert got == {i: found for i, found in expected.items() if found}


def test_blocks_are_rejected_before_they_are_unpacked(monkeypatch):
    """A frequent term's blocks are only read where a candidate is."""
    n = 20_000
    docs = np.arange(n)
    common = lexical.pack(np.zeros(n, int), docs, np.ones(n, int), np.full(n, 100))
    rare_docs = np.array([5, 9000, 19_999])
    rare = lexical.pack(np.zeros(3, int), rare_docs, np.ones(3, int), np.full(3, 100))
    lists = {b"c": lexical._List(common[2][0], common[3][0]),
             b"r": lexical._List(rare[2][0], rare[3][0])}
    best = lexical._Best(2)
    best.add(np.array([9_000_000, 9_000_000]), np.array([-1, -2]), np.zeros(2, bool))
    m = np.full(n, 50)
    part = int(lexical.impact(np.array([1]), np.array([50]))[0])
    query = [(b"c", 1, part), (b"r", 1000, 1000 * part)]
    lexical._search_segment(lists, query, best, m, docs, np.zeros(n, bool))
    assert len(lists[b"c"].blocks) == 3 and set(best.ids) == {5, 9000}


def test_search_without_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    index, n_docs, n_terms = lexical.build_index(none)
    assert (n_docs, n_terms) == (0, 0)
    found = lexical.search(index, n_docs, items)
    assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.count() == 0
    assert lexical.search(index, n_docs, items.limit(0)).count() == 0


# -- conversation prefix trie -------------------------------------------------------


def conversations(seed, n):
    pick = random.Random(seed)
    texts = ["a b", "c", "", None, "d e f", "a b "]
    rows = []
    for c in [*range(n), *range(-45, 0)]:
        for turn in range(pick.choice([1, 1, 2, 3, 6])):
            rows.append((c, turn, pick.choice(["user", "x", None]), pick.choice(texts[: 2 + turn])))
        if pick.random() < 0.1:
            rows.append((c, None, "system", pick.choice(texts)))
        if pick.random() < 0.1:
            rows.append(rows[-1])
    return rows + [(None, 0, "user", "lost")]


@pytest.mark.parametrize("seed, n, shards", [(1, 120, 500_000), (2, 400, 3), (3, 60, 1)])
def test_prefix_trie(spark, monkeypatch, seed, n, shards):
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", shards)
    monkeypatch.setattr(prefix_trie, "IDS", 3)
    rows = conversations(seed, n)
    table = spark.createDataFrame(
        [(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, depth int"
    ).repartition(5)
    got = sorted((tuple(r) for r in prefix_trie.prefix_trie(table).collect()), key=repr)
    assert got == plain.prefix_trie(rows)


def test_prefix_trie_of_copies_and_deep_ones(spark):
    """One conversation many times, and long ones that part late."""
    rows = [(c, t, "u", f"t{t}") for c in range(0, 2000, 20) for t in range(3)]
    rows += [(c, t, "u", f"deep {t}" if t < 250 else f"{c} {t}") for c in (3, 7, 11) for t in range(260)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted((tuple(r) for r in prefix_trie.prefix_trie(table).collect()), key=repr)
    assert got == plain.prefix_trie(rows)


def test_prefix_trie_turnless_and_empty(spark):
    kind = "conv_id long, turn long, role string, text string"
    rows = [(c, 0, "u", "only") for c in range(1, 20)]  # their base 0 is absent
    got = sorted((tuple(r) for r in prefix_trie.prefix_trie(spark.createDataFrame(rows, kind)).collect()), key=repr)
    assert got == plain.prefix_trie(rows)
    assert prefix_trie.prefix_trie(spark.createDataFrame([], kind)).count() == 0


def test_the_skeleton_has_what_spans_shards():
    splits = [b"a" * 16 + b"b" * 16, b"c" * 16]
    nodes = prefix_trie.skeleton(splits)
    assert set(nodes) == {b"", b"a" * 16, b"a" * 16 + b"b" * 16, b"c" * 16}
    assert prefix_trie._shared(b"a" * 32, b"a" * 16 + b"b" * 16) == 1
    assert prefix_trie._shared(b"", b"a" * 16) == 0 and prefix_trie._shared(b"a" * 16, b"a" * 32) == 1


# -- sharding -----------------------------------------------------------------------


def mixture(seed, n):
    pick = random.Random(seed)
    rows = []
    for i in range(n):
        source = pick.choices(["big", "mid", None, "", f"own{i}"], [60, 20, 10, 5, 5])[0]
        rows.append((pick.choice([i, i, i, None]), source, pick.choice(["", None, "é x", f"t{i}"]), i))
    return rows + [(5, "big", "again", -1)] * (n // 3)


@pytest.mark.parametrize("seed, n, shards, bucket", [(1, 900, 24, 50), (2, 40, 7, 4000), (3, 5, 24, 2)])
def test_shards(spark, monkeypatch, seed, n, shards, bucket):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", bucket)
    rows = mixture(seed, n)
    docs = spark.createDataFrame(
        rows, "doc_id long, source string, text string, shard long"
    )
    plan = sharding.shard_plan(docs.repartition(4), shards).collect()
    assert len(plan) == len(rows) and {r["law"] for r in plan} == {"rows"}
    by = defaultdict(list)
    for r in plan:
        by[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    sizes = [len(by[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert Counter((r["doc_id"], r["size"]) for r in plan) == Counter(
        (i, len((t or "").encode()) + 8) for i, _, t, _ in rows
    )
    again = sharding.shard_plan(docs.repartition(9, "text"), shards).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, plan))
    other = sharding.shard_plan(docs, shards, "another seed").collect()
    assert n < 100 or Counter(map(tuple, other)) != Counter(map(tuple, plan))


def test_written_shards_hold_the_mixture(spark, tmp_path):
    rows = mixture(4, 600)
    docs = spark.createDataFrame(
        rows, "doc_id long, source string, text string, shard long"
    ).repartition(3)
    sharding.write_shards(docs, str(tmp_path / "out"), 6)
    back = spark.read.parquet(str(tmp_path / "out"))
    got = back.select("shard", "slot", "document.*").toDF("s", "slot", *docs.columns).collect()
    assert Counter(tuple(r)[2:] for r in got) == Counter(rows)
    total = Counter(r[1] for r in rows)
    for s in range(6):
        share = Counter(r["source"] for r in got if r["s"] == s)
        assert all(abs(share[x] - total[x] / 6) <= 2 for x in total)
    ordered = spark.read.parquet(str(tmp_path / "out" / "shard=2")).select("slot").collect()
    assert [r[0] for r in ordered] == list(range(len(ordered)))


def test_no_shards(spark):
    none = spark.createDataFrame([], "doc_id long, source string, text string")
    plan = sharding.shard_plan(none)
    assert plan.count() == 0 and plan.columns == [
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard",
    ]
