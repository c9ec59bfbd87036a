import random
from collections import Counter, defaultdict

import plain
import pytest

from cellframe.llm import line_rules, mixing


def host_corpus(seed, n=200):
    pick = random.Random(seed)
    lines = [" ".join(pick.choices([f"w{i}" for i in range(900)], k=pick.randint(1, 30))) for _ in range(500)]
    common = lines[:3]
    rows = []
    for i in range(n):
        own = pick.choices(lines, k=pick.randint(1, 8))
        if pick.random() < 0.5:
            own[pick.randrange(len(own))] = pick.choice(common)
        if pick.random() < 0.2:
            own.append(pick.choice(own))
        if pick.random() < 0.2:
            own[0] += " ## $ %"
        text = pick.choice(["\n", "\r\n", "\n \n"]).join(own)
        if i and pick.random() < 0.2:
            text = rows[-1][2]
        rows.append((i, pick.choice(["a", "b", None, ""]), text))
    return rows + [(n, "a", None), (n + 1, None, ""), (n + 2, "a", " \n\t\n")]


@pytest.mark.parametrize("seed", [1, 2])
def test_line_rules(spark, seed):
    rows = host_corpus(seed)
    docs = spark.createDataFrame(
        [(*r, True) for r in rows], "doc_id long, source string, text string, kept boolean"
    ).repartition(4)
    got = {r["doc_id"]: r for r in line_rules.judge(docs, 3, 0.05, 0.5).collect()}
    assert len(got) == len(rows)
    verdicts = plain.line_verdicts(rows, 3, 0.05, 0.5)
    for i, _, text in rows:
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            plain.base_counts(text)
        )
        assert r["kept"] == verdicts[i], i
    kept = line_rules.keep_documents(docs, max_docs=3, max_share=0.05)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, k in verdicts.items() if k)


def test_frequent_lines_leave_the_text(spark):
    body = [" ".join(f"u{i}x{k}" for k in range(60)) for i in range(30)]
    rows = [(i, "h", f"Same  LINE here\n{b}") for i, b in enumerate(body)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    frequent = line_rules.frequent_lines(line_rules.line_profiles(docs), 20, 0.01)
    got = {r["doc_id"]: r["text"] for r in line_rules.clean_lines(docs, frequent).collect()}
    assert got[0] == rows[0][2] and all(got[i] == body[i] for i in range(1, 30))
    assert all(r["kept"] for r in line_rules.judge(docs).collect())


def test_rows_of_one_id_are_judged_apart(spark):
    good = " ".join(f"g{k}" for k in range(80))
    rows = [(7, "h", good, 1), (7, "h", "junk", 2), (None, "h", good + " x", 3),
            (None, "h", "", 4), (None, None, None, 5), (7, None, good, 6)]
    docs = spark.createDataFrame(
        rows, "doc_id long, source string, text string, digest long"
    )
    kept = line_rules.keep_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(r["digest"] for r in kept.collect()) == [1, 3, 6]


def test_the_stage_removes_lines(spark):
    body = ["\n".join(f"u{i}x{k}" for k in range(60)) for i in range(30)]
    rows = [(i // 2, "h", {"k": i}, f"Same  LINE here\n{b}\n\n") for i, b in enumerate(body)]
    docs = spark.createDataFrame(
        rows, "doc_id long, source string, host map<string, int>, text string"
    ).repartition(4)
    kept = line_rules.keep_documents(docs).collect()
    texts = sorted(r["text"] for r in kept)
    assert len(texts) == 30 and sum(t.startswith("Same") for t in texts) == 1
    assert all(t.endswith("\n\n") for t in texts)


def test_repeated_words_whole_and_long():
    pick = random.Random(5)
    for n in (0, 1, 2, 3, 4, 10, 500):
        for size in (1, 2, 5, 50):
            w = [str(pick.randrange(size)).encode() for _ in range(n)]
            text = b" ".join(w).decode()
            assert line_rules.repeated_words(w) == plain.base_counts(text)[4]


def test_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, source string, text string")
    assert line_rules.judge(none).count() == 0
    assert mixing.mix_plan(none).count() == 0
    assert mixing.mix_documents(none).count() == 0


def sources(seed, n, hot=0):
    pick = random.Random(seed)
    rows = []
    for i in range(n):
        source = "big" if i < hot else pick.choice(["a", "b", "ü", None, "", "z"])
        size = pick.choice([0, 1, 3, 40, 200, 900])
        rows.append((i, source, " ".join(["w"] * size) or pick.choice([None, "", " \n"])))
    return rows


def test_mix_beside_many_small_sources(spark):
    """Full sources give all of their words; the others share what is left."""
    rows = [(i, f"s{i:03d}", "w") for i in range(300)]
    rows += [(1000 + i, "t", " ".join(["v"] * 40)) for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    plan = mixing.mix_plan(docs).collect()
    by, target = Counter(), {}
    for r in plan:
        source = "t" if r["doc_id"] >= 1000 else r["doc_id"]
        by[source] += r["taken"]
        target[source] = r["target"]
    assert all(abs(by[s] - target[s]) <= mixing.BLOCK_WORDS for s in target)
    assert abs(sum(by.values()) - 1.5 * 20_300) <= mixing.BLOCK_WORDS


def test_mixed_rows_of_one_id(spark):
    rows = [(7, "a", "x " * 50, 1), (7, "a", None, 2), (7, "b", "y " * 10, 3), (None, "b", "", 4),
            (None, None, "z " * 5, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, mix_copies long")
    found = Counter(r["mix_copies"] for r in mixing.mix_documents(docs).collect())
    assert set(found) <= {1, 3, 5} and max(found.values()) <= 2


def shares(sizes, weights, budget):
    """Targets by filling up the smallest caps first."""
    left, open_ = budget, sorted(sizes, key=lambda s: 2 * sizes[s] / weights[s])
    target = {}
    while open_:
        level = left / sum(weights[s] for s in open_)
        s = open_[0]
        if 2 * sizes[s] > level * weights[s]:
            return target | {s: level * weights[s] for s in open_}
        target[s] = 2 * sizes[s]
        left -= target[s]
        open_.pop(0)
    return target


@pytest.mark.parametrize("seed, n, hot, shard", [(1, 300, 0, 20_000), (2, 400, 300, 50), (3, 7, 0, 20_000)])
def test_mix_plan(spark, seed, n, hot, shard):
    rows = sources(seed, n, hot)
    docs = spark.createDataFrame(
        [(*r, 1) for r in rows], "doc_id long, source string, text string, size int"
    ).repartition(5)
    plan = mixing.mix_plan(docs, shard_docs=shard).collect()
    assert len(plan) == n
    size = {i: len(plain.words(t)) for i, _, t in rows}
    by = defaultdict(int)
    for i, s, _ in rows:
        by[s] += size[i]
    names = sorted((s for s in by if s is not None), key=lambda s: s.encode()) + [None] * (None in by)
    weights = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    target = shares(by, weights, 1.5 * sum(by.values()))
    source = {i: s for i, s, _ in rows}
    taken = Counter()
    for r in plan:
        s = source[r["doc_id"]]
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == by[s]
        assert r["target"] == pytest.approx(target.get(s, 0))
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    for s in by:
        shards = max(1, sum(x == s for x in source.values()) // shard + 1)
        assert abs(taken[s] - target.get(s, 0)) <= 4 * mixing.BLOCK_WORDS * shards
    again = mixing.mix_plan(docs.repartition(3), shard_docs=shard)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, plan))


def test_sainte_lague_takes_the_highest_quotients(spark):
    pick = random.Random(8)
    for _ in range(4):
        entries = [(i, pick.randint(1, 50), pick.randint(1, 60)) for i in range(1, 9)]
        seats = pick.randint(1, sum(c for _, _, c in entries))
        quotients = sorted((2 * k - 1) / w + 0j.real for _, w, c in entries for k in range(1, c + 1))
        table = spark.createDataFrame(
            [("g", i, w, c, seats) for i, w, c in entries],
            "grp string, entry long, weight long, cap long, seats long",
        )
        got = {r["entry"]: r["quota"] for r in mixing.sainte_lague(table, ["grp"], "seats").collect()}
        ranked = sorted((((2 * k - 1) / w, i) for i, w, c in entries for k in range(1, c + 1)))
        expected = Counter(i for _, i in ranked[:seats])
        assert {i: q for i, q in got.items() if q} == dict(expected)
        assert len(quotients) >= seats


def test_mixed_documents(spark):
    rows = sources(4, 200) + [(None, "a", "one two three"), (5000, "a", "x y"), (5000, "a", "x y")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    mix = mixing.mix_documents(docs)
    assert mix.columns == docs.columns
    found = Counter(tuple(r) for r in mix.collect())
    assert set(found) <= {tuple(r) for r in rows}
    plan = {r["doc_id"]: r for r in mixing.mix_plan(docs).collect() if r["doc_id"] not in (None, 5000)}
    for (i, s, t), copies in found.items():
        if i in plan:
            assert copies == int(plan[i]["taken"] / plan[i]["size"] + 0.5)
