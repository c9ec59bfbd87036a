import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellframe.llm import quality, toxicity
from cellframe.llm.features import WordHash, auc, labelled_sample, remainder

SF = "/root/testdata/sf0.01"


def labelled(spark, n=600):
    """Texts whose words and shape tell both labels."""
    pick = random.Random(1)
    docs, labels = [], []
    for i in range(n):
        words = [f"w{pick.randrange(300)}" for _ in range(pick.randint(5, 60))]
        toxic, good = pick.random() < 0.2, pick.random() < 0.6
        if toxic:
            words.insert(pick.randrange(len(words)), pick.choice(["Nasty!", "vile", "creep,"]))
        if not good:
            words = [w + pick.choice(["###", "$$$"]) for w in words]
        docs.append((i, " ".join(words), "en", "s", len(words)))
        labels.append((i, int(good), int(toxic)))
    docs += [(n, None, None, None, None), (n + 1, "", "en", "s", 0), (None, "vile", "en", "s", 4)]
    labels += [(n, None, 1), (None, 1, 1), (n + 5, 0, 0)]
    return (
        spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


@pytest.mark.parametrize("model, label, modulus, held", [
    (quality, "quality", 3, 1), (toxicity, "toxic", 4, 2),
])
def test_held_out_accuracy(spark, model, label, modulus, held):
    docs, labels = labelled(spark)
    learned = model.train(docs, labels, remainder("doc_id", modulus) != held)
    rows = model.score(docs, learned).collect()
    assert len(rows) == docs.count()
    truth = dict(labels.select("doc_id", label).collect())
    out = [
        (r["score"], truth[r["doc_id"]]) for r in rows
        if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % modulus == held
        and truth.get(r["doc_id"]) is not None
    ]
    scores, marks = map(np.array, zip(*out))
    assert auc(scores, marks) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["predicted"] == (r["score"] >= model.THRESHOLD) for r in rows)
    again = model.score(docs, learned).collect()
    assert sorted(again, key=repr) == sorted(rows, key=repr)


@pytest.mark.parametrize("model, label", [(quality, "quality"), (toxicity, "toxic")])
def test_one_class_or_no_labels(spark, model, label):
    docs, labels = labelled(spark, 30)
    for some in (labels.where("false"), labels.where(f"{label} = 1")):
        learned = model.train(docs, some, F.lit(True))
        scores = {r["score"] for r in model.score(docs, learned).collect()}
        assert len({round(s, 9) for s in scores}) == 1
        assert (scores.pop() > 0.5) == (some.count() > 0)
    assert model.score(docs.limit(0), learned).count() == 0


def test_only_admitted_labels_are_read(spark):
    docs, labels = labelled(spark)
    where = remainder("doc_id", 3) != 1
    got = labelled_sample(docs, labels, "quality", where, 10_000).collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1 for r in got if r["doc_id"] is not None)
    assert labelled_sample(docs, labels, "quality", where, 50).count() == 50


def test_the_sample_is_bounded_by_rows(spark):
    """Many rows of one labelled doc_id are one row of the sample."""
    rows = [(i % 3, f"text {i % 7}", "x", 1) for i in range(50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string, labelled_id int")
    labels = spark.createDataFrame([(0, 1), (1, 0), (None, 1)], "doc_id long, toxic int")
    got = labelled_sample(docs, labels, "toxic", F.lit(True), 10).collect()
    assert sorted((r["doc_id"], r["label"]) for r in got) == [(0, 1), (1, 0)]
    assert quality.score(docs.withColumn("n_chars", F.lit(3)).limit(5), quality.train(
        docs.withColumn("n_chars", F.lit(3)), labels.withColumnRenamed("toxic", "quality"), F.lit(True)
    )).count() == 5
    assert toxicity.train(docs, labels, F.lit(True)).bias is not None


def test_linear_time_pairs_equal_the_double_sum():
    pick = np.random.default_rng(0)
    machine = quality.Machine(0.3, pick.normal(size=quality.SIZE), pick.normal(size=(quality.SIZE, quality.RANK)))
    at = pick.choice(quality.SIZE, 20, replace=False)
    x = pick.normal(size=20)
    slow = 0.3 + machine.weights[at] @ x + sum(
        machine.vectors[at[i]] @ machine.vectors[at[j]] * x[i] * x[j]
        for i in range(20) for j in range(i)
    )
    assert machine.raw(at, x)[0] == pytest.approx(slow)


def test_ftrl_keeps_few_weights():
    pick = np.random.default_rng(2)
    samples = []
    for i in range(800):
        slots = np.unique(pick.integers(10, 5000, 40))
        samples.append((np.append(slots, 3) if i % 5 == 0 else slots, int(i % 5 == 0)))
    model = toxicity.fit(samples)
    assert 3 in model.slots and len(model.slots) < 500
    assert model.values[model.slots.tolist().index(3)] == max(model.values)


def test_long_clean_text_stays_clean(spark):
    docs, labels = labelled(spark)
    learned = toxicity.train(docs, labels, F.lit(True))
    pick = random.Random(9)
    long = " ".join(f"w{pick.randrange(300)}" for _ in range(50_000))
    row = spark.createDataFrame([(1, long)], "doc_id long, text string")
    assert toxicity.score(row, learned).first()["predicted"] == 0


def test_quality_statistics_ignore_what_is_no_input(spark):
    known = WordHash()
    a = quality.features("Some words here.", 16, known)
    b = quality.features("Some words here.", 16, known)
    assert np.array_equal(a[0], b[0])
    assert len(quality.features(None, None, known)[0]) == quality.STATISTICS + 1
