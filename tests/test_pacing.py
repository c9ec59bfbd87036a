"""Batched, paced delivery."""

import json

import pytest
from pyspark.sql import functions as F

from cellframe.operators.pacing import (
    batch_seconds, batch_size, deliver, fetch, send_in_batches, send_partitions,
    sending_tasks,
)
from conftest import rows


class Recorder:
    def __init__(self, fail_at=None):
        self.batches, self.closed, self.fail_at = [], 0, fail_at

    def send(self, batch):
        if len(self.batches) == self.fail_at:
            raise OSError("store is gone")
        self.batches.append(list(batch))

    def close(self):
        self.closed += 1


def test_batch_size_is_the_shared_rate():
    assert batch_size(2000, 4) == 500
    assert batch_size(2000, 3) == 666
    assert batch_size(5, 8) == 1
    assert batch_size(2000, 0) == 2000


def test_never_more_tasks_than_rows_a_second():
    assert sending_tasks(2000, 8) == 8
    assert sending_tasks(3, 8) == 3
    assert sending_tasks(9000, 8, max_rate=10_000) == 8
    for rate in (2001, 0):
        with pytest.raises(ValueError):
            sending_tasks(rate, 1)
    for rate, workers in ((2000, 8), (3, 8), (7, 5), (1, 1)):
        tasks = sending_tasks(rate, workers)
        size = batch_size(rate, tasks)
        assert size * tasks / batch_seconds(rate, tasks, size) <= rate + 1e-9


def test_a_batch_lasts_its_time():
    sink, slept, now = Recorder(), [], [0.0]

    def sleep(seconds):
        slept.append(seconds)
        now[0] += seconds

    send_in_batches(range(9), lambda: sink, 3, 0.5, sleep, 2.0, lambda: now[0])
    assert slept == [2.0, 2.0, 2.0]


@pytest.mark.parametrize("rate, rows_sent, partitions", [(4, 12, 16), (60, 240, 24)])
def test_the_rate_holds_with_more_partitions_than_rate(spark, tmp_path, rate, rows_sent, partitions):
    folder = str(tmp_path)

    class Counting:
        """Writes the time of every batch to a file of its own."""

        def __init__(self):
            import uuid

            self.file = open(f"{folder}/{uuid.uuid4().hex}", "w")

        def send(self, batch):
            import time

            self.file.write(f"{time.time()} {len(batch)}\n")

        def close(self):
            self.file.close()

    df = spark.range(0, rows_sent, 1, partitions).select(F.col("id").cast("string").alias("k"))
    totals = deliver(df, Counting, rate=rate)
    assert totals["records"] == rows_sent
    sent = sorted(
        (float(t), int(n)) for f in tmp_path.iterdir()
        for t, n in (line.split() for line in f.read_text().splitlines())
    )
    # In any second and a bit, no more than two seconds' worth begins.
    for i, (start, _) in enumerate(sent):
        assert sum(n for t, n in sent[i:] if t < start + 0.95) <= 2 * rate
    span = sent[-1][0] - sent[0][0]
    assert rows_sent - rate <= rate * (span + 1)


@pytest.mark.parametrize("n, totals", [(0, (0, 0, 0)), (3, (3, 1, 0)), (4, (4, 1, 1)),
                                       (8, (8, 2, 2)), (9, (9, 3, 2))])
def test_batches_pauses_and_close(n, totals):
    sink, slept = Recorder(), []
    assert send_in_batches(range(n), lambda: sink, 4, 0.5, slept.append) == totals
    assert [x for b in sink.batches for x in b] == list(range(n))
    assert all(len(b) == 4 for b in sink.batches[:-1])
    assert slept == [0.5] * totals[2]
    assert sink.closed == 1


def test_connection_closes_after_a_failure():
    sink = Recorder(fail_at=1)
    with pytest.raises(OSError):
        send_in_batches(range(9), lambda: sink, 4, 0, lambda s: None)
    assert sink.closed == 1


def test_deliver_sends_every_row_once(spark, tmp_path):
    folder = str(tmp_path)

    class FileSink:
        def __init__(self):
            import uuid

            self.file = open(f"{folder}/{uuid.uuid4().hex}", "w")

        def send(self, batch):
            assert len(batch) <= 10
            self.file.write(json.dumps(batch) + "\n")

        def close(self):
            self.file.write("closed\n")
            self.file.close()

    df = spark.range(0, 95, 1, 4).select(F.col("id").cast("string").alias("row_key"))
    totals = deliver(df, FileSink, rate=40, workers=4, pause=0)
    # 4 partitions of 23 or 24 rows: 3 batches and 2 pauses each.
    assert tuple(totals) == (95, 12, 8)
    sent, closed = [], 0
    for file in tmp_path.iterdir():
        *batches, last = file.read_text().splitlines()
        closed += last == "closed"
        sent += [row["row_key"] for b in batches for row in json.loads(b)]
    assert sorted(sent, key=int) == [str(i) for i in range(95)]
    assert closed == 4


def test_every_batch_that_was_sent_is_a_row(spark):
    class Nothing:
        def send(self, batch):
            pass

        def close(self):
            pass

    df = spark.createDataFrame([(1,)] * 10 + [(2,)] * 5 + [(3,)] * 4, "region int")
    sent = send_partitions(df.repartitionById(4, "region"), Nothing, 5)
    assert rows(sent) == [
        (1, 0, 5, True), (1, 1, 5, True), (2, 0, 5, True), (3, 0, 4, False),
    ]
    with pytest.raises(ValueError):
        send_partitions(df, Nothing, 0)


def counting(folder):
    """A client that notes the time and size of every call in a file of its own."""

    class Counting:
        def __init__(self):
            import uuid

            self.file = open(f"{folder}/{uuid.uuid4().hex}", "w")

        def send(self, batch):
            import time

            self.file.write(f"{time.time()} {len(batch)}\n")

        def get(self, keys):
            self.send(keys)
            return {k: {"v": f"value of {k}", "w": None} for k in keys if not k.startswith("no")}

        def close(self):
            self.file.write("closed 0\n")
            self.file.close()

    return Counting


def calls(folder):
    lines = [line.split() for f in folder.iterdir() for line in f.read_text().splitlines()]
    made = sorted((float(t), int(n)) for t, n in lines if t != "closed")
    return made, sum(t == "closed" for t, _ in lines)


@pytest.mark.parametrize("partitions", [1, 64])
def test_the_whole_rate_is_used_and_no_more(spark, tmp_path, partitions):
    """One partition is sent as fast as 64 of them."""
    df = spark.range(0, 8000, 1, partitions).select(F.col("id").cast("string").alias("k"))
    totals = deliver(df, counting(str(tmp_path)), rate=2000, workers=4)
    assert totals["records"] == 8000
    made, closed = calls(tmp_path)
    assert closed == 4 and len(made) == totals["batches"]
    span = made[-1][0] - made[0][0]
    # The last second's share goes out at its beginning.
    assert 8000 - 2000 <= 2000 * (span + 0.2)
    assert 8000 - 2000 >= 2000 * (span - 1.0) * 0.9


def test_fetch_answers_every_key_in_its_way(spark, tmp_path):
    asked = ["a", "b", "a", "no1", None, "", "a", "no1"]
    keys = spark.createDataFrame([(k,) for k in asked], "row_key string")
    for how, missing in (("blank", ("", "", "")), ("keep_key", ("no1", "", "")), ("skip", None)):
        folder = tmp_path / how
        folder.mkdir()
        got = fetch(keys, counting(str(folder)), "k, v, w", rate=100, on_missing=how)
        assert got.columns == ["k", "v", "w"]
        expected = [(k, f"value of {k}", "") for k in "aaab"] + [missing] * 2 * (missing is not None)
        assert rows(got) == sorted(expected, key=repr)
    with pytest.raises(ValueError):
        fetch(keys, counting(str(tmp_path)), "k", on_missing="nothing")
    with pytest.raises(ValueError):
        fetch(keys, counting(str(tmp_path)), "k", rate=9999)


def test_fetch_keeps_the_rate_and_closes(spark, tmp_path):
    keys = spark.range(0, 1200, 1, 3).selectExpr("cast(id as string) AS row_key")
    got = fetch(keys, counting(str(tmp_path)), "k, v", rate=400, workers=4)
    assert got.where("v = concat('value of ', k)").count() == 1200
    made, closed = calls(tmp_path)
    assert closed == 4 and sum(n for _, n in made) == 1200
    span = made[-1][0] - made[0][0]
    assert 1200 - 400 <= 400 * (span + 0.5) and all(n <= 100 for _, n in made)


def test_a_failed_get_closes_and_fails(spark, tmp_path):
    store = counting(str(tmp_path))

    class Failing(store):
        def get(self, keys):
            raise OSError("store is gone")

    keys = spark.range(0, 10, 1, 1).selectExpr("cast(id as string) AS row_key")
    with pytest.raises(Exception, match="store is gone"):
        fetch(keys, Failing, "k, v", rate=100, workers=1).collect()
    assert calls(tmp_path)[1] >= 1


def test_answers_are_handed_on_batch_by_batch():
    from cellframe.operators.pacing import paced

    seen = []
    calls = paced(iter(range(7)), lambda b: seen.append(len(b)) or sum(b), 3, 0.5, lambda s: None)
    assert next(calls) == ([0, 1, 2], 3, True) and seen == [3]
    assert list(calls) == [([3, 4, 5], 12, True), ([6], 6, False)]
