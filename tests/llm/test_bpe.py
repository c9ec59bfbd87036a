import random
import struct

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from cellframe.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.read_ranks(PATH), PATTERN)


@pytest.fixture(scope="module")
def reference(encoder):
    return tiktoken.Encoding(
        "own", pat_str=PATTERN, mergeable_ranks=encoder.ranks, special_tokens={}
    )


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


PARTS = ["ab", "aaaa", " ", "  ", "\n", "\t", "é", "ß", "0", "12", "'s", "!", "漢", "🙂",
         " ", "\x1c", "\x85", "the", "ing", "\x00", "‍", "\r\n", "²", "Ⅷ", "<|endoftext|>"]


def test_random_texts(encoder, reference):
    pick = random.Random(1)
    for _ in range(2000):
        text = "".join(pick.choices(PARTS, k=pick.randrange(50)))
        assert ids(encoder.encode(text)) == reference.encode_ordinary(text)
        assert encoder.decode(encoder.encode(text)) == text.encode()


@pytest.mark.parametrize("text", [
    "a" * 9000, "ab" * 3000, "aaab" * 2000, "thetion" * 900, "é" * 3000, "  " * 999,
    "x" * 7 + "=" * 3001, "0123456789" * 500, "\n" * 100 + "x",
    "".join(random.Random(2).choices("abcdeot", k=20000)),
])
def test_long_pieces(encoder, reference, text):
    assert ids(encoder.encode(text)) == reference.encode_ordinary(text)


def test_join_is_a_monoid(encoder):
    pick = random.Random(3)
    ranks = encoder.ranks
    for _ in range(300):
        a, b, c = (
            bpe.encode_piece(ranks, "".join(pick.choices("abcest", k=pick.randrange(40))).encode())
            for _ in range(3)
        )
        left = bpe.join(ranks, bpe.join(ranks, a, b), c)
        right = bpe.join(ranks, a, bpe.join(ranks, b, c))
        assert left == right
        assert bpe.join(ranks, a, []) == a == bpe.join(ranks, [], a)
        assert left == bpe.merge(ranks, b"".join(a + b + c))


def test_the_queue_merges_like_the_loop(encoder):
    pick = random.Random(4)
    for n in (1, 2, 5, 60, 120):
        data = bytes(pick.choices(b"abcdest ", k=n))
        if data not in encoder.ranks:
            assert bpe._merge_queued(encoder.ranks, data) == bpe.merge(encoder.ranks, data)


def test_a_full_cache_starts_anew():
    cache = bpe._Cache(lambda key: key * 2, 3)
    assert [cache[i] for i in range(10)] == [2 * i for i in range(10)]
    assert len(cache) <= 3


def test_documents(spark, reference):
    texts = [None, "", "Hello world, it's 2024.", "x" * 50_000, "a b", "a b"]
    docs = spark.createDataFrame(
        [(i, t, "clash") for i, t in enumerate(texts)] + [(None, "null id", "c")],
        "doc_id long, text string, n_tokens string",
    )
    encoded = bpe.encode_documents(docs, PATH, PATTERN)
    rows = {r["doc_id"]: r for r in encoded.collect()}
    for i, text in enumerate(texts):
        expected = reference.encode_ordinary(text or "")
        assert list(rows[i]["token_ids"]) == expected
        assert rows[i]["n_tokens"] == len(expected)
    assert None in rows
    back = dict(bpe.decode_documents(encoded, PATH, PATTERN).collect())
    assert all(back[i] == (t or "") for i, t in enumerate(texts))
    assert bpe.encode_documents(docs.limit(0), PATH, PATTERN).count() == 0


def test_digests(spark, reference):
    import hashlib

    docs = spark.createDataFrame([(1, "Ünï  code\n"), (2, None)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in bpe.round_trip(docs, PATH, PATTERN).collect()}
    for i, text in ((1, "Ünï  code\n"), (2, "")):
        tokens = reference.encode_ordinary(text)
        packed = b"".join(struct.pack("<I", t) for t in tokens)
        assert rows[i]["n_tokens"] == len(tokens)
        assert rows[i]["ids_sha256"] == hashlib.sha256(packed).hexdigest()
        assert rows[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
