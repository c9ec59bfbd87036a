"""Hashed runs of consecutive words."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

from cellframe.llm.features import WordHash

_STEP = np.uint64(0x9E3779B97F4A7C15)
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over 64 output bits (splitmix finaliser)."""
    x = (x ^ (x >> _S30)) * _M1
    x = (x ^ (x >> _S27)) * _M2
    return x ^ (x >> _S31)


def runs(hashes: np.ndarray, width: int, seed: int = 1) -> np.ndarray:
    """Hash of every `width` consecutive words, in order."""
    n = len(hashes) - width + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    total = hashes[:n] * _STEP
    for step in range(1, width):
        total = (total ^ (total >> _S31)) * _M1 + hashes[step : step + n] * _STEP
    return mix(total + np.uint64(seed))


# What a byte adds to its word's hash, A-Z as a-z; the weight of its place in the word.
# Words longer than LONG are hashed one by one, all others of a block of texts at once.
LONG, BLOCK_TEXTS, BLOCK_BYTES = 64, 16, 1 << 20
_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _STEP)
_VALUES[ord("A") : ord("Z") + 1] = _VALUES[ord("a") : ord("z") + 1]
_WEIGHTS = mix(np.arange(1, LONG + 1, dtype=np.uint64) * _M1) | np.uint64(1)
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


def word_hashes(text: bytes, known: WordHash) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word of a text, A-Z in lower case, without a Python
    object for each."""
    data = np.frombuffer(text, np.uint8)
    white = np.ones(len(data) + 2, bool)
    np.take(_WHITE, data, out=white[1:-1])
    turns = np.flatnonzero(white[1:] != white[:-1])
    starts, ends = turns[::2], turns[1::2]
    lengths = ends - starts
    out = np.zeros(len(starts), np.uint64)
    which = np.flatnonzero(lengths <= LONG)
    for at in range(0, len(which), 1 << 16):
        some = which[at : at + (1 << 16)]
        each = lengths[some]
        first = np.cumsum(each) - each
        place = np.arange(first[-1] + each[-1]) - np.repeat(first, each)
        letters = data[place + np.repeat(starts[some], each)]
        total = np.add.reduceat(_VALUES[letters] * _WEIGHTS[place], first)
        out[some] = mix(total + each.astype(np.uint64) * _M2)
    for at in np.flatnonzero(lengths > LONG).tolist():
        out[at] = known[data[starts[at] : ends[at]].tobytes().lower()]
    return starts, out


def _distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct numbers."""
    values = np.sort(values)
    fresh = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=fresh[1:])
    return values[fresh]


def _sets_of_block(texts: list[bytes], known: WordHash, width: int) -> Iterator[np.ndarray]:
    lengths = np.array([len(t) + 1 for t in texts])
    starts, hashes = word_hashes(b" ".join(texts), known)
    firsts = np.searchsorted(starts, np.cumsum(lengths) - lengths).tolist()
    found = runs(hashes, width)
    for first, end in zip(firsts, [*firsts[1:], len(hashes)]):
        n = end - first
        if n >= width:
            yield _distinct(found[first : end - width + 1])
        else:
            yield runs(hashes[first:end], n, seed=n + 1000) if n else hashes[:0]


def shingle_sets(
    texts: Iterable[str | None], known: WordHash, width: int = 5
) -> Iterator[np.ndarray]:
    """For each text its sorted distinct shingles, A-Z in lower case.

    A text of fewer words has one shingle, its whole sequence; one without
    words has none.
    """
    block, size = [], 0
    for text in texts:
        block.append((text or "").encode())
        size += len(block[-1])
        if len(block) == BLOCK_TEXTS or size >= BLOCK_BYTES:
            yield from _sets_of_block(block, known, width)
            block, size = [], 0
    if block:
        yield from _sets_of_block(block, known, width)


def shingle_set(text: str | None, known: WordHash, width: int = 5) -> np.ndarray:
    """The shingles of one text."""
    return next(shingle_sets([text], known, width))
