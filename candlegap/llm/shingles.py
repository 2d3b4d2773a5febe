"""Hashed five-word shingles of whole texts, a batch of texts at a time."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np

WORDS = 5
#: Bytes of text hashed at once; bounds a worker's memory (a longer text is taken alone).
PIECE = 1 << 18
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """A random value per byte (A-Z as a-z), and per word place."""
    value = mixed(np.arange(1, 257, dtype=np.uint64) * _ODD)
    value[65:91] = value[97:123]
    return value, mixed(np.arange(1001, 1001 + WORDS, dtype=np.uint64) * _ODD) | np.uint64(1)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of every word ``[^\\x20\\x09-\\x0D]+`` of the texts."""
    value, _ = _tables()
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    inside = ~space
    first = inside.copy()
    first[1:] &= space[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    lengths = np.flatnonzero(space[1:] & inside[:-1]) + 1 - starts
    powers = np.multiply.accumulate(np.full(int(lengths.max()), _ODD))
    place = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    weighed = value[data[inside]] * powers[place]
    h = np.add.reduceat(weighed, np.cumsum(lengths) - lengths)
    ends = np.cumsum([len(t) + 1 for t in texts])
    return mixed(h + lengths.astype(np.uint64) * _M1), np.searchsorted(ends, starts, side="right")


def shingle_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """For each text, its distinct shingle hashes in ascending order (unsigned 64-bit):
    every five words, the whole sequence where there are fewer, nothing without words."""
    group, held = [], 0
    for text in texts:
        raw = (text or "").encode("utf-8", "replace")
        if group and held + len(raw) > PIECE:
            yield from _sets(group)
            group, held = [], 0
        group.append(raw)
        held += len(raw)
    if group:
        yield from _sets(group)


def _sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    _, factor = _tables()
    word, owner = word_hashes(texts)
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    n = len(word) - WORDS + 1
    every = np.zeros(max(n, 0), np.uint64)
    for k in range(WORDS):
        if n > 0:
            every += word[k:k + n] * factor[k]
    every = mixed(every)
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= WORDS:
            yield np.unique(every[a:b - WORDS + 1])
        elif b > a:
            short = (word[a:b] * factor[:b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            yield mixed(np.array([short], np.uint64))
        else:
            yield np.zeros(0, np.uint64)
