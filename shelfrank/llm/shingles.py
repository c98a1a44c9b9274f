"""Hashes of words, shingle sets and MinHash signatures of whole texts, in numpy."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

SLICE = 1 << 21  # bytes of text hashed at a time
MAX_POWER = 1 << 12

_RANDOM = np.random.default_rng(20240917)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z hash as a-z
_POWER = np.multiply.accumulate(
    np.concatenate([[np.uint64(1)], np.full(MAX_POWER - 1, 0x9E3779B97F4A7C15, np.uint64)])
)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LEFT, _RIGHT = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spreads every input bit over the whole of a 64-bit number."""
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def slices(raw: np.ndarray) -> Iterator[np.ndarray]:
    """Parts of about ``SLICE`` bytes that end behind white space; a word is never cut."""
    start = 0
    while start < len(raw):
        stop = start + SLICE
        while stop < len(raw) and not _SPACE[raw[stop - 1]]:
            more = np.flatnonzero(_SPACE[raw[stop : stop + SLICE]])
            stop = stop + int(more[0]) + 1 if len(more) else min(stop + SLICE, len(raw))
        yield raw[start:stop]
        start = stop


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word (runs of other than ASCII white space, A-Z as a-z)."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    found = []
    for part in slices(raw):
        space = _SPACE[part]
        edge = np.flatnonzero(np.diff(space, prepend=True, append=True))
        starts, ends = edge[::2], edge[1::2]
        if not len(starts):
            continue
        lengths = ends - starts
        own = part[~space]
        at = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        place = np.arange(len(own)) - np.repeat(at, lengths)
        if lengths.max() <= MAX_POWER:
            value = _BYTE[own] * _POWER[place]
        else:  # places beyond the table start over with another factor
            value = _BYTE[own] * _POWER[place % MAX_POWER]
            value *= mixed((place // MAX_POWER).astype(np.uint64)) | np.uint64(1)
        found.append(mixed(np.add.reduceat(value, at) + lengths.astype(np.uint64)))
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def shingle_set(text: str, size: int = 2) -> np.ndarray:
    """Sorted different hashes of the ``size``-word shingles.

    A text of fewer words is one shingle, a text without words has none.
    """
    words = word_hashes(text)
    if not len(words):
        return words
    size = min(size, len(words))
    last = len(words) - size + 1
    value = np.full(last, size, np.uint64)
    for i in range(size):
        value = mixed(value * _LEFT + words[i : i + last] * _RIGHT)
    return np.unique(value)


class MinHash:
    """``count`` hash functions; a signature has the least value of each over a set."""

    BLOCK = 2048

    def __init__(self, count: int, seed: int = 9) -> None:
        random = np.random.default_rng(seed)
        self.low = random.integers(0, 1 << 31, count, np.uint32) * np.uint32(2) + np.uint32(1)
        self.high = random.integers(0, 1 << 31, count, np.uint32) * np.uint32(2) + np.uint32(1)

    def signature(self, values: np.ndarray) -> np.ndarray:
        least = np.full(len(self.low), 0xFFFFFFFF, np.uint32)
        for i in range(0, len(values), self.BLOCK):
            some = values[i : i + self.BLOCK]
            low, high = some.astype(np.uint32), (some >> np.uint64(32)).astype(np.uint32)
            hashed = low[:, None] * self.low
            hashed += high[:, None] * self.high
            np.minimum(least, hashed.min(0), out=least)
        return least


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """One key per band of the signature, different between bands."""
    rows = signature.astype(np.uint64).reshape(bands, -1)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for column in rows.T:
        key = mixed(key * _LEFT + column * _RIGHT)
    return key.astype(np.int64)


def set_key(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()
