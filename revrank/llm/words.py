"""Words of many texts at once, as numpy arrays over their UTF-8 bytes.

The word rules of these operators separate at single ASCII bytes only, so words
can be found and hashed without one Python object per word.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence

import numpy as np

_RANDOM = np.random.Generator(np.random.PCG64(20_240_601))
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Word bytes of `[^\x20\x09-\x0D]+`.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Word bytes of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`, after lower-casing.
LETTERS = np.zeros(256, dtype=bool)
LETTERS[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

SLICE_BYTES = 1 << 19


def mix(values: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64."""
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0x9E3779B97F4A7C15)
    values ^= values >> np.uint64(29)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(32)
    return values


class Words:
    """Words of consecutive texts: ``start`` and ``end`` bytes, ``doc`` (index of the
    text), ``first`` (for each text and one past the last, index of its first word)."""

    def __init__(self, texts: Sequence[bytes], letters: np.ndarray):
        data = _LOWER[np.frombuffer(b" ".join([b"", *texts, b""]), dtype=np.uint8)]
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.text_start = np.concatenate([[0], np.cumsum(sizes + 1)]) + 1
        inside = letters[data]
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        self.data, self.inside = data, inside
        self.start, self.end = edges[0::2], edges[1::2]
        self.first = np.searchsorted(self.start, self.text_start)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))

    @functools.cached_property
    def _bytes(self) -> tuple[np.ndarray, np.ndarray]:
        """A number for every byte in its place of a word (0 outside of words), and that place."""
        origin = np.zeros(len(self.data), dtype=np.int64)
        origin[self.start] = self.start
        place = np.arange(len(self.data)) - np.maximum.accumulate(origin)
        values = _BYTE[self.data] * _PLACE[place & 255]
        if (far := place > 255).any():
            values[far] *= mix((place[far] >> 8).astype(np.uint64)) | np.uint64(1)
        values[~self.inside] = 0
        return values, place

    def hashes(self, most: int | None = None) -> np.ndarray:
        """64-bit hash of every word, or of its first ``most`` bytes."""
        if not len(self.start):
            return np.zeros(0, dtype=np.uint64)
        values, place = self._bytes
        length = self.end - self.start
        if most is not None:
            values = np.where(place < most, values, np.uint64(0))
            length = np.minimum(length, most)
        return mix(np.add.reduceat(values, self.start) + length.astype(np.uint64))


def slices(texts: Sequence[str | None], most_bytes: int = SLICE_BYTES) -> Iterator[list[bytes]]:
    """Whole texts as UTF-8 (null: empty), in order, in lists of about ``most_bytes``."""
    part: list[bytes] = []
    size = 0
    for text in texts:
        raw = text.encode("utf-8", "surrogatepass") if text else b""
        if part and size + len(raw) > most_bytes:
            yield part
            part, size = [], 0
        part.append(raw)
        size += len(raw)
    if part:
        yield part


def shingles(words: Words, hashes: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``size`` words within a text, and each text's first row in it.

    A text with fewer words has its whole sequence as one run, without words none.
    """
    counts = np.diff(words.first)
    runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    first = np.concatenate([[0], np.cumsum(runs)])
    if not first[-1]:
        return np.zeros(0, dtype=np.uint64), first
    at = np.arange(first[-1]) - np.repeat(first[:-1], runs) + np.repeat(words.first[:-1], runs)
    left = np.repeat(np.minimum(counts, size), runs)
    total = np.zeros(first[-1], dtype=np.uint64)
    padded = np.concatenate([hashes, np.zeros(size, dtype=np.uint64)])
    for i in range(size):
        total = total * np.uint64(0xD6E8FEB86659FD93) + np.where(i < left, padded[at + i], np.uint64(0x51ED270B))
    return mix(total), first
