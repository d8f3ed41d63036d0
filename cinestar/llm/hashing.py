"""64-bit hashes of the words and shingles of many texts at once, in numpy.

A word is a run of anything but ASCII white space, taken on UTF-8 bytes. Its
hash is a polynomial over its bytes modulo 2**64, each byte first replaced by a
fixed random number, and mixed at the end. Texts are worked on in blocks of
about BLOCK bytes that end between texts, or between words in a longer text, so
memory does not follow the length of a text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

BLOCK = 1 << 18
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits whose every output bit depends on all input bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=_U)
    out[0] = 1
    return np.multiply.accumulate(out)


class WordHasher:
    """Hashes of the words of a text; with `lower`, A-Z count as a-z."""

    def __init__(self, lower: bool = True) -> None:
        self.value = mix(np.arange(1, 257, dtype=_U))
        self.space = np.zeros(256, dtype=bool)
        self.space[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
        self.value[self.space] = 0
        if lower:
            self.value[65:91] = self.value[97:123]
        self._grow(2 * BLOCK)

    def _grow(self, n: int) -> None:
        self.up = _powers(_BASE, n)
        self.down = _powers(pow(_BASE, -1, 1 << 64), n)

    def words(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(start, hash) of each word."""
        raw = np.frombuffer(data, dtype=np.uint8)
        if len(raw) == 0:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=_U)
        if len(raw) > len(self.up):
            self._grow(2 * len(raw))
        word = ~self.space[raw]
        starts = word.copy()
        starts[1:] &= ~word[:-1]
        starts = np.flatnonzero(starts)
        if len(starts) == 0:
            return starts, np.empty(0, dtype=_U)
        sums = np.add.reduceat(self.value[raw] * self.up[: len(raw)], starts)
        return starts, mix(sums * self.down[starts])

    def texts(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """The word hashes of each text, in order; none for a null or empty text."""
        group: list[bytes] = []
        size = 0
        for text in texts:
            data = (text or "").encode("utf-8", "replace")
            if size and size + len(data) > BLOCK:
                yield from self._together(group)
                group, size = [], 0
            if len(data) > BLOCK:
                yield self._long(data)
                continue
            group.append(data)
            size += len(data) + 1
            if size > BLOCK:
                yield from self._together(group)
                group, size = [], 0
        yield from self._together(group)

    def _together(self, group: list[bytes]) -> Iterator[np.ndarray]:
        if not group:
            return
        starts, hashes = self.words(b" ".join(group))
        ends = np.cumsum([len(data) + 1 for data in group])
        yield from np.split(hashes, np.searchsorted(starts, ends[:-1]))

    def _long(self, data: bytes) -> np.ndarray:
        parts, at = [], 0
        while at < len(data):
            end = min(at + BLOCK, len(data))
            while end < len(data) and not self.space[data[end]]:
                end += 1
            parts.append(self.words(data[at:end])[1])
            at = end
        return np.concatenate(parts)


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of `width` words in a row; fewer words count as one shingle."""
    if len(words) == 0:
        return words
    width = min(width, len(words))
    n = len(words) - width + 1
    out = words[:n].copy()
    for k in range(1, width):
        out = mix(out * _U(3) + words[k : k + n])
    return np.unique(out)
