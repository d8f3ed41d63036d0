"""Suffix order of a byte string by two-stage sorting, and adjacent common prefixes.

A suffix is of type B if it is smaller than its successor (the suffix that
begins one byte later), else of type A. Within the bucket of a first byte all A
suffixes come before all B suffixes. So only B suffixes are sorted directly; one
scan over the buckets, in order, then places each A suffix: when a suffix is
met, the one before it, if of type A, goes to the end of the A part of its own
bucket. A bucket is scanned as a whole; runs of one byte feed their own bucket
and take further steps.

Suffixes are ordered by their first `depth` bytes; equal ones are neighbours.
Only those asked for are ordered, and those that the scan has to come from.
"""

from __future__ import annotations

import numpy as np


def smaller_than_successor(text: np.ndarray) -> np.ndarray:
    """Which suffixes are of type B; the last one is greater than the empty suffix."""
    n = len(text)
    if n == 0:
        return np.zeros(0, dtype=bool)
    # The type follows from the next place where two neighbouring bytes differ.
    differs = np.flatnonzero(text[1:] != text[:-1])
    rises = text[differs] < text[differs + 1]
    lengths = np.diff(np.concatenate(([-1], differs, [n - 1])))
    return np.repeat(np.append(rises, False), lengths)


def suffix_order(text: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The positions in `wanted` (a mask), in the order of their suffixes' first `depth` bytes."""
    n = len(text)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    is_b = smaller_than_successor(text)
    # A wanted A suffix is placed from its successor, that one from its own, up to a B suffix.
    ends = np.append(np.flatnonzero(is_b), n - 1)
    at = np.flatnonzero(wanted)
    stop = ends[np.searchsorted(ends, at)]
    steps = -np.bincount(stop + 1, minlength=n + 1)
    steps[at] += 1
    needed = np.cumsum(steps[:-1]) > 0

    padded = np.concatenate((text, np.zeros(depth, dtype=np.uint8)))
    windows = np.lib.stride_tricks.sliding_window_view(padded, depth)
    # From the end: a suffix that ends within `depth` comes before one that goes on with zeros.
    direct = np.flatnonzero(needed & is_b)[::-1]
    strings = np.ascontiguousarray(windows[direct]).view(f"V{depth}").ravel()
    direct = direct[np.argsort(strings.view(f"S{depth}"), kind="stable")]
    first = text[direct]
    bounds = np.searchsorted(first, np.arange(257))

    placed: list[list[np.ndarray]] = [[] for _ in range(256)]
    if needed[n - 1]:
        placed[text[n - 1]].append(np.array([n - 1]))  # its successor, the empty suffix, is the first
    order: list[np.ndarray] = []

    def feed(found: np.ndarray, own: int) -> np.ndarray:
        """Place the A suffixes just before those found; return those of the same bucket."""
        before = found[found > 0] - 1
        before = before[needed[before] & ~is_b[before]]
        byte = text[before]
        by_byte = np.argsort(byte, kind="stable")
        before, byte = before[by_byte], byte[by_byte]
        cuts = np.flatnonzero(np.diff(byte)) + 1
        same = before[:0]
        for group in np.split(before, cuts) if len(before) else []:
            if text[group[0]] == own:
                same = group
            else:
                placed[text[group[0]]].append(group)
        return same

    for byte in range(256):
        waiting = placed[byte]
        while waiting:
            found = np.concatenate(waiting)
            order.append(found)
            again = feed(found, byte)
            waiting = [again] if len(again) else []
        placed[byte] = []
        found = direct[bounds[byte] : bounds[byte + 1]]
        if len(found):
            order.append(found)
            feed(found, byte)
    ordered = np.concatenate(order) if order else np.zeros(0, dtype=np.int64)
    return ordered[wanted[ordered]]


def words_at(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, zeros after the end, as integers."""
    out = np.concatenate((text, np.zeros(8, dtype=np.uint8))).astype(np.uint64)
    for width in (1, 2, 4):
        out[: len(out) - width] = (out[: len(out) - width] << np.uint64(8 * width)) | out[width:]
    return out[: len(text)]


def share_prefix(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """For each suffix but the first of the order: are its first `depth` bytes those of the one before?

    All suffixes in `order` have at least `depth` bytes.
    """
    eight = words_at(text)
    equal = np.ones(max(len(order) - 1, 0), dtype=bool)
    left = np.flatnonzero(equal)
    # Whole words, the last one so that it ends with the prefix.
    places = [*range(0, depth - 7, 8), depth - 8] if depth >= 8 else []
    for place in places:
        same = eight[order[left] + place] == eight[order[left + 1] + place]
        equal[left[~same]] = False
        left = left[same]
    if depth < 8:
        shift = np.uint64(64 - 8 * depth)
        equal = (eight[order[1:]] >> shift) == (eight[order[:-1]] >> shift)
    return equal
