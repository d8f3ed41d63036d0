"""A K2-treap: a compressed quadtree over a grid of rows and columns with the maximum of each cell.

The grid is halved in both directions at each level. A node stands for a cell
that is not empty and holds a mask of its up to four quadrants that are not
empty and the largest value in it. Nodes are laid out level by level, the
children of a node one after the other, so a child's place follows from the
number of mask bits before it; only masks and values are stored.
"""

from __future__ import annotations

import numpy as np

_BITS = np.array([bin(k).count("1") for k in range(16)], dtype=np.int64)
# How many quadrants before the one asked for are there.
_BEFORE = np.array([[bin(mask & ((1 << q) - 1)).count("1") for q in range(4)] for mask in range(16)])


def _spread(x: np.ndarray) -> np.ndarray:
    """The bits of a number of up to 31 bits with a zero before each."""
    x = x.astype(np.uint64)
    for shift, mask in (
        (16, 0x0000FFFF0000FFFF),
        (8, 0x00FF00FF00FF00FF),
        (4, 0x0F0F0F0F0F0F0F0F),
        (2, 0x3333333333333333),
        (1, 0x5555555555555555),
    ):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


class Treap:
    """Masks and values of all nodes, the root first; `height` levels below the root."""

    def __init__(self, height: int, masks: np.ndarray, values: np.ndarray) -> None:
        self.height, self.masks, self.values = height, masks, values
        # Children follow in the order of their parents: the root is node 0, its first child node 1.
        counts = _BITS[masks]
        self.first_child = 1 + np.cumsum(counts) - counts

    @classmethod
    def build(cls, rows: np.ndarray, columns: np.ndarray, values: np.ndarray) -> Treap:
        """Of distinct (row, column) with a positive value each; at least one."""
        height = int(max(rows.max(), columns.max())).bit_length()
        codes = _spread(rows) << np.uint64(1) | _spread(columns)
        order = np.argsort(codes)
        codes, values = codes[order], values[order].astype(np.int32)
        masks = np.zeros(len(codes), dtype=np.uint8)
        levels = [(masks, values)]
        for _ in range(height):
            up = codes >> np.uint64(2)
            first = np.flatnonzero(np.concatenate(([True], up[1:] != up[:-1])))
            quadrant = np.left_shift(1, (codes & np.uint64(3)).astype(np.uint8)).astype(np.uint8)
            masks, values = np.bitwise_or.reduceat(quadrant, first), np.maximum.reduceat(values, first)
            codes = up[first]
            levels.append((masks, values))
        masks, values = (np.concatenate([level[k] for level in reversed(levels)]) for k in (0, 1))
        return cls(height, masks, values)

    def children(self, nodes: np.ndarray, quadrants: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(node of the quadrant, is it there) for each node."""
        masks = self.masks[nodes]
        there = (masks >> quadrants.astype(np.uint8)) & 1 > 0
        return self.first_child[nodes] + _BEFORE[masks, quadrants], there


def best_columns(
    treap: Treap,
    columns: int,
    rows: np.ndarray,
    weights: np.ndarray,
    items: np.ndarray,
    least: np.ndarray,
    most: int,
    wave: int = 16,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(item, column, score) of every column that may be among an item's `most` best.

    `rows`, `weights` and `items` are parallel: item by item, the rows it asks for
    and their weights. A column's score is the sum of weight times value over the
    item's rows. `least` has the score from which on a column counts, per item;
    it rises here as columns are found, and is changed in place.

    The paths of an item's rows go down together, over ranges of columns. A range
    is bounded by the weighted sum of the maxima of the cells on the paths. In
    each wave an item opens its ranges of the highest bounds; waves widen, and a
    range is given up once its bound is below the item's limit.
    """
    n_items = len(least)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    best: list[np.ndarray] = [np.empty(0, dtype=np.int64) for _ in range(n_items)]

    # Ranges: item, first column, bits of width, bound, and where their paths are.
    present = np.flatnonzero(np.bincount(items, minlength=n_items))
    lengths = np.bincount(items, minlength=n_items)[present]
    item, column = present, np.zeros(len(present), dtype=np.int64)
    width = np.full(len(present), treap.height)
    bound = np.add.reduceat(weights, np.cumsum(lengths) - lengths) * int(treap.values[0]) if len(present) else lengths
    path, node = np.arange(len(items)), np.zeros(len(items), dtype=np.int64)

    def taken(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The places of several stretches, one after the other."""
        ends = np.cumsum(sizes)
        return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)

    while len(item):
        keep = bound >= least[item]
        starts = np.cumsum(lengths) - lengths
        # The best ranges of each item are opened.
        order = np.lexsort((-bound, item))
        new = np.concatenate(([True], item[order][1:] != item[order][:-1]))
        rank = np.empty(len(item), dtype=np.int64)
        rank[order] = np.arange(len(item)) - np.flatnonzero(new)[np.cumsum(new) - 1]
        opened = np.flatnonzero(keep & (rank < wave))
        closed = np.flatnonzero(keep & (rank >= wave))
        wave *= 4

        leaf = opened[width[opened] == 0]
        if len(leaf):
            score = bound[leaf]
            found.append((item[leaf], column[leaf], score))
            for which in np.unique(item[leaf]):
                top = np.concatenate((best[which], score[item[leaf] == which]))
                if len(top) >= most:
                    top = -np.partition(-top, most - 1)[:most]
                    least[which] = max(least[which], top.min())
                best[which] = top
        opened = opened[width[opened] > 0]

        places = taken(starts[opened], lengths[opened])
        of = np.repeat(np.arange(len(opened)), lengths[opened])
        below = width[opened] - 1
        row_bit = (rows[path[places]] >> below[of]) & 1
        parts = [[], [], [], [], [], [], []]
        for half in (0, 1):
            start = column[opened] + (half << below)
            child, there = treap.children(node[places], 2 * row_bit + half)
            there &= (start < columns)[of]
            some, at = path[places][there], child[there]
            range_ = of[there]
            size = np.bincount(range_, minlength=len(opened))
            sums = np.zeros(len(opened), dtype=np.int64)
            full = np.flatnonzero(size)
            if len(full):
                # Sums in integers: a weighted bincount would round.
                edges = np.concatenate(([0], np.cumsum(size[full])[:-1]))
                sums[full] = np.add.reduceat(weights[some] * treap.values[at], edges)
            good = (size > 0) & (sums > 0) & (sums >= least[item[opened]])
            inside = good[range_]
            for part, value in zip(
                parts,
                (item[opened][good], start[good], below[good], sums[good], size[good], some[inside], at[inside]),
                strict=True,
            ):
                part.append(value)
        rest = taken(starts[closed], lengths[closed])
        kept = (item[closed], column[closed], width[closed], bound[closed], lengths[closed], path[rest], node[rest])
        item, column, width, bound, lengths, path, node = (
            np.concatenate((value, *part)) for value, part in zip(kept, parts, strict=True)
        )
    if not found:
        empty = np.empty(0, dtype=np.int64)
        return empty, empty, empty
    out = tuple(np.concatenate([f[k] for f in found]) for k in range(3))
    good = out[2] >= least[out[0]]
    return out[0][good], out[1][good], out[2][good]
