"""Balanced parentheses of tries, as flat arrays: every node opens and closes around its subtree.

``Forest`` is made from sorted paths. The excess (opened less closed) is kept
with the minima of its blocks and a tree of them: a node closes where the
excess first falls below its own, which is looked for in its block, then by
climbing and descending the tree, for all nodes at once. From there leaves are
a difference of the rank of ``()``, and sums over subtrees differences of
running sums.
"""

from __future__ import annotations

import numpy as np

BLOCK = 32
_HIGH = np.iinfo(np.int64).max


class Excess:
    """Running excess of a sequence of +1 and -1 with the minima of its blocks, as a range min-max tree."""

    def __init__(self, steps: np.ndarray):
        n = max(1, -(-len(steps) // BLOCK))
        self.width = 1 << (n - 1).bit_length()
        padded = np.full(self.width * BLOCK, _HIGH)
        np.cumsum(steps, out=padded[: len(steps)])
        self.blocks = padded.reshape(-1, BLOCK)
        self.tree = np.full(2 * self.width, _HIGH)
        self.tree[self.width :] = self.blocks.min(1)
        at = self.width >> 1
        while at:
            self.tree[at : 2 * at] = np.minimum(self.tree[2 * at : 4 * at : 2], self.tree[2 * at + 1 : 4 * at : 2])
            at >>= 1

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        """Where each of ``opens`` is closed."""
        out = np.zeros(len(opens), np.int64)
        for a in range(0, len(opens), 1 << 17):
            out[a : a + (1 << 17)] = self._findclose(opens[a : a + (1 << 17)])
        return out

    def _findclose(self, opens: np.ndarray) -> np.ndarray:
        target = self.blocks.reshape(-1)[opens] - 1
        block = opens // BLOCK
        after = (self.blocks[block] == target[:, None]) & (np.arange(BLOCK) > (opens % BLOCK)[:, None])
        here = after.any(1)
        node = block + self.width
        climbing = ~here
        while climbing.any():  # to the first subtree on the right that falls so low
            k = np.flatnonzero(climbing)
            low = (node[k] % 2 == 0) & (self.tree[np.minimum(node[k] ^ 1, len(self.tree) - 1)] <= target[k])
            node[k] = np.where(low, node[k] + 1, node[k] >> 1)
            climbing[k[low]] = False
        down = np.flatnonzero(~here)
        while len(k := down[node[down] < self.width]):
            left = node[k] * 2
            node[k] = np.where(self.tree[left] <= target[k], left, left + 1)
        block = np.where(here, block, node - self.width)
        first = np.where(here, after.argmax(1), (self.blocks[block] <= target[:, None]).argmax(1))
        return block * BLOCK + first


def subtree_min(values: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The least of ``values[i : i + size[i]]`` for each i."""
    out, level, row = values.copy(), np.frexp(np.maximum(size, 1))[1] - 1, values
    for k in range(int(level.max(initial=0)) + 1):
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(row[at], row[at + size[at] - (1 << k)])
        if len(row) <= 1 << k:
            break
        row = np.minimum(row[: -(1 << k)], row[1 << k :])
    return out


class Forest:
    """The tries of sorted paths. ``digests`` are the steps of all paths, two numbers each, ``first`` each path's first; paths of different ``group`` share nothing.

    Nodes are numbered as they open; ``step`` gives the place in ``digests`` of
    the step that made a node, ``end`` each path's last node.
    """

    def __init__(self, digests: np.ndarray, first: np.ndarray, group: np.ndarray):
        lengths = np.diff(first)
        shared = np.zeros(len(lengths), np.int64)  # with the path before
        if len(lengths) > 1:
            both = np.where(group[1:] == group[:-1], np.minimum(lengths[1:], lengths[:-1]), 0)
            row = np.repeat(np.arange(len(both)), both)
            place = np.arange(len(row)) - np.repeat(np.cumsum(both) - both, both)
            differs = (digests[first[1:-1][row] + place] != digests[first[:-2][row] + place]).any(1)
            shared[1:] = both
            at = np.flatnonzero(differs)[::-1]
            shared[row[at] + 1] = place[at]  # the first difference is written last
        opened = lengths - shared
        row = np.repeat(np.arange(len(lengths)), opened)
        within = np.arange(len(row)) - np.repeat(np.cumsum(opened) - opened, opened)
        self.depth = shared[row] + within + 1
        self.step = first[:-1][row] + self.depth - 1
        self.end = np.cumsum(opened) - 1
        self._close(self.depth)
        self.parent = _parents(self.depth)

    @classmethod
    def of_depths(cls, depth: np.ndarray) -> Forest:
        """A forest from the depths of its nodes in the order in which they open."""
        self = cls.__new__(cls)
        self.depth = depth
        self._close(depth)
        self.parent = _parents(depth)
        return self

    def _close(self, depth: np.ndarray) -> None:
        """Write the parentheses, then find each node's size and leaves by its closing one."""
        n = len(depth)
        closed = np.concatenate([depth[:-1] - depth[1:] + 1, depth[-1:]])  # after a node, before the next
        self.open = np.arange(n) + np.cumsum(closed) - closed
        steps = np.full(2 * n, -1, np.int64)
        steps[self.open] = 1
        close = Excess(steps).findclose(self.open)
        self.size = (close - self.open + 1) // 2
        pairs = np.zeros(2 * n + 1, np.int64)
        np.cumsum((steps == 1) & np.append(steps[1:] == -1, False), out=pairs[1:])
        self.leaves = pairs[close + 1] - pairs[self.open]

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Over each node's subtree, its top included."""
        running = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
        at = np.arange(len(values))
        return running[at + self.size] - running[at]


def _parents(depth: np.ndarray) -> np.ndarray:
    """The last node before each that is one step less deep; -1 for tops."""
    n = len(depth)
    keys = np.sort(depth * n + np.arange(n))
    found = keys[np.searchsorted(keys, (depth - 1) * n + np.arange(n)) - 1] if n else keys
    return np.where(depth > 1, found % max(n, 1), -1)
