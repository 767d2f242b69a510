"""An ordered tree as balanced parentheses, with least excesses of blocks.

Node i is the i-th opening parenthesis. The excess after a place is the number
of parentheses open there. Blocks of ``BLOCK`` places keep their least excess,
and a tree over the blocks the least of its halves, so a node's closing
parenthesis is found by passing over whole blocks. All queries are answered for
many nodes at once.
"""

from __future__ import annotations

import numpy as np

BLOCK = 64


class Parentheses:
    """``opens``: true for an opening, false for a closing parenthesis."""

    def __init__(self, opens: np.ndarray) -> None:
        self.opens = opens
        self.places = np.flatnonzero(opens)
        self.excess = np.cumsum(np.where(opens, 1, -1)).astype(np.int32)
        n_blocks = max(1, -(-len(opens) // BLOCK))
        self.width = 1 << (n_blocks - 1).bit_length()
        far = np.iinfo(np.int32).max
        padded = np.full(self.width * BLOCK, far, np.int32)
        padded[: len(opens)] = self.excess
        # Node 1 is the root of the tree of blocks, nodes from ``width`` on are the blocks.
        self.least = np.full(2 * self.width, far, np.int32)
        self.least[self.width :] = padded.reshape(-1, BLOCK).min(axis=1)
        step = self.width
        while step > 1:
            level = self.least[step : 2 * step]
            self.least[step // 2 : step] = np.minimum(level[::2], level[1::2])
            step //= 2
        self.padded = padded

    def close(self, places: np.ndarray) -> np.ndarray:
        """The place of the closing parenthesis of each opening one."""
        target = self.excess[places] - 1
        out = np.full(len(places), -1, np.int64)
        # What is left of the own block.
        self._scan(np.arange(len(places)), places + 1, (places // BLOCK + 1) * BLOCK, target, out)
        waiting = np.flatnonzero(out < 0)
        node = places[waiting] // BLOCK + self.width
        # Up until a right sibling holds the target, then down to its first block that does.
        climbing = np.ones(len(waiting), bool)
        while climbing.any():
            at = np.flatnonzero(climbing)
            here = node[at]
            sibling = here + 1
            found = (here & 1 == 0) & (self.least[np.minimum(sibling, len(self.least) - 1)] <= target[waiting[at]])
            node[at] = np.where(found, sibling, here >> 1)
            climbing[at[found]] = False
        inner = np.flatnonzero(node < self.width)
        while len(inner):
            left = node[inner] * 2
            node[inner] = np.where(self.least[left] <= target[waiting[inner]], left, left + 1)
            inner = inner[node[inner] < self.width]
        begin = (node - self.width) * BLOCK
        self._scan(waiting, begin, begin + BLOCK, target, out)
        return out

    def _scan(self, which: np.ndarray, begin: np.ndarray, stop: np.ndarray, target: np.ndarray, out: np.ndarray) -> None:
        """The first place of ``[begin, stop)`` with an excess of ``target``, for the queries ``which``."""
        for i in range(BLOCK):
            at = begin + i
            inside = at < stop
            hit = inside.copy()
            hit[inside] = self.padded[at[inside]] == target[which[inside]]
            out[which[hit]] = at[hit]
            left = inside & ~hit
            if not left.any():
                return
            which, begin, stop = which[left], begin[left], stop[left]

    def leaf_pairs(self) -> np.ndarray:
        """Places of opening parentheses that are closed at once."""
        return np.flatnonzero(self.opens[:-1] & ~self.opens[1:])
