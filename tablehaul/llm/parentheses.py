"""Trees as balanced parentheses: one bit where a node opens, another where it closes."""

from __future__ import annotations

import numpy as np

#: Parentheses of a block of the range min-max tree.
BLOCK = 64


class Parentheses:
    """A tree by the depths of its nodes in preorder; the first node is the root, of depth 0.

    The excess of openings over closings is kept with its least and largest value per block
    and per pair of blocks, of pairs and so on, so that the place where a node closes is found by
    going up and down that tree.
    """

    def __init__(self, depths: np.ndarray):
        n = len(depths)
        self.opens = 2 * np.arange(n) - depths  # so many nodes opened, all but ``depth`` closed
        bits = np.zeros(2 * n, bool)
        bits[self.opens] = True
        excess = np.cumsum(np.where(bits, 1, -1))
        self.pairs = np.concatenate([[0], np.cumsum(bits[:-1] & ~bits[1:])])
        n_blocks = 1 << max(0, -(-len(excess) // BLOCK) - 1).bit_length()
        padded = np.full(n_blocks * BLOCK, 1 << 40, np.int64)
        padded[: len(excess)] = excess
        self.excess = padded.reshape(n_blocks, BLOCK)
        lows, highs = [self.excess.min(axis=1)], [np.where(self.excess < 1 << 40, self.excess, -1).max(axis=1)]
        while len(lows[-1]) > 1:
            lows.append(lows[-1].reshape(-1, 2).min(axis=1))
            highs.append(highs[-1].reshape(-1, 2).max(axis=1))
        self.low, self.high = np.concatenate(lows), np.concatenate(highs)
        self.level_at = np.cumsum([0] + [len(x) for x in lows])[:-1]

    def _holds(self, level: np.ndarray, index: np.ndarray, want: np.ndarray) -> np.ndarray:
        at = self.level_at[level] + index
        return (self.low[at] <= want) & (want <= self.high[at])

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        """Where the parentheses that open at these places close."""
        out = np.empty(len(opens), np.int64)
        for at in range(0, len(opens), 1 << 14):
            out[at : at + (1 << 14)] = self._findclose(opens[at : at + (1 << 14)])
        return out

    def _findclose(self, opens: np.ndarray) -> np.ndarray:
        block, inside = np.divmod(opens, BLOCK)
        want = self.excess[block, inside] - 1
        hit = (self.excess[block] == want[:, None]) & (np.arange(BLOCK) > inside[:, None])
        out = block * BLOCK + hit.argmax(axis=1)
        rest = np.flatnonzero(~hit.any(axis=1))
        if not len(rest):
            return out
        want, level, index = want[rest], np.zeros(len(rest), np.int64), block[rest] + 1
        while True:  # up and to the right, to the first range that holds the excess
            out_of = ~self._holds(level, index, want)
            if not out_of.any():
                break
            up = out_of & (index % 2 == 1)
            index = np.where(up, index // 2 + 1, np.where(out_of, index + 1, index))
            level = level + up
        while level.any():  # and down to its first block
            deep = level > 0
            level = level - deep
            index = np.where(deep, 2 * index, index)
            index = index + (deep & ~self._holds(level, index, want))
        out[rest] = index * BLOCK + (self.excess[index] == want[:, None]).argmax(axis=1)
        return out

    def sizes(self) -> tuple[np.ndarray, np.ndarray]:
        """Nodes, and leaves (pairs that close as they open), of each node's subtree."""
        close = self.findclose(self.opens)
        return (close - self.opens + 1) // 2, self.pairs[close] - self.pairs[self.opens]
