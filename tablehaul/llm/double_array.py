"""A double-array trie over byte strings, held in three flat arrays.

State s has the child by byte c at ``t = base[s] + c`` if ``check[t] == s``; ``value[t]`` is the
number of the string that ends there, or -1. Walks are array look-ups, for one text or for many
side by side.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ROOT = 0


@dataclass(frozen=True)
class DoubleArray:
    base: np.ndarray
    check: np.ndarray
    value: np.ndarray

    def step(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The child of each state by each byte, or -1."""
        to = self.base[states] + codes
        return np.where(self.check[to] == states, to, -1)


def build(strings: dict[bytes, int]) -> DoubleArray:
    """A trie of the strings and their numbers."""
    tree: dict = {}
    for s, number in strings.items():
        node = tree
        for c in s:
            node = node.setdefault(c, {})
        node[-1] = number  # no byte is negative
    size = 1 << 12
    base, check, value = (np.full(size, fill, np.int32) for fill in (0, -1, -1))
    used = bytearray(size)
    used[ROOT] = 1
    # The first free slot that every byte can reach; where slots for several children are sought.
    free, start = 257, 257
    todo = [(ROOT, tree)]
    while todo:
        following = []
        for state, node in todo:
            if -1 in node:
                value[state] = node[-1]
            codes = sorted(c for c in node if c >= 0)
            while free + 600 >= size or start + 600 >= size:
                size, base, check, value, used = _grown(base, check, value, used)
            if len(codes) < 2:  # any free slot does
                at = free - codes[0] if codes else 1
            else:
                at, tries = start, 0
                while any(used[at + c] for c in codes):
                    at, tries = at + 1, tries + 1
                    if at + 600 >= size:
                        size, base, check, value, used = _grown(base, check, value, used)
                if tries > 32:  # crowded so far: leave the holes to single children
                    start = at
            base[state] = at
            for c in codes:
                used[at + c] = 1
                check[at + c] = state
                following.append((at + c, node[c]))
            while used[free]:
                free += 1
        todo = following
    # walks may look 256 beyond the last base
    end = int(base.max()) + 257
    return DoubleArray(base[:end].copy(), check[:end].copy(), value[:end].copy())


def _grown(base, check, value, used):
    n = len(base)
    grow = lambda a, fill: np.concatenate([a, np.full(n, fill, np.int32)])
    return 2 * n, grow(base, 0), grow(check, -1), grow(value, -1), used + bytearray(n)
