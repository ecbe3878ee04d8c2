"""Winnowed anchors of token sequences, vectorised for one text at a time.

A window is `length` consecutive tokens. Each window selects the least of its `k`-grams (by a hash,
the leftmost among equal ones), its anchor; equal windows select the same k-gram at the same place
in them. So windows can only be equal if their anchors are, and a text has few anchors: about two
for every `length - k` tokens, each with the run of window starts that select it.
"""

from __future__ import annotations

import numpy as np

#: Two odd bases of rolling hashes modulo 2**64, and a constant that spreads their bits.
BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED05)
_SPREAD = np.uint64(0xFF51AFD7ED558CCD)
_LOW = np.uint64(0xFFFFFFFF)


class _Powers:
    """Powers of a base and of its inverse, grown to the longest text seen."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 16)
            self.up, self.down = self._all(self.base, size), self._all(self.inverse, size)
        return self.up, self.down

    @staticmethod
    def _all(base: int, size: int) -> np.ndarray:
        factors = np.full(size, base, dtype=np.uint64)
        factors[0] = 1
        return np.multiply.accumulate(factors)


_POWERS = tuple(_Powers(base) for base in BASES)


def spread(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * _SPREAD
    return x ^ (x >> np.uint64(29))


class Rolling:
    """Hashes of any stretch of 64-bit tokens in constant time."""

    def __init__(self, tokens: np.ndarray, which: int = 0):
        up, self.down = _POWERS[which].get(len(tokens) + 1)
        self.sums = np.zeros(len(tokens) + 1, dtype=np.uint64)
        np.cumsum(tokens * up[: len(tokens)], out=self.sums[1:])

    def all(self, length: int) -> np.ndarray:
        """The hash at every start."""
        n = len(self.sums) - length
        if n <= 0:
            return np.empty(0, dtype=np.uint64)
        return spread((self.sums[length:] - self.sums[:n]) * self.down[:n])

    def between(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return spread((self.sums[ends] - self.sums[starts]) * self.down[starts])


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` consecutive values, from running minima of blocks."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    padded = np.full(-(-len(x) // width) * width, np.iinfo(x.dtype).max, dtype=x.dtype)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, width)
    onward = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], onward[width - 1 : width - 1 + n])


def anchors(grams: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor places, and the first and last window start that selects each; `grams` are the
    hashes of all k-grams and `width` is their number in a window."""
    order = (spread(grams) & ~_LOW) | np.arange(len(grams), dtype=np.uint64)
    chosen = (sliding_minimum(order, width) & _LOW).astype(np.int64)
    if not len(chosen):
        return chosen, chosen, chosen
    first = np.flatnonzero(np.append(True, chosen[1:] != chosen[:-1]))
    last = np.append(first[1:], len(chosen)) - 1
    return chosen[first], first, last
