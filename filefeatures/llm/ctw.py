"""Context-tree weighting over bytes, as numpy over sorted tables of byte strings.

A gram is a byte and the `depth` bytes before it, as one integer: the nearest of them in the highest byte, the byte itself
in the lowest. So the contexts of any length are prefixes of the integer, and sorted grams hold each subtree of the
context tree in one stretch.

Each byte is eight binary decisions. A node is a context and the bits already decided. At each node the
Krichevsky-Trofimov estimator gives the next bit from the zeros and ones seen there, and the weighted probability of what
was seen is half the estimator's and half the product over the contexts one byte longer:

    Pw(node) = Pe(node) / 2 + product of Pw(longer nodes) / 2

A bit's probability mixes all depths: at each node Pe's share is what it holds of Pw. Contexts never seen in training have
nothing to say, and their parent's estimate stands.
"""

from __future__ import annotations

import numpy as np

BITS = 8
END = 0x0A  # closes a text; words hold no white space, so it occurs nowhere else


def grams(data: np.ndarray, depth: int) -> np.ndarray:
    """For every byte from position `depth` on, its gram."""
    count = len(data) - depth
    out = np.zeros(count, np.int64)
    for back in range(1, depth + 1):
        out = out << 8 | data[depth - back : depth - back + count]
    return out << 8 | data[depth:]


def _series(n: np.ndarray, shift: float) -> np.ndarray:
    """log Gamma(n + shift) for whole n >= 0 and shift 1/2 or 1: Stirling's series, and the recurrence for small n."""
    x = n + shift
    low = x < 10
    rise = np.where(low, 10.0, 0.0)
    y = x + rise
    series = (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    if low.any():
        steps = np.ones(int(low.sum()))
        for k in range(10):
            steps *= x[low] + k
        series[low] -= np.log(steps)
    return series


_FIRST = {shift: _series(np.arange(1 << 12, dtype=np.float64), shift) for shift in (0.5, 1.0)}


def _log_gamma(n: np.ndarray, shift: float) -> np.ndarray:
    """log Gamma(n + shift): most nodes are seen a few times, so the first values are looked up."""
    first = _FIRST[shift]
    found = first[np.minimum(n, len(first) - 1).astype(np.int64)]
    large = np.flatnonzero(n >= len(first))
    if len(large):
        found[large] = _series(n[large], shift)
    return found


def estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """log of the Krichevsky-Trofimov probability of so many zeros and ones, in any order."""
    return _log_gamma(zeros, 0.5) + _log_gamma(ones, 0.5) - np.log(np.pi) - _log_gamma(zeros + ones, 1.0)


class Level:
    """The nodes of one context length and one number of decided bits, sorted by key = context << 8 | 1 << bits | decided."""

    def __init__(self, keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray):
        self.keys, self.zeros, self.ones = keys, zeros, ones
        self.log_pe = estimate(zeros, ones)
        self.log_pw = self.log_pe

    def add_longer(self, keys: np.ndarray, log_pw: np.ndarray) -> None:
        """The weighted probabilities of the nodes one byte longer, by the key of their parent here."""
        product = np.bincount(np.searchsorted(self.keys, keys), weights=log_pw, minlength=len(self.keys))
        self.log_pw = np.logaddexp(self.log_pe, product) - np.log(2)

    def mix(self, keys: np.ndarray, bits: np.ndarray, longer: np.ndarray) -> np.ndarray:
        """Probability of the bit at each key, given that of the longer contexts (NaN where these were never seen)."""
        if not len(self.keys):
            return longer
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        seen = self.keys[at] == keys
        zeros, ones = self.zeros[at], self.ones[at]
        own = (np.where(bits, ones, zeros) + 0.5) / (zeros + ones + 1)
        share = np.exp(np.log(0.5) + self.log_pe - self.log_pw)[at]
        mixed = np.where(np.isnan(longer), own, share * own + (1 - share) * longer)
        return np.where(seen, mixed, longer)


def node_keys(grams_: np.ndarray, depth: int, length: int, bits: int) -> np.ndarray:
    """Keys of the nodes that these grams pass, with a context of `length` bytes and `bits` bits decided."""
    context = grams_ >> 8 * (depth - length + 1)
    return context << 8 | 1 << bits | (grams_ & 0xFF) >> (BITS - bits)


class Tree:
    """Nodes with contexts of `shortest` .. `depth` bytes, from sorted distinct grams and how often each was seen."""

    def __init__(self, grams_: np.ndarray, counts: np.ndarray, depth: int, shortest: int = 0):
        self.depth, self.shortest = depth, shortest
        seen = counts > 0
        grams_, counts = grams_[seen], counts[seen].astype(np.float64)
        self.levels: dict[tuple[int, int], Level] = {}
        for length in range(depth, shortest - 1, -1):
            # Grams cut to this context length and the byte; bytes are not sorted below a cut context.
            cut = grams_ >> 8 * (depth - length + 1) << 8 | grams_ & 0xFF
            if length < depth:
                order = np.argsort(cut, kind="stable")
                cut, weight = cut[order], counts[order]
            else:
                weight = counts
            for bits in range(BITS):
                key = (cut >> 8) << 8 | 1 << bits | (cut & 0xFF) >> (BITS - bits)
                one = (cut >> (BITS - 1 - bits)) & 1
                starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
                total = np.add.reduceat(weight, starts) if len(key) else weight
                ones = np.add.reduceat(weight * one, starts) if len(key) else weight
                level = self.levels[length, bits] = Level(key[starts], total - ones, ones)
                if length < depth:
                    longer = self.levels[length + 1, bits]
                    level.add_longer(parent_keys(longer.keys), longer.log_pw)

    def bit_probabilities(self, grams_: np.ndarray, bits: int) -> np.ndarray:
        """Of the bit after `bits` decided ones, mixed over the depths of this tree; NaN where none was seen."""
        mixed = np.full(len(grams_), np.nan)
        bit = (grams_ >> (BITS - 1 - bits)) & 1
        for length in range(self.depth, self.shortest - 1, -1):
            mixed = self.levels[length, bits].mix(node_keys(grams_, self.depth, length, bits), bit, mixed)
        return mixed


def parent_keys(keys: np.ndarray) -> np.ndarray:
    """Keys of the nodes whose context is one byte shorter, at its far end."""
    return (keys >> 16) << 8 | keys & 0xFF


def levels_of(keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, longer: np.ndarray) -> dict[int, Level]:
    """Nodes of one context length as levels by decided bits; longer: log of the product over the nodes one byte longer."""
    levels = {}
    decided = np.frexp((keys & 0xFF).astype(np.float64))[1] - 1
    for bits in range(BITS):
        own = decided == bits
        level = levels[bits] = Level(keys[own], zeros[own], ones[own])
        level.log_pw = np.logaddexp(level.log_pe, longer[own]) - np.log(2)
    return levels


class Top:
    """The nodes with contexts shorter than `length`, from those at `length` - 1 with the product over their longer ones."""

    def __init__(self, length: int, keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, longer: np.ndarray):
        """keys: sorted keys of the longest contexts here, of all numbers of bits; longer: log of the product."""
        self.length = length
        self.levels: dict[tuple[int, int], Level] = {}
        for bits, level in levels_of(keys, zeros, ones, longer).items():
            self.levels[length - 1, bits] = level
            for shorter in range(length - 2, -1, -1):
                below = self.levels[shorter + 1, bits]
                up, back = np.unique(parent_keys(below.keys), return_inverse=True)
                added = [np.bincount(back, weights=x, minlength=len(up)) for x in (below.zeros, below.ones)]
                level = self.levels[shorter, bits] = Level(up, *added)
                level.add_longer(parent_keys(below.keys), below.log_pw)

    def mix(self, grams_: np.ndarray, depth: int, bits: int, longer: np.ndarray) -> np.ndarray:
        bit = (grams_ >> (BITS - 1 - bits)) & 1
        for length in range(self.length - 1, -1, -1):
            longer = self.levels[length, bits].mix(node_keys(grams_, depth, length, bits), bit, longer)
        return np.where(np.isnan(longer), 0.5, longer)
