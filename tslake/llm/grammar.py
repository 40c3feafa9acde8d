"""Run-length grammars of symbol sequences by recompression, and their longest
common extensions.

A sequence is compressed in alternate rounds: block compression names every
maximal repetition of one symbol by (symbol, length); pair compression deals the
symbols into left and right ones and names every adjacent (left, right) pair.
Equal stretches are compressed alike but for a few symbols at their ends, so two
places are compared by rising through the rounds while the symbols are equal and
both places begin a symbol of the next round, and by descending where they
differ. All queries take their steps together, as numpy arrays.

Several texts share one grammar: a separator, a symbol of its own, stands before
the first and after every text, so that no extension leaves its text.
"""

from __future__ import annotations

import numpy as np

from tslake.llm.common import mix64

#: Deals of symbols into left and right that a pair round chooses from.
DEALS = 4


class Grammar:
    """Rounds of a sequence whose separators are the symbols below zero, each of
    them unique."""

    def __init__(self, symbols: np.ndarray):
        self._symbols, self._up, self._up_last, self._down, self._down_last = [], [], [], [], []
        self._ahead, self._behind = [], []
        self._base, level, names = 0, symbols.astype(np.int64), int(symbols.max(initial=0)) + 1
        down = down_last = np.full(len(level), -1)
        seed = 0
        while True:
            block = _block_starts(level)
            if len(block) < len(level):
                lengths = np.diff(np.append(block, len(level)))
                self._round(level, down, down_last, block, lengths)
                down, down_last = self._below(block, lengths)
                level, names = _named(level[block], lengths, lengths > 1, names)
            starts, paired, seed = _pair_starts(level, seed)
            if not paired.any():
                break
            lengths = 1 + paired.astype(np.int64)
            self._round(level, down, down_last, starts, lengths, blocks=False)
            down, down_last = self._below(starts, lengths)
            level, names = _named(level[starts], level[np.minimum(starts + 1, len(level) - 1)], paired, names)
        self._round(level, down, down_last, None, None)
        flat = (self._symbols, self._up, self._up_last, self._down, self._down_last, self._ahead, self._behind)
        self.symbols, self.up, self.up_last, self.down, self.down_last, self.ahead, self.behind = map(np.concatenate, flat)

    def _round(self, level, down, down_last, starts, lengths, blocks: bool = True) -> None:
        """Keep a round's symbols and how they are taken together in the next."""
        n = len(level)
        up, up_last, one = np.full(n, -1), np.full(n, -1), np.ones(n, np.int64)
        ahead = behind = one
        if starts is not None:
            above = self._base + n + np.arange(len(starts))
            up[starts] = above
            up_last[starts + lengths - 1] = above
            if blocks:
                place = np.arange(n) - np.repeat(starts, lengths)
                behind, ahead = place + 1, np.repeat(lengths, lengths) - place
        for kept, value in zip((self._symbols, self._up, self._up_last, self._down, self._down_last, self._ahead, self._behind), (level, up, up_last, down, down_last, ahead, behind)):
            kept.append(value)
        self._below_base, self._base = self._base, self._base + n

    def _below(self, starts, lengths) -> tuple[np.ndarray, np.ndarray]:
        return self._below_base + starts, self._below_base + starts + lengths - 1

    def extend(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols from the places a and b (a <> b) on are equal."""
        return self._walk(a, b, self.up, self.down, self.ahead, 1)

    def extend_back(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols before the places a and b are equal."""
        return self._walk(a - 1, b - 1, self.up_last, self.down_last, self.behind, -1)

    def _walk(self, a, b, up, down, run, step: int) -> np.ndarray:
        out, origin = np.zeros(len(a), np.int64), a
        who, a, b, rising = np.arange(len(a)), a.copy(), b.copy(), np.ones(len(a), bool)
        while len(who):
            same = self.symbols[a] == self.symbols[b]
            differ = np.flatnonzero(~same)
            ended = differ[down[a[differ]] < 0]
            out[who[ended]] = step * (a[ended] - origin[who[ended]])
            rise = same & rising & (up[a] >= 0) & (up[b] >= 0)
            go = np.flatnonzero(same & ~rise)
            skip = step * np.minimum(run[a[go]], run[b[go]])
            a[go], b[go] = a[go] + skip, b[go] + skip
            a[rise], b[rise] = up[a[rise]], up[b[rise]]
            rising[differ] = False
            a[differ], b[differ] = down[a[differ]], down[b[differ]]
            if len(ended):
                left = np.ones(len(who), bool)
                left[ended] = False
                who, a, b, rising = who[left], a[left], b[left], rising[left]
        return out


def _block_starts(level: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], level[1:] != level[:-1]]))


def _named(first: np.ndarray, second: np.ndarray, new: np.ndarray, names: int) -> tuple[np.ndarray, int]:
    """The next round's symbols: a fresh name for each distinct (first, second)
    where ``new``, the first alone elsewhere."""
    out = first.copy()
    keys, name = np.unique(first[new] << 32 | second[new], return_inverse=True)
    out[new] = names + name
    return out, names + len(keys)


def _pair_starts(level: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Where symbols of the next round begin, and which of them are pairs, by the
    deal of a few that pairs most."""
    word = level >= 0
    free = word[:-1] & word[1:]
    if not free.any():
        return np.arange(len(level)), np.zeros(len(level), bool), seed
    best, most = None, 0
    while most == 0:  # neighbours differ, so a deal parts some pair soon
        for _ in range(DEALS):
            seed += 1
            left = (mix64(level.astype(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) & np.uint64(1)).astype(bool)
            pairs = free & left[:-1] & ~left[1:]
            if (n := int(pairs.sum())) > most:
                best, most = pairs, n
    begins = np.ones(len(level), bool)
    begins[1:][best] = False
    starts = np.flatnonzero(begins)
    return starts, np.append(best, False)[starts], seed
