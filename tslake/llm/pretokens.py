"""Pre-tokens of a byte-level vocabulary, each distinct one computed once.

Texts are split by the vocabulary's pattern; distinct pre-tokens get a row in a
pool that a subclass fills (token ids, counts). The pool is emptied when it
holds ``pool_limit`` pre-tokens, so a task's memory does not grow with its
input; results do not depend on it.
"""

from __future__ import annotations

import base64
from collections.abc import Callable

import numpy as np

POOL_LIMIT = 300_000


def read_ranks(path: str) -> list[bytes]:
    """Tokens of a rank file (base64 token, rank) in rank order."""
    with open(path, "rb") as lines:
        ranked = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    if sorted(ranked) != list(range(len(ranked))):
        raise ValueError(f"{path}: ranks must run from 0 without gaps")
    return [ranked[i] for i in range(len(ranked))]


def ragged(flat: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The concatenated rows ``flat[offsets[r]:offsets[r + 1]]`` and their offsets."""
    lengths = offsets[rows + 1] - offsets[rows]
    out = np.zeros(len(rows) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    index = np.arange(out[-1])
    index += np.repeat(offsets[rows] - out[:-1], lengths)
    return flat[index], out


def flatten(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.zeros(len(rows) + 1, np.int64)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    return np.frombuffer(b"".join(rows), np.uint8), offsets


class HashTable:
    """Whole numbers from 0 -> int32 values, open addressing with linear probing."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, missing: int):
        self.bits, self.missing = max(4, (4 * len(keys)).bit_length()), np.int32(missing)
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, missing, np.int32)
        slots = self._slot(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[slots] < 0)
            at, first = np.unique(slots[free], return_index=True)
            chosen = free[first]
            self.keys[at], self.values[at] = keys[chosen], values[chosen]
            rest = np.ones(len(keys), bool)
            rest[chosen] = False
            keys, values, slots = keys[rest], values[rest], self._next(slots[rest])

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _next(self, slots: np.ndarray) -> np.ndarray:
        return (slots + 1) & ((1 << self.bits) - 1)

    def look_up(self, keys: np.ndarray) -> np.ndarray:
        """Values of the keys, ``missing`` where there is none; negative keys have none."""
        slots = self._slot(keys)
        found = self.keys[slots]
        out = np.where((found == keys) & (keys >= 0), self.values[slots], self.missing)
        open_ = np.flatnonzero((found != keys) & (found >= 0) & (keys >= 0))
        while len(open_):
            slots[open_] = self._next(slots[open_])
            found = self.keys[slots[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.values[slots[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out


class PieceCodes:
    """Codes of the distinct pre-tokens seen so far; ``find`` splits a text."""

    def __init__(self, find: Callable[[str], list], pool_limit: int = POOL_LIMIT):
        self.find, self.pool_limit = find, pool_limit
        self.codes: dict = {}

    def number(self, pieces: list) -> None:
        self.codes.update(zip(pieces, range(len(self.codes), len(self.codes) + len(pieces))))

    def clear(self) -> None:
        raise NotImplementedError

    def add(self, pieces: list) -> None:
        """Append the pieces to the pool and number them on in ``codes``."""
        raise NotImplementedError

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Codes of all pre-tokens in order, and where each text's begin."""
        if len(self.codes) > self.pool_limit:
            self.codes = {}
            self.clear()
        begins, pieces = np.zeros(len(texts) + 1, np.int64), []
        for i, text in enumerate(texts):
            pieces += self.find(text)
            begins[i + 1] = len(pieces)
        new = list(set(pieces).difference(self.codes))
        if new:
            self.add(new)
        return np.fromiter(map(self.codes.__getitem__, pieces), np.int64, len(pieces)), begins
