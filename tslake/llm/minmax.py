"""Near-duplicates by min-max hashing.

Under each of ``PERMUTATIONS`` hash functions a set keeps both its smallest and
its largest value: either of them agrees between two sets with their Jaccard
similarity as probability, so one hash evaluation gives two unbiased values, and
as smallest and largest of one function lie apart, estimates vary less than with
as many smallest values of as many functions. ``ROWS`` values make a band; the
smallest and the largest values are banded apart, and a band's hash is a
signature of ``tslake.llm.linking``, which confirms links on the full sets.

A pair at the threshold shares no band with a probability of 2.4e-7; no link of the
tests' or the given tables is lost. Sets too small for any other to be similar and not equal sign
nothing. Defined results are those of ``tslake.llm.linking``; a row without
doc_id is kept.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tslake.llm import linking
from tslake.llm.common import mix64

WORDS, PERCENT = 3, 85
PERMUTATIONS, ROWS = 192, 8
#: Odd factors: shingle hashes are uniform already, so a product modulo 2^64 orders them anew.
_FACTORS = mix64(np.arange(1, PERMUTATIONS + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) | np.uint64(1)


def extremes(elements: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The smallest and the largest values of consecutive non-empty sets under
    each function: an array (2, functions, sets)."""
    out = np.zeros((2, PERMUTATIONS, len(at) - 1), np.uint64)
    for k, factor in enumerate(_FACTORS):
        values = elements * factor
        np.minimum.reduceat(values, at[:-1], out=out[0, k])
        np.maximum.reduceat(values, at[:-1], out=out[1, k])
    return out


def bands(values: np.ndarray) -> np.ndarray:
    """A signature for each band and set from ``extremes``: (bands, sets)."""
    n = PERMUTATIONS // ROWS
    out = []
    for side in (0, 1):
        grouped = values[side, : n * ROWS].reshape(n, ROWS, -1)
        names = mix64(np.arange(n, dtype=np.uint64) * np.uint64(2) + np.uint64(side + 1))
        total = np.repeat(names[:, None], grouped.shape[2], axis=1)
        for row in range(ROWS):
            total = mix64(total ^ grouped[:, row])
        out.append(total)
    return np.concatenate(out)


def _some(at: np.ndarray, least: int) -> np.ndarray:
    return np.flatnonzero(np.diff(at) >= least)


def _extremes_of(elements: np.ndarray, at: np.ndarray, some: np.ndarray) -> np.ndarray:
    """``extremes`` of the sets ``some``."""
    mine = np.zeros(len(at) - 1, bool)
    mine[some] = True
    sizes = np.diff(at)
    inside = elements[np.repeat(mine, sizes)]
    return extremes(inside, np.concatenate([[0], np.cumsum(sizes[some])])) if len(some) else np.zeros((2, PERMUTATIONS, 0), np.uint64)


def method(percent: int = PERCENT, words: int = WORDS) -> linking.Method:
    # a set of n shingles and one of n + 1 are similar from this n on
    least = math.ceil(percent / (100 - percent))

    def signatures(elements: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        some = _some(at, least)
        found = bands(_extremes_of(elements, at, some))
        return np.tile(some, len(found)), found.ravel()

    return linking.Method("minmax", words, percent, signatures)


def join(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept (whether the doc_id is its component's)."""
    return linking.join(docs, method(percent, words)).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


SQL = f"""SELECT *, doc_id IS NOT DISTINCT FROM component_id AS kept FROM ({linking.sql(PERCENT, WORDS)})"""
