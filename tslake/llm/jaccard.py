"""N-gram Jaccard join by PartEnum signatures.

Sets are banded by size so that two sets of similarity ``PERCENT`` or more lie
in the same or in adjacent bands; every set signs in its own band's instance
and in the next one's. An instance bounds the Hamming distance of such a pair
by k. Its domain (the shingle hashes) is dealt into n1 parts, of which one at
least holds at most one difference, and each part into n2 pieces; a signature
is the content of a part less one piece, so at least one of the n1 * n2
signatures of two similar sets is equal. How signatures become links and
components, and all defined results, are told in ``tslake.llm.linking``.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tslake.llm import linking
from tslake.llm.common import mix64

WORDS = 3
#: Two sets link when 100 * intersection >= PERCENT * union.
PERCENT = 90

def budget(sizes, percent: int = PERCENT):
    """Largest Hamming distance of linked sets whose sizes add up to ``sizes``."""
    return sizes * (100 - percent) // (100 + percent)


def bands(largest: int, percent: int = PERCENT) -> np.ndarray:
    """Upper ends of the size bands, two beyond the largest size."""
    ends = [1]
    while len(ends) < 3 or ends[-3] < largest:
        ends.append((ends[-1] + 1) * 100 // percent)
    return np.array(ends, np.int64)


def parts(end: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """(n1, n2) of instances by their band's upper end; n1 is 0 where only equal sets link.

    Small sets get more pieces, so that a signature still covers enough shingles,
    and so do all below 85 %, whose parts are half as large as at 90 %.
    """
    k = budget(2 * end, percent)
    return np.where(k > 0, (k + 2) // 2, 0), np.where(end < 60, 4, np.where((end < 200) | (percent < 85), 3, 2))


def _signatures(elements: np.ndarray, owner: np.ndarray, sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(owner, signature) of all sets in both of their instances."""
    ends = bands(int(sizes.max(initial=1)), percent)
    place, weight = mix64(elements ^ np.uint64(0x5851F42D4C957F2D)), mix64(elements + np.uint64(0x14057B7EF767814F))
    high, low = (place >> np.uint64(32)).astype(np.int64), (place & np.uint64(0xFFFFFFFF)).astype(np.int64)
    owners, signatures = [], []
    for step in (0, 1):
        instance = np.searchsorted(ends, sizes) + step
        n1, n2 = parts(ends[instance], percent)
        n1[sizes == 0] = 0
        for pieces in (2, 3, 4):
            some = np.flatnonzero((n2 == pieces) & (n1 > 0))
            if not len(some):
                continue
            first = np.zeros(len(sizes), np.int64)
            first[some] = np.cumsum(n1[some]) - n1[some]
            total = int(n1[some].sum())
            mine = np.flatnonzero((n2[owner] == pieces) & (n1[owner] > 0))
            o = owner[mine]
            sums = np.zeros(total * pieces, np.uint64)
            np.add.at(sums, (first[o] + high[mine] % n1[o]) * pieces + low[mine] % pieces, weight[mine])
            sums = sums.reshape(total, pieces)
            rest = sums.sum(axis=1, dtype=np.uint64)[:, None] - sums
            who = np.repeat(some, n1[some])
            part = np.arange(total) - first[who]
            name = (instance[who] * 4 + pieces).astype(np.uint64) << np.uint64(40) | part.astype(np.uint64) << np.uint64(3)
            signatures.append(mix64(rest + mix64(name[:, None] | np.arange(pieces, dtype=np.uint64))).ravel())
            owners.append(np.repeat(who, pieces))
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(owners), np.concatenate(signatures)


def method(percent: int = PERCENT, words: int = WORDS) -> linking.Method:
    def signatures(elements: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.diff(at)
        return _signatures(elements, np.repeat(np.arange(len(sizes)), sizes), sizes, percent)

    return linking.Method("jaccard", words, percent, signatures)


def join(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable by links)."""
    return linking.join(docs, method(percent, words))


def one_of_each(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """``docs`` with one row of each component: that of its smallest doc_id, of
    rows that repeat this id the smallest by hash and values. Rows without doc_id
    stay; all columns stay."""
    found = join(docs.select("doc_id", "text"), percent, words)
    firsts = found.filter("doc_id = component_id").select("doc_id").distinct()
    row = F.struct(*docs.columns)
    # only the smallest ids' rows are compared, so a group of copies costs nothing here
    first = docs.join(firsts, "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by(row, F.xxhash64(*docs.columns)).alias("_row")).select("_row.*")
    return first.select(*docs.columns).unionByName(docs.filter("doc_id is null").select(*docs.columns))


def sql(percent: int = PERCENT, words: int = WORDS) -> str:
    """DuckDB SQL for the rows of ``join``."""
    return linking.sql(percent, words)


SQL = sql()
