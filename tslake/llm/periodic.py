"""Periodic runs of words, found with a recompression grammar.

A run is a stretch of consecutive words with smallest period q, of ``LEAST``
words and ``EXPONENT`` periods or more, that no neighbouring word extends. For
every period p a run reaches over p + g(p) words or more, g being the grid's
step max(LEAST, EXPONENT * p) - p; so one multiple x of g(p) has both x and x + p
in it. All these pairs of places, n log n of them, are candidates; those whose
words are equal are extended exactly to both sides by the grammar of
``tslake.llm.grammar``, and what comes out long enough is a run of period p. A
stretch that comes out for several periods has the smallest of them.

Texts are taken in blocks of bounded size, one grammar for a block; a very long
text is a block of its own, and its candidates are taken in pieces. Nothing is
shuffled and no text is cut.

Words are ``[^\\x20\\x09-\\x0D]+``, compared as bytes. Defined results: null text
or one without words has no runs and collapses to the empty text; rows with
equal or null doc_id are judged one by one, and a null doc_id is never
rewritten; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tslake.llm.common import SPACED, equal_spans, row_blocks, text_buffer, word_spans
from tslake.llm.grammar import Grammar

LEAST, EXPONENT = 24, 3
#: Candidates held at once.
PIECE = 1 << 20

REPORT = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def word_numbers(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A number for every word, equal for equal bytes alone; the words' first and
    end bytes; and where each text's words begin."""
    hashes, starts, ends, begins = word_spans(data, offsets, SPACED, fold=False)
    _, first, number = np.unique(hashes, return_index=True, return_inverse=True)
    raw = data.tobytes() + bytes(8)
    odd = np.flatnonzero(~equal_spans(raw, starts, ends, raw, starts[first[number]], ends[first[number]]))
    others: dict[bytes, int] = {}
    for i in odd.tolist():  # words that share another word's hash
        number[i] = others.setdefault(raw[starts[i] : ends[i]], len(first) + len(others))
    return number.astype(np.int64), starts, ends, begins


def _candidates(counts: np.ndarray, least: int, exponent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, place, period) of the grids' pairs (place, place + period), in
    pieces, texts known by their numbers of words."""
    most = np.where(counts >= least, counts // exponent, 0)
    text = np.repeat(np.arange(len(counts)), most)
    period = np.arange(1, len(text) + 1) - np.repeat(np.cumsum(most) - most, most)
    step = np.maximum(least, exponent * period) - period
    points = -(-(counts[text] - period) // step)
    ends = np.cumsum(points)
    lo = 0
    while lo < len(text):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + PIECE, "right")))
        n = points[lo:hi]
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        yield np.repeat(text[lo:hi], n), place * np.repeat(step[lo:hi], n), np.repeat(period[lo:hi], n)
        lo = hi


def runs(numbers: np.ndarray, begins: np.ndarray, least: int = LEAST, exponent: int = EXPONENT) -> np.ndarray:
    """Rows (text, start, length, period) of all runs of consecutive texts, in
    that order; the texts are sequences of non-negative numbers."""
    counts = np.diff(begins)
    # a separator before the first text and after each
    symbols = np.full(len(numbers) + len(counts) + 1, -1, np.int64)
    at = begins[:-1] + np.arange(len(counts)) + 1
    symbols[np.arange(len(numbers)) + np.repeat(np.arange(len(counts)) + 1, counts)] = numbers
    separators = np.append(0, at + counts)
    symbols[separators] = -1 - np.arange(len(separators))
    grammar, found = None, []
    for text, place, period in _candidates(counts, least, exponent):
        x = at[text] + place
        some = np.flatnonzero(symbols[x] == symbols[x + period])
        if not len(some):
            continue
        grammar = grammar or Grammar(symbols)
        text, x, period = text[some], x[some], period[some]
        ahead = grammar.extend(x, x + period)
        behind = grammar.extend_back(x, x + period)
        length = ahead + behind + period
        some = np.flatnonzero(length >= np.maximum(least, exponent * period))
        found.append(_smallest(np.stack([text[some], (x - behind - at[text])[some], length[some], period[some]], axis=1)))
    rows = _smallest(np.concatenate([np.zeros((0, 4), np.int64), *found]))
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def _smallest(rows: np.ndarray) -> np.ndarray:
    """Each stretch (text, start, length) once, with its smallest period."""
    rows = rows[np.lexsort(rows.T[::-1])]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
    return rows[new]


def redundant(found: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Which words lie in a run behind its first period."""
    change = np.zeros(int(begins[-1]) + 1, np.int64)
    first = begins[found[:, 0]] + found[:, 1]
    np.add.at(change, first + found[:, 3], 1)
    np.add.at(change, first + found[:, 2], -1)
    return np.cumsum(change[:-1]) > 0


def planted_order(doc_id: int | None, n: int) -> np.ndarray:
    """Which word stands at each place once the contract's tail is repeated: a
    tenth of the documents, chosen by a hash of doc_id, end periodically."""
    order = np.arange(n)
    if doc_id is None or n == 0:
        return order
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        order[a:] = a + (order[a:] - a) % p
    return order


Order = Callable[[int | None, int], np.ndarray]


def report(docs: DataFrame, order: Order | None = None, least: int = LEAST, exponent: int = EXPONENT) -> DataFrame:
    """Per row: doc_id, its number of runs, the run of greatest exact exponent
    (then smallest start and period), digests of all runs and of the text
    without the words that only repeat a run's period. ``order`` may rearrange
    a document's words first, by doc_id and their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            for lo, hi in row_blocks(offsets):
                ids = batch.column(0).slice(lo, hi - lo).to_pylist()
                yield _block(ids, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])

    def _block(ids: list, data: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
        numbers, starts, ends, begins = word_numbers(data, offsets)
        take = np.arange(len(numbers))
        if order is not None:
            for i, doc_id in enumerate(ids):
                take[begins[i] : begins[i + 1]] = begins[i] + order(doc_id, int(begins[i + 1] - begins[i]))
        found = runs(numbers[take], begins, least, exponent)
        gone = redundant(found, begins)
        edges = np.searchsorted(found[:, 0], np.arange(len(ids) + 1))
        raw = data.tobytes()
        out = []
        for i, doc_id in enumerate(ids):
            a, b = int(begins[i]), int(begins[i + 1])
            mine = found[edges[i] : edges[i + 1], 1:].tolist()
            words = raw[offsets[i] : offsets[i + 1]].split()
            kept = words if not mine and (take[a:b] == np.arange(a, b)).all() else [words[k] for k in (take[a:b][~gone[a:b]] - a).tolist()]
            best = min(mine, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
            listed = "".join(f"{s},{length},{q}\n" for s, length, q in mine)
            digests = hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest()
            out.append((doc_id, len(mine), *(best or (None,) * 3), best and 1000 * best[1] // best[2], *digests))
        kinds = [pa.int64()] * 6 + [pa.string()] * 2
        names = [field.split()[0] for field in REPORT.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, REPORT)
