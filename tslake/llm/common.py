"""Helpers shared by the operators: let-bindings in SQL lambdas, text buffers
of Arrow batches and vectorised word hashes."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyspark
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text handled at once inside a task; bounds the temporary arrays.
BLOCK_BYTES = 2 << 20
#: Rows in an Arrow batch at most; a batch of texts is held by the JVM and by the worker.
BATCH_ROWS = 2000
SEGMENT_BYTES = 1 << 19

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def bounded_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def share(spark: SparkSession, value) -> Broadcast:
    """Broadcast a value whose size its maker bounds, pickled by value."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def held(shared: Broadcast):
    """The shared value in a task. A worker process keeps the value of the last
    broadcast it used, with what that has learnt, for its next tasks; the one
    before is let go, so workers do not grow from query to query."""
    kept = pyspark.__dict__.setdefault("_held", {})
    if id(shared) not in kept:
        kept.clear()
        kept[id(shared)] = shared, pickle.loads(shared.value)
    return kept[id(shared)][1]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    A column that is used inside a lambda would otherwise be inlined there and
    computed again for each element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(text, UPPER, LOWER)


# ---------------------------------------------------------------- text buffers


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``limit`` bytes each, one row at least."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


# ----------------------------------------------------------------- word hashes

LOWER_BYTES = bytes.maketrans(UPPER.encode(), LOWER.encode())
_STEP, _LENGTH = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
#: Masks of the last block's first 0 to 8 bytes.
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Words between white space: [^\x20\x09-\x0D]+
SPACED = np.ones(256, bool)
SPACED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: Words of letters and digits: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def lowered(data: np.ndarray) -> bytes:
    """The bytes with A-Z lower-cased, and eight zero bytes behind them."""
    return data.tobytes().translate(LOWER_BYTES) + bytes(8)


def _blocks(lower: bytes, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words' bytes, eight to a block and the last one padded with zeros;
    how many blocks each word has and where its blocks begin."""
    eight = np.ndarray((len(lower) - 7,), "<u8", lower, 0, (1,))  # the eight bytes from every place on
    counts = (lengths + 7) >> 3
    first = np.cumsum(counts) - counts
    blocks = eight[np.repeat(starts - 8 * first, counts) + 8 * np.arange(counts.sum())]
    blocks[first + counts - 1] &= _MASKS[lengths - 8 * (counts - 1)]
    return blocks, counts, first


def hash_spans(lower: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of non-empty byte strings of ``lowered`` data. Every block
    of eight bytes is mixed with its place before the blocks are added up."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    blocks, counts, first = _blocks(lower, starts, lengths)
    place = (np.arange(len(blocks)) - np.repeat(first, counts)).astype(np.uint64)
    mixed = mix64(mix64(blocks + _STEP) + place * _STEP)
    return mix64(np.add.reduceat(mixed, first) + lengths.astype(np.uint64) * _LENGTH)


def equal_spans(lower: bytes, starts: np.ndarray, ends: np.ndarray, other: bytes, other_starts: np.ndarray, other_ends: np.ndarray) -> np.ndarray:
    """Whether non-empty byte strings, taken pair by pair, have the same bytes."""
    lengths = ends - starts
    same = lengths == other_ends - other_starts
    at = np.flatnonzero(same)
    if len(at):
        mine, _, first = _blocks(lower, starts[at], lengths[at])
        theirs, _, _ = _blocks(other, other_starts[at], lengths[at])
        same[at] = np.logical_and.reduceat(mine == theirs, first)
    return same


def _segment_words(data: np.ndarray, breaks: np.ndarray, kind: np.ndarray, fold: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    word = kind[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    last = word.copy()
    last[:-1] &= ~word[1:]
    inner = breaks[(breaks > 0) & (breaks < len(data))]
    first[inner] = word[inner]
    last[inner - 1] = word[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, hash_spans(lowered(data) if fold else data.tobytes() + bytes(8), starts, ends)


def word_spans(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray, breaks: np.ndarray | None = None, fold: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes (64 bits), first and end bytes of the words of consecutive texts
    (with A-Z lower-cased if ``fold``), and for each text where its words begin (one entry more
    than texts). ``breaks`` are further places where words end, as at the
    texts' offsets.

    Works segment by segment, so that beside the
    hashes only a bounded part of a very long text is expanded at a time.
    """
    n, at, found = len(data), 0, []
    edges = offsets if breaks is None else np.unique(np.concatenate([offsets, breaks]))
    while at < n:
        end = min(at + SEGMENT_BYTES, n)
        if end < n:
            gaps = np.flatnonzero(~kind[data[at:end]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
            else:  # a word longer than a segment
                while end < n and kind[data[end]]:
                    end = min(n, end + SEGMENT_BYTES)
                    gaps = np.flatnonzero(~kind[data[at:end]])
                    if len(gaps):
                        end = at + int(gaps[0])
                        break
        lo, hi = np.searchsorted(edges, [at, end])
        starts, ends, hashes = _segment_words(data[at:end], edges[lo:hi] - at, kind, fold)
        found.append((starts + at, ends + at, hashes))
        at = end
    if not found:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, np.zeros(len(offsets), np.int64)
    starts, ends, hashes = map(np.concatenate, zip(*found))
    return hashes, starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of consecutive texts, and where each text's begin."""
    hashes, _, _, begins = word_spans(data, offsets, kind)
    return hashes, begins


def shingle_hashes(hashes: np.ndarray, begins: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the windows of ``size`` words of each text, in order, and where
    each text's windows begin. A text with fewer words has its whole sequence
    as one window; a text without words has none.
    """
    counts = np.diff(begins)
    windows = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    out_begins = np.concatenate([[0], np.cumsum(windows)])
    out = np.zeros(int(out_begins[-1]), np.uint64)
    n = len(hashes) - size + 1
    if n > 0:
        rolled = np.zeros(n, np.uint64)
        for i in range(size):
            rolled += hashes[i : i + n] * np.uint64(2 * (0x632BE59BD9B4E019 * (i + 1) >> 3 & 0x7FFFFFFFFFFFFFF) + 1)
        rolled = mix64(rolled + np.uint64(size))
        text_of = np.repeat(np.arange(len(counts)), counts)
        whole = text_of[:n] == text_of[size - 1 :]
        out[np.repeat(counts >= size, windows)] = rolled[whole]
    for t in np.flatnonzero((counts > 0) & (counts < size)):
        h = np.uint64(counts[t])
        for w in hashes[begins[t] : begins[t + 1]]:
            h = mix64(np.array([h ^ w], np.uint64) * _STEP)[0]
        out[out_begins[t]] = h
    return out, out_begins
