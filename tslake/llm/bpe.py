"""Byte-level BPE encoding and decoding over padded numpy matrices.

Distinct pre-tokens are bucketed by length into matrices of ids, a row each.
In every round each row merges its leftmost pair of minimum rank: the ranks of
adjacent pairs come from an open-addressing hash table, the row closes the gap,
the two neighbouring pairs are looked up anew and finished rows leave the
matrix. Pre-tokens beyond the largest bucket (``LONGEST`` bytes) are merged one
at a time with a heap, by the same order.

Defined results: null text counts as empty and gives no ids; a text is encoded
whole, special tokens' strings as ordinary text; rows are independent, so
repeated rows and ids stay; other columns are kept by ``encode``.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tslake.llm.common import held, row_blocks, share, text_buffer
from tslake.llm.pretokens import HashTable, PieceCodes, flatten, ragged, read_ranks

RANKS = "byte_bpe_50k.tiktoken"
BUCKETS = (2, 4, 6, 8, 10, 12, 16, 20, 24, 32, 48, 64, 96, 128, 192, 256)
LONGEST = BUCKETS[-1]
#: Ids in one matrix at most; bounds the temporary arrays.
CELLS = 400_000
NONE = np.int32(2**31 - 1)


class PairTable(HashTable):
    """(left id, right id) -> id of the merged token."""

    def __init__(self, tokens: list[bytes]):
        ids = {t: i for i, t in enumerate(tokens)}
        keys, merged = [], []
        for token, i in ids.items():
            for cut in range(1, len(token)):
                left, right = ids.get(token[:cut]), ids.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    merged.append(i)
        super().__init__(np.array(keys, np.int64), np.array(merged, np.int32), NONE)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged ids; NONE where the pair is no token or a side is padding (-1)."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        return self.look_up(np.where(right < 0, -1, keys))


class Vocabulary:
    """Tokens in rank order with what encoding and decoding look up."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.ids = {t: i for i, t in enumerate(tokens)}
        self.pairs = PairTable(tokens)
        self.byte_ids = np.array([self.ids[bytes([b])] for b in range(256)], np.int32)
        self.flat, self.offsets = flatten(tokens)

    def decode(self, ids: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of consecutive id sequences, and where each sequence's begin."""
        data, at = ragged(self.flat, self.offsets, ids)
        return data, at[begins]

    def encode_matrix(self, pieces: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids padded with -1, counts) of pieces of at most ``width`` bytes."""
        data, offsets = flatten(pieces)
        lengths = np.diff(offsets)
        ids = np.full((len(pieces), width), -1, np.int32)
        inside = np.arange(width) < lengths[:, None]
        ids[inside] = self.byte_ids[data]
        done, counts = ids.copy(), lengths.copy()
        rows = np.arange(len(pieces))
        rank = self.pairs.of(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(pieces), width - 1)
        while len(rows):
            j = rank.argmin(axis=1)
            best = rank[np.arange(len(rows)), j]
            over = best == NONE
            if over.any():
                done[rows[over], : ids.shape[1]] = ids[over]
                done[rows[over], ids.shape[1] :] = -1
                counts[rows[over]] = (ids[over] >= 0).sum(axis=1)
                rows, ids, rank, j, best = rows[~over], ids[~over], rank[~over], j[~over], best[~over]
                if not len(rows):
                    break
            at, width = np.arange(len(rows)), ids.shape[1]
            ids[at, j] = best
            after = np.arange(width - 1) > j[:, None]
            ids[:, :-1] = np.where(after, ids[:, 1:], ids[:, :-1])
            ids[:, -1] = np.where(j == width - 1, ids[:, -1], -1)
            right_of = np.arange(1, width - 1) > j[:, None]  # pairs right of the merged one move by one
            rank = np.where(right_of, rank[:, 1:], rank[:, :-1])
            ids = ids[:, :-1]
            if width == 2:
                rank = np.full((len(rows), 1), NONE, np.int32)
                ids = np.concatenate([ids, np.full((len(rows), 1), -1, np.int32)], axis=1)
                continue
            k = np.minimum(j, width - 3)
            has_right = j <= width - 3
            rank[at, k] = np.where(has_right, self.pairs.of(ids[at, k], ids[at, k + 1]), rank[at, k])
            left = j > 0
            if left.any():
                a, b = at[left], j[left]
                rank[a, b - 1] = self.pairs.of(ids[a, b - 1], ids[a, b])
        return done, counts

    def encode_long(self, piece: bytes) -> list[int]:
        """One piece of any length: a linked list and a heap of (rank, place)."""
        ids = [int(i) for i in self.byte_ids[np.frombuffer(piece, np.uint8)]]
        n = len(ids)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))

        def rank(i: int) -> int | None:
            j = right[i]
            return self.ids.get(self.tokens[ids[i]] + self.tokens[ids[j]]) if j < n else None

        heap = [(r, i) for i in range(n) if (r := rank(i)) is not None]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            r, i = heapq.heappop(heap)
            if not alive[i] or rank(i) != r:
                continue
            j = right[i]
            ids[i], alive[j], right[i] = r, False, right[j]
            if right[i] < n:
                left[right[i]] = i
            for k in (left[i], i):
                if k >= 0 and (r := rank(k)) is not None:
                    heapq.heappush(heap, (r, k))
        return [x for x, a in zip(ids, alive) if a]

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one after another, and their offsets."""
        lengths = np.array([len(p) for p in pieces], np.int64)
        counts = np.ones(len(pieces), np.int64)
        whole = np.array([self.ids.get(p, -1) for p in pieces], np.int64)  # a piece that is a token stays whole
        open_ = np.flatnonzero(whole < 0)
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        below = 1
        for width in BUCKETS:
            rows = open_[(lengths[open_] > below) & (lengths[open_] <= width)]
            below = width
            step = max(1, CELLS // width)
            for lo in range(0, len(rows), step):
                some = rows[lo : lo + step]
                matrix, n = self.encode_matrix([pieces[i] for i in some], width)
                counts[some] = n
                parts.append((some, matrix[matrix >= 0]))
        for i in open_[lengths[open_] > LONGEST]:
            ids = self.encode_long(pieces[i])
            counts[i] = len(ids)
            parts.append((np.array([i]), np.array(ids, np.int32)))
        offsets = np.zeros(len(pieces) + 1, np.int64)
        np.cumsum(counts, out=offsets[1:])
        flat = np.zeros(offsets[-1], np.int32)
        known = whole >= 0
        flat[offsets[:-1][known]] = whole[known]
        for rows, ids in parts:
            n = counts[rows]
            begin = np.cumsum(n) - n
            flat[np.arange(len(ids)) + np.repeat(offsets[rows] - begin, n)] = ids
        return flat, offsets


class Encoder(PieceCodes):
    def __init__(self, vocabulary: Vocabulary, pattern: str):
        super().__init__(regex.compile(pattern).findall)
        self.vocabulary = vocabulary
        self.clear()

    def clear(self) -> None:
        self.flat, self.offsets = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def add(self, pieces: list[str]) -> None:
        flat, offsets = self.vocabulary.encode_pieces([p.encode() for p in pieces])
        self.flat = np.concatenate([self.flat, flat])
        self.offsets = np.concatenate([self.offsets, offsets[1:] + self.offsets[-1]])
        self.number(pieces)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts one after another, and where each text's begin."""
        codes, begins = self.of(texts)
        ids, at = ragged(self.flat, self.offsets, codes)
        return ids, at[begins]


def vocabulary(path: str | None = None) -> Vocabulary:
    return Vocabulary(read_ranks(path or public_tokenizers.path(RANKS)))


def _texts(column: pa.Array) -> Iterator[list[str]]:
    _, offsets = text_buffer(column)
    for lo, hi in row_blocks(offsets):
        yield [t or "" for t in column.slice(lo, hi - lo).to_pylist()]


def encode(docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with a column ``out`` (array of int) of the ids of its whole texts.

    A column of that name is replaced. The vocabulary (bounded by its file) is
    built once and broadcast.
    """
    shared = share(docs.sparkSession, vocabulary(path))
    kept = [c for c in docs.columns if c != out]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(out, T.ArrayType(T.IntegerType(), False), False)])
    at = kept.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(held(shared), pattern)
        for batch in batches:
            lo = 0
            for texts in _texts(batch.column(at)):
                ids, begins = encoder.encode(texts)
                lists = pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(ids, pa.int32()))
                rows = batch.slice(lo, len(texts))
                yield pa.RecordBatch.from_arrays([*rows.columns, lists], names=[*kept, out])
                lo += len(texts)

    return docs.select(*kept).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str | None = None, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with a column ``out`` (binary) of the bytes its ids stand for; null ids give none."""
    shared = share(encoded.sparkSession, vocabulary(path))
    kept = [c for c in encoded.columns if c != out]
    schema = T.StructType([encoded.schema[c] for c in kept] + [T.StructField(out, T.BinaryType(), False)])
    at = kept.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.array(x or [], np.int64) for x in batch.column(at).to_pylist()]
            texts = [held(shared).decode(r, np.array([0, len(r)]))[0].tobytes() for r in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], names=[*kept, out])

    return encoded.select(*kept).mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text.

    Encodes, decodes the ids and digests both in one pass, so that neither ids
    nor bytes leave the task. Null text counts as empty, null doc_id stays null.
    """
    shared = share(docs.sparkSession, vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(held(shared), pattern)
        decimal, decimal_at = flatten([b"%d " % i for i in range(len(encoder.vocabulary.tokens))])
        for batch in batches:
            lo = 0
            for texts in _texts(batch.column(1)):
                ids, begins = encoder.encode(texts)
                written, at = ragged(decimal, decimal_at, ids)
                decoded, decoded_at = encoder.vocabulary.decode(ids, begins)
                at = at[begins]
                spans = list(zip(at[:-1], np.maximum(at[:-1], at[1:] - 1)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, len(texts)),
                        pa.array(np.diff(begins)),
                        pa.array([hashlib.sha256(written[a:b]).hexdigest() for a, b in spans]),
                        pa.array([hashlib.sha256(decoded[a:b]).hexdigest() for a, b in zip(decoded_at[:-1], decoded_at[1:])]),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )
                lo += len(texts)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
