"""Token ids in Arrow files of fixed-size lists.

Documents in ascending order of doc_id are encoded, ended by ``END`` and laid
one after another into sequences of ``SEQUENCE`` ids with a mask of the same
length; record batches hold ``BATCH`` sequences as fixed-size lists, so sequence
``i`` of a file lies at a computable place of the mapped file. Only a file's last
sequence is padded (mask false). A document never spans files; each file's
schema metadata lists its documents and their lengths.

Documents are dealt out by ranges of doc_id (then of the text's hash and the
row's number, which spread a doc_id that many rows share); a partition's first id is the sum of the
partitions before it, of which one number each comes to the driver.

Defined results: null text counts as empty and still gets the end id; a null
doc_id comes first; rows of equal doc_id follow one another in the order of
their texts' hashes; an empty table writes no file.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from tslake.llm import files
from tslake.llm.common import equal_spans, held, lowered, row_blocks, share, text_buffer, word_spans
from tslake.llm.pretokens import ragged
from tslake.session import work_dir

TOKENIZER = "word_bpe_49k.json"
END = 2
SEQUENCE = 2048
BATCH = 256
#: Ids after which a task starts its next file.
FILE_IDS = 4 << 20
#: Distinct pieces a worker keeps the ids of, some 60 bytes each.
POOL_LIMIT = 1_500_000
ID = np.uint16  # the vocabulary has 49,408 ids

MANIFEST = "path string, part int, part_start long, n_ids long, n_docs long"


#: What stands between blanks and line ends.
_PIECE = np.ones(256, bool)
_PIECE[[0x20, 0x0A]] = False
#: ASCII letters, and punctuation but for the apostrophe, as bytes.
_LETTER, _MARK = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_MARK[0x21:0x30] = _MARK[0x3A:0x41] = _MARK[0x5B:0x61] = _MARK[0x7B:0x7F] = True
_MARK[0x27] = False
#: Pieces that normaliser and pre-tokeniser leave as they are.
_PLAIN = re.compile("[a-zß-öø-ÿ]+").fullmatch


def mark_runs(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where a run of punctuation begins that follows a letter and ends its
    piece: such a run is a pre-token of its own."""
    mark = _MARK[data]
    change = np.flatnonzero(mark[1:] != mark[:-1]) + 1
    edges = np.concatenate([[0], change, [len(data)]]) if len(data) else np.zeros(0, np.int64)
    runs = np.flatnonzero(mark[edges[:-1]]) if len(data) else edges
    begin, end = edges[runs], edges[runs + 1] if len(runs) else edges[:0]
    ended = np.append(~_PIECE[data], True)[end]
    ended |= np.isin(end, offsets)
    after_letter = _LETTER[data[np.maximum(begin - 1, 0)]] & (begin > 0)
    return begin[ended & after_letter]


class Encoder:
    """The library's ids of whole texts.

    The tokenizer treats separately what stands between blanks or line ends (and
    a last run of punctuation there), and letters' case is lost. Added tokens
    that a text spells out get their ids and part it, as in the library. So each
    distinct piece of what is left, found by a 64-bit hash of its lower-cased
    bytes and then compared with them, goes to the library once while the pool
    of pieces holds it. Pieces of plain letters go, many in one text, to a copy of the tokenizer
    that splits at blanks and lacks the steps that would not alter them; a token
    with the vocabulary's word-end suffix ends each of them.
    """

    def __init__(self, definition: str, pool_limit: int = POOL_LIMIT):
        self.definition, self.pool_limit = definition, pool_limit
        self.full, self.plain = Tokenizer.from_str(definition), Tokenizer.from_str(definition)
        self.plain.normalizer = None
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        # pieces hold added tokens only as lower-cased look-alikes
        self.full.encode_special_tokens = self.plain.encode_special_tokens = True
        added = self.full.get_added_tokens_decoder()
        if any(t.single_word or t.lstrip or t.rstrip or t.normalized for t in added.values()):
            raise ValueError("an added token that does more than stand for itself")
        self.added = {t.content.encode(): i for i, t in added.items()}
        self.find_added = re.compile(b"|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) or b"(?!)").finditer
        suffix, known = self.plain.model.end_of_word_suffix, self.plain.get_vocab()
        self.ends_word = np.zeros(max(known.values()) + 1, bool)
        self.ends_word[[i for token, i in known.items() if token.endswith(suffix)]] = True
        self.clear()

    def __reduce__(self):
        return type(self), (self.definition, self.pool_limit)

    def clear(self) -> None:
        self.known, self.rows = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.flat, self.offsets = np.zeros(0, ID), np.zeros(1, np.int64)
        self.texts, self.ends = b"", np.zeros(1, np.int64)  # the pooled pieces, by row

    def _encode(self, tokenizer: Tokenizer, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [np.array(e.ids, ID) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate(found), np.array([len(x) for x in found])

    def _add(self, hashes: np.ndarray, found: list[bytes]) -> None:
        """Encode new pieces and put them into the pool."""
        pieces = [p.decode() for p in found]
        plain, other = [], []
        for i, piece in enumerate(pieces):
            (plain if _PLAIN(piece) else other).append(i)
        flats, lengths = [self.flat], []
        for lo in range(0, len(plain), 200):
            some = plain[lo : lo + 200]
            ids, _ = self._encode(self.plain, [" ".join([pieces[i] for i in some])])
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) != len(some):
                raise ValueError("the tokenizer's words do not end with its suffix")
            flats.append(ids)
            lengths.append(np.diff(ends, prepend=0))
        for lo in range(0, len(other), 2000):
            ids, n = self._encode(self.full, [pieces[i] for i in other[lo : lo + 2000]])
            flats.append(ids)
            lengths.append(n)
        self.flat = np.concatenate(flats)
        rows = np.arange(len(pieces)) + len(self.offsets) - 1
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(np.concatenate(lengths))])
        kept = [found[i] for i in plain + other]
        self.texts += b"".join(kept)
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum([len(p) for p in kept])])
        order = np.argsort(hashes[plain + other])
        added = hashes[plain + other][order]
        place = np.searchsorted(self.known, added)
        self.known, self.rows = np.insert(self.known, place, added), np.insert(self.rows, place, rows[order])

    def _cut(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The bytes without added tokens, where in them a text or what follows
        such a token begins, the id that comes before each of these places, and
        which of them are the texts'."""
        found = np.array([(m.start(), m.end(), self.added[m.group()]) for m in self.find_added(data.tobytes())], np.int64).reshape(-1, 3)
        # what two texts spell together is no token
        found = found[np.searchsorted(offsets, found[:, 0], "right") == np.searchsorted(offsets, found[:, 1], "left")]
        if not len(found):
            return data, offsets, np.full(len(offsets), END, ID), np.arange(len(offsets))
        begin, end, token = found.T
        change = np.zeros(len(data) + 1, np.int64)
        change[begin] += 1
        change[end] -= 1
        gone = np.cumsum(change[:-1]) > 0
        before = np.concatenate([[0], np.cumsum(gone)])
        places = np.concatenate([offsets, begin])
        order = np.argsort(places, kind="stable")  # a text begins before a token at its first byte
        values = np.concatenate([np.full(len(offsets), END), token]).astype(ID)
        return data[~gone], (places - before[places])[order], values[order], np.flatnonzero(order < len(offsets))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts, each ended by END, and where each text's begin."""
        data, places, before, texts = self._cut(data, offsets)
        ids, at = self._pooled(data, places)
        return np.insert(ids, at[1:], before[1:]), (at + np.arange(len(at)))[texts]

    def _pooled(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts without added tokens, and where each text's begin."""
        if len(self.known) > self.pool_limit:
            self.clear()
        hashes, starts, ends, begins = word_spans(data, offsets, _PIECE, mark_runs(data, offsets))
        if not len(hashes):
            return np.zeros(0, ID), begins
        distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), bool)
        if len(self.known):
            new = self.known[np.minimum(place, len(self.known) - 1)] != distinct
        lower = lowered(data)
        if new.any():
            self._add(distinct[new], [lower[a:b] for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist())])
            place = np.searchsorted(self.known, distinct)
        rows = self.rows[place][which]
        # a hash only proposes a pooled piece; its bytes decide
        odd = np.flatnonzero(~equal_spans(lower, starts, ends, self.texts + bytes(8), self.ends[rows], self.ends[rows + 1]))
        if not len(odd):
            ids, at = ragged(self.flat, self.offsets, rows)
            return ids, at[begins]
        more, n = self._encode(self.full, [lower[a:b].decode() for a, b in zip(starts[odd].tolist(), ends[odd].tolist())])
        rows[odd] = len(self.offsets) - 1 + np.arange(len(odd))
        ids, at = ragged(np.concatenate([self.flat, more]), np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(n)]), rows)
        return ids, at[begins]


# ----------------------------------------------------------------- file format


def file_bytes(ids: np.ndarray, doc_ids: pa.Array, lengths: np.ndarray, sequence: int = SEQUENCE) -> pa.Buffer:
    """One file: ``ids`` cut into sequences, with the documents they hold."""
    n = -(-len(ids) // sequence)
    padded = np.zeros(n * sequence, ids.dtype)
    padded[: len(ids)] = ids
    mask = np.arange(n * sequence) < len(ids)
    documents = pa.RecordBatch.from_arrays([doc_ids.cast(pa.int64()), pa.array(lengths, pa.int64())], names=["doc_id", "n_ids"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, documents.schema) as out:
        out.write_batch(documents)
    schema = pa.schema(
        [pa.field("ids", pa.list_(pa.from_numpy_dtype(ids.dtype), sequence), False), pa.field("mask", pa.list_(pa.bool_(), sequence), False)],
        metadata={"documents": sink.getvalue().to_pybytes(), "n_ids": str(len(ids))},
    )
    sink = pa.BufferOutputStream()
    with pa.ipc.new_file(sink, schema) as out:
        for lo in range(0, n, BATCH):
            part = slice(lo * sequence, min(n, lo + BATCH) * sequence)
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(x[part]), sequence) for x in (padded, mask)]
            out.write_batch(pa.RecordBatch.from_arrays(lists, schema=schema))
    return sink.getvalue()


class TokenFile:
    """Random access to a file's sequences. Ids and masks are views of the mapped
    (or held) file; only the batch that is asked for is touched."""

    def __init__(self, source):
        self.reader = pa.ipc.open_file(source)
        self.sequence = self.reader.schema.field("ids").type.list_size
        meta = self.reader.schema.metadata
        self.n_ids = int(meta[b"n_ids"])
        documents = pa.ipc.open_stream(meta[b"documents"]).read_all()
        self.doc_ids, self.lengths = documents.column(0).combine_chunks(), documents.column(1).to_numpy()

    def __len__(self) -> int:
        return -(-self.n_ids // self.sequence)

    def __getitem__(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """(ids, mask) of sequence ``i``, both without copying; the mask stays
        packed in bits."""
        batch, row = self.reader.get_batch(i // BATCH), i % BATCH
        ids, mask = (batch.column(k).flatten().slice(row * self.sequence, self.sequence) for k in (0, 1))
        return ids.to_numpy(), mask

    def pieces(self, start: int, end: int) -> Iterator[np.ndarray]:
        """The ids ``start`` to ``end`` as views, one for each batch they touch."""
        step = BATCH * self.sequence
        while start < end:
            stop = min(end, start - start % step + step)
            yield self.reader.get_batch(start // step).column(0).flatten().slice(start % step, stop - start).to_numpy()
            start = stop

    def ids(self) -> np.ndarray:
        """All unmasked ids in order, copied together."""
        return np.concatenate([np.zeros(0, ID), *self.pieces(0, self.n_ids)])


# ------------------------------------------------------------------------ Spark


def write(docs: DataFrame, folder: str, path: str | None = None, file_ids: int = FILE_IDS) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into files of ``folder``; returns their
    manifest (written once, beside them)."""
    spark = docs.sparkSession
    with open(path or public_tokenizers.path(TOKENIZER), encoding="utf-8") as source:
        shared = share(spark, Encoder(source.read()))
    settings = files.store_settings(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = held(shared)
        part, k, start, parts, doc_ids, lengths = TaskContext.get().partitionId(), 0, 0, [], [], []

        def file() -> pa.RecordBatch:
            ids, n = np.concatenate(parts), np.concatenate(lengths)
            place = files.write(folder, f"part-{part:05d}-{k:05d}", ".arrow", file_bytes(ids, pa.concat_arrays(doc_ids), n), settings)
            return pa.RecordBatch.from_pydict({"path": [place], "part": pa.array([part], pa.int32()), "part_start": [start], "n_ids": [len(ids)], "n_docs": [len(n)]})

        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            for lo, hi in row_blocks(offsets):
                ids, begins = encoder.encode(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                parts.append(ids)
                doc_ids.append(batch.column(0).slice(lo, hi - lo))
                lengths.append(np.diff(begins))
                if sum(map(len, parts)) >= file_ids:
                    yield file()
                    k, start, parts, doc_ids, lengths = k + 1, start + sum(map(len, parts)), [], [], []
        if parts:
            yield file()

    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # the row's number keeps rows that repeat one text under one doc_id from landing in one range
    order = [F.col("doc_id").asc_nulls_first(), F.col("h").asc(), F.col("row").asc()]
    ranged = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("row")).repartitionByRange(n, *order)
    return files.settled(spark, ranged.sortWithinPartitions(*order).select("doc_id", "text").mapInArrow(run, MANIFEST), "token-manifest")


def read(manifest: DataFrame) -> DataFrame:
    """Per document, from the files alone: doc_id, start, n_tokens, ids_crc32."""
    spark = manifest.sparkSession
    settings = files.store_settings(spark)
    at, base = 0, {}
    for row in manifest.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect():  # one row per write task
        base[row["part"]], at = at, at + row["n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, part, part_start in zip(*(batch.column(i).to_pylist() for i in range(3))):
                with files.open_input(path, settings) as source:
                    stored = TokenFile(source)
                    ends = np.cumsum(stored.lengths)
                    starts = ends - stored.lengths
                    digests = []
                    for a, b in zip(starts.tolist(), ends.tolist()):
                        digest = 0
                        for ids in stored.pieces(a, b):
                            digest = zlib.crc32(ids.astype("<u4"), digest)
                        digests.append(digest)
                yield pa.RecordBatch.from_arrays(
                    [stored.doc_ids, pa.array(starts + (base[part] + part_start)), pa.array(stored.lengths), pa.array(digests, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return files.spread(spark, manifest.select("path", "part", "part_start")).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame) -> DataFrame:
    return read(write(docs, work_dir(docs.sparkSession, "tokens")))
