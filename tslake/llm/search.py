"""Ranked lexical search with a Block-Max MaxScore index.

``index`` turns documents into shards, a file each: the documents in ascending
order of length, the shard's terms, and for every term its postings (document,
occurrences) in blocks of ``BLOCK``, packed to as few bytes as the block needs.
Spark's rows hold the files' paths only: no shard passes the JVM, and a task holds
one at a time.
A block's head tells its last document, its most occurrences and its shortest
document, which bound the score of any posting in it; the bound of a list is the
largest of its blocks'. As lengths stand in order, neighbouring documents are
alike and the bounds tight. An index says nothing about the whole corpus, so
shards can be added; their number of documents and of terms and the frequencies
of a query's terms are added up when it is searched.

``search`` takes every item through every shard by MaxScore: lists are ordered
by their bounds, and the longest prefix whose bounds add up to less than the
item's tenth best score so far is non-essential. Only documents of the other
lists are candidates. They are scored there; then the non-essential lists
are taken from the highest bound down, and a candidate is dropped as soon as its
score with the bounds of the blocks that could hold it cannot reach that tenth
best, before any of these blocks is unpacked. A task keeps its best documents of
an item over all its shards; the tasks' heaps are merged by Spark.

Scores are whole numbers, as the contract has them, and equal scores rank by
ascending doc_id. Terms are known by hashes and compared as bytes. Items come in
blocks of bounded size; a block's terms and the frequencies of these are all that
the driver sees. Defined results: null text or one without terms holds nothing
and is found by no item; an item without terms, or whose terms no document has,
gives no row; rows that repeat a document or an item are ranked one by one; a
null doc_id ranks behind its equals; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tslake.llm import files
from tslake.llm.common import ALNUM, LOWER_BYTES, equal_spans, hash_spans, held, lowered, row_blocks, share, text_buffer, word_spans
from tslake.session import work_dir

TOP = 10
BLOCK = 128
#: Bytes of text and documents of a shard at most; a longer text is a shard of its own.
SHARD_BYTES, SHARD_DOCS = 4 << 20, 1 << 16
#: Shards of a search task, if all cores have one; the later ones profit from its best documents so far.
TASK_SHARDS = 8
#: Different terms in a block of items.
BLOCK_TERMS = 100_000
WIDTHS = (1, 2, 4)

#: What a shard's file holds: arrays as bytes.
ARRAYS = {
    "doc_ids": np.int64,
    "null_ids": np.bool_,
    "sizes": np.int64,  # terms of each document
    "hashes": np.uint64,  # of the shard's terms, ascending
    "term_ends": np.int64,  # in ``terms``
    "terms": np.uint8,
    "frequencies": np.int32,  # documents of each term
    "block_ends": np.int64,  # blocks of each term and those before it
    "last": np.int32,  # a block's last document,
    "most": np.int32,  # most occurrences
    "shortest": np.int64,  # and fewest terms of a document
    "widths": np.uint8,  # bytes of a document and of an occurrence number
    "places": np.int64,  # where its postings begin,
    "postings": np.uint8,
}
#: A shard's row: its numbers of documents with terms and of terms, and its file.
INDEX = "n_docs long, n_terms long, path string"


def impact(occurrences: np.ndarray, sizes: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a term's weight is multiplied by, for its occurrences in documents of ``sizes`` terms."""
    m = 100 - 75 + (75 * sizes * n_docs) // n_terms
    return (1_000_000_000 * occurrences) // (1000 * occurrences + 8 * m)


def weight(n_docs: int, frequency: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * frequency + 1)))


# ---------------------------------------------------------------------- a shard


def _term_numbers(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """(term of each word, where each text's words begin, hashes and bytes of
    the terms, in ascending order of hashes)."""
    hashes, starts, ends, begins = word_spans(data, offsets, ALNUM)
    distinct, first, number = np.unique(hashes, return_index=True, return_inverse=True)
    lower = lowered(data)
    texts = [lower[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
    odd = np.flatnonzero(~equal_spans(lower, starts, ends, lower, starts[first[number]], ends[first[number]]))
    if len(odd):  # terms that share another one's hash
        others: dict[bytes, int] = {}
        for i in odd.tolist():
            number[i] = others.setdefault(lower[starts[i] : ends[i]], len(texts) + len(others))
        distinct = np.concatenate([distinct, hash_spans(b"".join(others) + bytes(8), *_spans(others))])
        texts += others
        order = np.argsort(distinct, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        number, distinct, texts = place[number], distinct[order], [texts[i] for i in order.tolist()]
    return number, begins, distinct, texts


def _spans(texts) -> tuple[np.ndarray, np.ndarray]:
    ends = np.cumsum([len(t) for t in texts])
    return np.append(0, ends[:-1]), ends


def _width(most: np.ndarray) -> np.ndarray:
    return np.searchsorted(np.array([1 << 8, 1 << 16]), most, "right")


def build(doc_ids: np.ndarray, null_ids: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The arrays of a shard."""
    number, begins, hashes, texts = _term_numbers(data, offsets)
    sizes = np.diff(begins)
    order = np.argsort(sizes, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    sizes = sizes[order]
    # postings by term, then document
    pairs, occurrences = np.unique(number.astype(np.int64) << 32 | np.repeat(rank, np.diff(begins)), return_counts=True)
    term, doc = pairs >> 32, pairs & 0xFFFFFFFF
    frequencies = np.bincount(term, minlength=len(hashes))
    first = np.cumsum(frequencies) - frequencies
    blocks = -(-frequencies // BLOCK)
    block_ends = np.cumsum(blocks)
    of = np.repeat(np.arange(len(hashes)), blocks)
    start = first[of] + (np.arange(len(of)) - (block_ends - blocks)[of]) * BLOCK
    length = np.diff(np.append(start, len(term)))
    out = {"doc_ids": doc_ids[order], "null_ids": null_ids[order], "sizes": sizes, "hashes": hashes, "frequencies": frequencies, "block_ends": block_ends}
    out |= {"term_ends": np.cumsum([len(t) for t in texts]), "terms": np.frombuffer(b"".join(texts), np.uint8)}
    if len(of):
        # the step from the block's document before, or from its list's first
        step = np.diff(doc, prepend=0)
        step[start] = doc[start]
        out["last"], out["most"], out["shortest"] = doc[start + length - 1], np.maximum.reduceat(occurrences, start), sizes[doc[start]]
        wide = _width(np.maximum.reduceat(step, start)), _width(out["most"])
        out["widths"] = wide[0] | wide[1] << 4
        bytes_of = np.array(WIDTHS)
        places = np.cumsum(length * (bytes_of[wide[0]] + bytes_of[wide[1]]))
        out["places"] = np.append(0, places[:-1])
        packed = np.zeros(int(places[-1]), np.uint8)
        block = np.repeat(np.arange(len(of)), length)
        place = np.arange(len(term)) - start[block]
        for values, kind, begin in ((step, wide[0], out["places"]), (occurrences, wide[1], out["places"] + length * bytes_of[wide[0]])):
            for k, width in enumerate(WIDTHS):
                some = np.flatnonzero(kind[block] == k)
                at = begin[block[some]] + place[some] * width
                for byte in range(width):
                    packed[at + byte] = values[some] >> 8 * byte & 255
        out["postings"] = packed
    return {name: np.ascontiguousarray(out.get(name, np.zeros(0)), kind) for name, kind in ARRAYS.items()}


class Shard:
    """A shard's arrays, for search."""

    def __init__(self, **arrays: np.ndarray):
        self.__dict__.update(arrays)

    def find(self, hashes: np.ndarray, texts: list[bytes]) -> dict[int, int]:
        """Which of some terms the shard has, and as which of its own."""
        out = {}
        left, right = (np.searchsorted(self.hashes, hashes, side) for side in ("left", "right"))
        for n in np.flatnonzero(left < right).tolist():
            for at in range(left[n], right[n]):
                if self.terms[self.term_ends[at - 1] if at else 0 : self.term_ends[at]].tobytes() == texts[n]:
                    out[n] = at
        return out

    def blocks(self, term: int) -> tuple[int, int]:
        return (int(self.block_ends[term - 1]) if term else 0), int(self.block_ends[term])

    def unpack(self, term: int, block: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, occurrences) of a block."""
        lo, hi = self.blocks(term)
        n = int(self.frequencies[term]) - (hi - 1 - lo) * BLOCK if block == hi - 1 else BLOCK
        wide = WIDTHS[self.widths[block] & 15], WIDTHS[self.widths[block] >> 4]
        at = int(self.places[block])
        step = np.frombuffer(self.postings, f"<u{wide[0]}", n, at)
        return np.cumsum(step, dtype=np.int64), np.frombuffer(self.postings, f"<u{wide[1]}", n, at + n * wide[0]).astype(np.int64)


def file_bytes(arrays: dict[str, np.ndarray]) -> pa.Buffer:
    """A shard's file: an Arrow file of one row, compressed column by column."""
    row = pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.large_binary()) for a in arrays.values()], names=[*arrays])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_file(sink, row.schema, options=pa.ipc.IpcWriteOptions(compression="zstd", use_threads=False)) as out:
        out.write_batch(row)
    return sink.getvalue()


def read(path: str, settings: dict[str, str] | None = None, names: tuple[str, ...] = tuple(ARRAYS)) -> Shard:
    """The shard of a file, with the arrays named."""
    options = pa.ipc.IpcReadOptions(use_threads=False, included_fields=[list(ARRAYS).index(name) for name in names])
    with files.open_input(path, settings) as source:
        row = pa.ipc.open_file(source, options=options).get_batch(0)
    return Shard(**{name: np.frombuffer(row.column(name)[0].as_buffer(), ARRAYS[name]) for name in names})


# --------------------------------------------------------------------- searching


class List:
    """A query term's postings in a shard: their weight and bounds."""

    def __init__(self, shard: Shard, term: int, weight: int, n_docs: int, n_terms: int):
        self.shard, self.term, self.weight = shard, term, weight
        self.first, end = shard.blocks(term)
        self.last = shard.last[self.first : end]
        self.bounds = weight * impact(shard.most[self.first : end].astype(np.int64), shard.shortest[self.first : end], n_docs, n_terms)
        self.bound = int(self.bounds.max())
        self.n_docs, self.n_terms = n_docs, n_terms

    def scored(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(documents, what the term adds to their scores) of some blocks."""
        found = [self.shard.unpack(self.term, self.first + b) for b in blocks.tolist()]
        docs, occurrences = (np.concatenate([f[k] for f in found]) for k in (0, 1))
        return docs, self.weight * impact(occurrences, self.shard.sizes[docs], self.n_docs, self.n_terms)


def best(lists: list[List], least: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of a shard, none left out whose score is ``least`` or more and above 0."""
    lists = sorted(lists, key=lambda x: x.bound)
    total, essential = 0, 0
    while essential < len(lists) and total + lists[essential].bound < least:
        total += lists[essential].bound
        essential += 1
    if essential == len(lists):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    found = [x.scored(np.arange(len(x.last))) for x in lists[essential:]]
    docs, which = np.unique(np.concatenate([d for d, _ in found]), return_inverse=True)
    scores = np.zeros(len(docs), np.int64)
    np.add.at(scores, which, np.concatenate([s for _, s in found]))
    for k in range(essential - 1, -1, -1):
        # the block of every list left that could hold the document
        blocks = [np.searchsorted(x.last, docs) for x in lists[: k + 1]]
        rest = sum(np.append(x.bounds, 0)[b] for x, b in zip(lists, blocks))
        keep = scores + rest >= least
        docs, scores, block = docs[keep], scores[keep], blocks[k][keep]
        if not len(docs):
            break
        block = np.unique(block[block < len(lists[k].last)])
        if len(block):
            held_docs, more = lists[k].scored(block)
            at = np.minimum(np.searchsorted(held_docs, docs), len(held_docs) - 1)
            scores = scores + np.where(held_docs[at] == docs, more[at], 0)
    keep = scores >= max(1, least)
    return docs[keep], scores[keep]


class Heap:
    """An item's best documents so far, best first."""

    def __init__(self):
        self.rows = np.zeros((0, 3), np.int64)  # score, whether doc_id is null, doc_id

    def least(self, top: int) -> int:
        """The score that a document needs to be among them."""
        return int(self.rows[top - 1, 0]) if len(self.rows) >= top else 0

    def add(self, scores: np.ndarray, null: np.ndarray, doc_ids: np.ndarray, top: int) -> None:
        rows = np.concatenate([self.rows, np.stack([scores, null.astype(np.int64), doc_ids], axis=1)])
        self.rows = rows[np.lexsort((rows[:, 2], rows[:, 1], -rows[:, 0]))[:top]]


# ------------------------------------------------------------------------- Spark


def index(docs: DataFrame, shard_bytes: int = SHARD_BYTES, shard_docs: int = SHARD_DOCS, folder: str | None = None) -> DataFrame:
    """Shards over all of ``docs`` (doc_id, text), written to files of ``folder``
    where the documents are read; a row each. Evaluated again, it writes them
    again: settle it before it is searched."""
    spark = docs.sparkSession
    folder, settings = folder or work_dir(spark, "search-shards"), files.store_settings(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k, parts, size, rows = TaskContext.get().partitionId(), 0, [], 0, 0

        def shard() -> pa.RecordBatch:
            ids = pa.concat_arrays([p[0] for p in parts])
            data = np.concatenate([p[1] for p in parts])
            lengths = np.concatenate([np.diff(p[2]) for p in parts])
            made = build(ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), data, np.append(0, np.cumsum(lengths)))
            path = files.write(folder, f"part-{part:05d}-{k:05d}", ".arrow", file_bytes(made), settings)
            return pa.RecordBatch.from_pydict({"n_docs": [int((made["sizes"] > 0).sum())], "n_terms": [int(made["sizes"].sum())], "path": [path]})

        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            for lo, hi in row_blocks(offsets):
                parts.append((batch.column(0).slice(lo, hi - lo), data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]))
                size, rows = size + len(parts[-1][1]), rows + hi - lo
                if size >= shard_bytes or rows >= shard_docs:
                    yield shard()
                    k, parts, size, rows = k + 1, [], 0, 0
        if parts:
            yield shard()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, INDEX)


class Queries:
    """A block of items: their terms, numbered over the block."""

    def __init__(self, items: list[tuple[int | None, bytes]]):
        self.items = [item_id for item_id, _ in items]
        numbers: dict[bytes, int] = {}
        self.terms = [Counter(numbers.setdefault(t, len(numbers)) for t in terms(text)) for _, text in items]
        self.texts = list(numbers)
        self.hashes = hash_spans(b"".join(self.texts) + bytes(8), *_spans(self.texts)) if numbers else np.zeros(0, np.uint64)
        self.weights: list[int] = []


def terms(text: bytes) -> list[bytes]:
    kept = text.translate(LOWER_BYTES)
    data = np.frombuffer(kept, np.uint8)
    _, starts, ends, _ = word_spans(data, np.array([0, len(data)]), ALNUM)
    return [kept[a:b] for a, b in zip(starts.tolist(), ends.tolist())]


def blocks(items: DataFrame, block_terms: int = BLOCK_TERMS) -> Iterator[Queries]:
    """The items in blocks of bounded size."""
    kept, size = [], 0
    for row in items.select("item_id", "text").toLocalIterator():
        text = (row["text"] or "").encode()
        if kept and size + len(text) // 2 + 1 > block_terms:
            yield Queries(kept)
            kept, size = [], 0
        kept.append((row["item_id"], text))
        size += len(text) // 2 + 1  # so many terms at most
    if kept:
        yield Queries(kept)


def _frequencies(paths: DataFrame, queries: Queries) -> list[int]:
    """How many documents of the shards hold each term of the queries."""
    spark = paths.sparkSession
    settings = files.store_settings(spark)
    shared = share(spark, (queries.hashes, queries.texts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, texts = held(shared)
        total = np.zeros(len(texts), np.int64)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                shard = read(path, settings, ("hashes", "term_ends", "terms", "frequencies"))
                for n, at in shard.find(hashes, texts).items():
                    total[n] += shard.frequencies[at]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "n"])

    found = paths.mapInArrow(run, "term long, n long")
    out = [0] * len(queries.texts)
    for row in found.groupBy("term").agg(F.sum("n").alias("n")).collect():  # BLOCK_TERMS rows at most
        out[row["term"]] = row["n"]
    return out


FOUND = "item long, item_id long, score long, null_id boolean, doc_id long"


def search(shards: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``top`` documents of the index."""
    spark, out = shards.sparkSession, None
    n_docs, n_terms, n_shards = shards.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0)), F.count(F.lit(1))).first()
    settings = files.store_settings(spark)
    paths = shards.select("path").repartition(max(spark.sparkContext.defaultParallelism, -(-n_shards // TASK_SHARDS)))
    for queries in blocks(items, block_terms) if n_docs else ():
        queries.weights = [weight(n_docs, n) if n else 0 for n in _frequencies(paths, queries)]
        shared = share(spark, queries)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            queries = held(shared)
            heaps = [Heap() for _ in queries.items]
            for batch in batches:
                for path in batch.column(0).to_pylist():
                    shard = read(path, settings)
                    place = shard.find(queries.hashes, queries.texts)
                    for heap, counted in zip(heaps, queries.terms):
                        lists = [List(shard, place[n], times * queries.weights[n], n_docs, n_terms) for n, times in counted.items() if n in place and queries.weights[n] > 0]
                        if lists:
                            docs, scores = best(lists, heap.least(top))
                            if len(docs):
                                heap.add(scores, shard.null_ids[docs], shard.doc_ids[docs], top)
            for n, (item_id, heap) in enumerate(zip(queries.items, heaps)):
                k = len(heap.rows)
                null = heap.rows[:, 1].astype(bool)
                columns = [pa.array([n] * k, pa.int64()), pa.array([item_id] * k, pa.int64()), pa.array(heap.rows[:, 0]), pa.array(null), pa.array(heap.rows[:, 2], mask=null)]
                yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in FOUND.split(", ")])

        found = paths.mapInArrow(run, FOUND)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc("null_id"), F.asc("doc_id"))
        merged = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
        part = files.settled(spark, merged.select("item_id", "rank", "doc_id", "score"), "search-block")
        shared.unpersist()
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if out is None else out


def report(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """Index ``docs`` and rank them for each of ``items``."""
    spark = docs.sparkSession
    return search(files.settled(spark, index(docs), "search-index"), items.select(F.col("item_id").cast("long").alias("item_id"), "text"), top)


_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS ts FROM documents),
i AS (SELECT row_number() OVER () AS iid, item_id, {_TERMS} AS ts FROM benchmark),
total AS (SELECT count(*)::BIGINT AS n, sum(len(ts))::BIGINT AS l FROM d WHERE len(ts) > 0),
tf AS (SELECT rid, t, count(*)::BIGINT AS tf FROM (SELECT rid, unnest(ts) AS t FROM d) GROUP BY ALL),
df AS (SELECT t, count(*)::BIGINT AS df FROM tf GROUP BY t),
q AS (SELECT iid, t, count(*)::BIGINT AS times FROM (SELECT iid, unnest(ts) AS t FROM i) GROUP BY ALL),
w AS (SELECT t, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM df, total),
m AS (SELECT rid, 100 - 75 + ((75 * len(ts) * n) // l) AS m FROM d, total WHERE len(ts) > 0),
s AS (SELECT iid, rid, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM q JOIN tf USING (t) JOIN w USING (t) JOIN m USING (rid) GROUP BY ALL),
r AS (SELECT iid, doc_id, score, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank
      FROM s JOIN d USING (rid) WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r JOIN i USING (iid) WHERE rank <= {TOP}
"""
