"""Benchmark decontamination by size-partitioned MinHash containment search.

An item (a benchmark text) stands in a document when the document holds
``PERCENT`` of the item's distinct shingles of ``WORDS`` words or more. Shingles
that no item has cannot matter to containment, so every document is first
reduced to the shingles that some item has, compared as text (each distinct text
has a number of its own, also where two have one hash): then a short item
and a long document that holds it are about the same size, and MinHash can find
one with the other.

Reduced sets and items are partitioned by size (powers of two). For a pair of
size classes the containment threshold gives the least Jaccard similarity, and
that the number of minima (one-row bands) needed for a miss probability below
``MISS``. Classes that would need more than ``HASHES`` minima are searched by
all their shingles instead, which misses nothing. Candidates are verified by
the exact containment of their shingles.

The benchmark is taken in blocks of at most ``BLOCK_ENTRIES`` shingles and
minima; a block's index is broadcast, its size bounded by that number, and
every whole document passes every block. Nothing is shuffled, so neither a hot
source nor a passage that many documents share gathers in a task.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z
lower-cased. Defined results: null texts and texts without words hold and match
nothing; an item with fewer words than a shingle is its whole sequence, sought
as such; repeated rows of either table are judged one by one; null ids stay;
empty tables give no pairs.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tslake.llm.common import ALNUM, held, mix64, row_blocks, share, shingle_hashes, text_buffer, word_spans
from tslake.llm.files import settled

WORDS = 5
PERCENT = 80
MISS = 1e-9
HASHES = 128
BLOCK_ENTRIES = 500_000

PAIRS = "doc_id long, item_id long, n_shared long, n_shingles long, containment double"

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_FIND = re.compile(rb"[0-9a-z\x80-\xff]+").findall
_SEEDS = mix64(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def words_of(text: bytes) -> list[bytes]:
    return _FIND(text.translate(_LOWER))


def minima(elements: np.ndarray) -> np.ndarray:
    return mix64(elements[None, :] ^ _SEEDS[:, None]).min(axis=1)


def minima_needed(item_class: int, doc_class: int, percent: int = PERCENT) -> int:
    """How many minima find a contained item but for MISS; over HASHES: too many."""
    q, u = 1 << item_class, (2 << doc_class) - 1
    least = percent * q / (100 * u + (100 - percent) * q)
    return 1 if least >= 1 else math.ceil(math.log(MISS) / math.log1p(-least))


class Item:
    """One benchmark text: its words, shingles and their length in words."""

    def __init__(self, item_id: int | None, text: str | None):
        self.item_id, self.words = item_id, words_of((text or "").encode())
        self.size = min(WORDS, len(self.words))
        self.shingles = {b" ".join(self.words[i : i + self.size]) for i in range(len(self.words) - self.size + 1)} if self.words else set()


class Index:
    """Search structure of a block of items."""

    def __init__(self, items: list[Item], percent: int = PERCENT):
        self.items, self.percent = items, percent
        #: by shingle length: hash -> {shingle: its number}; a number is one text, whatever its hash
        self.text_of: dict[int, dict[int, dict[bytes, int]]] = defaultdict(dict)
        self.sets: list[np.ndarray] = []
        self.by_shingle: dict[int, list[int]] = defaultdict(list)
        self.by_minimum: dict[tuple[int, int, int], list[int]] = defaultdict(list)
        self.classes = set()
        n = 0
        for i, item in enumerate(items):
            numbers = []
            shingles = sorted(item.shingles)
            for h, text in zip(_hashes(shingles, item.size), shingles):
                alike = self.text_of[item.size].setdefault(h, {})
                n += text not in alike
                numbers.append(alike.setdefault(text, n))
                self.by_shingle[numbers[-1]].append(i)
            self.sets.append(np.array(sorted(numbers), np.uint64))
            item_class = len(numbers).bit_length() - 1
            self.classes.add((item.size, item_class))
            for k, value in enumerate(minima(self.sets[i]).tolist()):
                self.by_minimum[item.size, item_class, k << 64 | value].append(i)
        self.sorted = {size: np.array(sorted(texts), np.uint64) for size, texts in self.text_of.items()}
        self.first_bits = {}
        for size, hashes in self.sorted.items():
            self.first_bits[size] = np.zeros(1 << 20, bool)
            self.first_bits[size][(hashes >> np.uint64(44)).astype(np.int64)] = True

    def _reduced(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(text, shingle size, its shingles that some item has), compared as text."""
        hashes, starts, ends, begins = word_spans(data, offsets, ALNUM)
        counts = np.diff(begins)
        for size, known in self.sorted.items():
            # windows of ``size`` words lie at the first words of each text but its last size - 1
            windows, at = shingle_hashes(hashes, begins, size)
            near = np.flatnonzero(self.first_bits[size][(windows >> np.uint64(44)).astype(np.int64)])
            place = np.minimum(np.searchsorted(known, windows[near]), len(known) - 1)
            near = near[known[place] == windows[near]]
            if not len(near):
                continue
            text = np.searchsorted(at, near, "right") - 1
            long_enough = counts[text] >= size
            near, text = near[long_enough], text[long_enough]
            word = begins[text] + near - at[text]
            texts = self.text_of[size]
            number = np.array(
                [
                    texts[h].get(b" ".join(words_of(data[a:b].tobytes())), 0)
                    for a, b, h in zip(starts[word].tolist(), ends[word + size - 1].tolist(), windows[near].tolist())
                ],
                np.uint64,
            )
            number, text = number[number > 0], text[number > 0]
            cuts = np.flatnonzero(np.diff(text)) + 1
            for rows, owner in zip(np.split(number, cuts), np.split(text, cuts)):
                if len(rows):
                    yield int(owner[0]), size, np.unique(rows)

    def _candidates(self, size: int, held: np.ndarray) -> set[int]:
        doc_class, least, found = len(held).bit_length() - 1, None, set()
        for item_size, item_class in self.classes:
            if item_size != size or self.percent * (1 << item_class) > 100 * len(held):
                continue  # the document holds too few shingles for the smallest item of the class
            needed = minima_needed(item_class, doc_class, self.percent)
            if needed > HASHES:
                found.update(i for h in held.tolist() for i in self.by_shingle.get(h, ()) if len(self.sets[i]).bit_length() - 1 == item_class)
                continue
            least = minima(held).tolist() if least is None else least
            for k in range(needed):
                found.update(self.by_minimum.get((size, item_class, k << 64 | least[k]), ()))
        return found

    def search(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int]]:
        """(text, item, shared shingles) of every containment."""
        out = []
        for text, size, held in self._reduced(data, offsets):
            for i in sorted(self._candidates(size, held)):
                shared = len(np.intersect1d(held, self.sets[i], assume_unique=True))
                if 100 * shared >= self.percent * len(self.sets[i]):
                    out.append((text, i, shared))
        return out


def _hashes(shingles: list[bytes], size: int) -> list[int]:
    data = np.frombuffer(b"".join(shingles), np.uint8)
    offsets = np.cumsum([0, *map(len, shingles)])
    hashes, _, _, begins = word_spans(data, offsets, ALNUM)
    return shingle_hashes(hashes, begins, size)[0].tolist()


def blocks(benchmark: DataFrame) -> Iterator[list[Item]]:
    """The benchmark's items with words, in blocks of bounded size."""
    held, size = [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        item = Item(row["item_id"], row["text"])
        if not item.shingles:
            continue
        if held and size + len(item.shingles) + HASHES > BLOCK_ENTRIES:
            yield held
            held, size = [], 0
        held.append(item)
        size += len(item.shingles) + HASHES
    if held:
        yield held


def pairs(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, item_id, n_shared, n_shingles (of the item), containment: a row
    for each row of ``docs`` and item it holds."""
    spark, out = docs.sparkSession, None
    for block in blocks(benchmark):
        shared = share(spark, Index(block, percent))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = held(shared)
            for batch in batches:
                data, offsets = text_buffer(batch.column(1))
                for lo, hi in row_blocks(offsets):
                    found = index.search(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                    if found:
                        rows = batch.column(0).take(pa.array([lo + t for t, _, _ in found]))
                        sizes = [len(index.sets[i]) for _, i, _ in found]
                        yield pa.RecordBatch.from_arrays(
                            [
                                rows,
                                pa.array([index.items[i].item_id for _, i, _ in found], pa.int64()),
                                pa.array([n for _, _, n in found], pa.int64()),
                                pa.array(sizes, pa.int64()),
                                pa.array([n / q for (_, _, n), q in zip(found, sizes)]),
                            ],
                            names=["doc_id", "item_id", "n_shared", "n_shingles", "containment"],
                        )

        part = settled(spark, docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(run, PAIRS), "contaminated")
        shared.unpersist()
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], PAIRS) if out is None else out


def clean(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT, text: str = "text") -> DataFrame:
    """``docs`` without the rows that hold an item; all columns stay."""
    at = docs.columns.index(text)
    for block in blocks(benchmark):
        shared = share(docs.sparkSession, Index(block, percent))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                data, offsets = text_buffer(batch.column(at))
                keep = np.ones(batch.num_rows, bool)
                for lo, hi in row_blocks(offsets):
                    for row, _, _ in held(shared).search(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]):
                        keep[lo + row] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {{words}} AS ws FROM documents),
i AS (SELECT row_number() OVER () AS iid, item_id, {{words}} AS ws FROM benchmark),
ish AS (SELECT DISTINCT iid, k, array_to_string(ws[s:s + k - 1], ' ') AS x
        FROM (SELECT iid, ws, least({WORDS}, len(ws)) AS k, unnest(range(1, greatest(2, len(ws) - {WORDS} + 2))) AS s FROM i WHERE len(ws) > 0)),
size AS (SELECT iid, count(*) AS n FROM ish GROUP BY iid),
dsh AS (SELECT DISTINCT rid, k, array_to_string(ws[s:s + k - 1], ' ') AS x
        FROM (SELECT rid, ws, k, unnest(range(1, len(ws) - k + 2)) AS s FROM d, (SELECT DISTINCT k FROM ish) WHERE len(ws) >= k)),
hit AS (SELECT rid, iid, count(*) AS n FROM dsh JOIN ish USING (k, x) GROUP BY ALL)
SELECT doc_id, item_id, hit.n::BIGINT AS n_shared, size.n::BIGINT AS n_shingles, hit.n::DOUBLE / size.n AS containment
FROM hit JOIN size USING (iid) JOIN d USING (rid) JOIN i USING (iid) WHERE 100 * hit.n >= {PERCENT} * size.n
""".replace(
    "{words}",
    r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')""",
)
