"""Components of documents whose shingle sets are similar, by any signatures.

A ``Method`` gives each set its signatures; two similar sets must share one.
Everything else is the same for all methods:

Every distinct set is taken once, with the text of one row that has it: copies,
and a doc_id that stands on many rows, cost no more than that. Signatures pass
one shuffle, in which the sets of a signature are linked to its smallest one (a
star, no pairs within the group); in a second round members of a signature
whose components are still different are compared across components. The parity
sketches of the sets, whose distance never exceeds that of the sets, thin the
candidates, and what is left is confirmed on the sets of shingles themselves,
compared as text. So every link between different components that
the signatures can show is found, without the pairs of a group that is already
one. A doc_id whose rows have different sets is linked with the representative
of each.

Equal sets are known by two 64-bit sums of shingle hashes and the size. Defined
results: null text or one without words has an empty set and links with
nothing; a text with fewer words than a shingle has its whole sequence as one;
a doc_id on several rows is one document whose links are those of any of its
rows; a row without doc_id links with nothing and has a null component; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tslake.llm import files
from tslake.llm.common import LOWER_BYTES, SPACED, mix64, row_blocks, shingle_hashes, text_buffer, word_hashes
from tslake.llm.components import components

KEY = ["n_shingles", "k1", "k2"]
#: Longs of a parity sketch, and the shingles from which on there is a longer one as
#: well, with twice as many, and so on.
SKETCH_LONGS, SKETCH_SIZE = 16, 1000
PLACES = [f"p{i}" for i in range(SKETCH_LONGS)]
SKETCH = ", ".join([*(f"{p} long" for p in PLACES), "more array<long>"])
SKETCH_NAMES = [*PLACES, "more"]
#: Shingle sets a task keeps while it confirms pairs.
HELD_SETS = 64


@dataclass(frozen=True)
class Method:
    """Sets are given as (elements, at): the sorted distinct shingle hashes of
    consecutive texts and where each text's begin."""

    name: str
    words: int
    #: Two sets link when 100 * intersection >= percent * union.
    percent: int
    #: (owner, signature) of all sets.
    signatures: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def sets_of(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of consecutive texts, and where each text's begin."""
    hashes, begins = shingle_hashes(*word_hashes(data, offsets, SPACED), words)
    found = [np.unique(hashes[a:b]) for a, b in zip(begins[:-1], begins[1:])]
    at = np.zeros(len(found) + 1, np.int64)
    np.cumsum([len(x) for x in found], out=at[1:])
    return np.concatenate(found) if found else hashes, at


def shingles(text: str, words: int) -> set[tuple[bytes, ...]]:
    """The set of a text, its shingles as they are."""
    found = text.encode().translate(LOWER_BYTES).split()
    return set(zip(*(found[i:] for i in range(words)))) if len(found) >= words else {tuple(found)} if found else set()


def lists(values: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.view(np.int64)))


def _blocks_of(batches: Iterator[pa.RecordBatch], column: int, words: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Bounded slices of the batches with their texts' sets."""
    for batch in batches:
        data, offsets = text_buffer(batch.column(column))
        for lo, hi in row_blocks(offsets):
            yield batch.slice(lo, hi - lo), *sets_of(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], words)


def _keys(elements: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(elements ^ np.uint64(seed)), dtype=np.uint64)]) for seed in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]
    return [(s[at[1:]] - s[at[:-1]]).view(np.int64) for s in sums]


def sketches(elements: np.ndarray, at: np.ndarray) -> list[pa.Array]:
    """The parity of a set's elements in each of a number of places, as so many
    columns of 64 places each. Sets from ``SKETCH_SIZE`` shingles on have a longer
    sketch as well, so that it still tells how far two of them are apart. A
    sketch folded in the middle is that of half as many places."""
    sizes, n = np.diff(at), len(at) - 1
    longs = SKETCH_LONGS << np.ceil(np.log2(np.maximum(sizes, 1) / SKETCH_SIZE)).clip(0).astype(np.int64)
    short = _parities(elements, at, np.full(n, SKETCH_LONGS)).reshape(n, SKETCH_LONGS)
    longs[longs == SKETCH_LONGS] = 0
    inside = np.repeat(longs > 0, sizes)
    more = _parities(elements[inside], np.append(0, np.cumsum(sizes[longs > 0])), longs[longs > 0])
    return [*(pa.array(np.ascontiguousarray(short[:, i])) for i in range(SKETCH_LONGS)), lists(more, np.append(0, np.cumsum(longs)))]


def _parities(elements: np.ndarray, at: np.ndarray, longs: np.ndarray) -> np.ndarray:
    sizes, begins = np.diff(at), np.append(0, np.cumsum(longs))
    place = mix64(elements) & (np.repeat(longs, sizes) * 64 - 1).astype(np.uint64)
    bits = np.bincount(np.repeat(begins[:-1] * 64, sizes) + place.astype(np.int64), minlength=int(begins[-1]) * 64) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def _apart(x: str, y: str) -> str:
    return f"aggregate(zip_with({x}, {y}, (x, y) -> bit_count(x ^ y)), 0, (s, x) -> s + x)"


def _folded(x: str) -> str:
    half = f"size({x}) div 2"
    return f"zip_with(slice({x}, 1, {half}), slice({x}, {half} + 1, {half}), (x, y) -> x ^ y)"


def near(a: str, b: str, percent: int) -> Column:
    """Whether the sizes and sketches whose names have these prefixes leave a link
    possible: a sketch's distance never exceeds that of the sets."""
    most = f"({a}n_shingles + {b}n_shingles) * {100 - percent}"
    sizes = f"100 * least({a}n_shingles, {b}n_shingles) >= {percent} * greatest({a}n_shingles, {b}n_shingles)"
    short = " + ".join(f"bit_count({a}{p} ^ {b}{p})" for p in PLACES)
    x, y = f"{a}more", f"{b}more"
    longer = (
        f"CASE WHEN size({x}) = 0 OR size({y}) = 0 THEN 0 WHEN size({x}) = size({y}) THEN {_apart(x, y)}"
        f" WHEN size({x}) = 2 * size({y}) THEN {_apart(_folded(x), y)} WHEN size({y}) = 2 * size({x}) THEN {_apart(x, _folded(y))} ELSE 0 END"
    )
    return F.expr(f"CASE WHEN NOT ({sizes}) THEN false WHEN ({short}) * {100 + percent} > {most} THEN false ELSE ({longer}) * {100 + percent} <= {most} END")


def known_sets(docs: DataFrame, words: int) -> DataFrame:
    """Per row: doc_id and the size and identity of its text's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, elements, at in _blocks_of(batches, 1, words):
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.diff(at)), *map(pa.array, _keys(elements, at))], names=["doc_id", *KEY])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_shingles long, k1 long, k2 long")


def distinct_sets(docs: DataFrame, copies: DataFrame, method: Method) -> DataFrame:
    """One row for each set of ``copies``: sid, rep, n_shingles, its sketch and a
    text that has the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, elements, at in _blocks_of(batches, 1, method.words):
            keys = [np.diff(at), *_keys(elements, at)]
            # a doc_id that repeats a set within the slice is sent once
            ids = rows.column(0).fill_null(0).to_numpy()
            _, first = np.unique(np.stack([ids, *keys]), axis=1, return_index=True)
            some = np.sort(first[keys[0][first] > 0])
            some = some[rows.column(0).is_valid().to_numpy(zero_copy_only=False)[some]]
            out = [rows.column(0), rows.column(1), *map(pa.array, keys), *sketches(elements, at)]
            yield pa.RecordBatch.from_arrays([c.take(pa.array(some)) for c in out], names=["rep", "text", *KEY, *SKETCH_NAMES])

    schema = f"rep long, text string, n_shingles long, k1 long, k2 long, {SKETCH}"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
    one = rows.join(copies, ["rep", *KEY]).groupBy("rep", *KEY, "sid").agg(*(F.first(c).alias(c) for c in (*SKETCH_NAMES, "text")))
    return one.select("sid", "rep", "n_shingles", *SKETCH_NAMES, "text")


def signed(texts: DataFrame, method: Method) -> DataFrame:
    """(sid, signature) rows of all sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, elements, at in _blocks_of(batches, 1, method.words):
            who, signature = method.signatures(elements, at)
            ids = rows.column(0).to_numpy()[who]
            for lo in range(0, len(ids), 1 << 17):
                part = slice(lo, lo + (1 << 17))
                yield pa.RecordBatch.from_arrays([pa.array(ids[part]), pa.array(signature[part].view(np.int64))], names=["sid", "signature"])

    return texts.select("sid", "text").mapInArrow(run, "sid long, signature long")


def _linked(texts: DataFrame, pairs: DataFrame, method: Method, name: str, made: list[str]) -> DataFrame:
    """Links (a, b) between the representatives of those pairs of sets (a, b)
    whose shingles, compared as text, are similar enough."""
    spark, words, percent = texts.sparkSession, method.words, method.percent
    pairs = files.settled(spark, pairs, f"{name}-pairs", made)
    wanted = pairs.select(F.col("a").alias("sid")).union(pairs.select("b")).distinct()
    held = files.settled(spark, texts.select("sid", "rep", "text").join(wanted, "sid"), f"{name}-texts", made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[int, set] = {}

        def of(sid: int, text: pa.StringScalar) -> set:
            if sid not in sets:
                if len(sets) >= HELD_SETS:
                    sets.clear()
                sets[sid] = shingles(text.as_py(), words)
            return sets[sid]

        for batch in batches:
            out = []
            a, ra, rb = (batch.column(i).to_pylist() for i in (0, 2, 3))
            for i in range(batch.num_rows):
                x, y = of(a[i], batch.column(4)[i]), shingles(batch.column(5)[i].as_py(), words)
                same = len(x & y)
                if 100 * same >= percent * (len(x) + len(y) - same):
                    out.append((ra[i], rb[i]))
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in out], pa.int64()) for k in (0, 1)], names=["a", "b"])

    def side(key: str) -> DataFrame:
        return held.select(F.col("sid").alias(key), F.col("rep").alias(f"r{key}"), F.col("text").alias(f"t{key}"))

    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ra", "rb", "ta", "tb")
    return joined.mapInArrow(run, "a long, b long").filter("a <> b").distinct()


def _several(known: DataFrame) -> DataFrame:
    """The doc_ids whose rows have different sets."""
    ends = known.filter("doc_id is not null").groupBy("doc_id").agg(*[f(c).alias(f"{n}_{c}") for c in KEY for n, f in (("low", F.min), ("high", F.max))])
    return ends.filter(" or ".join(f"low_{c} < high_{c}" for c in KEY)).select("doc_id")


def join(docs: DataFrame, method: Method) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable by links)."""
    spark, name = docs.sparkSession, method.name
    made: list[str] = []  # tables that only the way to the components needs
    known = files.settled(spark, known_sets(docs, method.words), f"{name}-known")
    copies = known.filter("n_shingles > 0 and doc_id is not null").groupBy(*KEY).agg(F.min("doc_id").alias("rep"))
    copies = files.settled(spark, copies.withColumn("sid", F.monotonically_increasing_id()), f"{name}-copies")
    texts = files.settled(spark, distinct_sets(docs, copies, method), f"{name}-texts", made)

    group = Window.partitionBy("signature")
    shared = signed(texts, method).withColumn("leader", F.min("sid").over(group)).withColumn("last", F.max("sid").over(group))
    members = files.settled(spark, shared.filter("leader < last").drop("last"), f"{name}-members", made)

    def traits(alias: str) -> DataFrame:
        return texts.select(F.col("sid").alias(alias), *(F.col(c).alias(f"{alias}_{c}") for c in ("n_shingles", *SKETCH_NAMES)))

    stars = members.filter("sid <> leader").select(F.col("leader").alias("a"), F.col("sid").alias("b")).distinct()
    stars = stars.join(traits("a"), "a").join(traits("b"), "b").filter(near("a_", "b_", method.percent)).select("a", "b")
    links = _linked(texts, stars, method, f"{name}-stars", made)

    several = files.settled(spark, _several(known), f"{name}-several")
    own = known.join(several, "doc_id", "left_semi").distinct()
    own = own.join(copies, KEY).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    whole = files.settled(spark, components(links.unionByName(own)), f"{name}-first")

    # members of a signature whose components still differ
    placed = members.select("signature", "sid").join(texts.select("sid", "rep"), "sid").join(whole, F.col("rep") == F.col("node"), "left")
    placed = placed.select("signature", "sid", F.coalesce("component", "rep").alias("component"))
    placed = placed.withColumn("low", F.min("component").over(group)).withColumn("high", F.max("component").over(group)).filter("low < high").drop("low", "high")
    placed = files.settled(spark, placed.join(traits("sid"), "sid"), f"{name}-placed", made)
    if not placed.isEmpty():
        x, y = placed.alias("x"), placed.alias("y")
        across = x.join(y, (F.col("x.signature") == F.col("y.signature")) & (F.col("x.component") < F.col("y.component")) & near("x.sid_", "y.sid_", method.percent))
        across = across.select(F.least("x.sid", "y.sid").alias("a"), F.greatest("x.sid", "y.sid").alias("b")).distinct()
        more = _linked(texts, across, method, f"{name}-across", made)
        whole = files.settled(spark, components(whole.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more)), f"{name}-whole")
    files.remove(spark, made)

    named = copies.join(whole, copies["rep"] == whole["node"], "left").select(*KEY, F.coalesce("component", "rep").alias("component"))
    out = known.join(named, KEY, "left")
    # a row without words has the component of its doc_id's other rows
    by_id = whole.join(several, whole["node"] == several["doc_id"], "left_semi").select(F.col("node").alias("doc_id"), F.col("component").alias("by_id"))
    out = out.join(by_id, "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "by_id", "doc_id")).alias("component_id"))


def sql(percent: int, words: int) -> str:
    """DuckDB SQL for the rows of ``join``."""
    return rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT rid, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < {words} THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - {words} + 2), lambda i: array_to_string(ws[i:i + {words} - 1], ' ')) END) AS g FROM d),
e AS (SELECT rid, unnest(g) AS x FROM s),
n AS (SELECT rid, len(g) AS n FROM s),
p AS (SELECT a.rid AS a, b.rid AS b, count(*) AS c FROM e a JOIN e b ON a.x = b.x AND a.rid < b.rid GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n na ON na.rid = a JOIN n nb ON nb.rid = b WHERE 100 * c >= {percent} * (na.n + nb.n - c)),
both_ AS (SELECT da.doc_id AS a, db.doc_id AS b FROM l JOIN d da ON da.rid = a JOIN d db ON db.rid = b
          WHERE da.doc_id IS NOT NULL AND db.doc_id IS NOT NULL),
g AS (SELECT a, b FROM both_ UNION SELECT b, a FROM both_),
reach(v, r) AS (SELECT DISTINCT doc_id, doc_id FROM d WHERE doc_id IS NOT NULL UNION SELECT reach.v, g.b FROM reach JOIN g ON reach.r = g.a)
SELECT d.doc_id, n.n::BIGINT AS n_shingles, m.r AS component_id
FROM d JOIN n USING (rid) LEFT JOIN (SELECT v, min(r) AS r FROM reach GROUP BY v) m ON m.v = d.doc_id
"""
