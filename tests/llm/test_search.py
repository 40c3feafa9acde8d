"""op11 against SQL; the index's packing, pruning and hashes."""

import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from helpers import same_rows

from tslake.llm import search
from tslake.llm.common import text_buffer, word_spans

DOCS = "doc_id long, text string, score string, rank int"


def corpus(seed=4, n=400):
    rng = random.Random(seed)
    word = lambda: f"w{int(60 * rng.random() ** 2)}"
    texts = [" ".join(word() for _ in range(rng.choice([1, 3, 8, 20, 60]))) for _ in range(n)]
    texts += [None, "", "?!", "W1 w2, W3-w4", "Élan élan ÉLAN", "rare " * 300, "w1 " * 70_000, "solo", "solo", "solo", "x" * 3000]
    texts += texts[:5]
    rng.shuffle(texts)
    docs = [(i - 20, t) for i, t in enumerate(texts)]
    docs += [docs[0], docs[1], (docs[2][0], "w1 w2 w3"), (None, "solo"), (None, "w5 w6 w7"), (3, None)]
    items = [" ".join(word() for _ in range(k)) for k in (1, 2, 3, 5, 8, 13, 30, 60)]
    items += [None, "", "...", "nothing of this", "élan", "RARE w1", "solo", "w1 w1 w1 w1 w2", "x" * 3000, "x" * 2999]
    return docs, [(i % 15, t) for i, t in enumerate(items)] + [(None, "w3 w4"), (4, items[4]), (4, items[4])]


def frames(spark, docs, items):
    arrow = [pa.table({c: pa.array([r[k] for r in rows], kind) for k, (c, kind) in enumerate(((name, pa.int64()), ("text", pa.string())))}) for rows, name in ((docs, "doc_id"), (items, "item_id"))]
    return spark.createDataFrame([(*r, "clash", 1) for r in docs], DOCS), spark.createDataFrame([(*r, 7) for r in items], "item_id long, text string, doc_id long"), *arrow


@pytest.mark.parametrize("block, shard_docs, block_terms", [(128, 1 << 16, 100_000), (4, 40, 30), (1, 7, 1)])
def test_against_sql(spark, monkeypatch, block, shard_docs, block_terms):
    monkeypatch.setattr(search, "BLOCK", block)
    docs, items = corpus()
    if block == 1:
        docs, items = docs[::3], items[::4]
    d, i, ad, ai = frames(spark, docs, items)
    same_rows(search.search(search.index(d.repartition(3), shard_docs=shard_docs), i, block_terms=block_terms), search.SQL, documents=ad, benchmark=ai)


def test_tables(spark):
    folder = "/root/testdata/sf0.001"
    read = {t: f"{folder}/{t}.parquet" for t in ("documents", "benchmark")}
    same_rows(search.report(*(spark.read.parquet(p) for p in read.values())), search.SQL, **{t: pq.read_table(p) for t, p in read.items()})


def test_empty(spark):
    docs, items = corpus(n=5)
    d, i, _, _ = frames(spark, docs, items)
    assert search.report(d.limit(0), i).count() == 0
    assert search.report(d, i.limit(0)).count() == 0
    assert search.report(d.filter("text is null"), i).count() == 0


def shard(texts, **kwargs):
    data, offsets = text_buffer(pa.array(texts))
    n = len(texts)
    return search.Shard(**search.build(np.arange(n), np.zeros(n, bool), data, offsets, **kwargs))


def test_postings_of_any_width():
    rng = random.Random(1)
    texts = [" ".join(["often"] * (70_000 if i % 1000 == 0 else rng.choice([1, 2, 255, 300] if i % 5 == 0 else [1])) + (["seldom"] if i % 700 == 3 else []) + [f"u{i}"]) for i in range(3000)]
    s = shard(texts)
    sizes = np.array([len(t.split()) for t in texts])
    order = np.argsort(sizes, kind="stable")
    assert (s.sizes == sizes[order]).all() and (s.doc_ids == order).all()
    for term in (b"often", b"seldom", b"u17"):
        at = s.find(search.hash_spans(term + bytes(8), np.array([0]), np.array([len(term)])), [term])[0]
        lo, hi = s.blocks(at)
        docs, n = (np.concatenate(x) for x in zip(*(s.unpack(at, b) for b in range(lo, hi))))
        want = [(k, texts[d].split().count(term.decode())) for k, d in enumerate(order.tolist()) if term.decode() in texts[d].split()]
        assert list(zip(docs.tolist(), n.tolist())) == want
    assert {int(w) for w in np.unique(s.widths & 15)} >= {0, 1} and {int(w) for w in np.unique(s.widths >> 4)} >= {0, 1, 2}


def test_terms_of_one_hash(monkeypatch):
    """Terms are told apart by their bytes, whatever their hashes."""
    monkeypatch.setattr(search, "word_spans", lambda *a: (lambda h, *rest: (h % np.uint64(3), *rest))(*word_spans(*a)))
    real = search.hash_spans
    monkeypatch.setattr(search, "hash_spans", lambda *a: real(*a) % np.uint64(3))
    texts = ["a b c d e f g h", "A x y z a", "h h g"]
    s = shard(texts)
    every = sorted({w for t in texts for w in t.lower().encode().split()})
    hashes = search.hash_spans(b"".join(every) + bytes(8), *search._spans(every))
    found = s.find(hashes, every)
    assert sorted(found) == list(range(len(every)))
    for n, at in found.items():
        docs, times = s.unpack(at, s.blocks(at)[0])
        assert {(texts[s.doc_ids[d]], int(t)) for d, t in zip(docs, times)} == {(t, t.lower().encode().split().count(every[n])) for t in texts if every[n] in t.lower().encode().split()}


def test_blocks_are_rejected_unread():
    """With a score to reach, most blocks of common terms stay packed, and nothing is lost."""
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["common", "usual", f"v{rng.randint(0, 9)}"]) for _ in range(rng.randint(3, 300))) for _ in range(20_000)]
    for i in range(12):
        texts[i * 1000] = "common usual needle"
    s = shard(texts)
    n_docs, n_terms = len(texts), int(s.sizes.sum())
    names = [b"common", b"usual", b"needle"]
    found = s.find(search.hash_spans(b"".join(names) + bytes(8), *search._spans(names)), names)

    def lists():
        return [search.List(s, found[k], search.weight(n_docs, int(s.frequencies[found[k]])), n_docs, n_terms) for k in range(3)]

    docs, scores = search.best(lists(), 0)
    tenth = int(np.sort(scores)[-10])
    read = []
    real = search.Shard.unpack
    try:
        search.Shard.unpack = lambda self, term, block: read.append(block) or real(self, term, block)
        some, few = search.best(lists(), tenth)
    finally:
        search.Shard.unpack = real
    want = scores >= tenth
    assert (some == docs[want]).all() and (few == scores[want]).all()
    assert len(read) < 0.2 * sum(s.blocks(found[k])[1] - s.blocks(found[k])[0] for k in range(3))


def test_shards_pass_as_files(spark):
    """A shard's row has its path, not its bytes, whatever its size; the file holds all of it."""
    rng = random.Random(6)
    texts = [" ".join(f"w{rng.randint(0, 50_000)}" for _ in range(1000)) for _ in range(200)] + ["", None, "solo"]
    docs = spark.createDataFrame([(i if t != "solo" else None, t) for i, t in enumerate(texts)], "doc_id long, text string")
    (row,) = search.index(docs.coalesce(1)).collect()
    assert sum(len(str(value)) for value in row) < 1000
    assert (row["n_docs"], row["n_terms"]) == (201, 200_001)
    found, want = search.read(row["path"]), shard(texts)
    assert sorted(found.doc_ids[~found.null_ids].tolist()) == list(range(202)) and found.null_ids.sum() == 1
    for name in set(search.ARRAYS) - {"doc_ids", "null_ids"}:
        assert (getattr(found, name) == getattr(want, name)).all()
    some = search.read(row["path"], names=("terms", "hashes"))
    assert (some.terms == want.terms).all() and (some.hashes == want.hashes).all() and not hasattr(some, "postings")
