import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from helpers import docs_frame, same_rows

from tslake.llm import decontaminate as dc
from tslake.llm.common import shingle_hashes, text_buffer


def corpus(seed=2):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randint(0, 5000)}"
    items = [" ".join(word() for _ in range(n)) for n in (5, 6, 8, 14, 30, 60, 200, 12, 13, 40)]
    items += [None, "", "?!", "Élan Vital", "one", "two words", "a b c d", items[3], "a b c d e a b c d e a b c d e"]
    docs = [None, "", "...", "ÉLAN vital", "élan vital", "a, b; c d", "a b c d e a b c d e"]
    for k, item in enumerate(items[:10]):
        words = item.split()
        for change in (0, 1, 2, max(1, len(words) // 25), len(words) // 8):
            copy = list(words)
            for _ in range(change):
                copy[rng.randrange(len(copy))] = word()
            noise = [word() for _ in range(rng.choice([0, 30, 3000]))]
            docs.append(" ".join(noise[: len(noise) // 2]) + ".\n" + ", ".join(copy).upper() + " " + " ".join(noise[len(noise) // 2 :]))
    docs.append(" ".join(items[:10]))  # one document that holds all
    docs.append(" ".join(items[:10]) + " two, words: ONE")
    docs += [" ".join(word() for _ in range(400)) for _ in range(20)]
    return items, docs


def frames(spark, items, docs):
    df, arrow = docs_frame(spark, docs)
    rows = [(k if k != 4 else None, t, 1) for k, t in enumerate(items)]
    bench = spark.createDataFrame(rows, "item_id long, text string, doc_id int")
    return df, arrow, bench, pa.table({"item_id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows], pa.string())})


def test_against_sql(spark):
    df, arrow, bench, bench_arrow = frames(spark, *corpus())
    same_rows(dc.pairs(df, bench), dc.SQL, documents=arrow, benchmark=bench_arrow)


def test_blocks_change_nothing(spark, monkeypatch):
    df, arrow, bench, bench_arrow = frames(spark, *corpus(5))
    monkeypatch.setattr(dc, "BLOCK_ENTRIES", 600)
    assert len(list(dc.blocks(bench))) > 3
    same_rows(dc.pairs(df, bench), dc.SQL, documents=arrow, benchmark=bench_arrow)


def test_clean_and_empty(spark):
    df, _, bench, _ = frames(spark, *corpus())
    held = {r.doc_id for r in dc.pairs(df, bench).collect()}
    kept = dc.clean(df, bench)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(map(repr, ids)) == sorted(repr(r.doc_id) for r in df.collect() if r.doc_id not in held)
    assert dc.pairs(df, bench.limit(0)).count() == 0 and dc.clean(df, bench.limit(0)).count() == df.count()
    assert dc.pairs(df.limit(0), bench).count() == 0


def test_table(spark):
    path = "/root/testdata/sf0.001/%s.parquet"
    got = dc.pairs(spark.read.parquet(path % "documents"), spark.read.parquet(path % "benchmark"))
    same_rows(got, dc.SQL, documents=pq.read_table(path % "documents"), benchmark=pq.read_table(path % "benchmark"))
    assert got.count() > 0


def test_shingles_of_one_hash(monkeypatch):
    """Shingles are told apart by their text, whatever their hashes."""
    texts = ["a b c d e f g", "h i j k l m n", "a b c d e f g x y z h i j k l m n", "other words than those of any item"]

    def found():
        data, offsets = text_buffer(pa.array(texts))
        return dc.Index([dc.Item(i, t) for i, t in enumerate(texts[:2])]).search(data, offsets)

    want = found()
    assert want == [(0, 0, 3), (1, 1, 3), (2, 0, 3), (2, 1, 3)]
    monkeypatch.setattr(dc, "shingle_hashes", lambda *a: (lambda h, at: (h % np.uint64(2), at))(*shingle_hashes(*a)))
    assert sorted(found()) == want


def test_structured_words(spark):
    x, y = ("".join("xy"[(i.bit_count() + swap) % 2] for i in range(1024)) for swap in (0, 1))
    docs = spark.createDataFrame([(1, f"{x} end"), (2, f"{y} end"), (3, "end")], "doc_id long, text string")
    items = spark.createDataFrame([(8, f"{x} end"), (9, f"{y} end")], "item_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in dc.pairs(docs, items).collect()) == [(1, 8), (2, 9)]
