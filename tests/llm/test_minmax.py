"""op13 against SQL, and its signatures against their guarantees."""

import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from helpers import docs_frame, same_rows
from test_jaccard import near_copies

from tslake.llm import minmax


def test_against_sql(spark):
    df, arrow = docs_frame(spark, near_copies(3))
    same_rows(minmax.join(df), minmax.SQL, documents=arrow)


def test_table(spark):
    path = "/root/testdata/sf0.001/documents.parquet"
    same_rows(minmax.join(spark.read.parquet(path)), minmax.SQL, documents=pq.read_table(path))


def test_at_the_threshold(spark):
    """Families whose members are just inside and just outside of it."""
    rng = random.Random(11)
    texts = []
    for n in (9, 13, 25, 60, 200, 700):
        base = [f"t{rng.random()}" for _ in range(n)]
        texts.append(" ".join(base))
        for share in (0.1, 0.14, 0.15, 0.16, 0.17, 0.18, 0.2):
            texts.append(" ".join(base + [f"m{rng.random()}" for _ in range(round(n * share))]))
            texts.append(" ".join(base[round((n - 2) * share) :]))
    rng.shuffle(texts)
    df, arrow = docs_frame(spark, texts)
    same_rows(minmax.join(df), minmax.SQL, documents=arrow)


def test_repeats_nulls_and_empty(spark):
    text = " ".join(f"t{i}" for i in range(40))
    rows = [(7, text), (3, text), (3, "other words here"), (None, text), (9, "OTHER words HERE"), (5, None), (5, None), (6, "a b"), (8, "A b")]
    arrow = pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows], pa.string())})
    same_rows(minmax.join(spark.createDataFrame(rows, "doc_id long, text string")), minmax.SQL, documents=arrow)
    assert minmax.join(spark.createDataFrame([], "doc_id long, text string, kept string")).count() == 0


def test_values_estimate_similarity():
    """Smallest and largest values agree with the similarity as probability; a band is shared at the threshold."""
    rng = np.random.default_rng(2)
    method = minmax.method()
    for size in (7, 20, 100, 1000):
        agreed, similar = [], []
        for _ in range(60):
            gone = max(g for g in range(size) if 100 * (size - g) >= 85 * size)
            a = rng.integers(0, 2**64, size, dtype=np.uint64)
            elements, at = np.concatenate([a, a[gone:]]), np.array([0, size, 2 * size - gone])
            values = minmax.extremes(elements, at)
            agreed.append((values[:, :, 0] == values[:, :, 1]).mean(axis=1))
            similar.append((size - gone) / size)
            who, signature = method.signatures(elements, at)
            assert set(signature[who == 0]) & set(signature[who == 1])
        for side in np.array(agreed).T:
            assert abs(side.mean() - np.mean(similar)) < 0.02
