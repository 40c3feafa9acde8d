import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from helpers import docs_frame, same_rows

from tslake.llm import jaccard, linking
from tslake.llm.components import components


def near_copies(seed=1):
    """Families of texts with changed words, copies, short and odd texts."""
    rng = random.Random(seed)
    out = [None, "", " \n", "one", "One", "one two", "a b c", "A B\tc", "a b c a b c a b c", "ÀB c d", "àB c d"]
    for size in (5, 9, 12, 20, 33, 60, 150, 400):
        base = [f"w{rng.randint(0, 3000)}" for _ in range(size)]
        for _ in range(14):
            words = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, max(1, size // 60), max(1, size // 30)])):
                at = rng.randrange(len(words))
                words[at : at + 1] = rng.choice([[], ["new%d" % rng.randint(0, 99)], [words[at], "more"]])
            out.append(" ".join(words).replace("w1", rng.choice(["w1", "W1"])))
    chain = [f"c{i}" for i in range(200)]
    for _ in range(12):  # each links with the next, the ends do not
        chain = chain[3:] + [f"x{rng.random()}" for _ in range(3)]
        out.append(" ".join(chain))
    rng.shuffle(out)
    return out


def test_against_sql(spark):
    df, arrow = docs_frame(spark, near_copies())
    same_rows(jaccard.join(df), jaccard.SQL, documents=arrow)


def test_table(spark):
    path = "/root/testdata/sf0.001/documents.parquet"
    same_rows(jaccard.join(spark.read.parquet(path)), jaccard.SQL, documents=pq.read_table(path))


def test_nulls_repeats_and_empty(spark):
    text = " ".join(f"t{i}" for i in range(40))
    rows = [(7, text), (3, text), (3, "other words here"), (None, text), (9, "OTHER words HERE"), (5, None), (5, None)]
    got = sorted(map(tuple, jaccard.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    assert got == sorted([(7, 38, 3), (3, 38, 3), (3, 1, 3), (None, 38, None), (9, 1, 3), (5, 0, 5), (5, 0, 5)], key=repr)
    assert jaccard.join(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_repeated_ids_with_different_texts(spark):
    """A doc_id links by all its rows, also where it is the smallest of no set."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(5, a), (9, a), (7, b), (9, b), (7, None), (8, c), (6, c), (8, ""), (4, "x y"), (8, "x y"), (10, None), (10, "z"), (None, b), (11, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    arrow = pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows], pa.string())})
    same_rows(jaccard.join(df), jaccard.SQL, documents=arrow)
    assert {r.doc_id: r.component_id for r in jaccard.join(df).collect()} == {5: 5, 9: 5, 7: 5, 8: 4, 6: 4, 4: 4, 10: 10, None: None, 11: 11}


def thue_morse(n, swap=False):
    return "".join("xy"[(i.bit_count() + swap) % 2] for i in range(n))


def test_structured_words(spark):
    """Words whose letters are each other's opposites do not count as one."""
    rows = [(i, t) for i, t in enumerate([thue_morse(1024), thue_morse(1024, True), thue_morse(1024), " ".join(thue_morse(1 << k) for k in range(11)), " ".join(thue_morse(1 << k, True) for k in range(11))])]
    assert {r.doc_id: r.component_id for r in jaccard.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == {0: 0, 1: 1, 2: 0, 3: 3, 4: 4}


def test_one_id_on_many_rows(spark):
    """Every row of an id has a set of its own, and some of them link."""
    base = [[f"{x}{i}" for i in range(60)] for x in "ab"]
    rows = [(d, " ".join([*base[d][:59], f"n{d}-{k}"])) for d in (0, 1) for k in range(300)]
    rows += [(2, rows[0][1])] * 50 + [(0, rows[300][1]), (9, "something else altogether")]
    got = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows) and {(r.doc_id, r.component_id) for r in got} == {(0, 0), (1, 0), (2, 0), (9, 9)}


def test_five_words_against_sql(spark):
    df, arrow = docs_frame(spark, near_copies(2))
    same_rows(jaccard.join(df, 80, 5), jaccard.sql(80, 5), documents=arrow)


def test_linked_sets_share_a_signature():
    """The guarantee, at the limit of the budget, for many sizes."""
    rng = np.random.default_rng(4)
    for size in [*range(1, 120), 200, 333, 700, 1500]:
        for percent in (90, 90, 90, 80, 80, 80):
            a = rng.integers(0, 2**63, size, dtype=np.uint64)
            gone = int(rng.integers(0, size * (100 - percent) // 100 + 1))
            fresh = int(rng.integers(0, size * (100 - percent) // 100 + 1))
            b = np.concatenate([a[gone:], rng.integers(0, 2**63, fresh, dtype=np.uint64)])
            both, union = size - gone, size + fresh
            elements, sizes = np.concatenate([a, b]), np.array([len(a), len(b)])
            who, signature = jaccard._signatures(elements, np.repeat([0, 1], sizes), sizes, percent)
            if 100 * both >= percent * union and gone + fresh:
                assert set(signature[who == 0]) & set(signature[who == 1]), (size, gone, fresh)


def test_sketches_bound_the_distance(spark):
    """Never more than the sets' distance, also between sketches of two widths."""
    rng = np.random.default_rng(5)
    rows = []
    for size in (1, 30, 300, 990, 1050, 1999, 2001, 3990, 9000):
        a = rng.integers(0, 2**63, size, dtype=np.uint64)
        for gone, fresh in ((0, 0), (size // 10, size // 10), (0, size // 8), (size // 8, 0), (size, size)):
            b = np.concatenate([a[gone:], rng.integers(0, 2**63, fresh, dtype=np.uint64)])
            x, y = zip(*(c.to_pylist() for c in linking.sketches(np.concatenate([a, b]), np.array([0, size, size + len(b)]))))
            rows.append((size, *x, len(b), *y, 100 * (size - gone) >= 90 * (size + fresh), gone == size > 30))
    schema = ", ".join(f"{s}n_shingles long, " + ", ".join(f"{s}{f}" for f in linking.SKETCH.split(", ")) for s in ("a_", "b_"))
    found = spark.createDataFrame(rows, f"{schema}, link boolean, far boolean").select("link", "far", linking.near("a_", "b_", 90).alias("near")).collect()
    assert all(r.near for r in found if r.link) and not any(r.near for r in found if r.far) and sum(r.link for r in found) > 7


def test_components(spark):
    rng = random.Random(8)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)] + [(5, 5), (None, 4), (400, 400)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    want = {n: find(n) for n in list(root)}
    assert {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()} == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
