"""op12 against plain scans; the grammar's extensions against plain comparison."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pyarrow.parquet as pq
import pytest

from tslake.llm import periodic
from tslake.llm.common import word_spans
from tslake.llm.grammar import Grammar


def plain_runs(words, least, exponent):
    """All runs by comparing every word with the one a period later."""
    n, out = len(words), {}
    for p in range(1, n // exponent + 1):
        i = 0
        while i + p < n:
            if words[i] == words[i + p]:
                j = i
                while j + p < n and words[j] == words[j + p]:
                    j += 1
                if j - i + p >= max(least, exponent * p):
                    out.setdefault((i, j - i + p), p)
                i = j
            i += 1
    return sorted((i, length, p) for (i, length), p in out.items())


def plain(doc_id, text, rewrite=True):
    words = [] if text is None else text.encode().split()
    n = len(words)
    if rewrite and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = sorted(plain_runs(words, 24, 3), key=lambda r: (r[0], r[2]))
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(found), *best, best[0] is not None and 1000 * best[1] // best[2] or None, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def texts(seed=3):
    rng = random.Random(seed)
    out = [None, "", " \t\n", "a", "a " * 24, "a " * 23, "a b " * 12, "a b c " * 8, "a b c d e f g h " * 3, "a b c d e f g h i " * 3, "a b c d e f g h i " * 3 + "a", "A a " * 30, "    " * 30, "x" * 5000 + " y " * 40]
    for _ in range(150):
        n, k = rng.randint(1, 220), rng.choice([1, 2, 3, 40])
        words = [f"w{rng.randrange(k)}" for _ in range(n)]
        for _ in range(rng.randint(0, 3)):  # periodic stretches, some inside others
            a, p = rng.randrange(n), rng.randint(1, 30)
            for i in range(a, min(n, a + rng.randint(10, 150))):
                words[i] = words[a + (i - a) % p]
        if rng.random() < 0.3:
            words[rng.randrange(n)] = "other"
        out.append(rng.choice([" ", "\n", " \t"]).join(words))
    out.append(" ".join((["p q r s"] * 9 + ["t"]) * 6))  # a period that holds runs itself
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 0) for r in rows], "doc_id long, text string, start string, n_runs int")


@pytest.mark.parametrize("rewrite", [True, False])
def test_against_plain(spark, rewrite):
    rows = [(i - 5, t) for i, t in enumerate(texts())]
    rows += [(None, rows[20][1]), rows[30], rows[31], (rows[32][0], rows[40][1])]
    got = periodic.report(frame(spark, rows), periodic.planted_order if rewrite else None).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((plain(d, t, rewrite) for d, t in rows), key=repr)
    assert sum(r.n_runs for r in got) > 60 and periodic.report(frame(spark, rows).limit(0)).count() == 0


def test_table(spark):
    """Whole documents of the given table, long ones too."""
    path = "/root/testdata/sf0.001/documents.parquet"
    table = pq.read_table(path)
    got = periodic.report(spark.read.parquet(path), periodic.planted_order).collect()
    want = [plain(d, t) for d, t in zip(table["doc_id"].to_pylist(), table["text"].to_pylist())]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_pieces_and_thresholds(monkeypatch):
    """The same runs whatever the piece, for other bounds as well, many texts in one grammar."""
    rng = random.Random(8)
    for piece, least, exponent in ((7, 24, 3), (1, 6, 3), (1 << 20, 4, 2), (100, 10, 4)):
        monkeypatch.setattr(periodic, "PIECE", piece)
        many = [[hash(w) % 1000 for w in (t or "").split()] for t in rng.sample(texts(piece), 25)]
        begins = np.append(0, np.cumsum([len(t) for t in many]))
        got = periodic.runs(np.array(sum(many, []), np.int64), begins, least, exponent)
        want = [[d, *r] for d, t in enumerate(many) for r in sorted(plain_runs(t, least, exponent), key=lambda r: (r[0], r[2]))]
        assert got.tolist() == want
    assert len(periodic.runs(np.zeros(0, np.int64), np.zeros(1, np.int64))) == 0


def test_extensions():
    rng = random.Random(6)
    for kind in range(60):
        n = rng.randint(2, 400)
        words = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(n)]
        p = rng.randint(1, 20)
        if kind % 2:
            words = (words[:p] * n)[:n]
        symbols = np.array([-1, *words, -2])
        grammar = Grammar(symbols)
        pairs = [(a, b) for a, b in ((rng.randint(1, n), rng.randint(1, n)) for _ in range(200)) if a < b]
        if not pairs:
            continue
        a, b = np.array(pairs).T
        ahead, behind = grammar.extend(a, b), grammar.extend_back(a, b)
        for i, (x, y) in enumerate(pairs):
            k = 0
            while symbols[x + k] == symbols[y + k]:
                k += 1
            assert ahead[i] == k
            k = 0
            while symbols[x - k - 1] == symbols[y - k - 1]:
                k += 1
            assert behind[i] == k


def test_grammar_is_small():
    """Rounds shrink the text by a constant share; a repetition costs its logarithm."""
    rng = np.random.default_rng(1)
    n = 50_000
    assert len(Grammar(np.concatenate([[-1], rng.integers(0, 5000, n), [-2]])).symbols) < 8 * n
    assert len(Grammar(np.concatenate([[-1], np.zeros(n, np.int64), [-2]])).symbols) < n + 20


def test_words_of_one_hash(monkeypatch):
    monkeypatch.setattr(periodic, "word_spans", lambda *a, **k: (lambda h, *rest: (h % np.uint64(3), *rest))(*word_spans(*a, **k)))
    text = b"a b A c b a a d e f A"
    numbers, *_ = periodic.word_numbers(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    words = text.split()
    assert all((numbers[i] == numbers[j]) == (words[i] == words[j]) for i in range(len(words)) for j in range(len(words)))
