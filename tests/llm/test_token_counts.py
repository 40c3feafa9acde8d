"""op9 against a plain dynamic programme over every substring."""

import math
import random

import public_tokenizers
import pytest
import regex

from tslake.llm import token_counts
from tslake.llm.pretokens import read_ranks

SCHEMA = "doc_id long, text string, n_tokens long"
TOKENS = read_ranks(public_tokenizers.path(token_counts.RANKS))
RANK = {t: i for i, t in enumerate(TOKENS)}
TOTAL = math.log(sum(1 / (r + token_counts.SHIFT) for r in range(len(TOKENS))))


def brute(piece: bytes) -> int:
    best = [(0.0, 0)]
    for end in range(1, len(piece) + 1):
        found = [
            (best[start][0] - math.log(RANK[piece[start:end]] + token_counts.SHIFT) - TOTAL, -best[start][1] - 1)
            for start in range(max(0, end - 130), end)
            if piece[start:end] in RANK
        ]
        top = max(s for s, _ in found)
        best.append((top, -max(n for s, n in found if s >= top - 1e-9)))
    return best[-1][1]


def texts():
    rng = random.Random(11)
    fixed = [None, "", " ", "a" * 700, "  \n\n x  ", "日本語 " * 30, "🎉 <|endoftext|> don't", "=" * 300, "token " * 5000]
    return fixed + ["".join(rng.choice("abet \n'sñé1#thing") for _ in range(rng.randint(0, 90))) for _ in range(200)]


def test_counts(spark):
    rows = [(i, t, -1) for i, t in enumerate(texts())] + [(None, "null id", 0), (0, None, -1)]
    got = sorted(map(tuple, token_counts.count(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    find = regex.compile(public_tokenizers.PATTERN).findall
    want = []
    for i, t, _ in rows:
        pieces = find(t or "")
        known = {p: brute(p.encode()) for p in set(pieces)}
        want.append((i, len(pieces), sum(known[p] for p in pieces)))
    assert got == sorted(want, key=repr)
    assert token_counts.count(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.fixture(scope="module")
def model():
    return token_counts.model()


def test_trie_equals_single(model):
    rng = random.Random(2)
    pieces = sorted({bytes(rng.choice(b"abcing the\xc3\xa9") for _ in range(rng.randint(1, 40))) for _ in range(3000)})
    counts, scores = model.count_sorted(pieces)
    for p, n, s in zip(pieces, counts, scores):
        m, t = model.count_one(p)
        assert n == m and abs(s - t) < 1e-9


def test_pool_limit_changes_nothing(model):
    a, b = token_counts.Counter(model, public_tokenizers.PATTERN), token_counts.Counter(model, public_tokenizers.PATTERN)
    b.pool_limit = 3
    for t in texts():
        assert a.count([t or ""])[1].tolist() == b.count([t or ""])[1].tolist()
