"""op7 against the tiktoken library."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import types as T

from tslake.llm import bpe

SCHEMA = "doc_id long, text string, ids string"


@pytest.fixture(scope="module")
def reference():
    ranks = {t: i for i, t in enumerate(bpe.vocabulary().tokens)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(7)
    fixed = [None, "", " ", "a", "a" * 3000, "  \n\n x  ", "日本語" * 40, "🎉 <|endoftext|> don't", "x" * 257, "ab " * 4000]
    return fixed + ["".join(rng.choice("abet \n'sñé1#") for _ in range(rng.randint(0, 90))) for _ in range(300)] + ["same"] * 3


def test_round_trip(spark, reference):
    rows = [(i, t, "clash") for i, t in enumerate(texts())] + [(None, "no id", None)]
    got = bpe.round_trip(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    want = {}
    for i, t, _ in rows:
        ids = reference.encode_ordinary(t or "")
        want[i] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
    assert {r.doc_id: tuple(r)[1:] for r in got} == want


def test_encode_then_decode_keeps_columns(spark, reference):
    rows = [(i, t, "clash") for i, t in enumerate(texts())]
    encoded = bpe.encode(spark.createDataFrame(rows, SCHEMA))
    assert encoded.columns == ["doc_id", "text", "ids"] and encoded.schema["ids"].dataType == T.ArrayType(T.IntegerType(), False)
    for r in bpe.decode(encoded).collect():
        assert r.ids == reference.encode_ordinary(r.text or "")
        assert bytes(r.decoded).decode() == (r.text or "")


def test_empty_table(spark):
    assert bpe.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


def test_pool_limit_changes_nothing(reference):
    encoder = bpe.Encoder(bpe.vocabulary(), public_tokenizers.PATTERN)
    encoder.pool_limit = 5
    for t in [x or "" for x in texts()]:
        ids, begins = encoder.encode([t])
        assert ids.tolist() == reference.encode_ordinary(t) and begins.tolist() == [0, len(ids)]
