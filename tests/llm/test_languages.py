"""op10: held-out accuracy, and the inference against a plain per-text version."""

import zlib
from collections import Counter

import numpy as np
import pytest

from tslake.llm import languages

PATH = "/root/testdata/sf0.01/documents.parquet"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(PATH)
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = languages.report(docs).collect()
    assert len(got) == len(truth)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
    tested = [r for r in got if r.held_out]
    assert sum(truth[r.doc_id] == r.lang_pred for r in tested) >= 0.98 * len(tested)


def test_lang_and_ids_are_no_inputs(spark):
    docs = spark.read.parquet(PATH)
    model = languages.learn(docs)
    a = {r.text: (r.lang_pred, r.score) for r in languages.predict(docs, model).collect()}
    changed = docs.selectExpr("doc_id + 7 as doc_id", "text", "'zz' as lang", "'s' as source", "n_chars")
    assert {r.text: (r.lang_pred, r.score) for r in languages.predict(changed, model).collect()} == a


def tiny(spark):
    en, de = "the cat sat on the mat with the other cats there", "der hund und die katze sind nicht im haus gewesen"
    rows = [(i, en if i % 2 else de, "en" if i % 2 else "de", 0.5) for i in range(40)]
    rows += [(100, None, "en", None), (101, "", "de", None), (102, "123 !? 45", "en", None), (None, de, "fr", None), (103, de, None, None)]
    rows += [(104, (en + " ") * 2000, None, None)] * 2 + [(105, "日本", None, None), (106, (en + " " + de + " ") * 30, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")


def test_unknown_nulls_and_long(spark):
    got = {}
    rows = languages.report(tiny(spark)).collect()
    assert len(rows) == tiny(spark).count()
    for r in rows:
        got[r.doc_id] = (r.held_out, r.lang_pred, round(r.score, 3))
    assert got[100][1:] == got[101][1:] == got[102][1:] == ("und", 0.0)
    assert got[None][:2] == (False, "de") and got[103][1] == "de" and got[104][1] == "en"
    assert {v[1] for v in got.values()} <= {"en", "de", "und"}
    assert 0.4 < got[106][2] < 0.6


def test_accept_keeps_columns_and_empty(spark):
    df = tiny(spark)
    kept = languages.accept(df)
    assert kept.columns == df.columns and kept.schema == df.schema
    ids = {r.doc_id for r in kept.collect()}
    assert {100, 101, 102} & ids == set() and {None, 103, 104} <= ids
    assert languages.report(df.limit(0)).count() == 0
    unlabelled = languages.report(df.withColumn("lang", df["lang"].cast("string")).filter("lang is null")).collect()
    assert {(r.lang_pred, r.score) for r in unlabelled} == {("und", 0.0)}


@pytest.fixture(scope="module")
def model(spark):
    return languages.learn(spark.read.parquet(PATH))


def plain_mixture(scores, allowed):
    mix = np.where(allowed, 1.0, 0.0) / sum(allowed)
    for _ in range(languages.ROUNDS):
        part = np.exp(scores - scores.max(axis=1, keepdims=True)) * mix
        new = (part / part.sum(axis=1, keepdims=True)).mean(axis=0)
        done = abs(new - mix).max() <= languages.SETTLED
        mix = new
        if done:
            break
    return mix, float(np.log((np.exp(scores) * mix).sum(axis=1)).sum())


def test_inference_against_plain(spark, model):
    texts = [r.text.lower().encode() for r in spark.read.parquet(PATH).limit(120).collect()]
    texts += [texts[i][:400] + b" " + texts[i + 1][:400] for i in range(0, 60)]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    scores, begins = model.word_scores(data, offsets)
    got, share = model.infer(scores, begins)
    for t in range(len(texts)):
        own = scores[begins[t] : begins[t + 1]].astype(float)
        mix, _ = plain_mixture(own, [True] * 4)
        order, price = np.argsort(-mix, kind="stable"), languages.PENALTY / 2 * np.log(max(2, len(own)))
        best = (own.sum(axis=0).max(), int(own.sum(axis=0).argmax()), 1.0)
        for size in range(2, 5):
            m, total = plain_mixture(own, [k in order[:size] for k in range(4)])
            if total - price * (size - 1) > best[0]:
                best = (total - price * (size - 1), int(m.argmax()), float(m.max()))
        assert got[t] == best[1] and abs(share[t] - best[2]) < 1e-2
    assert Counter(share < 1)[True] > 20  # mixtures occur
