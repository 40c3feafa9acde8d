"""Language identification by inference of a mixture of languages.

Every language learned has probabilities of byte trigrams of lower-cased words
(hashed to ``BUCKETS``, add-``SMOOTHING``). A document is taken as a mixture:
each word comes from one language, with the document's own proportions.
Expectation-maximisation over the words' trigram likelihoods estimates the
proportions. The set of languages is then chosen by penalised likelihood: sets
grow in the order of the proportions, and one more language must raise the
log-likelihood by more than ``PENALTY`` times half the logarithm of the number
of words. The prediction is the chosen set's language of largest proportion
(the smaller name of equal ones), its score that proportion.

The model is fitted on a sample of about ``SAMPLE_DOCS`` documents of each
language (all, if there are fewer), chosen by a hash; its trigram counts are
summed by Spark and come to the driver as languages x ``BUCKETS`` numbers. Every
document is predicted from its whole text, and from nothing else.

Defined results: a text that is null or has no letter is ``und`` with score 0;
so is everything if there is nothing to learn from; documents without doc_id
or lang are not learned from but predicted; a null doc_id is not held out;
repeated rows are predicted one by one; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tslake.llm.common import BLOCK_BYTES, held, row_blocks, share, text_buffer

BUCKETS = 1 << 14
SMOOTHING = 0.5
SAMPLE_DOCS = 500
ROUNDS = 20
SETTLED = 1e-3
PENALTY = 4.0
FOLDS = 5
UNKNOWN = "und"
#: The pipeline rejects documents whose language has a smaller share.
MIN_SCORE = 0.4

_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = _LETTER[0x80:] = True
_CODE = np.where(_LETTER, np.arange(256), 0x20).astype(np.uint32)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets of the trigrams around each letter, where each word's begin,
    where each text's words begin)."""
    n = len(data)
    code = np.full(n + 2, 0x20, np.uint32)
    code[1:-1] = _CODE[data]
    letter = _LETTER[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before, after = code[:-2].copy(), code[2:].copy()
    before[edge[:n]] = 0x20
    after[edge[1:]] = 0x20
    first = letter & ((before == 0x20) | edge[:n])
    at = np.flatnonzero(letter)
    mixed = (before[at] << 16 | code[1:-1][at] << 8 | after[at]) * np.uint32(0x9E3779B1)
    starts = np.flatnonzero(first)
    return (mixed >> np.uint32(32 - 14)).astype(np.int32), np.searchsorted(at, starts), np.searchsorted(starts, offsets)


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # trigram buckets x languages, log-probabilities

    def word_scores(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(words x languages, where each text's words begin)."""
        buckets, words, begins = trigrams(data, offsets)
        if not len(words):
            return np.zeros((0, len(self.languages))), begins
        return np.stack([np.add.reduceat(column[buckets], words) for column in self.scores.T], axis=1), begins

    def infer(self, scores: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(language, proportion) of each text that has words; -1, 0 for others."""
        counts = np.diff(begins)
        out, share = np.full(len(counts), -1), np.zeros(len(counts))
        texts = np.flatnonzero(counts)
        if not len(texts):
            return out, share
        counts, at = counts[texts], begins[:-1][texts]
        best = scores.max(axis=1)
        likely = np.exp(scores - best[:, None])
        base = np.add.reduceat(best, at)
        allowed = np.ones((len(texts), len(self.languages)), bool)
        mix, full = _mixture(likely, at, counts, allowed, base)
        order = np.argsort(-mix, axis=1, kind="stable")
        rank = np.argsort(order, axis=1, kind="stable")
        single = np.add.reduceat(scores, at, axis=0)
        top = single.argmax(axis=1)
        chosen_mix = np.zeros_like(mix)
        chosen_mix[np.arange(len(texts)), top] = 1.0
        value = single[np.arange(len(texts)), top]
        price = PENALTY / 2 * np.log(np.maximum(counts, 2))
        # no set can beat the full one's likelihood: most texts end here
        open_ = np.flatnonzero(full - price > value)
        for size in range(2, len(self.languages) + 1):
            open_ = open_[full[open_] - price[open_] * (size - 1) > value[open_]]
            if not len(open_):
                break
            rows = np.concatenate([np.arange(a, a + n) for a, n in zip(at[open_], counts[open_])])
            begin = np.concatenate([[0], np.cumsum(counts[open_])[:-1]])
            tried, found = _mixture(likely[rows], begin, counts[open_], rank[open_] < size, base[open_])
            better = found - price[open_] * (size - 1) > value[open_]
            value[open_[better]] = found[better] - price[open_[better]] * (size - 1)
            chosen_mix[open_[better]] = tried[better]
        out[texts] = chosen_mix.argmax(axis=1)
        share[texts] = np.clip(chosen_mix.max(axis=1), 0.0, 1.0)
        return out, share


def _mixture(likely: np.ndarray, at: np.ndarray, counts: np.ndarray, allowed: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(proportions, log-likelihood) by expectation-maximisation, all texts at once.

    Texts whose proportions have settled leave the rounds.
    """
    mix = allowed / allowed.sum(axis=1)[:, None]
    live, words, begin, n = np.arange(len(counts)), likely, at, counts
    for _ in range(ROUNDS):
        part = words * np.repeat(mix[live], n, axis=0)
        part /= part.sum(axis=1)[:, None]
        new = np.add.reduceat(part, begin, axis=0) / n[:, None]
        moving = np.abs(new - mix[live]).max(axis=1) > SETTLED
        mix[live] = new
        if not moving.any():
            break
        if moving.mean() < 0.7:
            words, live, n = words[np.repeat(moving, n)], live[moving], n[moving]
            begin = np.cumsum(n) - n
    total = (likely * np.repeat(mix, counts, axis=0)).sum(axis=1)
    return mix, np.add.reduceat(np.log(total), at) + base


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """The model of the languages of ``docs`` (doc_id, text, lang) outside the held-out fold."""
    rows = docs.select("doc_id", "text", "lang").filter(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))
    )
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32))
    chance = F.create_map(*[x for lang in languages for x in (F.lit(lang), F.lit(min(1.0, sample_docs / sizes[lang])))])[F.col("lang")]
    sample = rows.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < chance * (1 << 30)).select("lang", F.lower("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            for i, lang in enumerate(batch.column(0).to_pylist()):
                text = data[offsets[i] : offsets[i + 1]]
                buckets, _, _ = trigrams(text, np.array([0, len(text)]))
                counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
                counts[lang] += np.bincount(buckets, minlength=BUCKETS)
        for lang, found in counts.items():
            some = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(some, pa.int32()), pa.array(found[some])], names=["lang", "bucket", "n"])

    summed = sample.mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros((BUCKETS, len(languages)))
    for r in summed.collect():
        counts[r["bucket"], languages.index(r["lang"])] = r["n"]
    smooth = counts + SMOOTHING
    return Model(languages, np.log(smooth / smooth.sum(axis=0)).astype(np.float32))


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; columns of those names are replaced."""
    shared = share(docs.sparkSession, model)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    fields = [docs.schema[c] for c in kept] + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    at = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held(shared)
        block = max(1, 4 * BLOCK_BYTES // max(4, len(known.languages)))
        for batch in batches:
            data, offsets = text_buffer(batch.column(at))
            names, scores = [], []
            for lo, hi in row_blocks(offsets, block):
                if not known.languages:
                    names += [UNKNOWN] * (hi - lo)
                    scores += [0.0] * (hi - lo)
                    continue
                found, share = known.infer(*known.word_scores(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]))
                names += [known.languages[k] if k >= 0 else UNKNOWN for k in found]
                scores += share.tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*kept, "lang_pred", "score"])

    # texts without a letter go in as null, so that they come out as unknown
    body = F.when(F.col(text).rlike(r"\p{L}"), F.lower(F.col(text))).alias("_body")
    return docs.select(*kept, body).mapInArrow(run, T.StructType(fields))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every whole text."""
    found = predict(docs.select("doc_id", "text"), learn(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def accept(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The documents whose language is known with a share of ``min_score`` or more; all columns stay."""
    inner = docs.select(F.struct(*docs.columns).alias("_row"), F.col("text"))
    found = predict(inner, learn(docs))
    return found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score)).select("_row.*")
