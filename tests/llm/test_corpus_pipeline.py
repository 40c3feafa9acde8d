"""The pipeline against brute force, stage by stage on its own input."""

import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import tiktoken
from helpers import duck

import corpus_pipeline
from tslake.llm import bpe, decontaminate, jaccard, languages, quality

SF = "/root/testdata/sf0.001"
NEAR_SQL = jaccard.sql(corpus_pipeline.NEAR_PERCENT, corpus_pipeline.NEAR_WORDS)
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def made(seed=6):
    rng = random.Random(seed)
    vocabulary = {"en": "the of and in house tree with that from over water light".split(), "de": "der die und das mit haus baum wasser licht nicht auch über".split()}
    items = [" ".join(f"q{rng.randint(0, 999)}" for _ in range(n)) for n in (8, 20, 45)]
    docs = []
    for i in range(90):
        lang = rng.choice(["en", "de"])
        lines = [" ".join(rng.choice(vocabulary[lang]) + str(rng.randint(0, 60)) for _ in range(rng.randint(6, 25))) + "." for _ in range(rng.randint(2, 9))]
        if i % 9 == 0:
            lines.insert(1, items[i % 3].upper() + ".")
        if i % 11 == 0:
            lines.append("Home | News | Sport | More")
        docs.append((1000 - i, "\n".join(lines), lang))
    for k in range(20):  # near and exact copies
        words = docs[k][1].split(" ")
        if k % 2:
            words[len(words) // 2] = "changed"
        docs.append((2000 + k, " ".join(words), docs[k][2]))
    docs += [(None, docs[3][1], "en"), docs[4], (3000, None, "en"), (3001, "", None), (3002, "1 2 3 " * 40, None), (3003, "*** " * 90, "en")]
    return [(d, t, lang, "src", len(t or "")) for d, t, lang in docs], items


def write(folder, rows, items):
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()]
    pq.write_table(pa.table({c: pa.array([r[i] for r in rows], k) for i, (c, k) in enumerate(zip(COLUMNS, kinds))}), f"{folder}/documents.parquet")
    pq.write_table(pa.table({"item_id": pa.array(range(len(items)), pa.int64()), "text": pa.array(items, pa.string())}), f"{folder}/benchmark.parquet")


def arrow(df):
    return pa.Table.from_pylist([r.asDict() for r in df.collect()], schema=pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())]))


def check_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    bench = pq.read_table(f"{folder}/benchmark.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "language_id", "ngram_jaccard_join", "benchmark_decontamination", "byte_bpe"]
    for name, stage in corpus_pipeline.STAGES:
        before = arrow(docs)
        out = stage(spark, docs, folder)
        if name == "byte_bpe":
            break
        assert out.columns == docs.columns and out.schema == docs.schema
        after = arrow(out)
        ids = sorted(map(repr, after["doc_id"].to_pylist()))
        if name == "quality_rules":
            want = [r[0] for r in duck(f"SELECT doc_id FROM ({quality.SQL}) WHERE kept", documents=before)]
            assert ids == sorted(map(repr, want))
            assert all(n == len(t) for n, t in zip(after["n_chars"].to_pylist(), after["text"].to_pylist()))
        if name == "language_id":
            found = {(r.doc_id, r.text): r for r in languages.predict(docs, languages.learn(docs)).collect()}
            assert ids == sorted(repr(d) for d, t in zip(before["doc_id"].to_pylist(), before["text"].to_pylist()) if found[d, t].lang_pred != "und" and found[d, t].score >= languages.MIN_SCORE)
        if name == "ngram_jaccard_join":
            want = {r[0] for r in duck(f"SELECT component_id FROM ({NEAR_SQL}) WHERE doc_id IS NOT NULL", documents=before)}
            assert ids == sorted([repr(d) for d in want] + ["None"] * before["doc_id"].null_count)
            rows = {tuple(r.values()) for r in before.to_pylist()}
            assert all(tuple(r.values()) in rows for r in after.to_pylist())
        if name == "benchmark_decontamination":
            held = {r[0] for r in duck(decontaminate.SQL, documents=before, benchmark=bench)}
            assert ids == sorted(repr(d) for d in before["doc_id"].to_pylist() if d not in held)
            assert held
        docs = spark.createDataFrame(after.to_pylist(), docs.schema)
    ranks = {t: i for i, t in enumerate(bpe.vocabulary().tokens)}
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for d, t in zip(before["doc_id"].to_pylist(), before["text"].to_pylist()):
        ids = coder.encode_ordinary(t or "")
        want.append((d, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(want, key=repr) and want
    return sorted(want, key=repr)


def test_made_documents(spark, tmp_path):
    rows, items = made()
    write(tmp_path, rows, items)
    want = check_stages(spark, str(tmp_path))
    assert sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect()), key=repr) == want


def shingles(text, words):
    found = (text or "").lower().split()
    return {tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1))} if found else set()


def test_near_duplicates_of_five_words(spark):
    """The join stage against all pairs at five words and 80 %."""
    rng = random.Random(3)
    rows = []
    for n in (12, 30, 60, 100, 250, 600, 1500):
        base = [f"w{rng.randint(0, 5000)}" for _ in range(n)]
        rows.append(" ".join(base))
        for share in (0.05, 0.11, 0.15, 0.2, 0.24, 0.3):  # a paragraph more
            rows.append(" ".join(base + [f"n{rng.random()}" for _ in range(int(n * share))]))
        for share in (0.01, 0.019, 0.021, 0.03):  # changed words
            rows.append(" ".join("new" if rng.random() < share else w for w in base))
    rng.shuffle(rows)
    sets = [shingles(t, 5) for t in rows]
    root = list(range(len(rows)))

    def find(x):
        return x if root[x] == x else find(root[x])

    for i in range(len(rows)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    df = spark.createDataFrame([(i, t, "en", "src", len(t)) for i, t in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(r.doc_id for r in corpus_pipeline.ngram_jaccard_join(spark, df, "").collect())
    assert got == sorted({find(i) for i in range(len(rows))})


def test_given_documents(spark):
    check_stages(spark, SF)


def test_empty(spark, tmp_path):
    write(tmp_path, [], [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_all_queries_are_registered():
    names = sorted(int(n[2:].split("_")[0]) for n in corpus_pipeline.LLM_QUERIES if n != "pipeline")
    assert names == list(range(1, 14)) and "pipeline" in corpus_pipeline.LLM_QUERIES
    assert set(corpus_pipeline.LLM_SQL) <= set(corpus_pipeline.LLM_QUERIES)


@pytest.mark.parametrize("name", ["op2_license_scan", "op3_quality_rules"])
def test_native_plans_run_no_python(spark, name):
    plan = corpus_pipeline.LLM_QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(k in plan for k in ("Python", "Arrow", "Pandas"))
