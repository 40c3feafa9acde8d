"""op4 against the library on whole texts, and the file format's round trip."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from tslake.llm import files, token_files
from tslake.llm.common import text_buffer, word_spans
from tslake.session import work_dir

SCHEMA = "doc_id long, text string, start string"


def texts():
    rng = random.Random(5)
    fixed = [None, "", " ", "a" * 4000, "  \n\n x  ", "日本語 " * 30, "🎉 <|endoftext|> don't 's 'S!", "ΑΣ ΑΣ Σ\x1c a\x85b", "e ́x́ ́", "word.. word., (word) a.b", "long " * 9000]
    return fixed + ["".join(rng.choice("abet \n'sñÉ1#A\tΣ́.,!") for _ in range(rng.randint(0, 90))) for _ in range(300)]


def reference(values):
    t = Tokenizer.from_file(public_tokenizers.path(token_files.TOKENIZER))
    return [e.ids + [2] for e in t.encode_batch([v or "" for v in values], add_special_tokens=False)]


def test_round_trip(spark):
    values = texts()
    rows = [(7 * ((i * 37) % len(values)) - 50, t, "clash") for i, t in enumerate(values)]
    got = token_files.round_trip(spark.createDataFrame(rows, SCHEMA)).collect()
    by_id = dict(zip([r[0] for r in rows], reference(values)))
    at, want = 0, {}
    for d in sorted(by_id):
        want[d] = (at, len(by_id[d]), zlib.crc32(np.array(by_id[d], "<u4").tobytes()))
        at += len(by_id[d])
    assert {r.doc_id: tuple(r)[1:] for r in got} == want and len(got) == len(rows)


def test_added_tokens_in_texts(spark):
    """Added tokens that a text spells out, by the library as it is."""
    rng = random.Random(9)
    a, b = "<|startoftext|>", "<|endoftext|>"
    values = ["hello <|endoftext|> world", a, b + b, f"{a}x{b}", f"{a} x {b}", "<|ENDOFTEXT|> é<|endoftext|>́x", f"ab{b}'s {b}!! a.{b}..", "<|endof", "text|> y", None, "", f"end{b}", f"{b}begin", "plain"]
    values += ["".join(rng.choice([a, b, "<|EndOfText|>", "<|", "|>", "a", "B c", " ", "\n", "'s", "!", "é", "́", "x."]) for _ in range(rng.randint(0, 30))) for _ in range(200)]
    t = Tokenizer.from_file(public_tokenizers.path(token_files.TOKENIZER))
    want = {i: e.ids + [2] for i, e in enumerate(t.encode_batch([v or "" for v in values], add_special_tokens=False))}
    assert want[0] == [3306, 49407, 1002, 2]
    got = sorted(token_files.round_trip(spark.createDataFrame([(i, v, "") for i, v in enumerate(values)], SCHEMA)).collect())
    starts = np.cumsum([0] + [len(x) for x in want.values()])
    assert [tuple(r) for r in got] == [(i, int(starts[i]), len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in want.items()]


def test_nulls_and_repeats(spark):
    rows = [(None, "b", ""), (None, "a a", ""), (1, "x", ""), (1, "x", ""), (0, None, "")]
    got = sorted(token_files.round_trip(spark.createDataFrame(rows, SCHEMA)).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, None, 0, 1, 1]
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1]]
    assert token_files.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


def thue_morse(n, swap=False):
    return "".join("xy"[(i.bit_count() + swap) % 2] for i in range(n))


def test_pieces_of_one_hash(spark, monkeypatch):
    """Pieces are told apart by their bytes, whatever their hashes."""
    values = [f"{thue_morse(1024)} {thue_morse(1024, True)}", "alike other alike Ähnlich", "other", "ähnlich"]
    t = Tokenizer.from_file(public_tokenizers.path(token_files.TOKENIZER))
    want = [e.ids + [2] for e in t.encode_batch(values, add_special_tokens=False)]
    got = token_files.round_trip(spark.createDataFrame([(i, v, "") for i, v in enumerate(values)], SCHEMA)).orderBy("doc_id").collect()
    assert [r.ids_crc32 for r in got] == [zlib.crc32(np.array(x, "<u4").tobytes()) for x in want]
    monkeypatch.setattr(token_files, "word_spans", lambda *a: (lambda h, *rest: (h % np.uint64(2), *rest))(*word_spans(*a)))
    with open(public_tokenizers.path(token_files.TOKENIZER), encoding="utf-8") as source:
        encoder = token_files.Encoder(source.read())
    for _ in range(2):
        ids, begins = encoder.encode(*text_buffer(pa.array(values)))
        assert [ids[a:b].tolist() for a, b in zip(begins[:-1], begins[1:])] == want


def test_store_paths():
    settings = {"endpoint": "http://store:9000", "access.key": "a", "secret.key": "b", "path.style.access": "true"}
    assert files.store_arguments(settings) == {"access_key": "a", "secret_key": "b", "endpoint_override": "store:9000", "scheme": "http", "force_virtual_addressing": False}
    assert files.store_arguments({}) == {}
    for uri in ("s3a://bucket/some/file", "s3://bucket/some/file"):
        system, place = files.locate(uri, settings)
        assert type(system).__name__ == "S3FileSystem" and place == "bucket/some/file"
    for uri in ("/tmp/x/y", "file:/tmp/x/y", "file:///tmp/x/y"):
        system, place = files.locate(uri)
        assert type(system).__name__ == "LocalFileSystem" and place == "/tmp/x/y"


def test_one_text_on_many_rows(spark):
    """Rows that repeat doc_id and text are dealt over several tasks."""
    rows = [(7, "the same words", "")] * 4000 + [(i, "x y", "") for i in range(7)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(8)
    manifest = token_files.write(df, work_dir(spark, "repeats"))
    assert manifest.select("part").distinct().count() > 4
    got = token_files.read(manifest).orderBy("start").collect()
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1]] and [r.doc_id for r in got] == sorted(r[0] for r in rows)


def test_small_files_give_the_same(spark, tmp_path):
    df = spark.createDataFrame([(i, t, "") for i, t in enumerate(texts())], SCHEMA)
    whole = sorted(map(tuple, token_files.read(token_files.write(df, str(tmp_path / "a"))).collect()))
    manifest = token_files.write(df, str(tmp_path / "b"), file_ids=1)
    assert sorted(map(tuple, token_files.read(manifest).collect())) == whole
    files_, docs = manifest.count(), manifest.groupBy().sum("n_docs").first()[0]
    assert files_ >= 8 and docs == len(texts())


def test_sequences_and_masks(tmp_path):
    ids = np.arange(2048 * 600 + 17, dtype=np.uint16)
    data = token_files.file_bytes(ids, pa.array([4, None]), np.array([1000, len(ids) - 1000]))
    path = files.write(str(tmp_path), "part", ".arrow", data)
    with pa.memory_map(path) as source:
        stored = token_files.TokenFile(source)
        assert len(stored) == 601 and stored.doc_ids.to_pylist() == [4, None]
        before = pa.total_allocated_bytes()
        got, mask = stored[599]
        assert pa.total_allocated_bytes() == before  # ids and mask are views of the mapped file
        assert (got == ids[599 * 2048 : 600 * 2048]).all() and all(mask.to_pylist()) and not got.flags.owndata
        got, mask = stored[600]
        assert sum(mask.to_pylist()) == 17 and (got[:17] == ids[-17:]).all() and not got[17:].any()
        assert (stored.ids() == ids).all()
