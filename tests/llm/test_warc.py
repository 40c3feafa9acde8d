import os
import uuid

import pyarrow as pa
import pytest
from helpers import same_rows

from tslake.llm import warc

LONG = "<p>é" + "x" * 200 + "</p>"
ROWS = [
    (5, "http://a", LONG, 1),
    (3, "http://b", LONG, 2),
    (3, "http://b", LONG, 2),
    (9, None, LONG, 3),
    (None, "http://null", LONG, 4),
    (7, "http://short", "tiny", 5),
    (8, "http://short", "tiny", 5),
    (1, "http://none", None, 6),
    (2, "http://empty", "", 7),
    (None, "two\r\nlines: x", "y" * 100, 8),
    (None, "", "y" * 100, 8),
    (11, "http://long", "\r\n\r\nWARC/1.1\r\n" * 40000, 9),
    (12, "http://x", "z" * 99, 10),
    (13, "http://x", "z" * 99, 10),
]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest int")


def test_round_trip_against_sql(spark):
    arrow = pa.table({"page_id": pa.array([r[0] for r in ROWS], pa.int64()), "html": pa.array([r[2] for r in ROWS], pa.string())})
    same_rows(warc.round_trip(frame(spark)), warc.SQL, pages=arrow)
    assert warc.round_trip(frame(spark, [])).count() == 0


def test_payloads_and_urls_come_back(spark, tmp_path):
    manifest = warc.write(frame(spark), str(tmp_path / "w"))
    got = [r for r in warc.read(manifest).collect()]
    assert len(got) == len(ROWS)
    responses = {r.page_id: bytes(r.payload).decode() for r in got if r.record_type == "response" and r.page_id}
    assert responses == {p: h or "" for p, _, h, _ in ROWS if p in (3, 7, 8, 1, 2, 11, 12, 13)}
    assert {r.url for r in got if r.page_id is None} == {"http://null", "two%0D%0Alines: x", ""}


def test_unlisted_files_are_not_read(spark, tmp_path):
    manifest = warc.write(frame(spark), str(tmp_path / "w"))
    (tmp_path / "w" / "part-00000-0000-lost.warc.zst").write_bytes(b"left by a lost attempt")
    assert warc.read(manifest).count() == len(ROWS)


def archive(payload=b"payload " * 40):
    import hashlib

    import zstandard

    d = warc.fit_dictionary([])
    w = zstandard.ZstdCompressor(dict_data=warc.load_dictionary(d))
    one = warc.record(1, "u", payload, hashlib.sha256(payload).hexdigest(), None, uuid.UUID(int=1))
    return d, w, one


def test_validation():
    d, w, one = archive()
    head = warc.dictionary_frame(d)
    good = head + w.compress(one) + w.compress(one)
    assert [r["page_id"] for r in warc.read_archive(good)] == [1, 1]
    skippable = b"\x50\x2a\x4d\x18\x03\x00\x00\x00abc"
    assert len(list(warc.read_archive(head + skippable + w.compress(one) + skippable))) == 1
    for bad in (
        good[len(head) :],
        good[:-3],
        head + b"junk" + good[len(head) :],
        head + w.compress(one.replace(b"Content-Length: 4", b"Content-Length: 5")),
        head + w.compress(one.replace(b"payload payload", b"payload Payload")),
        head + w.compress(one.replace(b"WARC/1.1", b"WARK/1.1")),
        head + w.compress(one.replace(b"WARC-Date", b"X-Date")),
        head + w.compress(one.replace(b"WARC-Type: response", b"WARC-Type: resource")),
    ):
        with pytest.raises(ValueError):
            list(warc.read_archive(bad))


def test_frames_of_any_shape_end_where_they_end():
    import zstandard

    for size in (0, 1, 255, 256, 70000, 400000):
        for checksum in (False, True):
            for known in (False, True):
                data = os.urandom(size // 2) + b"a" * (size - size // 2)
                f = zstandard.ZstdCompressor(write_checksum=checksum, write_content_size=known).compress(data)
                assert warc.frame_end(memoryview(f + b"tail"), 0) == len(f)


def test_revisits_name_their_response(spark, tmp_path):
    """Ids and target of a revisit are those of the response's own record, and no two runs share one."""
    def heads(folder):
        manifest = warc.write(spark.createDataFrame(ROWS, "page_id long, url string, html string, digest int"), str(folder))
        out = []
        for row in manifest.collect():
            with open(row.path, "rb") as f:
                out += list(records(f.read()))
        return out

    def records(data):
        import zstandard

        size = int.from_bytes(data[4:8], "little")
        reader = zstandard.ZstdDecompressor(dict_data=warc.load_dictionary(data[8 : 8 + size]))
        at = 8 + size
        while at < len(data):
            end = warc.frame_end(memoryview(data), at)
            head = reader.decompress(data[at:end]).partition(b"\r\n\r\n")[0].decode()
            yield dict(line.split(": ", 1) for line in head.split("\r\n")[1:])
            at = end

    first, second = heads(tmp_path / "a"), heads(tmp_path / "b")
    ids = {r["X-Page-ID"]: r for r in first if r["WARC-Type"] == "response" and "X-Page-ID" in r}
    again = [r for r in first if r["WARC-Type"] == "revisit"]
    assert len(again) == 3
    for r in again:
        assert r["WARC-Refers-To"] == ids["3"]["WARC-Record-ID"] and r["WARC-Refers-To-Target-URI"] == "http://b"
    assert not {r["WARC-Record-ID"] for r in first} & {r["WARC-Record-ID"] for r in second}
