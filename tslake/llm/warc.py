"""Zstandard WARC archives: a writer of page records and a strict reader.

An archive starts with a skippable frame that holds the dictionary of all its
frames; every record is a frame of its own. The reader loads the dictionary,
finds each frame's end from its block headers, decodes one frame per record
and validates version, header fields, lengths, block end and payload digest;
any fault is an error that names file and offset.

Of records with equal payloads of ``REVISIT_BYTES`` or more, those with the
smallest page_id are responses and the others revisit them. Defined results:
null html is an empty payload; a null page_id or url writes no such field, and
a null page_id is never the smallest while another exists; repeated rows of the
smallest page_id are all responses; an empty table writes no archive.

Pages are matched to their group by a join against the digests that occur
twice or more; AQE splits a digest that holds many rows.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tslake.llm import files
from tslake.session import work_dir

REVISIT_BYTES = 100
#: Compressed bytes after which a task starts its next archive.
ARCHIVE_BYTES = 32 << 20
#: The sample the dictionary is fitted on: about so many pages (four times that at most), and characters of each.
SAMPLE_PAGES, SAMPLE_CHARS, DICTIONARY_BYTES = 256, 16384, 32768
LEVEL = 3
DICTIONARY_MAGIC, FRAME_MAGIC = 0x184D2A5D, 0xFD2FB528
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"

RECORDS = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"
MANIFEST = "path string, n_records long, n_bytes long"


# --------------------------------------------------------------------- records


def _field(value: str) -> str:
    return "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def record_id(run: uuid.UUID, page_id: int | None, digest: str) -> str:
    """The id of a page's record in one writing run, known from the page alone,
    so that a revisit can name the response without having seen it. Rows that
    repeat page and payload are one record written again."""
    return f"<{uuid.uuid5(run, f'{page_id} {digest}').urn}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, run: uuid.UUID, refers_to_url: str | None = None) -> bytes:
    """A WARC/1.1 record; one that refers to another carries no payload."""
    revisit = refers_to is not None
    block = b"" if revisit else HTTP % len(payload) + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(run, page_id, digest)), ("WARC-Date", "1970-01-01T00:00:00Z")]
    if url is not None:
        fields.append(("WARC-Target-URI", _field(url)))
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(run, refers_to, digest))]
        if refers_to_url is not None:
            fields.append(("WARC-Refers-To-Target-URI", _field(refers_to_url)))
        fields += [("WARC-Refers-To-Date", "1970-01-01T00:00:00Z"), ("X-Refers-To-Page-ID", str(refers_to))]
    fields += [
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("X-Payload-Length", str(len(payload))),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The validated fields of one record."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not found or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError("no WARC header")
    fields = {}
    for line in lines[1:]:
        key, colon, value = line.partition(":")
        if not colon or not key or key.lower() in fields:
            raise ValueError(f"malformed or repeated field {line!r}")
        fields[key.lower()] = value.strip()
    for key in ("warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest", "x-payload-length"):
        if key not in fields:
            raise ValueError(f"no {key}")
    length = int(fields["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"Content-Length {length}, but {len(rest) - 4} bytes stand")
    kind, size = fields["warc-type"], int(fields["x-payload-length"])
    algorithm, _, digest = fields["warc-payload-digest"].partition(":")
    if algorithm != "sha256" or len(digest) != 64:
        raise ValueError("no sha256 payload digest")
    payload = None
    if kind == "response":
        http, found, payload = rest[:length].partition(b"\r\n\r\n")
        if not found or not http.startswith(b"HTTP/"):
            raise ValueError("no HTTP header")
        stated = [int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
        if stated != [len(payload)] or size != len(payload):
            raise ValueError(f"payload of {len(payload)} bytes, {stated} and {size} stated")
        if hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError("payload digest differs")
    elif kind == "revisit":
        if fields.get("warc-profile") != PROFILE or "warc-refers-to" not in fields or "x-refers-to-page-id" not in fields or length:
            raise ValueError("malformed revisit")
    else:
        raise ValueError(f"unknown record type {kind!r}")
    number = lambda key: int(fields[key]) if key in fields else None
    return {
        "page_id": number("x-page-id"),
        "url": fields.get("warc-target-uri"),
        "payload": payload,
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": number("x-refers-to-page-id"),
    }


# --------------------------------------------------------------------- archives


def load_dictionary(data: bytes) -> zstandard.ZstdCompressionDict:
    return zstandard.ZstdCompressionDict(data)


def fit_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary for the records, or plain content where there is too little to fit one."""
    samples = [s for s in samples if s]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return (b"".join(samples)[-DICTIONARY_BYTES:] + HTTP + b"<!DOCTYPE html><html><head>").lstrip(b"\x37\xa4\x30\xec")


def dictionary_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary


def frame_end(data: memoryview, at: int) -> int:
    """Where the Zstandard frame that begins at ``at`` ends."""
    (magic,) = struct.unpack_from("<I", data, at)
    if magic != FRAME_MAGIC:
        raise ValueError(f"no frame, magic {magic:#x}")
    descriptor = data[at + 4]
    single = descriptor >> 5 & 1
    end = at + 5 + (not single) + (0, 1, 2, 4)[descriptor & 3] + ((1 if single else 0), 2, 4, 8)[descriptor >> 6]
    while True:
        head = int.from_bytes(data[end : end + 3], "little")
        if end + 3 > len(data):
            raise ValueError("frame is cut off")
        end += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
        if head & 1:
            break
    end += 4 * (descriptor >> 2 & 1)
    if end > len(data):
        raise ValueError("frame is cut off")
    return end


def read_archive(data: bytes, path: str = "") -> Iterator[dict]:
    """The records of one archive, a frame each."""
    view = memoryview(data)
    magic, size = struct.unpack_from("<II", view, 0)
    if magic != DICTIONARY_MAGIC or 8 + size > len(view):
        raise ValueError(f"{path}: no dictionary frame")
    dictionary = bytes(view[8 : 8 + size])
    if dictionary[:4] == struct.pack("<I", FRAME_MAGIC):  # a dictionary may be compressed itself
        dictionary = zstandard.ZstdDecompressor().decompress(dictionary)
    reader = zstandard.ZstdDecompressor(dict_data=load_dictionary(dictionary))
    at = 8 + size
    while at < len(view):
        if view[at + 1 : at + 4] == b"\x2a\x4d\x18" and view[at] >> 4 == 5:  # other skippable frames
            at += 8 + struct.unpack_from("<I", view, at + 4)[0]
            continue
        try:
            end = frame_end(view, at)
            yield parse(reader.decompress(view[at:end]))
        except (ValueError, zstandard.ZstdError, struct.error) as e:
            raise ValueError(f"{path}: record at byte {at}: {e}") from e
        at = end


# ------------------------------------------------------------------------ Spark


def matched(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest and, for revisits, the response's page_id."""
    spark = pages.sparkSession
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload")).withColumn("digest", F.sha2("payload", 256))
    groups = (
        rows.filter(F.octet_length("payload") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))).alias("of"), F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("digest", "first", F.col("of.url").alias("first_url"))
    )
    # settled first: Spark then knows its size and shuffles the pages only if it must
    rows = rows.join(files.settled(spark, groups, "warc-groups"), "digest", "left")
    again = ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.select("page_id", "url", "payload", "digest", F.when(again, F.col("first")).alias("refers_to"), F.when(again, F.col("first_url")).alias("refers_to_url"))


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Write the pages' archives to ``folder``; returns their manifest (written
    once, beside them)."""
    spark = pages.sparkSession
    share = min(1.0, SAMPLE_PAGES / max(1, pages.count()))
    sample = (
        pages.filter(F.col("html").isNotNull() & (F.pmod(F.xxhash64("page_id", "html"), F.lit(1 << 30)) < share * (1 << 30)))
        .select(F.substring("html", 1, SAMPLE_CHARS).alias("html"))
        .limit(4 * SAMPLE_PAGES)  # repeated rows may be chosen together
        .collect()
    )
    dictionary = fit_dictionary([r["html"].encode() for r in sample])
    run_id, settings = uuid.uuid4(), files.store_settings(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = zstandard.ZstdCompressor(level=LEVEL, dict_data=load_dictionary(dictionary))
        part, k, frames, size = TaskContext.get().partitionId(), 0, [], 0

        def archive() -> pa.RecordBatch:
            path = files.write(folder, f"part-{part:05d}-{k:04d}", ".warc.zst", b"".join([dictionary_frame(dictionary), *frames]), settings)
            return pa.RecordBatch.from_pydict({"path": [path], "n_records": [len(frames)], "n_bytes": [size]})

        for batch in batches:
            for i, row in enumerate(zip(*(c for c in batch.columns))):
                page_id, url, payload, digest, refers_to, refers_to_url = (x.as_py() for x in row)
                frames.append(writer.compress(record(page_id, url, payload, digest, refers_to, run_id, refers_to_url)))
                size += len(frames[-1])
                if size >= ARCHIVE_BYTES:
                    yield archive()
                    k, frames, size = k + 1, [], 0
        if frames:
            yield archive()

    return files.settled(spark, matched(pages).mapInArrow(run, MANIFEST), "warc-manifest")


def read(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the archives a manifest lists, validated."""
    spark = manifest.sparkSession
    settings = files.store_settings(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with files.open_input(path, settings) as source:
                    data = source.read()
                rows, size = [], 0
                for row in read_archive(data, path):
                    rows.append(row if payloads else row | {"payload": None})
                    size += len(rows[-1]["payload"] or b"") + 200
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return files.spread(spark, manifest.select("path")).mapInArrow(run, RECORDS)


def round_trip(pages: DataFrame) -> DataFrame:
    """Per page what reading its written record back gives."""
    manifest = write(pages, work_dir(pages.sparkSession, "warc"))
    return read(manifest, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
q AS (SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, sha256(payload) AS payload_digest,
        CASE WHEN strlen(payload) >= {REVISIT_BYTES} THEN min(page_id) OVER (PARTITION BY payload) END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM q
"""
