"""WARC archives: records compressed one by one with a dictionary that the archive itself carries.

An archive file starts with a skippable frame (magic 0x184D2A5D) that holds a Zstandard dictionary trained from some of
the file's own records. Each record follows as a frame of its own, so any record can be read alone. Of records with equal
payloads, known by SHA-256, that with the largest page_id is a response; others are revisits that name it.

Files go to the folder that driver and executors share, under names of their own for each attempt. Only files that a
committed manifest lists are read, so an attempt that is lost leaves nothing in the result.
"""

from __future__ import annotations

import base64
import contextlib
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.session import shared_dir, ship, table

SKIPPABLE, FRAME = b"\x5d\x2a\x4d\x18", b"\x28\xb5\x2f\xfd"
#: Raw bytes of a file, bytes of its dictionary, and bytes of records that the dictionary is trained from.
FILE_BYTES, DICTIONARY_BYTES, SAMPLE_BYTES, LEVEL = 24 << 20, 48 << 10, 2 << 20, 3
#: Bytes of a record that are learnt from at most, and of one piece of it where records are few.
LEARN_BYTES, PIECE_BYTES = 64 << 10, 4 << 10
#: A payload that more than 1/HOT of all repeated pages share is joined without a shuffle by payload.
HOT = 1000
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
MANIFEST = "path string, records long"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, intact boolean"


def sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record. A revisit keeps the response's HTTP header, with the payload's length, and leaves the payload out."""
    block = (HTTP % len(payload)).encode() + (payload if kind == "response" else b"")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {urn(page_id)}", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in url))
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {urn(refers_to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """Trained from the starts of records spread over the file; their plain bytes where they are too few or too alike to train from."""
    total, step = sum(min(len(r), LEARN_BYTES) for r in records), 1
    while total / step > SAMPLE_BYTES and step < len(records):
        step += 1
    some = [r[:LEARN_BYTES] for r in records[::step]]  # only what the dictionary learns from; records are written whole
    if len(some) < 16:  # few but large records are learnt from in pieces
        some = [r[i : i + PIECE_BYTES] for r in some for i in range(0, len(r), PIECE_BYTES)]
    if len(some) >= 16:
        with contextlib.suppress(zstandard.ZstdError):  # raised where samples are too alike
            return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(1024, sum(map(len, some)) // 8)), some, k=512, d=8)
    raw = b"".join(some)[:DICTIONARY_BYTES]
    return zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(raw) >= 8 else None


def archive(records: list[bytes]) -> bytes:
    learnt = dictionary(records)
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=learnt, write_content_size=True, write_checksum=True)
    body = learnt.as_bytes() if learnt else b""
    return b"".join([SKIPPABLE, len(body).to_bytes(4, "little"), body, *map(packer.compress, records)])


def frame_end(data: bytes, at: int) -> int:
    """Where the frame at this place ends, by its blocks' headers."""
    head = memoryview(data)[at : at + 18]
    end = at + zstandard.frame_header_size(head)
    checksum = zstandard.get_frame_parameters(head).has_checksum
    while True:
        b = int.from_bytes(data[end : end + 3], "little")
        end += 3 + (1 if b >> 1 & 3 == 1 else b >> 3)
        if b & 1:
            return end + 4 * checksum


def records_of(data: bytes) -> Iterator[tuple]:
    """The records of an archive file, as RECORDS."""
    if data[:4] != SKIPPABLE:
        raise ValueError("no dictionary frame at the start of the archive")
    at = 8 + int.from_bytes(data[4:8], "little")
    body = data[8:at]
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(body) if body else None)
    view = memoryview(data)
    while at < len(data):
        end = frame_end(data, at)
        raw = reader.decompress(view[at:end])
        at = end
        head, _, rest = raw.partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        block = rest[: int(fields["Content-Length"])]
        http, _, payload = block.partition(b"\r\n\r\n")
        n = int(http.rpartition(b": ")[2])
        digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
        number = lambda x: int(x[10:-1]) if len(x) > 11 else None
        intact = kind == "revisit" or (len(payload) == n and sha1(payload) == digest)
        yield number(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), n, digest, kind, number(fields["WARC-Refers-To"]) if kind == "revisit" else None, intact


def write_files(folder: str):
    def write(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        held, size, done = [], 0, []

        def flush() -> None:
            nonlocal held, size
            name = f"{base}/{uuid.uuid4().hex}.warc.zst"
            with store.open_output_stream(name) as out:
                out.write(archive(held))
            done.append((name.removeprefix(base + "/"), len(held)))
            held, size = [], 0

        for t in tables:
            for page_id, url, html, last, flagged in zip(t["page_id"].to_pylist(), t["url"].to_pylist(), t["html"].cast(pa.binary()), t["last"].to_pylist(), t["revisit"].to_pylist(), strict=True):
                payload = html.as_buffer().to_pybytes() if html.is_valid else b""
                held.append(record(page_id, url, payload, sha1(payload), "revisit" if flagged else "response", last))
                size += len(held[-1])
                if size >= FILE_BYTES:
                    flush()
        if held:
            flush()
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())], ["path", "records"])

    return write


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Write pages (page_id, url, html) as archives into folder, a URI that executors can write to. Returns the manifest (path, records).

    Payloads of at least min_bytes that are equal: rows with the largest page_id are responses, others revisits. Null
    html is an empty payload, null page_id is smaller than any, other columns are left out; no page: no file.
    """
    ship(pages.sparkSession)
    pages = pages.select("page_id", "url", "html")
    keyed = pages.withColumn("hex", F.sha2(F.coalesce("html", F.lit("")).cast("binary"), 256))
    last = keyed.groupBy("hex").agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1")
    last = table(last, "payloads")
    total = last.agg(F.sum("n")).first()[0] or 0
    often = F.col("n") * HOT > total
    hot = last.where(often).select("hex", F.struct("last").alias("hot"))  # fewer than HOT rows
    # pages of a payload that many pages have are spread by their own ids and urls, so no task gets them all
    spread = F.when(F.col("hot").isNull(), F.col("hex")).otherwise(F.concat_ws(":", "hex", F.col("page_id").cast("string"), "url"))
    rows = keyed.join(F.broadcast(hot), "hex", "left").withColumn("key", spread)
    cold = last.where(~often).select(F.col("hex").alias("key"), F.struct("last").alias("cold"))
    rows = rows.join(cold, "key", "left").withColumn("found", F.coalesce("hot", "cold"))
    rows = rows.withColumns({"last": F.col("found.last"), "shared": F.col("found").isNotNull()})
    big = F.coalesce(F.octet_length("html"), F.lit(0)) >= min_bytes
    rows = rows.select("page_id", "url", "html", "last", (big & F.col("shared") & ~F.col("page_id").eqNullSafe(F.col("last"))).alias("revisit"))
    return table(rows.mapInArrow(write_files(folder), MANIFEST), "manifest")


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """The records of all archives that the manifest lists."""
    ship(manifest.sparkSession)
    n = manifest.count()

    def load(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        for t in tables:
            for name in t["path"].to_pylist():
                with store.open_input_stream(f"{base}/{name}") as f:
                    columns = list(zip(*records_of(f.read()), strict=True))
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [x.split()[0] for x in RECORDS.split(", ")])

    return manifest.select("path").repartition(max(1, n)).mapInArrow(load, RECORDS)


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write all pages, read the archives back: one row a record."""
    folder = f"{shared_dir(pages.sparkSession)}/corvane/warc-{uuid.uuid4().hex}"
    return read_archives(write_archives(pages, folder), folder)
