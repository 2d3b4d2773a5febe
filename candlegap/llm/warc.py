"""Operator 4: WARC archives of pages, read back by segment reassembly.

Writing: one record per page. Its payload (the html in UTF-8) goes out as an HTTP response
with chunked transfer framing; a block longer than ``segment_bytes`` is cut into a first
segment and continuation records. Of pages with equal payloads the largest ``page_id`` is
the response and the others are revisit records without payload. Every record is its own
gzip member, in one file per task, named by attempt; only files of successful attempts are
in the list of files that is read.

Reading: records are parsed from the files as streams. Segments are grouped by the record
id of their origin, ordered by segment number, checked for gaps and against the total
length that the last one states, joined, cleared of chunk framing and checked against the
payload digest. A damaged record raises.

Defined results: a NULL html is an empty payload; rows that repeat a page (same id and
payload) give one record each, all of them responses where that is the largest ``page_id`` with the
payload; a page without ``page_id`` revisits the others with its payload, and is a response
where none of them has one; a NULL url has no target
header; an empty table gives no files and no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from candlegap.llm.common import read_table, scratch_dir, shared_filesystem, sliced, spread, written

#: Blocks above this size are cut; the longest pages of the given tables make several segments.
SEGMENT_BYTES = 16 * 1024
CHUNK_BYTES = 8 * 1024
#: Payloads below this size are always responses.
MIN_REVISIT_BYTES = 0
RECORD_DATE = "2024-01-01T00:00:00Z"
PARSED = ("record_id string, page_id long, record_type string, refers_to long, payload_bytes long, "
          "payload_digest string, segment int, total_length long, block binary")
RESULT = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = []
    for at in range(0, len(payload), size):
        piece = payload[at:at + size]
        parts += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes:
    parts, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if size == 0:
            return b"".join(parts)
        if body[end + 2 + size:end + 4 + size] != b"\r\n":
            raise ValueError("chunk without its end")
        parts.append(body[end + 2:end + 2 + size])
        at = end + 4 + size


def http_payload(block: bytes) -> bytes:
    """Payload of an HTTP response block, without chunk framing."""
    head, _, body = block.partition(b"\r\n\r\n")
    return dechunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def record_name(page_id: int | None, digest: str) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}:{digest}>"


def page_of(record_id: str | None) -> int | None:
    value = record_id.split(":")[2] if record_id else "null"
    return None if value == "null" else int(value)


def _record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers if v is not None), f"Content-Length: {len(block)}", "", ""]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode("utf-8") + block + b"\r\n\r\n") + packer.flush()


def records_of(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None,
               segment_bytes: int = SEGMENT_BYTES) -> Iterator[bytes]:
    """The gzip members of one page."""
    digest = payload_digest(payload)
    name = record_name(page_id, digest)
    target = None if url is None else "".join(c if " " < c < "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)
    about = [("WARC-Date", RECORD_DATE), ("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha1:{digest}"),
             ("WARC-Payload-Length", len(payload))]
    if refers_to is not None:
        yield _record([("WARC-Type", "revisit"), ("WARC-Record-ID", name), *about,
                       ("WARC-Refers-To", record_name(refers_to, digest)),
                       ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")], b"")
        return
    block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
             + chunked(payload))
    first = [("WARC-Type", "response"), ("WARC-Record-ID", name), *about,
             ("Content-Type", "application/http; msgtype=response")]
    if len(block) <= segment_bytes:
        yield _record(first, block)
        return
    pieces = [block[at:at + segment_bytes] for at in range(0, len(block), segment_bytes)]
    yield _record([*first, ("WARC-Segment-Number", 1)], pieces[0])
    for k, piece in enumerate(pieces[1:], 2):
        yield _record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"{name[:-1]}:{k}>"),
                       ("WARC-Date", RECORD_DATE), ("WARC-Segment-Origin-ID", name), ("WARC-Segment-Number", k),
                       ("WARC-Segment-Total-Length", len(block) if k == len(pieces) else None)], piece)


def parse_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of a gzip stream, read a megabyte at a time."""
    unpack, held, size = zlib.decompressobj(31), bytearray(), stream.size()

    def fill() -> None:
        nonlocal unpack
        raw = stream.read(1 << 20)
        while raw:
            held.extend(unpack.decompress(raw))
            raw = unpack.unused_data
            if unpack.eof:
                unpack = zlib.decompressobj(31)

    while True:
        while (end := held.find(b"\r\n\r\n")) < 0 and stream.tell() < size:
            fill()
        if end < 0:
            if held.strip():
                raise ValueError("archive ends inside a record")
            return
        lines = held[:end].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a record: {lines[0][:40]!r}")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        stop = end + 4 + int(headers["Content-Length"])
        while len(held) < stop + 4 and stream.tell() < size:
            fill()
        if held[stop:stop + 4] != b"\r\n\r\n":
            raise ValueError("record without its end")
        block = bytes(held[end + 4:stop])
        del held[:stop + 4]
        yield headers, block


def write_archives(pages: DataFrame, folder: str, min_revisit_bytes: int = MIN_REVISIT_BYTES,
                   segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Writes the archives; returns the list of files (a written table)."""
    html = F.coalesce(F.col("html"), F.lit(""))
    known = pages.select("page_id", "url", html.alias("html"), F.sha1(html.cast("binary")).alias("sha"))
    # one row per payload that several rows have; map-side combined, so a hot payload is cheap
    shared = (known.where(F.octet_length("html") >= min_revisit_bytes).groupBy("sha")
              .agg(F.max("page_id").alias("origin"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, n = None, 0
        for cols in sliced(batches):
            if out is None:
                fs, inner = shared_filesystem(folder)
                fs.create_dir(inner, recursive=True)
                file = f"pages-{uuid.uuid4().hex}.warc.gz"
                out = fs.open_output_stream(f"{inner}/{file}", compression=None)  # members are packed already
            for page_id, url, text, origin in zip(cols["page_id"], cols["url"], cols["html"], cols["origin"], strict=True):
                for member in records_of(page_id, url, text.encode("utf-8"), origin, segment_bytes):
                    out.write(member)
                n += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"file": pa.array([file]), "pages": pa.array([n], pa.int64())})

    refers = F.when(~F.col("page_id").eqNullSafe(F.col("origin")), F.col("origin")).alias("origin")
    rows = known.join(shared, "sha", "left").select("page_id", "url", "html", refers)
    return written(rows.mapInArrow(run, "file string, pages long"), "warc-files")


def read_archives(files: DataFrame, folder: str) -> DataFrame:
    """One row per page record of the archives, segments reassembled and checked."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("record_id", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()),
                            ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                            ("segment", pa.int32()), ("total_length", pa.int64()), ("block", pa.binary())])
        for cols in sliced(batches):
            for file in cols["file"]:
                fs, inner = shared_filesystem(folder)
                rows, held = [], 0
                with fs.open_input_file(f"{inner}/{file}") as stream:
                    for h, block in parse_records(stream):
                        kind, segment = h["WARC-Type"], h.get("WARC-Segment-Number")
                        page = page_of(h["WARC-Record-ID"])
                        if segment is not None:
                            total = h.get("WARC-Segment-Total-Length")
                            rows.append({"record_id": h.get("WARC-Segment-Origin-ID", h["WARC-Record-ID"]),
                                         "page_id": page, "record_type": kind, "segment": int(segment),
                                         "total_length": None if total is None else int(total), "block": block,
                                         "payload_bytes": int(h["WARC-Payload-Length"]) if kind == "response" else None,
                                         "payload_digest": h["WARC-Payload-Digest"][5:] if kind == "response" else None})
                            held += len(block)
                        else:
                            digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
                            n = int(h["WARC-Payload-Length"])
                            if kind == "response":
                                payload = http_payload(block)
                                if payload_digest(payload) != digest or len(payload) != n:
                                    raise ValueError(f"payload of {h['WARC-Record-ID']} does not match its digest")
                            rows.append({"record_id": h["WARC-Record-ID"], "page_id": page, "record_type": kind,
                                         "refers_to": page_of(h.get("WARC-Refers-To")), "payload_bytes": n,
                                         "payload_digest": digest})
                        if len(rows) >= 4096 or held >= 1 << 23:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols in sliced(batches, 64):
            for name, n, digest, segments in zip(cols["record_id"], cols["payload_bytes"], cols["payload_digest"],
                                                 cols["segments"], strict=True):
                if not segments:
                    continue
                segments = sorted(segments, key=lambda s: s["segment"])
                block = b"".join(s["block"] for s in segments)
                if [s["segment"] for s in segments] != list(range(1, len(segments) + 1)) or \
                        segments[-1]["total_length"] != len(block):
                    raise ValueError(f"segments of {name} are not whole")
                payload = http_payload(block)
                if payload_digest(payload) != digest or len(payload) != n:
                    raise ValueError(f"payload of {name} does not match its digest")
            yield pa.RecordBatch.from_pydict({
                "page_id": pa.array(cols["page_id"], pa.int64()), "payload_bytes": pa.array(cols["payload_bytes"], pa.int64()),
                "payload_digest": pa.array(cols["payload_digest"], pa.string()),
                "record_type": pa.array(cols["record_type"], pa.string()),
                "refers_to": pa.array(cols["refers_to"], pa.int64()), "copies": pa.array(cols["copies"], pa.int64())})

    parsed = spread(files, "file").mapInArrow(parse, PARSED)
    is_first = F.col("record_type") != "continuation"
    # the segments of one record; rows that repeat a page repeat its segments, the set holds each once
    whole = (parsed.groupBy("record_id").agg(
        F.max("page_id").alias("page_id"), F.max(F.when(is_first, F.col("record_type"))).alias("record_type"),
        F.max("refers_to").alias("refers_to"), F.max("payload_bytes").alias("payload_bytes"),
        F.max("payload_digest").alias("payload_digest"), F.count_if(is_first).alias("copies"),
        F.collect_set(F.when(F.col("segment").isNotNull(), F.struct("segment", "total_length", "block"))).alias("segments")))
    return (whole.mapInArrow(join, RESULT + ", copies long")
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copies", "copy"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "warc")
    return read_archives(write_archives(read_table(spark, sf_dir, "pages", "page_id", "url", "html"), folder), folder)
