"""Zstandard WARC archives of pages: writing, and reading with all checks.

An archive begins with a skippable frame (magic number 0x184D2A5D) that holds the dictionary, and
each record is one Zstandard frame after it. Of records with equal payloads the one with the
smallest page_id is a response with its payload; the others are revisits, which refer to it and
hold the HTTP headers alone.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditflow.llm.scratch import Scratch, narrow, open_folder

#: Fixed values of the formats.
DICTIONARY_MAGIC, ZSTD_MAGIC = 0x184D2A5D, b"\x28\xb5\x2f\xfd"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A dictionary of this size is trained on about so many pages.
DICTIONARY_BYTES, SAMPLE_PAGES = 64 << 10, 400
#: A task begins a new archive beyond this size.
FILE_BYTES = 128 << 20
LEVEL = 6
_CHUNK = 1 << 20
_MANIFEST = pa.schema([("path", pa.string()), ("records", pa.int64())])
_OUT = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
_OUT_DDL = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; the samples themselves where they are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def _urn(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def _escaped(url: str) -> str:
    """The URL with control characters, blanks and characters beyond ASCII percent-encoded."""
    return "".join(c if "!" <= c <= "~" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_urn(page_id)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url:
        head.append(f"WARC-Target-URI: {_escaped(url)}")
    if revisit:
        head += [f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(lines: bytes, what: str) -> dict[str, str]:
    out = {}
    for line in lines.decode("utf-8").split("\r\n"):
        name, colon, value = line.partition(":")
        if not colon or not name.strip() or name.lower() in out:
            raise ValueError(f"{what}: bad header {line!r}")
        out[name.lower()] = value.strip()
    return out


def _page(urn: str) -> int | None:
    found = re.fullmatch(r"<urn:x-page:(-?\d+|none)>", urn)
    if not found:
        raise ValueError(f"bad record id {urn!r}")
    return None if found[1] == "none" else int(found[1])


def parse(data: bytes) -> dict:
    """The parts of one record; raises if headers, lengths or digests are wrong."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    version, _, lines = head.partition(b"\r\n")
    if not gap or version not in (b"WARC/1.0", b"WARC/1.1"):
        raise ValueError("no WARC record")
    warc = _headers(lines, "WARC")
    if missing := {"warc-type", "warc-record-id", "warc-date", "content-length"} - warc.keys():
        raise ValueError(f"missing headers: {sorted(missing)}")
    size = int(warc["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError("Content-Length differs from the block")
    http, gap, payload = rest[:size].partition(b"\r\n\r\n")
    status, _, lines = http.partition(b"\r\n")
    if not gap or not status.startswith(b"HTTP/"):
        raise ValueError("no HTTP headers")
    length = int(_headers(lines, "HTTP")["content-length"])
    kind, digest = warc["warc-type"], warc.get("warc-payload-digest", "").removeprefix("sha1:")
    if not re.fullmatch(r"[A-Z2-7]{32}", digest):
        raise ValueError("bad payload digest")
    if kind == "response":
        if len(payload) != length or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError("payload differs from its length or digest")
    elif kind != "revisit" or payload or warc.get("warc-profile") != REVISIT_PROFILE or "warc-refers-to" not in warc:
        raise ValueError(f"bad {kind} record")
    return {
        "page_id": _page(warc["warc-record-id"]), "url": warc.get("warc-target-uri"), "payload": payload, "payload_bytes": length,
        "payload_digest": digest, "record_type": kind, "refers_to": _page(warc["warc-refers-to"]) if kind == "revisit" else None,
    }


def write_archive(folder: str, dictionary, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Write the rows of a task; a manifest row per archive. File names hold the attempt."""
    fs, root = open_folder(folder)
    task, known = TaskContext.get(), dictionary.value
    trained = zstandard.ZstdCompressionDict(known) if known else None
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained)
    done, out = [], None
    for batch in batches:
        columns = [batch.column(c) for c in ("page_id", "url", "html", "first")]
        for page_id, url, html, first in zip(*columns):
            if out is None:
                path = f"{root}/pages-{task.partitionId():06d}-{len(done):04d}-{task.taskAttemptId()}.warc.zst"
                out, size, records = fs.open_output_stream(path, compression=None), 0, 0
                if known:
                    out.write(struct.pack("<II", DICTIONARY_MAGIC, len(known)) + known)
            page_id, first = page_id.as_py(), first.as_py()
            revisit = first is not None and first != page_id
            frame = packer.compress(record(page_id, url.as_py(), (html.as_py() or "").encode(), first, revisit))
            out.write(frame)
            size, records = size + len(frame), records + 1
            if size >= FILE_BYTES:
                out.close()
                done.append((path, records))
                out = None
    if out is not None:
        out.close()
        done.append((path, records))
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*done), _MANIFEST)], schema=_MANIFEST)


def frames(stream) -> Iterator[bytes]:
    """The records of an archive, one per frame; memory holds one record and one chunk."""
    data = stream.read(8)
    trained = None
    if len(data) == 8 and struct.unpack("<I", data[:4])[0] == DICTIONARY_MAGIC:
        size = struct.unpack("<I", data[4:])[0]
        held = stream.read(size)
        if len(held) != size:
            raise ValueError("the dictionary frame is cut off")
        # The frame may hold the dictionary itself compressed.
        trained = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(held) if held[:4] == ZSTD_MAGIC else held)
        data = b""
    opener = zstandard.ZstdDecompressor(dict_data=trained)
    while data or (data := stream.read(_CHUNK)):
        frame, parts = opener.decompressobj(), []
        while not frame.eof:
            if not data and not (data := stream.read(_CHUNK)):
                raise ValueError("a record's frame is cut off")
            parts.append(frame.decompress(data))
            data = frame.unused_data if frame.eof else b""
        yield b"".join(parts)


def read_archive(folder: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Page, payload measures, type and reference of each record of the manifest's archives."""
    fs, _ = open_folder(folder)
    for batch in batches:
        for row in batch.to_pylist():
            out, n = [], 0
            with fs.open_input_stream(row["path"], compression=None) as stream:
                for data in frames(stream):
                    found = parse(data)
                    out.append(tuple(found[c] for c in _OUT.names))
                    n += 1
                    if len(out) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), _OUT)], schema=_OUT)
                        out = []
            if n != row["records"]:
                raise ValueError(f"{row['path']} holds {n} of {row['records']} records")
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), _OUT)], schema=_OUT)


def write(pages: DataFrame, scratch: Scratch, least_bytes: int = 0) -> DataFrame:
    """Write all pages as archives; the manifest."""
    html = F.coalesce("html", F.lit(""))
    keyed = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", "html", F.sha1(html.cast("binary")).alias("sha"), F.octet_length(html).alias("n")
    )
    # Pre-aggregated per task, so a payload that a third of the pages share is a few rows.
    firsts = keyed.where(F.col("n") >= least_bytes).groupBy("sha", "n").agg(F.min("page_id").alias("first"))
    firsts = scratch.table(firsts, "firsts")
    number = max(1, pages.count())
    share = min(1.0, SAMPLE_PAGES / number)
    samples = [r["html"].encode() for r in keyed.select("html").where((F.rand(7) < share) & F.col("html").isNotNull()).collect()]
    known = pages.sparkSession.sparkContext.broadcast(dictionary(samples) if samples else b"")
    rows = keyed.join(firsts, ["sha", "n"], "left").select("page_id", "url", "html", "first")
    return scratch.table(rows.mapInArrow(narrow(write_archive, f"{scratch.root}/archives", known), "path string, records long"), "manifest")


def read(files: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per record of the manifest's archives."""
    return files.repartition(max(1, files.count())).mapInArrow(narrow(read_archive, f"{scratch.root}/archives"), _OUT_DDL)


def round_trip(pages: DataFrame, scratch: Scratch, least_bytes: int = 0) -> DataFrame:
    """Write all pages as archives and read them back.

    Returns ``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` for each page; a
    null html is the empty payload. Payloads below ``least_bytes`` are all responses. Rows that
    repeat the smallest page_id of a payload are each a response; a null page_id is a revisit of
    the smallest one, or a response if there is none. No pages give no archives and no rows.
    Other columns are ignored.
    """
    return read(write(pages, scratch, least_bytes), scratch)
