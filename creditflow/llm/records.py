"""Token sequences as length-delimited binary records with a separate offset index.

A data file is a run of records. A record is the payload's length (unsigned 64 bit), the masked
checksum of these eight bytes (32 bit), the payload and its masked checksum; all little-endian.
The checksum is CRC-32, masked by a rotation and an addition so that checksums of data that holds
checksums stay good. A payload is the width of an id in bytes (1 byte), whether there is a
doc_id (1 byte), the doc_id (8 bytes) and the ids, two bytes each where the vocabulary allows. The
index file beside it holds offset and length of each record, 8 bytes each, so that a reader can
fetch records in any order.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditflow.llm import tokens
from creditflow.llm.scratch import Scratch, narrow, open_folder

#: A task begins a new file beyond this size.
FILE_BYTES = 128 << 20
_HEAD = struct.Struct("<BBq")
_MANIFEST = pa.schema([("part", pa.int64()), ("seq", pa.int64()), ("path", pa.string()), ("records", pa.int64()), ("ids", pa.int64()), ("bytes", pa.int64())])
_MANIFEST_DDL = "part long, seq long, path string, records long, ids long, bytes long"


def masked(data: bytes) -> int:
    """The masked CRC-32 of some bytes."""
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return b"".join((size, struct.pack("<I", masked(size)), payload, struct.pack("<I", masked(payload))))


def unframe(record: bytes) -> bytes:
    """The payload of a framed record; raises if a length or checksum is wrong."""
    if len(record) < 16 or struct.unpack("<I", record[8:12])[0] != masked(record[:8]):
        raise ValueError("record length is damaged")
    if struct.unpack("<Q", record[:8])[0] != len(record) - 16:
        raise ValueError("record length differs from the index")
    payload = record[12:-4]
    if struct.unpack("<I", record[-4:])[0] != masked(payload):
        raise ValueError("record payload is damaged")
    return payload


def _sequences(batch: pa.RecordBatch, encode: tokens.Encoder, end: int) -> Iterator[tuple[int | None, np.ndarray]]:
    for at, to, ids, first in encode.encode(batch.column("text"), end):
        bounds = first.tolist()
        for k, doc_id in enumerate(batch.column("doc_id").slice(at, to - at).to_pylist()):
            yield doc_id, ids[bounds[k] : bounds[k + 1]]


def write_records(folder: str, tokenizer: str, end: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Encode and write the rows of a task in their order; returns a manifest row per file.

    File names hold the attempt, so a task that runs again never touches files that an earlier
    attempt left; readers open only what the manifest names.
    """
    fs, root = open_folder(folder)
    task, encode = TaskContext.get(), tokens.encoder(tokenizer)
    width = 2 if encode.tokenizer.get_vocab_size() <= 1 << 16 else 4
    done: list[tuple] = []
    data = index = None
    for batch in batches:
        for doc_id, ids in _sequences(batch, encode, end):
            if data is None:
                path = f"{root}/records-{task.partitionId():06d}-{len(done):04d}-{task.taskAttemptId()}"
                data, index = fs.open_output_stream(f"{path}.rec"), fs.open_output_stream(f"{path}.idx")
                records = ids_written = at = 0
            record = frame(_HEAD.pack(width, doc_id is not None, doc_id or 0) + ids.astype(f"<u{width}").tobytes())
            data.write(record)
            index.write(struct.pack("<QQ", at, len(record)))
            records, ids_written, at = records + 1, ids_written + len(ids), at + len(record)
            if at >= FILE_BYTES:
                data.close(), index.close()
                done.append((task.partitionId(), len(done), path, records, ids_written, at))
                data = None
    if data is not None:
        data.close(), index.close()
        done.append((task.partitionId(), len(done), path, records, ids_written, at))
    encode.close()
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*done), _MANIFEST)], schema=_MANIFEST)


_ROWS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def read_records(folder: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Read the files of manifest rows by their indexes and check every record."""
    fs, _ = open_folder(folder)
    for batch in batches:
        for row in batch.to_pylist():
            with fs.open_input_stream(f"{row['path']}.idx") as f:
                index = np.frombuffer(f.read(), dtype="<u8").reshape(-1, 2)
            if len(index) != row["records"]:
                raise ValueError(f"{row['path']}: the index holds {len(index)} of {row['records']} records")
            start, out = row["start"], []
            with fs.open_input_file(f"{row['path']}.rec") as f:
                for offset, length in index.tolist():
                    payload = unframe(f.read_at(length, offset))
                    width, has_id, doc_id = _HEAD.unpack_from(payload)
                    ids = np.frombuffer(payload, dtype=f"<u{width}", offset=_HEAD.size)
                    out.append((doc_id if has_id else None, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    start += len(ids)
                    if len(out) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=_ROWS)
                        out = []
            if start - row["start"] != row["ids"]:
                raise ValueError(f"{row['path']}: ids are missing")
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=_ROWS)


def write(docs: DataFrame, scratch: Scratch, tokenizer: str, end: int = 1) -> DataFrame:
    """Write all texts in ascending order of doc_id; the manifest, with each file's first position.

    Ranges of (doc_id, text) are dealt out, so rows that repeat a doc_id may be split as well.
    Null doc_ids come first; rows of one doc_id come in the order of their text's hash.
    """
    order = ["doc_id", "h"]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    files = rows.mapInArrow(narrow(write_records, f"{scratch.root}/records", tokenizer, end), _MANIFEST_DDL)
    files = scratch.table(files, "manifest")
    # One row per file: a running sum over files, not over documents.
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read(files: DataFrame, scratch: Scratch) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of each record of the manifest's files."""
    dealt = files.repartition(max(1, files.count()))
    return dealt.mapInArrow(narrow(read_records, f"{scratch.root}/records"), "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, scratch: Scratch, tokenizer: str, end: int = 1) -> DataFrame:
    """Write all documents and read them back: position, length and checksum of each one's ids.

    A null text is empty and gives the end id alone; an empty table gives no files and no rows.
    Other columns are ignored.
    """
    return read(write(docs, scratch, tokenizer, end), scratch)
