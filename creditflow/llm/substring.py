"""Removal of repeated word windows by super-k-mer partitioning.

A window is ``window`` consecutive words. Its minimiser is the least hash among its runs of
``GRAM`` words, and consecutive windows that share a minimiser travel as one packed string, a
super-k-mer, to the minimiser's bucket: equal windows share a bucket, wherever they stand. There
sorting finds each window's first position and thereby all later ones, exactly.

Runs that make up more than ``HEAVY`` of all runs come last in the order of minimisers, so that a
line which many documents share doesn't gather all its surroundings in one bucket; there are at
most ``1 / HEAVY`` of them. Equal packed strings are reduced to the earliest one in each task
before the shuffle, so a passage that a third of all documents hold is sent once per block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditflow.llm import text as T
from creditflow.llm.scratch import Scratch, narrow, other_columns, return_memory

RULE = "blank"
WINDOW, GRAM = 20, 5
HEAVY = 1e-5
#: Packed bytes that a task gathers before it sends them, and that it sorts at once.
SEND_BYTES, SORT_BYTES = 16 << 20, 2 << 20
#: Packed strings are about three times the text, so their shuffle has as many more partitions.
PARTS = 4
_LAST = (1 << 63) - 1  # stands for a null doc_id: after all others
_U = np.uint64

_KMER = pa.schema([("turn", pa.uint16()), ("id", pa.int64()), ("h", pa.int32()), ("start", pa.int32()), ("n", pa.int32()), ("packed", pa.large_binary())])
_SPAN = pa.schema([("id", pa.int64()), ("h", pa.int32()), ("begin", pa.int32()), ("end", pa.int32())])
_SPAN_DDL = "id long, h int, begin int, end int"


def count_grams(gram: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs that are frequent in a block of texts, and the number of all runs (as run 0)."""
    for batch in batches:
        for _, _, w in T.word_blocks(batch.column("text"), RULE):
            runs = w.runs(gram)
            if not len(runs):
                continue
            values, counts = np.unique(runs, return_counts=True)
            often = (counts > 1) & (counts >= HEAVY * len(runs))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(values[often], _U(0)).view(np.int64)), pa.array(np.append(counts[often], len(runs)))],
                names=["run", "n"],
            )


def _order(w: T.Words, gram: int, heavy: np.ndarray) -> np.ndarray:
    """The rank of the run at each word: its hash, after all others if it is heavy."""
    rank = w.runs(gram) >> _U(1)
    if len(heavy) and len(rank):
        place = np.minimum(np.searchsorted(heavy, rank), len(heavy) - 1)
        rank = np.where(heavy[place] == rank, rank | _U(1 << 63), rank)
    return rank


def super_kmers(w: T.Words, window: int, gram: int, heavy: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket, first window and number of windows of each run of windows that share a minimiser."""
    rank = _order(w, gram, heavy)
    width, covered, least = window - gram + 1, 1, rank
    while covered < width:
        step = min(covered, width - covered)
        if len(least) <= step:
            return rank[:0], np.empty(0, np.int64), np.empty(0, np.int64)
        least = np.minimum(least[:-step], least[step:])
        covered += step
    if not len(least):
        return rank[:0], np.empty(0, np.int64), np.empty(0, np.int64)
    doc = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
    at = np.arange(len(least))
    valid = at + window <= w.first[doc[: len(least)] + 1]
    begins = valid.copy()
    begins[1:] &= ~valid[:-1] | (least[1:] != least[:-1]) | (doc[1 : len(least)] != doc[: len(least) - 1])
    first = np.flatnonzero(begins)
    sizes = np.add.reduceat(valid.astype(np.int64), first) if len(first) else np.empty(0, np.int64)
    return least[first], first, sizes


def send(window: int, gram: int, parts: int, heavy, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Super-k-mers of each text, gathered by destination and compressed."""
    held, size = [], 0  # of each: the parts of its rows, and the rows
    for batch in batches:
        ids, hashes = batch.column("id").to_numpy(), batch.column("h").to_numpy()
        for at, _, w in T.word_blocks(batch.column("text"), RULE):
            bucket, first, n = super_kmers(w, window, gram, heavy.value)
            if not len(first):
                continue
            doc = np.searchsorted(w.first, first, side="right") - 1
            own, start = ids[at + doc], first - w.first[doc]
            begin, end = w.starts[first], w.ends[first + n + window - 2]
            order = np.lexsort((start, own))
            raw, seen = w.data.tobytes(), {}
            packed = [raw[a:b] for a, b in zip(begin.tolist(), end.tolist())]
            repeat, again = np.zeros(len(first), dtype=bool), np.zeros(len(first), dtype=bool)
            h = hashes[at + doc]
            for i in order.tolist():
                j = seen.setdefault(packed[i], i)
                if i != j:
                    # Rows that repeat a document stand at the same place: neither is earlier.
                    repeat[i] = own[j] != own[i] or start[j] != start[i]
                    again[i] = not repeat[i] and h[j] == h[i]
            # A repeat within the block needs no look-up: it only carries its place.
            dealt = T.mix(np.where(repeat, T.mix(own.astype(_U) + start.astype(_U)), bucket))
            part, turn = (dealt % _U(parts)).astype(np.int32), (dealt >> _U(48)).astype(np.uint16)
            for i in np.flatnonzero(repeat).tolist():
                packed[i] = None
            own_batch = pa.RecordBatch.from_arrays(
                [pa.array(turn), pa.array(own), pa.array(h), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(packed, pa.large_binary())],
                schema=_KMER,
            )
            held.append((part[~again], own_batch.filter(pa.array(~again)) if again.any() else own_batch))
            size += int((end - begin)[~repeat].sum()) + 40 * len(first)
            if size >= SEND_BYTES:
                yield _blobs(held)
                held, size = [], 0
    if held:
        yield _blobs(held)


def _blobs(held: list[tuple[np.ndarray, pa.RecordBatch]]) -> pa.RecordBatch:
    table = pa.Table.from_batches([rows for _, rows in held])
    part = np.concatenate([own for own, _ in held])
    order = np.argsort(part, kind="stable")
    part = part[order]
    table = table.take(pa.array(order)).combine_chunks()
    first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    blobs = []
    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(part)]):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, _KMER, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as out:
            out.write_table(table.slice(a, b - a))
        blobs.append(sink.getvalue().to_pybytes())
    return pa.RecordBatch.from_arrays([pa.array(part[first]), pa.array(blobs, pa.binary())], names=["part", "blob"])


def later_windows(window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words covered by windows that also start earlier, from the super-k-mers of whole buckets."""
    received: list[pa.Table] = []
    for batch in batches:
        for blob in batch.column("blob"):
            received.append(pa.ipc.open_stream(blob.as_buffer()).read_all())
    if not received:
        return
    table = pa.concat_tables(received)
    received = None
    alone = table.filter(table.column("packed").is_null())
    start = alone.column("start").to_numpy()
    end = (start + alone.column("n").to_numpy() + window - 1).astype(np.int32)
    yield pa.RecordBatch.from_arrays([alone.column("id").combine_chunks(), alone.column("h").combine_chunks(), pa.array(start), pa.array(end)], schema=_SPAN)
    table = table.filter(table.column("packed").is_valid())
    slices = max(1, -(-table.nbytes // SORT_BYTES))
    # Buckets take turns by other bits of their hash than those that dealt them to tasks.
    turn = table.column("turn").to_numpy().astype(np.int64) % slices
    order = np.argsort(turn, kind="stable")
    cuts = np.searchsorted(turn[order], np.arange(slices + 1))
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b > a:
            yield _later(window, table.take(pa.array(order[a:b])).combine_chunks())
    table = None
    return_memory()


def _later(window: int, table: pa.Table) -> pa.RecordBatch:
    ids, hashes, start = (table.column(c).to_numpy() for c in ("id", "h", "start"))
    order = np.lexsort((start, ids))
    table = table.take(pa.array(order))
    ids, hashes, start = ids[order], hashes[order], start[order]
    turn = table.column("turn").to_numpy().astype(_U)
    column = table.column("packed").combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    w = T.words(data, offsets - offsets[0], RULE)
    runs = w.runs(window)
    row = np.repeat(np.arange(len(ids)), np.diff(w.first))[: len(runs)]
    place = np.arange(len(runs)) - w.first[row]
    inside = np.arange(len(runs)) + window <= w.first[row + 1]
    row, place = row[inside], place[inside]
    name = T.mix(runs[inside] ^ T.mix(turn[row]))
    by_name = np.argsort(name, kind="stable")
    head = np.append(True, name[by_name][1:] != name[by_name][:-1])
    earliest = by_name[np.flatnonzero(head)[np.cumsum(head) - 1]]
    # Rows are in the order of (id, start), so a group's head is its earliest window, but for
    # windows of one document, whose places are compared as well.
    here = start[row] + place
    late = np.zeros(len(row), dtype=bool)
    late[by_name] = (ids[row[earliest]] != ids[row[by_name]]) | (here[earliest] != here[by_name])
    edge = late.copy()
    edge[1:] &= ~late[:-1] | (row[1:] != row[:-1])
    first = np.flatnonzero(edge)
    stop = late.copy()
    stop[:-1] &= ~late[1:] | (row[1:] != row[:-1])
    last = np.flatnonzero(stop)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[row[first]]), pa.array(hashes[row[first]]), pa.array(here[first].astype(np.int32)), pa.array((here[last] + window).astype(np.int32))],
        schema=_SPAN,
    )


def cut(text_out: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Remove the marked words of each text; without any marked word a text stays as it is."""
    for batch in batches:
        spans = batch.column("spans")
        for at, to, w in T.word_blocks(batch.column("text"), RULE):
            texts = batch.column("text").slice(at, to - at).to_pylist() if text_out else None
            removed, digests = [], []
            raw, sizes = w.data.tobytes(), np.diff(w.first)
            for i, n in enumerate(sizes.tolist()):
                gone = np.zeros(n, dtype=bool)
                for span in spans[at + i].as_py() or ():
                    gone[span["begin"] : span["end"]] = True
                kept = np.flatnonzero(~gone) + w.first[i]
                joined = b" ".join([raw[a:b] for a, b in zip(w.starts[kept].tolist(), w.ends[kept].tolist())])
                removed.append(n - len(kept))
                if text_out:
                    texts[i] = joined.decode("utf-8") if len(kept) < n else texts[i]
                else:
                    digests.append(hashlib.sha256(joined).hexdigest())
            part = batch.slice(at, to - at)
            columns = {"n_words": pa.array(sizes, pa.int64()), "n_removed": pa.array(removed, pa.int64())}
            if text_out:
                columns["text"] = pa.array(texts, pa.string())
            else:
                columns["kept_sha256"] = pa.array(digests, pa.string())
            kept_names = [c for c in part.schema.names if c != "spans" and (text_out or c != "text")]
            names = list(dict.fromkeys([*kept_names, *columns]))
            yield pa.RecordBatch.from_arrays([columns[c] if c in columns else part.column(c) for c in names], names=names)


def without_repeats(docs: DataFrame, scratch: Scratch, window: int = WINDOW, keep: bool = False) -> DataFrame:
    """Remove each word covered by a window that also starts earlier.

    Earlier means in a document of smaller doc_id, or in the same one at an earlier word; windows
    are judged on the input. Returns ``(doc_id, n_words, n_removed, kept_sha256)`` for each row,
    or, with ``keep``, the other columns as the struct ``row``, ``text`` with the kept words joined
    by one blank (as it was where nothing is removed), ``n_words`` and ``n_removed``.
    A null text has no words. Rows with a null doc_id count as one document after all others; rows
    that repeat a doc_id are one document, and equal ones keep the same words. Other columns are
    ignored.
    """
    spark = docs.sparkSession
    keyed = docs.withColumns({"_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)), "_h": F.hash("text")})
    slim = keyed.select(F.col("_id").alias("id"), F.col("_h").alias("h"), "text")
    counted = scratch.table(
        slim.select("text").mapInArrow(narrow(count_grams, GRAM), "run long, n long").groupBy("run").agg(F.sum("n").alias("n")), "runs"
    )
    total = counted.where("run = 0").agg(F.sum("n")).first()[0] or 0
    heavy = counted.where((F.col("run") != 0) & (F.col("n") >= max(2.0, HEAVY * total))).select("run").collect()
    heavy = np.unique(np.array([r["run"] for r in heavy], dtype=np.int64).view(_U) >> _U(1))
    parts = PARTS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    sent = slim.mapInArrow(narrow(send, window, GRAM, parts, spark.sparkContext.broadcast(heavy)), "part int, blob binary")
    spans = scratch.table(sent.repartitionById(parts, F.col("part")).mapInArrow(narrow(later_windows, window), _SPAN_DDL), "spans")
    del sent
    scratch.release()
    marked = scratch.table(spans.groupBy("id", "h").agg(F.collect_set(F.struct("begin", "end")).alias("spans")), "marked")
    first = other_columns(docs, "text") if keep else F.col("doc_id")
    rows = keyed.select(first, "text", "_id", "_h")
    joined = rows.join(marked.toDF("_id", "_h", "spans"), ["_id", "_h"], "left").select(*rows.columns[:2], "spans")
    named = f"{rows.columns[0]} {rows.schema[0].dataType.simpleString()}"
    measures = "n_words long, n_removed long"
    if keep:
        return joined.mapInArrow(narrow(cut, True), f"{named}, text string, {measures}")
    return joined.mapInArrow(narrow(cut, False), f"{named}, {measures}, kept_sha256 string")
