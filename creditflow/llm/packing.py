"""Best-two-fit packing of documents into sequences.

Only lengths decide, so texts stay where they are: tasks encode them and pass on one small row
per piece. Pieces are dealt at random into groups of about ``GROUP`` and each group is packed by
itself; a group loses at most its last, part-filled sequences.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditflow.llm import tokens
from creditflow.llm.scratch import Scratch, narrow

CAPACITY = 4096
#: Pieces that are packed together, on average.
GROUP = 16384
_PIECE = pa.schema([(c, pa.int64()) for c in ("doc_id",)] + [("piece", pa.int32())] + [(c, pa.int64()) for c in ("start", "length", "ids_crc32")])
_PIECE_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(tokenizer: str, end: int, capacity: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Length and checksum of each document's pieces."""
    encode = tokens.encoder(tokenizer)
    for batch in batches:
        for at, to, ids, first in encode.encode(batch.column("text"), end):
            out, bounds = [], first.tolist()
            for i, doc_id in enumerate(batch.column("doc_id").slice(at, to - at).to_pylist()):
                for k, start in enumerate(range(bounds[i], bounds[i + 1], capacity)):
                    part = ids[start : min(start + capacity, bounds[i + 1])]
                    out.append((doc_id, k, start - bounds[i], len(part), zlib.crc32(part)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), _PIECE)], schema=_PIECE)
    encode.close()


def _best_pair(sizes: list[int], count: dict[int, int], room: int, over: int) -> tuple[int, int] | None:
    """Two sizes with the largest sum above ``over`` and not above ``room``."""
    best, low, high = None, 0, bisect_right(sizes, room) - 1
    while low <= high:
        a, b = sizes[low], sizes[high]
        if low == high and count[a] < 2:
            break
        if a + b > room:
            high -= 1
        else:
            if a + b > over:
                best, over = (a, b), a + b
                if over == room:
                    break
            low += 1
    return best


def best_two_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and place of each length.

    A bin takes the largest length left and then, again and again, the largest that fits. If
    space is left, its smallest length is exchanged for the two unpacked ones that together fill
    the space most tightly, if they fill more than it did.
    """
    waiting: dict[int, list[int]] = {}
    for i in np.argsort(lengths, kind="stable")[::-1].tolist():
        waiting.setdefault(int(lengths[i]), []).append(i)
    sizes, count = sorted(waiting), {s: len(v) for s, v in waiting.items()}

    def take(size: int) -> None:
        count[size] -= 1
        if not count[size]:
            sizes.remove(size)

    def give(size: int) -> None:
        if not count[size]:
            insort(sizes, size)
        count[size] += 1

    bins, places = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    n_bins = 0
    while sizes:
        held, gap = [], capacity
        while (k := bisect_right(sizes, gap) - 1) >= 0:
            held.append(size := sizes[k])
            take(size)
            gap -= size
        if gap and len(held) > 1:
            smallest = held[-1]
            if pair := _best_pair(sizes, count, gap + smallest, smallest):
                held[-1:] = pair
                for size in pair:
                    take(size)
                give(smallest)
        at = 0
        for size in held:
            i = waiting[size].pop()
            bins[i], places[i], at = n_bins, at, at + size
        n_bins += 1
    return bins, places


def _packed(capacity: int, table: pa.Table) -> pa.Table:
    bins, places = best_two_fit(table.column("length").to_numpy(), capacity)
    group = table.column("bucket").to_numpy().astype(np.int64)
    return table.drop_columns(["bucket"]).append_column("sequence_id", pa.array((group << 32) + bins)).append_column("offset", pa.array(places))


def pack(docs: DataFrame, scratch: Scratch, tokenizer: str, end: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)`` for each piece.

    A null or empty text is the end id alone. Only documents above ``capacity`` are cut. Rows that
    repeat a doc_id are packed one by one; a null doc_id stays null; no documents give no rows.
    Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    cut = scratch.table(rows.mapInArrow(narrow(pieces, tokenizer, end, capacity), _PIECE_DDL), "pieces")
    groups = max(1, -(-cut.count() // GROUP))
    dealt = cut.withColumn("bucket", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    return dealt.groupBy("bucket").applyInArrow(lambda table: _packed(capacity, table), f"{_PIECE_DDL}, sequence_id long, offset long")
