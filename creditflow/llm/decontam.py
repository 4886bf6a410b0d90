"""Benchmark decontamination by a prefix-filtered set join.

An item's windows are its runs of ``window`` words (a shorter item is one window). A document
holds a window only if it holds all the window's shingles of two words, so with shingles in order
of their rarity in the documents the necessary prefix is one shingle, the window's rarest. Only
places of such shingles are candidates; the shingle's position in the window gives the window's
start, which must lie inside the document (length and positional bound), and then the words are
compared one by one.

The benchmark is cut into blocks of at most about ``BLOCK_WINDOWS`` windows by their hash; a
block is broadcast (some 120 bytes a window) and all documents are read against it, so memory is
bounded however large the benchmark is. Words are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditflow.llm import text as T
from creditflow.llm.scratch import Scratch, chained, narrow, other_columns

RULE = "alnum_lower"
WINDOW = 10
BLOCK_WINDOWS = 1 << 17
_SIEVE = 1 << 22  # bits of the sieve before the exact look-up
_U = np.uint64
_WINDOW_DDL = "item string, size int, words binary"


def item_windows(window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of benchmark items, as word hashes."""
    for batch in batches:
        items, sizes, packed = [], [], []
        for at, _, w in T.word_blocks(batch.column("text"), RULE):
            for i, n in enumerate(np.diff(w.first)):
                own = w.hashes[w.first[i] : w.first[i] + n]
                for k in range(max(1, n - window + 1) if n else 0):
                    items.append(batch.column("item")[at + i])
                    sizes.append(min(window, n))
                    packed.append(own[k : k + window].tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array([x.as_py() for x in items], pa.string()), pa.array(sizes, pa.int32()), pa.array(packed, pa.binary())],
            names=["item", "size", "words"],
        )


def _shingles(words: np.ndarray) -> np.ndarray:
    """Hashes of two consecutive words; of the word itself where there is one."""
    return T.mix(words[:-1] * _U(0x9E3779B97F4A7C15) + T.mix(words[1:])) if len(words) > 1 else T.mix(words ^ _U(1))


@dataclass
class Lookup:
    """Sorted hashes behind a sieve."""

    keys: np.ndarray
    sieve: np.ndarray

    @classmethod
    def of(cls, hashes: np.ndarray) -> Lookup:
        sieve = np.zeros(_SIEVE, dtype=bool)
        sieve[hashes & _U(_SIEVE - 1)] = True
        return cls(np.unique(hashes), sieve)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of known hashes, and their places in ``keys``."""
        at = np.flatnonzero(self.sieve[hashes & _U(_SIEVE - 1)])
        if not len(at) or not len(self.keys):
            return at[:0], at[:0]
        place = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
        same = self.keys[place] == hashes[at]
        return at[same], place[same]


def _all_shingles(w: T.Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all two-word and one-word shingles; pairs that cross a text's end do no harm."""
    return _shingles(w.hashes) if len(w.hashes) > 1 else w.hashes[:0], T.mix(w.hashes ^ _U(1))


def count_shingles(lookup, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each known shingle occurs in the texts of this task."""
    known = lookup.value
    counts = np.zeros(len(known.keys), dtype=np.int64)
    for batch in batches:
        for _, _, w in T.word_blocks(batch.column("text"), RULE):
            for hashes in _all_shingles(w):
                counts += np.bincount(known.find(hashes)[1], minlength=len(counts))
    seen = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], names=["place", "n"])


@dataclass
class Index:
    """A block's windows by their rarest shingle."""

    lookup: Lookup
    begin: np.ndarray  # windows of key k: begin[k] to begin[k + 1] in by_key
    by_key: np.ndarray
    offset: np.ndarray  # of the rarest shingle in each window
    size: np.ndarray
    words: np.ndarray  # word hashes, a row per window
    item_begin: np.ndarray
    items: np.ndarray  # positions in names
    names: list[str]

    @classmethod
    def of(cls, windows: list[tuple[bytes, list[str]]], frequency: dict[int, int], window: int) -> Index:
        n = len(windows)
        words, size = np.zeros((n, window), np.uint64), np.zeros(n, np.int64)
        key, offset = np.zeros(n, np.uint64), np.zeros(n, np.int64)
        for i, (packed, _) in enumerate(windows):
            own = np.frombuffer(packed, dtype=np.uint64)
            words[i, : len(own)], size[i] = own, len(own)
            shingles = _shingles(own).tolist()
            offset[i] = min(range(len(shingles)), key=lambda k: (frequency.get(shingles[k], 0), shingles[k]))
            key[i] = shingles[offset[i]]
        lookup = Lookup.of(key)
        by_key = np.argsort(key, kind="stable")
        begin = np.searchsorted(key[by_key], np.append(lookup.keys, 0)[:-1])
        names = sorted({x for _, items in windows for x in items})
        place = {x: i for i, x in enumerate(names)}
        sizes = [len(items) for _, items in windows]
        return cls(
            lookup, np.append(begin, n), by_key, offset, size, words, np.append(0, np.cumsum(sizes, dtype=np.int64)),
            np.array([place[x] for _, items in windows for x in items], np.int64), names,
        )

    def occurrences(self, w: T.Words) -> tuple[np.ndarray, np.ndarray]:
        """Window and first word of every occurrence in a block of texts."""
        found = []
        for hashes in _all_shingles(w):
            at, place = self.lookup.find(hashes)
            many = self.begin[place + 1] - self.begin[place]
            spread = np.repeat(np.arange(len(at)), many)
            nth = np.arange(len(spread)) - np.repeat(np.cumsum(many) - many, many)
            win = self.by_key[self.begin[place[spread]] + nth]
            start = at[spread] - self.offset[win]
            doc = np.searchsorted(w.first, at[spread], side="right") - 1
            inside = (start >= w.first[doc]) & (start + self.size[win] <= w.first[doc + 1])
            win, start = win[inside], start[inside]
            for k in range(self.words.shape[1]):
                if len(win):
                    same = k >= self.size[win]
                    same |= w.hashes[np.minimum(start + k, len(w.hashes) - 1)] == self.words[win, k]
                    win, start = win[same], start[same]
            found.append((win, start))
        return tuple(np.concatenate(x) for x in zip(*found))


def search(index, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the word spans hit and the items met in one block to what earlier blocks found."""
    known = index.value
    for batch in batches:
        for at, to, w in T.word_blocks(batch.column("text"), RULE):
            win, start = known.occurrences(w)
            doc = np.searchsorted(w.first, start, side="right") - 1
            many = known.item_begin[win + 1] - known.item_begin[win]
            spread = np.repeat(np.arange(len(win)), many)
            nth = np.arange(len(spread)) - np.repeat(np.cumsum(many) - many, many)
            met = np.unique(np.stack([doc[spread], known.items[known.item_begin[win[spread]] + nth]], axis=1), axis=0)
            part = batch.slice(at, to - at)
            spans, items = part.column("spans").to_pylist(), part.column("items").to_pylist()
            order = np.lexsort((start, doc))
            doc, start, size = doc[order], start[order], known.size[win[order]]
            for i in np.unique(doc).tolist():
                a, b = np.searchsorted(doc, [i, i + 1])
                own = np.stack([start[a:b] - w.first[i], start[a:b] - w.first[i] + size[a:b]], axis=1).astype(np.int64)
                spans[i] = _merged(np.concatenate([np.frombuffer(spans[i], np.int64).reshape(-1, 2), own])).tobytes()
                a, b = np.searchsorted(met[:, 0], [i, i + 1])
                items[i] = sorted({*items[i], *(known.names[k] for k in met[a:b, 1])})
            columns = {
                "n_words": pa.array(np.diff(w.first), pa.int64()),
                "spans": pa.array(spans, pa.binary()),
                "items": pa.array(items, pa.list_(pa.string())),
            }
            yield pa.RecordBatch.from_arrays([columns.get(c, part.column(c)) for c in part.schema.names], names=part.schema.names)


def _merged(spans: np.ndarray) -> np.ndarray:
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.append(True, spans[1:, 0] > reach[:-1])
    first = np.flatnonzero(new)
    return np.stack([spans[first, 0], reach[np.append(first[1:], len(spans)) - 1]], axis=1)


def _measured(kept: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The columns named in ``kept``, and the measures of spans and items."""
    for batch in batches:
        hit = [int(np.diff(np.frombuffer(x, np.int64).reshape(-1, 2), axis=1).sum()) for x in batch.column("spans").to_pylist()]
        items = batch.column("items").to_pylist()
        columns = {
            "n_hit": pa.array(hit, pa.int64()),
            "n_items": pa.array([len(x) for x in items], pa.int64()),
            "items_sha256": pa.array([hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in items], pa.string()),
        }
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + list(columns.values()), names=[*kept, *columns])


def contaminated(docs: DataFrame, benchmark: DataFrame, scratch: Scratch, window: int = WINDOW, keep: bool = False, unnamed: bool = False) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)`` for each row of ``docs``.

    A null or wordless text has no words and is clean, as is everything if the benchmark holds no
    words. Item ids are text, and rows that repeat an item_id are one item. Items without an id
    are left out; with ``unnamed`` their passages count for n_hit and contaminated, and only the
    missing id stays out of n_items and items_sha256. Rows of ``docs`` are judged one by one, whatever their ids. With ``keep`` all
    columns of ``docs`` come along as the struct ``row``; otherwise others are ignored.
    """
    items = benchmark if unnamed else benchmark.where("item_id is not null")
    # The set of a window's items leaves nulls out; a window of unnamed items alone has none.
    items = items.select(F.col("item_id").cast("string").alias("item"), "text")
    windows = scratch.table(items.mapInArrow(narrow(item_windows, window), _WINDOW_DDL).groupBy("words").agg(F.collect_set("item").alias("items")), "windows")
    n_blocks = max(1, -(-windows.count() // BLOCK_WINDOWS))
    columns = ["doc_id", "text", other_columns(docs, "text")] if keep else ["doc_id", "text"]
    texts, state = docs.select("text"), docs.select(
        *columns, F.lit(0).cast("long").alias("n_words"), F.lit(b"").alias("spans"), F.array().cast("array<string>").alias("items")
    )
    context = docs.sparkSession.sparkContext
    for block in range(n_blocks):
        rows = windows.where(F.pmod(F.xxhash64("words"), F.lit(n_blocks)) == block).select("words", "items").collect()
        own = sorted((bytes(r["words"]), r["items"]) for r in rows)
        shingles = [_shingles(np.frombuffer(words, dtype=np.uint64)) for words, _ in own]
        lookup = Lookup.of(np.concatenate([*shingles, np.empty(0, np.uint64)]))
        counted = texts.mapInArrow(narrow(count_shingles, context.broadcast(lookup)), "place long, n long")
        frequency = {int(lookup.keys[r["place"]]): r["n"] for r in counted.groupBy("place").agg(F.sum("n").alias("n")).collect()}
        index = context.broadcast(Index.of(own, frequency, window))
        if block:
            # Cut here, so that a task holds one block at a time.
            state = scratch.table(state, f"block-{block}")
        if block < n_blocks - 1:
            state = state.mapInArrow(narrow(search, index), state.schema)
    kept = ["doc_id", *(["text", "row"] if keep else []), "n_words"]
    ddl = ", ".join(f"{c} {state.schema[c].dataType.simpleString()}" for c in kept)
    last = chained(narrow(search, index), narrow(_measured, kept))
    measured = state.mapInArrow(last, f"{ddl}, n_hit long, n_items long, items_sha256 string")
    return measured.withColumn("contaminated", F.col("n_hit") > 0)
