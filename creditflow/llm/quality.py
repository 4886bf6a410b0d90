"""Quality scores from random-indexing word vectors and a small network.

Each word has a fixed sparse random index vector, drawn from its hash; a word's vector is the sum
of the index vectors of its neighbours in all documents, labelled or not. A document is the mean
of its words' vectors, which a two-layer network turns into a probability, calibrated by a
temperature that is fitted on a part of the sample that the network hasn't seen.

Words are runs of letters and digits, and runs of other signs. All have a vector of their own,
whole numbers in a table: the ``HEAD`` most frequent at most are broadcast, the others are joined
with the texts that hold them, in ``ROUNDS`` rounds of which each takes its share of the words and
frees its shuffle files; for the few texts of the sample, in one. Unit vectors are fixed-point
numbers, so sums don't depend on their order. Only the network and the temperature learn from a
sample, of about ``SAMPLE`` labelled documents at most, picked by the hash of their ids.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditflow.llm import text as T
from creditflow.llm.scratch import Scratch, chained, narrow, return_memory, whole_groups

SAMPLE = 4000
#: The dimensions are a power of two.
DIMENSIONS, NONZERO, REACH = 64, 6, 2
#: Words whose vectors are broadcast, 264 bytes each.
HEAD = 1 << 17
HIDDEN = 32
#: Bytes of text pooled at once; a block holds a vector per word.
POOL_BYTES = 1 << 19
#: Words (264 bytes each) and occurrences that a task sums before it sends them on; sums stay below 2**31.
HELD_WORDS, HELD_TOKENS = 1 << 18, 1 << 26
#: Rounds in which the words outside the head are joined.
ROUNDS = 8
#: One in the fixed-point numbers of unit vectors.
ONE = 1 << 20
_ENTRY = np.dtype([("word", "<i8"), ("n", "<i4")])
_U = np.uint64
_TEXT = "h1 long, h2 long"
_OWN = ("h1", "h2", "size", "sums")
#: Rows of vectors worked on at once, so that they stay in the processor's cache.
_PART = 1 << 10
#: Kinds of bytes: 1 in words, 2 in sign runs, 0 between them.
_KINDS = T.RULES["letters"][0] + 2 * T.RULES["signs"][0].astype(np.uint8)


def _both(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and sign runs in their order, and where each text's begin."""
    kinds = np.zeros(len(data) + 2, dtype=np.uint8)
    kinds[1:-1] = _KINDS[data]
    border = kinds[1:] != kinds[:-1]
    border[offsets] = True
    border = np.flatnonzero(border)
    runs = np.flatnonzero(kinds[1:][border[:-1]])
    starts, ends = border[runs], border[runs + 1]
    # Both rules hash the bytes as they are.
    return T.span_hashes(data, starts, ends, "letters"), np.searchsorted(starts, offsets)


def index_vectors(words: np.ndarray) -> np.ndarray:
    """A few random signs per word."""
    out = np.zeros((len(words), DIMENSIONS), dtype=np.int8)
    n = np.arange(len(words))
    for k in range(1, NONZERO + 1):
        drawn = T.mix(words + _U(k * 0x9E3779B97F4A7C15 % (1 << 64)))
        out[n, (drawn & _U(DIMENSIONS - 1)).view(np.int64)] += (drawn >> _U(63)).astype(np.int8) * np.int8(2) - np.int8(1)
    return out


def _packed(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as binary values."""
    rows = np.ascontiguousarray(rows)
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(rows.shape[1] * rows.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a binary column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8), offsets


def _binary(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary values that follow each other in ``data`` and end where ``ends`` says."""
    offsets = np.append(0, ends).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _floats(column: pa.Array) -> np.ndarray:
    data, offsets = _bytes(column)
    return data[offsets[0] : offsets[-1]].view(np.float64).reshape(-1, DIMENSIONS)


#: Widths in bits that whole numbers are stored with; a row takes as many planes of DIMENSIONS bits.
_BITS = np.array([2, 3, 4, 5, 6, 8, 12, 16, 24, 32, 64])


def _kind(bits: int) -> np.dtype:
    """The narrowest kind of whole numbers that holds ``bits`` bits."""
    return np.dtype(next(f"<i{size}" for size in (1, 2, 4, 8) if bits <= 8 * size))


def _turned(x: np.ndarray) -> np.ndarray:
    """Swaps bit j of byte i with bit i of byte j in each number, in place."""
    for shift, mask in ((7, 0x00AA00AA00AA00AA), (14, 0x0000CCCC0000CCCC), (28, 0x00000000F0F0F0F0)):
        change = x >> _U(shift)
        change ^= x
        change &= _U(mask)
        x ^= change
        change <<= _U(shift)
        x ^= change
    return x


def _planes(rows: np.ndarray) -> pa.Array:
    """Rows of whole numbers, each as the bit planes of its two's complements."""
    room = np.maximum(rows.max(axis=1, initial=0), -1 - rows.min(axis=1, initial=0))
    bits = _BITS[np.searchsorted(_BITS, np.frexp(room.astype(np.float64))[1] + 1)]
    plane = DIMENSIONS // 8
    offsets = np.append(0, np.cumsum(bits * plane)).astype(np.int32)
    out = np.empty(offsets[-1], dtype=np.uint8)
    for k in np.unique(bits).tolist():
        every, size = np.flatnonzero(bits == k), _kind(k).itemsize
        for i in range(0, len(every), _PART):
            at = every[i : i + _PART]
            own = rows.take(at, axis=0).astype(_kind(k)).view(np.uint8).reshape(len(at), DIMENSIONS, size)
            own = _turned(np.ascontiguousarray(own.transpose(0, 2, 1)).view(np.uint64)).view(np.uint8)
            own = own.reshape(len(at), size, plane, 8).transpose(0, 1, 3, 2).reshape(len(at), -1)
            out[offsets[at].astype(np.int64)[:, None] + np.arange(k * plane)] = own[:, : k * plane]
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(out)])


def _numbers(column: pa.Array) -> np.ndarray:
    """The rows that ``_planes`` stored; zeros for null."""
    data, offsets = _bytes(column)
    plane = DIMENSIONS // 8
    bits = np.diff(offsets) // plane
    out = np.zeros((len(bits), DIMENSIONS), dtype=np.int32 if bits.max(initial=0) <= 32 else np.int64)
    for k in np.unique(bits[bits > 0]).tolist():
        every, size = np.flatnonzero(bits == k), _kind(k).itemsize
        for i in range(0, len(every), _PART):
            at = every[i : i + _PART]
            own = np.empty((len(at), size * 8, plane), dtype=np.uint8)
            own[:, :k] = data.take(offsets[at][:, None] + np.arange(k * plane)).reshape(len(at), k, plane)
            # The planes left out repeat the sign.
            own[:, k:] = own[:, k - 1 : k]
            own = np.ascontiguousarray(own.reshape(len(at), size, 8, plane).transpose(0, 1, 3, 2)).reshape(len(at), size, DIMENSIONS)
            own = _turned(own.view(np.uint64)).view(np.uint8).transpose(0, 2, 1)
            out[at] = np.ascontiguousarray(own).view(_kind(k)).reshape(len(at), DIMENSIONS)
    return out


def _group_sums(rows: np.ndarray, heads: np.ndarray, kind) -> np.ndarray:
    """Sums of the runs of rows that begin at ``heads``: short runs rank by rank, long ones each."""
    many = np.diff(np.append(heads, len(rows)))
    out = rows[heads].astype(kind)
    left = np.flatnonzero((many > 1) & (many < 16))
    for rank in range(1, 15):
        out[left] += rows[heads[left] + rank]
        left = left[many[left] > rank + 1]
    for k in np.flatnonzero(many >= 16).tolist():
        out[k] = rows[heads[k] : heads[k] + many[k]].sum(axis=0, dtype=kind)
    return out


def _heads(names: np.ndarray) -> np.ndarray:
    """Where the runs of equal names begin."""
    return np.flatnonzero(np.append(True, names[1:] != names[:-1])[: len(names)])


def _rows(words: np.ndarray, n: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n), _planes(sums)], names=["word", "n", "sums"])


def _neighbours(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Count and sum of the neighbours' index vectors for each word of a block."""
    order = np.argsort(words)
    heads = _heads(words[order])
    names, n = words[order[heads]], np.diff(np.append(heads, len(words)))
    local = np.repeat(np.arange(len(names)), n)
    # Between texts, and around all, lie REACH places of a last, zero, vector.
    place = (np.arange(len(words)) + REACH * (1 + np.repeat(np.arange(len(first) - 1), np.diff(first))))[order]
    padded = np.full(len(words) + REACH * len(first), len(names))
    padded[place] = local
    # Numbers are raised by NONZERO, so none is below zero and whole rows are added as a few long
    # numbers: the neighbours of a place stay below 2**8 in each dimension, those of a part below 2**16.
    raised = np.full((len(names) + 1, DIMENSIONS), NONZERO, dtype=np.uint8)
    for k in range(0, len(names), _PART):
        raised[k : k + _PART][: len(names) - k] += index_vectors(names[k : k + _PART]).view(np.uint8)
    raised = raised.view(np.uint64)
    sums = np.zeros((len(names), DIMENSIONS), dtype=np.int32)
    for k in range(0, len(words), _PART):
        at, own = place[k : k + _PART], local[k : k + _PART]
        around = np.zeros((len(at), raised.shape[1]), dtype=np.uint64)
        for step in range(1, REACH + 1):
            around += raised.take(padded.take(at - step), axis=0)
            around += raised.take(padded.take(at + step), axis=0)
        upto = np.zeros((len(at) + 1, DIMENSIONS), dtype=np.uint16)
        upto[1:] = around.view(np.uint8)
        upto = upto.view(np.uint64)
        np.cumsum(upto[1:], axis=0, out=upto[1:])
        # Differences are exact though the sums up to a place run over. Names follow each other.
        heads = np.append(_heads(own), len(own))
        part = sums[own[0] : own[-1] + 1]
        part += np.diff(upto[heads], axis=0).view(np.uint16)
        part -= (2 * REACH * NONZERO) * np.diff(heads).astype(np.int32)[:, None]
    return names, n, sums


class Held:
    """Counts and sums of a task's words; full, it gives away the rarer half, so frequent words are sent once."""

    def __init__(self, room: int):
        self.words, self.slots = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.n, self.sums, self.tokens = np.zeros(room, np.int64), np.zeros((room, DIMENSIONS), np.int32), 0

    def add(self, words: np.ndarray, n: np.ndarray, sums: np.ndarray) -> None:
        """Add sorted distinct words for which there is room."""
        place = np.searchsorted(self.words, words)
        met = self.words[np.minimum(place, max(0, len(self.words) - 1))] == words if len(self.words) else np.zeros(len(words), dtype=bool)
        slots = np.empty(len(words), dtype=np.int64)
        slots[met] = self.slots[place[met]]
        slots[~met] = len(self.words) + np.arange((~met).sum())
        self.words, self.slots = np.insert(self.words, place[~met], words[~met]), np.insert(self.slots, place[~met], slots[~met])
        self.n[slots] += n
        for k in range(0, len(slots), _PART):
            self.sums[slots[k : k + _PART]] += sums[k : k + _PART]
        self.tokens += int(n.sum())

    def give(self, keep: int) -> Iterator[pa.RecordBatch]:
        """All words but the ``keep`` most frequent, which stay."""
        order = np.argsort(-self.n[self.slots], kind="stable")
        kept, given = np.sort(order[:keep]), np.sort(order[keep:])
        for k in range(0, len(given), 1 << 14):
            part = given[k : k + (1 << 14)]
            yield _rows(self.words[part], self.n[self.slots[part]], self.sums[self.slots[part]])
        stay = self.slots[kept]
        n, sums = self.n[stay], self.sums[stay]
        self.n[:], self.sums[:] = 0, 0
        self.n[: len(kept)], self.sums[: len(kept)] = n, sums
        self.words, self.slots, self.tokens = self.words[kept], np.arange(len(kept)), int(n.sum())


def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of, and sums of the neighbours' index vectors for, each word in parts of this task."""
    held = Held(HELD_WORDS)
    for batch in batches:
        for _, _, data, offsets in T.blocks(batch.column("text"), POOL_BYTES):
            words, first = _both(data, offsets)
            if not len(words):
                continue
            names, n, sums = _neighbours(words, first)
            if len(held.words) + len(names) > HELD_WORDS or held.tokens + len(words) > HELD_TOKENS:
                yield from held.give(HELD_WORDS // 2 if held.tokens + len(words) <= HELD_TOKENS else 0)
            if len(held.words) + len(names) > HELD_WORDS or len(words) > HELD_TOKENS:
                # A long text's own words.
                yield _rows(names, n, sums)
            else:
                held.add(names, n, sums)
    yield from held.give(0)
    del held
    return_memory()


def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per word from rows sorted by word; a word without neighbours has its own index vector."""
    for table, _ in whole_groups(batches, ["word"], rows=1 << 14):
        words, n = (table.column(c).to_numpy() for c in ("word", "n"))
        heads = _heads(words)
        words, n, sums = words[heads], np.add.reduceat(n, heads), _group_sums(_numbers(table.column("sums")), heads, np.int64)
        alone = np.flatnonzero(~sums.any(axis=1))
        sums[alone] = index_vectors(words[alone].view(np.uint64))
        yield _rows(words, n, sums)


def units(sums: np.ndarray) -> np.ndarray:
    """Unit vectors of words, as fixed-point numbers."""
    sums = sums.astype(np.float64)
    return np.rint(sums * (ONE / np.maximum(np.sqrt((sums * sums).sum(axis=1, keepdims=True)), 1e-9))).astype(np.int64)


def look_up(head, rounds: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's sum over the words of the head, and its other words with their counts, by round."""
    known, vectors = head.value
    for batch in batches:
        for at, to, data, offsets in T.blocks(batch.column("text"), POOL_BYTES):
            words, first = _both(data, offsets)
            order = np.argsort(words)
            heads = _heads(words[order])
            names, local = words[order[heads]], np.empty(len(words), dtype=np.int64)
            local[order] = np.repeat(np.arange(len(names)), np.diff(np.append(heads, len(words))))
            place = np.minimum(np.searchsorted(known, names), max(0, len(known) - 1))
            found = known[place] == names if len(known) else np.zeros(len(names), dtype=bool)
            # Words outside the head take the last row, which is zero.
            place = np.where(found, place, len(known))[local]
            out, n = np.zeros((to - at, DIMENSIONS), dtype=np.int64), np.diff(first)
            # Parts of 1,024 words stay below 2**31.
            for i in np.flatnonzero(n):
                for k in range(first[i], first[i + 1], 1 << 10):
                    out[i] += vectors.take(place[k : min(k + (1 << 10), first[i + 1])], axis=0).sum(axis=0, dtype=np.int32)
            rest = np.flatnonzero(place == len(known))
            doc = np.searchsorted(first, rest, side="right") - 1
            pairs, many = np.unique(doc * len(names) + local[rest], return_counts=True)
            doc, word = np.divmod(pairs, max(1, len(names)))
            entries = np.empty(len(pairs), dtype=_ENTRY)
            entries["word"], entries["n"] = names[word].view(np.int64), many
            turn, tails = names[word] % _U(rounds), []
            for k in range(rounds):
                mine = np.flatnonzero(turn == _U(k))
                tails.append(_binary(entries[mine], np.searchsorted(doc[mine], np.arange(1, to - at + 1)) * _ENTRY.itemsize))
            part = batch.slice(at, to - at)
            yield pa.RecordBatch.from_arrays(
                [part.column("h1"), part.column("h2"), pa.array(n, pa.int64()), _planes(out), *tails],
                names=["h1", "h2", "size", "sums", *_tails(rounds)],
            )


def tail_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per text and word outside the head."""
    for batch in batches:
        data, offsets = _bytes(batch.column(1))
        both = data[offsets[0] : offsets[-1]].view(_ENTRY)
        texts = np.repeat(batch.column("text").to_numpy(), np.diff(offsets) // _ENTRY.itemsize)
        for k in range(0, len(both), 1 << 16):
            part = slice(k, k + (1 << 16))
            columns = (texts[part], np.ascontiguousarray(both["word"][part]), np.ascontiguousarray(both["n"][part]))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["text", "word", "n"])


def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of each text so far (rows without ``n``) and of words it holds ``n`` times, from rows sorted by text."""
    held = None
    for batch in (batch.slice(k, _PART) for batch in batches for k in range(0, batch.num_rows, _PART)):
        n = batch.column("n").fill_null(0).to_numpy(zero_copy_only=False)
        rows, of_word = _numbers(batch.column("sums")).astype(np.int64), np.flatnonzero(n)
        rows[of_word] = units(rows.take(of_word, axis=0)) * n[of_word, None]
        texts = batch.column("text").to_numpy()
        # Only the row of the sums so far has these; they add up to themselves.
        own = np.stack([batch.column(c).fill_null(0).to_numpy(zero_copy_only=False) for c in ("h1", "h2", "size")], axis=1)
        if held is not None:
            texts, own, rows = (np.concatenate(x) for x in zip(held, (texts, own, rows)))
        heads = _heads(texts)
        texts, own, rows = texts[heads], np.add.reduceat(own, heads, axis=0), np.add.reduceat(rows, heads, axis=0)
        held = texts[-1:], own[-1:], rows[-1:]
        if len(texts) > 1:
            yield _sums(texts[:-1], own[:-1], rows[:-1])
    if held is not None:
        yield _sums(*held)


def _sums(texts: np.ndarray, own: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(texts), *(pa.array(np.ascontiguousarray(x)) for x in own.T), _planes(rows)]
    return pa.RecordBatch.from_arrays(columns, names=["text", "h1", "h2", "size", "sums"])


def means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The mean word vector of each text, zero without words."""
    for batch in batches:
        x = _numbers(batch.column("sums")) / (np.maximum(batch.column("size").to_numpy(), 1)[:, None] * float(ONE))
        yield pa.RecordBatch.from_arrays([batch.column("h1"), batch.column("h2"), _packed(x)], names=["h1", "h2", "x"])


class WordVectors:
    """A table of all words with the sums of their neighbours' index vectors."""

    def __init__(self, docs: DataFrame, scratch: Scratch):
        parts = docs.select("text").mapInArrow(contexts, "word long, n long, sums binary")
        summed = parts.repartition("word").sortWithinPartitions("word").mapInArrow(add_up, "word long, n long, sums binary")
        self.words, self.scratch = scratch.table(summed, "words"), scratch
        del parts, summed
        scratch.release()
        # The head's least count, on a fixed scale of counts, so that few rows decide it.
        level = F.floor(F.log2("n") * 16)
        self.level, room = 1 << 30, HEAD
        for row in sorted(self.words.groupBy(level.alias("level")).count().collect(), reverse=True):
            room -= row["count"]
            if room < 0:
                break
            self.level = row["level"]
        head = self.words.where(level >= self.level).select("word", "sums").toArrow()
        names = head.column("word").to_numpy().view(np.uint64)
        order = np.argsort(names)
        vectors = units(_numbers(head.column("sums"))).astype(np.int32)[order]
        self.head = docs.sparkSession.sparkContext.broadcast((names[order], np.vstack([vectors, np.zeros((1, DIMENSIONS), np.int32)])))
        self.tail = self.words.where(level < self.level).select("word", "sums")

    def pooled(self, docs: DataFrame, rounds: int = ROUNDS, then=None, shape: str = "x binary") -> DataFrame:
        """``(h1, h2, x)``: the mean word vector of each row's text, by the text's hashes.

        ``then`` turns batches of these into such of ``shape`` in place of ``x``, in the same worker.
        """
        tails = "".join(f", {c} binary" for c in _tails(rounds))
        seen = docs.select(*text_key("text"), "text").mapInArrow(narrow(look_up, self.head, rounds), f"{_TEXT}, size long, sums binary{tails}")
        # Numbers of rows are short in a shuffle; they are fixed by being written.
        seen = self.scratch.table(seen.withColumn("text", F.monotonically_increasing_id()), "seen")
        found = seen.select("text", *_OWN)
        for k, tail in enumerate(_tails(rounds)):
            if k:
                found = self.scratch.table(found, f"sums{k}", instead=f"sums{k - 1}")
                self.scratch.release()
            rest = seen.select("text", tail).where(F.length(tail) > 0).mapInArrow(tail_rows, "text long, word long, n int")
            words = self.tail.where(_round("word", rounds) == k)
            rest = rest.join(words, "word").select("text", "n", "sums", *(F.lit(None).cast("long").alias(c) for c in ("h1", "h2", "size")))
            whole = found.select("text", F.lit(None).cast("int").alias("n"), "sums", "h1", "h2", "size")
            met = whole.union(rest).repartition("text").sortWithinPartitions("text")
            if k < rounds - 1:
                found = met.mapInArrow(pool, f"text long, {_TEXT}, size long, sums binary")
        return met.mapInArrow(chained(pool, means, *([then] if then else [])), f"{_TEXT}, {shape}")


def _tails(rounds: int) -> list[str]:
    return [f"tail{k}" for k in range(rounds)]


def _round(word: str, rounds: int) -> F.Column:
    """The round of a word: its hash, taken as unsigned, modulo the number of rounds, a power of two."""
    return F.col(word).bitwiseAND(F.lit(rounds - 1))


def text_key(text: str) -> list[F.Column]:
    """Two hashes that name a text; null is as empty."""
    text = F.coalesce(F.col(text), F.lit(""))
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")]


@dataclass
class Network:
    """Two layers and a temperature over standardised inputs."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum((x - self.mean) / self.scale @ self.w1 + self.b1, 0)
        return hidden @ self.w2 + self.b2

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -500, 500)))


def train(x: np.ndarray, y: np.ndarray, rounds: int = 400, rate: float = 0.01, decay: float = 1e-3) -> Network:
    """Fit on four fifths of the rows, the temperature on the rest."""
    rng = np.random.RandomState(5)
    if not len(y):
        x, y = np.zeros((1, DIMENSIONS)), np.array([0.5])
    fold = np.arange(len(y)) % 5 == 4
    if not fold.any():
        fold[:] = False
    a, t = x[~fold], y[~fold]
    net = Network(
        a.mean(axis=0), a.std(axis=0) + 1e-6, rng.standard_normal((x.shape[1], HIDDEN)) * (2 / x.shape[1]) ** 0.5, np.zeros(HIDDEN),
        rng.standard_normal(HIDDEN) * (1 / HIDDEN) ** 0.5, float(np.log((t.sum() + 1) / (len(t) - t.sum() + 1))),
    )
    z = (a - net.mean) / net.scale
    parts = [net.w1, net.b1, net.w2, np.array([net.b2])]
    first, second = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    for k in range(1, rounds + 1):
        hidden = np.maximum(z @ parts[0] + parts[1], 0)
        gap = (1 / (1 + np.exp(-np.clip(hidden @ parts[2] + parts[3], -500, 500))) - t) / len(t)
        back = gap[:, None] * parts[2][None, :] * (hidden > 0)
        slopes = [z.T @ back + decay * parts[0], back.sum(axis=0), hidden.T @ gap + decay * parts[2], np.array([gap.sum()])]
        for p, slope, m, v in zip(parts, slopes, first, second):
            m += 0.1 * (slope - m)
            v += 0.001 * (slope * slope - v)
            p -= rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = parts[0], parts[1], parts[2], float(parts[3][0])
    if fold.any():
        logits, held = net.logits(x[fold]), y[fold]
        loss = lambda c: np.mean(np.logaddexp(0, logits / c) - held * logits / c)
        net.temperature = float(min(np.exp(np.linspace(-2, 3, 101)), key=loss))
    return net


def score_rows(net, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The score of each row's text in place of its vector."""
    for batch in batches:
        scores = net.value.probabilities(_floats(batch.column("x")))
        yield pa.RecordBatch.from_arrays([batch.column("h1"), batch.column("h2"), pa.array(scores)], names=["h1", "h2", "_score"])


def fit(docs: DataFrame, labels: DataFrame, scratch: Scratch, label: str = "quality"):
    """Word vectors, learnt from all documents, and a network, learnt from those with a label (0 or 1)."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("double").alias("label")
    )
    share = min(1.0, SAMPLE / max(1, known.count()))
    picked = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    picked = picked.groupBy("doc_id").agg(F.max("label").alias("label"))
    # The sample's ids are few by their number's bound.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(picked), "doc_id")
    sample = scratch.table(texts, "sample")
    vectors = WordVectors(docs, scratch)
    # One round shuffles as many words as all rounds together, but reads their table and pools the texts once.
    found = vectors.pooled(sample, rounds=1).dropDuplicates(["h1", "h2"])
    rows = sample.select("doc_id", "label", *text_key("text")).join(found, ["h1", "h2"])
    rows = rows.select("doc_id", "h1", "h2", "label", "x").toArrow().sort_by([(c, "ascending") for c in ("doc_id", "h1", "h2")])
    del found
    scratch.release()
    return vectors, train(_floats(rows.column("x")), rows.column("label").to_numpy())


def scored(docs: DataFrame, model, keep: list[str]) -> DataFrame:
    """The columns named in ``keep`` and the score of each row's whole text, as ``_score``.

    A null, empty or wordless text has the score of the zero vector. Without any labelled
    document every score is near one half.
    """
    vectors, net = model
    net = docs.sparkSession.sparkContext.broadcast(net)
    scores = vectors.pooled(docs, then=narrow(score_rows, net), shape="_score double")
    scores = vectors.scratch.table(scores.groupBy("h1", "h2").agg(F.max("_score").alias("_score")), "scores").toDF("_h1", "_h2", "_score")
    vectors.scratch.release()
    h1, h2 = text_key("text")
    # Kept columns lie in a struct, where their names meet no others.
    row = F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row")
    source = docs.select(row, h1.alias("_h1"), h2.alias("_h2"))
    return source.join(scores, ["_h1", "_h2"]).select(*(F.col(f"row.`{c}`").alias(c) for c in keep), "_score")
