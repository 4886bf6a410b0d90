"""Phrases whose words come together more often than chance, by weighted acyclic automata.

A phrase that occurs often enough has no rarer part. A first pass therefore counts hashes of words
and word pairs, and the frequent ones set bits in a map of fixed size. A second pass does the same
for three words whose pairs the map lets through: in a large table most pairs are frequent, while
most chains of them occur once. The third pass takes the words, pairs and chains of threes that the
map lets through: each task sorts its phrases and builds count transducers from them, one per range
of two-word prefixes. They are dealt by range, where their union sums the weights. The parts of the
candidates are looked up where their prefix lies, by composing a transducer of all parts asked for
with that of the counts. The map goes by the leading 40 bits of a hash: hashes that share them let
more through, never less.

Labels are 64-bit hashes of the words, a phrase is the sequence of them behind its language's;
a count would be wrong only if two different words that both occur often had one hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditflow.llm.automata import Counted, CountTransducer, build, composed, union
from creditflow.llm.scratch import Scratch, narrow, reusing, whole_groups
from creditflow.llm.text import BLOCK_BYTES, ENDS, Words, blocks, hash_order, mix, utf8, words

#: Bits of the map of frequent words, pairs and threes (16 MB), and of one part of it.
MAP_BITS, PART_BITS = 27, 17
#: Hashes, and phrases, that a task counts before it sends them on.
HELD_HASHES, HELD_PHRASES = 1 << 22, 1 << 20
#: Prefix ranges per square root of the GB of text.
RANGES = 64
#: Transducers of one range that are united at once, at least.
UNITED = 16
#: The greatest count that is packed in the low bits of a hash.
_MOST = (1 << 24) - 1
_U = np.uint64
_NEXT = _U(0x9E3779B97F4A7C15)
_ENDS = np.zeros(256, dtype=np.int32)
_ENDS[[b for span in ENDS for b in span]] = 1
_TRANSDUCER = "range int, weights array<long>, first array<int>, labels array<long>, targets array<int>"
_NAME = "h long, name string"


def segments(data: np.ndarray, offsets: np.ndarray, size: int = BLOCK_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of texts of which the long ones are cut where pieces end, and the text that each is of."""
    cuts = []
    for t in np.flatnonzero(np.diff(offsets) > size):
        ends = offsets[t] + np.flatnonzero(_ENDS[data[offsets[t] : offsets[t + 1]]])
        at = offsets[t] + size
        while (k := np.searchsorted(ends, at)) < len(ends):
            cuts.append(ends[k])
            at = ends[k] + size
    parts = np.sort(np.concatenate([offsets, np.array(cuts, dtype=offsets.dtype)]))
    return parts, np.searchsorted(offsets, parts[:-1], side="right") - 1


def lang_hashes(names: list[str]) -> np.ndarray:
    return np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in names], dtype=np.uint64)


def _word_blocks(batch: pa.RecordBatch, names: dict[str, int]) -> Iterator[tuple[Words, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of words, with the language of each word as a number and a hash, and whether the next word goes on its piece."""
    data, offsets = utf8(batch.column("text"))
    parts, owner = segments(data, offsets)
    column = pa.LargeStringArray.from_buffers(len(parts) - 1, pa.py_buffer(parts.astype(np.int64)), pa.py_buffer(data)) if len(parts) > 1 else None
    langs = batch.column("lang").cast(pa.string()).fill_null("und").to_pylist()
    number = np.array([names.setdefault(x, len(names)) for x in langs], dtype=np.int64)
    hashes = lang_hashes(list(names))
    for at, to, own, places in blocks(column) if column is not None else ():
        found = words(own, places, "piece_lower")
        if not len(found.hashes):
            continue
        of = np.repeat(number[owner[at:to]], np.diff(found.first))
        text = np.repeat(np.arange(at, to), np.diff(found.first))
        ended = np.concatenate([[0], np.cumsum(_ENDS[own], dtype=np.int32)])
        goes_on = np.zeros(len(of), dtype=bool)
        goes_on[:-1] = (text[1:] == text[:-1]) & (ended[found.starts[1:]] == ended[found.ends[:-1]])
        yield found, of, hashes[of], goes_on


def _hashes(found: Words, lang: np.ndarray, goes_on: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words, and of the pairs of a word and its next (void where the piece ends)."""
    single = mix(found.hashes ^ lang)
    pair = np.zeros_like(single)
    pair[:-1] = mix(single[:-1] * _NEXT + found.hashes[1:])
    return single, pair


def _passed(found: Words, goes_on: np.ndarray, pair: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which words begin a pair that the map lets through, and where two such pairs stand in a row, with the hash of the three words."""
    chained = goes_on & _set(bits, pair)
    at = np.flatnonzero(chained[:-1] & chained[1:])
    return chained, at, mix(pair[at] * _NEXT + found.hashes[at + 2])


def _packed(keys: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Numbers of the leading bits of a hash and its count; a count beyond its bits takes several."""
    if len(n) and n.max() > _MOST:
        times = -(-n // _MOST)
        keys, rest = np.repeat(keys, times), n - (times - 1) * _MOST
        n = np.full(len(keys), _MOST, dtype=np.int64)
        n[np.cumsum(times) - 1] = rest
    return (keys & ~_U(_MOST)) | n.astype(np.uint64)


def _summed(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The leading bits of the hashes, each once and in order, and their counts; sorts ``packed``."""
    packed.sort()
    first = np.flatnonzero(np.concatenate([[True], (packed[1:] ^ packed[:-1]) > _U(_MOST)])) if len(packed) else np.empty(0, np.int64)
    keys = packed[first] & ~_U(_MOST)
    packed &= _U(_MOST)
    return keys, np.add.reduceat(packed.view(np.int64), first) if len(first) else np.empty(0, np.int64)


def count_hashes(most: int, parts: int, bits, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each hash occurs in the task's texts, packed, a row for each of the ``parts`` of the map.

    Counted are words and pairs or, with the map of these, three words whose pairs it lets through.
    """
    held, new, size, names = np.empty(0, np.uint64), [], 0, {}

    def rows(packed):
        bounds = np.append(np.searchsorted(packed, np.array([(k << 64) // parts for k in range(parts)], dtype=np.uint64)), len(packed))
        some = np.flatnonzero(np.diff(bounds))
        offsets = (8 * np.append(bounds[some], len(packed))).astype(np.int32)
        counts = pa.BinaryArray.from_buffers(pa.binary(), len(some), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])
        whole = pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), counts], names=["part", "counts"])
        for k in range(0, len(some), 64):
            yield whole.slice(k, 64)

    def sums():
        return _packed(*_summed(np.concatenate([held, *new])))

    for batch in batches:
        for found, _, lang, goes_on in _word_blocks(batch, names):
            single, pair = _hashes(found, lang, goes_on)
            if bits is None:
                own = np.concatenate([single, pair[goes_on]])
            else:
                _, _, own = _passed(found, goes_on, pair, bits.value)
            new.append((own & ~_U(_MOST)) | _U(1))
            size += len(own)
            if size > most:
                held, new, size = sums(), [], 0
                if len(held) > most // 2:
                    yield from rows(held)
                    held = held[:0].copy()
    if len(held) or size:
        yield from rows(sums())


def map_parts(least: int, most: int, parts: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ``parts`` of the bit map with the bits of hashes that occur ``least`` times, from rows sorted by part."""
    now, held, size, line = None, [], 0, most
    shift = _U(65 - parts.bit_length() - PART_BITS)

    def row():
        keys, n = _summed(np.concatenate(held))
        own = np.zeros(1 << PART_BITS, dtype=bool)
        own[(keys[n >= least] >> shift) & _U((1 << PART_BITS) - 1)] = True
        bits = np.packbits(own, bitorder="little").tobytes()
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([bits], pa.binary())], names=["part", "bits"])

    for batch in batches:
        part, counts = batch.column("part").to_numpy(), batch.column("counts").cast(pa.large_binary())
        _, offsets, data = counts.buffers()
        offsets = np.frombuffer(offsets, dtype=np.int64)[counts.offset : counts.offset + len(counts) + 1]
        new = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else []
        for s, e in zip(new, [*new[1:], len(part)]):
            if part[s] != now:
                if held:
                    yield row()
                now, held, size, line = int(part[s]), [], 0, most
            n = int(offsets[e] - offsets[s]) // 8
            held.append(np.frombuffer(data, dtype=np.uint64, count=n, offset=int(offsets[s])).copy())
            size += n
            if size > line:
                held = [_packed(*_summed(np.concatenate(held)))]
                size = len(held[0])
                line = max(most, 2 * size)
    if held:
        yield row()


def _set(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes >> _U(65 - (8 * len(bits)).bit_length())
    return (bits[at >> _U(3)] >> (at & _U(7)).astype(np.uint8)) & np.uint8(1) > 0


def frequent_map(docs: DataFrame, scratch: Scratch, least: int, bits=None) -> np.ndarray:
    """A bit map with the bits of all words and pairs of ``docs`` that occur ``least`` times.

    Where ``bits`` has that map as a broadcast, one of three words in a row instead.
    """
    parts = 1 << (MAP_BITS - PART_BITS)
    counted = docs.mapInArrow(reusing(narrow(count_hashes, HELD_HASHES, parts, bits)), "part int, counts binary")
    dealt = counted.repartition("part").sortWithinPartitions("part")
    # As many rows of fixed size as there are parts.
    rows = scratch.table(dealt.mapInArrow(reusing(narrow(map_parts, least, HELD_HASHES, parts)), "part int, bits binary"), "map").toArrow()
    made = np.zeros((parts, 1 << (PART_BITS - 3)), dtype=np.uint8)
    for part, own in zip(rows.column("part").to_pylist(), rows.column("bits").to_pylist()):
        made[part] = np.frombuffer(own, dtype=np.uint8)
    return made.ravel()


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each hash once, the first place where it stands, and how often."""
    order = hash_order(keys)
    own = keys[order]
    first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(keys) else np.empty(0, np.int64)
    return own[first], order[first], np.diff(first, append=len(keys))


class _Phrases:
    """A task's phrases with their counts, and the words in them."""

    def __init__(self, longest: int, most: int):
        self.longest, self.most = longest, most
        self.held: list[tuple[np.ndarray, Counted]] = []
        self.known, self.names = np.empty(0, np.uint64), []

    def add(self, found: Words, lang: np.ndarray, goes_on: np.ndarray, bits: np.ndarray) -> None:
        single, pair = _hashes(found, lang, goes_on)
        chained, three, key = _passed(found, goes_on, pair, bits)
        # Whether three words in a row are frequent; longer phrases consist of such.
        going = np.zeros(len(chained), dtype=bool)
        going[three[_set(bits, key)]] = True
        frequent = np.flatnonzero(_set(bits, single))
        self._name(found, np.flatnonzero(chained | np.concatenate([[False], chained[:-1]])))
        langs, n = np.unique(lang, return_counts=True)
        taken = [(mix(langs), np.searchsorted(langs, langs), np.zeros(len(langs), np.int64), n)]
        own, where, n = _distinct(single[frequent])
        taken.append((own, frequent[where], np.ones(len(own), np.int64), n))
        # The parts that a phrase consists of are frequent.
        at = np.flatnonzero(chained)
        key = single[at]
        for size in range(2, self.longest + 1):
            key = mix(key * _NEXT + found.hashes[at + size - 1])
            own, where, n = _distinct(key)
            taken.append((own, at[where], np.full(len(own), size), n))
            on = going[at + size - 2]
            at, key = at[on], key[on]
        key, at, size, n = (np.concatenate(side) for side in zip(*taken))
        labels = np.zeros((len(key), self.longest + 1), dtype=np.uint64)
        labels[:, 0] = lang[at]
        labels[: len(langs), 0] = langs
        for k in range(1, self.longest + 1):
            has = size >= k
            labels[has, k] = found.hashes[at[has] + k - 1]
        self.held.append((key, Counted(labels, n)))
        if sum(len(x) for x, _ in self.held) > self.most:
            self._merge()

    def _name(self, found: Words, at: np.ndarray) -> None:
        """Words of pairs that were not met before, with their hashes."""
        h, where, _ = _distinct(found.hashes[at])
        place = np.searchsorted(self.known, h)
        old = place < len(self.known)
        old[old] = self.known[place[old]] == h[old]
        self.names += [(x, found.run(0, i, i + 1).lower().decode()) for x, i in zip(h[~old].view(np.int64).tolist(), at[where[~old]].tolist())]
        self.known = np.insert(self.known, place[~old], h[~old])

    def _merge(self) -> None:
        """Phrases of one hash become one."""
        key = np.concatenate([x for x, _ in self.held])
        rows = Counted.joined([x for _, x in self.held])
        order = hash_order(key)
        key = key[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        self.held = [(key[first], Counted(rows.labels[order[first]], np.add.reduceat(rows.n[order], first)))]

    @property
    def full(self) -> bool:
        return len(self.held) == 1 and len(self.held[0][0]) > self.most // 2

    def rows(self, ranges: int) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        self._merge()
        ((_, rows),) = self.held
        of = prefix_ranges(rows.labels, ranges)
        order = np.argsort(of, kind="stable")
        of, rows = of[order], rows[order]
        bounds = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1], [True]]))
        for s, e in zip(bounds, bounds[1:]):
            yield transducer_row(int(of[s]), build(rows[slice(s, e)].sorted()))
        self.held = []

    def name_rows(self) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(self.names), 4096):
            h, names = zip(*self.names[k : k + 4096])
            yield pa.RecordBatch.from_arrays([*(pa.nulls(len(h), f.type) for f in _ROW), pa.array(h, pa.int64()), pa.array(names, pa.string())], schema=_ROWS)


_ROW = pa.schema(
    [("range", pa.int32()), ("weights", pa.list_(pa.int64())), ("first", pa.list_(pa.int32())), ("labels", pa.list_(pa.int64())), ("targets", pa.list_(pa.int32()))]
)
_ROWS = pa.schema([*_ROW, ("h", pa.int64()), ("name", pa.string())])


def prefix_ranges(labels: np.ndarray, ranges: int) -> np.ndarray:
    """The range of phrases: of their language and two words at most."""
    key = np.zeros(len(labels), dtype=np.uint64)
    for column in labels[:, :3].T:
        key = np.where(column != 0, mix(key * _NEXT + column), key)
    return (key % _U(ranges)).astype(np.int32)


def transducer_row(r: int, made: CountTransducer) -> pa.RecordBatch:
    lists = [pa.array([x], kind) for x, kind in zip((made.weights, made.first, made.labels.view(np.int64), made.targets), [f.type for f in _ROW][1:])]
    return pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), *lists, pa.nulls(1, pa.int64()), pa.nulls(1, pa.string())], schema=_ROWS)


def transducers(rows: pa.RecordBatch | pa.Table, width: int) -> Iterator[tuple[int, CountTransducer]]:
    for batch in rows.to_batches() if isinstance(rows, pa.Table) else [rows]:
        for k in range(batch.num_rows):
            weights, first, labels, targets = (batch.column(c)[k].values.to_numpy() for c in ("weights", "first", "labels", "targets"))
            yield batch.column("range")[k].as_py(), CountTransducer(weights, first.astype(np.int64), labels.view(np.uint64), targets.astype(np.int64), width)


def count_phrases(bits, ranges: int, longest: int, most: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Transducers of the task's phrases that the map lets through, and the names of words and languages."""
    held, names = _Phrases(longest, most), {}
    for batch in batches:
        for found, _, lang, goes_on in _word_blocks(batch, names):
            held.add(found, lang, goes_on, bits.value)
            if held.full:
                yield from held.rows(ranges)
    yield from held.rows(ranges)
    yield from held.name_rows()
    if names:
        h = [int(x) for x in lang_hashes(list(names)).view(np.int64)]
        yield pa.RecordBatch.from_arrays([*(pa.nulls(len(h), f.type) for f in _ROW), pa.array(h, pa.int64()), pa.array(list(names), pa.string())], schema=_ROWS)


def unite(least: int, most: int, width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One transducer per range with the phrases of at least ``least`` occurrences, from rows sorted by range.

    What was united waits until as much has come again, so that no phrase is taken along more than
    a few times however many transducers a range has.
    """
    now, held, new = None, [], 0
    for batch in batches:
        for r, part in transducers(batch, width):
            if r != now and held:
                yield transducer_row(now, union(held, least))
                held = []
            if r != now:
                now, new, line = r, 0, 0
            held.append(part)
            new += len(part.labels)
            if len(held) >= most and new >= line:
                held = [union(held)]
                new, line = 0, len(held[0].labels)
    if held:
        yield transducer_row(now, union(held, least))


def _lists(labels: np.ndarray) -> pa.ListArray:
    """Rows of equal length as a list column."""
    offsets = np.arange(len(labels) + 1, dtype=np.int32) * labels.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(labels).view(np.int64).ravel()))


def cut_candidates(ranges: int, width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each phrase of two words or more with each of its cuts, and the ranges of its parts."""
    for batch in batches:
        for _, counts in transducers(batch, width):
            found = counts.counted()
            sizes = found.sizes
            for m in range(3, width + 1):
                rows = found[sizes == m]
                for s in range(0, len(rows), 4096):
                    own = rows[slice(s, s + 4096)]
                    lang = own.labels[:, :1]
                    for k in range(2, m):
                        head, tail = own.labels[:, :k], np.hstack([lang, own.labels[:, k:m]])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(lang.ravel().view(np.int64)), _lists(own.labels[:, 1:m]), pa.array(own.n), pa.array(np.full(len(own), k - 1, np.int32)),
                             _lists(head[:, 1:]), _lists(tail[:, 1:]), pa.array(prefix_ranges(head, ranges)), pa.array(prefix_ranges(tail, ranges)), pa.array(prefix_ranges(lang, ranges))],
                            names=["lang", "words", "a", "k", "head", "tail", "head_range", "tail_range", "lang_range"],
                        )


def look_up(width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts of the parts asked for, from rows sorted by range."""
    for table, bounds in whole_groups(batches, ["range"]):
        for s, e in zip(bounds, [*bounds[1:], table.num_rows]):
            group = table.slice(s, e - s).combine_chunks()
            asks = group.column("weights").is_null()
            asked = group.filter(asks)
            part = asked.column("part").combine_chunks()
            size = np.diff(part.offsets.to_numpy())
            labels = np.zeros((len(asked), width), dtype=np.uint64)
            labels[:, 0] = asked.column("lang").to_numpy().view(np.uint64)
            row = np.repeat(np.arange(len(size)), size)
            labels[row, 1 + np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)] = part.flatten().to_numpy().view(np.uint64)
            parts = build(Counted(labels, np.ones(len(labels), dtype=np.int64)).summed().sorted())
            for _, counts in transducers(group.filter(group.column("weights").is_valid()), width):
                found = composed(parts, counts)
                sizes = found.sizes
                for m in np.unique(sizes).tolist():
                    own = found[sizes == m]
                    lang = pa.array(own.labels[:, 0].copy().view(np.int64))
                    yield pa.RecordBatch.from_arrays([lang, _lists(own.labels[:, 1:m]), pa.array(own.n)], names=["lang", "part", "f"])


def collocations(docs: DataFrame, scratch: Scratch, least: int = 100, longest: int = 5, top: int = 2000) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)`` of the ``top`` phrases of each language.

    Texts have A-Z lowered and are cut into pieces at ``.,;:!?`` and line ends; words are what
    blanks and tabs separate. Phrases have 2 to ``longest`` (at least 2) words of one piece and
    occur ``a >= least`` times, overlaps included. Of its cuts in two parts that occur l and r
    times, the one of least ``floor(1000 a n / (l r))`` counts, the first of those that tie; n is
    the number of words of the language. A phrase within a longer one that occurs as often is
    dropped. Ranked are score and a, the greatest first, then the phrase. Null texts are empty, a
    null lang is ``und``; other columns are ignored. Only the piece is never cut: memory holds the longest one.
    """
    docs = docs.select(F.col("text").cast("string").alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = int(RANGES * max(1, np.ceil(np.sqrt(size / 1e9))))
    send = docs.sparkSession.sparkContext.broadcast
    bits = send(frequent_map(docs, scratch, least))
    scratch.release()
    if longest > 2:
        whole = bits.value | frequent_map(docs, scratch, least, bits)
        bits.destroy()
        bits = send(whole)
        scratch.release()
    width = longest + 1
    shards = docs.mapInArrow(reusing(narrow(count_phrases, bits, ranges, longest, HELD_PHRASES)), f"{_TRANSDUCER}, {_NAME}")
    shards = scratch.table(shards, "shards")
    own = shards.where("weights is not null").repartition("range").sortWithinPartitions("range")
    counts = scratch.table(own.mapInArrow(reusing(narrow(unite, least, UNITED, width)), f"{_TRANSDUCER}, {_NAME}").drop("h", "name"), "counts")
    names = scratch.table(shards.where("name is not null").groupBy("h").agg(F.min("name").alias("name")), "names")
    shape = "lang long, words array<long>, a long, k int, head array<long>, tail array<long>, head_range int, tail_range int, lang_range int"
    cuts = scratch.table(counts.mapInArrow(reusing(narrow(cut_candidates, ranges, width)), shape), "cuts")
    none = F.array().cast("array<long>")
    parts = F.explode(F.array(*(F.struct(F.col(r).alias("range"), p.alias("part")) for r, p in (("head_range", F.col("head")), ("tail_range", F.col("tail")), ("lang_range", none)))))
    asked = cuts.select("lang", parts.alias("p")).select("p.range", "lang", "p.part").distinct()
    met = counts.unionByName(asked, allowMissingColumns=True).repartition("range").sortWithinPartitions("range")
    answers = scratch.table(met.mapInArrow(reusing(narrow(look_up, width)), "lang long, part array<long>, f long"), "answers")
    heads = answers.select("lang", F.col("part").alias("head"), F.col("f").alias("l"))
    tails = answers.select("lang", F.col("part").alias("tail"), F.col("f").alias("r"))
    totals = answers.where(F.size("part") == 0).select("lang", F.col("f").alias("n"))
    cuts = cuts.select("lang", "words", "a", "k", "head", "tail")
    cuts = scratch.table(cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).join(totals, "lang"), "answered")
    # Of the longer phrases that hold a phrase it is enough to look at those with one word more.
    whole = F.array(*(F.struct(F.col(p).alias("part"), F.col(f).alias("f")) for p, f in (("head", "l"), ("tail", "r"))))
    inner = cuts.select("lang", "a", F.size("words").alias("m"), F.explode(whole).alias("x")).where((F.size("x.part") == F.col("m") - 1) & (F.col("m") > 2))
    inner = inner.where(F.col("a") >= F.col("x.f")).select("lang", F.col("x.part").alias("words")).distinct()
    exact = lambda c, digits: F.col(c).cast(f"decimal({digits},0)")
    cuts = cuts.withColumns({"over": exact("a", 18) * 1000 * exact("n", 15), "under": exact("l", 18) * exact("r", 18)})
    scored = cuts.withColumn("score", F.expr("over div under"))
    best = scored.groupBy("lang", "words").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"), F.first("a").alias("a"), F.first("n").alias("n"))
    best = scratch.table(best.join(inner, ["lang", "words"], "left_anti"), "best")
    spoken = best.select("lang", "words", F.posexplode("words").alias("at", "h")).join(names, "h")
    spoken = spoken.groupBy("lang", "words").agg(F.array_sort(F.collect_list(F.struct("at", "name"))).alias("said"))
    spoken = spoken.select("lang", "words", F.array_join("said.name", " ").alias("phrase"))
    langs = names.select(F.col("h").alias("lang"), F.col("name").alias("language"))
    best = best.join(spoken, ["lang", "words"]).join(langs, "lang")
    best = best.select(F.col("language").alias("lang"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
