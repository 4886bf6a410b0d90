"""Near-duplicate documents by MinHash bands, odd sketches and an exact check.

A document's set holds its distinct shingles of ``width`` words (with fewer words, the whole
sequence as one). MinHash samples give bands, which find candidates. One-permutation MinHash
samples (the least hash in each of ``BINS`` parts of the hash range) are folded into a parity
bitmap, the odd sketch: the population count of two sketches' XOR estimates how many samples
differ, very precisely where sets are alike, so that few candidates reach the check on full sets.

Groups are never expanded into pairs. Documents with equal sets are one class, found by
aggregation. In each bucket the member that shares most buckets is the centre, and the others
are checked against it; after that only pairs of a bucket whose members are still in different
components are tried, all of them, behind the sketch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditflow.llm import text as T
from creditflow.llm.graph import components
from creditflow.llm.scratch import Scratch, narrow, whole_groups

#: 32 bands of 4 samples lose a pair of similarity 0.8 with odds of 5e-8.
BANDS, ROWS = 32, 4
BINS = 4096
SKETCH_WORDS = 32  # 64 bits each
#: A linked pair is lost to the sketch only if it is off by more standard deviations than this.
SIGMAS = 4.5
WIDTH = 5
_U = np.uint64

_rng = np.random.RandomState(20240501)
_MUL = _rng.randint(0, 2**63, BANDS * ROWS, dtype=np.int64).astype(np.uint64) * _U(2) + _U(1)
_ADD = _rng.randint(0, 2**63, BANDS * ROWS, dtype=np.int64).astype(np.uint64)

SIGNATURE = pa.schema(
    [(c, pa.int64()) for c in ("doc_id", "n", "f1", "f2")]
    + [("sketch", pa.binary()), ("bands", pa.list_(pa.int64()))]
)
_SIGNATURE_DDL = "doc_id long, n long, f1 long, f2 long, sketch binary, bands array<long>"
_PAIR_DDL = "a long, b long, na long, nb long"
#: Members of a bucket that one task compares with as many others at a time.
BLOCK = 512


def shingle_sets(w: T.Words, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, end to end, and where each set starts."""
    sizes = np.diff(w.first)
    runs = w.runs(width)
    sets, n_texts = [], len(sizes)
    for i in range(n_texts):
        a, n = w.first[i], sizes[i]
        if n >= width:
            sets.append(np.unique(runs[a : a + n - width + 1]))
        elif n:
            h = w.hashes[a : a + n]
            seed = np.array([n], dtype=np.uint64)
            for x in h:
                seed = T.mix(seed * _U(0x9E3779B97F4A7C15) + x)
            sets.append(seed)
        else:
            sets.append(h0)
    bounds = np.zeros(n_texts + 1, dtype=np.int64)
    np.cumsum([len(s) for s in sets], out=bounds[1:])
    return (np.concatenate(sets) if sets else h0), bounds


h0 = np.empty(0, dtype=np.uint64)


def odd_sketches(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Parity bitmaps of the sets that start at ``begin``; each set's hashes are sorted."""
    bits = SKETCH_WORDS * 64
    part = (values // _U(2**64 // BINS)).astype(np.int64)
    sample = np.ones(len(values), dtype=bool)
    sample[1:] = part[1:] != part[:-1]
    sample[begin] = True
    at = np.flatnonzero(sample)
    text = np.searchsorted(begin, at, side="right") - 1
    place = (T.mix(values[at] ^ _U(0x2545F4914F6CDD1D)) % _U(bits)).astype(np.int64)
    parity = np.bincount(text * bits + place, minlength=len(begin) * bits) & 1
    return np.packbits(parity.astype(np.uint8).reshape(len(begin), bits), axis=1).view(np.uint64)


def signatures(width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Set size, fingerprint of the set, odd sketch and band keys of each text."""
    for batch in batches:
        for at, to, w in T.word_blocks(batch.column("text"), "blank_lower"):
            values, bounds = shingle_sets(w, width)
            sizes = np.diff(bounds)
            full = np.flatnonzero(sizes)
            n = to - at
            f1, f2 = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
            sketch = np.zeros((n, SKETCH_WORDS), np.uint64)
            bands = np.zeros((n, BANDS), np.uint64)
            if len(full):
                begin = bounds[:-1][full]
                f1[full] = np.add.reduceat(T.mix(values), begin)
                f2[full] = np.add.reduceat(T.mix(values ^ _U(0x5851F42D4C957F2D)), begin)
                keys = np.zeros((len(full), BANDS), np.uint64)
                for k in range(BANDS * ROWS):
                    x = values * _MUL[k] + _ADD[k]
                    x ^= x >> _U(32)
                    least = np.minimum.reduceat(x, begin)
                    band = k // ROWS
                    keys[:, band] = T.mix(keys[:, band] ^ least ^ _U(band + 1))
                bands[full] = keys
                sketch[full] = odd_sketches(values, begin)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(n + 1, dtype=np.int32) * BANDS), pa.array(bands.reshape(-1).view(np.int64))
            )
            packed = pa.Array.from_buffers(
                pa.binary(), n, [None, pa.py_buffer(np.arange(n + 1, dtype=np.int32) * (SKETCH_WORDS * 8)), pa.py_buffer(sketch)]
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(at, n), pa.array(sizes), pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)), packed, lists],
                schema=SIGNATURE,
            )


def common(width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size of the intersection of the full sets of each pair of texts."""
    for batch in batches:
        size = T.BLOCK_BYTES // 2
        ends = np.maximum(T.utf8(batch.column("text_a"))[1][1:], T.utf8(batch.column("text_b"))[1][1:])
        at, n = 0, batch.num_rows
        while at < n:
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size)))
            sets = []
            for side in ("text_a", "text_b"):
                data, offsets = T.utf8(batch.column(side).slice(at, to - at))
                sets.append(shingle_sets(T.words(data, offsets, "blank_lower"), width))
            (va, ba), (vb, bb) = sets
            both = [
                len(np.intersect1d(va[ba[i] : ba[i + 1]], vb[bb[i] : bb[i + 1]], assume_unique=True))
                for i in range(to - at)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).slice(at, to - at) for c in ("a", "b", "na", "nb")] + [pa.array(both, pa.int64())],
                names=["a", "b", "na", "nb", "common"],
            )
            at = to


def may_link(na: np.ndarray, nb: np.ndarray, xor: np.ndarray, percent: int) -> np.ndarray:
    """Bounds on pairs that may link: sizes, and the XOR counts of the odd sketches.

    At similarity j a bin's least hash is common with odds j; a bin that differs adds two samples
    to the difference, or one if it is empty on one side. From the bin load follow the mean and
    a bound on the spread of the number of differing samples, and from that the XOR count.
    """
    bits, j = SKETCH_WORDS * 64, percent / 100
    load = (na + nb) / (1 + j) / BINS
    q = (1 - j) / 2
    alone = np.exp(-load) * np.expm1(load * q) / q if q else 0.0
    mean = BINS * (1 - j) * (2 * -np.expm1(-load) - alone)
    differ = mean + SIGMAS * np.sqrt(mean * np.minimum(2.0, 2 * load) + 1)
    noise = np.sqrt(np.minimum(differ * differ / bits, bits / 4))
    limit = np.minimum(differ, bits / 2 * (1 - (1 - 2 / bits) ** differ) + SIGMAS * noise)
    return (np.minimum(na, nb) * 100 >= np.maximum(na, nb) * percent) & (xor <= limit)


def _sketches(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    at = column.offset * SKETCH_WORDS * 8
    return np.frombuffer(column.buffers()[2], dtype=np.uint64, count=len(column) * SKETCH_WORDS, offset=at).reshape(-1, SKETCH_WORDS)


def behind_sketch(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs that may link."""
    for batch in batches:
        if batch.num_rows:
            na, nb = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
            xor = np.bitwise_count(_sketches(batch.column("sa")) ^ _sketches(batch.column("sb"))).sum(axis=1)
            yield batch.select(["a", "b", "na", "nb"]).filter(pa.array(may_link(na, nb, xor, percent)))


def across_components(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of each group of two blocks whose members are in different components and may link."""
    for table, bounds in whole_groups(batches, ["key", "lo", "hi"]):
        ids, n, comp, block, lo, hi = (table.column(c).to_numpy() for c in ("id", "n", "component", "block", "lo", "hi"))
        sketch = _sketches(table.column("sketch"))
        out = []
        for s, e in zip(bounds, [*bounds[1:], len(ids)]):
            left = np.arange(s, e)[block[s:e] == lo[s]]
            right = left if lo[s] == hi[s] else np.arange(s, e)[block[s:e] == hi[s]]
            step = max(1, (1 << 20) // (max(1, len(right)) * SKETCH_WORDS))
            for k in range(0, len(left), step):
                x = left[k : k + step]
                apart = comp[x][:, None] != comp[right][None, :]
                if lo[s] == hi[s]:
                    apart &= x[:, None] < right[None, :]
                i, j = np.nonzero(apart)
                if len(i) == 0:
                    continue
                xor = np.bitwise_count(sketch[x][:, None, :] ^ sketch[right][None, :, :]).sum(axis=2)
                near = may_link(n[x[i]], n[right[j]], xor[i, j], percent)
                out.append((x[i[near]], right[j[near]]))
        if out:
            x, y = (np.concatenate(side) for side in zip(*out))
            swap = ids[x] > ids[y]
            x, y = np.where(swap, y, x), np.where(swap, x, y)
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in (ids[x], ids[y], n[x], n[y])], names=["a", "b", "na", "nb"])


def near_duplicates(docs: DataFrame, scratch: Scratch, percent: int = 80, width: int = WIDTH) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for each row of ``docs``.

    Two documents link if their sets' Jaccard similarity is at least ``percent`` hundredths;
    ``component_id`` is the smallest doc_id reachable by links and ``kept`` says that it is the
    row's own. Null or wordless texts have the empty set and link with nothing. A row without
    doc_id links with nothing either and is kept, with a null component. Rows that repeat a
    doc_id are one document and share its component. Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    sig = scratch.table(rows.mapInArrow(narrow(signatures, width), _SIGNATURE_DDL), "signatures")
    usable = sig.where("n > 0 and doc_id is not null")
    # Classes of equal sets; aggregated per task, so a set that a third of all rows share is a few rows.
    classes = scratch.table(usable.groupBy("f1", "f2", "n").agg(F.min("doc_id").alias("rep")), "classes")
    members = scratch.table(
        usable.select("doc_id", "f1", "f2", "n").join(classes, ["f1", "f2", "n"]).select("doc_id", "rep"), "members"
    )
    reps = scratch.table(
        sig.join(classes.select(F.col("rep").alias("doc_id"), *(F.col(c).alias(f"r_{c}") for c in ("f1", "f2", "n"))), "doc_id")
        .where("f1 = r_f1 and f2 = r_f2 and n = r_n")
        .select("doc_id", "n", "bands", "sketch"),
        "representatives",
    )
    keyed = reps.select(F.col("doc_id").alias("id"), F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    buckets = scratch.table(keyed.join(scratch.table(shared, "shared"), "key"), "buckets")
    weight = scratch.table(buckets.groupBy("id").agg(F.sum("m").alias("weight")), "weights")
    weighed = buckets.join(weight, "id").select("key", F.struct("weight", (-F.col("id")).alias("minus")).alias("w"))
    centres = scratch.table(weighed.groupBy("key").agg((-F.max("w")["minus"]).alias("centre")), "centres")
    placed = scratch.table(buckets.join(centres, "key").select("key", "id", "centre"), "placed")

    light = reps.drop("bands")
    stars = placed.where("id <> centre").select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")).distinct()
    tried = (
        scratch.table(stars, "stars")
        .join(light.toDF("a", "na", "sa"), "a")
        .join(light.toDF("b", "nb", "sb"), "b")
        .mapInArrow(narrow(behind_sketch, percent), _PAIR_DDL)
    )
    first = scratch.table(_verified(tried, rows, scratch, percent, width, "first"), "first-links")
    found = scratch.table(components(first, scratch, "first"), "found")

    # Buckets whose members are not yet one component: all pairs across components, but for the
    # centre's, which have been tried.
    labelled = placed.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    labelled = scratch.table(labelled, "labelled")
    spans = labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("m"))
    spans = scratch.table(spans.where("lo <> hi").select("key", F.ceil(F.col("m") / BLOCK).alias("blocks")), "open")
    left = labelled.where("id <> centre").join(spans, "key").select("key", "id", "component", "blocks")
    left = scratch.table(left, "left").join(light.withColumnRenamed("doc_id", "id"), "id")
    dealt = left.withColumn("block", F.pmod(F.xxhash64("id"), "blocks")).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.select("key", "id", "n", "component", "sketch", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))
    across = dealt.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi").mapInArrow(narrow(across_components, percent), _PAIR_DDL)
    across = scratch.table(across.distinct(), "across")
    second = scratch.table(_verified(across, rows, scratch, percent, width, "second"), "second-links")
    links = first.union(second)
    grouped = scratch.table(components(links, scratch, "all"), "grouped")

    reached = scratch.table(
        members.join(grouped.withColumnRenamed("id", "rep"), "rep", "left")
        .select("doc_id", F.coalesce("component", "rep").alias("component"))
        .groupBy("doc_id")
        .agg(F.min("component").alias("component")),
        "reached",
    )
    return (
        sig.select("doc_id", "n")
        .join(reached, "doc_id", "left")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.coalesce("component", "doc_id").alias("component_id"),
            (F.col("doc_id").isNull() | (F.col("doc_id") == F.coalesce("component", "doc_id"))).alias("kept"),
        )
    )


def _verified(pairs: DataFrame, rows: DataFrame, scratch: Scratch, percent: int, width: int, name: str) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    pairs = scratch.table(pairs, f"{name}-pairs")
    wanted = pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id"))).distinct()
    wanted = scratch.table(wanted, f"{name}-wanted")
    texts = scratch.table(rows.join(wanted, "doc_id"), f"{name}-texts")
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    checked = pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "text_a", "text_b")
    checked = checked.mapInArrow(narrow(common, width), "a long, b long, na long, nb long, common long")
    return checked.where((F.col("common") * 100) >= (F.col("na") + F.col("nb") - F.col("common")) * percent).select("a", "b")
