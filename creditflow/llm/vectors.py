"""Near-duplicate vectors by an inverted multi-index.

Unit vectors are cut in two halves, each with its own codebook; the pair of nearest codes is a
vector's cell in the product grid. A query visits cells in the multi-sequence order of their
distance, here the squared distance that its two halves would have to move to enter the cell, and
stops where cells hold neighbours no more often than the target recall allows; the stop is the
larger of two: one is fitted on made-up neighbours at the threshold angle around sampled vectors,
the other on the real neighbours that some sampled vectors have among all rows. All members of visited cells are
then checked in double precision. Vectors of each length have codebooks, cells and a stop of their
own; cell numbers of all lengths lie in one sequence, so that one pass serves them all.

Equal vectors are one class, found by aggregation. A busy cell is cut into blocks, and tasks
compare blocks of queries with blocks of members; they return counts and, in place of pairs, the
links of a spanning forest of what they found.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditflow.llm.graph import components
from creditflow.llm.scratch import Scratch, narrow, whole_groups

#: The codebooks are fitted on about so many vectors; each has at most MOST_CODES codes.
SAMPLE, MOST_CODES = 8192, 256
#: Vectors per cell on average, until the codebooks have their full size.
PER_CELL = 128
TARGET_RECALL = 0.999
#: Sampled vectors whose real neighbours are searched, and steps of their distances' scale in a doubling.
SEARCHED, STEPS = 512, 64
#: Members or queries of a cell in one block.
BLOCK = 1024


def _units(column: pa.Array) -> np.ndarray:
    """The rows of a list column as unit vectors."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    if x.shape[1] == 1:
        x = np.hstack([x, np.zeros_like(x)])
    x = x / np.maximum(np.abs(x).max(axis=1, keepdims=True), 1e-300)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _codebook(x: np.ndarray, k: int, rng: np.random.RandomState) -> np.ndarray:
    """Plain k-means."""
    codes = x[rng.choice(len(x), k, replace=False)]
    for _ in range(12):
        near = _squares(x, codes).argmin(axis=1)
        sums, n = np.zeros_like(codes), np.bincount(near, minlength=k)
        np.add.at(sums, near, x)
        codes = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], codes)
    return np.unique(codes, axis=0)


def _squares(x: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=1)[:, None] - 2 * x @ codes.T + (codes * codes).sum(axis=1)[None, :]


@dataclass
class MultiIndex:
    """Two codebooks and the distance at which a query stops visiting cells."""

    codes: tuple[np.ndarray, np.ndarray]
    reach: float = 0.0
    base: int = 0  # the number of the first cell

    @classmethod
    def one_cell(cls, width: int) -> MultiIndex:
        width = max(width, 2)
        return cls((np.zeros((1, width // 2)), np.zeros((1, width - width // 2))))

    def __len__(self) -> int:
        return len(self.codes[0]) * len(self.codes[1])

    def moves(self, x: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Nearest code of each half, and the squared move that each code would take at least."""
        cut = x.shape[1] // 2
        best, moves = [], []
        for half, codes in zip((x[:, :cut], x[:, cut:]), self.codes):
            d = _squares(half, codes)
            near = d.argmin(axis=1)
            apart = np.sqrt(np.maximum(_squares(codes, codes), 0))[near]
            step = (d - d[np.arange(len(x)), near][:, None]) / (2 * np.maximum(apart, 1e-12))
            step[np.arange(len(x)), near] = 0.0
            best.append(near)
            moves.append(np.maximum(step, 0) ** 2)
        return best, moves

    def cells(self, x: np.ndarray) -> np.ndarray:
        (i, j), _ = self.moves(x)
        return self.base + i * len(self.codes[1]) + j

    def visits(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and cell of every visit.

        Codes of each half are taken in order of their moves; the cells before the stop are, for
        each code of the first half, a leading run of codes of the second.
        """
        _, (first, second) = self.moves(x)
        row_a, code_a = np.nonzero(first <= self.reach)
        order = np.argsort(second, axis=1, kind="stable")
        ranked = np.take_along_axis(second, order, axis=1)
        left = self.reach - first[row_a, code_a]
        run = (ranked[row_a] <= left[:, None]).sum(axis=1)
        rows = np.repeat(np.arange(len(row_a)), run)
        nth = np.arange(len(rows)) - np.repeat(np.cumsum(run) - run, run)
        at = row_a[rows]
        return at, self.base + code_a[rows] * len(self.codes[1]) + order[at, nth]

    def visits_cell(self, x: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Whether each row of ``x`` visits the cell beside it."""
        _, (first, second) = self.moves(x)
        n, cells = np.arange(len(x)), cells - self.base
        i, j = cells // len(self.codes[1]), cells % len(self.codes[1])
        # The same comparison as in visits(), so that both always agree.
        return (first[n, i] <= self.reach) & (second[n, j] <= self.reach - first[n, i])


def fit(sample: np.ndarray, total: int, threshold: float, recall: float = TARGET_RECALL) -> MultiIndex:
    """Codebooks for ``total`` vectors from a sample, and the stop that reaches the recall.

    The stop is the quantile, over sampled vectors, of the distance to the cell of a random
    neighbour at the threshold angle; neighbours at smaller angles are found more often.
    """
    rng = np.random.RandomState(11)
    k = int(min(MOST_CODES, max(1, np.ceil(np.sqrt(total / PER_CELL))), len(sample)))
    cut = sample.shape[1] // 2
    index = MultiIndex((_codebook(sample[:, :cut], k, rng), _codebook(sample[:, cut:], k, rng)))
    x = np.repeat(sample, 4, axis=0)
    aside = rng.standard_normal(x.shape)
    aside -= (aside * x).sum(axis=1, keepdims=True) * x
    aside /= np.maximum(np.sqrt((aside * aside).sum(axis=1, keepdims=True)), 1e-12)
    near = threshold * x + np.sqrt(1 - threshold * threshold) * aside
    _, (first, second) = index.moves(x)
    (i, j), _ = index.moves(near)
    n = np.arange(len(x))
    index.reach = float(np.quantile(first[n, i] + second[n, j], recall)) + 1e-12
    return index


def _by_length(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Each length of the vectors of a list column, with the rows that have it and their unit vectors."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    for d in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == d)
        yield d, at, _units(column if len(at) == len(column) else column.take(pa.array(at)))


def place(indexes, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The cell of each vector."""
    for batch in batches:
        if batch.num_rows:
            cells = np.empty(batch.num_rows, dtype=np.int64)
            for d, at, x in _by_length(batch.column("embedding")):
                cells[at] = indexes.value[d].cells(x)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.int64())], names=[*batch.schema.names, "cell"])


def spread(indexes, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per visit of each vector: the vector with the cell it visits."""
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            for d, own, x in _by_length(part.column("embedding")):
                rows, cells = indexes.value[d].visits(x)
                out = part.take(pa.array(own[rows]))
                yield pa.RecordBatch.from_arrays([*out.columns, pa.array(cells, pa.int64())], names=[*out.schema.names, "to"])


def compare(indexes, threshold: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Link counts of, and spanning links between, the vectors of each pair of blocks."""
    for table, bounds in whole_groups(batches, ["to", "qb", "xb"]):
        ids, query, cell = (table.column(c).to_numpy(zero_copy_only=False) for c in ("rep", "query", "cell"))
        weight = table.column("n").to_numpy()
        lengths = pc.list_value_length(table.column("embedding")).to_numpy()
        for s, e in zip(bounds, [*bounds[1:], len(ids)]):
            # A cell belongs to one length.
            index, units = indexes.value[lengths[s]], _units(table.column("embedding").slice(s, e - s))
            q, x = s + np.flatnonzero(query[s:e]), s + np.flatnonzero(~query[s:e])
            found = []
            for k in range(0, len(q), BLOCK):
                i, j = np.nonzero(units[q[k : k + BLOCK] - s] @ units[x - s].T >= threshold)
                found.append((q[k : k + BLOCK][i], x[j]))
            if not found:
                continue
            a, b = (np.concatenate(side) for side in zip(*found))
            other = ids[a] != ids[b]
            a, b = a[other], b[other]
            if not len(a):
                continue
            # Where the member doesn't visit the query's cell in turn, it learns of the link here.
            silent = np.empty(len(a), dtype=bool)
            for k in range(0, len(a), 4096):
                silent[k : k + 4096] = ~index.visits_cell(units[b[k : k + 4096] - s], cell[a[k : k + 4096]])
            gained = np.bincount(a - s, weight[b], e - s) + np.bincount(b[silent] - s, weight[a[silent]], e - s)
            names, local = np.unique(ids[s:e], return_inverse=True)
            root = _roots(len(names), local[a - s], local[b - s])
            counts = np.bincount(local, gained, len(names)).astype(np.int64)
            told = np.flatnonzero((counts > 0) | (root != np.arange(len(names))))
            yield pa.RecordBatch.from_arrays([pa.array(names[told]), pa.array(counts[told]), pa.array(names[root[told]])], names=["id", "n", "root"])


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest number that each of n numbers reaches by the links given."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], least)
        np.minimum.at(new, root[b], least)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def real_neighbours(searched, threshold: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many real neighbours of the searched vectors lie in cells at each distance, on a scale rounded up."""
    index, ids, units = searched.value
    _, (first, second) = index.moves(units)
    for batch in batches:
        if not batch.num_rows:
            continue
        x, reps = _units(batch.column("embedding")), batch.column("rep").to_numpy()
        (i, j), _ = index.moves(x)
        q, at = np.nonzero(units @ x.T >= threshold)
        other = ids[q] != reps[at]
        q, at = q[other], at[other]
        far = first[q, i[at]] + second[q, j[at]]
        levels, n = np.unique(np.ceil(np.log2(np.maximum(far, 1e-12)) * STEPS).astype(np.int64), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(levels), pa.array(n)], names=["level", "n"])


def _fitted(classes: DataFrame, total: int, threshold: float) -> MultiIndex:
    """The index of vectors of one length, fitted on a sample of them."""
    share = min(1.0, SAMPLE / total)
    sample = classes.where(F.pmod(F.xxhash64("rep"), F.lit(1 << 30)) < int(share * (1 << 30))).select("rep", "embedding").toArrow()
    if not sample.num_rows:
        sample = classes.select("rep", "embedding").limit(1).toArrow()
    sample = sample.sort_by("rep")
    units = _units(sample.column("embedding"))
    index = fit(units, total, threshold)
    some = np.random.RandomState(13).permutation(len(units))[:SEARCHED]
    searched = classes.sparkSession.sparkContext.broadcast((index, sample.column("rep").to_numpy()[some], units[some]))
    found = classes.select("rep", "embedding").mapInArrow(narrow(real_neighbours, searched, threshold), "level long, n long")
    found = sorted(tuple(r) for r in found.groupBy("level").agg(F.sum("n")).collect())
    if found:
        levels, n = np.array(found).T
        enough = np.searchsorted(np.cumsum(n), TARGET_RECALL * n.sum())
        index.reach = max(index.reach, float(2.0 ** (levels[min(enough, len(levels) - 1)] / STEPS)) + 1e-12)
    return index


def near_duplicates(vectors: DataFrame, scratch: Scratch, threshold: float = 0.95) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for each row of ``vectors``.

    Vectors link if their cosine is at least ``threshold``. ``n_links`` counts the other vectors
    linked directly, ``component_id`` is the smallest vec_id reachable. Null, empty and zero
    vectors and those with null or non-finite components link with nothing, as do rows without
    vec_id, which are kept with a null component. Vectors link with those of their own length only. Rows that repeat id and vector are one vector. Other columns are ignored.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding"))
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    sound = F.col("vec_id").isNotNull() & finite & F.exists("embedding", lambda v: v != 0)
    sound = rows.where(F.coalesce(sound, F.lit(False)))
    classes = scratch.table(
        sound.distinct().groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")), "classes"
    )
    totals = sorted(tuple(r) for r in classes.groupBy(F.size("embedding")).count().collect())
    reached = None
    if totals:
        indexes, base = {}, 0
        for d, total in totals:
            # So few vectors are one cell.
            indexes[d] = _fitted(classes.where(F.size("embedding") == d), total, threshold) if total > PER_CELL else MultiIndex.one_cell(d)
            indexes[d].base, base = base, base + len(indexes[d])
        index = vectors.sparkSession.sparkContext.broadcast(indexes)
        kind = classes.schema["embedding"].dataType.simpleString()
        placed = scratch.table(classes.mapInArrow(narrow(place, index), f"embedding {kind}, rep long, n long, cell long"), "placed")
        visits = placed.mapInArrow(narrow(spread, index), f"embedding {kind}, rep long, n long, cell long, to long")
        visits = scratch.table(visits.select("rep", "cell", "to"), "visits")
        # Blocks per cell, of members and of queries.
        members = placed.groupBy("cell").agg(F.count("*").alias("xs"))
        queries = visits.groupBy("to").agg(F.count("*").alias("qs"))
        blocks = queries.join(members, F.col("to") == F.col("cell")).select(
            "to", F.ceil(F.col("xs") / BLOCK).alias("xblocks"), F.ceil(F.col("qs") / BLOCK).alias("qblocks")
        )
        blocks = scratch.table(blocks, "blocks")
        numbers = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
        asking = (
            visits.join(blocks, "to")
            .join(placed, ["rep", "cell"])
            .select("embedding", "rep", "n", "cell", "to", F.lit(True).alias("query"), F.pmod(F.xxhash64("rep"), "qblocks").alias("qb"), numbers("xblocks").alias("xb"))
        )
        held = placed.join(blocks, F.col("cell") == F.col("to")).select(
            "embedding", "rep", "n", "cell", "to", F.lit(False).alias("query"), numbers("qblocks").alias("qb"), F.pmod(F.xxhash64("rep"), "xblocks").alias("xb")
        )
        met = asking.union(held).repartition("to", "qb", "xb").sortWithinPartitions("to", "qb", "xb")
        met = scratch.table(met.mapInArrow(narrow(compare, index, threshold), "id long, n long, root long"), "met")
        grouped = components(met.select(F.col("id").alias("a"), F.col("root").alias("b")), scratch)
        counts = scratch.table(met.groupBy("id").agg(F.sum("n").alias("links")), "counts")
        reached = scratch.table(counts.join(grouped, "id", "left"), "reached")
    own = classes.select("embedding", F.col("rep").alias("id"), "n")
    if reached is not None:
        own = own.join(reached, "id", "left")
    else:
        own = own.withColumns({"links": F.lit(0).cast("long"), "component": F.col("id")})
    own = scratch.table(
        own.select("embedding", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component_id")),
        "own",
    )
    # Rows that can link are those that were sound; others go on without a partner.
    marked = rows.withColumn("key", F.when(F.coalesce(F.col("vec_id").isNotNull(), F.lit(False)), F.col("embedding")))
    return (
        marked.join(own.withColumnRenamed("embedding", "key"), "key", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
            F.coalesce("component_id", "vec_id").alias("component_id"),
            (F.col("vec_id").isNull() | (F.col("vec_id") == F.coalesce("component_id", "vec_id"))).alias("kept"),
        )
    )
