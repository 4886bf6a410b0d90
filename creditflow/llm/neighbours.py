"""Approximate nearest neighbours by inner product: a robust-pruned directed graph per shard.

Vectors of one length and about one norm (within a factor of sqrt(2) around a power of two) are
dealt at random to shards. Each shard is a task that builds one graph: its members enter in random
order in growing rounds, each round searches the graph so far greedily from an entry point, and the
vectors visited are its proposals. Pruning keeps the nearest proposal and drops those that are, by
the factor ``RELAXED``, nearer to it than to the new member, again and again; the edges that stay
point in different directions. Edges are set in both directions, and full lists are pruned anew.

A graph needs a metric, so members get one more coordinate that makes all norms of a shard equal;
for a query, whose coordinate is 0, nearest then means largest inner product.

Each query searches every shard of its length with a beam; what a beam ends with is scored again in
double precision on the original vectors. Equal vectors are one member that carries the smallest of
their ids, as many as a result can need.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditflow.llm.scratch import Scratch, narrow, return_memory, whole_groups

#: Edges per member, proposals per member, and how much nearer an edge must be to make another needless.
DEGREE, PROPOSALS, RELAXED = 32, 64, 1.2
#: Members that a query keeps while it searches a shard, and how many of them it expands at once.
BEAM, AT_ONCE = 128, 4
#: Shards per square root of the vectors (so that searches, queries times shards, and building stay
#: in balance as tables grow), and bytes of vectors in one shard at most.
SHARDS_PER_ROOT, SHARD_BYTES = 1 / 32, 256 << 20
#: Slots of seen members that one block of searches may hold.
SEEN = 1 << 25
#: Parts of a group of equal vectors in the first of two reductions.
SALT = 32


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length of a list column, in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products row by row, summed from the first component to the last."""
    return np.add.accumulate(x * y, axis=-1)[..., -1]


@dataclass
class PrunedGraph:
    """Members (with the coordinate that evens norms) and their edges; unused edges are -1."""

    x: np.ndarray
    edges: np.ndarray
    entry: int

    def search(self, queries: np.ndarray, beam: int, visited: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Members and squared distances at the end of greedy searches, nearest first.

        With ``visited`` only members whose edges were followed count. Missing ones are -1.
        """
        n = len(self.x)
        size = max(1, min(1024, SEEN // max(n, 1)))
        parts = [self._search(queries[k : k + size], beam, visited) for k in range(0, len(queries), size)]
        if not parts:
            return np.empty((0, beam), np.int64), np.empty((0, beam))
        return tuple(np.concatenate(side) for side in zip(*parts))

    def _search(self, queries: np.ndarray, beam: int, visited: bool) -> tuple[np.ndarray, np.ndarray]:
        q, n = len(queries), len(self.x)
        rows = np.arange(q)
        seen = np.zeros((q, n + 1), dtype=bool)
        seen[:, n] = True  # stands for missing edges
        ids = np.full((q, beam), -1, dtype=np.int64)
        far = np.full((q, beam), np.inf, dtype=self.x.dtype)
        done = np.ones((q, beam), dtype=bool)
        ids[:, 0], done[:, 0], seen[:, self.entry] = self.entry, False, True
        far[:, 0] = ((queries - self.x[self.entry]) ** 2).sum(axis=1)
        while len(rows):
            # The nearest members whose edges were not followed yet.
            waiting = np.where(done[rows], np.inf, far[rows])
            k = min(AT_ONCE, beam)
            at = np.argpartition(waiting, k - 1, axis=1)[:, :k]
            open_ = np.isfinite(np.take_along_axis(waiting, at, axis=1))
            going = open_.any(axis=1)
            rows, at, open_ = rows[going], at[going], open_[going]
            if not len(rows):
                break
            done[rows[:, None], at] = True
            near = np.where(open_[:, :, None], self.edges[np.where(open_, ids[rows[:, None], at], 0)], -1).reshape(len(rows), -1)
            near[near < 0] = n
            # Each member once, also if two of the expanded ones point to it.
            near.sort(axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = n
            new = ~seen[rows[:, None], near]
            r, c = np.nonzero(new)
            to = near[r, c]
            seen[rows[r], to] = True
            d = self.x[to] - queries[rows[r]]
            more_far = np.full(near.shape, np.inf, dtype=self.x.dtype)
            more_far[r, c] = np.einsum("ij,ij->i", d, d)
            all_ids = np.hstack([ids[rows], near])
            all_far = np.hstack([far[rows], more_far])
            all_done = np.hstack([done[rows], ~new])
            best = np.argpartition(all_far, beam - 1, axis=1)[:, :beam]
            ids[rows], far[rows] = np.take_along_axis(all_ids, best, axis=1), np.take_along_axis(all_far, best, axis=1)
            done[rows] = np.take_along_axis(all_done, best, axis=1)
        if visited:
            far[~done] = np.inf
        order = np.argsort(far, axis=1, kind="stable")
        ids, far = np.take_along_axis(ids, order, axis=1), np.take_along_axis(far, order, axis=1)
        ids[~np.isfinite(far)] = -1
        return ids, far

    def prune(self, at: np.ndarray, proposed: np.ndarray) -> np.ndarray:
        """The edges that members ``at`` keep of the members proposed to each (-1: none)."""
        out = np.full((len(at), DEGREE), -1, dtype=np.int32)
        block = max(1, (1 << 22) // (proposed.shape[1] ** 2 + 1))
        for k in range(0, len(at), block):
            out[k : k + block] = self._prune(at[k : k + block], proposed[k : k + block])
        return out

    def _prune(self, at: np.ndarray, proposed: np.ndarray) -> np.ndarray:
        proposed = np.sort(proposed, axis=1)
        alive = (proposed >= 0) & (proposed != at[:, None])
        alive[:, 1:] &= proposed[:, 1:] != proposed[:, :-1]
        x = self.x[np.maximum(proposed, 0)]
        far = ((x - self.x[at][:, None, :]) ** 2).sum(axis=2)
        far[~alive] = np.inf
        order = np.argsort(far, axis=1, kind="stable")
        proposed, far = np.take_along_axis(proposed, order, axis=1), np.take_along_axis(far, order, axis=1)
        x, alive = np.take_along_axis(x, order[:, :, None], axis=1), np.isfinite(far)
        squares = (x * x).sum(axis=2)
        apart = squares[:, :, None] + squares[:, None, :] - 2 * (x @ x.transpose(0, 2, 1))
        out, kept = np.full((len(at), DEGREE), -1, dtype=np.int32), np.zeros(len(at), dtype=np.int64)
        for k in range(proposed.shape[1]):
            take = np.flatnonzero(alive[:, k] & (kept < DEGREE))
            if not len(take):
                continue
            out[take, kept[take]] = proposed[take, k]
            kept[take] += 1
            alive[take] &= RELAXED * RELAXED * apart[take, k] > far[take]
        return out


def even_norms(members: np.ndarray) -> np.ndarray:
    """The rows, scaled by one factor and lengthened by the coordinate that makes them unit vectors."""
    unit = members / (np.abs(members).max(initial=0.0) or 1.0)
    unit /= np.sqrt((unit * unit).sum(axis=1)).max(initial=0.0) or 1.0
    more = np.sqrt(np.maximum(0.0, 1.0 - (unit * unit).sum(axis=1)))
    return np.hstack([unit, more[:, None]]).astype(np.float32)


def build(members: np.ndarray, seed: int = 7) -> PrunedGraph:
    """The graph of the rows of ``members``."""
    x = even_norms(members)
    n = len(x)
    graph = PrunedGraph(x, np.full((n, DEGREE), -1, dtype=np.int32), 0)
    if not n:
        return graph
    graph.entry = int(((x - x.mean(axis=0)) ** 2).sum(axis=1).argmin())
    order = np.random.RandomState(seed).permutation(n)
    order = np.concatenate([[graph.entry], order[order != graph.entry]])
    at = 1
    while at < n:
        new = order[at : at + max(1, min(at, 1 + n // 16))]
        at += len(new)
        proposed, _ = graph.search(x[new], PROPOSALS, visited=True)
        graph.edges[new] = graph.prune(new, proposed)
        _add_back(graph, new)
    return graph


def _add_back(graph: PrunedGraph, new: np.ndarray) -> None:
    """Set the edges that lead back to ``new``; lists that would grow too long are pruned."""
    a, b = np.repeat(new, DEGREE), graph.edges[new].ravel()
    a, b = a[b >= 0], b[b >= 0]
    order = np.argsort(b, kind="stable")
    a, b = a[order], b[order]
    to, first, count = np.unique(b, return_index=True, return_counts=True)
    held = (graph.edges[to] >= 0).sum(axis=1)
    fits = held + count <= DEGREE
    place = np.arange(len(b)) - np.repeat(first, count) + np.repeat(held, count)
    easy = np.repeat(fits, count)
    graph.edges[b[easy], place[easy]] = a[easy]
    # A list takes what it can hold of proposals at a time, until none is left.
    full, first, count = to[~fits], first[~fits], count[~fits]
    step = 2 * DEGREE
    while len(full):
        some = np.minimum(count, step)
        proposed = np.full((len(full), DEGREE + step), -1, dtype=np.int64)
        proposed[:, :DEGREE] = graph.edges[full]
        row = np.repeat(np.arange(len(full)), some)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(some) - some, some)
        proposed[row, DEGREE + nth] = a[first[row] + nth]
        graph.edges[full] = graph.prune(full, proposed)
        first, count = first + some, count - some
        full, first, count = full[count > 0], first[count > 0], count[count > 0]


def graphs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The members of each shard with their edges, from rows sorted by shard."""
    for table, bounds in whole_groups(batches, ["shard"]):
        for s, e in zip(bounds, [*bounds[1:], table.num_rows]):
            part = table.slice(s, e - s).combine_chunks()
            graph = build(matrix(part.column("embedding")))
            starts = np.arange(len(part) + 1, dtype=np.int32) * DEGREE
            edges = pa.ListArray.from_arrays(pa.array(starts), pa.array(graph.edges.ravel()))
            place = np.arange(len(part), dtype=np.int32)
            out = part.append_column("place", pa.array(place)).append_column("edges", edges)
            yield from out.append_column("entry", pa.array(place == graph.entry)).to_batches(max_chunksize=4096)
    return_memory()


def search(k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ``k`` nearest rows in a shard of each query that meets it, from rows sorted by meeting."""
    for table, bounds in whole_groups(batches, ["meeting"]):
        for s, e in zip(bounds, [*bounds[1:], table.num_rows]):
            part = table.slice(s, e - s).combine_chunks()
            asks = part.column("edges").is_null()
            held, asking = part.filter(pc.invert(asks)), part.filter(asks)
            if len(held) and len(asking):
                yield from _nearest_rows(held.sort_by("place"), asking, k)
    return_memory()


def _nearest_rows(held: pa.Table, asking: pa.Table, k: int) -> Iterator[pa.RecordBatch]:
    x = matrix(held.column("embedding"))
    graph = PrunedGraph(np.empty(0), held.column("edges").combine_chunks().flatten().to_numpy().reshape(len(x), -1), 0)
    graph.entry = int(np.flatnonzero(held.column("entry").to_numpy())[0])
    graph.x = even_norms(x)
    names = held.column("ids").combine_chunks()
    first, ids = names.offsets.to_numpy() - names.offsets[0].as_py(), names.flatten().to_numpy()
    beam = max(BEAM, 2 * (k + 1))
    for at in range(0, len(asking), 256):
        part = asking.slice(at, 256)
        q, own = matrix(part.column("embedding")), part.column("query_id").to_numpy()
        unit = q / np.abs(q).max(axis=1, keepdims=True)
        unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
        found, _ = graph.search(np.hstack([unit, np.zeros((len(q), 1))]).astype(np.float32), beam)
        row, col = np.nonzero(found >= 0)
        member = found[row, col]
        score = products(x[member], q[row])
        # k + 1 classes of equal members suffice: each holds a row, and one row may be the query's own.
        row, member, score = _leading(row, score, ids[first[member]], k + 1, member)
        n = first[member + 1] - first[member]
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        row, score, vec = np.repeat(row, n), np.repeat(score, n), ids[np.repeat(first[member], n) + nth]
        other = vec != own[row]
        row, vec, score = _leading(row[other], score[other], vec[other], k, vec[other])
        yield pa.RecordBatch.from_arrays(
            [part.column("query_id").combine_chunks().take(pa.array(row)), part.column("query_key").combine_chunks().take(pa.array(row)), pa.array(vec), pa.array(score)],
            names=["query_id", "query_key", "vec_id", "score"],
        )


def _leading(row: np.ndarray, score: np.ndarray, name: np.ndarray, k: int, carried: np.ndarray):
    """Of each row the k entries of greatest score, ties to the smaller name."""
    order = np.lexsort((name, -score, row))
    row, score, carried = row[order], score[order], carried[order]
    nth = np.arange(len(row)) - np.searchsorted(row, row)
    return row[nth < k], carried[nth < k], score[nth < k]


def _sound(vectors: DataFrame) -> DataFrame:
    """Distinct (vec_id, embedding) rows that can take part; -0.0 becomes 0.0."""
    kind = vectors.schema["embedding"].dataType.elementType
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda v: v + F.lit(0).cast(kind)).alias("embedding"))
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    sound = F.col("vec_id").isNotNull() & finite & F.exists("embedding", lambda v: v != 0)
    return rows.where(F.coalesce(sound, F.lit(False)))


def _octave() -> F.Column:
    """The power of two nearest to a vector's norm."""
    most = F.array_max(F.transform("embedding", lambda v: F.abs(v.cast("double"))))
    squares = F.aggregate("embedding", F.lit(0.0), lambda s, v: s + F.pow(v.cast("double") / most, F.lit(2)))
    return F.floor(F.log2(most) + F.log2(squares) / 2 + 0.5)


def nearest(vectors: DataFrame, queries: DataFrame, scratch: Scratch, k: int = 20) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` rows of ``vectors`` found nearest to each query.

    Nearest means of largest inner product in double precision, ties to the smaller vec_id. Both
    tables hold ``vec_id`` and ``embedding``. Rows with the query's own vec_id are no candidates.
    Rows without vec_id and vectors that are null, empty, zero or hold null or non-finite
    components take no part, neither as query nor as candidate; a vector is compared with those of
    its own length. Rows that repeat id and vector count once; an id with several vectors is a
    query, and a candidate, with each. Fewer than ``k`` candidates are all returned. Other columns are ignored.
    """
    first_ids = Window.partitionBy("embedding").orderBy("vec_id")
    salted = Window.partitionBy("embedding", "salt").orderBy("vec_id")
    rows = _sound(vectors).withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALT)))
    # Equal rows rank alike, so k + 1 different ids stay of each class.
    least = rows.withColumn("nth", F.dense_rank().over(salted)).where(F.col("nth") <= k + 1).select("embedding", "vec_id", "salt").distinct()
    least = least.withColumn("nth", F.dense_rank().over(first_ids)).where(F.col("nth") <= k + 1)
    members = least.groupBy("embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    members = scratch.table(members.withColumns({"width": F.size("embedding"), "octave": _octave()}), "members")
    sizes = members.groupBy("width", "octave").agg(F.count("*").alias("n"))
    enough = F.greatest(F.ceil(F.sqrt("n") * SHARDS_PER_ROOT), F.ceil(F.col("n") * F.col("width") * 8 / SHARD_BYTES))
    before = Window.orderBy("width", "octave").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("shards", enough).withColumn("first", F.coalesce(F.sum("shards").over(before), F.lit(0)))
    sizes = scratch.table(sizes, "sizes")
    total = sizes.agg(F.sum("shards")).first()[0]
    if total is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    placed = members.join(sizes, ["width", "octave"]).select(
        "width", (F.col("first") + F.pmod(F.xxhash64("embedding"), "shards")).cast("int").alias("shard"), "ids", "embedding"
    )
    kind = members.schema["embedding"].dataType.simpleString()
    dealt = placed.repartitionById(total, "shard").sortWithinPartitions("shard")
    shape = f"width int, shard int, ids array<long>, embedding {kind}, place int, edges array<int>, entry boolean"
    built = scratch.table(dealt.mapInArrow(narrow(graphs), shape), "graphs")
    # Each slice of the queries of a length meets each of its shards once.
    asked = _sound(queries).distinct().withColumns({"width": F.size("embedding"), "query_key": F.xxhash64("embedding")})
    asked = scratch.table(asked.withColumnRenamed("vec_id", "query_id"), "queries")
    width = sizes.groupBy("width").agg(F.min("first").alias("first"), F.sum("shards").alias("shards"), F.sum("n").alias("n"))
    width = width.join(asked.groupBy("width").agg(F.count("*").alias("asked")), "width")
    width = width.withColumn("slices", F.ceil(F.col("asked") * F.col("shards") / F.greatest("n", F.lit(1024) * F.col("shards"))))
    before = Window.orderBy("width").rowsBetween(Window.unboundedPreceding, -1)
    width = scratch.table(width.withColumn("base", F.coalesce(F.sum(F.col("shards") * F.col("slices")).over(before), F.lit(0))), "widths")
    meetings = width.agg(F.sum(F.col("shards") * F.col("slices"))).first()[0]
    if meetings is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    meeting = (F.col("base") + (F.col("shard") - F.col("first")) * F.col("slices") + F.col("slice")).cast("int").alias("meeting")
    numbers = lambda start, n: F.explode(F.sequence(start, start + n - 1))
    asking = (
        asked.join(width, "width")
        .withColumn("slice", F.pmod(F.xxhash64("query_id", "query_key"), "slices"))
        .withColumn("shard", numbers(F.col("first"), F.col("shards")))
    )
    kept = built.join(width, "width").withColumn("slice", numbers(F.lit(0).cast("long"), F.col("slices")))
    met = kept.select(meeting, "place", "ids", "embedding", "edges", "entry").unionByName(
        asking.select(meeting, "embedding", "query_id", "query_key"), allowMissingColumns=True
    )
    met = met.repartitionById(meetings, "meeting").sortWithinPartitions("meeting")
    found = met.mapInArrow(narrow(search, k), "query_id long, query_key long, vec_id long, score double")
    found = scratch.table(found, "found")
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
