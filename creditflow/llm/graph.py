"""Connected components by contraction, in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditflow.llm.scratch import Scratch


def components(links: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """``(id, component)`` for each id in ``links(a, b)``; component is its smallest reachable id.

    Each round every node moves to the neighbour (or itself) of the highest order of degree, ties
    in a random order of the round, and links follow their ends; links inside one node vanish.
    Stars end in a round or two and chains shrink by a constant factor per round. Minima are pre-aggregated per task and joins on busy nodes can be split, so no task
    holds the links of one node. Every round is a written table.
    Null ids and links of a node to itself are ignored; no links give no rows.
    """
    edges = scratch.table(
        links.where("a is not null and b is not null and a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(),
        f"{name}-links",
    )
    moves, turn = [], 0
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a")).toDF("id", "near")
        degree = scratch.table(both.groupBy("id").agg(F.count("*").alias("degree")), f"{name}-degree-{turn}")
        rank = lambda id_, degree: F.struct(
            (-F.floor(F.log2(degree))).alias("d"), F.xxhash64(F.lit(turn), id_).alias("h"), F.col(id_).alias("id")
        )
        near = both.join(degree.toDF("near", "degree"), "near").select("id", rank("near", "degree").alias("to"))
        move = scratch.table(
            near.groupBy("id")
            .agg(F.min("to").alias("to"), F.count("*").alias("n"))
            .select("id", F.least("to", rank("id", "n"))["id"].alias("to")),
            f"{name}-move-{turn}",
        )
        moves.append(move)
        at_a = move.select(F.col("id").alias("a"), F.col("to").alias("na"))
        at_b = move.select(F.col("id").alias("b"), F.col("to").alias("nb"))
        edges = scratch.table(
            edges.join(at_a, "a")
            .join(at_b, "b")
            .where("na <> nb")
            .select(F.least("na", "nb").alias("a"), F.greatest("na", "nb").alias("b"))
            .distinct(),
            f"{name}-links-{turn}",
        )
        turn += 1
    if not moves:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).limit(0)
    roots = moves[0]
    for k, move in enumerate(moves[1:], 1):
        then = move.select(F.col("id").alias("to"), F.col("to").alias("then"))
        roots = scratch.table(
            roots.join(then, "to", "left").select("id", F.coalesce("then", "to").alias("to")),
            f"{name}-roots-{k}",
        )
    least = scratch.table(roots.groupBy("to").agg(F.min("id").alias("component")), f"{name}-least")
    return roots.join(least, "to").select("id", "component")
