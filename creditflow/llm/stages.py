"""Stages of the corpus pipeline; each takes documents and, but for the last, returns documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditflow.llm import decontam, neardup, packing, quality, substring
from creditflow.llm.queries import tokenizer_path
from creditflow.llm.scratch import Scratch
from creditflow.sources.tables import table

#: Documents scored below this go.
GOOD = 0.5


def good_documents(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject; learnt from the labels table."""
    scratch = Scratch(spark, "quality")
    model = quality.fit(docs, table(spark, folder, "labels"), scratch)
    rows = docs.select("text", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    return quality.scored(rows, model, ["row"]).where(F.col("_score") >= GOOD).select("row.*")


def deduplicated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The document of smallest doc_id of each group of near-duplicates.

    A document without doc_id stays. Texts that share a doc_id are documents of their own: the one
    of smallest hash goes by the id, the others by a hash of id and text. Of rows that repeat both
    doc_id and text one stays.
    """
    scratch = Scratch(spark, "neardup")
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", row)
    repeated = scratch.table(_repeated(rows), "repeated")
    again = not repeated.isEmpty()
    if again:
        hashed = rows.withColumn("hash", F.xxhash64("text"))
        first = scratch.table(hashed.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("hash").alias("first")), "first-texts")
        other = F.col("hash") > F.col("first")
        name = F.when(other, F.xxhash64("doc_id", "text")).otherwise(F.col("doc_id"))
        rows = hashed.join(first, "doc_id", "left").select(name.alias("doc_id"), "text", "row")
    found = neardup.near_duplicates(rows, scratch, percent=80).where("not kept").select("doc_id").distinct()
    kept = rows.join(scratch.table(found, "dropped"), "doc_id", "left_anti")
    if not again:
        return kept.select("row.*")
    repeated = scratch.table(_repeated(rows), "repeated-rows")
    once = kept.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("row").alias("row"))
    return kept.join(repeated, "doc_id", "left_anti").select("row.*").unionByName(once.select("row.*"))


def _repeated(rows: DataFrame) -> DataFrame:
    return rows.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")


def without_repeats(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without the words of passages that stand earlier in the corpus."""
    scratch = Scratch(spark, "substring")
    out = substring.without_repeats(docs, scratch, keep=True)
    columns = {c: F.col(f"row.`{c}`") for c in docs.columns if c != "text"} | {"text": F.col("text")}
    if "n_chars" in columns:
        changed = F.when(F.col("n_removed") > 0, F.char_length("text")).otherwise(columns["n_chars"])
        columns["n_chars"] = changed.cast(docs.schema["n_chars"].dataType)
    return out.select(*(columns[c].alias(c) for c in docs.columns))


def decontaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item."""
    scratch = Scratch(spark, "decontam")
    out = decontam.contaminated(docs, table(spark, folder, "benchmark"), scratch, keep=True, unnamed=True).where("not contaminated")
    return out.select(*((F.col("text") if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def packed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Sequences of at most 4096 tokens, a row per piece of a document."""
    return packing.pack(docs, Scratch(spark, "packing"), tokenizer_path())
