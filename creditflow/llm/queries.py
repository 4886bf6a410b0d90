"""One query per operator, with the parameters it runs with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditflow.llm import (
    collocations, decontam, langid, neardup, neighbours, packing, quality, records, spelling, substring, urls, vectors, warc,
)
from creditflow.llm.scratch import Scratch
from creditflow.sources.tables import table

#: Fixed values: (verdict, host, path) of the URL rules.
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def tokenizer_path() -> str:
    """The tokenizer file that the queries use; it lies at the same place on every machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _fold(of: int) -> F.Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % of


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Learns outside fold 0 of 5; ``held_out`` marks that fold (a null doc_id is not in it, nor learnt from)."""
    docs = table(spark, folder, "documents")
    model = langid.fit(docs.where(_fold(5) != 0), Scratch(spark, "op1"))
    marked = docs.select("doc_id", "text", F.coalesce(_fold(5) == 0, F.lit(False)).alias("held_out"))
    return langid.identified(marked, model, ["doc_id", "held_out"])


def op2_odd_sketch(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, folder, "documents"), Scratch(spark, "op2"), percent=85)


def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages"), Scratch(spark, "op3"))


def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judged(table(spark, folder, "pages"), Scratch(spark, "op4"), URL_RULES)


def op5_token_records(spark: SparkSession, folder: str) -> DataFrame:
    return records.round_trip(table(spark, folder, "documents"), Scratch(spark, "op5"), tokenizer_path())


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return decontam.contaminated(docs, items, Scratch(spark, "op6"), unnamed=True)


def op7_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, folder, "embeddings"), Scratch(spark, "op7"))


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Learns outside fold 1 of 3; ``held_out`` marks that fold."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = quality.fit(docs, labels.where(_fold(3) != 1), Scratch(spark, "op8"))
    marked = docs.select("doc_id", "text", F.coalesce(_fold(3) == 1, F.lit(False)).alias("held_out"))
    out = quality.scored(marked, model, ["doc_id", "held_out"]).withColumnRenamed("_score", "score")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring.without_repeats(table(spark, folder, "documents"), Scratch(spark, "op9"))


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), Scratch(spark, "op10"), tokenizer_path())


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Of one run in 31, by a checksum of document and run, one letter is taken out first."""
    return spelling.variants(spelling.words(table(spark, folder, "documents"), worn=31), Scratch(spark, "op11"))


def op12_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """Queries are the rows whose vec_id is divisible by 20."""
    rows = table(spark, folder, "embeddings")
    found = neighbours.nearest(rows, rows.where(F.col("vec_id") % 20 == 0), Scratch(spark, "op12"))
    return found.select("query_id", "rank", "vec_id", "score")


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"), Scratch(spark, "op13"))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = [
        op1_language_id, op2_odd_sketch, op3_warc, op4_url_filter, op5_token_records,
        op6_decontamination, op7_multi_index, op8_quality, op9_substring_dedup, op10_packing,
        op11_spelling_variants, op12_nearest_neighbours, op13_collocations,
    ]
    return {f.__name__: f for f in ops}
