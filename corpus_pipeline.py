"""The corpus pipeline: each stage takes documents and returns documents, the last one packs them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from creditflow.llm.scratch import Scratch
from creditflow.llm.stages import decontaminated, deduplicated, good_documents, packed, without_repeats

STAGES = [
    ("quality classifier", good_documents),
    ("near-duplicates", deduplicated),
    ("repeated passages", without_repeats),
    ("benchmark decontamination", decontaminated),
    ("best-fit packing", packed),
]

#: Model scores and token ids are beyond SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table; each result is written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
