"""Rows and helpers that the tests of the operators share."""

from __future__ import annotations

from pyspark.sql import types as T

from creditflow.llm.scratch import Scratch

DOCUMENT = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
)
#: Columns that operators use as names of their own.
CLASHING = ["id", "n", "key", "h", "spans", "items", "bucket", "sequence_id", "component_id", "label", "start", "rep", "first", "host", "n_words"]
BENCHMARK = "item_id long, text string"


def fresh(spark) -> Scratch:
    return Scratch(spark, "test")


def hard_rows() -> list[tuple]:
    """Nulls, empty and very long texts, ties, repeated rows, odd blanks and scripts."""
    base = " ".join(f"word{k} " + ("alpha" if k % 3 else "beta") for k in range(60))
    passage = " ".join(f"shared{k}" for k in range(35))
    long = " ".join(f"t{k % 977}x{k // 977}" for k in range(30_000))
    return [
        (1, base), (2, base), (3, base.upper()), (4, base + " one more"), (5, "x " + passage + " y"), (6, passage), (7, "before " + passage + " after " + passage),
        (8, None), (9, ""), (10, "  \n\t "), (11, "one"), (12, "one"), (13, "a b c d"), (14, "A b C d"), (15, long), (16, long + " tail"),
        (17, "ß ü é 中文   " * 30), (18, "la " * 400), (19, "***"), (20, "0 1 2 3 4 5 6 7 8 9 a b c"),
        (21, "la " * 400), (22, "x\r\n" + passage.replace(" ", "\n")), (-5, "negative id " + passage),
    ]
