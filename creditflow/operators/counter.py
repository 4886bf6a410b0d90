"""Running event count per key.

A plain ``row_number`` per key puts all rows of a key into one task. One key may hold a large
share of the stream, so the rows of a key are cut into time slices first: rows are numbered
inside their slice, and each slice starts from the number of rows in the key's earlier slices.
Only the slice counts, not the rows, meet in one place per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def running_count(
    df: DataFrame,
    key: str,
    ts_ms: str,
    tie: str,
    slice_ms: int = 60_000,
) -> DataFrame:
    """Add ``event_count``: the rank of the row among its key's rows by (ts_ms, tie).

    ``key`` may be of any type that can be compared and stays as it is; rows without a key are
    counted together, apart from every real key. One task holds at most one key's rows of one
    slice, whatever its share of the table; choose ``slice_ms`` for that. ``ts_ms`` must not be
    null.
    """
    # A null never equals a null in a join, so a missing key is told by a flag of its own.
    sliced = df.withColumns(
        {
            "_key": F.coalesce(F.col(key).cast("string"), F.lit("")),
            "_keyed": F.col(key).isNotNull(),
            "_slice": F.floor(F.col(ts_ms) / F.lit(slice_ms)),
        }
    )
    group = ["_key", "_keyed"]
    per_slice = sliced.groupBy(*group, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*group).orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = per_slice.select(
        *group, "_slice", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    within = Window.partitionBy(*group, "_slice").orderBy(ts_ms, tie)
    numbered = sliced.withColumn("_rank", F.row_number().over(within))
    return (
        numbered.join(offsets, [*group, "_slice"])
        .withColumn("event_count", F.col("_before") + F.col("_rank"))
        .drop(*group, "_slice", "_rank", "_before")
    )
