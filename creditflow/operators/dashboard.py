"""Dashboard roll-ups over window metrics.

``anchor`` is the "now" of a trailing range, in epoch milliseconds: a literal column from the
caller, or :func:`latest` of the table. On a table partitioned by day the range prunes files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOUR_MS = 60 * 60 * 1000
DAY_MS = 24 * HOUR_MS

LAST_FIELDS = [
    "approval_rate", "approved_count", "rejected_count", "total_amount", "avg_amount",
    "high_risk_count", "avg_proc_time",
]
TREND_FIELDS = ["approval_rate", "total_amount", "avg_amount", "avg_risk_score"]


def latest(df: DataFrame, ts: str = "window_end") -> Column:
    """The newest time in the table, as a scalar subquery."""
    return df.agg(F.max(ts)).scalar()


def trailing(df: DataFrame, anchor: Column, length_ms: int, ts: str = "window_end") -> DataFrame:
    """Rows of the last ``length_ms`` milliseconds before ``anchor``."""
    return df.filter(F.col(ts) >= anchor - F.lit(length_ms))


def series(metrics: DataFrame, field: str, ts: str = "window_end") -> DataFrame:
    """One field over time."""
    return metrics.select(F.col(ts).alias("time"), F.col(field).alias("value"))


def last_values(
    metrics: DataFrame, fields: Sequence[str] = LAST_FIELDS, ts: str = "window_end"
) -> DataFrame:
    """The newest value of each field: partial aggregates, no sort."""
    return metrics.agg(
        F.max(ts).alias("time"), *[F.max_by(F.col(c), F.col(ts)).alias(c) for c in fields]
    )


def trend(
    metrics: DataFrame,
    every_ms: int = 30_000,
    fields: Sequence[str] = TREND_FIELDS,
    ts: str = "window_end",
) -> DataFrame:
    """The mean of each field per bucket; a bucket without rows does not appear.

    A bucket is stamped with its end.
    """
    bucket = (F.floor(F.col(ts) / F.lit(every_ms)) + 1) * F.lit(every_ms)
    return metrics.groupBy(bucket.alias("time")).agg(*[F.avg(c).alias(c) for c in fields])


def daily(metrics: DataFrame) -> DataFrame:
    """Totals of a trailing day. The amount average is a mean of window means."""
    totals = metrics.agg(
        F.coalesce(F.sum("approved_count"), F.lit(0)).alias("approved"),
        F.coalesce(F.sum("rejected_count"), F.lit(0)).alias("rejected"),
        F.coalesce(F.sum("high_risk_count"), F.lit(0)).alias("high_risk"),
        F.coalesce(F.sum("total_amount"), F.lit(0.0)).alias("total_amount"),
        F.avg("avg_amount").alias("avg_amount"),
    )
    total = F.col("approved") + F.col("rejected")
    return totals.withColumn(
        "daily_approval_rate", F.when(total > 0, F.col("approved") / total).otherwise(0.0)
    )
