"""Window metrics over decisions, and the shapes in which a time-series store takes them.

There is no key but the window, so each partition reduces to one row per window before the
shuffle: the exchange carries windows, not decisions.

Risk is summed in whole millionths. The scores have two decimals (the composite risk has at
most five), so the sum is exact and the averages do not depend on how rows were partitioned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditflow.functions.clock import nanos, now_ms

# Risk above which a loan is high risk, measurement name, tags.
HIGH_RISK = 0.7
MEASUREMENT = "loan_decisions"
TAGS = {"window_type": "tumbling"}
# Field order of the line format; ``i`` marks an integer field.
LINE_FIELDS = [
    ("approved_count", "i"),
    ("rejected_count", "i"),
    ("approval_rate", ""),
    ("total_amount", ""),
    ("avg_amount", ""),
    ("avg_risk_score", ""),
    ("high_risk_count", "i"),
    ("avg_proc_time", ""),
    ("window_start", "i"),
    ("window_end", "i"),
]
_MICROS = 1_000_000.0
METRIC_FIELDS = [name for name, _ in LINE_FIELDS]


def event_time(df: DataFrame, ts_ms: str) -> DataFrame:
    """Add ``event_ts``, the timestamp column that windows and watermarks work on."""
    return df.withColumn("event_ts", F.timestamp_millis(F.col(ts_ms)))


def _micros(x: Column) -> Column:
    """The sum in whole millionths; a score with more decimals fails instead of being rounded."""
    whole = F.floor(x * _MICROS + 0.5)
    finer = F.raise_error(F.concat(F.lit("risk score with more than six decimals: "), x.cast("string")))
    exact = F.when(F.abs(x * _MICROS - whole) < 1e-3, whole).when(x.isNotNull(), finer.cast("bigint"))
    return F.sum(exact)


def _exact_sum(x: Column) -> Column:
    return _micros(x) / _MICROS


def _ratio(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator > 0, numerator / denominator).otherwise(0.0)


def _edges() -> list[Column]:
    return [
        F.unix_millis(F.col("window.start")).alias("bucket_start"),
        F.unix_millis(F.col("window.end")).alias("bucket_end"),
    ]


#: How two partials of one window become one, by column.
PARTIALS = {
    "n": F.sum, "approved_count": F.sum, "rejected_count": F.sum, "total_amount": F.sum,
    "risk_micros": F.sum, "high_risk_count": F.sum, "proc_sum": F.sum,
    "window_start": F.min, "window_end": F.max,
}
EDGES = ["bucket_start", "bucket_end"]


def window_partials(df: DataFrame, size: str = "1 second") -> DataFrame:
    """Sums, counts and ends per tumbling window of ``event_ts``, which :func:`merged` adds up."""
    grouped = df.groupBy(F.window("event_ts", size)).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("is_approved")).alias("approved_count"),
        F.count_if(~F.col("is_approved")).alias("rejected_count"),
        F.sum("loan_amount").alias("total_amount"),
        _micros(F.col("risk_score")).alias("risk_micros"),
        F.count_if(F.col("risk_score") > HIGH_RISK).alias("high_risk_count"),
        F.sum("processing_time").alias("proc_sum"),
        F.min("timestamp").alias("window_start"),
        F.max("timestamp").alias("window_end"),
    )
    return grouped.select(*_edges(), *PARTIALS)


def merged(partials: DataFrame) -> DataFrame:
    """One partial per window. Partials of the same records in any split merge to the same one."""
    return partials.groupBy(*EDGES).agg(*[merge(c).alias(c) for c, merge in PARTIALS.items()])


def finished(partials: DataFrame) -> DataFrame:
    """The metrics of windows, from one partial each."""
    n, approved = F.col("n"), F.col("approved_count")
    return partials.select(
        *EDGES,
        "window_start",
        "window_end",
        "approved_count",
        "rejected_count",
        _ratio(approved, n).alias("approval_rate"),
        "total_amount",
        _ratio(F.col("total_amount"), approved).alias("avg_amount"),
        _ratio(F.col("risk_micros") / _MICROS, n).alias("avg_risk_score"),
        "high_risk_count",
        F.expr("proc_sum div n").cast("double").alias("avg_proc_time"),
    )


def window_metrics(df: DataFrame, size: str = "1 second") -> DataFrame:
    """Approval, amount, risk and latency per tumbling window of ``event_ts``.

    ``window_start`` and ``window_end`` are the first and last event seen in the window,
    ``bucket_start`` and ``bucket_end`` its edges. The average amount is over approved loans;
    the average latency is a whole number, truncated.
    """
    return finished(window_partials(df, size))


def notification_metrics(df: DataFrame, size: str = "2 seconds") -> DataFrame:
    """The notification stage's variant: all amounts count, and latency is not truncated."""
    grouped = df.groupBy(F.window("event_ts", size)).agg(
        F.count(F.lit(1)).alias("total_count"),
        F.count_if(F.col("loan_decision")).alias("approved_count"),
        F.count_if(~F.col("loan_decision")).alias("rejected_count"),
        F.sum("loan_amount").alias("total_amount"),
        _exact_sum(F.col("risk_score")).alias("risk_sum"),
        F.count_if(F.col("risk_score") > HIGH_RISK).alias("high_risk_count"),
        F.sum("processing_time_ms").alias("proc_sum"),
    )
    n = F.col("total_count")
    return grouped.select(
        *_edges(),
        "total_count",
        "approved_count",
        "rejected_count",
        _ratio(F.col("approved_count"), n).alias("approval_rate"),
        "total_amount",
        _ratio(F.col("total_amount"), n).alias("avg_amount"),
        _ratio(F.col("risk_sum"), n).alias("avg_risk_score"),
        "high_risk_count",
        _ratio(F.col("proc_sum"), n).alias("avg_processing_time"),
    )


def line_protocol(metrics: DataFrame) -> DataFrame:
    """One text line per window: measurement, tags, fields, timestamp in nanoseconds."""
    head = ",".join([MEASUREMENT, *[f"{k}={v}" for k, v in TAGS.items()]])
    fields = F.concat_ws(
        ",",
        *[
            F.concat(F.lit(f"{name}="), F.col(name).cast("string"), F.lit(suffix))
            for name, suffix in LINE_FIELDS
        ],
    )
    stamp = nanos(F.col("window_end")).cast("string")
    return metrics.select(F.concat_ws(" ", F.lit(head), fields, stamp).alias("value"))


# Names under which the notification metrics are written, and their label.
NOTIFICATION_NAMES = {
    "window_start": "bucket_start",
    "window_end": "bucket_end",
    "total_notifications": "total_count",
    "approved_loans": "approved_count",
    "rejected_loans": "rejected_count",
    "approval_rate": "approval_rate",
    "total_loan_amount": "total_amount",
    "avg_loan_amount": "avg_amount",
    "avg_risk_score": "avg_risk_score",
    "high_risk_loans": "high_risk_count",
    "avg_processing_time": "avg_processing_time",
}
NOTIFICATION_WINDOW = "1min"


def notification_json(metrics: DataFrame, written_ms: Column | None = None) -> DataFrame:
    """One JSON line per window; ``written_ms`` defaults to the wall clock."""
    stamp = written_ms if written_ms is not None else now_ms()
    record = F.struct(
        *[F.col(column).alias(name) for name, column in NOTIFICATION_NAMES.items()],
        stamp.alias("timestamp"),
        F.lit(NOTIFICATION_WINDOW).alias("window"),
    )
    return metrics.select(F.to_json(record).alias("value"))


def metrics_long(
    metrics: DataFrame, fields: Sequence[str] = METRIC_FIELDS, time: str = "window_end"
) -> DataFrame:
    """One row per point and field; numeric columns become (field, value)."""
    ids = [F.col(time).alias("time"), F.lit(MEASUREMENT).alias("measurement")]
    ids += [F.lit(v).alias(k) for k, v in TAGS.items()]
    wide = metrics.select(*ids, *[F.col(c).cast("double").alias(f"f_{c}") for c in fields])
    long = wide.unpivot(
        ["time", "measurement", *TAGS], [f"f_{c}" for c in fields], "field", "value"
    )
    return long.withColumn("field", F.expr("substring(field, 3)"))


def points(df: DataFrame, timestamp: str, fallback_ms: Column | None = None) -> DataFrame:
    """Split a record for a time-series store: numbers to fields, text to tags.

    Other types are left out; a missing timestamp falls back to ``fallback_ms``, by default the
    wall clock.
    """
    numeric = [
        f.name for f in df.schema
        if f.dataType.typeName() in ("integer", "long", "double", "float") and f.name != timestamp
    ]
    text = [f.name for f in df.schema if f.dataType.typeName() == "string"]
    stamped = df.select(
        F.coalesce(
            F.col(timestamp), fallback_ms if fallback_ms is not None else now_ms()
        ).alias("time"),
        *text,
        *[F.col(c).cast("double").alias(c) for c in numeric],
    )
    return stamped.unpivot(["time", *text], numeric, "field", "value").filter(
        F.col("value").isNotNull()
    )


def metrics_pivot(long: DataFrame, fields: Sequence[str] = METRIC_FIELDS) -> DataFrame:
    """Back to one row per time, in one aggregation: the field list is given."""
    return long.groupBy("time").agg(
        *[F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in fields]
    )
