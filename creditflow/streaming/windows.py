"""Windows that fire once: a processing-time timer per window, whose state goes when it fires.

Records are reduced to partials of their windows inside each task first, so a window that gets all
of a second's records is a few rows. A window's state is one partial. When the wall clock passes
its end (plus ``grace_ms``) it is emitted, also if no further record comes, and its state is
dropped. What arrives for a window after that is emitted at once, as a partial marked late;
:func:`creditflow.operators.metrics.merged` adds it to the window's.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from creditflow.operators import metrics
from creditflow.streaming.jobs import Transform, _checkpoint

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_HOW = {F.sum: "sum", F.min: "min", F.max: "max"}
HOW = {c: _HOW[merge] for c, merge in metrics.PARTIALS.items()}
_KINDS = {c: "double" if c == "total_amount" else "long" for c in HOW}
_STATE = ", ".join(f"{c} {kind}" for c, kind in _KINDS.items())
OUTPUT = f"bucket_start long, bucket_end long, {_STATE}, late boolean"


def single_partials(records: DataFrame, size_ms: int, ts: str = "timestamp") -> DataFrame:
    """Each record as a partial of its window; nulls count as nothing."""
    risk = F.floor(F.col("risk_score") * 1e6 + 0.5)
    values = {
        "n": F.lit(1).cast("long"),
        "approved_count": F.col("is_approved").cast("long"),
        "rejected_count": (~F.col("is_approved")).cast("long"),
        "total_amount": F.col("loan_amount"),
        "risk_micros": risk,
        "high_risk_count": (F.col("risk_score") > metrics.HIGH_RISK).cast("long"),
        "proc_sum": F.col("processing_time"),
        "window_start": F.col(ts),
        "window_end": F.col(ts),
    }
    start = (F.floor(F.col(ts) / F.lit(size_ms)) * F.lit(size_ms)).alias("bucket_start")
    return records.where(F.col(ts).isNotNull()).select(
        start, *[F.coalesce(v.cast(_KINDS[c]), F.lit(0).cast(_KINDS[c])).alias(c) for c, v in values.items()]
    )


def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One partial per window and Arrow batch."""
    for batch in batches:
        if batch.num_rows:
            out = pa.Table.from_batches([batch]).group_by("bucket_start").aggregate(list(HOW.items()))
            yield from out.rename_columns({f"{c}_{how}": c for c, how in HOW.items()}).select(["bucket_start", *HOW]).combine_chunks().to_batches()


class FireOnce(StatefulProcessor):
    """The state and timer of one window."""

    def __init__(self, size_ms: int, grace_ms: int):
        self.size_ms, self.grace_ms = size_ms, grace_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.held = handle, handle.getValueState("partial", _STATE)

    def _row(self, start: int, values: tuple, late: bool) -> pd.DataFrame:
        return pd.DataFrame([(start, start + self.size_ms, *values, late)], columns=["bucket_start", "bucket_end", *HOW, "late"])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        start, now = int(key[0]), timerValues.getCurrentProcessingTimeInMs()
        parts = pd.concat([r[list(HOW)] for r in rows])
        fires = start + self.size_ms + self.grace_ms
        if self.held.exists():
            parts = pd.concat([parts, pd.DataFrame([tuple(self.held.get())], columns=list(HOW))])
        elif now >= fires:
            yield self._row(start, _merged(parts), True)
            return
        else:
            self.handle.registerTimer(fires)
        self.held.update(_merged(parts))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        values = tuple(self.held.get())
        self.held.clear()
        yield self._row(int(key[0]), values, False)

    def close(self) -> None:
        pass


def _merged(parts: pd.DataFrame) -> tuple:
    return tuple(float(v) if _KINDS[c] == "double" else int(v) for c, v in ((c, getattr(parts[c], how)()) for c, how in HOW.items()))


def fire_once(records: DataFrame, size_ms: int = 1000, grace_ms: int = 0, ts: str = "timestamp") -> DataFrame:
    """One partial per window of a stream of decisions, and late ones, as rows of ``OUTPUT``."""
    parts = single_partials(records, size_ms, ts)
    parts = parts.mapInArrow(add_up, parts.schema)
    return parts.groupBy("bucket_start").transformWithStateInPandas(FireOnce(size_ms, grace_ms), OUTPUT, "append", "processingTime")


def run_windows(
    source: DataFrame,
    transform: Transform,
    path: str,
    name: str,
    checkpoint: str | None = None,
    size_ms: int = 1000,
    grace_ms: int = 0,
    ts: str = "timestamp",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Records to window partials under ``path``, each window once, late ones in a folder of their own.

    ``ts`` should be the wall clock at which a record was taken in. The files of a micro-batch
    are published together; read them with :func:`read_windows` and
    :func:`creditflow.operators.metrics.finished`. Timers need a query that keeps running, and
    state in RocksDB, which is set here for queries of this session that start from now on.
    """
    source.sparkSession.conf.set(_STORE, _ROCKS)
    return (
        fire_once(source.transform(transform), size_ms, grace_ms, ts)
        .writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("late")
        .queryName(name)
        .option("checkpointLocation", _checkpoint(source, checkpoint, name))
        .trigger(**(trigger or {"processingTime": f"{max(size_ms // 2, 100)} milliseconds"}))
        .start(path)
    )


def read_windows(spark: SparkSession, path: str) -> DataFrame:
    """The partials that :func:`run_windows` wrote."""
    return spark.read.parquet(path).withColumn("late", F.col("late").cast("boolean"))
