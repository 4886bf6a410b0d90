"""Keyed state: the running event count as a stateful stream operator."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StructField, StructType

_STATE = StructType([StructField("count", LongType())])


def counts_by_key(df: DataFrame, key: str) -> DataFrame:
    """The number of rows per key so far, for an update-mode sink: counted inside the engine,
    pre-aggregated per task, so a busy key is one row per task."""
    return df.groupBy(key).count().withColumnRenamed("count", "event_count")


def count_events(df: DataFrame, key: str, idle_minutes: float | None = None) -> DataFrame:
    """Each row with ``event_count``, the number of rows of its key so far, itself included.

    For jobs that need the number on every row; where the newest count per key is enough, use
    :func:`counts_by_key`. All rows of a key in a micro-batch go through one task, in Arrow
    batches, so they are not held in memory. State is one number per key and is kept for good;
    ``idle_minutes`` drops the state of a key that has been idle that long, after which **its
    count starts again at 1**. (A query that waits for such timeouts does not end by itself, so
    leave it unset where the source is only drained.)
    """
    output = StructType([*df.schema, StructField("event_count", LongType())])

    def step(
        _key: tuple, batches: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        count = state.get[0] if state.exists else 0
        for rows in batches:
            rows = rows.copy()
            rows["event_count"] = range(count + 1, count + 1 + len(rows))
            count += len(rows)
            yield rows
        state.update((count,))
        if idle_minutes is not None:
            state.setTimeoutDuration(int(idle_minutes * 60_000))

    timeout = (
        GroupStateTimeout.NoTimeout
        if idle_minutes is None
        else GroupStateTimeout.ProcessingTimeTimeout
    )
    return df.groupBy(key).applyInPandasWithState(step, output, _STATE, "append", timeout)
