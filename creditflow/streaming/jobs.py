"""The four kinds of job: publish, upsert, outbox, metrics; and the notification fan-out.

Every job takes a streaming source and runs the batch functions on it. Sinks are idempotent:
a replayed micro-batch is recognised by its id, or writes the same keys again.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from creditflow.operators import alerts, merge, metrics, outbox
from creditflow.operators.counter import running_count
from creditflow.sources import files
from creditflow.sources.rollup import RollupTable
from creditflow.sources.stage_table import Snapshot, StageTable
from creditflow.sources.topics import append_topic, decode, encode, split_bad
from creditflow.streaming.state import count_events

Transform = Callable[[DataFrame], DataFrame]
# ``{"availableNow": True}`` drains the source; ``{"processingTime": "10 seconds"}`` keeps going.
DRAIN = {"availableNow": True}


def _checkpoint(source: DataFrame, given: str | None, name: str) -> str:
    """The checkpoint folder of a query: given, or under the folder that the session names.

    There is no other default: a job that takes a new folder at each start never resumes.
    """
    root = source.sparkSession.conf.get("spark.checkpoint.dir", None)
    if not given and not root:
        raise ValueError("give a checkpoint folder or set spark.checkpoint.dir")
    return given or f"{root.rstrip('/')}/{name}"


def _writer(batch: DataFrame, name: str) -> str:
    """The identity under which a query numbers its micro-batches.

    The query id lives in the checkpoint: it survives a restart, and a query that starts over
    from a fresh checkpoint, whose batch ids begin again at 0, counts as another writer.
    """
    query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not query_id:
        raise RuntimeError("not inside a streaming query")
    return f"{name}@{query_id}"


def _own_folder(root: str, batch: DataFrame, batch_id: int) -> str:
    """The directory of one micro-batch of one query."""
    return f"{root}/query={_writer(batch, '').removeprefix('@')}/batch={batch_id}"


def _not_fewer(batch: DataFrame, held: DataFrame, key: str, counts: Sequence[str]) -> DataFrame:
    """The windows of ``batch`` that count at least as many records as the table's own."""
    total = lambda df: sum((F.col(c) for c in counts), F.lit(0))
    known = held.select(key, total(held).alias("_held"))
    joined = batch.join(known, key, "left")
    return joined.filter(F.col("_held").isNull() | (total(batch) >= F.col("_held"))).drop("_held")


def _read_messages(
    batch: DataFrame, batch_id: int, message: StructType | None, fmt: str, rejects: str | None
) -> DataFrame:
    """The records of a micro-batch of (key, value) pairs, or the batch itself without ``message``.

    A bad message fails the job, or goes to the folder ``rejects`` with its reason (JSON only).
    """
    if message is None:
        return batch
    if rejects is None:
        return decode(batch, message, fmt)
    rows, bad = split_bad(batch, message)
    bad.write.mode("overwrite").parquet(_own_folder(rejects, batch, batch_id))
    return rows


def run_publish(
    source: DataFrame,
    topic_path: str,
    name: str,
    checkpoint: str | None = None,
    transform: Transform | None = None,
    count_by: str | None = None,
    idle_minutes: float | None = None,
    trigger: dict = DRAIN,
) -> StreamingQuery:
    """Records to a directory topic, exactly once.

    ``count_by`` keeps a running count per key and adds it as ``event_count``; the state of a
    key idle for ``idle_minutes`` is dropped.
    """
    out = source.transform(transform) if transform else source
    if count_by:
        out = count_events(out, count_by, idle_minutes)
    return (
        out.writeStream.format("parquet")
        .option("checkpointLocation", _checkpoint(source, checkpoint, name))
        .trigger(**trigger)
        .start(topic_path)
    )


def run_publish_kafka(
    source: DataFrame,
    schema: StructType,
    options: dict[str, str],
    name: str,
    key: str | None = None,
    fmt: str = "json",
    checkpoint: str | None = None,
    trigger: dict = DRAIN,
) -> StreamingQuery:
    """Records to a broker topic, at least once, keyed by column ``key``."""
    return (
        encode(source, schema, key, fmt)
        .writeStream.format("kafka")
        .options(**options)
        .option("checkpointLocation", _checkpoint(source, checkpoint, name))
        .trigger(**trigger)
        .start()
    )


def run_upsert(
    source: DataFrame,
    transform: Transform,
    spec: merge.MergeSpec,
    target: StageTable,
    order: Sequence[str],
    name: str,
    checkpoint: str | None = None,
    trigger: dict = DRAIN,
    message: StructType | None = None,
    fmt: str = "json",
    rejects: str | None = None,
) -> StreamingQuery:
    """Messages to a keyed stage table, one merge per micro-batch.

    With ``message`` the source holds (key, value) pairs, which are decoded first. A bad message
    fails the job, or goes to the folder ``rejects`` with its reason (JSON only).
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = _read_messages(batch, batch_id, message, fmt, rejects)
        target.merge(rows.transform(transform), spec, order, _writer(batch, name), batch_id)

    return (
        source.writeStream.foreachBatch(write)
        .queryName(name)
        .option("checkpointLocation", _checkpoint(source, checkpoint, name))
        .trigger(**trigger)
        .start()
    )


def run_outbox(
    table: StageTable,
    spec: outbox.OutboxSpec,
    topic_path: str,
    proc_ms: Column | None = None,
    fmt: str | None = None,
    broker: dict[str, str] | None = None,
    since_ms: int | None = None,
) -> bool:
    """One pass: send the pending rows of a snapshot, then mark them.

    With ``fmt`` (``json`` or ``avro``) messages go out as (key, value) pairs, keyed by request;
    ``broker`` sends them to a broker topic. ``since_ms`` reads only the days from then on, for a
    table that is split by day and whose older rows have all been sent. Returns False when nothing was pending. Sending and marking are two steps: after a crash in
    between the next pass sends the same keys again, which the keyed stage behind absorbs. A row
    that was upserted meanwhile is not marked, so its new state goes out with the next pass.
    """
    rows = table.read() if since_ms is None else table.since(since_ms)
    return _send(table, rows, spec, topic_path, proc_ms, fmt, broker)


def _send(
    table: StageTable, rows: DataFrame, spec: outbox.OutboxSpec, topic_path: str,
    proc_ms: Column | None = None, fmt: str | None = None, broker: dict[str, str] | None = None,
) -> bool:
    """Send and mark the pending ones of some rows of a table."""
    todo = outbox.pending(rows, spec)
    if todo.isEmpty():
        return False
    if proc_ms is None:  # one reading of the clock, so that message and mark agree
        proc_ms = F.lit(int(time.time() * 1000))
    sent = outbox.hand_over(todo, spec, proc_ms)
    out = outbox.messages(outbox.ordered(sent, spec), spec)
    if fmt is not None:
        out = encode(out, spec.message, "requestId", fmt)
    append_topic(out, topic_path, broker)
    table.mark_sent(sent, spec)
    return True


def poll_outbox(
    table: StageTable, spec: outbox.OutboxSpec, topic_path: str, name: str, every: str = "100 milliseconds",
    checkpoint: str | None = None, **options,
) -> StreamingQuery:
    """Outbox passes for as long as the query runs, one per trigger; ``options`` as for a pass."""
    ticks = table.spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return (
        ticks.writeStream.foreachBatch(lambda _batch, _id: run_outbox(table, spec, topic_path, **options) and None)
        .queryName(name)
        .option("checkpointLocation", _checkpoint(ticks, checkpoint, name))
        .trigger(processingTime=every)
        .start()
    )


def run_outbox_log(
    table: StageTable, spec: outbox.OutboxSpec, topic_path: str, name: str,
    checkpoint: str | None = None, trigger: dict = DRAIN, **options,
) -> StreamingQuery:
    """Outbox passes driven by the table's log of versions, read as a stream.

    Each merge leaves a version file that names the parts it wrote; only there can rows have become
    pending. The query's checkpoint holds the position in the log: a pass reads the parts of the
    versions behind it, and where there is no new version no table file is read at all. Versions
    that a pass itself left, by marking, are no news. Versions that are gone (``expire``) before
    they were read leave a gap in their numbers; then the whole table is looked through. A pass
    that fails is repeated with the same versions. ``options`` as for :func:`run_outbox`.
    """
    files.make(table.spark, f"{table.path}/commits")
    log = table.spark.readStream.option("wholetext", True).text(f"{table.path}/commits")
    position: list[int] = []

    def write(batch: DataFrame, _batch_id: int) -> None:
        # One small row per version since the last pass.
        news = sorted((Snapshot(**json.loads(r.value)) for r in batch.collect()), key=lambda s: s.version)
        if not news:
            return
        numbers = [s.version for s in news]
        # A query that goes on after a restart can't tell whether versions have gone meanwhile.
        known = position[0] if position else (0 if _batch_id == 0 else None)
        whole = known is None or numbers != list(range(known + 1, numbers[-1] + 1))
        position[:] = [numbers[-1]]
        changed = {p for s in news if s.kind == "merge" for p, d in s.dirs.items() if d.startswith(f"{s.version:020d}-")}
        now = table.snapshot()
        parts = None if whole else sorted(changed & now.dirs.keys())
        if whole or parts:
            _send(table, table.read(now, parts), spec, topic_path, **options)

    return (
        log.writeStream.foreachBatch(write)
        .queryName(name)
        .option("checkpointLocation", _checkpoint(log, checkpoint, name))
        .trigger(**trigger)
        .start()
    )


def run_counted_publish(
    source: DataFrame,
    key: str,
    ts: str,
    tie: str,
    totals: StageTable,
    topic_path: str,
    name: str,
    checkpoint: str | None = None,
    slice_ms: int = 60_000,
    trigger: dict = DRAIN,
) -> StreamingQuery:
    """Records to a directory topic with ``event_count``, the running count of their key.

    Inside a micro-batch rows count in the order of ``ts`` and ``tie``, slice by slice
    (:func:`creditflow.operators.counter.running_count`), so a key that holds most of the rows is
    spread over tasks; between micro-batches only one number per key is kept, in ``totals`` (see
    :func:`totals_schema`). Rows without a key count together. A micro-batch writes its own folder
    before its totals are merged, and is left alone once they are: a replay changes nothing.
    """
    spec = merge.MergeSpec(name="totals", table=totals.schema, key="key", refresh=("event_count",))
    own = lambda df: df.withColumn("_total_key", F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("")))

    def write(batch: DataFrame, batch_id: int) -> None:
        writer = _writer(batch, name)
        before = totals.snapshot()
        if before.writers.get(writer, -1) >= batch_id:
            return
        held = totals.read(before).select(F.col("key").alias("_total_key"), F.col("event_count").alias("_held"))
        fresh = own(batch).groupBy("_total_key").agg(F.count(F.lit(1)).alias("_new")).join(held, "_total_key", "left")
        fresh = fresh.withColumn("_held", F.coalesce("_held", F.lit(0))).persist()
        try:
            counted = running_count(batch, key, ts, tie, slice_ms)
            out = own(counted).join(fresh.select("_total_key", "_held"), "_total_key")
            out = out.withColumn("event_count", F.col("event_count") + F.col("_held")).select(*counted.columns)
            out.write.mode("overwrite").parquet(_own_folder(topic_path, batch, batch_id))
            new = fresh.select(F.col("_total_key").alias("key"), (F.col("_held") + F.col("_new")).alias("event_count"))
            totals.merge(new, spec, ["event_count"], writer, batch_id)
        finally:
            fresh.unpersist()

    return (
        source.writeStream.foreachBatch(write)
        .queryName(name)
        .option("checkpointLocation", _checkpoint(source, checkpoint, name))
        .trigger(**trigger)
        .start()
    )


def totals_schema() -> StructType:
    """Columns of a table of totals, keyed by ``key``: the key's text behind ``=``, empty for none."""
    return StructType([StructField("key", StringType()), StructField("event_count", LongType())])


def run_metrics(
    source: DataFrame,
    transform: Transform,
    name: str,
    checkpoint: str | None = None,
    ts: str = "timestamp",
    size: str = "1 second",
    delay: str | None = None,
    aggregate: Callable[[DataFrame, str], DataFrame] = metrics.window_metrics,
    spec: merge.MergeSpec = merge.METRICS,
    sink: StageTable | None = None,
    lines: str | None = None,
    as_lines: Transform = metrics.line_protocol,
    more_of: Sequence[str] | None = ("approved_count", "rejected_count"),
    trigger: dict = DRAIN,
    message: StructType | None = None,
    fmt: str = "json",
    skip_bad: bool = False,
) -> StreamingQuery:
    """Records to window metrics.

    ``ts`` is the event time of a record in milliseconds. No record is dropped by default, however
    late: windows stay in the state, one row each. With ``delay``, windows older than that leave
    the state and later records of theirs are dropped; the query's progress reports their number
    (``numRowsDroppedByWatermark``). Each micro-batch emits the windows it changed, and ``sink``
    overwrites them by window, so the table holds the newest state of every window. A window is
    not replaced by one that counts fewer records (the sum of ``more_of``), so a query that
    starts over on a topic that has lost its oldest records leaves complete windows as they are.
    ``lines`` also appends the windows as text, for a store that overwrites a point in the same
    way. Without either, metrics go nowhere. With ``message`` the source holds (key, value) pairs;
    a bad one fails the job, or is left to :func:`run_rejects` with ``skip_bad`` (JSON only).

    Without ``delay`` the state grows by a row per window for good; :func:`run_rollup` keeps none,
    and :func:`creditflow.streaming.windows.run_windows` emits each window once and drops its state.
    """
    if message is not None:
        source = split_bad(source, message)[0] if skip_bad else decode(source, message, fmt)

    def write(batch: DataFrame, batch_id: int) -> None:
        writer = _writer(batch, name)
        batch = batch.persist()
        try:
            batch.count()  # the state of every partition commits, whatever the sinks read
            if lines is not None:
                as_lines(batch).write.mode("overwrite").text(_own_folder(lines, batch, batch_id))
            if sink is not None:
                if more_of is not None:
                    batch = _not_fewer(batch, sink.read(), spec.key, more_of)
                sink.merge(batch, spec, ["bucket_end"], writer, batch_id)
        finally:
            batch.unpersist()

    records = metrics.event_time(source.transform(transform), ts)
    if delay is not None:
        records = records.withWatermark("event_ts", delay)
    return (
        aggregate(records, size)
        .writeStream.outputMode("update")
        .foreachBatch(write)
        .queryName(name)
        .option("checkpointLocation", _checkpoint(source, checkpoint, name))
        .trigger(**trigger)
        .start()
    )


def run_rejects(
    source: DataFrame, message: StructType, folder: str, name: str = "rejects",
    checkpoint: str | None = None, trigger: dict = DRAIN,
) -> StreamingQuery:
    """The bad ones of a source's (key, value) pairs, with their reason, exactly once."""
    return (
        split_bad(source, message)[1]
        .writeStream.format("parquet")
        .queryName(name)
        .option("checkpointLocation", _checkpoint(source, checkpoint, name))
        .trigger(**trigger)
        .start(folder)
    )


def run_rollup(
    source: DataFrame,
    transform: Transform,
    table: RollupTable,
    name: str,
    checkpoint: str | None = None,
    ts: str = "timestamp",
    fold_every: int | None = 100,
    trigger: dict = DRAIN,
    message: StructType | None = None,
    fmt: str = "json",
    rejects: str | None = None,
) -> StreamingQuery:
    """Records to the partials of their windows, which dashboards read.

    ``ts`` is the event time of a record in milliseconds. Nothing is kept in a state and no record
    is too late: each micro-batch appends its own partials. Every ``fold_every`` micro-batches
    those before are added up in one folder.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = _read_messages(batch, batch_id, message, fmt, rejects)
        writer = _writer(batch, "").removeprefix("@")
        table.append(metrics.event_time(rows.transform(transform), ts), writer, batch_id)
        if fold_every and batch_id and batch_id % fold_every == 0:
            # The batch itself may yet be replayed; those before it can't.
            table.fold(writer, batch_id - 1)

    return (
        source.writeStream.foreachBatch(write)
        .queryName(name)
        .option("checkpointLocation", _checkpoint(source, checkpoint, name))
        .trigger(**trigger)
        .start()
    )


def run_notifications(
    source: DataFrame,
    transform: Transform,
    out: str,
    name: str = "notifications",
    checkpoint: str | None = None,
    threshold: float = alerts.ALERT_RISK,
    environment: str = "development",
    trigger: dict = DRAIN,
    message: StructType | None = None,
    fmt: str = "json",
    rejects: str | None = None,
) -> StreamingQuery:
    """One stream, two sinks: tagged points, and alerts as JSON lines.

    Each micro-batch of each query owns a directory per sink and overwrites it when replayed; a
    query that starts over from a fresh checkpoint leaves the directories of others alone.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = _read_messages(batch, batch_id, message, fmt, rejects)
        records = rows.transform(transform).persist()
        try:
            alerts.tagged_notifications(records, environment).write.mode("overwrite").parquet(
                _own_folder(f"{out}/points", batch, batch_id)
            )
            alerts.json_lines(alerts.high_risk_alerts(records, threshold)).write.mode(
                "overwrite"
            ).text(_own_folder(f"{out}/alerts", batch, batch_id))
        finally:
            records.unpersist()

    return (
        source.writeStream.foreachBatch(write)
        .queryName(name)
        .option("checkpointLocation", _checkpoint(source, checkpoint, name))
        .trigger(**trigger)
        .start()
    )


def distinct_requests(
    df: DataFrame, ts_ms: str = "systemTime", key: str = "requestId", delay: str = "1 hour"
) -> DataFrame:
    """Drop repeats of a request that arrive within ``delay`` of each other."""
    stamped = df.withColumn("_ts", F.timestamp_millis(F.col(ts_ms)))
    return stamped.withWatermark("_ts", delay).dropDuplicatesWithinWatermark([key]).drop("_ts")


def run_console(
    source: DataFrame, name: str, checkpoint: str | None = None, trigger: dict = DRAIN
) -> StreamingQuery:
    """Rows to the console, for a look at a running flow."""
    return (
        source.writeStream.format("console")
        .option("truncate", "false")
        .option("checkpointLocation", _checkpoint(source, checkpoint, name))
        .trigger(**trigger)
        .start()
    )
