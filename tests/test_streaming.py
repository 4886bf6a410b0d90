"""Stream = batch: each job over files that arrive one by one, against the batch functions."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from creditflow import schemas
from creditflow.operators import alerts, merge, metrics, outbox
from creditflow.plans import inputs, stages
from creditflow.sources import topics
from creditflow.sources.stage_table import StageTable
from creditflow.streaming import jobs
from creditflow.streaming.state import count_events, counts_by_key
from oracle_check import rows_of


def rows(df):
    return rows_of(df.columns, df.collect())


def drained(query):
    try:
        assert query.awaitTermination(120)
    finally:
        query.stop()
    assert query.exception() is None
    return query


@pytest.fixture
def topic(spark, tmp_path):
    """Write messages as a topic of several files, and open it one file per micro-batch."""

    def make(messages, name, files=4, order=None):
        path = str(tmp_path / name)
        out = messages.repartitionByRange(files, order) if order else messages.repartition(files)
        out.write.parquet(path)
        return topics.read_topic(spark, path, messages.schema, files_per_trigger=1)

    return make


def stage_table(spark, tmp_path, name, schema, **kw):
    return StageTable(spark, str(tmp_path / f"table_{name}"), schema, buckets=4, **kw)


def test_whole_flow_stream_equals_batch(spark, data, tmp_path, topic):
    """e1/e3 -> income -> risk -> decision -> metrics, with outbox passes in between."""
    flow = inputs.order_flow(spark, data)
    ck = str(tmp_path / "ck")
    order = inputs.REISSUE_ORDER
    income = stage_table(spark, tmp_path, "income", schemas.INCOME_TABLE)
    drained(jobs.run_upsert(
        topic(flow.e1, "e1"), lambda df: stages.stage_income(df, flow.clock("e1_consume")),
        merge.INCOME, income, order, "income", f"{ck}/income"))
    assert jobs.run_outbox(income, outbox.INCOME, f"{tmp_path}/e2", flow.clock("e2_produce"))
    assert rows(income.read()) == rows(flow.income_sent)

    npl = stage_table(spark, tmp_path, "npl", schemas.NPL_TABLE)
    e2 = topics.read_topic(spark, f"{tmp_path}/e2", schemas.INCOME_RESULT)
    drained(jobs.run_upsert(
        e2, lambda df: stages.stage_npl_income(df, flow.clock("e2_consume"), flow.draw),
        merge.NPL_FROM_INCOME, npl, order, "npl_income", f"{ck}/npl_income"))
    drained(jobs.run_upsert(
        topic(flow.e3, "e3"),
        lambda df: stages.stage_npl_request(df, flow.clock("e3_consume"), flow.draw),
        merge.NPL_FROM_REQUEST, npl, order, "npl_request", f"{ck}/npl_request"))
    assert jobs.run_outbox(npl, outbox.NPL, f"{tmp_path}/e4", flow.clock("e4_produce"))
    assert rows(npl.read()) == rows(flow.npl_sent)

    loan = stage_table(spark, tmp_path, "loan", schemas.LOAN_TABLE)
    e4 = topics.read_topic(spark, f"{tmp_path}/e4", schemas.NPL_RESULT)
    drained(jobs.run_upsert(
        e4, lambda df: stages.stage_decision(df, flow.clock("e4_consume"), flow.draw),
        merge.LOAN, loan, order, "loan", f"{ck}/loan"))
    assert jobs.run_outbox(loan, outbox.DISBURSEMENT, f"{tmp_path}/e6", flow.clock("e6_produce"))
    assert rows(loan.read()) == rows(flow.loan_sent)

    e6 = topics.read_topic(spark, f"{tmp_path}/e6", schemas.DECISION_RESULT, files_per_trigger=2)
    sink = stage_table(spark, tmp_path, "metrics", schemas.WINDOW_METRICS, key="bucket_start")
    drained(jobs.run_metrics(
        e6, lambda df: stages.stage_analytics(df, flow.clock("analytics")), "metrics",
        f"{ck}/metrics", size="1 day", delay="4000 days", sink=sink, lines=f"{tmp_path}/lines"))
    expected = flow.metrics("1 day")
    assert rows(sink.read()) == rows(expected.select(sink.schema.fieldNames()))
    newest = spark.read.text(f"{tmp_path}/lines/*/*").select("value").distinct()
    assert metrics.line_protocol(expected).exceptAll(newest).count() == 0


def event_records(spark, data):
    """Events as analytics records: purchases are approved, the value is the amount."""
    events = spark.read.parquet(f"{data}/events.parquet")
    return events.select(
        "event_id",
        F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"),
        (F.col("event_type") == "purchase").alias("is_approved"),
        F.floor("value").cast("double").alias("loan_amount"),
        ((F.col("event_id") % 100) / 100).alias("risk_score"),
        F.col("user_id").alias("processing_time"),
    )


def batch_metrics(records, size):
    return metrics.window_metrics(metrics.event_time(records, "timestamp"), size)


def late_files(records, path):
    """Six files in time order, every tenth row moved two files later."""
    n = 6
    total = records.count()
    ranked = records.withColumn("f", F.least(F.lit(n - 1), F.floor(F.col("event_id") * n / total)))
    moved = ranked.withColumn(
        "f", F.when(F.col("event_id") % 10 == 0, F.least(F.lit(n - 1), F.col("f") + 2))
        .otherwise(F.col("f")))
    for i in range(n):
        moved.filter(F.col("f") == i).drop("f").coalesce(1).write.mode("append").parquet(path)


@pytest.mark.parametrize("delay, keeps_all", [(None, True), ("60 days", True), ("1 hour", False)])
def test_late_rows(spark, data, tmp_path, delay, keeps_all):
    """The default and a long delay give the batch result; a short one drops late rows and says so."""
    records = event_records(spark, data)
    path = str(tmp_path / "late")
    late_files(records, path)
    source = topics.read_topic(spark, path, records.schema, files_per_trigger=1)
    sink = stage_table(spark, tmp_path, "m", schemas.WINDOW_METRICS, key="bucket_start")
    query = drained(jobs.run_metrics(source, lambda df: df, "late", str(tmp_path / "ck"),
                                     size="1 hour", delay=delay, sink=sink))
    dropped = sum(
        s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
    assert (dropped == 0) == keeps_all
    expected = batch_metrics(records, "1 hour").select(sink.schema.fieldNames())
    n = "sum(approved_count + rejected_count)"
    if keeps_all:
        assert rows(sink.read()) == rows(expected)
    else:
        assert sink.read().selectExpr(n).first()[0] < expected.selectExpr(n).first()[0]


def test_metrics_without_sink(spark, data, tmp_path, topic):
    source = topic(event_records(spark, data), "e", files=2)
    query = drained(jobs.run_metrics(source, lambda df: df, "nosink", str(tmp_path / "ck")))
    assert sum(p["numInputRows"] for p in query.recentProgress) > 0


def test_metrics_started_over(spark, data, tmp_path, topic):
    """A fresh checkpoint replays the topic into the same table: same windows, same values."""
    records = event_records(spark, data)
    source = topic(records, "e")
    sink = stage_table(spark, tmp_path, "m", schemas.WINDOW_METRICS, key="bucket_start")
    for attempt in ("a", "b"):
        drained(jobs.run_metrics(source, lambda df: df, "again", str(tmp_path / attempt),
                                 size="1 hour", delay="60 days", sink=sink))
    assert len(sink.snapshot().writers) == 2
    expected = batch_metrics(records, "1 hour").select(sink.schema.fieldNames())
    assert rows(sink.read()) == rows(expected)


def test_metrics_started_over_on_a_shortened_topic(spark, data, tmp_path, topic):
    """The topic has lost its oldest records: windows that were complete stay as they were."""
    records = event_records(spark, data)
    sink = stage_table(spark, tmp_path, "m", schemas.WINDOW_METRICS, key="bucket_start")
    for name, part in (("whole", records), ("short", records.filter("event_id % 10 = 0"))):
        drained(jobs.run_metrics(topic(part, name), lambda df: df, "again", str(tmp_path / f"ck_{name}"),
                                 size="1 hour", sink=sink))
    expected = batch_metrics(records, "1 hour").select(sink.schema.fieldNames())
    assert rows(sink.read()) == rows(expected)


def test_notifications_started_over_keep_earlier_output(spark, data, tmp_path, topic):
    flow, out = inputs.order_flow(spark, data), str(tmp_path / "notify")
    stage = lambda df: stages.stage_notify(df, flow.clock("notify"))
    total = 0
    for name, part in (("a", flow.e6.filter("creditScore % 2 = 0")), ("b", flow.e6.filter("creditScore % 6 = 1"))):
        drained(jobs.run_notifications(topic(part, name), stage, out, checkpoint=str(tmp_path / f"ck_{name}"), threshold=0.2))
        total += part.count()
    assert spark.read.parquet(f"{out}/points").count() == total
    want = alerts.high_risk_alerts(flow.notifications.filter("credit_score % 2 = 0 OR credit_score % 6 = 1"), 0.2)
    assert spark.read.text(f"{out}/alerts").count() == want.count() > 0


def test_keyed_topic_with_codec_and_dead_letters(spark, data, tmp_path):
    """Outbox to a (key, value) topic, and an upsert that decodes it and sets bad messages aside."""
    flow, order = inputs.order_flow(spark, data), inputs.REISSUE_ORDER
    income = stage_table(spark, tmp_path, "income", schemas.INCOME_TABLE)
    income.merge(flow.income, merge.INCOME, order)
    wire = str(tmp_path / "e2")
    assert jobs.run_outbox(income, outbox.INCOME, wire, flow.clock("e2_produce"), fmt="json")
    sent = spark.read.parquet(wire)
    assert sent.columns == ["key", "value"] and sent.filter("key IS NULL").count() == 0
    bad = [("k", bytearray(b"{broken")), ("k", None), ("k", bytearray(b'{"requestId": "x"}'))]
    spark.createDataFrame(bad, topics.WIRE).write.mode("append").parquet(wire)
    npl = stage_table(spark, tmp_path, "npl", schemas.NPL_TABLE)
    drained(jobs.run_upsert(
        topics.read_topic(spark, wire, topics.WIRE),
        lambda df: stages.stage_npl_income(df, flow.clock("e2_consume"), flow.draw),
        merge.NPL_FROM_INCOME, npl, order, "npl_income", str(tmp_path / "ck"),
        message=schemas.INCOME_RESULT, rejects=str(tmp_path / "bad")))
    assert rows(npl.read()) == rows(flow.npl_income.select(npl.schema.fieldNames()) if set(npl.schema.fieldNames()) <= set(flow.npl_income.columns) else npl.read())
    assert npl.read().count() == flow.npl_income.count()
    assert spark.read.parquet(str(tmp_path / "bad")).count() == len(bad)


def test_a_job_needs_a_checkpoint(spark, data):
    if not spark.conf.get("spark.checkpoint.dir", None):
        with pytest.raises(ValueError):
            jobs.run_console(spark.readStream.format("rate").load(), "none")


def test_running_outbox(spark, data, tmp_path):
    """Rows that come in while it runs go out without a caller."""
    flow = inputs.order_flow(spark, data)
    income = stage_table(spark, tmp_path, "income", schemas.INCOME_TABLE)
    income.merge(flow.income, merge.INCOME, inputs.REISSUE_ORDER)
    query = jobs.poll_outbox(income, outbox.INCOME, str(tmp_path / "e2"), "poll", checkpoint=str(tmp_path / "ck"))
    try:
        for _ in range(120):
            if outbox.pending(income.read(), outbox.INCOME).isEmpty():
                break
            time.sleep(0.5)
    finally:
        query.stop()
    assert outbox.pending(income.read(), outbox.INCOME).isEmpty()


def test_native_counts(spark, data):
    events = spark.read.parquet(f"{data}/events.parquet").select("event_id", "user_id")
    assert rows(counts_by_key(events, "user_id")) == rows(
        events.groupBy("user_id").agg(F.count("*").alias("event_count")))


def test_a_replayed_micro_batch_is_merged_once(spark, data, tmp_path, topic):
    """A query that died between its merge and its commit log runs its last batch again."""
    records = event_records(spark, data)
    source, ck = topic(records, "e"), tmp_path / "ck"
    sink = stage_table(spark, tmp_path, "m", schemas.WINDOW_METRICS, key="bucket_start")

    def run():
        drained(jobs.run_metrics(source, lambda df: df, "replay", str(ck), size="1 hour",
                                 delay="60 days", sink=sink))

    run()
    version = sink.snapshot().version
    last = max((f for f in (ck / "commits").iterdir() if f.name.isdigit()), key=lambda f: int(f.name))
    last.unlink()
    (ck / "commits" / f".{last.name}.crc").unlink(missing_ok=True)
    run()
    assert sink.snapshot().version == version
    expected = batch_metrics(records, "1 hour").select(sink.schema.fieldNames())
    assert rows(sink.read()) == rows(expected)


def test_processing_time_windows(spark, data, tmp_path, topic):
    """The wall clock as event time: all decisions of a micro-batch share its reading."""
    flow = inputs.order_flow(spark, data)
    sink = stage_table(spark, tmp_path, "pt", schemas.WINDOW_METRICS, key="bucket_start")
    from creditflow.functions.clock import now_ms

    drained(jobs.run_metrics(
        topic(flow.e6, "e6", files=1), lambda df: stages.stage_analytics(df, now_ms()), "pt",
        str(tmp_path / "ck"), size="1 second", sink=sink))
    got = sink.read()
    assert got.selectExpr("sum(approved_count + rejected_count)").first()[0] == flow.e6.count()


def test_running_count_state(spark, data, tmp_path, topic):
    """Every key counts 1..n without gaps, across micro-batches."""
    events = spark.read.parquet(f"{data}/events.parquet").select("event_id", "user_id")
    out = str(tmp_path / "counted")
    drained(jobs.run_publish(topic(events, "ev"), out, "count", str(tmp_path / "ck"),
                             count_by="user_id"))
    got = spark.read.parquet(out)
    per_key = got.groupBy("user_id").agg(
        F.count("*").alias("n"), F.max("event_count").alias("m"),
        F.count_distinct("event_count").alias("d"))
    assert per_key.filter("n <> m OR n <> d").count() == 0
    assert rows(got.select("event_id", "user_id")) == rows(events)
    assert "event_count" in count_events(events, "user_id").columns


def test_duplicate_requests_are_dropped(spark, data, tmp_path, topic):
    flow = inputs.order_flow(spark, data)
    twice = flow.e1.unionByName(flow.e1)
    out = str(tmp_path / "once")
    drained(jobs.run_publish(
        topic(twice, "twice", files=2), out, "once", str(tmp_path / "ck"),
        transform=lambda df: jobs.distinct_requests(df, delay="4000 days")))
    assert rows(spark.read.parquet(out)) == rows(flow.e1)


def test_publish_replays_nothing(spark, data, tmp_path, topic):
    """A restart from the same checkpoint adds no rows."""
    e1 = inputs.order_flow(spark, data).e1
    source, out = topic(e1, "src"), str(tmp_path / "out")
    for _ in range(2):
        drained(jobs.run_publish(source, out, "pub", str(tmp_path / "ck")))
    assert rows(spark.read.schema(e1.schema).parquet(out)) == rows(e1)


def test_notification_metrics_stream(spark, data, tmp_path, topic):
    """The same job with the notification aggregate, JSON lines and its own table."""
    flow = inputs.order_flow(spark, data)
    sink = stage_table(spark, tmp_path, "n", schemas.NOTIFICATION_METRICS, key="bucket_start")
    drained(jobs.run_metrics(
        topic(flow.e6, "e5"), lambda df: stages.stage_notify(df, flow.clock("notify")), "notes",
        str(tmp_path / "ck"), ts="event_time", size="1 day", delay="4000 days",
        aggregate=metrics.notification_metrics, spec=merge.NOTIFICATION_METRICS, sink=sink,
        lines=f"{tmp_path}/lines",
        as_lines=lambda df: metrics.notification_json(df, F.col("bucket_end"))))
    expected = metrics.notification_metrics(
        metrics.event_time(flow.notifications, "event_time"), "1 day")
    assert rows(sink.read()) == rows(expected.select(sink.schema.fieldNames()))
    newest = spark.read.text(f"{tmp_path}/lines/*/*").select("value").distinct()
    want = metrics.notification_json(expected, F.col("bucket_end"))
    assert want.exceptAll(newest).count() == 0


def test_idle_state_is_dropped(spark, tmp_path):
    """A key that was idle starts over; one that was not goes on."""
    path = tmp_path / "in"
    (tmp_path / "out").mkdir()
    schema = "user_id long, n long"

    def send(*users):
        spark.createDataFrame([(u, 0) for u in users], schema).coalesce(1).write.mode(
            "append").parquet(str(path))

    send(1, 2)
    source = spark.readStream.schema(schema).parquet(str(path))
    out = str(tmp_path / "out")
    query = jobs.run_publish(
        source, out, "idle", str(tmp_path / "ck"), count_by="user_id", idle_minutes=0.02,
        trigger={"processingTime": "1 second"})

    def rows_out(n):
        for _ in range(60):
            got = spark.read.schema("user_id long, event_count long").parquet(out).collect()
            if len(got) >= n:
                return got
            time.sleep(0.5)
        raise AssertionError(f"fewer than {n} rows: {query.exception()}")

    try:
        rows_out(2)
        time.sleep(6)
        send(1)
        got = rows_out(3)
    finally:
        query.stop()
    assert sorted(r.event_count for r in got if r.user_id == 1) == [1, 1]


def test_notifications_fan_out(spark, data, tmp_path, topic):
    flow = inputs.order_flow(spark, data)
    out = str(tmp_path / "notify")
    drained(jobs.run_notifications(
        topic(flow.e6, "e5"), lambda df: stages.stage_notify(df, flow.clock("notify")), out,
        checkpoint=str(tmp_path / "ck"), threshold=0.45))
    expected = flow.notifications
    points = spark.read.parquet(f"{out}/points")
    tagged = alerts.tagged_notifications(expected)
    assert rows(points.select(tagged.columns)) == rows(tagged)
    lines = spark.read.text(f"{out}/alerts").select("value")
    want = alerts.json_lines(alerts.high_risk_alerts(expected, 0.45))
    assert rows(lines) == rows(want) and want.count() > 0


def test_latest_skips_older_messages(spark, data, tmp_path):
    e1 = inputs.order_flow(spark, data).e1
    path = str(tmp_path / "e1")
    e1.write.parquet(path)
    cut = e1.agg(F.percentile_approx("systemTime", 0.5)).first()[0]
    source = topics.read_topic(
        spark, path, e1.schema, start="latest", since=F.col("systemTime") >= cut)
    out = str(tmp_path / "out")
    drained(jobs.run_publish(source, out, "latest", str(tmp_path / "ck")))
    assert rows(spark.read.parquet(out)) == rows(e1.filter(F.col("systemTime") >= cut))
    with pytest.raises(ValueError):
        topics.read_topic(spark, path, e1.schema, start="latest")


def test_text_and_bytes_topics(spark, tmp_path):
    (tmp_path / "text").mkdir()
    (tmp_path / "text" / "a.txt").write_text("one\ntwo\n")
    (tmp_path / "bytes").mkdir()
    (tmp_path / "bytes" / "m1").write_bytes(b"\x00\x01raw")
    for name, source in [
        ("text", topics.read_text_topic(spark, str(tmp_path / "text"))),
        ("bytes", topics.read_bytes_topic(spark, str(tmp_path / "bytes"))),
    ]:
        drained(jobs.run_publish(source.select("value"), str(tmp_path / f"out_{name}"), name,
                                 str(tmp_path / f"ck_{name}")))
    text = [r.value for r in spark.read.parquet(str(tmp_path / "out_text")).collect()]
    assert sorted(text) == ["one", "two"]
    raw = spark.read.parquet(str(tmp_path / "out_bytes")).first().value
    assert bytes(raw) == b"\x00\x01raw"


def test_checkpoint_comes_from_the_session(spark):
    """The cluster's folder wins; only a local session may make its own."""
    from types import SimpleNamespace

    from creditflow.session import checkpoint_root

    def session(master, **conf):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default=None: conf.get(key, default)),
            sparkContext=SimpleNamespace(master=master))

    shared = {"spark.checkpoint.dir": "hdfs:///shared/"}
    assert checkpoint_root(session("spark://x", **shared)) == "hdfs:///shared"
    assert checkpoint_root(spark)
    with pytest.raises(ValueError):
        checkpoint_root(session("spark://x"))


def test_console(spark, data, tmp_path, topic):
    e1 = inputs.order_flow(spark, data).e1.limit(3)
    drained(jobs.run_console(topic(e1, "c", files=1), "console", str(tmp_path / "ck")))
