"""Roll-up of window partials, windows that fire once, the log-driven outbox, counts of busy keys."""

from __future__ import annotations

import json
import time

import pytest
from pyspark.sql import functions as F

from creditflow import schemas
from creditflow.operators import counter, dashboard, merge, metrics, outbox
from creditflow.plans import inputs
from creditflow.sources import files, topics
from creditflow.sources.rollup import RollupTable
from creditflow.sources.stage_table import StageTable
from creditflow.streaming import jobs, windows
from oracle_check import rows_of

DAY = dashboard.DAY_MS


def rows(df):
    return rows_of(df.columns, df.collect())


def drained(query):
    try:
        assert query.awaitTermination(120)
    finally:
        query.stop()
    assert query.exception() is None


def decisions(spark, n=3000, span=40 * DAY, first=0):
    """Decisions of forty days, most of them of one window, some without a risk."""
    ts = F.when(F.col("id") % 3 == 0, F.lit(7 * DAY + 5)).otherwise(F.pmod(F.xxhash64("id"), F.lit(span)))
    return spark.range(first, first + n).select(
        F.concat(F.lit("r"), "id").alias("request_id"), ts.alias("timestamp"), (F.col("id") % 2 == 0).alias("is_approved"),
        F.when(F.col("id") % 2 == 0, (F.col("id") % 50) * 100.0).otherwise(0.0).alias("loan_amount"),
        (F.col("id") % 97 / 100).alias("risk_score"), (F.col("id") % 4000).alias("processing_time"),
    )


def whole(df, size_ms=DAY):
    return metrics.window_metrics(metrics.event_time(df, "timestamp"), f"{size_ms} milliseconds")


def test_partials_of_any_split_merge_alike(spark):
    df = metrics.event_time(decisions(spark), "timestamp")
    parts = [metrics.window_partials(df.filter(F.col("processing_time") % 3 == k), "1 day") for k in range(3)]
    merged = metrics.merged(parts[0].union(parts[1]).union(parts[2]))
    assert rows(metrics.finished(merged)) == rows(whole(decisions(spark)))


def test_stream_of_partials_equals_batch(spark, tmp_path):
    records = decisions(spark)
    records.repartition(7).write.parquet(f"{tmp_path}/e6")
    table = RollupTable(spark, f"{tmp_path}/rollup", DAY)
    start = lambda ck: drained(jobs.run_rollup(
        topics.read_topic(spark, f"{tmp_path}/e6", records.schema, files_per_trigger=1), lambda df: df, table, "roll", ck, fold_every=3))
    start(f"{tmp_path}/ck")
    assert rows(table.windows()) == rows(whole(records))
    # Six of the seven micro-batches are in one folder, what it covers goes with the next fold.
    assert [f.split("=")[-1] for f in table.folders()] == ["000000000000-000000000005", "000000000006-000000000006"]
    before = {f: sorted(files.names(spark, f)) for f in table.folders()}
    # A second round of records touches folders of its own and the days it holds only.
    decisions(spark, 10, DAY, 10_000).filter("timestamp < 86400000").coalesce(1).write.mode("append").parquet(f"{tmp_path}/e6")
    start(f"{tmp_path}/ck")
    new = [f for f in table.folders() if f not in before]
    assert new and all(n in ("_SUCCESS", "period=0") for f in new for n in files.names(spark, f) if not n.startswith("."))
    assert {f: sorted(files.names(spark, f)) for f in before} == before
    everything = spark.read.schema(records.schema).parquet(f"{tmp_path}/e6")
    assert rows(table.windows()) == rows(whole(everything))


def test_replayed_batch_counts_once(spark, tmp_path):
    table, df = RollupTable(spark, str(tmp_path / "r"), DAY), metrics.event_time(decisions(spark), "timestamp")
    for batch_id in (0, 0, 1, 0):
        table.append(df.filter(F.col("processing_time") % 2 == batch_id), "q", batch_id)
    table.append(df.limit(0), "q", 2)
    assert rows(table.windows()) == rows(whole(decisions(spark)))
    table.fold("q", 1)
    assert rows(table.windows()) == rows(whole(decisions(spark)))
    table.fold("q", 2)
    assert sorted(f.split("=")[-1] for f in table.folders()) == ["000000000000-000000000002"]
    assert rows(table.windows()) == rows(whole(decisions(spark)))


def test_unfinished_folder_is_not_read(spark, tmp_path):
    table, df = RollupTable(spark, str(tmp_path / "r"), DAY), metrics.event_time(decisions(spark), "timestamp")
    table.append(df, "q", 0)
    table.append(df, "q", 1)
    files.delete(spark, table.folders()[1] + "/_SUCCESS")
    assert rows(table.windows()) == rows(whole(decisions(spark)))


def test_empty_rollup(spark, tmp_path):
    table = RollupTable(spark, str(tmp_path / "none"))
    assert table.windows().count() == 0 and table.recent(DAY).count() == 0
    assert dashboard.daily(table.recent(DAY)).first().approved == 0


def _files_read(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    total, ahead = 0, [plan]
    while ahead:
        node = ahead.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            ahead.append(node.executedPlan())
            continue
        if node.nodeName().endswith("QueryStage"):
            ahead.append(node.plan())
            continue
        if node.nodeName().startswith("Scan parquet") or node.nodeName().startswith("FileScan"):
            total += node.metrics().apply("numFiles").value()
        ahead.extend(node.children().apply(i) for i in range(node.children().size()))
    return total


def test_range_reads_its_days_only(spark, tmp_path):
    table, df = RollupTable(spark, str(tmp_path / "r"), 3_600_000), decisions(spark, 4000)
    table.append(metrics.event_time(df, "timestamp"), "q", 0)
    anchor = df.agg(F.max("timestamp")).first()[0]
    for length in (0, DAY, 5 * DAY, 100 * DAY):
        want = dashboard.trailing(whole(df, 3_600_000), F.lit(anchor), length)
        assert rows(table.recent(length)) == rows(want)
        assert rows(table.recent(length, F.lit(anchor))) == rows(want)
    one, five, every = (_files_read(table.recent(d * DAY)) for d in (1, 5, 100))
    assert one < five < every and one <= 3 and every >= 39


# Windows that fire once


def test_each_window_fires_once_and_its_state_goes(spark, tmp_path):
    now = int(time.time() * 1000) // 1000 * 1000
    old, soon = now - 60_000, now + 15_000
    records = [(f"r{i}", old if i % 10 == 0 else soon + 1000 * (i % 2) + i % 7, i % 2 == 0, 100.0, 0.25, 3) for i in range(400)]
    df = spark.createDataFrame(records, "request_id string, timestamp long, is_approved boolean, loan_amount double, risk_score double, processing_time long")
    df.repartition(4).write.parquet(f"{tmp_path}/in")
    source = topics.read_topic(spark, f"{tmp_path}/in", df.schema, files_per_trigger=1)
    query = windows.run_windows(source, lambda x: x, f"{tmp_path}/out", "once", f"{tmp_path}/ck")
    state = []
    try:
        until = time.time() + 90
        while time.time() < until:
            time.sleep(1)
            if query.exception():
                raise query.exception()
            state = [p["stateOperators"][0]["numRowsTotal"] for p in map(json.loads, (x.json for x in query.recentProgress)) if p["stateOperators"]]
            if files.exists(spark, f"{tmp_path}/out/late=false") and windows.read_windows(spark, f"{tmp_path}/out").where("not late").count() >= 2:
                time.sleep(2)
                break
    finally:
        query.stop()
    out = windows.read_windows(spark, f"{tmp_path}/out")
    fired = out.where("not late")
    assert fired.count() == fired.select("bucket_start").distinct().count() == 2
    late = out.where("late")
    assert late.agg(F.sum("n")).first()[0] == 40 and {r.bucket_start for r in late.collect()} == {old}
    assert rows(metrics.finished(metrics.merged(out))) == rows(whole(df, 1000))
    assert state and state[-1] < max(state)


# The outbox by the table's log


@pytest.fixture
def loans(spark, data, tmp_path):
    flow = inputs.order_flow(spark, data)
    table = StageTable(spark, f"{tmp_path}/loan", schemas.LOAN_TABLE, buckets=4, day_of="system_time")
    return flow, table


def test_log_driven_passes_equal_a_scan(spark, loans, tmp_path, monkeypatch):
    flow, table = loans
    loan = flow.loan.persist()
    read = []
    plain = StageTable.read
    monkeypatch.setattr(StageTable, "read", lambda self, *a, **k: read.append(a) or plain(self, *a, **k))
    pass_ = lambda: drained(jobs.run_outbox_log(table, outbox.DISBURSEMENT, f"{tmp_path}/e6", "log", f"{tmp_path}/ck", proc_ms=flow.clock("e6_produce")))
    third = F.pmod(F.xxhash64("request_id"), F.lit(3))
    for k in range(2):
        table.merge(loan.filter(third == k), merge.LOAN, inputs.REISSUE_ORDER[:1])
    pass_()
    assert rows(table.read()) == rows(outbox.hand_over(loan.filter(third < 2), outbox.DISBURSEMENT, flow.clock("e6_produce")))
    pass_()  # sees the version that the marks left
    read.clear()
    pass_()
    assert not read
    # New rows of one day: a pass reads that day's parts.
    few = loan.filter(third == 2).orderBy("system_time").limit(3)
    table.merge(few, merge.LOAN, inputs.REISSUE_ORDER[:1])
    pass_()
    sent = spark.read.schema(schemas.DECISION_RESULT).parquet(f"{tmp_path}/e6")
    keys = [r[0] for r in sent.select("requestId").collect()]
    want = loan.filter(third < 2).count() + 3
    assert len(keys) == len(set(keys)) == want and outbox.pending(table.read(), outbox.DISBURSEMENT).isEmpty()
    loan.unpersist()


def test_log_with_a_gap_looks_through_the_table(spark, loans, tmp_path):
    flow, table = loans
    half = F.pmod(F.xxhash64("request_id"), F.lit(2))
    table.merge(flow.loan.filter(half == 0), merge.LOAN, inputs.REISSUE_ORDER[:1])
    table.merge(flow.loan.filter(half == 1).limit(1), merge.LOAN, inputs.REISSUE_ORDER[:1])
    table.expire(keep=1)
    drained(jobs.run_outbox_log(table, outbox.DISBURSEMENT, f"{tmp_path}/e6", "log", f"{tmp_path}/ck"))
    assert outbox.pending(table.read(), outbox.DISBURSEMENT).isEmpty()


# Counts of busy keys


def test_counts_of_a_busy_key_in_a_stream(spark, tmp_path):
    df = spark.range(2000).select(
        F.when(F.col("id") % 10 > 0, "hot").when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id") % 4)).alias("key"),
        (F.col("id") * 137).alias("ts"), F.col("id").alias("tie"))
    df.repartitionByRange(5, "ts").write.parquet(f"{tmp_path}/in")
    totals = StageTable(spark, f"{tmp_path}/totals", jobs.totals_schema(), key="key", buckets=2)
    source = lambda: topics.read_topic(spark, f"{tmp_path}/in", df.schema, files_per_trigger=1)
    drained(jobs.run_counted_publish(source(), "key", "ts", "tie", totals, f"{tmp_path}/out", "count", f"{tmp_path}/ck", slice_ms=5000))
    got = spark.read.option("recursiveFileLookup", True).parquet(f"{tmp_path}/out")
    want = counter.running_count(df, "key", "ts", "tie")
    got = {r.tie: (r.key, r.event_count) for r in got.collect()}
    # Files may come in any order, so a key's numbers are whole, and in order inside a file's range.
    by_key = {}
    for r in want.collect():
        by_key.setdefault(r.key, set()).add(r.event_count)
    assert {k: {n for key, n in got.values() if key == k} for k in by_key} == by_key and len(got) == 2000
    held = {r["key"]: r.event_count for r in totals.read().collect()}
    assert held["=hot"] == 1800 and held[""] == len(by_key[None])
    before = totals.snapshot().version
    drained(jobs.run_counted_publish(source(), "key", "ts", "tie", totals, f"{tmp_path}/out", "count", f"{tmp_path}/ck", slice_ms=5000))
    assert totals.snapshot().version == before


def test_counts_of_a_replayed_batch_stay(spark, tmp_path, monkeypatch):
    df = spark.range(50).select(F.lit("a").alias("key"), F.col("id").alias("ts"), F.col("id").alias("tie"))
    df.coalesce(1).write.parquet(f"{tmp_path}/in")
    totals = StageTable(spark, f"{tmp_path}/totals", jobs.totals_schema(), key="key", buckets=2)
    start = lambda: jobs.run_counted_publish(topics.read_topic(spark, f"{tmp_path}/in", df.schema), "key", "ts", "tie", totals, f"{tmp_path}/out", "c", f"{tmp_path}/ck")
    plain = StageTable.merge

    def merged_then_lost(self, *a):
        plain(self, *a)
        raise RuntimeError("lost")

    monkeypatch.setattr(StageTable, "merge", merged_then_lost)
    query = start()
    with pytest.raises(Exception, match="lost"):
        query.awaitTermination(60)
    monkeypatch.setattr(StageTable, "merge", plain)
    drained(start())
    out = spark.read.option("recursiveFileLookup", True).parquet(f"{tmp_path}/out")
    assert sorted(r.event_count for r in out.collect()) == list(range(1, 51))
    assert totals.read().first().event_count == 50


# Bad messages


def test_rejects_of_every_job(spark, tmp_path):
    good = decisions(spark, 20)
    schema = good.schema
    wire = topics.encode(good, schema, "request_id").unionByName(spark.createDataFrame([(None, bytearray(b"{broken"))], "key string, value binary"))
    wire.coalesce(1).write.parquet(f"{tmp_path}/wire")
    source = lambda: topics.read_topic(spark, f"{tmp_path}/wire", topics.WIRE)
    table = RollupTable(spark, f"{tmp_path}/roll", DAY)
    drained(jobs.run_rollup(source(), lambda df: df, table, "roll", f"{tmp_path}/ck1", message=schema, rejects=f"{tmp_path}/bad1"))
    assert rows(table.windows()) == rows(whole(good))
    sink = StageTable(spark, f"{tmp_path}/m", schemas.WINDOW_METRICS, key="bucket_start", buckets=2)
    drained(jobs.run_metrics(source(), lambda df: df, "m", f"{tmp_path}/ck2", size="1 day", sink=sink, message=schema, skip_bad=True))
    assert rows(sink.read()) == rows(whole(good))
    drained(jobs.run_rejects(source(), schema, f"{tmp_path}/bad2", "rejects", f"{tmp_path}/ck3"))
    for folder in ("bad1", "bad2"):
        bad = spark.read.option("recursiveFileLookup", True).parquet(f"{tmp_path}/{folder}")
        assert [r.reason for r in bad.collect()] == ["malformed"]
    notes = good.select("request_id", F.lit("a").alias("application_id"), F.lit(1).alias("customer_id"), F.col("is_approved").alias("loan_decision"), "loan_amount", "risk_score",
                        F.lit(700).cast("long").alias("credit_score"), F.col("processing_time").alias("processing_time_ms"), F.col("timestamp").alias("event_time"))
    topics.encode(notes, schemas.NOTIFICATION, "request_id").unionByName(wire.filter("key is null")).coalesce(1).write.parquet(f"{tmp_path}/notes")
    drained(jobs.run_notifications(topics.read_topic(spark, f"{tmp_path}/notes", topics.WIRE), lambda df: df, f"{tmp_path}/n", "n", f"{tmp_path}/ck4", message=schemas.NOTIFICATION, rejects=f"{tmp_path}/bad3"))
    assert spark.read.option("recursiveFileLookup", True).parquet(f"{tmp_path}/bad3").count() == 1
    assert spark.read.option("recursiveFileLookup", True).parquet(f"{tmp_path}/n/points").count() > 0
