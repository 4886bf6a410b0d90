"""Window metrics and roll-ups at their default sizes, on small frames."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditflow import schemas
from creditflow.operators import dashboard, metrics

T0 = 1_700_000_000_000


def analytics(spark, rows):
    return metrics.event_time(spark.createDataFrame(rows, schemas.LOAN_ANALYTICS), "timestamp")


def points(spark, rows):
    return spark.createDataFrame(rows, schemas.WINDOW_METRICS)


def point(end, rate=0.5, approved=1, rejected=1, total=100.0, avg=100.0, risk=0.5, high=0):
    return (end - 500, end + 500, end - 1, end, approved, rejected, rate, total, avg, risk, high,
            10.0)


def test_golden_window(spark):
    """0.70 is not high risk; the mean amount is over approved; 43 div 4 is 10."""
    df = analytics(spark, [
        (1000, True, 100.0, 0.70, 10), (1200, False, 0.0, 0.71, 11),
        (1900, True, 300.0, 0.10, 10), (1500, False, 0.0, 0.90, 12)])
    row = metrics.window_metrics(df).first()
    assert row.asDict() == {
        "bucket_start": 1000, "bucket_end": 2000, "window_start": 1000, "window_end": 1900,
        "approved_count": 2, "rejected_count": 2, "approval_rate": 0.5, "total_amount": 400.0,
        "avg_amount": 200.0, "avg_risk_score": 0.6025, "high_risk_count": 2,
        "avg_proc_time": 10.0}


def test_no_approved_loan(spark):
    row = metrics.window_metrics(analytics(spark, [(5, False, 0.0, 0.2, 7)])).first()
    assert (row.approval_rate, row.avg_amount, row.total_amount) == (0.0, 0.0, 0.0)


def test_negative_latency_truncates_toward_zero(spark):
    df = analytics(spark, [(1, True, 0.0, 0.1, -3), (2, True, 0.0, 0.1, -4)])
    assert metrics.window_metrics(df).first().avg_proc_time == -3.0


def test_risk_sum_is_exact_in_any_order(spark):
    rows = [(1, True, 100.0, (i % 100) / 100, 1) for i in range(1000)]
    a = metrics.window_metrics(analytics(spark, rows).repartition(1)).first()
    b = metrics.window_metrics(analytics(spark, rows[::-1]).repartition(7)).first()
    assert a == b and a.avg_risk_score == 0.495


def test_default_windows(spark):
    df = analytics(spark, [(T0 + 100 * i, True, 100.0, 0.1, 1) for i in range(25)])
    counts = metrics.window_metrics(df).orderBy("bucket_start").select("approved_count")
    assert [r[0] for r in counts.collect()] == [10, 10, 5]
    notes = df.withColumns({"loan_decision": F.lit(True), "processing_time_ms": F.lit(3)})
    two = metrics.notification_metrics(notes).orderBy("bucket_start").collect()
    assert [r.total_count for r in two] == [20, 5]


def test_notification_metrics_count_every_amount(spark):
    rows = [(0, 100.0, True, 0.75, 3), (1, 300.0, False, 0.25, 4)]
    df = metrics.event_time(
        spark.createDataFrame(
            rows, "event_time long, loan_amount double, loan_decision boolean, "
            "risk_score double, processing_time_ms long"), "event_time")
    row = metrics.notification_metrics(df).first()
    assert (row.total_count, row.approved_count, row.rejected_count) == (2, 1, 1)
    assert (row.total_amount, row.avg_amount, row.avg_risk_score) == (400.0, 200.0, 0.5)
    assert (row.high_risk_count, row.avg_processing_time) == (1, 3.5)


def test_line_text(spark):
    line = metrics.line_protocol(points(spark, [point(T0, rate=0.25, total=1200.0)])).first()
    assert line.value == (
        "loan_decisions,window_type=tumbling approved_count=1i,rejected_count=1i,"
        "approval_rate=0.25,total_amount=1200.0,avg_amount=100.0,avg_risk_score=0.5,"
        f"high_risk_count=0i,avg_proc_time=10.0,window_start={T0 - 1}i,window_end={T0}i "
        f"{T0}000000")


def test_long_and_back(spark):
    wide = points(spark, [point(T0), point(T0 + 1000, rate=0.75)])
    long = metrics.metrics_long(wide)
    assert long.count() == 2 * len(metrics.METRIC_FIELDS)
    back = metrics.metrics_pivot(long).orderBy("time").collect()
    assert [r.approval_rate for r in back] == [0.5, 0.75]


def test_points_split(spark):
    df = spark.createDataFrame(
        [(None, "HIGH", 7, 0.5, True), (5, "LOW", None, 1.5, False)],
        "timestamp long, severity string, customer_id int, risk double, flag boolean")
    got = metrics.points(df, "timestamp", F.lit(99)).orderBy("time", "field").collect()
    assert [tuple(r) for r in got] == [
        (5, "LOW", "risk", 1.5), (99, "HIGH", "customer_id", 7.0), (99, "HIGH", "risk", 0.5)]


def test_trailing_range_and_last(spark):
    hour = dashboard.HOUR_MS
    df = points(spark, [point(T0 - 2 * hour, 0.1), point(T0 - hour, 0.2), point(T0, 0.3)])
    recent = dashboard.trailing(df, dashboard.latest(df), hour)
    assert sorted(r.approval_rate for r in recent.collect()) == [0.2, 0.3]
    assert dashboard.last_values(recent).first().approval_rate == 0.3
    literal = dashboard.trailing(df, F.lit(T0 + hour), hour)
    assert [r.time for r in dashboard.series(literal, "approval_rate").collect()] == [T0]


def test_trend_buckets(spark):
    start = T0 - T0 % 30_000
    df = points(spark, [point(start, 0.2), point(start + 29_999, 0.4), point(start + 90_000, 0.9)])
    got = dashboard.trend(df).orderBy("time").collect()
    assert [r.time for r in got] == [start + 30_000, start + 120_000]
    assert [round(r.approval_rate, 9) for r in got] == [0.3, 0.9]


def test_daily(spark):
    df = points(spark, [point(T0, approved=3, rejected=1, avg=100.0, high=2),
                        point(T0 + 1, approved=0, rejected=0, avg=50.0, total=0.0)])
    row = dashboard.daily(df).first()
    assert (row.approved, row.rejected, row.high_risk) == (3, 1, 2)
    assert (row.total_amount, row.avg_amount, row.daily_approval_rate) == (100.0, 75.0, 0.75)
    assert dashboard.daily(df.limit(0)).first().daily_approval_rate == 0.0
