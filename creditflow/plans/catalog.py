"""The registered queries: one per operator, each over whole tables.

Order dates span years, so the queries use one-day windows, a seven-day trend bucket and
trailing ranges anchored at the newest point; the operators' own defaults are one second,
thirty seconds and one hour.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditflow import schemas
from creditflow.functions import clock, jsonio, payload, scoring
from creditflow.operators import (
    alerts,
    counter,
    dashboard,
    merge,
    metrics,
    outbox,
    records,
    reports,
)
from creditflow.plans import stages
from creditflow.plans.inputs import (
    REISSUE_ORDER,
    Flow,
    order_draws,
    order_flow,
    order_requests,
    processed_flow,
    processed_flow_by_key,
    reissue_ends,
    wall_clock,
)
from creditflow.session import checkpoint_root, flow_defaults
from creditflow.sources.rollup import RollupTable
from creditflow.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]

WINDOW = "1 day"
TREND_MS = 7 * dashboard.DAY_MS
RANGE_MS = 365 * dashboard.DAY_MS
# Composite risk of an approved loan stays below the alerting default, because high default
# risk is a hard rejection; the query lowers the line so that it has alerts to compare.
ALERT_LINE = 0.45

_registry: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _registry[fn.__name__] = fn
    return fn


def registered() -> dict[str, Query]:
    return {name: _in_flow_session(fn) for name, fn in _registry.items()}


def _in_flow_session(fn: Query) -> Query:
    """The given tables hold zone-free times, which the flow reads as UTC."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        flow_defaults(spark)
        return fn(spark, folder)

    return run


# --- routing, records, scoring ----------------------------------------------------------


@query
def request_routing(spark, folder):
    return order_requests(spark, folder).select(
        "request_id", "application_id", "customer_id", "prospect_id", "is_customer",
        "income_source", "income_requested_at", "npl_requested_at", "system_time",
        "predicted_income",
    )


@query
def map_requests(spark, folder):
    """Every e1 field through the record mapper; null booleans read as false."""
    wire = records.to_message(order_requests(spark, folder), schemas.INCOME_REQUEST)
    return records.from_message(wire, schemas.INCOME_REQUEST)


@query
def map_disbursement(spark, folder):
    """Decision messages as the metric stage reads them: effective id, null times as 0."""
    return records.from_message(
        order_flow(spark, folder).e6, schemas.DECISION_RESULT, zero_longs=True
    )


@query
def income_prediction(spark, folder):
    entity = records.effective_id(
        F.col("is_customer"), F.col("customer_id"), F.col("prospect_id")
    )
    return order_requests(spark, folder).select(
        "request_id", scoring.predicted_income(entity).alias("predicted_income")
    )


@query
def credit_score_bands(spark, folder):
    scored = stages.with_risk_scores(order_requests(spark, folder), order_draws())
    return scored.select("request_id", "credit_score")


@query
def npl_score(spark, folder):
    scored = stages.with_risk_scores(order_requests(spark, folder), order_draws())
    return scored.select("request_id", "predicted_npl")


@query
def industry_profile(spark, folder):
    requests = order_requests(spark, folder).select("request_id")
    return stages.with_profile_draws(requests, order_draws()).select(
        "request_id", "employment_industry", "credibility", "debt_to_income_ratio",
        "employment_stability",
    )


def _scored(spark, folder) -> DataFrame:
    return stages.with_decision(order_flow(spark, folder).npl, order_draws())


@query
def score_factors(spark, folder):
    return _scored(spark, folder).select(
        "request_id", "income_score", "credit_points", "npl_points", "industry_points",
        "debt_points", "stability_points",
    )


@query
def weighted_score(spark, folder):
    return _scored(spark, folder).select("request_id", "total_score")


@query
def loan_decision(spark, folder):
    return _scored(spark, folder).select("request_id", "decision", "loan_decision")


@query
def loan_amount(spark, folder):
    return _scored(spark, folder).select("request_id", "loan_amount")


@query
def stage_clock(spark, folder):
    """Stage times of every loan, and the event-or-system time fallback."""
    return order_flow(spark, folder).loan.select(
        "request_id", "e1_consumed_at", "e2_produced_at", "e2_consumed_at", "e3_consumed_at",
        "e4_produced_at", "e4_consumed_at",
        clock.event_or_system_time(
            F.nullif(F.col("e3_consumed_at"), F.lit(0).cast("bigint")),
            F.nullif(F.col("e1_consumed_at"), F.lit(0).cast("bigint")),
            F.col("system_time"),
        ).alias("event_time"),
    )


@query
def stage_latency(spark, folder):
    flow = order_flow(spark, folder)
    return reports.stage_latency(flow.income_sent, flow.npl_sent, flow.loan)


@query
def decision_analytics(spark, folder):
    return order_flow(spark, folder).analytics


# --- notifications and alerts -----------------------------------------------------------


@query
def risk_category(spark, folder):
    """Notification points with composite risk, risk category and common tags."""
    tagged = alerts.tagged_notifications(order_flow(spark, folder).notifications)
    return tagged.select(
        "request_id", "risk_score", "tag_risk_category",
        "tag_loan_decision", "tag_customer_id", "tag_application_id", "tag_environment",
    )


_ALERT_FIELDS = (
    "timestamp bigint, alert_type string, severity string, message string, customer_id int, "
    "risk_score double, loan_amount double"
)


@query
def alerts_high_risk(spark, folder):
    """Alerts written as JSON and read back."""
    lines = alerts.json_lines(
        alerts.high_risk_alerts(order_flow(spark, folder).notifications, ALERT_LINE)
    )
    return lines.select(F.from_json("value", _ALERT_FIELDS).alias("a")).select(
        "a.timestamp", "a.alert_type", "a.severity", "a.message", "a.customer_id",
        "a.risk_score", "a.loan_amount",
    )


@query
def alerts_default_line(spark, folder):
    """Alerts above the operator's own line; none, if hard limits hold."""
    found = alerts.high_risk_alerts(order_flow(spark, folder).notifications)
    return found.select("timestamp", "customer_id", "risk_score", "loan_amount")


@query
def event_counter_text_key(spark, folder):
    """The running count by a text key, of which some rows have none."""
    key = F.when(F.col("user_id") % 7 != 0, F.concat(F.lit("req-"), (F.col("user_id") % 50).cast("string")))
    events = table(spark, folder, "events").select(
        "event_id", key.alias("request_id"), clock.epoch_ms(F.col("ts")).alias("ts_ms")
    )
    counted = counter.running_count(events, "request_id", "ts_ms", "event_id")
    return counted.select("event_id", "request_id", "event_count")


@query
def notification_metrics(spark, folder):
    notes = metrics.event_time(order_flow(spark, folder).notifications, "event_time")
    return metrics.notification_metrics(notes, WINDOW)


_NOTIFICATION_FIELDS = (
    "window_start bigint, window_end bigint, total_notifications bigint, approved_loans bigint, "
    "rejected_loans bigint, approval_rate double, total_loan_amount double, "
    "avg_loan_amount double, avg_risk_score double, high_risk_loans bigint, "
    "avg_processing_time double, timestamp bigint, window string"
)


@query
def notification_json(spark, folder):
    """Notification metrics written as JSON lines and read back."""
    notes = metrics.event_time(order_flow(spark, folder).notifications, "event_time")
    lines = metrics.notification_json(
        metrics.notification_metrics(notes, WINDOW), F.col("bucket_end")
    )
    return lines.select(F.from_json("value", _NOTIFICATION_FIELDS).alias("m")).select("m.*")


@query
def alert_points(spark, folder):
    """Alerts as points of a time-series store: numbers are fields, texts are tags."""
    found = alerts.high_risk_alerts(order_flow(spark, folder).notifications, ALERT_LINE)
    return metrics.points(found, "timestamp")


# --- counters, JSON, payloads -----------------------------------------------------------


@query
def event_counter(spark, folder):
    events = table(spark, folder, "events").select(
        "event_id", "user_id", clock.epoch_ms(F.col("ts")).alias("ts_ms")
    )
    counted = counter.running_count(events, "user_id", "ts_ms", "event_id")
    return counted.select("event_id", "user_id", "event_count")


@query
def counter_messages(spark, folder):
    """The running count as log lines."""
    events = table(spark, folder, "events").select(
        "event_id", "user_id", clock.epoch_ms(F.col("ts")).alias("ts_ms")
    )
    counted = counter.running_count(events, "user_id", "ts_ms", "event_id")
    line = payload.counter_message(
        F.concat(F.lit("req-"), F.col("event_id").cast("string")),
        F.col("event_count"),
        F.col("user_id"),
    )
    return counted.select("event_id", line.alias("message"))


def _event_request(events: DataFrame) -> DataFrame:
    """Events as JSON requests; the user id stands for the customer or the prospect."""
    customer = F.col("event_type") != "signup"
    return events.withColumns(
        {
            "requestId": F.concat(F.lit("req-"), F.col("event_id").cast("string")),
            "applicationId": F.concat(F.lit("app-"), F.col("event_id").cast("string")),
            "customerId": F.when(customer, F.col("user_id").cast("int")).otherwise(0),
            "prospectId": F.when(customer, 0).otherwise(F.col("user_id").cast("int")),
            "requestedAt": clock.epoch_ms(F.col("ts")),
            "incomeSource": F.when(customer, "batch").otherwise("real-time"),
            "isCustomer": customer,
        }
    )


@query
def json_request_write(spark, folder):
    """Counted events as JSON requests."""
    events = table(spark, folder, "events").withColumn("ts_ms", clock.epoch_ms(F.col("ts")))
    counted = counter.running_count(events, "user_id", "ts_ms", "event_id")
    requests = _event_request(counted).withColumnRenamed("event_count", "eventCount")
    return requests.select(
        "event_id",
        jsonio.write_request(schemas.JSON_REQUEST).alias("value"),
    )


@query
def json_request_parse(spark, folder):
    """Whole, partial, broken, foreign and missing JSON requests, parsed with defaults."""
    kind = F.col("event_type")
    head = F.concat(F.lit('{"requestId":"req-'), F.col("event_id").cast("string"), F.lit('"'))
    user = F.col("user_id").cast("string")
    full = F.concat(
        head, F.lit(',"customerId":'), user,
        F.lit(',"incomeSource":"batch","isCustomer":true,"eventCount":'), user, F.lit("}"),
    )
    raw = (
        F.when(kind == "click", full)
        .when(kind == "view", F.concat(head, F.lit(',"isCustomer":"yes"}')))
        .when(kind == "purchase", F.concat(head, F.lit(',"prospectId":'), user))
        .when(kind == "signup", F.col("props"))
    )
    messages = table(spark, folder, "events").select(
        "event_id", payload.safe_text(raw.cast("binary")).alias("value")
    )
    parsed = jsonio.parse_requests(messages, "value")
    return parsed.select(
        "event_id", "request_id", "customer_id", "prospect_id", "income_source", "is_customer",
        "event_count", jsonio.request_message(parsed).alias("message"),
    )


def _hex_id(key: Column, kind: str) -> Column:
    """A 36-character id shaped like a UUID."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(":" + kind)).cast("binary"))
    parts = [F.substring(digest, start, length) for start, length in
             [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]]
    return F.concat_ws("-", *parts)


@query
def payload_slice(spark, folder):
    """Ids cut from binary payloads at fixed offsets."""
    key = F.col("o_orderkey")
    value = F.concat(
        F.lit("H"), _hex_id(key, "request"), F.lit("H"), _hex_id(key, "application"),
        F.col("o_orderpriority"),
    ).cast("binary")
    raw = table(spark, folder, "orders").select("o_orderkey", value.alias("value"))
    v = F.col("value")
    return raw.select(
        "o_orderkey",
        payload.sliced_request_id(v).alias("request_id"),
        payload.sliced_application_id(v).alias("application_id"),
        payload.sliced_rest(v).cast("string").alias("rest"),
    )


def _payload_rows(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents").select(
        F.lit("documents").alias("origin"), F.col("doc_id").alias("id"),
        F.col("text").cast("binary").alias("value"),
    )
    events = table(spark, folder, "events").select(
        F.lit("events").alias("origin"), F.col("event_id").alias("id"),
        F.col("props").cast("binary").alias("value"),
    )
    return docs.unionByName(events)


@query
def payload_diagnostics(spark, folder):
    """Length, printable bytes, format and previews of each payload."""
    v = F.col("value")
    return _payload_rows(spark, folder).select(
        "origin",
        "id",
        F.octet_length(v).cast("bigint").alias("n_bytes"),
        payload.printable_bytes(v).cast("bigint").alias("n_printable"),
        payload.payload_kind(v).alias("kind"),
        payload.hex_preview(v).alias("hex_preview"),
        payload.printable_preview(v).alias("ascii_preview"),
    )


@query
def payload_profile(spark, folder):
    """How many payloads of each format arrive, and how large they are."""
    v = F.col("value")
    rows = _payload_rows(spark, folder).select(
        "origin",
        payload.payload_kind(v).alias("kind"),
        F.octet_length(v).cast("bigint").alias("n_bytes"),
        payload.printable_bytes(v).cast("bigint").alias("n_printable"),
    )
    return rows.groupBy("origin", "kind").agg(
        F.count(F.lit(1)).alias("n_payloads"),
        F.sum("n_bytes").alias("total_bytes"),
        F.min("n_bytes").alias("min_bytes"),
        F.max("n_bytes").alias("max_bytes"),
        F.sum("n_printable").alias("printable_bytes"),
    )


# --- outbox -----------------------------------------------------------------------------


def _outbox_flows(spark, folder) -> tuple[Flow, Flow]:
    """Finished orders have been handed on already; the others are still to go."""
    flow = order_flow(spark, folder)
    done = F.col("o_orderstatus") == "F"
    return flow.where(done), flow.where(~done)


@query
def outbox_pending_income(spark, folder):
    sent, new = _outbox_flows(spark, folder)
    rows = sent.income_sent.unionByName(new.income)
    return outbox.ordered(outbox.pending(rows, outbox.INCOME), outbox.INCOME)


@query
def outbox_pending_npl(spark, folder):
    """Messages for the rows not yet decided on; a row lacks either its e2 or its e3 time."""
    sent, new = _outbox_flows(spark, folder)
    rows = sent.npl_sent.unionByName(new.npl)
    todo = outbox.ordered(outbox.pending(rows, outbox.NPL), outbox.NPL)
    return outbox.messages(
        outbox.hand_over(todo, outbox.NPL, wall_clock(order_draws(), "e4_produce")),
        outbox.NPL,
    )


@query
def outbox_pending_loan(spark, folder):
    sent, new = _outbox_flows(spark, folder)
    rows = sent.loan_sent.unionByName(new.loan)
    todo = outbox.ordered(outbox.pending(rows, outbox.DISBURSEMENT), outbox.DISBURSEMENT)
    return outbox.messages(
        outbox.hand_over(
            todo, outbox.DISBURSEMENT, wall_clock(order_draws(), "e6_produce")
        ),
        outbox.DISBURSEMENT,
    )


def _handed_on(flow: Flow, which: Column) -> DataFrame:
    """The loan table of which the rows that meet ``which`` have been handed on."""
    return outbox.mark_where(
        flow.loan, outbox.DISBURSEMENT, wall_clock(order_draws(), "e6_produce"), which
    )


@query
def outbox_mark_sent(spark, folder):
    """The loan table after a pass that sent some of its pending rows: others were sent before,
    under another clock, or stay pending."""
    rows = _handed_on(order_flow(spark, folder), F.col("credit_score") % 3 == 0)
    return outbox.mark_where(
        rows, outbox.DISBURSEMENT, wall_clock(order_draws(), "notify"),
        F.col("credit_score") % 2 == 0,
    )


@query
def outbox_anti(spark, folder):
    """Requests that no shipped line item accounts for: pending against a log of sent keys."""
    requests = order_requests(spark, folder).select("request_id", "is_customer", "system_time")
    log = table(spark, folder, "lineitem").filter(F.col("l_linestatus") == "F").select(
        F.concat(F.lit("req-"), F.col("l_orderkey").cast("string")).alias("request_id")
    )
    return outbox.unsent(requests, log)


# --- merges -----------------------------------------------------------------------------


@query
def npl_inputs_union(spark, folder):
    return order_flow(spark, folder).npl_union


@query
def upsert_income(spark, folder):
    held, batch = processed_flow_by_key(spark, folder), reissue_ends(spark, folder)
    return merge.upsert(held.income_sent, batch.income, merge.INCOME, REISSUE_ORDER)


@query
def upsert_npl_income(spark, folder):
    held, batch = processed_flow_by_key(spark, folder), reissue_ends(spark, folder)
    table_rows = outbox.hand_over(held.npl_income, outbox.NPL, held.clock("e4_produce"))
    return merge.upsert(table_rows, batch.npl_income, merge.NPL_FROM_INCOME, REISSUE_ORDER)


@query
def upsert_npl_request(spark, folder):
    held, batch = processed_flow_by_key(spark, folder), reissue_ends(spark, folder)
    table_rows = outbox.hand_over(held.npl_request, outbox.NPL, held.clock("e4_produce"))
    return merge.upsert(table_rows, batch.npl_request, merge.NPL_FROM_REQUEST, REISSUE_ORDER)


@query
def upsert_loan(spark, folder):
    held, batch = processed_flow_by_key(spark, folder), reissue_ends(spark, folder)
    return merge.upsert(held.loan_sent, batch.loan, merge.LOAN, REISSUE_ORDER)


# --- metrics and dashboard --------------------------------------------------------------


def _metrics(spark, folder) -> DataFrame:
    return order_flow(spark, folder).metrics(WINDOW)


@query
def window_metrics(spark, folder):
    return _metrics(spark, folder)


@query
def line_protocol(spark, folder):
    """Metric lines, taken apart again: text of a double differs between engines."""
    lines = metrics.line_protocol(_metrics(spark, folder))
    part = F.split("value", " ")
    split = lines.select(
        part[0].alias("head"),
        F.str_to_map(part[1], F.lit(","), F.lit("=")).alias("f"),
        part[2].cast("bigint").alias("time_ns"),
    )
    return split.select(
        "head",
        "time_ns",
        *[
            F.col("f")[name].alias(name)
            if suffix
            else F.col("f")[name].cast("double").alias(name)
            for name, suffix in metrics.LINE_FIELDS
        ],
    )


@query
def metrics_long(spark, folder):
    return metrics.metrics_long(_metrics(spark, folder))


@query
def metrics_pivot(spark, folder):
    return metrics.metrics_pivot(metrics.metrics_long(_metrics(spark, folder)))


def _recent(spark, folder) -> DataFrame:
    """The trailing range of metrics. Its anchor, the newest event, needs no windows."""
    flow = order_flow(spark, folder)
    newest = dashboard.latest(flow.analytics, "timestamp")
    return dashboard.trailing(flow.metrics(WINDOW), newest, RANGE_MS)


@query
def dash_series(spark, folder):
    return dashboard.series(_recent(spark, folder), "approval_rate")


@query
def dash_latest(spark, folder):
    return dashboard.last_values(_recent(spark, folder))


@query
def dash_trend_30s(spark, folder):
    means = dashboard.trend(_recent(spark, folder), TREND_MS)
    return means.select("time", *[F.round(c, 6).alias(c) for c in dashboard.TREND_FIELDS])


@query
def dash_daily(spark, folder):
    return dashboard.daily(_recent(spark, folder)).withColumn(
        "avg_amount", F.round("avg_amount", 6)
    )


def _rolled_up(spark, folder) -> DataFrame:
    """The trailing range of a roll-up that two micro-batches have written."""
    flow = order_flow(spark, folder)
    rollup = RollupTable(spark, f"{checkpoint_root(spark)}/rollup-{uuid.uuid4().hex}", dashboard.DAY_MS, RANGE_MS)
    records = metrics.event_time(flow.analytics, "timestamp")
    late = F.col("timestamp") % 3 == 0
    for batch_id, which in enumerate((~late, late)):
        rollup.append(records.filter(which), "orders", batch_id)
    return rollup.recent(RANGE_MS)


@query
def rollup_latest(spark, folder):
    return dashboard.last_values(_rolled_up(spark, folder))


@query
def rollup_trend_30s(spark, folder):
    means = dashboard.trend(_rolled_up(spark, folder), TREND_MS)
    return means.select("time", *[F.round(c, 6).alias(c) for c in dashboard.TREND_FIELDS])


@query
def rollup_daily(spark, folder):
    return dashboard.daily(_rolled_up(spark, folder)).withColumn("avg_amount", F.round("avg_amount", 6))


# --- reports ----------------------------------------------------------------------------


@query
def stage_counts(spark, folder):
    """Row counts per stage table; some rows of the income and loan tables are still unsent."""
    flow = order_flow(spark, folder)
    income = outbox.mark_where(
        flow.income, outbox.INCOME, flow.clock("e2_produce"), F.col("predicted_income") % 10_000 == 0
    )
    loan = _handed_on(flow, F.col("credit_score") % 3 == 0)

    def line(name: str, df: DataFrame, sent: str) -> DataFrame:
        return reports.counts(
            df,
            n_real_time=F.col("income_source") == "real-time",
            n_prospects=~F.col("is_customer"),
            n_sent=F.col(sent),
        ).select(F.lit(name).alias("stage"), "*")

    return (
        line("income_prediction", income, "sent_to_npl")
        .unionByName(line("npl_prediction", flow.npl, "sent_to_ldes"))
        .unionByName(line("loan_result", loan, "sent_to_ldis"))
    )


@query
def latest_by_max(spark, folder):
    rows = reports.latest_rows(order_flow(spark, folder).income_sent, "e1_produced_at")
    return rows.select("request_id", "e1_produced_at", "e1_consumed_at", "predicted_income")


@query
def latest_prospect_npl(spark, folder):
    rows = reports.latest_rows(
        order_flow(spark, folder).npl_sent, "e4_produced_at", among=~F.col("is_customer")
    )
    return rows.select("request_id", "is_customer", "e4_produced_at", "predicted_npl")


@query
def latest_by_source(spark, folder):
    """The newest risk rows of each income source."""
    rows = order_flow(spark, folder).npl_sent
    known = F.col("income_source").isin(stages.PROSPECT_SOURCE, stages.CUSTOMER_SOURCE)
    return reports.latest_rows_by(rows.filter(known), "e4_produced_at", "income_source")


@query
def income_report(spark, folder):
    """The newest income rows with readable times."""
    rows = order_flow(spark, folder).income_sent
    return reports.with_time_text(reports.latest_rows(rows, "e1_produced_at"))


@query
def npl_report(spark, folder):
    """The newest prospect's risk row with readable times."""
    rows = order_flow(spark, folder).npl_sent
    return reports.with_time_text(
        reports.latest_rows(rows, "e4_produced_at", among=~F.col("is_customer"))
    )


@query
def source_filters(spark, folder):
    """Risk rows by the way they came in: a batch customer from the request topic, or a
    real-time prospect from the income stage."""
    rows = order_flow(spark, folder).npl
    batch = (F.col("income_source") == "batch") & (
        F.col("kafka_source") == "npl_prediction_request"
    )
    live = (F.col("income_source") == "real-time") & (
        F.col("kafka_source") != "npl_prediction_request"
    )
    return rows.filter(batch | live).select(
        "request_id", "income_source", "kafka_source", "is_customer"
    )


@query
def source_batch(spark, folder):
    """Risk rows of batch customers alone: a filter on the income source."""
    rows = order_flow(spark, folder).npl.filter(F.col("income_source") == "batch")
    return rows.select("request_id", "income_source", "kafka_source", "is_customer")


@query
def source_income_stage(spark, folder):
    """Risk rows that came through the income stage: a filter on the topic."""
    rows = order_flow(spark, folder).npl.filter(F.col("kafka_source") != "npl_prediction_request")
    return rows.select("request_id", "income_source", "kafka_source", "is_customer")


@query
def source_high_risk_prospects(spark, folder):
    """Real-time prospects with a default risk above one half: filters on both and on the score."""
    rows = order_flow(spark, folder).npl.filter(
        ~F.col("is_customer") & (F.col("predicted_npl") > 0.5)
    )
    return rows.select("request_id", "income_source", "kafka_source", "is_customer")


@query
def request_lookup(spark, folder):
    """The loan of one request: that of the most expensive order. The raw key reaches the scan."""
    orders = table(spark, folder, "orders")
    top = orders.agg(F.max_by("o_orderkey", F.struct("o_totalprice", "o_orderkey"))).scalar()
    return order_flow(spark, folder, F.col("o_orderkey") == top).loan


@query
def loan_report(spark, folder):
    """Dealt into ranges of the sort column while the requests are raw: a sort looks at its input
    twice, and only the first look, which finds the ranges, is before the scoring."""
    newest_first = F.col("system_time").desc_nulls_first()
    requests = order_requests(spark, folder).repartitionByRange(newest_first)
    return reports.with_time_text(Flow(requests, order_draws()).loan_sent).sortWithinPartitions(newest_first)


@query
def epoch_format(spark, folder):
    flow = order_flow(spark, folder)
    return reports.with_time_text(flow.income_sent).select(
        "request_id",
        *[
            reports.text_name(c)
            for c in reports.TIME_COLUMNS
            if c in schemas.INCOME_TABLE.fieldNames()
        ],
    )


@query
def newest_100(spark, folder):
    rows = reports.newest(
        order_flow(spark, folder).npl, ["system_time", "request_id"], k=100
    )
    return rows.select("request_id", "system_time", "credit_score", "predicted_npl")
