"""Record mapping, JSON, payloads, encoding and dead letters on small frames."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from creditflow import schemas
from creditflow.functions import clock, jsonio, payload, scoring
from creditflow.operators import alerts, records
from creditflow.sources import topics


def test_snake():
    assert [schemas.snake(n) for n in ("requestId", "e1ProducedAt", "sentToNpl")] == [
        "request_id", "e1_produced_at", "sent_to_npl"]


def test_null_fields_of_a_message(spark):
    columns = ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in schemas.DECISION_RESULT)
    row = ("r", "a", 1, None, 5, None, None, 700, 0.1, 0.3, None, 100.0, None)
    df = spark.createDataFrame([row], columns)
    kept = records.from_message(df, schemas.DECISION_RESULT).first()
    assert (kept.is_customer, kept.loan_decision, kept.npl_requested_at) == (False, False, None)
    zero = records.from_message(df, schemas.DECISION_RESULT, zero_longs=True).first()
    assert (zero.income_requested_at, zero.npl_requested_at, zero.e5_produced_at) == (0, 0, 0)


def test_conform_and_schema_sizes(spark):
    df = records.conform(spark.range(1).select(F.lit("r").alias("request_id")),
                         schemas.INCOME_TABLE)
    assert df.columns == schemas.INCOME_TABLE.fieldNames()
    sizes = [len(s) for s in (schemas.INCOME_TABLE, schemas.NPL_TABLE, schemas.LOAN_TABLE,
                              schemas.NPL_RESULT, schemas.DECISION_RESULT)]
    assert sizes == [14, 22, 32, 22, 13]


def test_processing_time_fallbacks(spark):
    rows = [(True, 50, 40, 30), (True, 0, 40, 30), (False, 50, 40, 30), (False, 50, 0, 30)]
    df = spark.createDataFrame(rows, "c boolean, n long, i long, s long")
    got = df.select(clock.processing_time(F.col("c"), F.col("n"), F.col("i"), F.col("s"),
                                          F.lit(100)))
    assert [r[0] for r in got.collect()] == [50, 60, 60, 70]


def test_epoch_text(spark):
    df = spark.createDataFrame([(1_700_000_000_007,), (None,)], "ms long")
    got = [r[0] for r in df.select(clock.epoch_text(F.col("ms"))).collect()]
    assert got == ["2023-11-14 22:13:20.007", None]


def test_risk_categories(spark):
    df = spark.createDataFrame([(0.71,), (0.7,), (0.41,), (0.4,)], "r double")
    got = [r[0] for r in df.select(scoring.risk_category(F.col("r"))).collect()]
    assert got == ["HIGH", "MEDIUM", "MEDIUM", "LOW"]


def test_alerts_need_approval_and_high_risk(spark):
    rows = [("a", "x", 1, True, 10.0, 0.81, 700, 5, 9), ("b", "x", 1, True, 10.0, 0.80, 700, 5, 9),
            ("c", "x", 1, False, 10.0, 0.99, 700, 5, 9)]
    df = spark.createDataFrame(rows, schemas.NOTIFICATION)
    lines = [json.loads(r.value) for r in
             alerts.json_lines(alerts.high_risk_alerts(df)).collect()]
    assert lines == [{
        "timestamp": 9, "alert_type": "HIGH_RISK_APPROVED", "severity": "HIGH",
        "message": "High-risk loan approved: a", "customer_id": 1, "risk_score": 0.81,
        "loan_amount": 10.0}]


def test_json_requests(spark):
    long = '{"requestId":"' + "x" * 200
    texts = [
        '{"requestId":"r1","customerId":7,"prospectId":0,"incomeSource":"batch",'
        '"isCustomer":true,"eventCount":3}',
        "{}", '{"isCustomer":"true","eventCount":"5"}', long, payload.NULL_MESSAGE,
        "[Error: bad]", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
    parsed = jsonio.parse_requests(df, "value")
    got = [r[0] for r in
           parsed.orderBy("i").select(jsonio.request_message(parsed)).collect()]
    plain = "Processed JSON Request: ID=unknown, Customer=N/A, Prospect=N/A, Source=unknown, "
    assert got == [
        "Processed JSON Request: ID=r1, Customer=7, Prospect=0, Source=batch, Customer=true, "
        "Count=3",
        plain + "Customer=false, Count=0",
        plain + "Customer=false, Count=0",
        "Error parsing JSON: malformed, Raw data: " + long[:100] + "...",
        "Received null message from Kafka",
        "Deserialization error: [Error: bad]",
        "Received null message from Kafka",
    ]


def test_safe_text(spark):
    df = spark.createDataFrame([(b"ok",), (b"\xff\xfe",), (None,)], "v binary")
    got = [r[0] for r in df.select(payload.safe_text(F.col("v"))).collect()]
    assert got == ["ok", "[Error: invalid UTF-8]", "[null message]"]
    lines = df.select(payload.received_message(payload.safe_text(F.col("v")))).collect()
    assert lines[0][0] == "Received income prediction Request: ok"


def test_counter_message(spark):
    df = spark.createDataFrame([(None, 2, None), ("r", 3, 8)], "r string, n long, c int")
    got = df.select(payload.counter_message(F.col("r"), F.col("n"), F.col("c"))).collect()
    assert [r[0] for r in got] == ["request unknown - 2 - customer 0", "request r - 3 - customer 8"]


def test_payload_slices(spark):
    request, application = "0" * 36, "1" * 36
    raw = b"H" + request.encode() + b"H" + application.encode() + b"\x00\xff\x01"
    v = F.col("v")
    row = spark.createDataFrame([(raw,)], "v binary").select(
        payload.sliced_request_id(v), payload.sliced_application_id(v), payload.sliced_rest(v)
    ).first()
    assert (row[0], row[1], bytes(row[2])) == (request, application, b"\x00\xff\x01")


def test_payload_diagnosis(spark):
    raws = [b'  {"a":1}', b"\x00\x06abc", b"plain \xc3\xa9\n", b"", b"z" * 200]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "i int, v binary")
    v = F.col("v")
    rows = df.orderBy("i").select(
        payload.payload_kind(v), payload.hex_preview(v), payload.printable_preview(v),
        payload.printable_bytes(v), payload.diagnostic_line(v)).collect()
    assert [r[0] for r in rows] == ["json", "avro_like", "other", "empty", "other"]
    assert rows[1][1] == "0006616263" and rows[2][2] == "plain ···"
    assert [r[3] for r in rows] == [9, 3, 6, 0, 200]
    assert rows[4][1] == "7a" * 75 + "..." and rows[4][2] == "z" * 150 + "..."
    assert rows[1][4] == "RAW[5]: hex=0006616263, ascii=··abc"


MESSAGES = [("r1", "a", 1, 0, 10, 11, 12, None, True), ("r2", "b", 0, 2, 20, 21, 22, "x", False)]


def test_json_codec_round_trip(spark):
    df = spark.createDataFrame(MESSAGES, schemas.INCOME_REQUEST)
    wire = topics.encode(df, schemas.INCOME_REQUEST, key="requestId")
    assert wire.schema.simpleString() == topics.WIRE.simpleString()
    assert [r.key for r in wire.collect()] == ["r1", "r2"]
    back = topics.decode(wire, schemas.INCOME_REQUEST)
    assert [tuple(r) for r in back.collect()] == MESSAGES
    assert topics.encode(df, schemas.INCOME_REQUEST).first().key is None


@pytest.mark.parametrize("bad", [b"not json", None])
def test_a_bad_record_fails_the_job(spark, bad):
    df = spark.createDataFrame([(bad,)], "value binary")
    with pytest.raises(Exception, match="null record|MALFORMED|FAILFAST"):
        topics.decode(df, schemas.INCOME_REQUEST).collect()


def test_dead_letters(spark):
    good = json.dumps(dict(zip(schemas.INCOME_REQUEST.fieldNames(), MESSAGES[0])))
    wrong = good.replace('"customerId": 1', '"customerId": "one"')
    partial = json.dumps({"requestId": "r9"})
    rows = [(good.encode(),), (b"{broken",), (wrong.encode(),), (None,), (partial.encode(),)]
    ok, bad = topics.split_bad(spark.createDataFrame(rows, "value binary"),
                               schemas.INCOME_REQUEST)
    assert [tuple(r) for r in ok.collect()] == MESSAGES[:1]
    assert sorted(r.reason for r in bad.collect()) == [
        "malformed", "malformed", "missing field", "null record"]


def test_every_topic_has_an_avro_schema():
    names = [json.loads(topics.avro_schema(s, r))["name"] for _, s, r in schemas.TOPICS.values()]
    assert names == [r for _, _, r in schemas.TOPICS.values()]


def test_avro_schema_text():
    schema = json.loads(topics.avro_schema(schemas.INCOME_REQUEST, "IncomePredictionRequest"))
    by_name = {f["name"]: f for f in schema["fields"]}
    assert by_name["customerId"]["type"] == "int" and by_name["systemTime"]["type"] == "long"
    assert by_name["incomeSource"] == {
        "name": "incomeSource", "type": ["null", "string"], "default": None}


def test_broker_options():
    """Configuration only: the connector is not on the test class path."""
    assert topics.kafka_source_options("t", group="g", start="latest") == {
        "kafka.bootstrap.servers": "localhost:9092", "subscribe": "t",
        "startingOffsets": "latest", "groupIdPrefix": "g"}
    assert topics.kafka_sink_options("t")["topic"] == "t"
    with pytest.raises(ValueError):
        topics.kafka_source_options("t", start="yesterday")
    with pytest.raises(ValueError):
        topics.encode(None, schemas.INCOME_REQUEST, fmt="xml")


def test_range_source(spark):
    assert spark.range(1, 1001).count() == 1000
