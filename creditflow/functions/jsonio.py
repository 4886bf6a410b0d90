"""JSON requests: typed extraction with a default per field, and writing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from creditflow.functions.payload import ERROR_MARK, NULL_MESSAGE
from creditflow.schemas import snake

# Texts of the parse result, length of the shown part, defaults of the fields.
NULL_RECEIVED = "Received null message from Kafka"
DECODE_ERROR = "Deserialization error: "
PARSE_ERROR = "Error parsing JSON: malformed, Raw data: "
PROCESSED = (
    "Processed JSON Request: ID=%s, Customer=%s, Prospect=%s, Source=%s, Customer=%s, Count=%s"
)
SHOWN_CHARS = 100
DEFAULTS = {
    "request_id": "unknown",
    "customer_id": "N/A",
    "prospect_id": "N/A",
    "income_source": "unknown",
    "is_customer": False,
    "event_count": 0,
}

_EXTRACT = StructType(
    [
        StructField("requestId", StringType()),
        StructField("customerId", StringType()),
        StructField("prospectId", StringType()),
        StructField("incomeSource", StringType()),
        StructField("isCustomer", BooleanType()),
        StructField("eventCount", LongType()),
    ]
)


def is_json(text: Column) -> Column:
    """True for well-formed JSON; null text is not JSON."""
    return F.try_parse_json(text).isNotNull()


def parse_requests(df: DataFrame, text: str) -> DataFrame:
    """Add the request fields found in column ``text``, with the default of each field.

    ``parse_error`` is null for a good message. A bad one keeps its row: the error column says
    why and shows the first 100 characters.
    """
    raw = F.col(text)
    body = F.from_json(raw, _EXTRACT, {"mode": "PERMISSIVE"})
    shown = F.substring(raw, 1, SHOWN_CHARS)
    preview = F.when(F.length(raw) > SHOWN_CHARS, F.concat(shown, F.lit("..."))).otherwise(raw)
    error = (
        F.when(raw.isNull() | (raw == NULL_MESSAGE), F.lit(NULL_RECEIVED))
        .when(raw.startswith(ERROR_MARK.strip()), F.concat(F.lit(DECODE_ERROR), raw))
        .when(~is_json(raw), F.concat(F.lit(PARSE_ERROR), preview))
    )
    parsed = df.withColumn("_body", body).withColumn("parse_error", error)
    ok = F.col("parse_error").isNull()
    fields = {
        snake(f.name): F.coalesce(F.col(f"_body.{f.name}"), F.lit(DEFAULTS[snake(f.name)]))
        for f in _EXTRACT
    }
    return parsed.withColumns({k: F.when(ok, v) for k, v in fields.items()}).drop("_body")


def request_message(df: DataFrame) -> Column:
    """The log line of a parsed request, or its error text (after :func:`parse_requests`)."""
    line = F.format_string(
        PROCESSED, df["request_id"], df["customer_id"], df["prospect_id"], df["income_source"],
        df["is_customer"].cast("string"), df["event_count"].cast("string"),
    )
    return F.coalesce(df["parse_error"], line)


def write_request(fields: StructType) -> Column:
    """The columns named by ``fields`` as one JSON object; null fields are left out."""
    return F.to_json(F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields]))
