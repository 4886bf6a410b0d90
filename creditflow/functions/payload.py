"""Raw message payloads: safe text, fixed-offset slices and a format profile."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts and sizes of the diagnostic output.
NULL_MESSAGE = "[null message]"
ERROR_MARK = "[Error: "
RECEIVED = "Received income prediction Request: "
NOT_PRINTABLE = "·"
PREVIEW_CHARS = 150
ID_CHARS = 36


def safe_text(value: Column) -> Column:
    """Bytes as UTF-8 text; a null or undecodable payload becomes a marked placeholder."""
    text = F.try_validate_utf8(value.cast("string"))
    return (
        F.when(value.isNull(), F.lit(NULL_MESSAGE))
        .when(text.isNull(), F.lit(ERROR_MARK + "invalid UTF-8]"))
        .otherwise(text)
    )


def received_message(text: Column) -> Column:
    return F.concat(F.lit(RECEIVED), text)


# The words of the counter's log line.
COUNTER_WORDS = ("request ", "unknown", " - ", " - customer ")


def counter_message(request_id: Column, count: Column, customer_id: Column) -> Column:
    return F.concat(
        F.lit(COUNTER_WORDS[0]), F.coalesce(request_id, F.lit(COUNTER_WORDS[1])),
        F.lit(COUNTER_WORDS[2]), count.cast("string"),
        F.lit(COUNTER_WORDS[3]), F.coalesce(customer_id, F.lit(0)).cast("string"),
    )


def sliced_request_id(value: Column) -> Column:
    """One marker byte, then a 36-byte request id."""
    return F.substring(value, 2, ID_CHARS).cast("string")


def sliced_application_id(value: Column) -> Column:
    """A second marker byte, then a 36-byte application id."""
    return F.substring(value, ID_CHARS + 3, ID_CHARS).cast("string")


def sliced_rest(value: Column) -> Column:
    """Everything behind the two ids, untouched."""
    return F.substring(value, 2 * ID_CHARS + 3, 2147483647)


def _preview(text: Column, more: Column) -> Column:
    return F.concat(
        F.substring(text, 1, PREVIEW_CHARS), F.when(more, F.lit("...")).otherwise(F.lit(""))
    )


def hex_preview(value: Column) -> Column:
    """Lower-case hex of the first bytes, with dots when there is more."""
    digits = F.lower(F.hex(F.substring(value, 1, PREVIEW_CHARS // 2)))
    return _preview(digits, F.octet_length(value) * 2 > PREVIEW_CHARS)


def printable(value: Column) -> Column:
    """One character per byte: printable ASCII as is, any other byte as a middle dot."""
    return F.regexp_replace(F.decode(value, "ISO-8859-1"), "[^ -~]", NOT_PRINTABLE)


def printable_preview(value: Column) -> Column:
    return _preview(
        printable(F.substring(value, 1, PREVIEW_CHARS)), F.octet_length(value) > PREVIEW_CHARS
    )


def printable_bytes(value: Column) -> Column:
    """How many bytes of the whole payload are printable ASCII."""
    return F.length(F.regexp_replace(F.decode(value, "ISO-8859-1"), "[^ -~]", ""))


def payload_kind(value: Column) -> Column:
    """``json``, ``avro_like`` (first byte zero), ``empty`` or ``other``."""
    # White space before the brace is skipped however long it is.
    text = F.regexp_replace(F.decode(value, "ISO-8859-1"), "^[ \\t\\r\\n]+", "")
    return (
        F.when(value.isNull() | (F.octet_length(value) == 0), "empty")
        .when(text.startswith("{"), "json")
        .when(F.hex(F.substring(value, 1, 1)) == "00", "avro_like")
        .otherwise("other")
    )


def diagnostic_line(value: Column) -> Column:
    return F.when(value.isNull(), F.lit("ERROR: null (null bytes)")).otherwise(
        F.concat(
            F.lit("RAW["), F.octet_length(value).cast("string"),
            F.lit("]: hex="), hex_preview(value),
            F.lit(", ascii="), printable_preview(value),
        )
    )
