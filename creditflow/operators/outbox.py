"""Outbox: rows not yet handed on, the message for each, and the mark once it is out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from creditflow import schemas
from creditflow.functions.clock import decision_clock, shifted
from creditflow.operators.records import effective_id, to_message
from creditflow.schemas import snake


@dataclass(frozen=True)
class OutboxSpec:
    """``flag`` selects and marks; ``stamps`` get the hand-over time; ``order`` sorts."""

    name: str
    table: StructType
    message: StructType
    flag: str
    stamps: tuple[str, ...]
    order: tuple[str, ...]
    key: str = "request_id"


INCOME = OutboxSpec(
    name="income",
    table=schemas.INCOME_TABLE,
    message=schemas.INCOME_RESULT,
    flag="sent_to_npl",
    stamps=("e2_produced_at",),
    order=("e1_consumed_at",),
)

NPL = OutboxSpec(
    name="npl",
    table=schemas.NPL_TABLE,
    message=schemas.NPL_RESULT,
    flag="sent_to_ldes",
    stamps=("e4_produced_at",),
    order=("e2_consumed_at", "e3_consumed_at"),
)

# One flag both selects and marks, so a second pass finds nothing. (A pass that selects on one
# flag and marks another would send every row again on each poll.) The message field is the
# e5 stamp; the table gets both stamps.
DISBURSEMENT = OutboxSpec(
    name="disbursement",
    table=schemas.LOAN_TABLE,
    message=schemas.DECISION_RESULT,
    flag="sent_to_ldis",
    stamps=("e5_produced_at", "e6_produced_at"),
    order=("e4_consumed_at",),
)

# The same decisions for the notification stage, under its own flag.
NOTIFICATION = OutboxSpec(
    name="notification",
    table=schemas.LOAN_TABLE,
    message=schemas.DECISION_RESULT,
    flag="sent_to_ns",
    stamps=("e5_produced_at",),
    order=("e4_consumed_at",),
)


def pending(table: DataFrame, spec: OutboxSpec) -> DataFrame:
    """The rows whose flag is false. A null flag is not pending, as in SQL."""
    return table.filter(~F.col(spec.flag))


def ordered(df: DataFrame, spec: OutboxSpec) -> DataFrame:
    """Oldest first; rows without the time come last, ties by key."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in spec.order], F.col(spec.key))


def hand_over(rows: DataFrame, spec: OutboxSpec, proc_ms: Column) -> DataFrame:
    """Pending rows as they stand once sent: flag set, stage clock stamped."""
    stamp = _stamp(spec, proc_ms)
    return rows.withColumns({spec.flag: F.lit(True), **{c: stamp for c in spec.stamps}})


def _stamp(spec: OutboxSpec, proc_ms: Column) -> Column:
    if spec.table is schemas.INCOME_TABLE:
        return shifted(F.col("income_requested_at"), proc_ms, F.col("system_time"))
    return decision_clock(
        F.col("is_customer"), F.col("npl_requested_at"), F.col("income_requested_at"),
        proc_ms, F.col("system_time"),
    )


def messages(sent: DataFrame, spec: OutboxSpec) -> DataFrame:
    """The outgoing messages of handed-over rows.

    Times that a prospect or a customer never had are null in the table and 0 in the message.
    """
    if spec.message is schemas.DECISION_RESULT:
        sent = sent.withColumn(
            "customer_id",
            effective_id(F.col("is_customer"), F.col("customer_id"), F.col("prospect_id")),
        )
    return to_message(sent, spec.message, zero_longs=True)


def _content(spec: OutboxSpec) -> str:
    """A hash of what a row's message says, flag and stamps aside."""
    own = {spec.flag, *spec.stamps}
    said = [snake(f.name) for f in spec.message if snake(f.name) not in own]
    said += [c for c in ("prospect_id",) if c not in said]
    return f"xxhash64({', '.join(said)})"


def marks(sent: DataFrame, spec: OutboxSpec, *carry: str) -> DataFrame:
    """Key, flag and stamps of handed-over rows, with the content they were sent with."""
    return sent.selectExpr(
        *dict.fromkeys([spec.key, *carry]), spec.flag, *spec.stamps, f"{_content(spec)} AS _said"
    )


def apply_marks(table: DataFrame, marked: DataFrame, spec: OutboxSpec) -> DataFrame:
    """Set flag and stamps where the row still says what was sent.

    A row that was upserted with other values since stays pending.
    """
    columns = [spec.flag, *spec.stamps]
    m = marked.selectExpr(spec.key, "_said", f"struct({', '.join(columns)}) AS _set")
    joined = table.withColumn("_says", F.expr(_content(spec))).join(m, spec.key, "left")
    return joined.selectExpr(
        *[
            f"CASE WHEN _said = _says THEN _set.{c} ELSE {c} END AS {c}" if c in columns else c
            for c in table.columns
        ]
    )


def mark_sent(table: DataFrame, sent: DataFrame, spec: OutboxSpec) -> DataFrame:
    """The table with the flag and stamps of the rows in ``sent`` (each key once)."""
    return apply_marks(table, marks(sent, spec), spec)


def mark_where(table: DataFrame, spec: OutboxSpec, proc_ms: Column, which: Column) -> DataFrame:
    """The table after its pending rows that meet ``which`` went out, in one pass and no join.

    For a pass that selects and marks on one snapshot; :func:`apply_marks` is for marks that come
    later, when rows may have changed.
    """
    now, stamp = ~F.col(spec.flag) & which, _stamp(spec, proc_ms)
    return table.withColumns(
        {
            spec.flag: F.when(now, F.lit(True)).otherwise(F.col(spec.flag)),
            **{c: F.when(now, stamp).otherwise(F.col(c)) for c in spec.stamps},
        }
    )


def unsent(requests: DataFrame, log: DataFrame, key: str = "request_id") -> DataFrame:
    """The rows of ``requests`` whose key the log of sent messages does not hold.

    The log is reduced to its keys before the join, so a key sent many times costs one row.
    """
    return requests.join(log.select(key).distinct(), key, "left_anti")
