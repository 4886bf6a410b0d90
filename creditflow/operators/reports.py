"""Ad-hoc reports over the stage tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditflow.functions.clock import epoch_text

TIME_COLUMNS = [
    "income_requested_at", "e1_produced_at", "system_time", "e1_consumed_at", "e2_produced_at",
    "e2_consumed_at", "npl_requested_at", "e3_produced_at", "e3_consumed_at", "e4_produced_at",
    "e4_consumed_at",
]


def text_name(column: str) -> str:
    """``e1_produced_at`` -> ``e1_produced_time``; ``system_time`` -> ``system_time_text``."""
    return column[:-3] + "_time" if column.endswith("_at") else column + "_text"


def with_time_text(df: DataFrame, columns: Sequence[str] = TIME_COLUMNS) -> DataFrame:
    """Add a readable form of every epoch column the table has."""
    return df.withColumns(
        {text_name(c): epoch_text(F.col(c)) for c in columns if c in df.columns}
    )


def counts(df: DataFrame, **conditions: Column) -> DataFrame:
    """The row count and one count per condition, in a single pass."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(cond).alias(name) for name, cond in conditions.items()],
    )


def latest_rows(df: DataFrame, column: str, among: Column | None = None) -> DataFrame:
    """The rows that hold the greatest ``column`` of the table, or of its rows ``among``.

    Ties are kept. The greatest value is a scalar subquery, so it reaches the scan as a filter.
    """
    source = df if among is None else df.filter(among)
    greatest = source.agg(F.max(column)).scalar()
    return df.filter(F.col(column) == greatest)


def latest_rows_by(df: DataFrame, column: str, by: str) -> DataFrame:
    """The rows that hold the greatest ``column`` of their ``by``. Ties are kept; a null ``by`` has none.

    The greatest values are partial aggregates, a row per value of ``by``.
    """
    greatest = df.groupBy(by).agg(F.max(column).alias(column))
    return df.join(greatest, [by, column], "left_semi").select(*df.columns)


def newest(df: DataFrame, order: Sequence[str], k: int = 100) -> DataFrame:
    """Top-k by ``order`` descending: each task keeps its own k, the driver merges those."""
    return df.orderBy(*[F.col(c).desc_nulls_last() for c in order]).limit(k)


def loan_report(loans: DataFrame) -> DataFrame:
    """Every loan with readable times, newest first."""
    return with_time_text(loans).orderBy(F.col("system_time").desc_nulls_first())


def stage_latency(income: DataFrame, npl: DataFrame, loan: DataFrame) -> DataFrame:
    """Latency per stage of each loan, by joining the three stage tables on their key.

    ``carried_ok`` tells whether the times carried through the messages equal the joined ones.
    A request skips the income table when it is a customer's.
    """
    i = income.select(
        "request_id",
        F.col("e1_consumed_at").alias("i_e1_consumed_at"),
        F.col("e2_produced_at").alias("i_e2_produced_at"),
        F.col("predicted_income").alias("i_predicted_income"),
    )
    n = npl.select(
        "request_id",
        F.col("e2_consumed_at").alias("n_e2_consumed_at"),
        F.col("e3_consumed_at").alias("n_e3_consumed_at"),
        F.col("e4_produced_at").alias("n_e4_produced_at"),
        F.col("credit_score").alias("n_credit_score"),
    )
    joined = loan.join(n, "request_id", "left").join(i, "request_id", "left")
    c = F.col

    def same(carried: str, own: str) -> Column:
        return c(carried) == F.coalesce(c(own), F.lit(0))

    start = F.when(c("is_customer"), c("npl_requested_at")).otherwise(c("income_requested_at"))
    return joined.select(
        "request_id",
        "is_customer",
        (c("i_e1_consumed_at") - c("income_requested_at")).alias("income_ms"),
        (c("i_e2_produced_at") - c("i_e1_consumed_at")).alias("income_outbox_ms"),
        (c("n_e4_produced_at") - F.coalesce(c("n_e3_consumed_at"), c("n_e2_consumed_at"))).alias(
            "npl_outbox_ms"
        ),
        (c("e4_consumed_at") - start).alias("total_ms"),
        (
            same("e1_consumed_at", "i_e1_consumed_at")
            & same("e2_produced_at", "i_e2_produced_at")
            & same("e2_consumed_at", "n_e2_consumed_at")
            & same("e3_consumed_at", "n_e3_consumed_at")
            & (c("e4_produced_at") == c("n_e4_produced_at"))
            & (c("credit_score") == c("n_credit_score"))
        ).alias("carried_ok"),
    )
