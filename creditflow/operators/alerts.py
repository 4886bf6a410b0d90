"""Risk tags and high-risk alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditflow.functions.scoring import risk_category
from creditflow.operators.records import common_tags

# Risk above which an approved loan alerts, and the texts of the alert.
ALERT_RISK = 0.8
ALERT_TYPE, SEVERITY, MESSAGE = "HIGH_RISK_APPROVED", "HIGH", "High-risk loan approved: "


def tagged_notifications(df: DataFrame, environment: str = "development") -> DataFrame:
    """Notification points with their tags: decision, risk category and the common ones."""
    return common_tags(
        df.withColumns(
            {
                "tag_loan_decision": F.col("loan_decision").cast("string"),
                "tag_risk_category": risk_category(F.col("risk_score")),
            }
        ),
        environment,
    )


def high_risk_alerts(df: DataFrame, threshold: float = ALERT_RISK) -> DataFrame:
    """An alert for each approved loan whose risk is above ``threshold``."""
    hits = df.filter((F.col("risk_score") > threshold) & F.col("loan_decision"))
    return hits.select(
        F.col("event_time").alias("timestamp"),
        F.lit(ALERT_TYPE).alias("alert_type"),
        F.lit(SEVERITY).alias("severity"),
        F.concat(F.lit(MESSAGE), F.col("request_id")).alias("message"),
        "customer_id",
        "risk_score",
        "loan_amount",
    )


def as_json(df: DataFrame, *columns: str) -> Column:
    """The given columns (default: all) as one JSON object."""
    return F.to_json(F.struct(*(columns or df.columns)))


def json_lines(df: DataFrame) -> DataFrame:
    """One JSON text per row, ready for a text sink or a topic."""
    return df.select(as_json(df).alias("value"))
