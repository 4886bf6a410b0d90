"""One fixed schema per message, stage table and metric record, shared by writers and readers.

Messages keep the camelCase names of the wire format, stage tables the snake_case names of
the store. ``?`` marks a nullable field.
"""

from __future__ import annotations

import re

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

_TYPES: dict[str, DataType] = {
    "str": StringType(),
    "int": IntegerType(),
    "long": LongType(),
    "dbl": DoubleType(),
    "bool": BooleanType(),
}


# Field names, types and order of every schema below are the contract.


def _struct(**fields: str) -> StructType:
    return StructType(
        [StructField(n, _TYPES[t.rstrip("?")], t.endswith("?")) for n, t in fields.items()]
    )


def snake(name: str) -> str:
    """``e1ProducedAt`` -> ``e1_produced_at``."""
    return re.sub(r"(?<!^)(?=[A-Z])", "_", name).lower()


# --- messages ---------------------------------------------------------------------------

INCOME_REQUEST = _struct(  # e1
    requestId="str", applicationId="str", customerId="int", prospectId="int",
    incomeRequestedAt="long", e1ProducedAt="long", systemTime="long",
    incomeSource="str?", isCustomer="bool",
)

INCOME_RESULT = _struct(  # e2
    requestId="str", applicationId="str", customerId="int", prospectId="int",
    incomeRequestedAt="long", e1ProducedAt="long", systemTime="long",
    incomeSource="str?", isCustomer="bool",
    kafkaSource="str", predictedIncome="dbl", e1ConsumedAt="long",
    sentToNpl="bool", e2ProducedAt="long",
)

NPL_REQUEST = _struct(  # e3
    requestId="str", applicationId="str", customerId="int", prospectId="int",
    incomeRequestedAt="long", nplRequestedAt="long", e3ProducedAt="long", systemTime="long",
    incomeSource="str?", isCustomer="bool", predictedIncome="dbl",
)

NPL_RESULT = _struct(  # e4
    requestId="str", applicationId="str", customerId="int", prospectId="int",
    incomeRequestedAt="long", e1ProducedAt="long", systemTime="long",
    incomeSource="str?", isCustomer="bool",
    kafkaSource="str", predictedIncome="dbl", e1ConsumedAt="long",
    sentToNpl="bool", e2ProducedAt="long", e2ConsumedAt="long",
    nplRequestedAt="long", e3ProducedAt="long", e3ConsumedAt="long",
    creditScore="long", sentToLdes="bool", e4ProducedAt="long", predictedNpl="dbl",
)

DECISION_RESULT = _struct(  # e5 (notification) and e6 (disbursement) share these fields
    requestId="str", applicationId="str", customerId="int",
    incomeRequestedAt="long?", systemTime="long", isCustomer="bool", nplRequestedAt="long?",
    creditScore="long", predictedNpl="dbl", debtToIncomeRatio="dbl",
    loanDecision="bool", loanAmount="dbl", e5ProducedAt="long?",
)

JSON_REQUEST = _struct(
    requestId="str?", applicationId="str?", customerId="int?", prospectId="int?",
    requestedAt="long?", incomeSource="str", isCustomer="bool", eventCount="long",
)

# Topic name, message schema and record name of each event. e5 and e6 differ only
# in who listens.
TOPICS = {
    "e1": ("income_prediction_request", INCOME_REQUEST, "IncomePredictionRequest"),
    "e2": ("income_prediction_result", INCOME_RESULT, "IncomePredictionResult"),
    "e3": ("npl_prediction_request", NPL_REQUEST, "NplPredictionRequest"),
    "e4": ("npl_prediction_result", NPL_RESULT, "NplPredictionResult"),
    "e5": ("loan_decision_result_notification", DECISION_RESULT, "LoanDecisionResultNotification"),
    "e6": ("loan_decision_result_disbursement", DECISION_RESULT, "LoanDecisionResultDisbursement"),
}

# --- stage tables, all keyed by request_id ----------------------------------------------

INCOME_TABLE = _struct(
    request_id="str", application_id="str", customer_id="int", prospect_id="int",
    income_requested_at="long", system_time="long", e1_produced_at="long",
    income_source="str?", is_customer="bool?", kafka_source="str?", predicted_income="dbl?",
    e1_consumed_at="long?", sent_to_npl="bool?", e2_produced_at="long?",
)

NPL_TABLE = _struct(
    request_id="str", application_id="str", customer_id="int", prospect_id="int",
    income_requested_at="long?", system_time="long", e1_produced_at="long?",
    income_source="str?", is_customer="bool?", kafka_source="str?", predicted_income="dbl?",
    e1_consumed_at="long?", sent_to_npl="bool?", e2_produced_at="long?",
    e2_consumed_at="long?", npl_requested_at="long?", e3_produced_at="long?",
    e3_consumed_at="long?", credit_score="long", sent_to_ldes="bool?",
    e4_produced_at="long?", predicted_npl="dbl",
)

LOAN_TABLE = _struct(
    request_id="str", application_id="str", customer_id="int", prospect_id="int",
    income_requested_at="long?", system_time="long", e1_produced_at="long?",
    income_source="str?", is_customer="bool?", kafka_source="str?", predicted_income="dbl?",
    e1_consumed_at="long?", sent_to_npl="bool?", e2_produced_at="long?",
    e2_consumed_at="long?", npl_requested_at="long?", e3_produced_at="long?",
    e3_consumed_at="long?", credit_score="long", sent_to_ldes="bool?",
    e4_produced_at="long?", predicted_npl="dbl", e4_consumed_at="long?",
    debt_to_income_ratio="dbl", employment_industry="str?", employment_stability="dbl",
    loan_decision="bool", loan_amount="dbl", sent_to_ns="bool?", e5_produced_at="long?",
    sent_to_ldis="bool?", e6_produced_at="long?",
)

# --- analytics --------------------------------------------------------------------------

LOAN_ANALYTICS = _struct(
    timestamp="long", is_approved="bool", loan_amount="dbl", risk_score="dbl",
    processing_time="long",
)

WINDOW_METRICS = _struct(
    bucket_start="long", bucket_end="long", window_start="long", window_end="long",
    approved_count="long", rejected_count="long", approval_rate="dbl", total_amount="dbl",
    avg_amount="dbl", avg_risk_score="dbl", high_risk_count="long", avg_proc_time="dbl",
)

NOTIFICATION_METRICS = _struct(
    bucket_start="long", bucket_end="long", total_count="long", approved_count="long",
    rejected_count="long", approval_rate="dbl", total_amount="dbl", avg_amount="dbl",
    avg_risk_score="dbl", high_risk_count="long", avg_processing_time="dbl",
)

NOTIFICATION = _struct(
    request_id="str", application_id="str", customer_id="int", loan_decision="bool",
    loan_amount="dbl", risk_score="dbl", credit_score="long", processing_time_ms="long",
    event_time="long",
)
