"""The stages of the loan flow: each is a function from DataFrame to DataFrame.

    requests --e1--> income --e2--> risk --e4--> decision --e6--> metrics
             --e3-----------------> risk              '----e5--> notification

``draw`` gives the uniform model draws of a row, ``proc_ms`` the wall clock at which the stage
handles it. Both are inputs, so that a run can be repeated and checked.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditflow import schemas
from creditflow.functions import clock, scoring
from creditflow.functions.draws import Draw, keyed_draws
from creditflow.operators.records import conform, from_message

# Where the ids of customers and prospects start, and how many there are of each.
CUSTOMER_ID_BASE, PROSPECT_ID_BASE, ID_RANGE = 1_000_000, 2_000_000, 1_000_000
# Income source of customers and of prospects.
CUSTOMER_SOURCE, PROSPECT_SOURCE = "batch", "real-time"


def route_requests(
    df: DataFrame, is_customer: Column, entity: Column, sequential_ms: Column, wall_ms: Column
) -> DataFrame:
    """Customers and prospects take different ways into the flow.

    A prospect is scored in real time, from the income stage on. A customer comes from a batch
    of the day before, with an income already known, and starts at the risk stage.
    """
    local = (entity % ID_RANGE).cast("int")
    customer_id = F.when(is_customer, local + CUSTOMER_ID_BASE).otherwise(F.lit(0))
    prospect_id = F.when(is_customer, F.lit(0)).otherwise(local + PROSPECT_ID_BASE)
    routed = df.withColumns(
        {
            "is_customer": is_customer,
            "customer_id": customer_id,
            "prospect_id": prospect_id,
            "system_time": wall_ms,
            "npl_requested_at": sequential_ms,
        }
    )
    customer = F.col("is_customer")
    return routed.withColumns(
        {
            "income_source": F.when(customer, CUSTOMER_SOURCE).otherwise(PROSPECT_SOURCE),
            "income_requested_at": F.when(
                customer, F.col("npl_requested_at") - clock.DAY_MS
            ).otherwise(F.col("npl_requested_at")),
            "e1_produced_at": F.col("npl_requested_at"),
            "e3_produced_at": F.col("npl_requested_at"),
            "predicted_income": F.when(
                customer, scoring.predicted_income(F.col("customer_id"))
            ).otherwise(F.lit(0.0)),
        }
    )


def stage_income(e1: DataFrame, proc_ms: Column) -> DataFrame:
    """Rows of the income table for income requests."""
    rec = from_message(e1, schemas.INCOME_REQUEST)
    return conform(
        rec.withColumns(
            {
                "kafka_source": F.lit(schemas.TOPICS["e1"][0]),
                "predicted_income": scoring.predicted_income(F.col("prospect_id")),
                "e1_consumed_at": clock.shifted(
                    F.col("income_requested_at"), proc_ms, F.col("system_time")
                ),
                "sent_to_npl": F.lit(False),
            }
        ),
        schemas.INCOME_TABLE,
    )


def _with_draws(df: DataFrame, draw: Draw, *salts: str) -> DataFrame:
    """Each draw as a column of its own, so that it is computed once however often it is used."""
    return df.withColumns({f"u_{salt}": draw(salt) for salt in salts})


def with_risk_scores(df: DataFrame, draw: Draw) -> DataFrame:
    """Draw the credit score and the default risk."""
    drawn = _with_draws(df, draw, "credit_band", "credit_val", "npl")
    return drawn.withColumns(
        {
            "credit_score": scoring.credit_score(F.col("u_credit_band"), F.col("u_credit_val")),
            "predicted_npl": scoring.npl_score(F.col("u_npl")),
        }
    )


def stage_npl_income(e2: DataFrame, proc_ms: Column, draw: Draw) -> DataFrame:
    """Rows of the risk table for prospects whose income has been predicted."""
    rec = from_message(e2, schemas.INCOME_RESULT)
    consumed = clock.shifted(F.col("income_requested_at"), proc_ms, F.col("system_time"))
    return conform(
        with_risk_scores(rec, draw).withColumns(
            {
                "npl_requested_at": consumed,
                "e2_consumed_at": consumed,
                "sent_to_ldes": F.lit(False),
            }
        ),
        schemas.NPL_TABLE,
    )


def stage_npl_request(e3: DataFrame, proc_ms: Column, draw: Draw) -> DataFrame:
    """Rows of the risk table for customers, who come with an income."""
    rec = from_message(e3, schemas.NPL_REQUEST)
    return conform(
        with_risk_scores(rec, draw).withColumns(
            {
                "kafka_source": F.lit(schemas.TOPICS["e3"][0]),
                "sent_to_npl": F.lit(True),
                "e3_consumed_at": clock.shifted(
                    F.col("npl_requested_at"), proc_ms, F.col("system_time")
                ),
                "sent_to_ldes": F.lit(False),
            }
        ),
        schemas.NPL_TABLE,
    )


def npl_inputs(from_income: DataFrame, from_request: DataFrame) -> DataFrame:
    """Both writers of the risk table side by side."""
    return from_income.unionByName(from_request, allowMissingColumns=True)


def risk_rows(requests: DataFrame, clock_of: Callable[[str], Column], draw: Draw) -> DataFrame:
    """Rows of the risk table straight from routed requests, customers and prospects in one pass.

    What :func:`npl_inputs` holds once all requests have gone their two ways: every step is a
    function of its row, so the ways need not be taken apart. ``clock_of`` gives the wall clock of
    a stage.
    """
    customer, income_at, made = F.col("is_customer"), F.col("income_requested_at"), F.col("system_time")
    # Draws and clocks first, as columns: each is computed once however often it is used.
    salts = ("credit_band", "credit_val", "npl")
    drawn = requests.withColumns(
        {f"u_{salt}": draw(salt) for salt in salts}
        | {f"_{stage}": clock.shifted(income_at, clock_of(stage), made) for stage in ("e1_consume", "e2_produce", "e2_consume")}
        | {"_e3_consume": clock.shifted(F.col("npl_requested_at"), clock_of("e3_consume"), made)}
    )
    prospect_only = lambda c: F.when(~customer, F.col(c))
    customer_only = lambda c: F.when(customer, F.col(c))
    return conform(
        drawn.withColumns(
            {
                "credit_score": scoring.credit_score(F.col("u_credit_band"), F.col("u_credit_val")),
                "predicted_npl": scoring.npl_score(F.col("u_npl")),
                "kafka_source": F.when(customer, schemas.TOPICS["e3"][0]).otherwise(schemas.TOPICS["e1"][0]),
                "predicted_income": customer_only("predicted_income").otherwise(scoring.predicted_income(F.col("prospect_id"))),
                "e1_produced_at": prospect_only("e1_produced_at"),
                "e1_consumed_at": prospect_only("_e1_consume"),
                "sent_to_npl": F.lit(True),
                "e2_produced_at": prospect_only("_e2_produce"),
                "e2_consumed_at": prospect_only("_e2_consume"),
                "npl_requested_at": customer_only("npl_requested_at").otherwise(F.col("_e2_consume")),
                "e3_produced_at": customer_only("e3_produced_at"),
                "e3_consumed_at": customer_only("_e3_consume"),
                "sent_to_ldes": F.lit(False),
            }
        ),
        schemas.NPL_TABLE,
    )


def with_profile_draws(df: DataFrame, draw: Draw) -> DataFrame:
    """Draw the applicant's industry and, from its profile, debt ratio and job stability."""
    named = df.withColumn("employment_industry", scoring.industry(draw("industry")))
    return scoring.with_industry_profile(named, "employment_industry").withColumns(
        {
            "debt_to_income_ratio": scoring.debt_to_income(
                F.col("dti_base"), F.col("dti_width"), draw("dti")
            ),
            "employment_stability": scoring.employment_stability(
                F.col("stab_base"), F.col("stab_width"), draw("stability")
            ),
        }
    )


def with_factor_scores(df: DataFrame) -> DataFrame:
    return df.withColumns(
        scoring.factor_scores(
            F.col("predicted_income"), F.col("credit_score"), F.col("predicted_npl"),
            F.col("credibility"), F.col("debt_to_income_ratio"), F.col("employment_stability"),
        )
    )


def with_total_score(df: DataFrame) -> DataFrame:
    points = {name: F.col(name) for name, _ in scoring.WEIGHTS}
    return df.withColumn("total_score", scoring.weighted_score(points))


def with_decision(df: DataFrame, draw: Draw) -> DataFrame:
    """Score, three-way decision, its boolean form and the loan size."""
    scored = with_total_score(with_factor_scores(with_profile_draws(df, draw)))
    return _with_draws(scored, draw, "decision", "amount").withColumns(
        {
            "decision": scoring.decide(
                F.col("total_score"), F.col("credit_score"), F.col("predicted_npl"),
                F.col("debt_to_income_ratio"), F.col("u_decision"),
            ),
            "loan_amount": scoring.loan_amount(
                F.col("debt_to_income_ratio"), F.col("predicted_income"), F.col("u_amount")
            ),
        }
    ).withColumn("loan_decision", scoring.is_approved(F.col("decision")))


def stage_decision(e4: DataFrame, proc_ms: Column, draw: Draw) -> DataFrame:
    """Rows of the loan table: the decision and the size of each loan."""
    rec = from_message(e4, schemas.NPL_RESULT)
    return conform(
        with_decision(rec, draw).withColumns(
            {
                "e4_consumed_at": clock.decision_clock(
                    F.col("is_customer"), F.col("npl_requested_at"),
                    F.col("income_requested_at"), proc_ms, F.col("system_time"),
                ),
                "sent_to_ns": F.lit(False),
                "sent_to_ldis": F.lit(False),
            }
        ),
        schemas.LOAN_TABLE,
    )


def stage_analytics(e6: DataFrame, proc_ms: Column) -> DataFrame:
    """One analytics record per decision; the amount counts only when approved."""
    rec = from_message(e6, schemas.DECISION_RESULT, zero_longs=True).withColumn(
        "timestamp", proc_ms
    )
    return rec.select(
        "request_id",
        "timestamp",
        F.col("loan_decision").alias("is_approved"),
        F.when(F.col("loan_decision"), F.col("loan_amount")).otherwise(0.0).alias("loan_amount"),
        F.col("predicted_npl").alias("risk_score"),
        clock.processing_time(
            F.col("is_customer"), F.col("npl_requested_at"), F.col("income_requested_at"),
            F.col("system_time"), F.col("timestamp"),
        ).alias("processing_time"),
    )


def stage_notify(e5: DataFrame, proc_ms: Column) -> DataFrame:
    """One notification record per decision, with the composite risk."""
    rec = from_message(e5, schemas.DECISION_RESULT).withColumn("event_time", proc_ms)
    return rec.select(
        "request_id",
        "application_id",
        "customer_id",
        "loan_decision",
        "loan_amount",
        scoring.composite_risk(
            F.col("predicted_npl"), F.col("debt_to_income_ratio"), F.col("credit_score")
        ).alias("risk_score"),
        "credit_score",
        (F.col("event_time") - F.col("system_time")).alias("processing_time_ms"),
        "event_time",
    )
