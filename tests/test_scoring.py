"""Hand-computed rows at the edges of every band and limit."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from creditflow.functions import scoring
from creditflow.plans import stages

# income, credit, npl, industry, dti, stability, u, factors (i, c, n, k, d, s), total, decision
GOLDEN = [
    (95000.0, 843, 0.29, "Technology", 0.25, 0.90, 0.5, (95, 98, 71, 95, 50, 90), 82, "APPROVED"),
    (120000.0, 850, 0.00, "Government", 0.10, 0.95, 0.99, (100, 100, 100, 88, 80, 95), 96,
     "APPROVED"),
    (95000.0, 780, 0.10, "Finance", 0.30, 0.57, 0.80, (95, 87, 90, 85, 40, 56), 80, "APPROVED"),
    (95000.0, 740, 0.20, "Finance", 0.30, 0.57, 0.79, (95, 80, 80, 85, 40, 56), 76, "APPROVED"),
    (95000.0, 740, 0.20, "Finance", 0.30, 0.57, 0.80, (95, 80, 80, 85, 40, 56), 76,
     "MANUAL_REVIEW"),
    (70000.0, 720, 0.30, "Education", 0.40, 0.75, 0.49, (70, 76, 70, 75, 20, 75), 64, "APPROVED"),
    (70000.0, 720, 0.30, "Education", 0.40, 0.75, 0.50, (70, 76, 70, 75, 20, 75), 64,
     "MANUAL_REVIEW"),
    (50000.0, 600, 0.60, "Retail", 0.50, 0.40, 0.1, (50, 54, 40, 55, 0, 40), 40, "MANUAL_REVIEW"),
    (50000.0, 400, 0.80, "Entertainment", 0.70, 0.25, 0.2, (50, 18, 20, 45, 0, 25), 23,
     "REJECTED"),
    (95000.0, 399, 0.10, "Technology", 0.25, 0.90, 0.1, (95, 18, 90, 95, 50, 90), 63, "REJECTED"),
    (95000.0, 850, 0.81, "Technology", 0.25, 0.90, 0.1, (95, 100, 19, 95, 50, 90), 70,
     "REJECTED"),
    (95000.0, 850, 0.10, "Fishing", 0.71, 0.90, 0.1, (95, 100, 90, 50, 0, 90), 78, "REJECTED"),
]


def test_golden_decisions(spark):
    rows = [(n, *row[:7]) for n, row in enumerate(GOLDEN)]
    df = spark.createDataFrame(
        rows,
        "n int, predicted_income double, credit_score bigint, predicted_npl double, "
        "employment_industry string, debt_to_income_ratio double, employment_stability double, "
        "u double",
    )
    scored = stages.with_total_score(
        stages.with_factor_scores(scoring.with_industry_profile(df, "employment_industry"))
    ).withColumn(
        "decision",
        scoring.decide(
            F.col("total_score"), F.col("credit_score"), F.col("predicted_npl"),
            F.col("debt_to_income_ratio"), F.col("u"),
        ),
    )
    for row in scored.orderBy("n").collect():
        factors = (
            row.income_score, row.credit_points, row.npl_points, row.industry_points,
            row.debt_points, row.stability_points,
        )
        assert (factors, row.total_score, row.decision) == GOLDEN[row.n][7:], row


@pytest.mark.parametrize(
    "dti, income, u, amount",
    [
        (0.29, 95000.0, 0.5, 278400.0),
        (0.30, 95000.0, 0.5, 229600.0),
        (0.49, 50000.0, 0.0, 66300.0),
        (0.50, 50000.0, 0.999, 65000.0),
        (0.00, 50000.0, 0.5, 85000.0),
    ],
)
def test_loan_amount(spark, dti, income, u, amount):
    df = spark.createDataFrame([(dti, income, u)], "dti double, income double, u double")
    got = df.select(scoring.loan_amount(F.col("dti"), F.col("income"), F.col("u"))).first()[0]
    assert got == amount


@pytest.mark.parametrize(
    "band, value, score",
    [
        (0.0, 0.0, 300), (0.159, 0.999, 578), (0.16, 0.0, 580), (0.33, 0.0, 670),
        (0.54, 0.999, 798), (0.80, 0.0, 800), (0.999, 0.999, 849),
    ],
)
def test_credit_bands(spark, band, value, score):
    df = spark.createDataFrame([(band, value)], "b double, v double")
    assert df.select(scoring.credit_score(F.col("b"), F.col("v"))).first()[0] == score


@pytest.mark.parametrize("u, npl", [(0.0, 0.0), (0.49, 0.39), (0.5, 0.8), (0.999, 0.99)])
def test_npl(spark, u, npl):
    df = spark.createDataFrame([(u,)], "u double")
    assert df.select(scoring.npl_score(F.col("u"))).first()[0] == npl


def test_half_up_is_not_round(spark):
    df = spark.createDataFrame([(1.005,), (0.125,)], "x double")
    got = [r[0] for r in df.select(scoring.half_up_2(F.col("x"))).collect()]
    assert got == [1.0, 0.13]


def test_ranges(spark, data):
    """Properties that hold for every derived loan."""
    from creditflow.plans.inputs import order_flow

    loans = order_flow(spark, data).loan
    bad = loans.filter(
        ~F.col("credit_score").between(300, 849)
        | ~F.col("predicted_npl").between(0.0, 0.99)
        | (F.col("loan_amount") % 100 != 0)
        | (
            F.col("loan_decision")
            & (
                (F.col("credit_score") < 400)
                | (F.col("predicted_npl") > 0.8)
                | (F.col("debt_to_income_ratio") > 0.7)
            )
        )
    )
    assert bad.count() == 0


def test_decision_shares(spark):
    """The draw rule fixes the shares of the ten-thousand-order set exactly."""
    from pathlib import Path

    from creditflow.plans import catalog

    folder = "/root/testdata/sf0.01"
    if not Path(folder).is_dir():
        pytest.skip("needs sf0.01")
    got = catalog.registered()["loan_decision"](spark, folder).groupBy("decision").count()
    assert {r[0]: r[1] for r in got.collect()} == {
        "REJECTED": 8099, "APPROVED": 3582, "MANUAL_REVIEW": 3319,
    }
