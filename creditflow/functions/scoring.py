"""Credit scoring, decision and loan sizing as native column expressions.

``u`` arguments are uniform draws in [0, 1), so no function hides randomness. All arithmetic
is DOUBLE and keeps its written order: the truncations are sensitive to the last bit.
"""

from __future__ import annotations

import operator
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Credit-score bands as (cumulative share, lowest score, width of the band).
CREDIT_BANDS = [
    (0.16, 300, 279),
    (0.33, 580, 89),
    (0.54, 670, 69),
    (0.80, 740, 59),
    (1.00, 800, 50),
]

# Industry, credibility, debt-to-income base and width, stability base and width.
INDUSTRIES = [
    ("Technology", 0.95, 0.25, 0.15, 0.70, 0.20),
    ("Healthcare", 0.90, 0.28, 0.17, 0.80, 0.15),
    ("Government", 0.88, 0.30, 0.15, 0.85, 0.10),
    ("Finance", 0.85, 0.27, 0.18, 0.65, 0.20),
    ("Education", 0.75, 0.35, 0.20, 0.75, 0.15),
    ("Manufacturing", 0.70, 0.33, 0.22, 0.55, 0.25),
    ("Real Estate", 0.65, 0.30, 0.25, 0.45, 0.25),
    ("Retail", 0.55, 0.40, 0.20, 0.40, 0.25),
    ("Hospitality", 0.50, 0.42, 0.23, 0.30, 0.30),
    ("Entertainment", 0.45, 0.35, 0.30, 0.25, 0.35),
]
# The same five numbers for an industry that is not listed.
UNKNOWN_INDUSTRY = (0.5, 0.35, 0.20, 0.55, 0.25)

# Income of an entity id, as base and step per last digit.
INCOME_BASE, INCOME_STEP = 50000.0, 5000.0
# The lower half of the draws spreads over 0..0.8, the upper half over 0.8..1.
NPL_SPLIT, NPL_LOW_SLOPE, NPL_HIGH_BASE, NPL_HIGH_SLOPE = 0.5, 0.8, 0.8, 0.4
# Weight of each factor, in the order in which they are summed.
WEIGHTS = [
    ("credit_points", 0.30),
    ("npl_points", 0.25),
    ("income_score", 0.20),
    ("debt_points", 0.15),
    ("stability_points", 0.05),
    ("industry_points", 0.05),
]
APPROVED, MANUAL_REVIEW, REJECTED = "APPROVED", "MANUAL_REVIEW", "REJECTED"
# Lowest score of a band, share of draws that hit, decision on a hit, on a miss.
DECISION_BANDS = [
    (80, 1.0, APPROVED, APPROVED),
    (70, 0.8, APPROVED, MANUAL_REVIEW),
    (60, 0.5, APPROVED, MANUAL_REVIEW),
    (45, 0.7, MANUAL_REVIEW, REJECTED),
    (30, 0.3, MANUAL_REVIEW, REJECTED),
]
# Limits that reject whatever the score (below, above, above).
MIN_CREDIT, MAX_NPL, MAX_DTI = 400, 0.8, 0.7
# Debt ratio below which a share applies, share base, share width.
AMOUNT_SHARES = [(0.3, 0.8, 0.1), (0.5, 0.65, 0.15), (float("inf"), 0.5, 0.15)]
# Weights of the composite risk and the floor of each risk category.
RISK_WEIGHTS = (0.4, 0.3, 0.3)
RISK_CATEGORIES = [(0.7, "HIGH"), (0.4, "MEDIUM")]

PROFILE_COLUMNS = ["credibility", "dti_base", "dti_width", "stab_base", "stab_width"]


def _first_match(cases: Iterable[tuple[Column, object]], otherwise: object) -> Column:
    """CASE WHEN over (condition, value) pairs."""
    head, *rest = cases
    chain = F.when(*head)
    for condition, value in rest:
        chain = chain.when(condition, value)
    return chain.otherwise(otherwise)


def half_up_2(x: Column) -> Column:
    """Two decimals, halves upward (``round`` would first widen the binary value)."""
    return F.floor(x * 100.0 + 0.5) / 100.0


def predicted_income(entity_id: Column) -> Column:
    return F.lit(INCOME_BASE) + (entity_id % 10) * F.lit(INCOME_STEP)


def credit_score(u_band: Column, u_value: Column) -> Column:
    """A score in 300..849; the first draw picks the band, the second the place in it."""
    places = [
        (share, F.lit(low).cast("bigint") + (u_value * float(width)).cast("bigint"))
        for share, low, width in CREDIT_BANDS
    ]
    return _first_match([(u_band < share, v) for share, v in places[:-1]], places[-1][1])


def npl_score(u: Column) -> Column:
    """Default risk, floored to two decimals; half of the draws land at 0.8 or above."""
    skewed = F.when(u < NPL_SPLIT, u * NPL_LOW_SLOPE).otherwise(
        (u - NPL_SPLIT) * NPL_HIGH_SLOPE + NPL_HIGH_BASE
    )
    return F.floor(skewed * 100.0) / 100.0


def industry(u: Column) -> Column:
    names = F.array(*[F.lit(row[0]) for row in INDUSTRIES])
    return F.element_at(names, F.floor(u * float(len(INDUSTRIES))).cast("int") + 1)


def industry_dimension(df: DataFrame) -> DataFrame:
    """The ten-row industry table, in the session of ``df``."""
    rows = ", ".join(
        "('{}', {})".format(row[0], ", ".join(f"{x}D" for x in row[1:])) for row in INDUSTRIES
    )
    return df.sparkSession.sql(
        f"SELECT * FROM VALUES {rows} AS dim(industry_name, {', '.join(PROFILE_COLUMNS)})"
    )


def with_industry_profile(df: DataFrame, name: str) -> DataFrame:
    """Add the profile columns of the industry in column ``name``.

    The dimension is a constant of ten rows, which is the bound of the broadcast.
    """
    dim = F.broadcast(industry_dimension(df))
    joined = df.join(dim, F.col(name) == F.col("industry_name"), "left").drop("industry_name")
    return joined.withColumns(
        {
            c: F.coalesce(F.col(c), F.lit(default))
            for c, default in zip(PROFILE_COLUMNS, UNKNOWN_INDUSTRY)
        }
    )


def debt_to_income(base: Column, width: Column, u: Column) -> Column:
    return half_up_2(base + u * width)


def employment_stability(base: Column, width: Column, u: Column) -> Column:
    return half_up_2(base + u * width)


def factor_scores(
    income: Column,
    credit: Column,
    npl: Column,
    credibility: Column,
    dti: Column,
    stability: Column,
) -> dict[str, Column]:
    """Six scores of 0..100, each truncated toward zero."""
    return {
        "income_score": F.least(F.lit(100.0), income / 1000.0).cast("int"),
        "credit_points": ((credit - 300) / 5.5).cast("int"),
        "npl_points": F.greatest(F.lit(0), (F.lit(100.0) - npl * 100.0).cast("int")),
        "industry_points": (credibility * 100.0).cast("int"),
        "debt_points": F.greatest(F.lit(0), (F.lit(100.0) - dti * 200.0).cast("int")),
        "stability_points": (stability * 100.0).cast("int"),
    }


def weighted_score(points: dict[str, Column]) -> Column:
    """Weighted total of the factor scores; the order of the sum is part of the contract."""
    total = reduce(operator.add, [points[name] * weight for name, weight in WEIGHTS])
    return total.cast("int")


def decide(score: Column, credit: Column, npl: Column, dti: Column, u: Column) -> Column:
    """APPROVED, MANUAL_REVIEW or REJECTED; the hard limits override the score."""
    banded = _first_match(
        [
            (score >= low, F.when(u < share, hit).otherwise(miss))
            for low, share, hit, miss in DECISION_BANDS
        ],
        REJECTED,
    )
    beyond = (credit < MIN_CREDIT) | (npl > MAX_NPL) | (dti > MAX_DTI)
    return F.when(beyond, REJECTED).otherwise(banded)


def is_approved(decision: Column) -> Column:
    """Manual review counts as not approved from here on."""
    return decision == APPROVED


def loan_amount(dti: Column, income: Column, u: Column) -> Column:
    """Income over debt ratio, cut by a drawn share, to the nearest 100."""
    potential = F.when(dti > 0, income / F.nullif(dti, F.lit(0.0))).otherwise(income * 2.0)
    shares = [(dti < limit, u * width + base) for limit, base, width in AMOUNT_SHARES]
    share = _first_match(shares[:-1], shares[-1][1])
    return F.floor(potential * share / 100.0 + 0.5) * 100.0


def composite_risk(npl: Column, dti: Column, credit: Column) -> Column:
    w_npl, w_dti, w_credit = RISK_WEIGHTS
    return npl * w_npl + dti * w_dti + (F.lit(1000) - credit) / 1000.0 * w_credit


def risk_category(risk: Column) -> Column:
    return _first_match([(risk > floor, name) for floor, name in RISK_CATEGORIES], "LOW")
