"""Schemas, labels, cut points and score constants, kept in one place."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

RAW_SCHEMA = T.StructType(
    [
        T.StructField("person_age", T.IntegerType()),
        T.StructField("person_income", T.LongType()),
        T.StructField("person_home_ownership", T.StringType()),
        T.StructField("person_emp_length", T.DoubleType()),
        T.StructField("loan_intent", T.StringType()),
        T.StructField("loan_grade", T.StringType()),
        T.StructField("loan_amnt", T.IntegerType()),
        T.StructField("loan_int_rate", T.DoubleType()),
        T.StructField("loan_status", T.IntegerType()),
        T.StructField("loan_percent_income", T.DoubleType()),
        T.StructField("cb_person_default_on_file", T.StringType()),
        T.StructField("cb_person_cred_hist_length", T.IntegerType()),
    ]
)
RAW_COLUMNS = RAW_SCHEMA.fieldNames()

NULL_TOKEN = "NA"

# A row without any one of these cannot be scored.
CRITICAL_COLUMNS = ["loan_amnt", "loan_int_rate", "loan_status", "person_age", "person_income"]

MAX_AGE = 100
MAX_INCOME = 3_000_000
CLEAN_AGE_RANGE = (18, 100)


@dataclass(frozen=True)
class Segments:
    """Cut points and one label more than cuts; the last label also takes NULL."""

    cuts: tuple[float, ...]
    labels: tuple[str, ...]
    upper_inclusive: bool = False


# The labels and cut points below are part of the results.
AGE_GROUPS = Segments(
    (25, 35, 45, 55),
    (
        "Gen Z (<25)",
        "Young Adult (25-34)",
        "Mid Career (35-44)",
        "Experienced (45-54)",
        "Senior (55+)",
    ),
)
INCOME_TIERS = Segments(
    (30_000, 60_000, 100_000),
    ("Low (<$30K)", "Medium ($30K-$60K)", "High ($60K-$100K)", "Very High (>$100K)"),
)
LOAN_SIZES = Segments(
    (5_000, 15_000, 25_000),
    ("Small (<$5K)", "Medium ($5K-$15K)", "Large ($15K-$25K)", "Very Large (>$25K)"),
)
DTI_BUCKETS = Segments(
    (10, 20, 35, 50),
    (
        "1. Low DTI (<10%)",
        "2. Moderate DTI (10-20%)",
        "3. High DTI (20-35%)",
        "4. Very High DTI (35-50%)",
        "5. Critical DTI (>50%)",
    ),
)
LOW_RISK, MEDIUM_RISK, HIGH_RISK, CRITICAL_RISK = (
    "Low Risk",
    "Medium Risk",
    "High Risk",
    "Critical Risk",
)
RISK_TIERS = Segments(
    (30, 55, 75), (LOW_RISK, MEDIUM_RISK, HIGH_RISK, CRITICAL_RISK), upper_inclusive=True
)
RISK_SEGMENTS = {
    "High Risk": (HIGH_RISK, CRITICAL_RISK),
    "Low/Medium Risk": (LOW_RISK, MEDIUM_RISK),
}
STATUS_LABELS = {0: "Non-Default", 1: "Default"}
OUTCOME_LABELS = {0: "Non-Default", 1: "Defaulted"}
NULL_ALERT_PCT = 5
QUALITY_LABELS = ("Good", "Needs Attention")


@dataclass(frozen=True)
class ScoreModel:
    """Points and weights of the 0-100 risk score."""

    # Fixed values.
    grade_points: dict[str, int] = field(
        default_factory=lambda: {"A": 5, "B": 15, "C": 30, "D": 50, "E": 70, "F": 85}
    )
    other_grade_points: int = 100
    top_rate: float = 25
    dti_factor: float = 2
    points_per_history_year: int = 10
    grade_weight: float = 0.35
    rate_weight: float = 0.25
    dti_weight: float = 0.25
    history_weight: float = 0.15
    tiers: Segments = RISK_TIERS


DEFAULT_MODEL = ScoreModel()

# New name -> scored column, in output order; the CLEAN layer also adds loan_outcome.
CLEAN_COLUMNS = [
    "borrower_age",
    "borrower_age_group",
    "home_ownership",
    "annual_income",
    "income_tier",
    "employment_years",
    "loan_amount",
    "loan_size_category",
    "interest_rate",
    "loan_purpose",
    "loan_grade",
    "loan_percent_income",
    "debt_to_income_ratio",
    "loan_to_income_ratio",
    "annual_interest_burden",
    "credit_history_years",
    "prior_default_on_file",
    "risk_score",
    "risk_tier",
    "loan_outcome",
    "default_flag",
]
