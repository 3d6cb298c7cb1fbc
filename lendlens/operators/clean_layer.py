"""The CLEAN relation: scored loans renamed, rounded and limited to valid rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlens.functions.numeric import bucketize, round_half_up
from lendlens.schema import CLEAN_AGE_RANGE, CLEAN_COLUMNS, DTI_BUCKETS, OUTCOME_LABELS


def clean_layer(scored: DataFrame) -> DataFrame:
    """21 columns; drops rows that were scored but have no income, no amount or an odd age."""
    valid = (
        (F.col("loan_amnt") > 0)
        & (F.col("person_income") > 0)
        & F.col("person_age").between(*CLEAN_AGE_RANGE)
    )
    columns = {
        "borrower_age": F.col("person_age"),
        "borrower_age_group": F.col("age_group"),
        "home_ownership": F.upper("person_home_ownership"),
        "annual_income": F.round("person_income", 2),
        "employment_years": F.col("person_emp_length"),
        "loan_amount": F.col("loan_amnt"),
        "interest_rate": round_half_up(F.col("loan_int_rate"), 2),
        "loan_purpose": F.initcap("loan_intent"),
        "loan_grade": F.upper("loan_grade"),
        "loan_percent_income": round_half_up(F.col("loan_percent_income"), 4),
        "debt_to_income_ratio": round_half_up(F.col("debt_to_income_ratio"), 2),
        "loan_to_income_ratio": round_half_up(F.col("loan_to_income_ratio"), 4),
        "annual_interest_burden": round_half_up(F.col("annual_interest_burden"), 2),
        "credit_history_years": F.col("cb_person_cred_hist_length"),
        "prior_default_on_file": F.upper("cb_person_default_on_file"),
        "loan_outcome": F.when(F.col("loan_status") == 1, OUTCOME_LABELS[1]).otherwise(
            OUTCOME_LABELS[0]
        ),
        "default_flag": F.col("loan_status"),
    }
    return scored.filter(valid).select(
        *[columns.get(name, F.col(name)).alias(name) for name in CLEAN_COLUMNS]
    )


def dti_bucket() -> Column:
    return bucketize(F.col("debt_to_income_ratio"), DTI_BUCKETS)


def score_band() -> Column:
    """Ten-point band around a multiple of ten: band 30 is [25, 35)."""
    return round_half_up(F.col("risk_score") / 10, 0) * 10
