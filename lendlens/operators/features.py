"""Affordability ratios and segments derived from one loan application."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlens.functions.numeric import bucketize, ratio, round_half_up
from lendlens.schema import AGE_GROUPS, INCOME_TIERS, LOAN_SIZES


def add_features(df: DataFrame) -> DataFrame:
    """Six feature columns. A zero income gives NULL ratios.

    Both sides of the debt-to-income ratio are monthly, so it equals the loan as a percentage of
    yearly income.
    """
    amount, income = F.col("loan_amnt"), F.col("person_income")
    interest = amount * F.col("loan_int_rate") / 100
    return df.withColumns(
        {
            "debt_to_income_ratio": round_half_up(ratio(amount / 12, income / 12) * 100, 2),
            "loan_to_income_ratio": round_half_up(ratio(amount, income), 4),
            "annual_interest_burden": round_half_up(ratio(interest, income) * 100, 2),
            "age_group": bucketize(F.col("person_age"), AGE_GROUPS),
            "income_tier": bucketize(income, INCOME_TIERS),
            "loan_size_category": bucketize(amount, LOAN_SIZES),
        }
    )
