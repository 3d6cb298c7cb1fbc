"""The four ANALYTICS marts, grouped aggregates over the CLEAN relation.

Results carry no stored order; sort when reading, by ``MART_ORDER``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlens.functions.measures import (
    loans,
    mean,
    rate_pct,
    total,
    with_rank,
    with_share,
)
from lendlens.functions.numeric import stable_round


def risk_tier_summary(clean: DataFrame) -> DataFrame:
    groups = clean.groupBy("risk_tier", "loan_grade").agg(
        loans(),
        total("default_flag", "total_defaults"),
        rate_pct(),
        mean("loan_amount", 2, "avg_loan_amount"),
        mean("interest_rate", 2, "avg_interest_rate"),
        mean("risk_score", 1, "avg_risk_score"),
        mean("annual_income", 2, "avg_borrower_income"),
        mean("debt_to_income_ratio", 2, "avg_dti_ratio"),
        total("loan_amount", "total_loan_exposure"),
    )
    return with_share(groups, "total_loan_exposure", "exposure_share_pct")


def loan_purpose_analysis(clean: DataFrame) -> DataFrame:
    """Ranked over (purpose, grade) pairs by the unrounded default rate."""
    groups = clean.groupBy("loan_purpose", "loan_grade").agg(
        loans(),
        rate_pct(),
        mean("loan_amount", 2, "avg_loan_amount"),
        total("loan_amount", "total_exposure"),
        mean("interest_rate", 2, "avg_interest_rate"),
        mean("risk_score", 1, "avg_risk_score"),
        total("default_flag", "total_defaults"),
        F.avg("default_flag").alias("exact_rate"),
    )
    return with_rank(groups, "exact_rate", "default_risk_rank").drop("exact_rate")


def borrower_demographics(clean: DataFrame) -> DataFrame:
    return clean.groupBy("borrower_age_group", "home_ownership", "income_tier", "risk_tier").agg(
        loans("total_borrowers"),
        rate_pct(),
        mean("annual_income", 2, "avg_income"),
        mean("loan_amount", 2, "avg_loan_amount"),
        mean("risk_score", 1, "avg_risk_score"),
        mean("employment_years", 1, "avg_employment_years"),
        mean("credit_history_years", 1, "avg_credit_history"),
        total("default_flag", "total_defaults"),
    )


def credit_analysis(clean: DataFrame) -> DataFrame:
    groups = clean.groupBy("risk_tier", "prior_default_on_file", "loan_size_category").agg(
        loans(),
        rate_pct(),
        mean("risk_score", 1, "avg_risk_score"),
        stable_round(F.min("risk_score"), 1).alias("min_risk_score"),
        stable_round(F.max("risk_score"), 1).alias("max_risk_score"),
        mean("credit_history_years", 1, "avg_credit_history"),
        mean("debt_to_income_ratio", 2, "avg_dti"),
        mean("annual_interest_burden", 2, "avg_interest_burden"),
        mean("loan_amount", 2, "avg_loan_amount"),
    )
    return with_share(groups, "total_loans", "pct_of_portfolio")


MARTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "risk_tier_summary": risk_tier_summary,
    "loan_purpose_analysis": loan_purpose_analysis,
    "borrower_demographics": borrower_demographics,
    "credit_analysis": credit_analysis,
}
MART_ORDER = {
    "risk_tier_summary": "avg_risk_score",
    "loan_purpose_analysis": "default_rate_pct",
    "borrower_demographics": "default_rate_pct",
    "credit_analysis": "avg_risk_score",
}


def sorted_mart(name: str, mart: DataFrame) -> DataFrame:
    return mart.orderBy(F.desc_nulls_first(MART_ORDER[name]))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One (table_name, row_count) row per table."""
    counts = None
    for name, table in tables.items():
        one = table.agg(F.count("*").alias("row_count")).select(
            F.lit(name.upper()).alias("table_name"), "row_count"
        )
        counts = one if counts is None else counts.unionByName(one)
    return counts
