"""The analyst queries over the CLEAN relation.

Each is one scan and one map-side-combined aggregation. Where groups are unchecked text (purpose, grade),
their shares and ranks are spread over tasks; windows in one task are over fixed bands only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lendlens.functions.measures import (
    loans,
    mean,
    rank_desc,
    rate_pct,
    share_pct,
    sum_of_result,
    total,
    with_rank,
    with_share,
)
from lendlens.operators.clean_layer import dti_bucket, score_band
from lendlens.schema import RISK_SEGMENTS
from lendlens.sources.constants import literal_rows

WORST_FIRST = F.desc_nulls_first


def default_by_tier(clean: DataFrame) -> DataFrame:
    return (
        clean.groupBy("risk_tier")
        .agg(
            loans(),
            total("default_flag", "total_defaults"),
            rate_pct(),
            mean("loan_amount", 2, "avg_loan_amount"),
            mean("interest_rate", 2, "avg_interest_rate"),
        )
        .orderBy(WORST_FIRST("default_rate_pct"))
    )


def default_by_purpose(clean: DataFrame) -> DataFrame:
    purposes = clean.groupBy("loan_purpose").agg(
        loans(),
        total("default_flag", "total_defaults"),
        rate_pct(),
        mean("loan_amount", 2, "avg_loan_amount"),
        F.avg("default_flag").alias("exact_rate"),
    )
    ranked = with_rank(purposes, "exact_rate", "risk_rank").drop("exact_rate")
    return ranked.orderBy(WORST_FIRST("default_rate_pct"))


def income_tier_default(clean: DataFrame) -> DataFrame:
    return (
        clean.groupBy("income_tier")
        .agg(
            loans("total_borrowers"),
            total("default_flag", "total_defaults"),
            rate_pct(),
            mean("annual_income", 2, "avg_income"),
            mean("loan_amount", 2, "avg_loan_amount"),
            mean("debt_to_income_ratio", 2, "avg_dti"),
        )
        .orderBy(WORST_FIRST("default_rate_pct"))
    )


def grade_risk(clean: DataFrame) -> DataFrame:
    grades = clean.groupBy("loan_grade").agg(
        loans(),
        rate_pct(),
        mean("interest_rate", 2, "avg_interest_rate"),
        mean("risk_score", 1, "avg_risk_score"),
        total("loan_amount", "total_exposure"),
    )
    shares = with_share(grades, "total_exposure", "exposure_share_pct")
    return shares.orderBy(WORST_FIRST("avg_risk_score"))


def risk_segments(clean: DataFrame) -> DataFrame:
    """High- against low-risk borrowers: always one row per segment, from one scan."""
    segment = F.lit("other")
    for label, tiers in RISK_SEGMENTS.items():
        segment = F.when(F.col("risk_tier").isin(*tiers), label).otherwise(segment)
    profile = (
        clean.groupBy(segment.alias("segment"))
        .agg(
            loans("total_borrowers"),
            mean("borrower_age", 1, "avg_age"),
            mean("annual_income", 0, "avg_income"),
            mean("loan_amount", 0, "avg_loan"),
            mean("interest_rate", 2, "avg_interest_rate"),
            mean("debt_to_income_ratio", 2, "avg_dti"),
            rate_pct(),
        )
    )
    labels = literal_rows(
        clean.sparkSession, "segment string", [(label,) for label in RISK_SEGMENTS]
    )
    # The broadcast side has at most three rows. The join leaves out other tiers: a filter on the
    # tier would be moved below the dedup when the input is not yet stored, and score rows twice.
    return labels.join(F.broadcast(profile), "segment", "left").withColumn(
        "total_borrowers", F.coalesce("total_borrowers", F.lit(0))
    )


def risk_segment(clean: DataFrame, label: str) -> DataFrame:
    """One row of ``risk_segments``; of a CLEAN table with a folder per tier, only its tiers are read."""
    own = clean.filter(F.col("risk_tier").isin(*RISK_SEGMENTS[label]))
    return risk_segments(own).filter(F.col("segment") == label)


def prior_default_impact(clean: DataFrame) -> DataFrame:
    return (
        clean.groupBy("prior_default_on_file", "risk_tier")
        .agg(
            loans(),
            rate_pct(),
            mean("risk_score", 1, "avg_risk_score"),
            mean("loan_amount", 2, "avg_loan_amount"),
            mean("interest_rate", 2, "avg_interest_rate"),
        )
        .orderBy(F.asc_nulls_last("prior_default_on_file"), WORST_FIRST("default_rate_pct"))
    )


def dti_buckets(clean: DataFrame) -> DataFrame:
    return (
        clean.groupBy(dti_bucket().alias("dti_bucket"))
        .agg(
            loans(),
            rate_pct(),
            mean("loan_amount", 2, "avg_loan_amount"),
            mean("risk_score", 1, "avg_risk_score"),
        )
        .orderBy("dti_bucket")
    )


def cumulative_exposure(clean: DataFrame) -> DataFrame:
    """Exposure per score band with its running total from the riskiest band down."""
    downwards = Window.orderBy(F.desc("risk_score_band")).rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    running = F.sum("total_exposure").over(downwards)
    return (
        clean.groupBy(score_band().alias("risk_score_band"))
        .agg(loans(), total("loan_amount", "total_exposure"), rate_pct())
        .withColumn("cumulative_exposure", running)
        .withColumn(
            "cumulative_exposure_pct",
            share_pct(F.col("cumulative_exposure"), sum_of_result("total_exposure")),
        )
        .orderBy(F.desc("risk_score_band"))
    )


def age_groups(clean: DataFrame) -> DataFrame:
    return (
        clean.groupBy("borrower_age_group")
        .agg(
            loans("total_borrowers"),
            rate_pct(),
            mean("annual_income", 0, "avg_income"),
            mean("loan_amount", 0, "avg_loan"),
            mean("debt_to_income_ratio", 2, "avg_dti"),
            mean("credit_history_years", 1, "avg_credit_history"),
            mean("risk_score", 1, "avg_risk_score"),
            F.avg("default_flag").alias("exact_rate"),
        )
        .withColumn("default_risk_rank", rank_desc("exact_rate"))
        .drop("exact_rate")
        .orderBy(WORST_FIRST("default_rate_pct"))
    )
