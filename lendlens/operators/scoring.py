"""The weighted 0-100 risk score and its tier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlens.functions.numeric import bucketize, round_half_up
from lendlens.schema import DEFAULT_MODEL, ScoreModel


def grade_points(model: ScoreModel = DEFAULT_MODEL) -> Column:
    """Points by grade; an unknown or missing grade gets the highest."""
    chain = F
    for grade, points in model.grade_points.items():
        chain = chain.when(F.col("loan_grade") == grade, points)
    return chain.otherwise(model.other_grade_points)


def rate_points(model: ScoreModel = DEFAULT_MODEL) -> Column:
    return F.least(F.lit(100), round_half_up(F.col("loan_int_rate") / model.top_rate * 100, 0))


def dti_points(model: ScoreModel = DEFAULT_MODEL) -> Column:
    """Points for the rounded ratio; ``least`` skips NULL, so no income scores 100."""
    return F.least(F.lit(100), round_half_up(F.col("debt_to_income_ratio") * model.dti_factor, 0))


def history_points(model: ScoreModel = DEFAULT_MODEL) -> Column:
    """Fewer points for a longer history; ``greatest`` skips NULL, so no history scores 0."""
    earned = F.col("cb_person_cred_hist_length") * model.points_per_history_year
    return F.greatest(F.lit(0), F.round(100 - earned, 0))


def add_risk_score(df: DataFrame, model: ScoreModel = DEFAULT_MODEL) -> DataFrame:
    # Each step is a column of its own: rounding names its input several times, and Catalyst
    # then computes that input once instead of repeating the expression.
    points = {
        "_grade": grade_points(model) * model.grade_weight,
        "_rate": rate_points(model) * model.rate_weight,
        "_dti": dti_points(model) * model.dti_weight,
        "_history": history_points(model) * model.history_weight,
    }
    exact = F.col("_grade") + F.col("_rate") + F.col("_dti") + F.col("_history")
    return (
        df.withColumns(points)
        .withColumn("_exact", exact)
        .withColumn("risk_score", round_half_up(F.col("_exact"), 1))
        .withColumn("risk_tier", bucketize(F.col("risk_score"), model.tiers))
        .drop(*points, "_exact")
    )
