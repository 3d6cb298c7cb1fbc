"""The data behind each dashboard page, rolled up from marts where they carry what is needed.

A rate is rolled up as total defaults over total loans, never as an average of rates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lendlens.functions.measures import loans, share_pct
from lendlens.functions.numeric import ratio, stable_round
from lendlens.operators.clean_layer import dti_bucket
from lendlens.schema import RISK_SEGMENTS


def portfolio_kpis(risk_tier_summary: DataFrame) -> DataFrame:
    """Loans, default rate, exposure, and the share of loans in the High or Critical tier."""
    risky = F.col("risk_tier").isin(*RISK_SEGMENTS["High Risk"])
    return risk_tier_summary.agg(
        F.sum("total_loans").alias("total_loans"),
        F.sum("total_defaults").alias("total_defaults"),
        share_pct(F.sum("total_defaults"), F.sum("total_loans")).alias("default_rate_pct"),
        F.sum("total_loan_exposure").alias("total_exposure"),
        share_pct(
            F.sum(F.when(risky, F.col("total_loans")).otherwise(0)), F.sum("total_loans")
        ).alias("high_risk_rate_pct"),
    )


def loan_performance(loan_purpose_analysis: DataFrame) -> DataFrame:
    """Default rates and exposure by purpose and, separately, by grade."""
    by_purpose, by_grade = F.col("loan_purpose"), F.col("loan_grade")
    section = F.when(F.grouping("loan_grade") == 1, "loan_purpose").otherwise("loan_grade")
    category = F.when(F.grouping("loan_grade") == 1, F.col("loan_purpose")).otherwise(
        F.col("loan_grade")
    )
    rolled = loan_purpose_analysis.groupingSets(
        [[by_purpose], [by_grade]], by_purpose, by_grade
    ).agg(
        section.alias("section"),
        category.alias("category"),
        F.sum("total_loans").alias("total_loans"),
        F.sum("total_defaults").alias("total_defaults"),
        F.sum("total_exposure").alias("total_exposure"),
    )
    by_section = Window.partitionBy("section")
    exact = ratio(F.col("total_defaults"), F.col("total_loans"))
    return rolled.select(
        "section",
        "category",
        "total_loans",
        "total_defaults",
        share_pct(F.col("total_defaults"), F.col("total_loans")).alias("default_rate_pct"),
        stable_round(ratio(F.col("total_exposure"), F.col("total_loans")), 2).alias(
            "avg_loan_amount"
        ),
        "total_exposure",
        share_pct(F.col("total_exposure"), F.sum("total_exposure").over(by_section)).alias(
            "exposure_share_pct"
        ),
        F.rank().over(by_section.orderBy(exact.desc())).alias("risk_rank"),
    )


def customer_segments(borrower_demographics: DataFrame) -> DataFrame:
    """Borrowers and default rate by age group, by income tier and by home ownership."""
    keys = ["borrower_age_group", "income_tier", "home_ownership"]
    section, category = F.lit(keys[-1]), F.col(keys[-1])
    for key in keys[:-1]:
        grouped_by_key = F.grouping(key) == 0
        section = F.when(grouped_by_key, key).otherwise(section)
        category = F.when(grouped_by_key, F.col(key)).otherwise(category)
    return (
        borrower_demographics.groupingSets([[F.col(key)] for key in keys], *map(F.col, keys))
        .agg(
            section.alias("section"),
            category.alias("category"),
            F.sum("total_borrowers").alias("total_borrowers"),
            F.sum("total_defaults").alias("total_defaults"),
            share_pct(F.sum("total_defaults"), F.sum("total_borrowers")).alias(
                "default_rate_pct"
            ),
        )
        .drop(*keys)
    )


def credit_analysis_page(clean: DataFrame) -> DataFrame:
    """By DTI bucket, by prior default and tier, and by tier: one scan of the CLEAN relation.

    The credit mart holds no default counts, so this page comes from the loans themselves. They
    are summed once by all three keys; the three groupings then only expand those few sums.
    """
    measures = ["default_flag", "risk_score", "loan_amount"]
    sums = clean.groupBy(
        dti_bucket().alias("dti_bucket"), "prior_default_on_file", "risk_tier"
    ).agg(
        loans("n"),
        *[F.sum(name).alias(f"{name}_sum") for name in measures],
        *[F.count(name).alias(f"{name}_n") for name in measures],
    )
    bucket, prior, tier = map(F.col, ("dti_bucket", "prior_default_on_file", "risk_tier"))
    section = (
        F.when(F.grouping("dti_bucket") == 0, "dti_bucket")
        .when(F.grouping("prior_default_on_file") == 0, "prior_default")
        .otherwise("risk_tier")
    )

    def average(name: str) -> Column:
        return ratio(F.sum(f"{name}_sum"), F.sum(f"{name}_n"))

    return sums.groupingSets([[bucket], [prior, tier], [tier]], bucket, prior, tier).agg(
        section.alias("section"),
        F.sum("n").alias("total_loans"),
        stable_round(average("default_flag") * 100, 2).alias("default_rate_pct"),
        stable_round(average("risk_score"), 1).alias("avg_risk_score"),
        stable_round(average("loan_amount"), 2).alias("avg_loan_amount"),
    )


#: page -> its mart
MART_PAGES = {
    "portfolio_kpis": (portfolio_kpis, "risk_tier_summary"),
    "loan_performance": (loan_performance, "loan_purpose_analysis"),
    "customer_segments": (customer_segments, "borrower_demographics"),
}


def stored_pages(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """The pages that need nothing but a mart, read through the database of the analytics layer."""
    return {
        name: page(spark.table(f"`{database}`.`{mart}`")) for name, (page, mart) in MART_PAGES.items()
    }
