"""Checks that a loaded table holds what was written to it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlens.functions.measures import rate_pct

SAMPLE_COLUMNS = [
    "person_age",
    "loan_amnt",
    "loan_int_rate",
    "risk_score",
    "risk_tier",
    "loan_status",
]


def count_rows(df: DataFrame, name: str = "total_rows") -> DataFrame:
    return df.agg(F.count("*").alias(name))


def tier_check(loaded: DataFrame) -> DataFrame:
    return (
        loaded.groupBy("risk_tier")
        .agg(
            F.count("*").alias("total"),
            rate_pct("loan_status", name="actual_default_rate"),
        )
        .orderBy(F.desc("total"))
    )


def sample_rows(loaded: DataFrame, rows: int = 5) -> DataFrame:
    """A few loaded rows, the same ones every time (a top-k by the shown columns)."""
    columns = [F.col(name).alias(name) for name in SAMPLE_COLUMNS]
    return loaded.select(*columns).orderBy(*SAMPLE_COLUMNS).limit(rows)


def load_checks(source: DataFrame, target: DataFrame) -> DataFrame:
    """One pass/fail row for the row count and one per risk tier."""
    tagged = source.select("risk_tier", F.lit(1).alias("s"), F.lit(0).alias("t")).unionByName(
        target.select("risk_tier", F.lit(0).alias("s"), F.lit(1).alias("t"))
    )
    counts = [F.sum("s").alias("source_rows"), F.sum("t").alias("target_rows")]
    per_tier = tagged.groupBy("risk_tier").agg(*counts)
    overall = per_tier.agg(
        F.coalesce(F.sum("source_rows"), F.lit(0)).alias("source_rows"),
        F.coalesce(F.sum("target_rows"), F.lit(0)).alias("target_rows"),
    )
    tier_name = F.concat(F.lit("tier: "), F.coalesce("risk_tier", F.lit("NULL")))
    return (
        overall.select(F.lit("row count").alias("check_name"), "source_rows", "target_rows")
        .unionByName(
            per_tier.select(tier_name.alias("check_name"), "source_rows", "target_rows")
        )
        .withColumn("passed", F.col("source_rows") == F.col("target_rows"))
    )
