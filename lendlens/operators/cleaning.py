"""Cleaning of raw loan applications: dedup, drop incomplete rows, drop outliers, tidy text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlens.functions.numeric import fold_nan
from lendlens.schema import CRITICAL_COLUMNS, MAX_AGE, MAX_INCOME, RAW_COLUMNS


def dedup(df: DataFrame) -> DataFrame:
    """Keep one of each set of fully equal rows (NULL equals NULL).

    A hash aggregate on all columns: copies collapse inside each map task first, so a row that
    makes up a third of the table still sends one record per task through the shuffle.
    """
    return df.dropDuplicates()


def drop_missing(df: DataFrame, columns: list[str] = CRITICAL_COLUMNS) -> DataFrame:
    return df.dropna(subset=columns)


def in_range() -> Column:
    """Plausible age and income and a positive amount; age and income have no lower bound."""
    return (
        (F.col("person_age") <= MAX_AGE)
        & (F.col("person_income") <= MAX_INCOME)
        & (F.col("loan_amnt") > 0)
    )


def filter_outliers(df: DataFrame) -> DataFrame:
    return df.filter(in_range())


def standardize_text(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "loan_intent": F.initcap("loan_intent"),
            "loan_grade": F.upper("loan_grade"),
            "person_home_ownership": F.upper("person_home_ownership"),
        }
    )


def clean(raw: DataFrame) -> DataFrame:
    """All four steps, in order, with NaN as missing. Both filters move below the dedup shuffle."""
    return (
        raw.transform(fold_nan)
        .transform(dedup)
        .transform(drop_missing)
        .transform(filter_outliers)
        .transform(standardize_text)
    )


def clean_funnel(raw: DataFrame) -> DataFrame:
    """Row counts after each cleaning step, in one job with one row-level shuffle."""
    complete = F.lit(True)
    for name in CRITICAL_COLUMNS:
        complete = complete & F.col(name).isNotNull()
    return (
        fold_nan(raw)
        .groupBy(*RAW_COLUMNS)
        .agg(F.count("*").alias("copies"))
        .agg(
            F.coalesce(F.sum("copies"), F.lit(0)).alias("raw_rows"),
            F.count("*").alias("after_dedup"),
            F.count_if(complete).alias("after_null_drop"),
            F.count_if(complete & in_range()).alias("after_outlier_fix"),
        )
        .select(
            "raw_rows",
            (F.col("raw_rows") - F.col("after_dedup")).alias("duplicates_removed"),
            "after_dedup",
            "after_null_drop",
            "after_outlier_fix",
            F.col("after_outlier_fix").alias("final_clean_rows"),
        )
    )
