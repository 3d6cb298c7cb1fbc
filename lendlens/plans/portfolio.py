"""Exploratory reports on raw loans and distribution reports on scored loans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlens.functions.measures import (
    loans,
    mean,
    rate_pct,
    share_of_result,
)
from lendlens.functions.numeric import fold_nan, ratio, stable_round
from lendlens.operators.histograms import histogram, histogram_by_class
from lendlens.schema import STATUS_LABELS
from lendlens.sources.layers import LOANS, LayerStore

AMOUNT_BINS = 40
AGE_BINS = 30
RATE_BINS = 30


def _status_label() -> Column:
    chain = F
    for value, label in STATUS_LABELS.items():
        chain = chain.when(F.col("loan_status") == value, label)
    return chain


def status_distribution(raw: DataFrame) -> DataFrame:
    """Loans per status with their share; the label goes with the value, not with its rank."""
    return (
        raw.filter(F.col("loan_status").isNotNull())
        .groupBy("loan_status")
        .agg(loans("count"))
        .select(
            "loan_status",
            _status_label().alias("label"),
            "count",
            share_of_result("count", 1).alias("share_pct"),
        )
        .orderBy(F.desc("count"))
    )


def loan_amount_histogram(raw: DataFrame) -> DataFrame:
    return histogram(fold_nan(raw), "loan_amnt", AMOUNT_BINS)


def age_histogram(raw: DataFrame) -> DataFrame:
    return histogram(fold_nan(raw), "person_age", AGE_BINS)


def rate_histogram_by_status(raw: DataFrame) -> DataFrame:
    return histogram_by_class(
        fold_nan(raw), "loan_int_rate", RATE_BINS, "loan_status", list(STATUS_LABELS)
    )


def stored_amount_histogram(store: LayerStore) -> DataFrame:
    """``loan_amount_histogram`` of the RAW table: bounds from file footers, then one scan."""
    bounds = store.bounds("raw", LOANS, "LOAN_AMNT")[None]
    return histogram(store.read("raw"), "LOAN_AMNT", AMOUNT_BINS, bounds)


def stored_rate_histogram(store: LayerStore) -> DataFrame:
    """``rate_histogram_by_status`` of the RAW table, which has a folder per status."""
    bounds = store.bounds("raw", LOANS, "LOAN_INT_RATE", "LOAN_STATUS")
    rows = histogram_by_class(
        store.read("raw"), "LOAN_INT_RATE", RATE_BINS, "LOAN_STATUS", list(STATUS_LABELS), bounds
    )
    return rows.withColumnRenamed("LOAN_STATUS", "loan_status")


def executive_summary(raw: DataFrame) -> DataFrame:
    """Headline figures of the raw rows; averages skip NULL, the default rate counts every row."""
    rate = stable_round(ratio(F.col("total_defaults"), F.col("total_loans")) * 100, 2)
    return (
        fold_nan(raw).agg(
            loans(),
            F.coalesce(F.sum("loan_status"), F.lit(0)).alias("total_defaults"),
            mean("loan_amnt", 2, "avg_loan_amount"),
            mean("person_income", 2, "avg_income"),
            mean("loan_int_rate", 2, "avg_interest_rate"),
            mean("person_age", 1, "avg_age"),
            mean("cb_person_cred_hist_length", 1, "avg_credit_history"),
        )
        .withColumn("default_rate_pct", rate)
        .withColumn(
            "one_default_in", stable_round(ratio(F.lit(100.0), F.col("default_rate_pct")), 1)
        )
    )


def tier_distribution(scored: DataFrame) -> DataFrame:
    return (
        scored.groupBy("risk_tier")
        .agg(
            loans("count"),
            mean("risk_score", 1, "avg_score"),
            rate_pct("loan_status", name="actual_default_rate_pct"),
        )
        .orderBy("avg_score")
    )


def tier_status_counts(scored: DataFrame) -> DataFrame:
    return scored.groupBy("risk_tier", "loan_status").agg(loans("count"))


def tier_summary(scored: DataFrame) -> DataFrame:
    return (
        scored.groupBy("risk_tier")
        .agg(
            loans("total"),
            rate_pct("loan_status", 1, "default_rate"),
            mean("risk_score", 1, "avg_risk_score"),
            mean("loan_amnt", 0, "avg_loan"),
        )
        .orderBy("avg_risk_score")
    )


def tier_shares(scored: DataFrame) -> DataFrame:
    return (
        scored.groupBy("risk_tier")
        .agg(loans("count"))
        .withColumn("share_pct", share_of_result("count", 1))
        .orderBy(F.desc("count"))
    )
