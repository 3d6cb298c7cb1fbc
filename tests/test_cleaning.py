import pytest

from lendlens.operators import cleaning
from lendlens.schema import CRITICAL_COLUMNS, RAW_COLUMNS


def test_dedup_matches_nulls_and_keeps_case_variants(make_loans):
    loans = make_loans(
        {"person_emp_length": None},
        {"person_emp_length": None},
        {"person_home_ownership": "rent"},
        {"person_home_ownership": "RENT"},
    )
    assert cleaning.dedup(loans).count() == 3
    # Text is only tidied afterwards, so the two spellings both survive.
    assert cleaning.clean(loans).count() == 3


def test_dedup_is_idempotent(raw):
    once = cleaning.dedup(raw)
    assert cleaning.dedup(once).count() == once.count() == 1500


@pytest.mark.parametrize("column", RAW_COLUMNS)
def test_only_critical_columns_drop_rows(make_loans, column):
    kept = cleaning.drop_missing(make_loans({column: None})).count()
    assert kept == (0 if column in CRITICAL_COLUMNS else 1)


def test_range_filter_bounds(make_loans):
    loans = make_loans(
        {"person_age": 100},
        {"person_age": 101},
        {"person_age": -5},
        {"person_income": 3_000_000},
        {"person_income": 3_000_001},
        {"person_income": 0},
        {"loan_amnt": 0},
        {"loan_amnt": 1},
    )
    kept = cleaning.filter_outliers(loans).collect()
    assert len(kept) == 5
    assert {row.person_age for row in kept} == {100, -5, 30}


def test_text_is_standardized(make_loans):
    row = cleaning.standardize_text(
        make_loans(
            {
                "loan_intent": "hOME improvement",
                "loan_grade": "b",
                "person_home_ownership": "Own",
                "cb_person_default_on_file": "y",
            }
        )
    ).first()
    assert row.loan_intent == "Home Improvement"
    assert (row.loan_grade, row.person_home_ownership) == ("B", "OWN")
    assert row.cb_person_default_on_file == "y"


def test_funnel_counts(raw, make_loans):
    assert cleaning.clean_funnel(raw).first().asDict() == {
        "raw_rows": 1530,
        "duplicates_removed": 30,
        "after_dedup": 1500,
        "after_null_drop": 1347,
        "after_outlier_fix": 1342,
        "final_clean_rows": 1342,
    }
    empty = cleaning.clean_funnel(make_loans({}).limit(0)).first()
    assert tuple(empty) == (0, 0, 0, 0, 0, 0)


def test_nan_counts_as_missing_in_every_raw_plan(make_loans):
    from lendlens.operators.cleaning import clean, clean_funnel
    from lendlens.plans import portfolio

    raw = make_loans({"loan_int_rate": 10.0}, {"loan_int_rate": float("nan"), "person_age": 40})
    funnel = clean_funnel(raw).first()
    assert funnel.final_clean_rows == clean(raw).count() == 1
    summary = portfolio.executive_summary(raw).first().asDict()
    assert 10.0 in summary.values() and not [v for v in summary.values() if v != v]
    bins = portfolio.rate_histogram_by_status(raw).collect()
    assert not [v for row in bins for v in row if isinstance(v, float) and v != v]
