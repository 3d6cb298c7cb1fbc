from pyspark.sql import functions as F

from lendlens.operators.clean_layer import clean_layer, score_band
from lendlens.plans.pipeline import score_loans
from lendlens.schema import CLEAN_COLUMNS


def test_columns_in_order(clean):
    assert clean.columns == CLEAN_COLUMNS
    assert len(CLEAN_COLUMNS) == 21


def test_scored_rows_without_income_or_under_age_are_left_out(make_loans):
    scored = score_loans(
        make_loans(
            {"person_income": 0},
            {"person_income": -1},
            {"person_age": 17},
            {"person_age": 18},
            {"person_age": 100},
        )
    )
    assert scored.count() == 5
    assert sorted(r.borrower_age for r in clean_layer(scored).collect()) == [18, 100]


def test_outcome_and_prior_default(make_loans):
    rows = clean_layer(
        score_loans(
            make_loans(
                {"loan_status": 1, "cb_person_default_on_file": "y"},
                {"loan_status": 0, "cb_person_default_on_file": None},
            )
        )
    ).collect()
    found = {(r.default_flag, r.loan_outcome, r.prior_default_on_file) for r in rows}
    assert found == {(1, "Defaulted", "Y"), (0, "Non-Default", None)}


def test_reads_the_upper_case_raw_table(spark, make_loans):
    scored = score_loans(make_loans({}))
    upper = scored.toDF(*[c.upper() for c in scored.columns])
    assert clean_layer(upper).collect() == clean_layer(scored).collect()


def test_score_band_rounds_half_up(spark):
    frame = spark.createDataFrame([(24.9,), (25.0,), (34.9,), (35.0,), (100.0,)], "risk_score double")
    assert [r[0] for r in frame.select(score_band()).collect()] == [20.0, 30.0, 30.0, 40.0, 100.0]
    assert frame.select(score_band().alias("b")).filter(F.col("b") == 30).count() == 2
