import itertools

from pyspark.sql import functions as F

from lendlens.operators.features import add_features
from lendlens.operators.scoring import add_risk_score
from lendlens.plans.pipeline import score_loans
from lendlens.schema import ScoreModel, Segments


def score_one(make_loans, model=None, **row):
    featured = add_features(make_loans(row))
    return (add_risk_score(featured, model) if model else add_risk_score(featured)).first()


def test_hand_computed_score(make_loans):
    row = score_one(make_loans)
    assert row.debt_to_income_ratio == 20.0
    assert row.loan_to_income_ratio == 0.2
    assert row.annual_interest_burden == 2.5
    # 30, 50, 40 and 60 points at 35, 25, 25 and 15 percent.
    assert (row.risk_score, row.risk_tier) == (42.0, "Medium Risk")


def test_missing_inputs_take_their_documented_points(make_loans):
    base = score_one(make_loans).risk_score
    assert score_one(make_loans, cb_person_cred_hist_length=None).risk_score == base - 9.0
    assert score_one(make_loans, loan_grade=None).risk_score == base + 24.5
    assert score_one(make_loans, loan_grade="Z").risk_score == base + 24.5
    zero_income = score_one(make_loans, person_income=0)
    assert zero_income.debt_to_income_ratio is None
    assert zero_income.annual_interest_burden is None
    assert zero_income.risk_score == base + 15.0


def test_points_are_capped(make_loans):
    worst = score_one(
        make_loans, loan_grade="G", loan_int_rate=99.0, loan_amnt=500_000,
        cb_person_cred_hist_length=0,
    )
    assert (worst.risk_score, worst.risk_tier) == (100.0, "Critical Risk")
    assert score_one(make_loans, cb_person_cred_hist_length=40).risk_score == 33.0


def test_score_is_monotonic(spark, make_loans):
    grid = [
        {"loan_int_rate": r, "loan_amnt": a, "person_income": i, "cb_person_cred_hist_length": h}
        for r, a, i, h in itertools.product(
            (5.0, 9.99, 18.0, 30.0), (1000, 9000, 40_000), (8000, 50_000, 400_000), (0, 3, 12)
        )
    ]
    rows = add_risk_score(add_features(make_loans(*grid))).collect()
    for a, b in itertools.product(rows, rows):
        riskier = (
            a.loan_int_rate >= b.loan_int_rate
            and a.loan_amnt >= b.loan_amnt
            and a.person_income <= b.person_income
            and a.cb_person_cred_hist_length <= b.cb_person_cred_hist_length
        )
        assert not riskier or a.risk_score >= b.risk_score


def test_model_can_be_replaced(make_loans):
    model = ScoreModel(
        grade_points={"C": 80},
        grade_weight=1.0,
        rate_weight=0.0,
        dti_weight=0.0,
        history_weight=0.0,
        tiers=Segments((79.9,), ("fine", "watch"), upper_inclusive=True),
    )
    row = score_one(make_loans, model)
    assert (row.risk_score, row.risk_tier) == (80.0, "watch")


def test_scored_shape_and_tiers(scored):
    assert len(scored.columns) == 20
    counts = {r.risk_tier: r["count"] for r in scored.groupBy("risk_tier").count().collect()}
    assert counts == {"Low Risk": 501, "Medium Risk": 739, "High Risk": 89, "Critical Risk": 13}
    assert scored.filter(F.col("risk_score").isNull()).count() == 0


def test_empty_input(make_loans):
    assert score_loans(make_loans({}).limit(0)).count() == 0
