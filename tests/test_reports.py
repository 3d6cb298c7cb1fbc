import pytest

from lendlens.operators.clean_layer import clean_layer
from lendlens.plans import business, dashboards, marts, portfolio
from lendlens.plans.pipeline import score_loans


def test_status_labels_go_with_the_value(make_loans):
    loans = make_loans(*[{"loan_status": 1}] * 3, {"loan_status": 0}, {"loan_status": None})
    rows = [tuple(r) for r in portfolio.status_distribution(loans).collect()]
    assert rows == [(1, "Default", 3, 75.0), (0, "Non-Default", 1, 25.0)]


def test_executive_summary(make_loans):
    row = portfolio.executive_summary(
        make_loans(
            {"loan_status": 1, "loan_int_rate": None, "person_age": 20},
            {"loan_status": 0, "loan_int_rate": 10.0, "person_age": 31},
            {"loan_status": None, "loan_int_rate": 13.0, "person_age": 40},
        )
    ).first()
    assert (row.total_loans, row.total_defaults, row.default_rate_pct) == (3, 1, 33.33)
    assert (row.avg_interest_rate, row.avg_age, row.one_default_in) == (11.5, 30.3, 3.0)


def test_executive_summary_without_defaults_or_rows(make_loans):
    assert portfolio.executive_summary(make_loans({})).first().one_default_in is None
    empty = portfolio.executive_summary(make_loans({}).limit(0)).first()
    assert (empty.total_loans, empty.total_defaults, empty.default_rate_pct) == (0, 0, None)


def test_tier_reports_add_up(scored):
    total = scored.count()
    assert sum(r["count"] for r in portfolio.tier_distribution(scored).collect()) == total
    assert sum(r["count"] for r in portfolio.tier_status_counts(scored).collect()) == total
    assert sum(r.total for r in portfolio.tier_summary(scored).collect()) == total
    shares = portfolio.tier_shares(scored).collect()
    assert abs(sum(r.share_pct for r in shares) - 100) <= 0.05 * len(shares)
    assert [r["count"] for r in shares] == sorted((r["count"] for r in shares), reverse=True)


@pytest.mark.parametrize("name", marts.MARTS)
def test_marts_add_up_to_the_loans(clean, name):
    mart = marts.MARTS[name](clean)
    rows = mart.collect()
    count = "total_borrowers" if "total_borrowers" in mart.columns else "total_loans"
    assert sum(r[count] for r in rows) == clean.count()
    if "total_defaults" in mart.columns:
        assert sum(r.total_defaults for r in rows) == clean.filter("default_flag = 1").count()
    for share in {"exposure_share_pct", "pct_of_portfolio"} & set(mart.columns):
        assert abs(sum(r[share] for r in rows) - 100) <= 0.01 * len(rows)


def test_mart_widths(clean):
    widths = [len(mart(clean).columns) for mart in marts.MARTS.values()]
    assert widths == [12, 10, 12, 13]


def test_sorted_mart(clean):
    for name, mart in marts.MARTS.items():
        values = [r[marts.MART_ORDER[name]] for r in marts.sorted_mart(name, mart(clean)).collect()]
        assert values == sorted(values, reverse=True)


def test_row_counts(clean):
    tables = {name: mart(clean) for name, mart in marts.MARTS.items()}
    counts = {r.table_name: r.row_count for r in marts.row_counts(tables).collect()}
    assert counts == {name.upper(): table.count() for name, table in tables.items()}


def test_ranks_have_gaps_after_ties(make_loans):
    loans = [
        {"loan_intent": intent, "loan_status": status, "person_emp_length": float(i)}
        for intent, statuses in {"A": (1, 0), "B": (0, 1), "C": (0, 0), "D": (1, 1)}.items()
        for i, status in enumerate(statuses)
    ]
    clean = clean_layer(score_loans(make_loans(*loans)))
    ranks = {r.loan_purpose: r.risk_rank for r in business.default_by_purpose(clean).collect()}
    assert ranks == {"D": 1, "A": 2, "B": 2, "C": 4}


def test_cumulative_exposure_ends_at_everything(clean):
    rows = business.cumulative_exposure(clean).collect()
    bands = [r.risk_score_band for r in rows]
    assert bands == sorted(bands, reverse=True)
    assert rows[-1].cumulative_exposure == sum(r.total_exposure for r in rows)
    assert rows[-1].cumulative_exposure_pct == 100.0


def test_risk_segments_always_has_two_rows(clean, make_loans):
    empty = business.risk_segments(clean.limit(0)).collect()
    assert {(r.segment, r.total_borrowers, r.avg_age, r.default_rate_pct) for r in empty} == {
        ("High Risk", 0, None, None),
        ("Low/Medium Risk", 0, None, None),
    }
    without_tier = clean.withColumn("risk_tier", clean.risk_tier.cast("string")).replace(
        "Low Risk", None, "risk_tier"
    )
    counts = {r.segment: r.total_borrowers for r in business.risk_segments(without_tier).collect()}
    assert counts == {"High Risk": 102, "Low/Medium Risk": 739}


def test_shares_of_nothing_are_no_rows(clean):
    assert business.grade_risk(clean.limit(0)).collect() == []
    assert dashboards.portfolio_kpis(marts.risk_tier_summary(clean.limit(0))).first()[0] is None


def test_dashboard_pages_follow_the_loans(clean):
    kpis = dashboards.portfolio_kpis(marts.risk_tier_summary(clean)).first()
    assert kpis.total_loans == clean.count()
    assert kpis.high_risk_rate_pct == round(100 * 102 / clean.count(), 2)
    page = dashboards.customer_segments(marts.borrower_demographics(clean)).collect()
    for section in ("borrower_age_group", "income_tier", "home_ownership"):
        assert sum(r.total_borrowers for r in page if r.section == section) == clean.count()
