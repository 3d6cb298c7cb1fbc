"""Every registered query against its independent SQL statement."""

import pytest

import __spark_entry__ as registered
from harness import compare
from tests.conftest import SF_DIR

STATEMENTS = registered.oracle_sql()
OPTIONAL = registered._llm_queries() if registered.llm_queries else {}  # tested in tests/llm
QUERIES = {name: q for name, q in registered.queries().items() if name not in OPTIONAL}


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


ESTIMATES = {"approximate_profile"}  # compared with the exact profile in test_profiling.py


def test_every_query_has_a_statement():
    assert set(QUERIES) - ESTIMATES == set(STATEMENTS) - set(OPTIONAL)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - ESTIMATES))
def test_query_equals_statement(spark, duck, name):
    assert compare.differences(duck, QUERIES[name](spark, SF_DIR), STATEMENTS[name]) == []


@pytest.mark.parametrize("name", compare.ORDERS)
def test_query_keeps_its_order(spark, name):
    rows = QUERIES[name](spark, SF_DIR).collect()
    assert len(rows) > 1 and compare.out_of_order(rows, compare.ORDERS[name]) == []


def test_wrong_order_is_seen():
    rows = [{"a": None}, {"a": 2}, {"a": 2}, {"a": 1}]
    assert compare.out_of_order(rows, [("a", True, True)]) == []
    assert len(compare.out_of_order(rows, [("a", True, False)])) == 1
    assert len(compare.out_of_order(rows, [("a", False, True)])) == 1


def test_entry(spark):
    rows = registered.entry(spark).collect()
    assert [r.risk_tier for r in rows][0] == "Critical Risk"
    assert sum(r.total_loans for r in rows) == 1342
