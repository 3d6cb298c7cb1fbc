import numpy as np
import pytest

from lendlens.operators.histograms import histogram, histogram_by_class
from lendlens.plans import portfolio


def assert_same(rows, values, bins):
    counts, edges = np.histogram(np.array(values, dtype=float), bins=bins)
    assert [r.rows for r in rows] == counts.tolist()
    assert [r.bin_lo for r in rows] == edges[:-1].tolist()
    assert [r.bin_hi for r in rows] == edges[1:].tolist()


@pytest.mark.parametrize("column,bins", [("loan_amnt", 40), ("person_age", 30), ("loan_int_rate", 30)])
def test_equals_numpy(raw, column, bins):
    values = [r[0] for r in raw.select(column).collect() if r[0] is not None]
    assert_same(histogram(raw, column, bins).collect(), values, bins)


@pytest.mark.parametrize("seed", range(3))
def test_values_on_and_next_to_edges(spark, seed):
    rng = np.random.default_rng(seed)
    edges = np.linspace(0.1, 0.7, 22)
    values = np.concatenate([edges, np.nextafter(edges[1:-1], 0), np.nextafter(edges[1:-1], 1)])
    values = np.concatenate([values, np.round(rng.uniform(0.1, 0.7, 500), 2)])
    frame = spark.createDataFrame([(float(v),) for v in values], "x double")
    assert_same(histogram(frame, "x", 21).collect(), values, 21)


@pytest.mark.parametrize("values", [[7.0, 7.0, 7.0], [], [None, 3.0, 5.0]])
def test_constant_empty_and_null(spark, values):
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    present = [v for v in values if v is not None]
    assert_same(histogram(frame, "x", 5).collect(), present, 5)


def test_each_class_has_its_own_bounds(spark):
    rows = [(0, 1.0), (0, 3.0), (0, 2.0), (1, 100.0), (1, 200.0), (None, 9.0), (2, 9.0), (1, None)]
    frame = spark.createDataFrame(rows, "c int, x double")
    result = histogram_by_class(frame, "x", 4, "c", [0, 1]).collect()
    for value in (0, 1):
        assert_same(
            [r for r in result if r.c == value],
            [x for c, x in rows if c == value and x is not None],
            4,
        )
    assert len(result) == 8


def test_bins_add_up_to_the_non_null_rows(raw):
    total = sum(r.rows for r in portfolio.rate_histogram_by_status(raw).collect())
    assert total == raw.filter("loan_int_rate IS NOT NULL").count()
