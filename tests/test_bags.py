from collections import Counter

import pytest

from lendlens.operators import bags


def as_bag(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("chunk", [1, 2, 3, 100_000])
def test_equals_except_all(spark, monkeypatch, chunk):
    monkeypatch.setattr(bags, "COPIES_PER_TASK_ROW", chunk)
    left = spark.createDataFrame(
        [(1, "a")] * 7 + [(2, None)] * 4 + [(None, "c")] * 2 + [(4, "d")], "x int, y string"
    )
    right = spark.createDataFrame([(1, "a")] * 2 + [(2, None)] * 4 + [(9, "z")], "x int, y string")
    assert as_bag(bags.bag_difference(left, right)) == as_bag(left.exceptAll(right))


def test_copies_of_one_row_are_spread(spark, monkeypatch):
    monkeypatch.setattr(bags, "COPIES_PER_TASK_ROW", 1000)
    hot = spark.range(100_000).selectExpr("1 AS x", "'hot' AS y")
    rest = bags.bag_difference(hot, hot.limit(10))
    sizes = rest.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(sizes) == 99_990
    assert max(sizes) < 80_000
