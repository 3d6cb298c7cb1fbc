import math
import random

import pytest
from pyspark.sql import functions as F

from lendlens.functions.numeric import (
    bucketize,
    fold_nan,
    ratio,
    round_half_up,
    stable_round,
)
from lendlens.schema import AGE_GROUPS, DTI_BUCKETS, INCOME_TIERS, LOAN_SIZES, RISK_TIERS

BOUNDARIES = [
    (AGE_GROUPS, [(24, 0), (25, 1), (34, 1), (35, 2), (44, 2), (45, 3), (54, 3), (55, 4), (None, 4)]),
    (
        INCOME_TIERS,
        [(0, 0), (29_999, 0), (30_000, 1), (59_999, 1), (60_000, 2), (99_999, 2), (100_000, 3), (None, 3)],
    ),
    (
        LOAN_SIZES,
        [(4_999, 0), (5_000, 1), (14_999, 1), (15_000, 2), (24_999, 2), (25_000, 3), (None, 3)],
    ),
    (
        DTI_BUCKETS,
        [(9.99, 0), (10.0, 1), (19.99, 1), (20.0, 2), (34.99, 2), (35.0, 3), (49.99, 3), (50.0, 4), (None, 4)],
    ),
    (RISK_TIERS, [(30.0, 0), (30.1, 1), (30.5, 1), (55.0, 1), (55.1, 2), (75.0, 2), (75.1, 3), (None, 3)]),
]


@pytest.mark.parametrize("segments,cases", BOUNDARIES)
def test_bucketize_boundaries(spark, segments, cases):
    frame = spark.createDataFrame([(None if v is None else float(v),) for v, _ in cases], "x double")
    labels = [row[0] for row in frame.select(bucketize(F.col("x"), segments)).collect()]
    assert labels == [segments.labels[i] for _, i in cases]


def test_ratio_gives_null_for_zero(spark):
    row = spark.range(1).select(
        ratio(F.lit(3), F.lit(0)), ratio(F.lit(3), F.lit(2)), ratio(F.lit(None), F.lit(2))
    )
    assert tuple(row.first()) == (None, 1.5, None)


def test_stable_round_ties_and_lost_last_bits(spark):
    value = F.lit(8.245)
    a_bit_less = F.lit(math.nextafter(8.245, 0))
    row = spark.range(1).select(
        stable_round(value, 2), stable_round(a_bit_less, 2), stable_round(F.lit(-2.5), 0)
    )
    assert tuple(row.first()) == (8.25, 8.25, -3.0)


def test_fold_nan(spark):
    frame = spark.createDataFrame([(float("nan"), 1, "x"), (2.0, 2, None)], "d double, i int, s string")
    assert [tuple(r) for r in fold_nan(frame).orderBy("i").collect()] == [(None, 1, "x"), (2.0, 2, None)]
    assert fold_nan(frame).dtypes == frame.dtypes


def test_round_half_up_equals_round(spark):
    rng = random.Random(7)
    values = [0.0, -0.0, 0.5, -0.5, 2.5, 2.675, 8.245, 1.005, -1.005, 1e-9, 5e8, 1e9, 1e15, 4e300]
    values += [float("nan"), float("inf"), float("-inf"), None, 0.49999999999999994, -1e-3]
    for digits in (0, 1, 2, 4):
        ties = [(rng.randrange(-(10**8), 10**8) + 0.5) / 10**digits for _ in range(2000)]
        values += ties
        values += [math.nextafter(t, math.inf) for t in ties]
        values += [math.nextafter(t, -math.inf) for t in ties]
    values += [rng.uniform(-1e6, 1e6) for _ in range(5000)]
    values += [rng.uniform(-1, 1) * 10 ** rng.randrange(-12, 14) for _ in range(5000)]
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    for digits in (0, 1, 2, 4):
        ours, spark_round = round_half_up(F.col("x"), digits), F.round("x", digits)
        assert frame.filter(~ours.eqNullSafe(spark_round)).count() == 0
        assert frame.select(ours.cast("string").alias("s")).filter("s = '-0.0'").count() == 0
        assert frame.filter(spark_round.cast("string") == "-0.0").count() == 0
