"""Column builders for numbers: zero-safe ratios, stable rounding, bucketing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendlens.schema import Segments


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives NULL, not an error, for a zero denominator."""
    return F.try_divide(numerator, denominator)


def round_half_up(value: Column, digits: int) -> Column:
    """``F.round`` for a double column, several times faster, with the same result for every value.

    ``F.round`` goes through a decimal object per value, which dominates the cost of scoring. Away
    from a tie and below 1e9 (after scaling) plain arithmetic is certain to pick the same
    neighbour: scaling errors stay under 1e-6. Everything else, NaN and NULL too, takes ``F.round``.
    """
    scale = 10.0**digits
    scaled = value * F.lit(scale)
    from_tie = F.abs(scaled - F.floor(scaled) - F.lit(0.5))
    certain = (F.abs(scaled) < 1e9) & (from_tie > 1e-6)
    return F.when(certain, F.floor(scaled + 0.5) / F.lit(scale)).otherwise(F.round(value, digits))


def stable_round(value: Column, digits: int) -> Column:
    """Round an aggregate half up, independent of the order its doubles were summed in.

    Summation order moves the last bits of an average; going through a 12-digit decimal drops
    those bits, so a tie such as 8.245 always rounds the same way.
    """
    return F.round(value.cast("decimal(30,12)"), digits).cast("double")


def bucketize(value: Column, segments: Segments) -> Column:
    """Label of the segment a value falls in; NULL falls in the last one."""
    chain = F
    for cut, label in zip(segments.cuts, segments.labels):
        below = value <= cut if segments.upper_inclusive else value < cut
        chain = chain.when(below, label)
    return chain.otherwise(segments.labels[-1])


def fold_nan(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every floating-point column, so that both count as missing."""
    floating = (T.DoubleType, T.FloatType)
    return df.select(
        *[
            F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name)
            if isinstance(f.dataType, floating)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
