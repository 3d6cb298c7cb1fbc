"""Aggregate measures shared by the marts, queries and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lendlens.functions.numeric import ratio, stable_round

RATE_SLICES = 1000


def loans(name: str = "total_loans") -> Column:
    return F.count("*").alias(name)


def total(column: str, name: str) -> Column:
    return F.sum(column).alias(name)


def mean(column: str, digits: int, name: str) -> Column:
    return stable_round(F.avg(column), digits).alias(name)


def rate_pct(flag: str = "default_flag", digits: int = 2, name: str = "default_rate_pct") -> Column:
    """Share of rows with the 0/1 flag set, in percent."""
    return stable_round(F.avg(flag) * 100, digits).alias(name)


def share_pct(part: Column, whole: Column, digits: int = 2) -> Column:
    return stable_round(ratio(part * F.lit(100.0), whole), digits)


def sum_of_result(column: str) -> Column:
    """The column's sum over all result rows, in one task: for results with a fixed number of groups."""
    return F.sum(column).over(Window.partitionBy())


def share_of_result(column: str, digits: int = 2) -> Column:
    """For results with a fixed number of groups, as ``sum_of_result``."""
    return share_pct(F.col(column), sum_of_result(column), digits)


def with_share(groups: DataFrame, column: str, name: str, digits: int = 2) -> DataFrame:
    """Each group's share of the column's sum, for any number of groups: no task holds them all.

    The sum is a scalar subquery over the same groups. It also asks for their greatest row, which needs
    every column, so that both plans have the same shuffle and Spark reads the input and shuffles once.
    """
    sides = F.struct(F.sum(column).alias("sum"), F.max(F.struct(*groups.columns)).alias("greatest"))
    whole = groups.agg(sides).scalar()["sum"]
    return groups.withColumn(name, share_pct(F.col(column), whole, digits))


def rank_desc(column: str) -> Column:
    """1 for the highest value, with gaps after ties; for results with a fixed number of groups."""
    return F.rank().over(Window.orderBy(F.col(column).desc()))


def with_rank(groups: DataFrame, rate: str, name: str) -> DataFrame:
    """``rank_desc`` by a rate from 0 to 1, for any number of groups; NULL rates come last, equal.

    Groups are counted per rate, so ties cost nothing. Rates are ranked within slices of equal
    width, each a window of its own; a slice starts after all groups of the slices above it.
    """
    share = F.least(F.greatest(F.col("_rate"), F.lit(0.0)), F.lit(1.0))
    per_rate = groups.groupBy(F.col(rate).alias("_rate")).agg(F.count("*").alias("_n"))
    per_rate = per_rate.withColumn("_slice", F.coalesce(F.floor(share * RATE_SLICES), F.lit(-1)))
    within = Window.partitionBy("_slice").orderBy(F.desc("_rate"))
    per_rate = per_rate.withColumn("_to", F.sum("_n").over(within))
    downwards = Window.orderBy(F.desc("_above"))
    above = per_rate.groupBy(F.col("_slice").alias("_above")).agg(F.sum("_n").alias("_all"))
    # At most RATE_SLICES + 2 rows, in one task and on the broadcast side.
    above = above.select("_above", (F.sum("_all").over(downwards) - F.col("_all")).alias("_skipped"))
    ranks = per_rate.join(F.broadcast(above), F.col("_slice") == F.col("_above")).select(
        "_rate", (F.col("_skipped") + F.col("_to") - F.col("_n") + 1).cast("int").alias(name)
    )
    return groups.join(ranks, F.col(rate).eqNullSafe(F.col("_rate"))).drop("_rate")
