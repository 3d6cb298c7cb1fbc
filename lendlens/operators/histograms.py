"""Equal-width histograms, over a whole column or separately per class."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def histogram(
    df: DataFrame, column: str, bins: int, bounds: tuple | None = None
) -> DataFrame:
    """(bin, bin_lo, bin_hi, rows) for every bin, empty ones included; NULLs are left out."""
    one_class = df.withColumn("_all", F.lit(0))
    known = None if bounds is None else {0: bounds}
    return histogram_by_class(one_class, column, bins, "_all", [0], known).drop("_all")


def histogram_by_class(
    df: DataFrame,
    column: str,
    bins: int,
    class_column: str,
    classes: list[int],
    bounds: dict[int, tuple] | None = None,
) -> DataFrame:
    """A histogram per listed class value, each between the class's own minimum and maximum.

    With ``bounds``, the least and greatest value of each class as ``LayerStore.bounds`` has them from
    file footers, there is one column-pruned scan: a count per bin. Without, a first scan finds the bounds, which
    the count reads as a scalar subquery. No row-level join or shuffle, for any data size.
    """
    values = df.select(
        F.col(class_column).alias("class"), F.col(column).cast("double").alias("x")
    ).filter(F.col("x").isNotNull() & F.col("class").isin(*classes))
    if bounds is None:
        by_class = [part for value in classes for part in (F.lit(value), _class_bounds(value))]
        ranges = values.agg(F.create_map(*by_class)).scalar()
    else:
        by_class = [part for value in classes for part in (F.lit(value), _known_bounds(bounds.get(value)))]
        ranges = F.create_map(*by_class)
    counts = (
        values.withColumn("bounds", F.element_at(ranges, F.col("class")))
        .select("class", "x", "bounds.*")
        .withColumn("near", _nearest_bin(bins))
        .groupBy("class", _exact_bin(bins).alias("bin"))
        .agg(F.count("*").alias("rows"))
    )
    # One row with at most bins x classes counts; its bins are then laid out in order.
    pairs = F.collect_list(F.struct(F.struct("class", "bin"), "rows"))
    found = counts.agg(F.map_from_entries(pairs).alias("counts"))
    at = F.struct("class", "bin")
    return (
        found.select(F.explode(F.array(*map(F.lit, classes))).alias("class"), "counts")
        .select("class", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "counts")
        .select("class", "bin", F.coalesce(F.try_element_at("counts", at), F.lit(0)).alias("rows"))
        .withColumn("bounds", F.element_at(ranges, F.col("class")))
        .select("class", "bin", "rows", "bounds.*")
        .select(
            F.col("class").alias(class_column),
            "bin",
            _edge(F.col("bin"), bins).alias("bin_lo"),
            _edge(F.col("bin") + 1, bins).alias("bin_hi"),
            "rows",
        )
        .orderBy(class_column, "bin")
    )


def _known_bounds(bounds: tuple | None) -> Column:
    lo, hi = bounds or (None, None)
    if lo is None:
        lo, hi = 0.0, 1.0
    half = 0.5 if lo == hi else 0.0
    return F.struct(F.lit(float(lo - half)).alias("lo"), F.lit(float(hi + half)).alias("hi"))


def _class_bounds(value: int) -> Column:
    """(lo, hi) of a class: a constant gets half a unit either side, no rows get (0, 1)."""
    x = F.when(F.col("class") == value, F.col("x"))
    half = F.when(F.min(x) == F.max(x), 0.5).otherwise(0.0)
    return F.struct(
        F.coalesce(F.min(x) - half, F.lit(0.0)).alias("lo"),
        F.coalesce(F.max(x) + half, F.lit(1.0)).alias("hi"),
    )


def _edge(index: Column, bins: int) -> Column:
    """Left edge of a bin; the last edge is the upper bound itself."""
    width = (F.col("hi") - F.col("lo")) / bins
    return F.when(index == bins, F.col("hi")).otherwise(index * width + F.col("lo"))


def _nearest_bin(bins: int) -> Column:
    position = F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins)
    return F.least(position, F.lit(bins - 1)).cast("int")


def _exact_bin(bins: int) -> Column:
    """The bin whose edges hold the value: division may land one bin off next to an edge."""
    near, x = F.col("near"), F.col("x")
    return (
        F.when(x < _edge(near, bins), near - 1)
        .when((near < bins - 1) & (x >= _edge(near + 1, bins)), near + 1)
        .otherwise(near)
    )
