"""Column quality and schema reports over any frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendlens.functions.numeric import ratio, stable_round
from lendlens.schema import NULL_ALERT_PCT, QUALITY_LABELS
from lendlens.sources.constants import literal_rows

SKETCH_BITS = 14
SKETCHES = "position int, total long, nulls long, sketch binary"
LANES = {"whole": "bigint", "number": "double", "text": "string"}


def _column_list(df: DataFrame) -> DataFrame:
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return literal_rows(df.sparkSession, "position int, column_name string, type string", rows)


def _cells(df: DataFrame) -> DataFrame:
    """One row per cell: the column's position, and the value in the lane of its type."""
    cells = []
    for position, field in enumerate(df.schema.fields):
        kind = "string"
        if isinstance(field.dataType, T.IntegralType):
            kind = "bigint"
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            kind = "double"
        lanes = [
            (F.col(field.name) if lane_kind == kind else F.lit(None)).cast(lane_kind).alias(lane)
            for lane, lane_kind in LANES.items()
        ]
        cells.append(F.struct(F.lit(position).alias("position"), *lanes))
    return df.select(F.inline(F.array(*cells)))


def quality_profile(df: DataFrame) -> DataFrame:
    """Per column: type, NULL count and share, distinct values (NULL is one), status.

    One scan for all columns. Cells are counted per (column, value); the count combines within
    each map task, so only distinct values are shuffled, however often one of them repeats. Both
    the NULL count and the distinct count follow from the counted values.
    """
    is_null = F.lit(True)
    for lane in LANES:
        is_null = is_null & F.col(lane).isNull()
    per_column = (
        _cells(df)
        .groupBy("position", *LANES)
        .agg(F.count("*").alias("n"))
        .groupBy("position")
        .agg(
            F.sum("n").alias("total"),
            F.sum(F.when(is_null, F.col("n")).otherwise(0)).alias("nulls"),
            F.count("*").alias("distinct_values"),
        )
    )
    return _with_status(df, per_column)


def column_sketches(df: DataFrame) -> DataFrame:
    """``SKETCHES``: per column the rows, the NULLs and a mergeable sketch of its distinct values.

    One aggregate of one row per task; no distinct value is shuffled. A sketch has a few kilobytes at
    most. Values are sketched by their text, numbers with one zero.
    """
    cells = []
    for position, field in enumerate(df.schema.fields):
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            value = value + F.lit(0.0)  # -0.0 is 0.0
        cells.append(
            F.struct(
                F.lit(position).alias("position"),
                F.count("*").alias("total"),
                F.count_if(value.isNull()).alias("nulls"),
                F.hll_sketch_agg(value.cast("string"), F.lit(SKETCH_BITS)).alias("sketch"),
            )
        )
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def merge_sketches(sketches: DataFrame) -> DataFrame:
    """One row per column from the sketches of several parts or versions of a table."""
    return sketches.groupBy("position").agg(
        F.sum("total").alias("total"),
        F.sum("nulls").alias("nulls"),
        F.hll_union_agg("sketch").alias("sketch"),
    )


def sketched_profile(df: DataFrame, sketches: DataFrame) -> DataFrame:
    """``quality_profile`` of what was sketched, without its rows: distinct values are estimates.

    ``df`` gives names and types only. The estimate's standard error is 1.04 / sqrt(2**SKETCH_BITS),
    0.8 percent; NULL counts and shares are exact.
    """
    some_null = F.when(F.col("nulls") > 0, 1).otherwise(0)
    known = F.hll_sketch_estimate("sketch")
    return _with_status(
        df, sketches.select("position", "total", "nulls", (known + some_null).alias("distinct_values"))
    )


def approximate_profile(df: DataFrame) -> DataFrame:
    """``quality_profile`` with estimated distinct values; NULL counts and shares stay exact."""
    return sketched_profile(df, column_sketches(df))


def _with_status(df: DataFrame, per_column: DataFrame) -> DataFrame:
    null_pct = stable_round(ratio(F.col("nulls"), F.col("total")) * 100, 2)
    good, alert = QUALITY_LABELS
    # The broadcast side has one row per column; the list keeps columns of an empty frame.
    return (
        _column_list(df)
        .join(F.broadcast(per_column), "position", "left")
        .select(
            "position",
            "column_name",
            "type",
            F.coalesce("nulls", F.lit(0)).alias("null_count"),
            null_pct.alias("null_pct"),
            F.coalesce("distinct_values", F.lit(0)).alias("distinct_values"),
            F.when(null_pct > NULL_ALERT_PCT, alert).otherwise(good).alias("status"),
        )
        .orderBy("position")
    )


def quality_summary(profile: DataFrame) -> DataFrame:
    return profile.agg(
        F.count("*").alias("columns_assessed"),
        F.count_if(F.col("null_pct") > NULL_ALERT_PCT).alias("columns_needing_cleanup"),
    )


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column with its type, and the frame's row and column counts."""
    counted = df.agg(F.count("*").alias("row_count"))
    return _column_list(df).select(
        "*",
        counted.scalar().alias("row_count"),
        F.lit(len(df.columns)).alias("column_count"),
    )
