"""Multiset difference that stays spread out when one row has very many copies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COPIES_PER_TASK_ROW = 100_000


def bag_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` minus those of ``right``, counting copies; NULL equals NULL.

    ``exceptAll`` gives the same rows but re-creates all copies of a row in one task. Here the
    copies to re-create are cut into chunks first, and the chunks are spread over tasks.
    """
    names = left.columns
    weighted = left.withColumn("_w", F.lit(1)).unionByName(
        right.select(*names).withColumn("_w", F.lit(-1))
    )
    per_chunk = F.lit(COPIES_PER_TASK_ROW)
    surplus = weighted.groupBy(*names).agg(F.sum("_w").alias("_n")).filter(F.col("_n") > 0)
    last_chunk = F.floor((F.col("_n") - 1) / per_chunk)
    chunks = surplus.withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0).cast("long"), last_chunk))
    ).withColumn("_take", F.least(per_chunk, F.col("_n") - F.col("_chunk") * per_chunk))
    # With a number, AQE does not merge the chunks, whose rows are few and small.
    width = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = chunks.repartition(width, *names, "_chunk")
    return spread.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_take")))).select(
        *names
    )
