"""Loan applications from CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendlens.functions.numeric import fold_nan
from lendlens.schema import NULL_TOKEN, RAW_COLUMNS, RAW_SCHEMA

RECORD = "_corrupt_record"


def _reader(spark: SparkSession):
    return spark.read.option("header", True).option("nullValue", NULL_TOKEN)


def _header(spark: SparkSession, path: str | list[str]) -> list[str]:
    header = _reader(spark).csv(path).columns
    missing = sorted(set(RAW_COLUMNS) - set(header))
    if missing:
        raise ValueError(f"columns missing from the CSV header: {', '.join(missing)}")
    return header


def _typed(header: list[str]) -> T.StructType:
    return T.StructType(
        [
            RAW_SCHEMA[name] if name in RAW_COLUMNS else T.StructField(name, T.StringType())
            for name in header
        ]
    )


def read_loans_csv(spark: SparkSession, path: str | list[str], mode: str = "PERMISSIVE") -> DataFrame:
    """Read CSV with a header; ``NA`` and empty fields are NULL, and so is NaN.

    Types are declared, so there is no inference pass over the data. Columns are found by their
    header name, in whatever order the files have them; every file must have the same header.
    A value that does not parse is NULL, or an error with ``mode="FAILFAST"``; ``rejected_records``
    has the records of the former.
    """
    schema = _typed(_header(spark, path))
    reader = _reader(spark).schema(schema).option("enforceSchema", False).option("mode", mode)
    return fold_nan(reader.csv(path).select(*[F.col(name) for name in RAW_COLUMNS]))


def rejected_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file, record, rejected``: records with a value that does not parse, or a wrong number of fields.

    ``rejected`` lists the columns that ``read_loans_csv`` makes NULL, in the order of RAW; ``NA``, empty
    fields and NaN are missing, not rejected. One scan: the parser itself sets bad records aside as they
    stand in the file, and only these are cut again, to tell a value that was lost from a missing one.
    """
    header = _header(spark, path)
    schema = T.StructType([*_typed(header), T.StructField(RECORD, T.StringType())])
    reader = _reader(spark).schema(schema).option("enforceSchema", False).option("columnPruning", False)
    records = reader.option("columnNameOfCorruptRecord", RECORD).csv(path)
    bad = records.filter(F.col(RECORD).isNotNull())
    as_text = ", ".join(f"`{name}` string" for name in header)
    fields = F.from_csv(F.col(RECORD), as_text, {"nullValue": NULL_TOKEN})
    bad = bad.select(*RAW_COLUMNS, RECORD, F.col("_metadata.file_path").alias("file"), fields.alias("fields"))
    lost = [
        F.when(F.col("fields")[name].isNotNull() & F.col(name).isNull(), F.lit(name)) for name in RAW_COLUMNS
    ]
    return bad.select("file", F.col(RECORD).alias("record"), F.array_compact(F.array(*lost)).alias("rejected"))


def rejected_values(rejects: DataFrame) -> DataFrame:
    """(column_name, rejected) for every RAW column, from the records of ``rejected_records``."""
    counts = [F.count_if(F.array_contains("rejected", name)).alias(name) for name in RAW_COLUMNS]
    names = [F.struct(F.lit(n).alias("column_name"), F.col(n).alias("rejected")) for n in RAW_COLUMNS]
    return rejects.agg(*counts).select(F.inline(F.array(*names)))


def write_loans_csv(raw: DataFrame, path: str) -> None:
    """Write loans in the form ``read_loans_csv`` reads."""
    raw.select(*RAW_COLUMNS).write.mode("overwrite").option("header", True).option(
        "nullValue", NULL_TOKEN
    ).csv(path)
