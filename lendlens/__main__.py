"""Run the whole batch flow: ``python -m lendlens CSV_PATH BASE_DIR [--databases PREFIX] [--keep N]``.

With ``--databases`` the written tables are also registered as ``PREFIXraw``, ``PREFIXclean`` and
``PREFIXanalytics``, for SQL.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from lendlens.plans.marts import MARTS
from lendlens.plans.pipeline import REJECTS, quarantine, run_pipeline
from lendlens.plans.portfolio import tier_distribution
from lendlens.operators.verify import count_rows
from lendlens.sources.csv import read_loans_csv, rejected_records
from lendlens.sources.layers import LOANS, LayerStore


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(prog="lendlens", description=__doc__.split("\n")[0])
    parser.add_argument("csv", help="file or folder of loan applications with a header")
    parser.add_argument("base", help="folder for the raw, clean and analytics layers")
    parser.add_argument("--databases", metavar="PREFIX", help="also register the tables for SQL")
    parser.add_argument("--strict", action="store_true", help="stop at a value that does not parse")
    parser.add_argument("--keep", type=int, metavar="N", help="remove all but N versions of a table")
    args = parser.parse_args(argv)

    spark = spark or SparkSession.builder.appName("lendlens").getOrCreate()
    store = LayerStore(spark, args.base)
    raw = read_loans_csv(spark, args.csv, mode="FAILFAST" if args.strict else "PERMISSIVE")
    run_pipeline(raw, store)
    if not args.strict:
        quarantine(rejected_records(spark, args.csv), store)
    if args.keep:
        for layer, table in [("raw", LOANS), ("raw", REJECTS), ("clean", LOANS), *(("analytics", name) for name in MARTS)]:
            store.keep_versions(layer, table, args.keep)
    if args.databases is not None:
        store.create_namespaces(args.databases)
        tables = [("raw", LOANS), ("clean", LOANS), *(("analytics", name) for name in MARTS)]
        for layer, table in tables:
            store.register(layer, table, args.databases)
    count_rows(store.read("clean"), "clean row count").show()
    tier_distribution(store.read("raw")).show()


if __name__ == "__main__":
    main()
