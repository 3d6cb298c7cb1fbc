"""Compare every registered query with its DuckDB statement, cell by cell."""

from __future__ import annotations

import datetime
import decimal
import math
import os

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = os.path.join(sf_dir, f"{table}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, int):
        return ("int", value)
    if isinstance(value, float):
        return ("float", "nan" if math.isnan(value) else value + 0.0)
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, datetime.datetime):
        return ("time", value.isoformat())
    return (type(value).__name__, value)


def _bag(columns: list[str], rows: list[tuple]) -> list:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(_cell(row[i]) for i in order) for row in rows), key=repr)


def differences(con: duckdb.DuckDBPyConnection, result: DataFrame, sql: str) -> list[str]:
    """Empty if names, row count, value types and values agree."""
    cursor = con.execute(sql)
    names = [column[0] for column in cursor.description]
    if sorted(names) != sorted(result.columns):
        return [f"columns {sorted(result.columns)} expected {sorted(names)}"]
    ours = _bag(result.columns, [tuple(row) for row in result.collect()])
    theirs = _bag(names, cursor.fetchall())
    found = [] if len(ours) == len(theirs) else [f"rows {len(ours)} expected {len(theirs)}"]
    found += [f"{a} expected {b}" for a, b in zip(ours, theirs) if a != b][:3]
    return found


#: query -> its sort keys: (column, descending, NULLs first)
ORDERS = {
    "quality_profile": [("position", False, True)],
    "status_distribution": [("count", True, False)],
    "loan_amount_histogram": [("bin", False, True)],
    "age_histogram": [("bin", False, True)],
    "rate_histogram_by_status": [("loan_status", False, True), ("bin", False, True)],
    "stored_amount_histogram": [("bin", False, True)],
    "stored_rate_histogram": [("loan_status", False, True), ("bin", False, True)],
    "tier_distribution": [("avg_score", False, True)],
    "tier_summary": [("avg_risk_score", False, True)],
    "tier_shares": [("count", True, False)],
    "verify_tiers": [("total", True, False)],
    "mart_risk_tier_summary": [("avg_risk_score", True, True)],
    "mart_loan_purpose": [("default_rate_pct", True, True)],
    "mart_demographics": [("default_rate_pct", True, True)],
    "mart_credit_analysis": [("avg_risk_score", True, True)],
    "q01_default_by_tier": [("default_rate_pct", True, True)],
    "q02_default_by_purpose": [("default_rate_pct", True, True)],
    "q03_income_tier": [("default_rate_pct", True, True)],
    "q04_grade_risk": [("avg_risk_score", True, True)],
    "q06_prior_default": [("prior_default_on_file", False, False), ("default_rate_pct", True, True)],
    "q07_dti_buckets": [("dti_bucket", False, True)],
    "q08_cumulative_exposure": [("risk_score_band", True, False)],
    "q09_age_groups": [("default_rate_pct", True, True)],
}


def out_of_order(rows: list, keys: list[tuple[str, bool, bool]]) -> list[str]:
    """Neighbouring rows that the sort keys forbid; equal keys may come in any order."""

    def before(one, other) -> bool:
        for column, descending, nulls_first in keys:
            a, b = one[column], other[column]
            if a == b:
                continue
            if a is None or b is None:
                return (a is None) == nulls_first
            return (a > b) == descending
        return True

    return [f"{a} before {b}" for a, b in zip(rows, rows[1:]) if not before(a, b)]
