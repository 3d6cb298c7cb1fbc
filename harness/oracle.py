"""DuckDB statements that compute each registered query independently of the Spark code."""

from __future__ import annotations

RAW_COLUMNS = [
    "person_age",
    "person_income",
    "person_home_ownership",
    "person_emp_length",
    "loan_intent",
    "loan_grade",
    "loan_amnt",
    "loan_int_rate",
    "loan_status",
    "loan_percent_income",
    "cb_person_default_on_file",
    "cb_person_cred_hist_length",
]

RAW_CTES = """
keyed AS (
  SELECT o_orderkey AS k, o_custkey AS c, o_totalprice AS p, c_acctbal AS b,
         CASE WHEN o_custkey * 13 % 100 < 33 THEN 0 WHEN o_custkey * 13 % 100 < 65 THEN 1
              WHEN o_custkey * 13 % 100 < 85 THEN 2 WHEN o_custkey * 13 % 100 < 96 THEN 3
              WHEN o_custkey * 13 % 100 < 98 THEN 4 WHEN o_custkey * 13 % 100 < 99 THEN 5
              ELSE 6 END AS g
  FROM orders JOIN customer ON o_custkey = c_custkey
), sized AS (
  SELECT *,
         CAST(CASE WHEN k % 1499 = 7 THEN 6000000 WHEN k % 1999 = 3 THEN 0
              WHEN k % 401 = 2 THEN NULL
              ELSE 4000 + CAST(floor((b + 1000) * 13) AS BIGINT) END AS BIGINT) AS person_income,
         CAST(CASE WHEN k % 1201 = 5 THEN 0
              ELSE (CAST(floor(p / 360) AS BIGINT) + 20) * 25 END AS INTEGER) AS loan_amnt
  FROM keyed
), single AS (
  SELECT k,
         CAST(CASE WHEN k % 997 = 0 THEN 123 ELSE 18 + (7 * k + c) % 60 END AS INTEGER)
           AS person_age,
         person_income,
         CASE c % 4 WHEN 0 THEN 'RENT' WHEN 1 THEN 'mortgage' WHEN 2 THEN 'Own' ELSE 'OTHER' END
           AS person_home_ownership,
         CASE WHEN k % 37 = 0 THEN NULL ELSE CAST(5 * k % 31 AS DOUBLE) END AS person_emp_length,
         CASE k % 6 WHEN 0 THEN 'PERSONAL' WHEN 1 THEN 'EDUCATION' WHEN 2 THEN 'MEDICAL'
              WHEN 3 THEN 'VENTURE' WHEN 4 THEN 'HOMEIMPROVEMENT' ELSE 'DEBTCONSOLIDATION' END
           AS loan_intent,
         CASE g WHEN 0 THEN 'A' WHEN 1 THEN 'b' WHEN 2 THEN 'C' WHEN 3 THEN 'D' WHEN 4 THEN 'E'
              WHEN 5 THEN 'F' ELSE 'G' END AS loan_grade,
         loan_amnt,
         CASE WHEN k % 10 = 3 THEN NULL
              ELSE CAST(540 + 250 * g + 37 * k % 250 AS DOUBLE) / CAST(100 AS DOUBLE) END
           AS loan_int_rate,
         CAST(CASE WHEN (31 * k + 17 * g) % 100 < 8 + 9 * g THEN 1 ELSE 0 END AS INTEGER)
           AS loan_status,
         CASE WHEN person_income > 0
              THEN round(CAST(loan_amnt AS DOUBLE) / CAST(person_income AS DOUBLE), 2) END
           AS loan_percent_income,
         CASE WHEN k % 211 = 4 THEN NULL WHEN (k + g) % 5 = 0 THEN 'Y'
              WHEN (k + g) % 5 = 1 THEN 'n' ELSE 'N' END AS cb_person_default_on_file,
         CASE WHEN k % 307 = 9 THEN NULL ELSE CAST(2 + 3 * k % 13 AS INTEGER) END
           AS cb_person_cred_hist_length
  FROM sized
), raw AS (
  SELECT * EXCLUDE (k) FROM single
  UNION ALL
  SELECT * EXCLUDE (k) FROM single WHERE k % 50 = 11
)"""

CLEANING_CTES = """
deduped AS (SELECT DISTINCT * FROM raw),
complete AS (
  SELECT * FROM deduped
  WHERE loan_amnt IS NOT NULL AND loan_int_rate IS NOT NULL AND loan_status IS NOT NULL
    AND person_age IS NOT NULL AND person_income IS NOT NULL
), plausible AS (
  SELECT * FROM complete
  WHERE person_age <= 100 AND person_income <= 3000000 AND loan_amnt > 0
), tidy AS (
  SELECT * REPLACE (
    upper(left(loan_intent, 1)) || lower(substr(loan_intent, 2)) AS loan_intent,
    upper(loan_grade) AS loan_grade,
    upper(person_home_ownership) AS person_home_ownership)
  FROM plausible
)"""

SCORING_CTES = """
featured AS (
  SELECT *,
    round((CAST(loan_amnt AS DOUBLE) / 12e0) / nullif(CAST(person_income AS DOUBLE) / 12e0, 0e0)
          * 100e0, 2) AS debt_to_income_ratio,
    round(CAST(loan_amnt AS DOUBLE) / nullif(CAST(person_income AS DOUBLE), 0e0), 4)
      AS loan_to_income_ratio,
    round((CAST(loan_amnt AS DOUBLE) * loan_int_rate / 100e0)
          / nullif(CAST(person_income AS DOUBLE), 0e0) * 100e0, 2) AS annual_interest_burden,
    CASE WHEN person_age < 25 THEN 'Gen Z (<25)' WHEN person_age < 35 THEN 'Young Adult (25-34)'
         WHEN person_age < 45 THEN 'Mid Career (35-44)'
         WHEN person_age < 55 THEN 'Experienced (45-54)' ELSE 'Senior (55+)' END AS age_group,
    CASE WHEN person_income < 30000 THEN 'Low (<$30K)'
         WHEN person_income < 60000 THEN 'Medium ($30K-$60K)'
         WHEN person_income < 100000 THEN 'High ($60K-$100K)'
         ELSE 'Very High (>$100K)' END AS income_tier,
    CASE WHEN loan_amnt < 5000 THEN 'Small (<$5K)' WHEN loan_amnt < 15000 THEN 'Medium ($5K-$15K)'
         WHEN loan_amnt < 25000 THEN 'Large ($15K-$25K)' ELSE 'Very Large (>$25K)' END
      AS loan_size_category
  FROM tidy
), pointed AS (
  SELECT *,
    CAST(CASE loan_grade WHEN 'A' THEN 5 WHEN 'B' THEN 15 WHEN 'C' THEN 30 WHEN 'D' THEN 50
         WHEN 'E' THEN 70 WHEN 'F' THEN 85 ELSE 100 END AS DOUBLE) AS grade_points,
    least(100e0, round(loan_int_rate / 25e0 * 100e0, 0)) AS rate_points,
    least(100e0, round(debt_to_income_ratio * 2e0, 0)) AS dti_points,
    greatest(0e0, CAST(100 - cb_person_cred_hist_length * 10 AS DOUBLE)) AS history_points
  FROM featured
), totalled AS (
  SELECT * EXCLUDE (grade_points, rate_points, dti_points, history_points),
    round(grade_points * 0.35e0 + rate_points * 0.25e0 + dti_points * 0.25e0
          + history_points * 0.15e0, 1) AS risk_score
  FROM pointed
), scored AS (
  SELECT *,
    CASE WHEN risk_score <= 30 THEN 'Low Risk' WHEN risk_score <= 55 THEN 'Medium Risk'
         WHEN risk_score <= 75 THEN 'High Risk' ELSE 'Critical Risk' END AS risk_tier
  FROM totalled
)"""

CLEAN_CTES = """
clean AS (
  SELECT person_age AS borrower_age, age_group AS borrower_age_group,
    upper(person_home_ownership) AS home_ownership, person_income AS annual_income, income_tier,
    person_emp_length AS employment_years, loan_amnt AS loan_amount, loan_size_category,
    round(loan_int_rate, 2) AS interest_rate, loan_intent AS loan_purpose, loan_grade,
    round(loan_percent_income, 4) AS loan_percent_income, debt_to_income_ratio,
    loan_to_income_ratio, annual_interest_burden,
    cb_person_cred_hist_length AS credit_history_years,
    upper(cb_person_default_on_file) AS prior_default_on_file, risk_score, risk_tier,
    CASE WHEN loan_status = 1 THEN 'Defaulted' ELSE 'Non-Default' END AS loan_outcome,
    loan_status AS default_flag
  FROM scored
  WHERE loan_amnt > 0 AND person_income > 0 AND person_age BETWEEN 18 AND 100
)"""

STAGES = [RAW_CTES, CLEANING_CTES, SCORING_CTES, CLEAN_CTES]
LEVEL = {"raw": 1, "cleaning": 2, "scored": 3, "clean": 4}


def statement(level: str, body: str, *extra_ctes: str) -> str:
    """A query over the relations of the given stage (and the stages before it)."""
    return "WITH" + ",".join([*STAGES[: LEVEL[level]], *extra_ctes]) + "\n" + body


def rounded(value: str, digits: int, name: str) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(30,12)), {digits}) AS DOUBLE) AS {name}"


def avg(column: str, digits: int, name: str) -> str:
    return rounded(f"avg({column})", digits, name)


def rate(flag: str = "default_flag", digits: int = 2, name: str = "default_rate_pct") -> str:
    return rounded(f"avg({flag}) * 100e0", digits, name)


def total(column: str, name: str) -> str:
    return f"CAST(sum({column}) AS BIGINT) AS {name}"


def share(part: str, whole: str, digits: int, name: str) -> str:
    quotient = f"CAST({part} AS DOUBLE) * 100e0 / CAST({whole} AS DOUBLE)"
    return rounded(quotient, digits, name)


def rank(name: str, over: str = "ORDER BY avg(default_flag) DESC") -> str:
    return f"CAST(rank() OVER ({over}) AS INTEGER) AS {name}"


N = "count(*) AS total_loans"
DEFAULTS = total("default_flag", "total_defaults")


def grouped(level: str, table: str, keys: str, *measures: str) -> str:
    columns = ", ".join([keys, *measures])
    return statement(level, f"SELECT {columns} FROM {table} GROUP BY {keys}")


MART_SQL = {
    "risk_tier_summary": (
        "risk_tier, loan_grade",
        N,
        DEFAULTS,
        rate(),
        avg("loan_amount", 2, "avg_loan_amount"),
        avg("interest_rate", 2, "avg_interest_rate"),
        avg("risk_score", 1, "avg_risk_score"),
        avg("annual_income", 2, "avg_borrower_income"),
        avg("debt_to_income_ratio", 2, "avg_dti_ratio"),
        total("loan_amount", "total_loan_exposure"),
        share("sum(loan_amount)", "sum(sum(loan_amount)) OVER ()", 2, "exposure_share_pct"),
    ),
    "loan_purpose_analysis": (
        "loan_purpose, loan_grade",
        N,
        rate(),
        avg("loan_amount", 2, "avg_loan_amount"),
        total("loan_amount", "total_exposure"),
        avg("interest_rate", 2, "avg_interest_rate"),
        avg("risk_score", 1, "avg_risk_score"),
        DEFAULTS,
        rank("default_risk_rank"),
    ),
    "borrower_demographics": (
        "borrower_age_group, home_ownership, income_tier, risk_tier",
        "count(*) AS total_borrowers",
        rate(),
        avg("annual_income", 2, "avg_income"),
        avg("loan_amount", 2, "avg_loan_amount"),
        avg("risk_score", 1, "avg_risk_score"),
        avg("employment_years", 1, "avg_employment_years"),
        avg("credit_history_years", 1, "avg_credit_history"),
        DEFAULTS,
    ),
    "credit_analysis": (
        "risk_tier, prior_default_on_file, loan_size_category",
        N,
        rate(),
        avg("risk_score", 1, "avg_risk_score"),
        rounded("min(risk_score)", 1, "min_risk_score"),
        rounded("max(risk_score)", 1, "max_risk_score"),
        avg("credit_history_years", 1, "avg_credit_history"),
        avg("debt_to_income_ratio", 2, "avg_dti"),
        avg("annual_interest_burden", 2, "avg_interest_burden"),
        avg("loan_amount", 2, "avg_loan_amount"),
        share("count(*)", "sum(count(*)) OVER ()", 2, "pct_of_portfolio"),
    ),
}
DTI_CASE = """CASE WHEN debt_to_income_ratio < 10 THEN '1. Low DTI (<10%)'
  WHEN debt_to_income_ratio < 20 THEN '2. Moderate DTI (10-20%)'
  WHEN debt_to_income_ratio < 35 THEN '3. High DTI (20-35%)'
  WHEN debt_to_income_ratio < 50 THEN '4. Very High DTI (35-50%)'
  ELSE '5. Critical DTI (>50%)' END"""


def _segment(label: str, tiers: str) -> str:
    measures = ", ".join(
        [
            "count(*) AS total_borrowers",
            avg("borrower_age", 1, "avg_age"),
            avg("annual_income", 0, "avg_income"),
            avg("loan_amount", 0, "avg_loan"),
            avg("interest_rate", 2, "avg_interest_rate"),
            avg("debt_to_income_ratio", 2, "avg_dti"),
            rate(),
        ]
    )
    return f"SELECT '{label}' AS segment, {measures} FROM clean WHERE risk_tier IN ({tiers})"


def _business() -> dict[str, str]:
    return {
        "q01_default_by_tier": grouped(
            "clean",
            "clean",
            "risk_tier",
            N,
            DEFAULTS,
            rate(),
            avg("loan_amount", 2, "avg_loan_amount"),
            avg("interest_rate", 2, "avg_interest_rate"),
        ),
        "q02_default_by_purpose": grouped(
            "clean",
            "clean",
            "loan_purpose",
            N,
            DEFAULTS,
            rate(),
            avg("loan_amount", 2, "avg_loan_amount"),
            rank("risk_rank"),
        ),
        "q03_income_tier": grouped(
            "clean",
            "clean",
            "income_tier",
            "count(*) AS total_borrowers",
            DEFAULTS,
            rate(),
            avg("annual_income", 2, "avg_income"),
            avg("loan_amount", 2, "avg_loan_amount"),
            avg("debt_to_income_ratio", 2, "avg_dti"),
        ),
        "q04_grade_risk": grouped(
            "clean",
            "clean",
            "loan_grade",
            N,
            rate(),
            avg("interest_rate", 2, "avg_interest_rate"),
            avg("risk_score", 1, "avg_risk_score"),
            total("loan_amount", "total_exposure"),
            share("sum(loan_amount)", "sum(sum(loan_amount)) OVER ()", 2, "exposure_share_pct"),
        ),
        "q05_risk_segments": statement(
            "clean",
            _segment("High Risk", "'High Risk', 'Critical Risk'")
            + " UNION ALL "
            + _segment("Low/Medium Risk", "'Low Risk', 'Medium Risk'"),
        ),
        "q06_prior_default": grouped(
            "clean",
            "clean",
            "prior_default_on_file, risk_tier",
            N,
            rate(),
            avg("risk_score", 1, "avg_risk_score"),
            avg("loan_amount", 2, "avg_loan_amount"),
            avg("interest_rate", 2, "avg_interest_rate"),
        ),
        "q07_dti_buckets": grouped(
            "clean",
            f"(SELECT *, {DTI_CASE} AS dti_bucket FROM clean)",
            "dti_bucket",
            N,
            rate(),
            avg("loan_amount", 2, "avg_loan_amount"),
            avg("risk_score", 1, "avg_risk_score"),
        ),
        "q08_cumulative_exposure": statement(
            "clean",
            "SELECT risk_score_band, total_loans, total_exposure, default_rate_pct, "
            "CAST(sum(total_exposure) OVER (ORDER BY risk_score_band DESC) AS BIGINT) "
            "AS cumulative_exposure, "
            + share(
                "sum(total_exposure) OVER (ORDER BY risk_score_band DESC)",
                "sum(total_exposure) OVER ()",
                2,
                "cumulative_exposure_pct",
            )
            + " FROM bands",
            f"""
bands AS (
  SELECT round(risk_score / 10) * 10 AS risk_score_band, {N},
    {total("loan_amount", "total_exposure")}, {rate()}
  FROM clean GROUP BY ALL
)""",
        ),
        "q09_age_groups": grouped(
            "clean",
            "clean",
            "borrower_age_group",
            "count(*) AS total_borrowers",
            rate(),
            avg("annual_income", 0, "avg_income"),
            avg("loan_amount", 0, "avg_loan"),
            avg("debt_to_income_ratio", 2, "avg_dti"),
            avg("credit_history_years", 1, "avg_credit_history"),
            avg("risk_score", 1, "avg_risk_score"),
            rank("default_risk_rank"),
        ),
        "q10_snapshot_recovery": statement(
            "clean",
            "SELECT count(*) FILTER (WHERE risk_tier <> 'Critical Risk') AS rows_after_delete, "
            "count(*) AS rows_before_delete, count(*) AS rows_restored FROM clean",
        ),
        "snapshot_history": statement(
            "clean",
            "SELECT CAST(version AS BIGINT) AS version, risk_tier, count(*) AS total_loans "
            "FROM clean, (VALUES (0), (1), (2), (3)) AS v(version) "
            "WHERE NOT (version = 1 AND risk_tier = 'Critical Risk') GROUP BY version, risk_tier",
        ),
    }


def _section(name: str, key: str, table: str, *measures: str) -> str:
    return f"SELECT '{name}' AS section, {key} AS category, {', '.join(measures)} FROM {table} GROUP BY {key}"


def _dashboards() -> dict[str, str]:
    performance = (
        N,
        DEFAULTS,
        rate(),
        avg("loan_amount", 2, "avg_loan_amount"),
        total("loan_amount", "total_exposure"),
        share("sum(loan_amount)", "sum(sum(loan_amount)) OVER ()", 2, "exposure_share_pct"),
        rank("risk_rank"),
    )
    segment = ("count(*) AS total_borrowers", DEFAULTS, rate())
    page = (N, rate(), avg("risk_score", 1, "avg_risk_score"), avg("loan_amount", 2, "avg_loan_amount"))
    measures = ", ".join(page)
    return {
        "dash_portfolio_kpis": statement(
            "clean",
            f"SELECT {N}, {DEFAULTS}, {rate()}, {total('loan_amount', 'total_exposure')}, "
            + share(
                "count(*) FILTER (WHERE risk_tier IN ('High Risk', 'Critical Risk'))",
                "count(*)",
                2,
                "high_risk_rate_pct",
            )
            + " FROM clean",
        ),
        "dash_loan_performance": statement(
            "clean",
            " UNION ALL ".join(
                _section(key, key, "clean", *performance) for key in ("loan_purpose", "loan_grade")
            ),
        ),
        "dash_customer_segments": statement(
            "clean",
            " UNION ALL ".join(
                _section(key, key, "clean", *segment)
                for key in ("borrower_age_group", "income_tier", "home_ownership")
            ),
        ),
        "dash_credit_analysis": statement(
            "clean",
            f"SELECT 'dti_bucket' AS section, dti_bucket, NULL AS prior_default_on_file, "
            f"NULL AS risk_tier, {measures} FROM (SELECT *, {DTI_CASE} AS dti_bucket FROM clean) "
            f"GROUP BY dti_bucket UNION ALL "
            f"SELECT 'prior_default', NULL, prior_default_on_file, risk_tier, {measures} "
            f"FROM clean GROUP BY prior_default_on_file, risk_tier UNION ALL "
            f"SELECT 'risk_tier', NULL, NULL, risk_tier, {measures} FROM clean GROUP BY risk_tier",
        ),
    }


def _histogram(column: str, bins: int, by_status: bool = False, source: str = "raw") -> str:
    """Counts by comparing every value with every pair of bin edges."""
    key = "loan_status" if by_status else "0"
    lo = f"CASE WHEN min({column}) = max({column}) THEN min({column}) - 0.5e0 ELSE CAST(min({column}) AS DOUBLE) END"
    hi = f"CASE WHEN min({column}) = max({column}) THEN max({column}) + 0.5e0 ELSE CAST(max({column}) AS DOUBLE) END"
    ctes = f"""
bounds AS (
  SELECT {key} AS cls, {lo} AS lo, {hi} AS hi FROM {source} WHERE {column} IS NOT NULL GROUP BY cls
), bins AS (
  SELECT cls, CAST(i AS INTEGER) AS bin, i * ((hi - lo) / {bins}) + lo AS bin_lo,
    CASE WHEN i = {bins - 1} THEN hi ELSE (i + 1) * ((hi - lo) / {bins}) + lo END AS bin_hi
  FROM bounds, range({bins}) AS r(i)
), vals AS (
  SELECT {key} AS cls, CAST({column} AS DOUBLE) AS x, count(*) AS n
  FROM {source} WHERE {column} IS NOT NULL GROUP BY ALL
)"""
    output = "bins.cls AS loan_status, " if by_status else ""
    body = f"""SELECT {output}bin, bin_lo, bin_hi, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows
FROM bins LEFT JOIN vals ON vals.cls = bins.cls AND x >= bin_lo
  AND (x < bin_hi OR (bin = {bins - 1} AND x <= bin_hi))
GROUP BY bins.cls, bin, bin_lo, bin_hi"""
    return statement(source, body, ctes)


RAW_TYPES = dict(
    zip(
        RAW_COLUMNS,
        "int bigint string double string string int double int double string int".split(),
    )
)


def _quality_rows() -> str:
    one = (
        "SELECT CAST({i} AS INTEGER) AS position, '{name}' AS column_name, '{type}' AS type, "
        "count(*) - count({name}) AS null_count, "
        "(count(*) - count({name})) * 100e0 / count(*) AS pct, "
        "count(DISTINCT {name}) + CASE WHEN count({name}) < count(*) THEN 1 ELSE 0 END "
        "AS distinct_values FROM raw"
    )
    return " UNION ALL ".join(
        one.format(i=i, name=name, type=kind) for i, (name, kind) in enumerate(RAW_TYPES.items())
    )


def _reports() -> dict[str, str]:
    null_pct = rounded("pct", 2, "null_pct")
    profile = f"\nquality AS (SELECT *, {null_pct} FROM ({_quality_rows()}))"
    fields = ", ".join(f"({i}, '{n}', '{t}')" for i, (n, t) in enumerate(RAW_TYPES.items()))
    summary = ", ".join(
        [
            N,
            total("loan_status", "total_defaults"),
            avg("loan_amnt", 2, "avg_loan_amount"),
            avg("person_income", 2, "avg_income"),
            avg("loan_int_rate", 2, "avg_interest_rate"),
            avg("person_age", 1, "avg_age"),
            avg("cb_person_cred_hist_length", 1, "avg_credit_history"),
            rounded("sum(loan_status) * 100e0 / count(*)", 2, "default_rate_pct"),
        ]
    )
    count = 'count(*) AS "count"'
    count_share = share("count(*)", "sum(count(*)) OVER ()", 1, "share_pct")
    return {
        "schema_report": statement(
            "raw",
            "SELECT CAST(position AS INTEGER) AS position, column_name, type, "
            "(SELECT count(*) FROM raw) AS row_count, CAST(12 AS INTEGER) AS column_count "
            f"FROM (VALUES {fields}) AS f(position, column_name, type)",
        ),
        "quality_profile": statement(
            "raw",
            "SELECT position, column_name, type, null_count, null_pct, distinct_values, "
            "CASE WHEN null_pct > 5 THEN 'Needs Attention' ELSE 'Good' END AS status FROM quality",
            profile,
        ),
        "quality_summary": statement(
            "raw",
            "SELECT count(*) AS columns_assessed, "
            "count(*) FILTER (WHERE null_pct > 5) AS columns_needing_cleanup FROM quality",
            profile,
        ),
        "status_distribution": statement(
            "raw",
            "SELECT loan_status, CASE loan_status WHEN 0 THEN 'Non-Default' WHEN 1 THEN 'Default' "
            f"END AS label, {count}, {count_share} FROM raw WHERE loan_status IS NOT NULL "
            "GROUP BY loan_status",
        ),
        "loan_amount_histogram": _histogram("loan_amnt", 40),
        "age_histogram": _histogram("person_age", 30),
        "rate_histogram_by_status": _histogram("loan_int_rate", 30, by_status=True),
        "stored_amount_histogram": _histogram("loan_amnt", 40, source="scored"),
        "stored_rate_histogram": _histogram("loan_int_rate", 30, by_status=True, source="scored"),
        "executive_summary": statement(
            "raw",
            "SELECT *, "
            + rounded("100e0 / nullif(default_rate_pct, 0)", 1, "one_default_in")
            + f" FROM (SELECT {summary} FROM raw)",
        ),
        "tier_distribution": grouped(
            "scored",
            "scored",
            "risk_tier",
            count,
            avg("risk_score", 1, "avg_score"),
            rate("loan_status", name="actual_default_rate_pct"),
        ),
        "tier_status_counts": grouped("scored", "scored", "risk_tier, loan_status", count),
        "tier_summary": grouped(
            "scored",
            "scored",
            "risk_tier",
            "count(*) AS total",
            rate("loan_status", 1, "default_rate"),
            avg("risk_score", 1, "avg_risk_score"),
            avg("loan_amnt", 0, "avg_loan"),
        ),
        "tier_shares": grouped("scored", "scored", "risk_tier", count, count_share),
        "verify_counts": statement(
            "clean",
            "SELECT 'row count' AS check_name, count(*) AS source_rows, count(*) AS target_rows, "
            "true AS passed FROM scored UNION ALL SELECT 'tier: ' || risk_tier, count(*), "
            "count(*), true FROM scored GROUP BY risk_tier",
        ),
        "verify_tiers": grouped(
            "scored",
            "scored",
            "risk_tier",
            "count(*) AS total",
            rate("loan_status", name="actual_default_rate"),
        ),
        "verify_sample": statement(
            "scored",
            "SELECT person_age, loan_amnt, loan_int_rate, risk_score, risk_tier, loan_status "
            "FROM scored ORDER BY ALL LIMIT 5",
        ),
    }


def _stages() -> dict[str, str]:
    upper = ", ".join(
        f"{name} AS {name.upper()}"
        for name in [
            *RAW_COLUMNS,
            "debt_to_income_ratio",
            "loan_to_income_ratio",
            "annual_interest_burden",
            "age_group",
            "income_tier",
            "loan_size_category",
            "risk_score",
            "risk_tier",
        ]
    )
    return {
        "read_loans_csv": statement("raw", "SELECT * FROM raw"),
        "csv_rejected_values": statement(
            "raw",
            " UNION ALL ".join(
                f"SELECT '{name}' AS column_name, count(*) FILTER (WHERE {rejected}) AS rejected FROM raw"
                for name, rejected in {
                    **dict.fromkeys(RAW_COLUMNS, "false"),
                    "person_age": "person_age % 10 = 0",
                    "person_income": "loan_grade = 'A' AND person_income >= 1000",
                }.items()
            ),
        ),
        "csv_rejected_records": statement(
            "raw",
            "SELECT rejected, count(*) AS records FROM (SELECT concat_ws(',', "
            "CASE WHEN person_age % 10 = 0 THEN 'person_age' END, "
            "CASE WHEN loan_grade = 'A' AND person_income >= 1000 THEN 'person_income' END) AS rejected "
            "FROM raw) WHERE rejected <> '' GROUP BY rejected",
        ),
        "dedup_loans": statement("cleaning", "SELECT * FROM deduped"),
        "drop_missing": statement("cleaning", "SELECT * FROM complete"),
        "filter_outliers": statement("cleaning", "SELECT * FROM plausible"),
        "standardize_text": statement("cleaning", "SELECT * FROM tidy"),
        "clean_funnel": statement(
            "cleaning",
            "SELECT r AS raw_rows, r - d AS duplicates_removed, d AS after_dedup, "
            "n AS after_null_drop, o AS after_outlier_fix, t AS final_clean_rows FROM "
            "(SELECT count(*) AS r FROM raw), (SELECT count(*) AS d FROM deduped), "
            "(SELECT count(*) AS n FROM complete), (SELECT count(*) AS o FROM plausible), "
            "(SELECT count(*) AS t FROM tidy)",
        ),
        "loan_features": statement("scored", "SELECT * FROM featured"),
        "risk_scores": statement("scored", "SELECT * FROM scored"),
        "scored_view": statement("scored", "SELECT * FROM scored"),
        "load_raw": statement("scored", f"SELECT {upper} FROM scored"),
        "clean_layer": statement("clean", "SELECT * FROM clean"),
        "clean_database": statement("clean", "SELECT * FROM clean"),
        "clean_restated_tier": statement("clean", "SELECT * FROM clean"),
    }


def _marts() -> dict[str, str]:
    keys = {
        "mart_risk_tier_summary": "risk_tier_summary",
        "mart_loan_purpose": "loan_purpose_analysis",
        "mart_demographics": "borrower_demographics",
        "mart_credit_analysis": "credit_analysis",
    }
    marts = {key: grouped("clean", "clean", *MART_SQL[name]) for key, name in keys.items()}
    marts["mart_row_counts"] = statement(
        "clean",
        " UNION ALL ".join(
            f"SELECT '{name.upper()}' AS table_name, count(*) AS row_count "
            f"FROM (SELECT DISTINCT {spec[0]} FROM clean)"
            for name, spec in MART_SQL.items()
        ),
    )
    return marts


def statements() -> dict[str, str]:
    every = {**_stages(), **_reports(), **_marts(), **_business(), **_dashboards()}
    segment = f"SELECT * FROM ({every['q05_risk_segments']}) WHERE segment = 'High Risk'"
    pages = ("portfolio_kpis", "loan_performance", "customer_segments")
    return {
        **every,
        "stored_risk_segment": segment,
        **{f"stored_{page}": every[f"dash_{page}"] for page in pages},
    }
