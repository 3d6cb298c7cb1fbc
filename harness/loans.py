"""Loan applications derived from the driver's ``orders`` and ``customer`` tables (FIXTURES.md).

The rules plant every dirty case the cleaning and scoring stages have to handle. ``RAW_CTES``
in ``harness/oracle.py`` states the same derivation for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


ORDER_SCHEMA = "o_orderkey long, o_custkey long, o_totalprice double"
CUSTOMER_SCHEMA = "c_custkey long, c_acctbal double"


def raw_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """12 columns, one row per order, and a second copy of every 50th.

    The join is left to Catalyst: it broadcasts the customers only while they are under the
    session's size threshold, and otherwise AQE splits a customer with very many orders.
    """
    orders = spark.read.schema(ORDER_SCHEMA).parquet(f"{sf_dir}/orders.parquet")
    customers = spark.read.schema(CUSTOMER_SCHEMA).parquet(f"{sf_dir}/customer.parquet")
    keyed = orders.selectExpr("o_orderkey AS k", "o_custkey AS c", "o_totalprice AS p").join(
        customers.selectExpr("c_custkey AS c", "c_acctbal AS b"), "c"
    )
    derived = keyed.selectExpr(
        "k",
        "c",
        """CASE WHEN c * 13 % 100 < 33 THEN 0 WHEN c * 13 % 100 < 65 THEN 1
                WHEN c * 13 % 100 < 85 THEN 2 WHEN c * 13 % 100 < 96 THEN 3
                WHEN c * 13 % 100 < 98 THEN 4 WHEN c * 13 % 100 < 99 THEN 5 ELSE 6 END AS g""",
        """CASE WHEN k % 1499 = 7 THEN 6000000 WHEN k % 1999 = 3 THEN 0
                WHEN k % 401 = 2 THEN NULL ELSE 4000 + floor((b + 1000) * 13) END AS income""",
        """CASE WHEN k % 1201 = 5 THEN 0
                ELSE int((floor(p / 360) + 20) * 25) END AS amount""",
    )
    # Repeating whole rows also keeps Catalyst from moving later filters below this point, where
    # each would have to compute the derived columns a second time.
    loans = derived.selectExpr(
        """inline(array_repeat(named_struct(
             'person_age', CASE WHEN k % 997 = 0 THEN 123 ELSE int(18 + (7 * k + c) % 60) END,
             'person_income', income,
             'person_home_ownership', elt(int(c % 4) + 1, 'RENT', 'mortgage', 'Own', 'OTHER'),
             'person_emp_length', CASE WHEN k % 37 <> 0 THEN double(5 * k % 31) END,
             'loan_intent', elt(int(k % 6) + 1, 'PERSONAL', 'EDUCATION', 'MEDICAL', 'VENTURE',
                                'HOMEIMPROVEMENT', 'DEBTCONSOLIDATION'),
             'loan_grade', elt(g + 1, 'A', 'b', 'C', 'D', 'E', 'F', 'G'),
             'loan_amnt', amount,
             'loan_int_rate', CASE WHEN k % 10 <> 3
                                   THEN double(540 + 250 * g + 37 * k % 250) / 100 END,
             'loan_status', CASE WHEN (31 * k + 17 * g) % 100 < 8 + 9 * g THEN 1 ELSE 0 END,
             'loan_percent_income', CASE WHEN income > 0 THEN round(double(amount) / income, 2) END,
             'cb_person_default_on_file',
               CASE WHEN k % 211 = 4 THEN NULL WHEN (k + g) % 5 = 0 THEN 'Y'
                    WHEN (k + g) % 5 = 1 THEN 'n' ELSE 'N' END,
             'cb_person_cred_hist_length', CASE WHEN k % 307 <> 9 THEN int(2 + 3 * k % 13) END
           ), CASE WHEN k % 50 = 11 THEN 2 ELSE 1 END))"""
    )
    return loans
