import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from harness.loans import raw_loans  # noqa: E402
from lendlens.plans.pipeline import score_loans  # noqa: E402
from lendlens.operators.clean_layer import clean_layer  # noqa: E402
from lendlens.schema import RAW_SCHEMA  # noqa: E402
from lendlens.session import local_session, scratch_dir  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"

DEFAULTS = {
    "person_age": 30,
    "person_income": 50_000,
    "person_home_ownership": "RENT",
    "person_emp_length": 4.0,
    "loan_intent": "MEDICAL",
    "loan_grade": "C",
    "loan_amnt": 10_000,
    "loan_int_rate": 12.5,
    "loan_status": 0,
    "loan_percent_income": 0.2,
    "cb_person_default_on_file": "N",
    "cb_person_cred_hist_length": 4,
}


@pytest.fixture(scope="session")
def spark():
    session = local_session(4)
    yield session
    session.stop()


@pytest.fixture
def make_loans(spark):
    """Raw loans from partial dicts; anything not given takes a default value."""

    def make(*rows):
        values = [tuple({**DEFAULTS, **row}[n] for n in RAW_SCHEMA.fieldNames()) for row in rows]
        return spark.createDataFrame(values, RAW_SCHEMA)

    return make


def stored(spark, df, name):
    """Written, not cached: Spark would put a cached result into other queries' plans."""
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def raw(spark):
    return stored(spark, raw_loans(spark, SF_DIR), "raw")


@pytest.fixture(scope="session")
def scored(spark, raw):
    return stored(spark, score_loans(raw), "scored")


@pytest.fixture(scope="session")
def clean(spark, scored):
    return stored(spark, clean_layer(scored), "clean")
