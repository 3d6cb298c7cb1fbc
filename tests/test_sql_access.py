"""The stored CLEAN table answers the same questions in Spark SQL."""

import pytest

import __spark_entry__ as registered
from harness import compare, oracle
from lendlens.plans.pipeline import run_pipeline
from lendlens.session import scratch_dir
from lendlens.sources.layers import LayerStore
from tests.conftest import SF_DIR

NAMES = [
    name
    for name, text in registered.oracle_sql().items()
    if ",".join(oracle.STAGES) in text and not name.startswith(("verify_", "q10", "snapshot"))
]


@pytest.fixture(scope="module")
def table(spark, raw):
    store = LayerStore(spark, scratch_dir(spark, "sql"))
    run_pipeline(raw, store)
    store.create_namespaces("sql_")
    return store.register("clean", prefix="sql_")


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", NAMES)
def test_spark_sql_over_the_stored_table(spark, table, duck, name):
    text = registered.oracle_sql()[name]
    over_table = text.replace(",".join(oracle.STAGES), f"\nclean AS (SELECT * FROM {table})")
    assert compare.differences(duck, spark.sql(over_table), text) == []
