"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
from harness.loans import raw_loans
from lendlens.functions import measures
from lendlens.operators import cleaning, profiling
from lendlens.plans import business, dashboards, marts, portfolio
from lendlens.plans.pipeline import build_clean, run_pipeline, score_loans
from lendlens.session import footer_session, scratch_dir
from lendlens.sources.layers import LOANS, LayerStore
from tests.conftest import SF_DIR


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def store(spark, raw):
    layers = LayerStore(spark, scratch_dir(spark, "layers"))
    run_pipeline(raw, layers)
    return layers


def test_scoring_shuffles_once_and_filters_first(raw):
    text = plan(score_loans(raw))
    assert text.count("Exchange") == 1
    # Copies combine before the shuffle: one aggregate above it and one below.
    above, below = text.split("Exchange")
    assert above.count("HashAggregate") == below.count("HashAggregate") == 1
    assert text.index("Exchange") < text.index("Filter")
    assert "PushedFilters: [IsNotNull(person_age)" in text


def test_funnel_needs_one_row_level_shuffle(raw):
    text = plan(cleaning.clean_funnel(raw))
    assert text.count("FileScan") == 1
    assert text.count("Exchange hashpartitioning") == 1


def test_profile_reads_the_table_once(raw):
    assert plan(profiling.quality_profile(raw)).count("FileScan") == 1


def test_a_segment_reads_its_tiers_only(store):
    text = plan(business.risk_segment(store.read("clean"), "High Risk"))
    assert re.search(r"PartitionFilters: \[risk_tier#\d+ IN \(High Risk,Critical Risk\)", text)
    leaf = store.read("clean").filter("risk_tier = 'Critical Risk'")
    files = {row.f for row in leaf.select(F.input_file_name().alias("f")).distinct().collect()}
    assert files and all("risk_tier=Critical" in name for name in files)


@pytest.mark.parametrize("stored", [portfolio.stored_amount_histogram, portfolio.stored_rate_histogram])
def test_a_stored_histogram_scans_once(store, stored):
    assert plan(stored(store)).count("FileScan") == 1


def test_bounds_come_from_footers(spark, store):
    rows = store.read("raw")
    least, most = rows.agg(F.min("LOAN_AMNT"), F.max("LOAN_AMNT")).first()
    assert store.bounds("raw", LOANS, "LOAN_AMNT") == {None: (least, most)}
    by_status = store.bounds("raw", LOANS, "LOAN_INT_RATE", "LOAN_STATUS")
    expected = rows.groupBy("LOAN_STATUS").agg(F.min("LOAN_INT_RATE"), F.max("LOAN_INT_RATE")).collect()
    assert by_status == {row[0]: (row[1], row[2]) for row in expected}
    other = footer_session(spark)
    files = other.read.schema(rows.schema).parquet(store.path("raw", LOANS))
    text = plan(files.groupBy("LOAN_STATUS").agg(F.min("LOAN_INT_RATE")))
    assert "PushedAggregation: [MIN(LOAN_INT_RATE)]" in text and "PushedGroupBy: [LOAN_STATUS]" in text
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown", "false") == "false"


def test_bounds_of_a_column_without_statistics(spark, store):
    odd = spark.createDataFrame([(0, None, float("nan")), (1, None, 2.0)], "c int, n double, x double")
    store.replace("analytics", "odd", odd, ["c"])
    assert store.bounds("analytics", "odd", "n", "c") == {0: (None, None), 1: (None, None)}
    assert store.bounds("analytics", "odd", "x", "c")[1] == (2.0, 2.0)


def _dirty(clean, spark):
    """CLEAN with a grade and a purpose of its own for most rows, and one rate that many share."""
    number = F.monotonically_increasing_id()
    grades = clean.withColumn("loan_grade", F.concat(F.lit("g"), (number % 700).cast("string")))
    return grades.withColumn("loan_purpose", F.concat(F.lit("p"), (number % 500).cast("string")))


def test_shares_and_ranks_of_many_groups_need_no_single_task(spark, clean):
    path = scratch_dir(spark, "dirty")
    _dirty(clean, spark).write.parquet(path)
    dirty = spark.read.parquet(path)
    for query in (marts.risk_tier_summary, marts.loan_purpose_analysis, business.grade_risk, business.default_by_purpose):
        windows = [line for line in plan(query(dirty)).split("\n") if " Window " in line]
        assert all("_slice" in line or "_above" in line for line in windows)
    rates = dirty.groupBy("loan_purpose").agg(F.avg("default_flag").alias("r")).collect()
    order = sorted((row.r for row in rates), reverse=True)
    ranks = {row.loan_purpose: row.risk_rank for row in business.default_by_purpose(dirty).collect()}
    assert ranks == {row.loan_purpose: 1 + order.index(row.r) for row in rates}
    shares = business.grade_risk(dirty).collect()
    whole = sum(row.total_exposure for row in shares)
    assert all(abs(row.exposure_share_pct - 100 * row.total_exposure / whole) <= 0.0051 for row in shares)


def test_ranks_with_null_and_equal_rates(spark):
    rows = [("a", 0.5), ("b", None), ("c", 1.0), ("d", 0.5), ("e", 0.0), ("f", None), ("g", 0.4999)]
    ranked = measures.with_rank(spark.createDataFrame(rows, "k string, r double"), "r", "rank")
    ranks = {row.k: row["rank"] for row in ranked.collect()}
    assert ranks == {"c": 1, "a": 2, "d": 2, "g": 4, "e": 5, "b": 6, "f": 6}


def test_the_summed_groups_are_computed_once(spark, store):
    for query in (business.grade_risk, marts.risk_tier_summary, marts.credit_analysis):
        result = query(store.read("clean"))
        result.collect()
        final = plan(result).split("== Initial Plan ==")[0]
        assert "ReusedExchange" in final and "FileScan" not in final  # the scan is the subquery's


def test_stored_pages_scan_marts_only(spark, store):
    prefix = "t5_"
    store.create_namespaces(prefix)
    for name in marts.MARTS:
        store.register("analytics", name, prefix)
    for name, page in dashboards.stored_pages(spark, f"{prefix}analytics").items():
        scans = re.findall(r"FileScan parquet ([\w.]+)", plan(page))
        assert scans == [f"spark_catalog.t5_analytics.{dashboards.MART_PAGES[name][1]}"]


@pytest.mark.parametrize("query", [business.risk_segments, business.cumulative_exposure])
def test_one_scan_per_business_query(store, query):
    assert plan(query(store.read("clean"))).count("FileScan") == 1


def test_marts_read_only_their_columns(spark, store):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    text = plan(marts.loan_purpose_analysis(store.read("clean")))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    columns = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert len(columns.split(",")) == 6


def test_no_python_no_cross_join(spark):
    optional = registered._llm_queries() if registered.llm_queries else {}
    for name, query in registered.queries().items():
        if name in optional:
            continue
        if name.startswith(("read_", "csv_", "load_", "verify_", "q10_", "snapshot_", "mart_row_", "clean_", "stored_", "approximate_")) and name not in ("clean_layer", "clean_funnel"):
            continue  # these write tables first; their last plan is a plain scan
        text = plan(query(spark, SF_DIR))
        assert "Python" not in text and "Pandas" not in text, name
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_filters_do_not_repeat_the_score_below_the_dedup(spark):
    text = plan(business.risk_segments(build_clean(raw_loans(spark, SF_DIR))))
    assert text.count("0.25") == 2


def test_a_customer_with_a_third_of_the_orders_is_split(spark):
    folder = scratch_dir(spark, "skewed")
    spark.range(300_000, numPartitions=8).selectExpr(
        "id AS o_orderkey",
        "IF(id % 3 = 0, 7, id % 5000) AS o_custkey",
        "double(id % 400000) + 1000 AS o_totalprice",
    ).write.parquet(f"{folder}/orders.parquet")
    spark.range(5000).selectExpr("id AS c_custkey", "double(id) AS c_acctbal").write.parquet(
        f"{folder}/customer.parquet"
    )
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key) for key in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        query = build_clean(raw_loans(spark, folder))
        rows = query.collect()
        final = plan(query)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert "SortMergeJoin(skew=true)" in final
    assert len(rows) == build_clean(raw_loans(spark, folder)).count()
