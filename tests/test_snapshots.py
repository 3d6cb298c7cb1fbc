from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest

from lendlens.session import scratch_dir
from lendlens.sources.snapshots import SnapshotTable

SCHEMA = "borrower int, risk_tier string, score double"
ROWS = [
    (1, "Critical Risk", 80.0),
    (1, "Critical Risk", 80.0),
    (2, None, 10.0),
    (3, "Low Risk", None),
    (4, "", 5.0),
    (5, "Odd/=% tier", 6.0),
]


CRITICAL = "risk_tier = 'Critical Risk'"


def bag(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(params=["risk_tier", None])
def table(spark, request):
    frame = spark.createDataFrame(ROWS, SCHEMA)
    made = SnapshotTable(spark, scratch_dir(spark, "snap"), frame.schema, request.param)
    made.create(frame)
    return made


def test_create_keeps_every_row_null_and_odd_value(table):
    assert bag(table.read()) == Counter(ROWS)
    assert table.latest().rows == len(ROWS)
    assert table.read().columns == ["borrower", "risk_tier", "score"]


def test_delete_keeps_null_tiers_and_old_versions_stay_readable(table):
    before = table.latest()
    after = table.delete_where(CRITICAL)
    assert bag(table.read()) == Counter(r for r in ROWS if r[1] != "Critical Risk")
    assert after.rows == 4
    assert bag(table.read(before)) == Counter(ROWS)


def test_a_version_is_one_folder_and_one_log_row(table):
    after = table.delete_where("borrower = 3 OR score IS NULL")
    assert after.rows == 5
    assert [v.number for v in table.versions()] == [0, 1]
    assert len({v.folder for v in table.versions()}) == 2
    assert bag(table.spark.read.parquet(f"{table.base}/{after.folder}")) == bag(table.read())
    assert bag(table.read()) == Counter(r for r in ROWS if r[0] != 3)


def test_a_read_opens_one_folder_whatever_the_history(table):
    first = table.latest()
    for _ in range(4):
        table.delete_where(CRITICAL)
        table.restore_where(CRITICAL, as_of=first)
    steps = table.read()._jdf.queryExecution().executedPlan().toString().split("\n")
    assert len([step for step in steps if step.strip()]) == 2  # a scan, its columns as rows
    assert bag(table.read()) == Counter(ROWS)


def test_delete_of_one_tier_reads_about_one_tier(spark):
    frame = spark.range(400_000, numPartitions=1).selectExpr(
        "id AS borrower", "concat('tier ', id % 40) AS risk_tier"
    )
    table = SnapshotTable(spark, scratch_dir(spark, "snap"), frame.schema, "risk_tier")
    table.create(frame)
    hits = table.read().filter("risk_tier = 'tier 7'")
    hits.collect()
    metrics = hits._jdf.queryExecution().executedPlan().collectLeaves().head().metrics()
    assert hits.count() == 10_000
    assert metrics.apply("numOutputRows").value() < 60_000


def test_a_condition_on_now_or_chance_is_decided_once(table):
    table.delete_where("rand() < 0.5")
    assert bag(table.read()) == bag(table.read())


def test_a_second_create_is_refused(table):
    with pytest.raises(ValueError, match="exists"):
        table.create(table.read())
    assert bag(table.read()) == Counter(ROWS)


def test_rows_restored_after_a_delete_stay(table):
    before = table.latest()
    table.delete_where(CRITICAL)
    table.restore_where(CRITICAL, as_of=before)
    assert bag(table.read()) == Counter(ROWS)


def test_restore_gives_the_original_bag_and_restore_missing_is_idempotent(table):
    before = table.latest()
    table.delete_where(CRITICAL)
    table.restore_missing(CRITICAL, as_of=before)
    assert bag(table.read()) == Counter(ROWS)
    table.restore_missing(CRITICAL, as_of=before)
    assert bag(table.read()) == Counter(ROWS)
    table.restore_where(CRITICAL, as_of=before)
    assert bag(table.read()) == Counter(ROWS) + Counter({(1, "Critical Risk", 80.0): 2})


def test_everything_deleted_and_restored(table):
    before = table.latest()
    gone = table.delete_where("true")
    assert (gone.rows, table.read().count()) == (0, 0)
    assert table.delete_where("true").rows == 0
    table.restore_where("true", as_of=before)
    assert bag(table.read()) == Counter(ROWS)


def test_read_as_of_an_offset(spark):
    start = datetime(2024, 5, 1, 12, 0, tzinfo=timezone.utc)
    frame = spark.createDataFrame(ROWS, SCHEMA)
    table = SnapshotTable(spark, scratch_dir(spark, "snap"), frame.schema, "risk_tier")
    table.create(frame, committed_at=start)
    table.delete_where(CRITICAL, committed_at=start + timedelta(seconds=60))
    now = start + timedelta(seconds=130)
    assert table.version_before(120, now=now).number == 0
    assert table.version_before(70, now=now).number == 1
    assert table.read(table.version_before(120, now=now)).count() == 6
    # An old delete: the state of two minutes ago has lost the rows too, so nothing comes back.
    late = table.version_before(120, now=start + timedelta(seconds=600))
    assert table.restore_where(CRITICAL, as_of=late).rows == 4
    with pytest.raises(ValueError):
        table.version_before(3600, now=now)


def test_empty_table(spark):
    frame = spark.createDataFrame([], SCHEMA)
    table = SnapshotTable(spark, scratch_dir(spark, "snap"), frame.schema, "risk_tier")
    assert table.create(frame).rows == 0
    assert table.read().dtypes == frame.dtypes
    assert table.read().count() == 0
