import os

import pytest
from pyspark.sql import functions as F

from lendlens.__main__ import main
from lendlens.operators import profiling
from lendlens.operators.verify import load_checks
from lendlens.plans import marts
from lendlens.plans.pipeline import (
    REJECTS,
    check_marts,
    quarantine,
    register_scored,
    run_pipeline,
    score_loans,
)
from lendlens.schema import RAW_COLUMNS, RAW_SCHEMA
from lendlens.session import scratch_dir, shuffle_partitions
from lendlens.sources.csv import (
    read_loans_csv,
    rejected_records,
    rejected_values,
    write_loans_csv,
)
from lendlens.sources.constants import literal_rows
from lendlens.sources.layers import VERSIONS, LayerStore
from tests.conftest import SF_DIR

HEADER = ",".join(RAW_COLUMNS)


def read_text(spark, tmp_path, text, **options):
    path = tmp_path / "loans.csv"
    path.write_text(text)
    return read_loans_csv(spark, str(path), **options)


def test_null_tokens(spark, tmp_path):
    rows = read_text(
        spark,
        tmp_path,
        f"{HEADER}\n"
        "22,59000,RENT,123.0,PERSONAL,D,35000,16.02,1,0.59,Y,3\n"
        'NA,,"",NA,NA,,1000,NaN,0,NA,"",\n',
    ).collect()
    assert tuple(rows[0]) == (22, 59000, "RENT", 123.0, "PERSONAL", "D", 35000, 16.02, 1, 0.59, "Y", 3)
    assert tuple(rows[1]) == (None, None, "", None, None, None, 1000, None, 0, None, "", None)


def test_columns_are_found_by_name(spark, tmp_path):
    shuffled = ["note", *reversed(RAW_COLUMNS)]
    values = dict(zip(RAW_COLUMNS, "22,59000,RENT,1.5,PERSONAL,D,35000,16.02,1,0.59,Y,3".split(",")))
    line = ",".join(values.get(name, "x") for name in shuffled)
    loans = read_text(spark, tmp_path, f"{','.join(shuffled)}\n{line}\n")
    assert loans.columns == RAW_COLUMNS
    assert [f.dataType for f in loans.schema] == [f.dataType for f in RAW_SCHEMA]
    assert tuple(loans.first())[:4] == (22, 59000, "RENT", 1.5)


def test_missing_columns_and_bad_values(spark, tmp_path):
    with pytest.raises(ValueError, match="loan_grade"):
        read_text(spark, tmp_path, HEADER.replace("loan_grade,", "") + "\n")
    text = f"{HEADER}\nold,59000,RENT,1.5,PERSONAL,D,35000,16.02,1,0.59,Y,3\n"
    assert read_text(spark, tmp_path, text).first().person_age is None
    with pytest.raises(Exception):
        read_text(spark, tmp_path, text, mode="FAILFAST").collect()


def test_csv_round_trip(spark, raw):
    path = scratch_dir(spark, "csv")
    write_loans_csv(raw, path)
    back = read_loans_csv(spark, path)
    assert back.exceptAll(raw).count() == raw.exceptAll(back).count() == 0


def test_rejected_values_are_those_that_the_reader_loses(spark, make_loans):
    path = scratch_dir(spark, "csv")
    loans = make_loans({"loan_amnt": 0}, {"loan_amnt": 1}, {"loan_amnt": 2, "person_age": None})
    incomes = F.array(F.lit("50000"), F.lit("50,000"), F.lit("5e"))
    text = loans.withColumn("person_income", incomes[F.col("loan_amnt")])
    write_loans_csv(text.coalesce(1), path)
    lost = read_loans_csv(spark, path).filter("person_income IS NULL").count()
    rejects = rejected_records(spark, path)
    found = {r.column_name: r.rejected for r in rejected_values(rejects).collect()}
    assert found.pop("person_income") == lost == 2
    assert set(found.values()) == {0} and len(found) == 11
    records = {r.record: r.rejected for r in rejects.collect()}
    assert len(records) == 2 and set(map(tuple, records.values())) == {("person_income",)}
    assert any('"50,000"' in record for record in records)


def test_rejects_have_odd_columns_and_field_counts(spark, tmp_path):
    names = ["note", *reversed(RAW_COLUMNS)]
    good = dict(zip(RAW_COLUMNS, "22,59000,RENT,1.5,PERSONAL,D,35000,16.02,1,0.59,Y,3".split(",")))
    bad = {**good, "person_age": "old", "loan_int_rate": "NaN", "loan_status": "x", "loan_amnt": "NA"}
    lines = [",".join(row.get(name, "?") for name in names) for row in (good, bad, good, good)]
    path = tmp_path / "loans.csv"
    path.write_text("\n".join([",".join(names), *lines[:3], f"{lines[3]},one too many"]) + "\n")
    rejects = rejected_records(spark, str(path)).collect()
    assert {r.record: r.rejected for r in rejects} == {
        lines[1]: ["person_age", "loan_status"],
        f"{lines[3]},one too many": [],
    }
    assert all(r.file.endswith("loans.csv") for r in rejects)
    text = rejected_records(spark, str(path))._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1
    with pytest.raises(ValueError, match="columns missing"):
        path.write_text("note\n1\n")
        rejected_records(spark, str(path))


def test_rejects_are_kept_beside_raw(spark, tmp_path):
    path = tmp_path / "loans.csv"
    path.write_text(f"{HEADER}\nold,59000,RENT,1.5,PERSONAL,D,35000,16.02,1,0.59,Y,3\n")
    store = LayerStore(spark, scratch_dir(spark, "layers"))
    quarantine(rejected_records(spark, str(path)), store)
    kept = store.read("raw", REJECTS).first()
    assert kept.record.startswith("old,59000") and kept.rejected == ["person_age"]


def test_pipeline_writes_every_layer(spark, raw, clean):
    store = LayerStore(spark, scratch_dir(spark, "layers"))
    run_pipeline(raw, store)
    loaded = store.read("raw")
    assert all(name == name.upper() for name in loaded.columns)
    assert len(loaded.columns) == 20
    written = store.read("clean")
    assert written.exceptAll(clean).count() == clean.exceptAll(written).count() == 0
    for name, mart in marts.MARTS.items():
        stored = store.read("analytics", name)
        assert stored.exceptAll(mart(clean)).count() == 0
        assert stored.count() == mart(clean).count()
    checks = load_checks(score_loans(raw), loaded).collect()
    assert len(checks) == 5 and all(c.passed for c in checks)


def test_pipeline_can_run_again(spark, raw):
    store = LayerStore(spark, scratch_dir(spark, "layers"))
    run_pipeline(raw, store)
    run_pipeline(raw, store)
    assert store.read("clean").count() == 1342


def test_a_shortened_mart_or_table_stops_the_pipeline(spark, raw):
    store = LayerStore(spark, scratch_dir(spark, "layers"))
    run_pipeline(raw, store)
    name = "credit_analysis"
    store.replace("analytics", name, store.read("analytics", name).limit(1))
    with pytest.raises(RuntimeError, match=name):
        check_marts(store)

    class Losing(LayerStore):
        def load_raw(self, scored):
            loaded = super().load_raw(scored)
            return loaded.filter("RISK_TIER <> 'Critical Risk'")

    with pytest.raises(RuntimeError, match="RAW"):
        run_pipeline(raw, Losing(spark, scratch_dir(spark, "layers")))


def test_load_checks_report_a_loss(spark, scored):
    short = scored.filter("risk_tier <> 'Critical Risk'")
    failed = {c.check_name for c in load_checks(scored, short).collect() if not c.passed}
    assert failed == {"row count", "tier: Critical Risk"}
    empty = load_checks(scored.limit(0), scored.limit(0)).collect()
    assert [(c.check_name, c.source_rows, c.passed) for c in empty] == [("row count", 0, True)]


def test_tables_are_visible_to_sql(spark, raw):
    store = LayerStore(spark, scratch_dir(spark, "layers"))
    names = store.create_namespaces(prefix="t1_")
    assert names == ["t1_raw", "t1_clean", "t1_analytics"]
    store.create_namespaces(prefix="t1_")
    run_pipeline(raw, store)
    table = store.register("clean", prefix="t1_")
    row = spark.sql(
        f"SELECT COUNT(*) AS N FROM {table} WHERE RISK_TIER IN ('High Risk', 'Critical Risk')"
    ).first()
    assert row.N == 102
    assert store.register("clean", prefix="t1_") == table
    elsewhere = LayerStore(spark, scratch_dir(spark, "layers"))
    run_pipeline(raw, elsewhere)
    with pytest.raises(ValueError, match="already exists"):
        elsewhere.register("clean", prefix="t1_")


def test_scored_view(spark, scored):
    register_scored(scored)
    assert spark.sql("SELECT count(*) AS n FROM loans_scored").first().n == 1342


def test_command_line_run(spark, raw, capsys):
    folder = scratch_dir(spark, "cli")
    write_loans_csv(raw, f"{folder}/csv")
    main([f"{folder}/csv", f"{folder}/layers", "--databases", "t2_"], spark)
    assert spark.table("t2_clean.loan_applications").count() == 1342
    assert spark.table("t2_analytics.loan_purpose_analysis").count() > 0
    assert "clean row count" in capsys.readouterr().out


def test_file_size_option_and_unknown_layer(spark, raw):
    store = LayerStore(spark, scratch_dir(spark, "layers"))
    store.load_raw(score_loans(raw), max_records_per_file=100)
    files = [name for _, _, names in os.walk(store.path("raw", "loan_applications")) for name in names]
    assert sum(name.endswith(".parquet") for name in files) >= 14
    with pytest.raises(ValueError):
        store.read("gold")


def test_scratch_dir_needs_a_shared_folder_off_local_mode(spark):
    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Session:
        def __init__(self, **values):
            self.conf = Conf({k.replace("_", "."): v for k, v in values.items()})

    with pytest.raises(ValueError):
        scratch_dir(Session(spark_master="yarn"), "x")
    shared = Session(spark_master="yarn", spark_checkpoint_dir="hdfs://shared/tmp/")
    assert scratch_dir(shared, "x").startswith("hdfs://shared/tmp/x-")
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_shuffle_width_follows_the_input_without_bound():
    assert shuffle_partitions(0) == 1
    assert shuffle_partitions(10**9) == 12
    assert shuffle_partitions(10**14) == 1_117_588


def test_a_failed_replace_keeps_the_table(spark, raw):
    store = LayerStore(spark, scratch_dir(spark, "layers"))
    store.replace("raw", "numbers", spark.range(10))
    broken = spark.range(5).selectExpr("assert_true(id < 3, 'broken') AS id")
    with pytest.raises(Exception, match="broken"):
        store.replace("raw", "numbers", broken)
    assert store.read("raw", "numbers").count() == 10
    assert store.replace("raw", "numbers", spark.range(4)).count() == 4


def test_register_follows_replaced_tables(spark):
    store = LayerStore(spark, scratch_dir(spark, "layers"))
    store.create_namespaces(prefix="t9_")
    store.replace("raw", "numbers", spark.range(10))
    name = store.register("raw", "numbers", prefix="t9_")
    store.replace("raw", "numbers", spark.range(3).selectExpr("id", "'x' AS more"))
    assert store.register("raw", "numbers", prefix="t9_") == name
    assert [tuple(r) for r in spark.table(name).orderBy("id").collect()] == [(0, "x"), (1, "x"), (2, "x")]
    inside = LayerStore(spark, store.base + "/raw/numbers")  # ends alike, is another place
    inside.replace("raw", "numbers", spark.range(2))
    with pytest.raises(ValueError, match="already exists"):
        inside.register("raw", "numbers", prefix="t9_")


def folders(store):
    root = store.base + "/raw/numbers"
    return {name for name in os.listdir(root) if not name.startswith(".")}


def test_retention_keeps_the_newest_versions(spark):
    store = LayerStore(spark, scratch_dir(spark, "layers"))
    assert store.keep_versions("raw", "numbers", 1) == []
    for n in range(4):
        store.replace("raw", "numbers", spark.range(n))
    assert len(folders(store)) == 4
    assert len(store.keep_versions("raw", "numbers", 2)) == 2
    assert len(folders(store)) == 2 and store.read("raw", "numbers").count() == 3
    assert store.keep_versions("raw", "numbers", 2) == []
    assert store.replace("raw", "numbers", spark.range(9)).count() == 9
    assert len(store.keep_versions("raw", "numbers", 1)) == 2
    assert store.read("raw", "numbers").count() == 9
    with pytest.raises(ValueError):
        store.keep_versions("raw", "numbers", 0)


def test_writers_that_take_the_same_number(spark):
    one, other = (LayerStore(spark, base) for base in [scratch_dir(spark, "layers")] * 2)
    one.replace("raw", "numbers", spark.range(5))
    schema = one.read("raw", "numbers").schema.json()
    root = one.base + "/raw/numbers"
    for folder, n in (("a" * 32, 6), ("f" * 32, 7)):  # both saw version 0 as the newest
        spark.range(n).write.parquet(f"{root}/{folder}")
        literal_rows(spark, VERSIONS, [(1, folder, schema, "[]")]).write.mode("append").parquet(f"{root}.versions")
    assert one.read("raw", "numbers").count() == other.read("raw", "numbers").count() == 7
    other.replace("raw", "numbers", spark.range(8))
    assert one.read("raw", "numbers").count() == 8


def test_partitions_are_replaced_alone_and_columns_keep_their_order(spark):
    store = LayerStore(spark, scratch_dir(spark, "layers"))
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, n int")
    stored = store.replace("raw", "numbers", rows, ["k"])
    assert stored.columns == ["k", "n"]
    before = {r.k: r.f for r in stored.withColumn("f", F.input_file_name()).collect()}
    again = store.replace_partitions("raw", "numbers", rows.filter("k = 'b'").withColumn("n", F.lit(9)))
    after = {r.k: (r.n, r.f) for r in again.withColumn("f", F.input_file_name()).collect()}
    assert {k: n for k, (n, _) in after.items()} == {"a": 1, "b": 9, None: 3}
    assert [k for k in after if after[k][1] != before[k]] == ["b"]
    broken = rows.filter("k = 'a'").withColumn("n", F.expr("CAST(assert_true(false, 'broken') AS int)"))
    with pytest.raises(Exception, match="broken"):
        store.replace_partitions("raw", "numbers", broken)
    assert store.read("raw", "numbers").filter("k = 'a'").first().n == 1
    empty = store.replace("raw", "numbers", rows.limit(0), ["k"])
    store.create_namespaces(prefix="t6_")
    assert spark.table(store.register("raw", "numbers", prefix="t6_")).count() == 0
    store.replace("raw", "numbers", rows.drop("k"))
    with pytest.raises(ValueError, match="not partitioned"):
        store.replace_partitions("raw", "numbers", rows)
    store.replace("raw", "numbers", rows.limit(0), ["k"])
    assert empty.columns == ["k", "n"] and store.read("raw", "numbers").count() == 0


def test_missing_table(spark):
    with pytest.raises(ValueError, match="no table"):
        LayerStore(spark, scratch_dir(spark, "layers")).read("clean")


def test_sketches_are_made_once_per_version_and_merge(spark):
    store = LayerStore(spark, scratch_dir(spark, "layers"))
    store.replace("raw", "numbers", spark.range(1000).selectExpr("id", "if(id % 4 = 0, null, -0.0D) AS x"))
    store.sketches("raw", "numbers").collect()
    store.replace("raw", "numbers", spark.range(500, 1500).selectExpr("id", "0.0D AS x"))
    ids, xs = profiling.sketched_profile(
        store.read("raw", "numbers"), store.sketches("raw", "numbers", every_version=True)
    ).collect()
    assert abs(ids.distinct_values - 1500) < 60 and ids.null_count == 0
    assert (xs.distinct_values, xs.null_count, xs.null_pct) == (2, 250, 12.5)
    root = store.base + "/raw/numbers.sketches"
    assert len(os.listdir(root)) == 2
    text = store.sketches("raw", "numbers", every_version=True)._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == text.count("sketch:binary>") == 2  # not the rows
