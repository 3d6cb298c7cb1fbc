from lendlens.operators import profiling


def test_profile_matches_brute_force(spark, raw):
    rows = [r.asDict() for r in raw.collect()]
    profile = profiling.quality_profile(raw).collect()
    assert [r.column_name for r in profile] == raw.columns
    for r in profile:
        values = [row[r.column_name] for row in rows]
        assert r.null_count == sum(v is None for v in values)
        assert r.distinct_values == len(set(values))
        assert abs(r.null_pct - 100 * r.null_count / len(rows)) <= 0.005
        assert r.status == ("Needs Attention" if r.null_pct > 5 else "Good")
    assert {r.column_name: r.type for r in profile} == dict(raw.dtypes)


def test_null_counts_as_one_value_and_zero_has_one_sign(spark):
    frame = spark.createDataFrame([(None, 0.0), (None, -0.0), (2, 1.5)], "a int, b double")
    a, b = profiling.quality_profile(frame).collect()
    assert (a.null_count, a.distinct_values) == (2, 2)
    assert (b.null_count, b.distinct_values) == (0, 2)
    summary = profiling.quality_summary(profiling.quality_profile(frame)).first()
    assert tuple(summary) == (2, 1)


def test_empty_frame_still_lists_its_columns(spark):
    profile = profiling.quality_profile(spark.createDataFrame([], "a int, b string")).collect()
    assert [(r.column_name, r.null_count, r.null_pct, r.distinct_values) for r in profile] == [
        ("a", 0, None, 0),
        ("b", 0, None, 0),
    ]


def test_schema_report(spark):
    frame = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "a int, b string")
    report = [tuple(r) for r in profiling.schema_report(frame).collect()]
    assert report == [(0, "a", "int", 3, 2), (1, "b", "string", 3, 2)]


def test_approximate_profile_is_close_and_exact_in_nulls(spark, raw):
    exact, close = (
        profile.collect()
        for profile in (profiling.quality_profile(raw), profiling.approximate_profile(raw))
    )
    for e, c in zip(exact, close, strict=True):
        assert (e.column_name, e.type, e.null_count, e.null_pct, e.status) == (
            c.column_name,
            c.type,
            c.null_count,
            c.null_pct,
            c.status,
        )
        assert abs(e.distinct_values - c.distinct_values) <= 0.1 * e.distinct_values + 1


def test_approximate_profile_of_an_empty_frame(spark):
    rows = profiling.approximate_profile(spark.createDataFrame([], "a int, `b.c` string")).collect()
    assert [(r.column_name, r.null_count, r.null_pct, r.distinct_values) for r in rows] == [
        ("a", 0, None, 0),
        ("b.c", 0, None, 0),
    ]
