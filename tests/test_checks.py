"""Checks within and across tables."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stackroom.operators.checks import (
    Check,
    CheckSuite,
    QualityGateError,
    _sample_bounds,
    enforce,
    failed_rows,
    failed_rows_of,
    failed_samples,
    roll_up,
    rows_with_repeated_key,
    summarize,
)
from stackroom.operators.profile import first_rows, table_profile
from stackroom.operators.relationship import RelationshipSpec, coverage, missing_key_sample, missing_keys

COLUMNS = "n int, score int, price double, day date, a string, b string"
TODAY = dt.date(2020, 6, 1)
ROWS = [
    (1, 1, 1.0, TODAY, "x", "k"),
    (2, 9, -0.5, dt.date(2020, 6, 2), "x", None),
    (3, None, None, None, None, None),
    (4, 5, 0.0, dt.date(1999, 1, 1), None, "k"),
    (5, 9, float("nan"), TODAY, "z", None),
]
SUITE = CheckSuite.from_dict(
    {
        "dataset_name": "d",
        "quality_dimension": "q",
        "checks": [
            {"name": "present", "type": "not_null", "column": "a", "severity": "critical"},
            {"name": "positive", "type": "non_negative", "column": "price", "severity": "warning"},
            {"name": "allowed", "type": "value_in_set", "column": "score", "allowed_values": [1, 5], "severity": "critical"},
            {"name": "past", "type": "not_in_future", "column": "day", "severity": "warning"},
            {
                "name": "pair",
                "type": "requires_when_present",
                "required_column": "b",
                "when_present_column": "a",
                "severity": "warning",
                "sample_limit": 1,
            },
            {"name": "unique", "type": "duplicate_key", "key_columns": ["a"], "severity": "warning"},
            {"name": "unique_pair", "type": "duplicate_key", "key_columns": ["b", "a"], "severity": "critical"},
        ],
    }
)
FAILED = {"present": {3, 4}, "positive": {2}, "allowed": {2, 5}, "past": {2}, "pair": {2, 5}, "unique": {1, 2}, "unique_pair": set()}


@pytest.fixture
def df(spark):
    return spark.createDataFrame(ROWS, COLUMNS)


def test_summary(df):
    lines = {r.check_name: r for r in summarize(df, SUITE, TODAY).collect()}
    assert set(lines) == set(FAILED)
    for name, failing in FAILED.items():
        r = lines[name]
        assert (r.total_rows, r.passed_rows, r.failed_rows) == (5, 5 - len(failing), len(failing))
        assert r.failed_pct == len(failing) * 20.0
        assert r.status == ("failed" if failing else "passed")
        assert (r.dataset_name, r.quality_dimension) == ("d", "q")
    assert lines["unique_pair"].check_type == "duplicate_key" and lines["unique_pair"].severity == "critical"


def test_summary_columns(df):
    assert summarize(df, SUITE).dtypes == [
        ("dataset_name", "string"),
        ("quality_dimension", "string"),
        ("check_name", "string"),
        ("check_type", "string"),
        ("severity", "string"),
        ("status", "string"),
        ("total_rows", "bigint"),
        ("passed_rows", "bigint"),
        ("failed_rows", "bigint"),
        ("failed_pct", "double"),
    ]


def test_summary_of_no_rows_passes(df):
    for r in summarize(df.limit(0), SUITE).collect():
        assert (r.status, r.total_rows, r.failed_rows, r.failed_pct) == ("passed", 0, 0, 0.0)


def test_future_defaults_to_the_current_date(spark):
    df = spark.createDataFrame([(dt.date(2999, 1, 1),), (dt.date(2000, 1, 1),)], "day date")
    suite = CheckSuite((Check("past", "not_in_future", "warning", column="day"),))
    assert summarize(df, suite).first().failed_rows == 1


def test_text_tables_can_be_checked(spark):
    rows = [("-1.5", "1", "2030-01-01"), ("x", "1.0", "no date"), ("2", None, "2020-06-01"), (None, "7", None)]
    df = spark.createDataFrame(rows, "price string, score string, day string")
    suite = CheckSuite(
        (
            Check("positive", "non_negative", "warning", column="price"),
            Check("allowed", "value_in_set", "warning", column="score", allowed_values=(1, 2)),
            Check("past", "not_in_future", "warning", column="day"),
        )
    )
    assert {r.check_name: r.failed_rows for r in summarize(df, suite, TODAY).collect()} == {
        "positive": 1,
        "allowed": 2,
        "past": 1,
    }


def test_failed_rows_agree_with_the_summary(df):
    found = {}
    for r in failed_rows(df, SUITE, TODAY).collect():
        found.setdefault(r.check_name, set()).add(r.n)
    assert found == {name: rows for name, rows in FAILED.items() if rows}
    for check in SUITE.checks:
        assert {r.n for r in failed_rows_of(df, check, TODAY).collect()} == FAILED[check.name]


def test_one_pass_agrees_with_single_checks_on_random_rows(spark):
    rng = random.Random(5)
    some = lambda values: rng.choice([None, *values])
    rows = [
        (i, some([1, 2, 5]), some([-1.0, 2.0]), some([TODAY, dt.date(2030, 1, 1)]), some("ab"), some("cd"))
        for i in range(400)
    ]
    df = spark.createDataFrame(rows, COLUMNS)
    lines = {r.check_name: r.failed_rows for r in summarize(df, SUITE, TODAY).collect()}
    assert lines == {c.name: failed_rows_of(df, c, TODAY).count() for c in SUITE.checks}


def test_repeated_key_rows_start_with_the_key(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None), (5, "b")], "n int, a string")
    out = rows_with_repeated_key(df, Check("u", "duplicate_key", "warning", key_columns=("a",)))
    assert out.columns == ["a", "n"]
    assert sorted(out.collect()) == [("a", 1), ("a", 2)]


def test_samples_of_tables_with_maps(spark):
    df = spark.range(9).selectExpr("id", "map('k', id) m", "cast(null AS string) name")
    suite = CheckSuite.from_dict(
        {"dataset_name": "d", "quality_dimension": "q", "checks": [{"name": "named", "type": "not_null", "column": "name", "severity": "warning", "sample_limit": 4}]}
    )
    assert failed_samples(df, suite).count() == 4


def test_samples_are_the_first_rows_of_each_check(spark):
    df = spark.range(3000).selectExpr("cast(id as int) n", "-1.0D price", "if(id % 2 = 0, null, 'x') a").repartition(11)
    suite = CheckSuite(
        (
            Check("price", "non_negative", "warning", column="price", sample_limit=3),
            Check("a", "not_null", "warning", column="a", sample_limit=5),
        )
    )
    found = sorted((r.check_name, r.n) for r in failed_samples(df, suite, ["n"]).collect())
    assert found == [("a", 0), ("a", 2), ("a", 4), ("a", 6), ("a", 8), ("price", 0), ("price", 1), ("price", 2)]
    unordered = failed_samples(df, suite).collect()
    assert sorted(r.check_name for r in unordered) == ["a"] * 5 + ["price"] * 3


def test_bounded_samples_equal_a_sort_of_all_failing_rows(spark):
    """Nulls and NaN in the order, ties at the bound, a limit of 0, fewer failing rows than the limit, clashing names."""
    rng = random.Random(5)
    rows = [
        (i, rng.choice([None, float("nan"), -0.0, 0.0, 1.5, float(rng.randint(-400, 400))]), rng.choice([None, "x"]), -1.0 if i % 900 == 0 else 1.0, i)
        for i in range(4000)
    ]
    df = spark.createDataFrame(rows, "n int, bound double, place string, bounded_check double, spread int").repartition(13)
    suite = CheckSuite(
        (
            Check("place", "not_null", "warning", column="place", sample_limit=40),
            Check("few", "non_negative", "warning", column="bounded_check", sample_limit=40),
            Check("none", "not_null", "warning", column="place", sample_limit=0),
            Check("twice", "duplicate_key", "warning", key_columns=("bound",), sample_limit=7),
        )
    )
    found = failed_samples(df, suite, ["bound", "n"])
    assert found.columns == ["check_name", *df.columns]
    for check in suite.checks:
        want = failed_rows_of(df, check).orderBy("bound", "n").limit(check.sample_limit)
        assert sorted(r.n for r in found.where(F.col("check_name") == check.name).collect()) == sorted(r.n for r in want.collect())
    unordered = failed_samples(df, suite)
    assert {r.check_name: r["count"] for r in unordered.groupBy("check_name").count().collect()} == {"place": 40, "few": 5, "twice": 7}
    assert failed_samples(df.limit(0), suite, ["bound"]).count() == 0


def test_whole_rows_of_samples_travel_only_within_the_bounds(spark):
    """The row bounds let through are few more than the sample, whatever the number of failing rows."""
    df = spark.range(200_000).selectExpr("id", "cast(null as string) a", "repeat('w', 50) wide").repartition(7)
    suite = CheckSuite((Check("a", "not_null", "warning", column="a", sample_limit=20),))
    failing = failed_rows_of(df, suite.checks[0]).selectExpr("'a' check_name", "id key", "xxhash64(id) spread")
    [(name, bound)] = _sample_bounds(failing, suite).collect()
    assert name == "a" and 19 <= bound < 40
    assert sorted(r.id for r in failed_samples(df, suite, ["id"]).collect()) == list(range(20))


def test_gate(df):
    summary = summarize(df, SUITE, TODAY)
    with pytest.raises(QualityGateError, match="allowed, present"):
        enforce(summary)
    enforce(summary.filter("severity = 'warning'"))
    counts = {(r.severity, r.status): (r.checks, r.failed_rows) for r in roll_up(summary).collect()}
    assert counts == {("critical", "failed"): (2, 4), ("critical", "passed"): (1, 0), ("warning", "failed"): (4, 6)}


@pytest.mark.parametrize(
    "check",
    [
        {"type": "not_null", "column": "a", "severity": "warning"},
        {"name": "c", "column": "a", "severity": "warning"},
        {"name": "c", "type": "other", "column": "a", "severity": "warning"},
        {"name": "c", "type": "not_null", "column": "a", "severity": "fatal"},
        {"name": "c", "type": "not_null", "severity": "warning"},
        {"name": "c", "type": "value_in_set", "column": "a", "severity": "warning"},
        {"name": "c", "type": "value_in_set", "column": "a", "allowed_values": [], "severity": "warning"},
        {"name": "c", "type": "requires_when_present", "required_column": "a", "severity": "warning"},
        {"name": "c", "type": "duplicate_key", "key_columns": [], "severity": "warning"},
    ],
)
def test_bad_checks(check):
    with pytest.raises(ValueError):
        CheckSuite.from_dict({"checks": [check]})


def test_suites_need_checks_and_known_columns(df):
    with pytest.raises(ValueError):
        CheckSuite.from_dict({"checks": []})
    with pytest.raises(ValueError, match="nowhere"):
        summarize(df, CheckSuite((Check("c", "not_null", "warning", column="nowhere"),)))


# --- relationship -----------------------------------------------------------------------------

KEYS = RelationshipSpec.from_dict({"check_name": "r", "left_key": "l", "right_key": "r", "sample_limit": 1})


def test_coverage(spark):
    left = spark.createDataFrame([("a",), ("a",), ("b",), (None,), ("c",)], "l string")
    right = spark.createDataFrame([("a",), ("a",), (None,), ("d",)], "r string")
    line = coverage(left, right, KEYS).first()
    assert (line.left_total_keys, line.matched_keys, line.missing_keys) == (3, 1, 2)
    assert (line.status, line.missing_pct, line.severity) == ("failed", 66.6667, "critical")
    assert sorted(missing_keys(left, right, KEYS).collect()) == [("b",), ("c",)]
    assert missing_key_sample(left, right, KEYS).collect() == [("b",)]
    with pytest.raises(QualityGateError):
        enforce(coverage(left, right, KEYS))


def test_coverage_of_no_keys(spark):
    none = spark.createDataFrame([(None,)], "l string")
    line = coverage(none, none.withColumnRenamed("l", "r"), KEYS).first()
    assert (line.status, line.left_total_keys, line.missing_pct) == ("passed", 0, 0.0)


def test_relationship_validation(spark):
    with pytest.raises(ValueError):
        RelationshipSpec.from_dict({"check_name": "r", "left_key": "l"})
    with pytest.raises(ValueError):
        RelationshipSpec.from_dict({"check_name": "r", "left_key": "l", "right_key": "r", "severity": "x"})
    with pytest.raises(ValueError):
        coverage(spark.range(1), spark.range(1), KEYS)


# --- profile ----------------------------------------------------------------------------------


def test_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "n int, `a.b` string")
    assert table_profile(df).collect() == [(1, "n", "int", 0, 2), (2, "a.b", "string", 1, 2)]
    assert first_rows(df, 1, ["n"]).collect() == [(1, None)]
    assert first_rows(df, 5).count() == 2
