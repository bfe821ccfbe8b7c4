"""Standardize, surrogate keys, defaults, enrich and quarantine."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stackroom.functions.columns import field
from stackroom.operators.defaults import fill_defaults, fill_rules
from stackroom.operators.enrich import EnrichSpec, enrich
from stackroom.operators.quarantine import QuarantineSpec, eligible, rejects
from stackroom.operators.standardize import StandardizeSpec, standardize
from stackroom.operators.surrogate import SurrogateKey, assign_keys, key_mapping
from stackroom.plans import bookstore


def spec_of(*rules, **more):
    return StandardizeSpec.from_dict({"column_rules": list(rules), **more})


def rows(df):
    return sorted(df.collect(), key=str)


# --- standardize ------------------------------------------------------------------------------


def test_rule_sees_targets_of_rules_before_it(spark):
    df = spark.createDataFrame([(" 1.9 ",), ("x",)], "a string")
    spec = spec_of(
        {"source": "a", "target": "b", "trim": True},
        {"source": "b", "target": "c", "target_type": "int", "cast_via": "double"},
        {"source": "c", "target": "b"},
    )
    assert [tuple(r) for r in standardize(df, spec).collect()] == [(" 1.9 ", 1, 1), ("x", None, None)]


def test_target_with_existing_name_replaces_the_column(spark):
    df = spark.createDataFrame([(" A ",)], "a string")
    spec = spec_of(
        {"source": "a", "target": "a", "trim": True}, {"source": "a", "target": "k", "lower": True}
    )
    assert standardize(df, spec).collect() == [("A", "a")]


def test_targets_only_keeps_order_and_ignores_unknown_names(spark):
    df = spark.createDataFrame([("x", "y", 1)], "a string, b string, n int")
    spec = spec_of(
        {"source": "a", "target": "c"},
        {"source": "b", "target": "b"},
        output_mode="select_targets_only",
        passthrough_columns=["n", "nothing", "c"],
    )
    assert standardize(df, spec).columns == ["n", "c", "b"]


def test_drop_ignores_unknown_names_and_comes_before_shaping(spark):
    df = spark.createDataFrame([("x", "y")], "a string, b string")
    rule = {"source": "a", "target": "c"}
    assert standardize(df, spec_of(rule, drop_columns_after_transform=["a", "z"])).columns == ["b", "c"]
    spec = spec_of(rule, drop_columns_after_transform=["c"], output_mode="select_targets_only", passthrough_columns=["b"])
    assert standardize(df, spec).columns == ["b"]


def test_odd_names_are_plain_names(spark):
    df = spark.createDataFrame([(" 5.0 ",)], "`review/score.raw` string")
    spec = spec_of({"source": "review/score.raw", "target": "s.c", "target_type": "int", "cast_via": "double"})
    assert standardize(df, spec).select(field("s.c")).first()[0] == 5


def test_text_rules_are_idempotent(spark):
    rng = random.Random(3)
    values = ["".join(rng.choice(" \t\nAbC") for _ in range(rng.randint(0, 9))) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "title string")
    spec = spec_of(bookstore.TITLE_KEY | {"target": "title"})
    once = standardize(df, spec)
    assert once.collect() == standardize(once, spec).collect()


@pytest.mark.parametrize(
    "config",
    [
        {},
        {"column_rules": []},
        {"column_rules": [{"target": "b"}]},
        {"column_rules": [{"source": "a"}]},
        {"column_rules": [{"source": "a", "target": "b"}], "output_mode": "other"},
        {"column_rules": [{"source": "a", "target": "b", "parse_mode": "other"}]},
        {"column_rules": [{"source": "a", "target": "b"}], "surrogate_key": {"source": "a"}},
        {"column_rules": [{"source": "a", "target": "b"}], "surrogate_key": {"source": "a", "target": "k", "method": "x"}},
    ],
)
def test_bad_standardize_specs(config):
    with pytest.raises(ValueError):
        StandardizeSpec.from_dict(config)


def test_rule_with_unknown_source(spark):
    df = spark.createDataFrame([("x",)], "a string")
    with pytest.raises(ValueError, match="later"):
        standardize(df, spec_of({"source": "later", "target": "b"}, {"source": "a", "target": "later"}))


# --- surrogate keys ---------------------------------------------------------------------------


def test_numbers_follow_sorted_order_over_many_ranges(spark):
    rng = random.Random(11)
    values = list({"".join(rng.choice("abcXYZ019 é") for _ in range(rng.randint(1, 8))) for _ in range(5000)})
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(13)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        mapping = {r.v: r.k for r in key_mapping(df, SurrogateKey("v", "k", start_at=7)).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    ordered = sorted(values, key=lambda v: v.encode())
    assert mapping == {v: i for i, v in enumerate(ordered, start=7)}


def test_repeated_values_share_a_key_and_null_has_none(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "b"), (5, None)], "n int, v string")
    out = assign_keys(df, SurrogateKey("v", "k", require_unique_source=False))
    assert out.columns == ["v", "n", "k"]
    assert {r.n: r.k for r in out.collect()} == {1: 2, 2: 1, 3: None, 4: 2, 5: None}


def test_repeated_values_are_an_error_by_default(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "v string")
    with pytest.raises(ValueError, match="1 values"):
        assign_keys(df, SurrogateKey("v", "k"))


def test_keys_of_no_rows(spark):
    df = spark.createDataFrame([(None,)], "v string")
    assert assign_keys(df, SurrogateKey("v", "k")).collect() == [(None, None)]
    assert assign_keys(df.limit(0), SurrogateKey("v", "k")).collect() == []


def test_source_may_be_dropped_and_must_exist(spark):
    df = spark.createDataFrame([(2.5,), (-1.0,)], "v double")
    out = assign_keys(df, SurrogateKey("v", "k", drop_source_after_create=True))
    assert out.columns == ["k"] and rows(out) == [(1,), (2,)]
    with pytest.raises(ValueError):
        assign_keys(df, SurrogateKey("w", "k"))


# --- defaults ---------------------------------------------------------------------------------


def test_fill_defaults(spark):
    df = spark.createDataFrame([(None, "x"), (" ", " y ")], "a string, b string")
    assert fill_defaults(df, fill_rules({"fill_rules": [{"column": "a", "value": 7}]})).collect() == [
        ("7", "x"),
        ("7", " y "),
    ]


def test_fill_defaults_rejects_other_types_and_unknown_columns(spark):
    df = spark.createDataFrame([(1, "x")], "n int, a string")
    for defaults in ({"n": "none"}, {"z": "none"}):
        with pytest.raises(ValueError):
            fill_defaults(df, defaults)


# --- enrich -----------------------------------------------------------------------------------


def test_later_groups_read_earlier_targets(spark):
    df = spark.createDataFrame([("a", None), (None, None)], "a string, b int")
    spec = EnrichSpec.from_dict(
        {
            "hash_rules": [
                {"source": "a", "target": "h", "method": "xxhash64"},
                {"source": "h", "target": "hh", "method": "xxhash64"},
            ],
            "flag_rules": [
                {"source": "hh", "target": "has_hh", "rule": "is_not_null"},
                {"source": "b", "target": "has_b", "rule": "is_not_null"},
            ],
            "score_rules": [{"target": "n", "method": "sum_flags", "sources": ["has_hh", "has_b", "has_hh"]}],
        }
    )
    out = enrich(df, spec)
    assert [(r.has_hh, r.has_b, r.n) for r in out.collect()] == [(True, False, 2), (False, False, 0)]
    assert dict(out.dtypes)["n"] == "int" and dict(out.dtypes)["h"] == "bigint"


@pytest.mark.parametrize(
    "config",
    [
        {"hash_rules": [{"source": "a", "target": "h", "method": "md5"}]},
        {"hash_rules": [{"target": "h", "method": "xxhash64"}]},
        {"flag_rules": [{"source": "a", "target": "f", "rule": "is_null"}]},
        {"flag_rules": [{"source": "a", "rule": "is_not_null"}]},
        {"score_rules": [{"target": "s", "method": "sum_flags", "sources": []}]},
        {"score_rules": [{"target": "s", "method": "avg", "sources": ["a"]}]},
        {
            "hash_rules": [{"source": "a", "target": "t", "method": "xxhash64"}],
            "flag_rules": [{"source": "a", "target": "t", "rule": "is_not_null"}],
        },
    ],
)
def test_bad_enrich_specs(config):
    with pytest.raises(ValueError):
        EnrichSpec.from_dict(config)


def test_enrich_needs_its_sources(spark):
    df = spark.createDataFrame([("a",)], "a string")
    spec = EnrichSpec.from_dict({"score_rules": [{"target": "s", "method": "sum_flags", "sources": ["later"]}]})
    with pytest.raises(ValueError, match="later"):
        enrich(df, spec)


# --- quarantine -------------------------------------------------------------------------------


def test_both_sides_together_are_the_input(spark):
    values = [None, "", "a"]
    df = spark.createDataFrame([(a, b) for a in values for b in values], "title string, title_key string")
    spec = QuarantineSpec.from_dict({"dataset_name": "books"})
    good, bad = eligible(df, spec), rejects(df, spec)
    assert rows(good.unionAll(bad.select(*df.columns))) == rows(df)
    assert good.filter("title IS NULL OR title_key IS NULL").count() == 0
    first = bad.filter("title IS NULL AND title_key IS NULL").first()
    assert (first.quarantine_reason, first.quarantine_stage, first.quarantine_entity) == (
        "missing_title_and_title_key",
        "silver",
        "books",
    )


def test_reason_of_other_columns(spark):
    df = spark.createDataFrame([(None, "k", 1), ("a", None, 1), ("a", "k", None)], "title string, title_key string, n int")
    spec = QuarantineSpec.from_dict(
        {"quarantine_entity": "e", "quarantine_stage": "s", "rules": {"require_non_null_columns": ["n"]}}
    )
    assert [r.quarantine_reason for r in rejects(df, spec).collect()] == ["quarantine_rule_matched"]
    bare = df.select("n")
    assert [r.quarantine_reason for r in rejects(bare, spec).collect()] == ["missing_n"]


def test_quarantine_validation(spark):
    with pytest.raises(ValueError):
        QuarantineSpec("e", required=())
    with pytest.raises(ValueError):
        eligible(spark.range(1), QuarantineSpec("e"))


# --- row-wise operators on a stream -----------------------------------------------------------


def test_row_wise_operators_take_a_stream(spark, tmp_path):
    raw = spark.createDataFrame([(" A ", "2013"), (None, "x")], "title string, day string")
    raw.write.parquet(str(tmp_path / "in"))
    spec = spec_of(
        {"source": "title", "target": "title", "trim": True},
        {"source": "title", "target": "title_key", "lower": True},
        {"source": "day", "target": "day", "parse_mode": "multi_format_date"},
    )
    flags = EnrichSpec.from_dict({"flag_rules": [{"source": "day", "target": "has_day", "rule": "is_not_null"}]})
    stream = spark.readStream.schema(raw.schema).parquet(str(tmp_path / "in"))
    out = eligible(enrich(standardize(stream, spec), flags), QuarantineSpec("e"))
    run = (
        out.writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "state"))
        .option("path", str(tmp_path / "out"))
        .trigger(availableNow=True)
        .start()
    )
    assert run.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).select("title", "day", "title_key", "has_day").collect() == [
        ("A", dt.date(2013, 1, 1), "a", True)
    ]


def test_no_python_udf_in_the_plan(spark):
    df = spark.createDataFrame([(" A ",)], "title string")
    spec = spec_of(bookstore.TITLE_KEY)
    plan = standardize(df, spec).select(F.col("title_key"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
