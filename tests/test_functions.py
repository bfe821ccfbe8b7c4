"""Column builders on small literal values."""

import datetime as dt
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from stackroom.functions import parsing, scoring, text


def apply(spark, build, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in df.select("i", build(F.col("v")).alias("out")).orderBy("i").collect()]


def test_collapse_turns_runs_into_one_space(spark):
    rng = random.Random(7)
    values = ["".join(rng.choice(" \t\n\r\f\vAb") for _ in range(rng.randint(0, 12))) for _ in range(800)]
    expected = [re.sub(r"[ \t\n\x0b\f\r]+", " ", v).strip(" ") for v in values]
    assert apply(spark, text.collapse, values) == expected


def test_trim_keeps_tabs_and_no_break_spaces(spark):
    assert apply(spark, F.trim, [" \ta\t ", "  a ", None]) == ["\ta\t", " a", None]


def test_blank_to_null(spark):
    assert apply(spark, text.empty_to_null, ["", " ", "a", None]) == [None, " ", "a", None]
    assert apply(spark, text.blank_to_null, ["", " ", "a", None]) == [None, " ", "a", None]
    assert apply(spark, text.blank_to_null, [0, None, 5], "long") == [0, None, 5]


def test_fill_blank_keeps_other_values(spark):
    fill = lambda c: text.fill_blank(c, "none")
    assert apply(spark, fill, [None, "", "  ", " a ", "\t"]) == ["none", "none", "none", " a ", "\t"]


def test_list_text(spark):
    values = ["['A', \"B's\"]", "plain", None, "[]"]
    assert apply(spark, text.bare_names, values) == ['A, "Bs"', "plain", None, ""]
    assert apply(spark, text.bare_labels, ["['A', 'B']", "['A']", "A", None]) == ["A', 'B", "A", "A", None]


def test_partial_date(spark):
    cases = {
        "2013-05-01": dt.date(2013, 5, 1),
        "2013-05": dt.date(2013, 5, 1),
        "2013": dt.date(2013, 1, 1),
        "1000-01-01": dt.date(1000, 1, 1),
        "2012-02-29": dt.date(2012, 2, 29),
        "2013-02-30": None,
        "2013-13": None,
        "199?": None,
        "2013-5-1": None,
        " 2013": None,
        "2013-05-01T00": None,
        "": None,
        None: None,
    }
    assert apply(spark, parsing.partial_date, list(cases)) == list(cases.values())


def test_convert_through_double(spark):
    values = ["4.0", "-3.7", "abc", "5d", "NaN", "1e20", "", None, "12"]
    as_int = lambda c: parsing.convert(c, "int", "double")
    assert apply(spark, as_int, values) == [4, -3, None, 5, None, None, None, None, 12]
    as_long = lambda c: parsing.convert(c, "long", "double")
    assert apply(spark, as_long, ["1e12", "3000000000.9", "x"]) == [10**12, 3_000_000_000, None]


def test_epoch_and_day(spark):
    moments = [0, -1, 1_000_000_000, None, 2**63 - 1]
    clock = lambda c: parsing.epoch_timestamp(c).cast("string")
    assert apply(spark, clock, moments, "long") == [
        "1970-01-01 00:00:00",
        "1969-12-31 23:59:59",
        "2001-09-09 01:46:40",
        None,
        None,
    ]
    day = lambda c: parsing.day_of(parsing.epoch_timestamp(c))
    assert apply(spark, day, moments[:4], "long") == [
        dt.date(1970, 1, 1),
        dt.date(1969, 12, 31),
        dt.date(2001, 9, 9),
        None,
    ]


def test_year(spark):
    assert apply(spark, lambda c: parsing.year_of(c.cast("date")), ["2013-05-01", None]) == [2013, None]
    assert apply(spark, parsing.year_of, ["2013-05-01", "no date"]) == [2013, None]


def test_hash_is_seeded_xxhash64_and_keeps_null(spark):
    values = ["", "a", "münchen", "x" * 100, None]

    def signed(value):
        n = xxhash.xxh64_intdigest(value.encode(), seed=42)
        return n - 2**64 if n >= 2**63 else n

    assert apply(spark, scoring.null_safe_hash, values) == [signed(v) for v in values[:-1]] + [None]


def test_count_true(spark):
    df = spark.createDataFrame([(True, None, True), (False, None, None)], "a boolean, b boolean, c boolean")
    out = df.select(scoring.count_true([F.col("a"), F.col("b"), F.col("c")]).alias("n"))
    assert [r.n for r in out.collect()] == [2, 0]
    assert out.dtypes == [("n", "int")]


@pytest.mark.parametrize(
    "count, mean, band",
    [
        (0, None, "No Reviews"),
        (3, None, "Low"),
        (3, 4.5, "Excellent"),
        (3, 4.49, "Good"),
        (3, 4.0, "Good"),
        (3, 3.99, "Average"),
        (3, 3.0, "Average"),
        (3, 2.99, "Low"),
    ],
)
def test_rating_band(spark, count, mean, band):
    df = spark.createDataFrame([(count, mean)], "n long, mean double")
    assert df.select(scoring.rating_band(F.col("n"), F.col("mean"))).first()[0] == band


def test_percent_of_nothing_is_zero(spark):
    df = spark.createDataFrame([(0, 0), (1, 3), (2, 2)], "part long, whole long")
    assert [r[0] for r in df.select(scoring.percent(F.col("part"), F.col("whole"))).collect()] == [0.0, 33.3333, 100.0]


def test_missing_reason(spark):
    df = spark.createDataFrame([(None, None), (None, "k"), ("t", None), ("t", "k")], "title string, title_key string")
    out = df.select(scoring.missing_reason(("title", "title_key"), "other"))
    assert [r[0] for r in out.collect()] == [
        "missing_title_and_title_key",
        "missing_title",
        "missing_title_key",
        "other",
    ]
