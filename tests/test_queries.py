"""Every registered query against its SQL."""

import pytest
from conftest import tables_dir
from oracle import compare, connect

import __spark_entry__ as entry
from stackroom.plans.oracle import ORACLE_SQL as SQL
from stackroom.plans.queries import QUERIES

# Queries whose result on these tables is known to have no rows.
EMPTY: set[str] = set()


@pytest.fixture(scope="module")
def con():
    return connect(tables_dir())


def test_every_query_has_sql():
    assert sorted(QUERIES) == sorted(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    more, less, count, _ = compare(QUERIES[name](spark, tables_dir()), con, SQL[name])
    assert not more and not less, (list(more)[:3], list(less)[:3])
    assert count or name in EMPTY


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert {"title", "rating_band", "avg_review_score"} <= set(df.columns)


def test_standardize_reviews_takes_every_text(spark, con):
    texts = "SELECT count(*), sum(length(trim(text, ' '))) FROM lineitem JOIN documents ON l_orderkey = doc_id WHERE trim(text, ' ') <> ''"
    found = QUERIES["standardize_reviews"](spark, tables_dir()).selectExpr("count(review_text)", "sum(char_length(review_text))").first()
    whole = con.execute(texts).fetchone()
    assert tuple(found) == whole
