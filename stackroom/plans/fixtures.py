"""A messy catalogue and its reviews, derived from the test tables.

The test tables hold no nulls and no malformed text, so cleaning rules would have
nothing to do on them. These two queries spoil whole tables on the way in. They
run unchanged on Spark and on any engine that checks the results; ``{part}`` and
the like stand for the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RAW_BOOKS = """
SELECT p_partkey AS book_no,
 CASE WHEN p_partkey % 40 = 0 THEN NULL WHEN p_partkey % 40 = 1 THEN '   '
      WHEN p_partkey % 40 = 2 THEN '  ' || upper(p_name) || '   No ' || CAST(p_partkey AS STRING) || ' '
      WHEN p_partkey % 40 = 3 THEN p_name
      ELSE p_name || ' no ' || CAST(p_partkey AS STRING) END AS title,
 {description} AS description,
 CASE WHEN p_partkey % 6 = 0 THEN '' ELSE '[''' || p_brand || ''', ''' || p_name || ''']' END AS authors,
 'http://img/' || CAST(p_partkey AS STRING) AS image_url,
 CASE WHEN p_partkey % 11 = 0 THEN ' ' ELSE 'http://view/' || CAST(p_partkey AS STRING) || ' ' END AS preview_link,
 CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_type END AS publisher,
 CASE p_partkey % 7 WHEN 0 THEN '1995-03-17' WHEN 1 THEN '2001-11' WHEN 2 THEN '1987'
      WHEN 3 THEN '199?' WHEN 4 THEN '2013-02-30' WHEN 5 THEN ' 2999-01-01 ' ELSE NULL END AS published_date_raw,
 CAST(NULL AS STRING) AS info_link,
 CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE '[''' || p_type || ''']' END AS categories,
 CASE p_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'n/a' WHEN 2 THEN '-3.0' ELSE CAST(p_size AS STRING) || '.5' END
   AS ratings_count_raw
FROM {part}
"""

RAW_REVIEWS = """
SELECT l_orderkey AS review_no, l_linenumber AS review_line,
 CASE WHEN l_orderkey % 50 = 0 THEN NULL ELSE CAST(l_partkey AS STRING) END AS id,
 CASE WHEN l_partkey % 40 < 2 THEN NULL WHEN l_partkey % 40 = 3 THEN p_name
      WHEN l_orderkey % 97 = 0 OR l_partkey % 40 = 4 THEN 'unlisted ' || CAST(l_partkey AS STRING)
      ELSE p_name || ' no ' || CAST(l_partkey AS STRING) END AS title,
 CASE l_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '  ' ELSE CAST(l_partkey % 60 AS STRING) || '.5' END AS price_raw,
 CASE l_orderkey % 3 WHEN 0 THEN '' ELSE 'U' || CAST(l_suppkey AS STRING) END AS user_id,
 CASE WHEN l_orderkey % 7 = 0 THEN '   ' ELSE ' Reader ' || CAST(l_suppkey AS STRING) || ' ' END AS profile_name,
 CAST(l_linenumber AS STRING) || '/7' AS review_helpfulness,
 CASE WHEN l_orderkey % 101 = 0 THEN '6.0' WHEN l_orderkey % 103 = 0 THEN NULL
      WHEN l_partkey % 8 = 5 THEN '5.0'
      WHEN l_partkey % 8 = 6 THEN CAST(4 + l_orderkey % 2 AS STRING) || '.0'
      ELSE CAST((l_orderkey + l_linenumber) % 5 + 1 AS STRING) || '.0' END AS review_score_raw,
 CASE WHEN l_orderkey % 211 = 0 THEN NULL
      ELSE CAST(1000000000 + (l_orderkey * 7919 + l_linenumber * 86400) % 400000000 AS STRING) END AS review_time_raw,
 CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE l_returnflag || '  ' || l_linestatus END AS review_summary,
 {review_text} AS review_text
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
"""

# Whole documents where there is one with that number, elsewhere null; some are blank.
DESCRIPTION = "CASE WHEN p_partkey % 4 = 0 THEN '  ' ELSE text END"
REVIEW_TEXT = "CASE WHEN l_orderkey % 9 = 0 THEN '' ELSE text END"


def books_sql() -> str:
    return RAW_BOOKS.replace("{description}", DESCRIPTION) + "LEFT JOIN {documents} ON doc_id = p_partkey"


def reviews_sql(every_text: bool = False) -> str:
    """With ``every_text`` no text is blanked: all that documents hold goes through."""
    return RAW_REVIEWS.replace("{review_text}", "text" if every_text else REVIEW_TEXT) + "LEFT JOIN {documents} ON doc_id = l_orderkey"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _run(spark: SparkSession, folder: str, sql: str) -> DataFrame:
    names = [n for n in ("part", "lineitem", "documents") if "{" + n + "}" in sql]
    tables = {n: table(spark, folder, n) for n in names}
    return spark.sql(sql, **tables)


def raw_books(spark: SparkSession, folder: str) -> DataFrame:
    return _run(spark, folder, books_sql())


def raw_reviews(spark: SparkSession, folder: str, every_text: bool = False) -> DataFrame:
    return _run(spark, folder, reviews_sql(every_text))
