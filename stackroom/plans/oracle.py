"""The same results as plain SQL over the raw tables, to check the queries against.

Stages are common table expressions. Means are rounded on integers, because engines
break exact ties of ``ROUND(AVG(x), 2)`` differently.
"""

from __future__ import annotations

from stackroom.plans.fixtures import books_sql, reviews_sql

TABLES = ("part", "lineitem", "documents")


def _raw(sql: str) -> str:
    return sql.format(**{name: name for name in TABLES})


def _tidy(column: str) -> str:
    return f"nullif(trim({column}, ' '), '')"


def _key(column: str) -> str:
    return f"lower(nullif(trim(regexp_replace(trim({column}, ' '), '\\s+', ' ', 'g'), ' '), ''))"


def _whole(column: str, kind: str) -> str:
    return f"CAST(trunc(TRY_CAST({_tidy(column)} AS DOUBLE)) AS {kind})"


def _date(column: str) -> str:
    text = f"trim({column}, ' ')"
    layouts = (("\\d{4}-\\d{2}-\\d{2}", ""), ("\\d{4}-\\d{2}", "-01"), ("\\d{4}", "-01-01"))
    whens = " ".join(
        f"WHEN regexp_full_match({text}, '{pattern}') THEN CAST(try_strptime({text} || '{rest}', '%Y-%m-%d') AS DATE)"
        for pattern, rest in layouts
    )
    return f"CASE {whens} END"


def _mean(total: str, count: str, scale: int = 1) -> str:
    """round(total / scale / count, 2) by integers; total is not negative."""
    n, d = f"(200 // {scale}) * CAST({total} AS BIGINT)", f"CAST({count} AS BIGINT)"
    return f"CASE WHEN {count} > 0 THEN (({n} + {d}) // (2 * {d})) / 100.0 END"


def _percent(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} = 0 THEN 0.0 ELSE ((2000000 * {part} + {whole}) // (2 * {whole})) / 10000.0 END"


def _unblanked(column: str) -> str:
    return f"trim({column}, (SELECT string_agg(chr(CAST(i AS INTEGER)), '') FROM range(1, 33) t(i)))"


STD_BOOKS = f"""
SELECT book_no, {_tidy("title")} AS title, {_key("title")} AS title_key, {_tidy("description")} AS description,
 {_tidy("authors")} AS authors, {_tidy("image_url")} AS image_url, {_tidy("preview_link")} AS preview_link,
 {_tidy("publisher")} AS publisher, {_date("published_date_raw")} AS published_date,
 {_tidy("info_link")} AS info_link, {_tidy("categories")} AS categories,
 {_whole("ratings_count_raw", "INTEGER")} AS ratings_count
FROM raw_books"""

STD_REVIEWS = f"""
SELECT *, make_timestamp(review_time * 1000000) AS review_timestamp,
 CAST(make_timestamp(review_time * 1000000) AS DATE) AS review_date
FROM (SELECT review_no, review_line, id, {_tidy("id")} AS book_source_id, {_tidy("title")} AS title,
 {_key("title")} AS title_key, TRY_CAST({_tidy("price_raw")} AS DOUBLE) AS price, {_tidy("user_id")} AS user_id,
 {_tidy("profile_name")} AS profile_name, {_tidy("review_helpfulness")} AS review_helpfulness,
 {_whole("review_score_raw", "INTEGER")} AS review_score, {_whole("review_time_raw", "BIGINT")} AS review_time,
 {_tidy("review_summary")} AS review_summary, {_tidy("review_text")} AS review_text
FROM raw_reviews)"""

BOOK_FLAGS = ("description", "authors", "publisher", "published_date", "categories", "ratings_count")

SILVER_BOOKS = f"""
SELECT *, CAST({" + ".join(f"CAST(has_{c} AS INTEGER)" for c in BOOK_FLAGS)} AS INTEGER) AS completeness_score
FROM (SELECT *, {", ".join(f"{c} IS NOT NULL AS has_{c}" for c in BOOK_FLAGS)}
FROM (SELECT * REPLACE (coalesce(authors, 'Unknown') AS authors, coalesce(publisher, 'Unknown') AS publisher,
 coalesce(categories, 'Uncategorized') AS categories) FROM std_books))"""

SILVER_REVIEWS = """
SELECT *, price IS NOT NULL AS has_price, user_id IS NOT NULL AS has_user_id, review_text IS NOT NULL AS has_review_text
FROM (SELECT * REPLACE (coalesce(user_id, 'anonymous') AS user_id, coalesce(profile_name, 'anonymous') AS profile_name)
FROM std_reviews)"""

GOOD_BOOKS = "SELECT * FROM silver_books WHERE title IS NOT NULL AND title_key IS NOT NULL"


def _with(select: str, every_text: bool = False) -> str:
    """Put the stages that a select needs in front of it."""
    stages = (
        ("raw_books", _raw(books_sql())),
        ("raw_reviews", _raw(reviews_sql(every_text))),
        ("std_books", STD_BOOKS),
        ("std_reviews", STD_REVIEWS),
        ("silver_books", SILVER_BOOKS),
        ("silver_reviews", SILVER_REVIEWS),
        ("good_books", GOOD_BOOKS),
    )
    used, text = [], select
    for name, sql in reversed(stages):
        if name in text:
            used.insert(0, f"{name} AS ({sql})")
            text += sql
    return f"WITH {', '.join(used)} {select}" if used else select


def _line(dataset, dimension, name, kind, severity, source, failed) -> str:
    """One row of a check summary; ``failed`` counts failing rows of ``source``."""
    return f"""
SELECT '{dataset}' AS dataset_name, '{dimension}' AS quality_dimension, '{name}' AS check_name,
 '{kind}' AS check_type, '{severity}' AS severity, CASE WHEN f = 0 THEN 'passed' ELSE 'failed' END AS status,
 t AS total_rows, t - f AS passed_rows, f AS failed_rows, {_percent("f", "t")} AS failed_pct
FROM (SELECT count(*) AS t, CAST({failed} AS BIGINT) AS f FROM {source})"""


def _where(condition: str) -> str:
    return f"coalesce(sum(CASE WHEN {condition} THEN 1 ELSE 0 END), 0)"


def _monitor(dataset, source, *columns) -> list[str]:
    return [
        _line(dataset, "completeness", f"{c}_not_null_monitor", "not_null", "warning", source, _where(f"{c} IS NULL"))
        for c in columns
    ]


def _repeated(dataset, dimension, name, severity, source, *keys) -> str:
    key = ", ".join(keys)
    present = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    counted = f"(SELECT *, count(*) OVER (PARTITION BY {key}) AS same FROM {source})"
    return _line(
        dataset, dimension, name, "duplicate_key", severity, counted, _where(f"same > 1 AND {present}")
    )


B, R, SB, SR = "books_data", "books_rating", "silver_books", "silver_reviews"


def _date_past(dimension: str) -> str:
    failed = _where("published_date > CURRENT_DATE")
    return _line(B, dimension, "published_date_not_in_future", "not_in_future", "warning", SB, failed)


def _count_positive(dimension: str) -> str:
    failed = _where("ratings_count < 0")
    return _line(B, dimension, "ratings_count_non_negative", "non_negative", "warning", SB, failed)


def _review_validity(dimension: str) -> list[str]:
    return [
        _line(R, dimension, "book_source_id_not_null", "not_null", "critical", SR, _where("book_source_id IS NULL")),
        _line(
            R,
            dimension,
            "review_score_in_allowed_set",
            "value_in_set",
            "critical",
            SR,
            _where("review_score NOT IN (1, 2, 3, 4, 5)"),
        ),
        _line(
            R, dimension, "review_timestamp_not_null", "not_null", "critical", SR, _where("review_timestamp IS NULL")
        ),
        _line(R, dimension, "price_non_negative", "non_negative", "warning", SR, _where("price < 0")),
    ]


def _hash_present(dataset: str, dimension: str, source: str) -> str:
    # A hash is missing only where its key is, so nothing can fail. price_required_when_scored is the case that does.
    name = "title_hash_required_when_title_key_present"
    return _line(dataset, dimension, name, "requires_when_present", "warning", source, _where("FALSE"))


def _title_unique(dimension: str) -> str:
    return _repeated(B, dimension, "title_key_duplicate_monitor", "warning", SB, "title_key")


def _union(*parts: str) -> str:
    return " UNION ALL ".join(parts)


FLOW_CHECKS = (
    _date_past("completeness"),
    _count_positive("completeness"),
    _title_unique("completeness"),
    *_review_validity("completeness"),
    *_monitor(R, SR, "title", "title_key"),
    _hash_present(R, "completeness", SR),
)

BOOK_MONITORS = (
    "title", "title_key", "description", "authors", "publisher", "published_date", "categories", "ratings_count"
)
REVIEW_MONITORS = ("title", "title_key", "user_id", "profile_name", "price", "review_summary", "review_text")

def _failed(name: str, condition: str) -> str:
    return f"SELECT '{name}' AS check_name, {', '.join(BOOK_TYPES)} FROM silver_books WHERE {condition}"


SAMPLE_ORDER = "review_no, review_line, id, review_score, price, review_date, user_id"


def _sample(name: str, condition: str) -> str:
    return f"""
SELECT '{name}' AS check_name, review_no, review_line, id, {", ".join(REVIEW_TYPES)} FROM (
 SELECT *, row_number() OVER (ORDER BY {", ".join(f"{c} NULLS FIRST" for c in SAMPLE_ORDER.split(", "))}) AS place
 FROM silver_reviews WHERE {condition}) WHERE place <= 25"""


def _profile(source: str, columns: dict[str, str]) -> list[str]:
    return [
        f"SELECT {i} AS position, '{name}' AS column_name, '{kind}' AS data_type,"
        f" CAST(count(*) - count({name}) AS BIGINT) AS null_count, count(*) AS row_count FROM {source}"
        for i, (name, kind) in enumerate(columns.items(), start=1)
    ]


BOOK_TYPES = {
    "title": "string", "title_key": "string", "description": "string", "authors": "string", "image_url": "string",
    "preview_link": "string", "publisher": "string", "published_date": "date", "info_link": "string",
    "categories": "string", "ratings_count": "int", "has_description": "boolean", "has_authors": "boolean",
    "has_publisher": "boolean", "has_published_date": "boolean", "has_categories": "boolean",
    "has_ratings_count": "boolean", "completeness_score": "int",
}
REVIEW_TYPES = {
    "book_source_id": "string", "title": "string", "title_key": "string", "price": "double", "user_id": "string",
    "profile_name": "string", "review_helpfulness": "string", "review_score": "int", "review_time": "bigint",
    "review_timestamp": "timestamp", "review_date": "date", "review_summary": "string", "review_text": "string",
    "has_price": "boolean", "has_user_id": "boolean", "has_review_text": "boolean",
}

BOOK_COLUMNS = ", ".join(list(BOOK_TYPES)[:11])
REVIEW_COLUMNS = ", ".join(list(REVIEW_TYPES)[:13])


def _title_join(kind: str) -> str:
    return f"""SELECT coalesce(r.title_key, b.title_key) AS title_key, review_score, review_date, publisher,
 published_date FROM silver_reviews r {kind} JOIN silver_books b ON r.title_key = b.title_key"""


def _missing_keys() -> str:
    return """SELECT DISTINCT title_key AS relationship_key FROM silver_reviews WHERE title_key IS NOT NULL
 AND title_key NOT IN (SELECT title_key FROM good_books)"""


def _coverage(name, left, left_key, right, right_key, severity, left_keys, right_keys) -> str:
    return f"""
SELECT '{name}' AS check_name, '{left}' AS left_dataset_name, '{right}' AS right_dataset_name,
 '{left_key}' AS left_key, '{right_key}' AS right_key, '{severity}' AS severity,
 CASE WHEN m = 0 THEN 'passed' ELSE 'failed' END AS status, t AS left_total_keys, t - m AS matched_keys,
 m AS missing_keys, {_percent("m", "t")} AS missing_pct
FROM (SELECT count(*) AS t, CAST(coalesce(sum(CASE WHEN r.k IS NULL THEN 1 ELSE 0 END), 0) AS BIGINT) AS m
 FROM ({left_keys}) l LEFT JOIN ({right_keys}) r ON l.k = r.k)"""


def _distinct(key: str, source: str) -> str:
    return f"SELECT DISTINCT {key} AS k FROM {source} WHERE {key} IS NOT NULL"


BARE_AUTHORS = "replace(replace(replace(authors, '[', ''), ']', ''), '''', '')"
BARE_CATEGORIES = "replace(replace(categories, '[''', ''), ''']', '')"

# Prices end in .5, so twice a price is whole.
PERFORMANCE = f"""
SELECT title, {BARE_AUTHORS} AS authors, publisher, published_date, {BARE_CATEGORIES} AS categories, ratings_count,
 completeness_score, coalesce(review_count, 0) AS review_count, avg_review_score, min_review_score, max_review_score,
 first_review_date, last_review_date, avg_price, min_price, max_price,
 CASE WHEN coalesce(review_count, 0) = 0 THEN 'No Reviews' WHEN avg_review_score >= 4.5 THEN 'Excellent'
 WHEN avg_review_score >= 4.0 THEN 'Good' WHEN avg_review_score >= 3.0 THEN 'Average' ELSE 'Low' END AS rating_band
FROM good_books b LEFT JOIN (SELECT title_key, count(*) AS review_count,
 {_mean("sum(review_score)", "count(review_score)")} AS avg_review_score, min(review_score) AS min_review_score,
 max(review_score) AS max_review_score, min(review_date) AS first_review_date, max(review_date) AS last_review_date,
 {_mean("sum(2 * price)", "count(price)", 2)} AS avg_price, min(price) AS min_price, max(price) AS max_price
 FROM silver_reviews GROUP BY title_key) r ON b.title_key = r.title_key"""

CATEGORIES = f"""SELECT {BARE_CATEGORIES} AS categories, count(DISTINCT b.title_key) AS book_count,
 count(review_score) AS review_count, {_mean("sum(review_score)", "count(review_score)")} AS avg_review_score
 FROM good_books b LEFT JOIN silver_reviews r ON b.title_key = r.title_key GROUP BY {BARE_CATEGORIES}"""

DAILY = f"""SELECT review_date, count(*) AS review_count, count(DISTINCT title_key) AS reviewed_book_count,
 {_mean("sum(review_score)", "count(review_score)")} AS avg_review_score,
 {_mean("sum(2 * price)", "count(price)", 2)} AS avg_price, count(price) AS priced_review_count
 FROM silver_reviews WHERE review_date IS NOT NULL GROUP BY review_date"""


def _corrected(report: str) -> str:
    """The report as it is with every score of 1 a 2."""
    scores = "(SELECT * REPLACE (CASE WHEN review_score = 1 THEN 2 ELSE review_score END AS review_score) FROM silver_reviews)"
    return report.replace("silver_reviews", scores)


REJECTS = f"""SELECT {", ".join(BOOK_TYPES)},
 CASE WHEN title IS NULL AND title_key IS NULL THEN 'missing_title_and_title_key'
 WHEN title IS NULL THEN 'missing_title' WHEN title_key IS NULL THEN 'missing_title_key'
 ELSE 'quarantine_rule_matched' END AS quarantine_reason, 'silver' AS quarantine_stage,
 'books_data' AS quarantine_entity
 FROM silver_books WHERE title IS NULL OR title_key IS NULL OR published_date IS NULL"""

ORACLE_SQL: dict[str, str] = {
    "csv_ingest": "SELECT trim(text, (SELECT string_agg(chr(CAST(i AS INTEGER)), '') FROM range(1, 33) t(i))) AS text,"
    " CAST(doc_id AS VARCHAR) AS doc_id, lang AS language, source FROM documents",
    "csv_one_file": f"SELECT lang AS language, {_unblanked('text || text')} AS twice, {_unblanked('text')} AS text,"
    " CAST(doc_id AS VARCHAR) AS doc_id, TRUE AS in_ranges FROM documents",
    "csv_bad_records": f"""WITH r AS (SELECT *, '"' || replace(text, '"', '""') || '"' AS q, doc_id % 7 AS kind FROM documents)
SELECT {_unblanked("text")} AS text, CAST(doc_id AS VARCHAR) AS doc_id, lang, '' AS reasons FROM r WHERE kind NOT IN (3, 4, 5)
UNION ALL SELECT CASE kind WHEN 3 THEN q || ',' || doc_id || ',' || lang || ',extra' WHEN 4 THEN q
 ELSE q || 'tail,' || doc_id || ',' || lang END, NULL, NULL, CASE WHEN kind = 5 THEN 'quotes' ELSE 'columns' END FROM r WHERE kind IN (3, 4, 5)""",
    "csv_table": "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,"
    " o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders",
    "sink_orc_partitioned": "SELECT * FROM lineitem",
    "sink_file_layout": "SELECT l_returnflag, count(*) AS rows, TRUE AS capped, TRUE AS spread FROM lineitem GROUP BY l_returnflag",
    **{
        name: """SELECT CASE WHEN l_orderkey % 2 = 0 THEN 'any' ELSE 'line ' || l_linenumber END AS mode, count(*) AS rows, TRUE AS sized
 FROM lineitem GROUP BY 1"""
        for name in ("sink_sized_folders", "sink_sized_packed")
    },
    "sink_report": _with(
        "SELECT *, failed_rows AS stored_rows FROM ("
        + _union(
            _date_past("validity"),
            _count_positive("validity"),
            _line(B, "validity", "score_not_negative", "non_negative", "critical", SB, _where("completeness_score < 0")),
        )
        + ")"
    ),
    "sink_snapshot": "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey, CAST(s_acctbal AS VARCHAR) AS s_acctbal"
    " FROM supplier ORDER BY s_name LIMIT 25",
    "standardize_books": _with(f"SELECT book_no, {BOOK_COLUMNS} FROM std_books"),
    "standardize_reviews": _with(f"SELECT {REVIEW_COLUMNS} FROM std_reviews", every_text=True),
    "standardize_append": _with(
        f"""SELECT book_no, lower({_tidy("title")}) AS title, authors, publisher, published_date_raw, categories,
 ratings_count_raw, {_date("published_date_raw")} AS published_date,
 CAST(year({_date("published_date_raw")}) AS INTEGER) AS published_year,
 TRY_CAST(ratings_count_raw AS DOUBLE) AS ratings_count FROM raw_books"""
    ),
    "fill_defaults": _with(f"SELECT {BOOK_COLUMNS} FROM silver_books"),
    "fill_defaults_raw": _with(
        """SELECT * REPLACE (
 CASE WHEN coalesce(trim(user_id, ' '), '') = '' THEN 'anonymous' ELSE user_id END AS user_id,
 CASE WHEN coalesce(trim(profile_name, ' '), '') = '' THEN 'anonymous' ELSE profile_name END AS profile_name)
 FROM raw_reviews"""
    ),
    "enrich_books": _with(
        f"SELECT {', '.join(BOOK_TYPES)} FROM silver_books"    ),
    "enrich_reviews": _with(
        f"SELECT {', '.join(REVIEW_TYPES)} FROM silver_reviews"
    ),
    "hash_key": _with(
        """SELECT title_key, title_key IS NOT NULL AS has_hash, count(DISTINCT title_key) AS hashes, count(*) AS books
 FROM std_books GROUP BY title_key"""
    ),
    "surrogate_key": """SELECT p_partkey, p_name, p_brand, 99 + dense_rank() OVER (ORDER BY p_name) AS name_key
 FROM part""",
    "surrogate_key_batches": """WITH first AS (SELECT l_orderkey, dense_rank() OVER (ORDER BY l_orderkey) AS no FROM (
  SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R')),
rest AS (SELECT l_orderkey, (SELECT count(*) FROM first) + row_number() OVER (ORDER BY l_orderkey) AS no FROM (
  SELECT DISTINCT l_orderkey FROM lineitem WHERE l_orderkey NOT IN (SELECT l_orderkey FROM first)))
SELECT l.*, no AS order_no FROM lineitem l JOIN (SELECT * FROM first UNION ALL SELECT * FROM rest) k USING (l_orderkey)""",
    "surrogate_key_unique": _with(
        """SELECT book_no, image_url, CASE WHEN preview_link IS NOT NULL THEN
 dense_rank() OVER (ORDER BY preview_link NULLS LAST) END AS link_key FROM std_books"""
    ),
    "quarantine_eligible": _with(
        f"""SELECT {BOOK_COLUMNS}, {", ".join(f"has_{c}" for c in BOOK_FLAGS)}, completeness_score FROM good_books"""
    ),
    "quarantine_rejects": _with(REJECTS),
    "dq_summary_completeness": _with(_union(*_monitor(B, SB, *BOOK_MONITORS), *_monitor(R, SR, *REVIEW_MONITORS))),
    "dq_summary_validity": _with(
        _union(_date_past("validity"), _count_positive("validity"), *_review_validity("validity"))
    ),
    "dq_summary_consistency": _with(
        _union(
            _hash_present(B, "consistency", SB),
            _hash_present(R, "consistency", SR),
            _line(
                R,
                "consistency",
                "price_required_when_scored",
                "requires_when_present",
                "critical",
                SR,
                _where("review_score IS NOT NULL AND price IS NULL"),
            ),
        )
    ),
    "dq_summary_uniqueness": _with(
        _union(
            _title_unique("uniqueness"),
            _repeated(R, "uniqueness", "book_source_id_duplicate_monitor", "warning", SR, "book_source_id"),
            _repeated(
                "lineitem", "uniqueness", "order_line_unique", "critical", "lineitem", "l_orderkey", "l_linenumber"
            ),
            _line(
                "lineitem",
                "validity",
                "quantity_non_negative",
                "non_negative",
                "warning",
                "lineitem",
                _where("l_quantity < 0"),
            ),
        )
    ),
    "dq_failed_rows": _with(
        _union(
            _failed("published_date_not_in_future", "published_date > CURRENT_DATE"),
            _failed("ratings_count_non_negative", "ratings_count < 0"),
            _failed(
                "title_key_duplicate_monitor",
                "title_key IN (SELECT title_key FROM silver_books GROUP BY title_key HAVING count(*) > 1)",
            ),
            *[_failed(f"{c}_not_null_monitor", f"{c} IS NULL") for c in BOOK_MONITORS],
        )
    ),
    "dq_failed_sample": _with(
        _union(
            _sample("book_source_id_not_null", "book_source_id IS NULL"),
            _sample("review_score_in_allowed_set", "review_score NOT IN (1, 2, 3, 4, 5)"),
            _sample("review_timestamp_not_null", "review_timestamp IS NULL"),
            _sample("price_non_negative", "price < 0"),
        )
    ),
    "dq_failed_duplicate_key": """SELECT l.* FROM lineitem l JOIN (SELECT l_orderkey, l_linenumber FROM lineitem
 GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) d
 ON l.l_orderkey = d.l_orderkey AND l.l_linenumber = d.l_linenumber""",
    "dq_gate_rollup": _with(
        f"""SELECT dataset_name, severity, status, count(*) AS checks, CAST(sum(failed_rows) AS BIGINT) AS failed_rows
 FROM ({_union(*FLOW_CHECKS)}) GROUP BY dataset_name, severity, status"""
    ),
    "relationship_summary": _with(
        _union(
            _coverage(
                "books_rating_title_hash_must_exist_in_books_data",
                R,
                "title_hash",
                B,
                "title_hash",
                "critical",
                _distinct("title_key", SR),
                _distinct("title_key", "good_books"),
            ),
            _coverage(
                "line_part_must_exist",
                "lineitem",
                "l_partkey",
                "part",
                "p_partkey",
                "warning",
                _distinct("l_partkey", "lineitem"),
                _distinct("p_partkey", "part"),
            ),
        )
    ),
    "relationship_missing_keys": _with(_missing_keys()),
    "relationship_sample": _with(
        f"SELECT relationship_key FROM ({_missing_keys()}) ORDER BY relationship_key LIMIT 20"
    ),
    "table_profile": _with(_union(*_profile(SB, BOOK_TYPES), *_profile(SR, REVIEW_TYPES))),
    "table_head": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 20",
    "serve_books_analytics": _with(
        """SELECT title, description, authors, publisher, published_date, categories, ratings_count, completeness_score
 FROM good_books"""    ),
    "serve_reviews_analytics": _with(
        "SELECT title, price, review_score, review_timestamp, review_date, review_summary FROM silver_reviews"
    ),
    "serve_reviews_science": _with(
        """SELECT book_source_id, title_key, title, review_score, review_timestamp, review_date, review_summary,
 review_text FROM silver_reviews"""    ),
    **{
        f"serve_filter_{name}": f"""SELECT d.doc_id, text, lang, quality, toxic FROM documents d
 LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE quality IS {condition} AND lang IS NOT NULL"""
        for name, condition in (("not_null", "NOT NULL"), ("null", "NULL"))
    },
    **{f"serve_join_{kind}": _with(_title_join(kind)) for kind in ("inner", "left", "right", "full")},
    **{
        f"serve_join_{name}": _with(
            f"""SELECT title_key, review_score, review_date FROM silver_reviews r
 WHERE {test} (SELECT 1 FROM silver_books b WHERE b.title_key = r.title_key)"""
        )
        for name, test in (("semi", "EXISTS"), ("anti", "NOT EXISTS"))
    },
    "serve_join_diff_keys": _with(
        """SELECT r.title_key, price, categories, authors FROM silver_reviews r
 RIGHT JOIN silver_books b ON r.title_key = b.title_key"""
    ),
    "serve_join_chain": """SELECT l_orderkey, l_linenumber, o_orderstatus, c_name, n_name, r_name FROM lineitem
 LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
 LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
    "serve_dedupe": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity FROM (
 SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
 ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity) AS place FROM lineitem) WHERE place = 1""",
    "serve_dedupe_text": """SELECT doc_id, text, lang, source FROM (
 SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS place FROM documents) WHERE place = 1""",
    "stream_silver_reviews": _with(f"SELECT {', '.join(REVIEW_TYPES)} FROM silver_reviews"),
    "stream_quarantine": _with(REJECTS),
    "stream_duplicate_key": "SELECT * FROM part QUALIFY count(*) OVER (PARTITION BY p_name) > 1",
    "view_book_performance": _with(PERFORMANCE),
    "view_category_summary": _with(CATEGORIES),
    "view_review_daily": _with(DAILY),
    "view_book_performance_batches": _with(_corrected(PERFORMANCE)),
    "view_category_summary_batches": _with(_corrected(CATEGORIES)),
    "view_review_daily_batches": _with(_corrected(DAILY)),
    "medallion_end_to_end": _with(PERFORMANCE),
    "medallion_resumed": _with(f"SELECT *, 3 AS layers_kept, 6 AS layers_built FROM ({PERFORMANCE})"),
}
