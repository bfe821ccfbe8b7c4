"""Rules for a book catalogue and its reviews.

Fixed values throughout: column names, default texts, check names, allowed
scores and severities have to be these for results to agree.
"""

from __future__ import annotations

from typing import Any

from stackroom.operators.checks import CheckSuite
from stackroom.operators.defaults import fill_rules
from stackroom.operators.enrich import EnrichSpec
from stackroom.operators.quarantine import QuarantineSpec
from stackroom.operators.relationship import RelationshipSpec
from stackroom.operators.serving import ServingSpec
from stackroom.operators.standardize import StandardizeSpec
from stackroom.sources.raw_csv import CsvContract

BOOKS, REVIEWS = "books_data", "books_rating"


def _contract(columns: dict[str, str]) -> CsvContract:
    return CsvContract(tuple(columns.items()))


BOOKS_CONTRACT = _contract(
    {
        "Title": "title",
        "description": "description",
        "authors": "authors",
        "image": "image_url",
        "previewLink": "preview_link",
        "publisher": "publisher",
        "publishedDate": "published_date_raw",
        "infoLink": "info_link",
        "categories": "categories",
        "ratingsCount": "ratings_count_raw",
    }
)

REVIEWS_CONTRACT = _contract(
    {
        "Id": "id",
        "Title": "title",
        "Price": "price_raw",
        "User_id": "user_id",
        "profileName": "profile_name",
        "review/helpfulness": "review_helpfulness",
        "review/score": "review_score_raw",
        "review/time": "review_time_raw",
        "review/summary": "review_summary",
        "review/text": "review_text",
    }
)


def _tidy(source: str, target: str = "", target_type: str = "string", **more: Any) -> dict[str, Any]:
    """A trimmed column in which blank means null."""
    return {
        "source": source,
        "target": target or source,
        "target_type": target_type,
        "trim": True,
        "blank_to_null": True,
        **more,
    }


TITLE_KEY = _tidy("title", "title_key", collapse_spaces=True, lower=True)

BOOKS_SILVER = StandardizeSpec.from_dict(
    {
        "output_mode": "select_targets_only",
        "column_rules": [
            _tidy("title"),
            TITLE_KEY,
            _tidy("description"),
            _tidy("authors"),
            _tidy("image_url"),
            _tidy("preview_link"),
            _tidy("publisher"),
            _tidy("published_date_raw", "published_date", "date", parse_mode="multi_format_date"),
            _tidy("info_link"),
            _tidy("categories"),
            _tidy("ratings_count_raw", "ratings_count", "int", cast_via="double"),
        ],
    }
)

REVIEWS_SILVER = StandardizeSpec.from_dict(
    {
        "output_mode": "select_targets_only",
        "column_rules": [
            _tidy("id", "book_source_id"),
            _tidy("title"),
            TITLE_KEY,
            _tidy("price_raw", "price", "double"),
            _tidy("user_id"),
            _tidy("profile_name"),
            _tidy("review_helpfulness"),
            _tidy("review_score_raw", "review_score", "int", cast_via="double"),
            _tidy("review_time_raw", "review_time", "long", cast_via="double"),
            {
                "source": "review_time",
                "target": "review_timestamp",
                "target_type": "timestamp",
                "parse_mode": "unix_seconds_to_timestamp",
            },
            {
                "source": "review_timestamp",
                "target": "review_date",
                "target_type": "date",
                "parse_mode": "timestamp_to_date",
            },
            _tidy("review_summary"),
            _tidy("review_text"),
        ],
    }
)

BOOKS_DEFAULTS = fill_rules(
    {
        "fill_rules": [
            {"column": "authors", "value": "Unknown"},
            {"column": "publisher", "value": "Unknown"},
            {"column": "categories", "value": "Uncategorized"},
        ]
    }
)
REVIEWS_DEFAULTS = {"user_id": "anonymous", "profile_name": "anonymous"}

_TITLE_HASH = {"source": "title_key", "target": "title_hash", "method": "xxhash64"}


def _flags(*columns: str) -> list[dict[str, str]]:
    return [{"source": c, "target": f"has_{c}", "rule": "is_not_null"} for c in columns]


_BOOK_FLAGS = _flags("description", "authors", "publisher", "published_date", "categories", "ratings_count")

BOOKS_QUALITY = EnrichSpec.from_dict(
    {
        "hash_rules": [_TITLE_HASH],
        "flag_rules": _BOOK_FLAGS,
        "score_rules": [
            {
                "target": "completeness_score",
                "method": "sum_flags",
                "sources": [flag["target"] for flag in _BOOK_FLAGS],
            }
        ],
    }
)
REVIEWS_QUALITY = EnrichSpec.from_dict(
    {"hash_rules": [_TITLE_HASH], "flag_rules": _flags("price", "user_id", "review_text")}
)

BOOKS_QUARANTINE = QuarantineSpec(entity=BOOKS)


def _monitors(*columns: str) -> list[dict[str, Any]]:
    return [
        {"name": f"{c}_not_null_monitor", "type": "not_null", "column": c, "severity": "warning"} for c in columns
    ]


def _suite(dataset: str, dimension: str, *checks: dict[str, Any]) -> CheckSuite:
    return CheckSuite.from_dict({"dataset_name": dataset, "quality_dimension": dimension, "checks": list(checks)})


_HASH_PRESENT = {
    "name": "title_hash_required_when_title_key_present",
    "type": "requires_when_present",
    "required_column": "title_hash",
    "when_present_column": "title_key",
    "severity": "warning",
}
_DATE_PAST = {
    "name": "published_date_not_in_future",
    "type": "not_in_future",
    "column": "published_date",
    "severity": "warning",
}
_COUNT_POSITIVE = {
    "name": "ratings_count_non_negative",
    "type": "non_negative",
    "column": "ratings_count",
    "severity": "warning",
}
_TITLE_UNIQUE = {
    "name": "title_key_duplicate_monitor",
    "type": "duplicate_key",
    "key_columns": ["title_key"],
    "severity": "warning",
}
_ID_PRESENT = {
    "name": "book_source_id_not_null",
    "type": "not_null",
    "column": "book_source_id",
    "severity": "critical",
}
_SCORE_ALLOWED = {
    "name": "review_score_in_allowed_set",
    "type": "value_in_set",
    "column": "review_score",
    "allowed_values": [1, 2, 3, 4, 5],
    "severity": "critical",
}
_TIME_PRESENT = {
    "name": "review_timestamp_not_null",
    "type": "not_null",
    "column": "review_timestamp",
    "severity": "critical",
}
_PRICE_POSITIVE = {
    "name": "price_non_negative",
    "type": "non_negative",
    "column": "price",
    "severity": "warning",
}
_ID_UNIQUE = {
    "name": "book_source_id_duplicate_monitor",
    "type": "duplicate_key",
    "key_columns": ["book_source_id"],
    "severity": "warning",
}

# The suites that the flow runs.
BOOKS_CHECKS = _suite(BOOKS, "completeness", _DATE_PAST, _COUNT_POSITIVE, _TITLE_UNIQUE)
REVIEWS_CHECKS = _suite(
    REVIEWS,
    "completeness",
    _ID_PRESENT,
    _SCORE_ALLOWED,
    _TIME_PRESENT,
    *_monitors("title", "title_key"),
    _PRICE_POSITIVE,
    _HASH_PRESENT,
)

# One suite per dimension, for monitoring.
BOOKS_COMPLETENESS = _suite(
    BOOKS,
    "completeness",
    *_monitors(
        "title", "title_key", "description", "authors", "publisher", "published_date", "categories", "ratings_count"
    ),
)
BOOKS_VALIDITY = _suite(BOOKS, "validity", _DATE_PAST, _COUNT_POSITIVE)
BOOKS_CONSISTENCY = _suite(BOOKS, "consistency", _HASH_PRESENT)
BOOKS_UNIQUENESS = _suite(BOOKS, "uniqueness", _TITLE_UNIQUE)
REVIEWS_COMPLETENESS = _suite(
    REVIEWS,
    "completeness",
    *_monitors("title", "title_key", "user_id", "profile_name", "price", "review_summary", "review_text"),
)
REVIEWS_VALIDITY = _suite(REVIEWS, "validity", _ID_PRESENT, _SCORE_ALLOWED, _TIME_PRESENT, _PRICE_POSITIVE)
REVIEWS_CONSISTENCY = _suite(REVIEWS, "consistency", _HASH_PRESENT)
REVIEWS_UNIQUENESS = _suite(REVIEWS, "uniqueness", _ID_UNIQUE)

TITLE_RELATIONSHIP = RelationshipSpec(
    check_name="books_rating_title_hash_must_exist_in_books_data",
    left_dataset_name=REVIEWS,
    left_key="title_hash",
    right_dataset_name=BOOKS,
    right_key="title_hash",
    severity="critical",
)

BOOKS_ANALYTICS = ServingSpec(
    base_input="books",
    select_columns=(
        "title",
        "description",
        "authors",
        "publisher",
        "published_date",
        "categories",
        "ratings_count",
        "completeness_score",
        "title_hash",
    ),
)
REVIEWS_ANALYTICS = ServingSpec(
    base_input="reviews",
    select_columns=(
        "title",
        "price",
        "review_score",
        "review_timestamp",
        "review_date",
        "review_summary",
        "title_hash",
    ),
)
REVIEWS_SCIENCE = ServingSpec(
    base_input="reviews",
    select_columns=(
        "book_source_id",
        "title_key",
        "title",
        "review_score",
        "review_timestamp",
        "review_date",
        "review_summary",
        "review_text",
        "title_hash",
    ),
)
