"""Casts, dates and epochs. Malformed input becomes null and never stops a job."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Layouts of a partial date: pattern, and what completes it to year-month-day.
DATE_LAYOUTS = (
    (r"^\d{4}-\d{2}-\d{2}$", ""),
    (r"^\d{4}-\d{2}$", "-01"),
    (r"^\d{4}$", "-01-01"),
)

# Seconds whose microseconds still fit a long.
MAX_EPOCH_SECONDS = 9_223_372_036_854


def convert(value: Column, target_type: str, via: str | None = None) -> Column:
    """Cast, if asked through another type first: ``'4.0'`` via double gives int 4."""
    if via:
        value = value.try_cast(via)
    return value.try_cast(target_type)


def partial_date(text: Column) -> Column:
    """Day, month or year as text -> date at the start of that span."""
    candidates = [
        F.when(text.rlike(pattern), F.try_to_date(F.concat(text, F.lit(rest)), "yyyy-MM-dd"))
        for pattern, rest in DATE_LAYOUTS
    ]
    return F.coalesce(*candidates)


def year_of(value: Column) -> Column:
    return F.year(value.try_cast("date"))


def epoch_timestamp(seconds: Column) -> Column:
    whole = seconds.try_cast("bigint")
    fits = whole.between(-MAX_EPOCH_SECONDS, MAX_EPOCH_SECONDS)
    return F.when(fits, F.timestamp_seconds(whole))


def day_of(moment: Column) -> Column:
    return moment.try_cast("date")


# Names a column rule may use. A parse mode fixes the result type by itself.
PARSE_MODES: dict[str, Callable[[Column], Column]] = {
    "multi_format_date": partial_date,
    "year_from_date": year_of,
    "unix_seconds_to_timestamp": epoch_timestamp,
    "timestamp_to_date": day_of,
}
