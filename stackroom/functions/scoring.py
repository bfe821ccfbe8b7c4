"""Hashes, flags, scores, bands and reasons."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from stackroom.functions.columns import field

# Lowest rounded mean of each band, best first.
RATING_BANDS = ((4.5, "Excellent"), (4.0, "Good"), (3.0, "Average"))
LOWEST_BAND = "Low"
UNRATED_BAND = "No Reviews"


def null_safe_hash(value: Column) -> Column:
    """xxhash64 that keeps null as null (plain ``xxhash64(null)`` is the seed)."""
    return F.when(value.isNotNull(), F.xxhash64(value))


def is_present(value: Column) -> Column:
    return value.isNotNull()


def count_true(flags: Iterable[Column]) -> Column:
    """How many flags of a row are true; null counts as not true."""
    return sum((F.when(flag, 1).otherwise(0) for flag in flags), F.lit(0)).cast("int")


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.round(part / whole * 100, 4)).otherwise(F.lit(0.0))


def rounded_mean(total: Column, count: Column) -> Column:
    return F.round(F.when(count > 0, total / count), 2)


def rating_band(review_count: Column, mean_score: Column) -> Column:
    band = F.when(review_count == 0, UNRATED_BAND)
    for lowest, label in RATING_BANDS:
        band = band.when(mean_score >= lowest, label)
    return band.otherwise(LOWEST_BAND)


def missing_reason(names: Iterable[str], otherwise: str) -> Column:
    """``missing_a``, ``missing_b`` or ``missing_a_and_b``, after the columns that are null."""
    absent = F.array_compact(F.array(*[F.when(field(n).isNull(), F.lit(n)) for n in names]))
    return F.when(F.size(absent) == 0, F.lit(otherwise)).otherwise(
        F.concat(F.lit("missing_"), F.array_join(absent, "_and_"))
    )
