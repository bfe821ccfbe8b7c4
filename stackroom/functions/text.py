"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Runs of white space that are not already one plain space. Text without any is not rebuilt.
UNEVEN_SPACE = r"\s{2,}|[^\S ]"


def collapse(text: Column) -> Column:
    """Turn every run of white space into one space and drop it at the edges."""
    return F.trim(F.regexp_replace(text, UNEVEN_SPACE, " "))


def empty_to_null(text: Column) -> Column:
    """For text only. ``nullif`` works its input out once, ``when`` would do so twice."""
    return F.nullif(text, F.lit(""))


def blank_to_null(value: Column) -> Column:
    """The same for a column of any type: numbers and dates pass through with their type."""
    return F.when(value.cast("string") != "", value)


def is_blank(text: Column) -> Column:
    return text.isNull() | (F.trim(text) == "")


def fill_blank(text: Column, default: str) -> Column:
    """Replace null or blank text; anything else stays as it is, edges included."""
    return F.when(is_blank(text), F.lit(default)).otherwise(text)


def bare_names(text: Column) -> Column:
    """``['A', 'B']`` -> ``A, B``: every bracket and single quote goes."""
    return F.translate(text, "[]'", "")


def bare_labels(text: Column) -> Column:
    """``['A', 'B']`` -> ``A', 'B``: only the outer marks go."""
    opened = F.replace(text, F.lit("['"), F.lit(""))
    return F.replace(opened, F.lit("']"), F.lit(""))
