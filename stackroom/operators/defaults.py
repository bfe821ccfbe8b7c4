"""Default values for missing text."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql.types import CharType, StringType, VarcharType

from stackroom.functions.columns import field
from stackroom.functions.text import fill_blank
from stackroom.operators.derive import Step, derive, require_columns


def fill_rules(config: dict[str, Any]) -> list[tuple[str, Any]]:
    """``{"fill_rules": [{"column", "value"}]}`` as pairs, in order."""
    return [(rule["column"], rule["value"]) for rule in config.get("fill_rules", ())]


def fill_defaults(df: DataFrame, defaults: Mapping[str, Any] | Iterable[tuple[str, Any]]) -> DataFrame:
    """Replace null or blank text by the default of its column.

    Only text columns take a default: in any other column a text default would
    either fail at run time or turn the whole column into text.
    """
    pairs = list(defaults.items() if isinstance(defaults, Mapping) else defaults)
    names = [name for name, _ in pairs]
    require_columns(df, names, "fill defaults")
    other = [n for n in names if not isinstance(df.schema[n].dataType, (StringType, VarcharType, CharType))]
    if other:
        raise ValueError(f"fill defaults: {other} are not text columns")
    return derive(df, (Step(n, (n,), fill_blank(field(n), str(v))) for n, v in pairs))
