"""Split a table into rows that may go on and rows held back with a reason."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackroom.functions.columns import any_of, field
from stackroom.functions.scoring import missing_reason
from stackroom.operators.derive import require_columns

# Columns required, and named in the reason, unless the spec says otherwise.
DEFAULT_REQUIRED = ("title", "title_key")
OTHER_REASON = "quarantine_rule_matched"


@dataclass(frozen=True)
class QuarantineSpec:
    entity: str
    stage: str = "silver"
    required: tuple[str, ...] = DEFAULT_REQUIRED

    def __post_init__(self) -> None:
        if not self.required:
            raise ValueError("quarantine needs at least one required column")

    @classmethod
    def from_dict(cls, config: dict[str, Any]) -> QuarantineSpec:
        return cls(
            entity=config.get("quarantine_entity") or config["dataset_name"],
            stage=config.get("quarantine_stage", "silver"),
            required=tuple(config.get("rules", {}).get("require_non_null_columns", DEFAULT_REQUIRED)),
        )

    def condition(self) -> Column:
        """True or false, never null, so the two sides together are the input."""
        return any_of(field(name).isNull() for name in self.required)


def eligible(df: DataFrame, spec: QuarantineSpec) -> DataFrame:
    require_columns(df, spec.required, "quarantine")
    return df.filter(~spec.condition())


def rejects(df: DataFrame, spec: QuarantineSpec) -> DataFrame:
    require_columns(df, spec.required, "quarantine")
    named = DEFAULT_REQUIRED if set(DEFAULT_REQUIRED) <= set(df.columns) else spec.required
    return df.filter(spec.condition()).withColumns(
        {
            "quarantine_reason": missing_reason(named, OTHER_REASON),
            "quarantine_stage": F.lit(spec.stage),
            "quarantine_entity": F.lit(spec.entity),
        }
    )
