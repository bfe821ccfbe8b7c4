"""Typed, cleaned columns from all-text ones."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackroom.functions import parsing, text
from stackroom.functions.columns import field
from stackroom.operators.derive import Step, derive, known_options
from stackroom.operators.surrogate import SurrogateKey, assign_keys

APPEND, TARGETS_ONLY = "append", "select_targets_only"


@dataclass(frozen=True)
class ColumnRule:
    source: str = ""
    target: str = ""
    target_type: str = ""
    cast_via: str = ""
    parse_mode: str = ""
    trim: bool = False
    collapse_spaces: bool = False
    blank_to_null: bool = False
    lower: bool = False

    def __post_init__(self) -> None:
        if not (self.source and self.target):
            raise ValueError(f"a column rule needs a source and a target: {self}")
        if self.parse_mode and self.parse_mode not in parsing.PARSE_MODES:
            raise ValueError(f"unknown parse mode {self.parse_mode!r} for {self.target!r}")

    def column(self) -> Column:
        """Clean, then parse, then cast."""
        value = field(self.source)
        if self.collapse_spaces:
            value = text.collapse(value)
        elif self.trim:
            value = F.trim(value)
        if self.blank_to_null:
            is_text = self.trim or self.collapse_spaces
            value = text.empty_to_null(value) if is_text else text.blank_to_null(value)
        if self.lower:
            value = F.lower(value)
        if self.parse_mode:
            return parsing.PARSE_MODES[self.parse_mode](value)
        if self.target_type:
            return parsing.convert(value, self.target_type, self.cast_via)
        return value


@dataclass(frozen=True)
class StandardizeSpec:
    rules: tuple[ColumnRule, ...]
    output_mode: str = APPEND
    passthrough_columns: tuple[str, ...] = ()
    drop_columns_after_transform: tuple[str, ...] = ()
    surrogate_key: SurrogateKey | None = None

    def __post_init__(self) -> None:
        if not self.rules:
            raise ValueError("standardize needs at least one column rule")
        if self.output_mode not in (APPEND, TARGETS_ONLY):
            raise ValueError(f"unknown output mode {self.output_mode!r}")

    @classmethod
    def from_dict(cls, config: dict[str, Any]) -> StandardizeSpec:
        key = config.get("surrogate_key")
        return cls(
            rules=tuple(ColumnRule(**known_options(ColumnRule, r)) for r in config.get("column_rules", ())),
            output_mode=config.get("output_mode", APPEND),
            passthrough_columns=tuple(config.get("passthrough_columns", ())),
            drop_columns_after_transform=tuple(config.get("drop_columns_after_transform", ())),
            surrogate_key=SurrogateKey(**known_options(SurrogateKey, key)) if key else None,
        )

    def kept(self) -> list[str]:
        """Passthrough columns, then targets, then the surrogate key, each once."""
        names = [*self.passthrough_columns, *(rule.target for rule in self.rules)]
        if self.surrogate_key:
            names.append(self.surrogate_key.target)
        return list(dict.fromkeys(names))


def standardize(df: DataFrame, spec: StandardizeSpec) -> DataFrame:
    known = set(df.columns)
    for rule in spec.rules:
        if rule.source not in known:
            raise ValueError(f"rule for {rule.target!r} reads {rule.source!r}, known so far: {sorted(known)}")
        known.add(rule.target)

    out = derive(df, (Step(r.target, (r.source,), r.column()) for r in spec.rules))
    if spec.surrogate_key:
        out = assign_keys(out, spec.surrogate_key)
    out = out.drop(*spec.drop_columns_after_transform)
    if spec.output_mode == TARGETS_ONLY:
        present = set(out.columns)
        out = out.select(*[field(name) for name in spec.kept() if name in present])
    return out
