"""Quality columns: key hashes, presence flags and scores over flags."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame

from stackroom.functions import scoring
from stackroom.functions.columns import field
from stackroom.operators.derive import Step, derive

HASH_METHODS: dict[str, Callable[[Column], Column]] = {"xxhash64": scoring.null_safe_hash}
FLAG_RULES: dict[str, Callable[[Column], Column]] = {"is_not_null": scoring.is_present}
SCORE_METHODS: dict[str, Callable[[list[Column]], Column]] = {"sum_flags": scoring.count_true}


@dataclass(frozen=True)
class EnrichRule:
    target: str
    sources: tuple[str, ...]
    method: str
    methods: dict[str, Callable]

    def __post_init__(self) -> None:
        if not self.target or not self.sources or not all(self.sources):
            raise ValueError(f"an enrich rule needs a target and its sources: {self.target!r}, {self.sources}")
        if self.method not in self.methods:
            raise ValueError(f"unknown method {self.method!r} for {self.target!r}")

    def column(self) -> Column:
        inputs = [field(name) for name in self.sources]
        build = self.methods[self.method]
        return build(inputs) if self.methods is SCORE_METHODS else build(inputs[0])


@dataclass(frozen=True)
class EnrichSpec:
    """Rules in the order they apply; a later rule may read an earlier target."""

    rules: tuple[EnrichRule, ...]

    def __post_init__(self) -> None:
        targets = [rule.target for rule in self.rules]
        if len(set(targets)) < len(targets):
            raise ValueError(f"two enrich rules share a target: {targets}")

    @classmethod
    def from_dict(cls, config: dict[str, Any]) -> EnrichSpec:
        return cls(tuple(_rules_of(config)))


def _rules_of(config: dict[str, Any]) -> Iterator[EnrichRule]:
    one_source = (("hash_rules", "method", HASH_METHODS), ("flag_rules", "rule", FLAG_RULES))
    for group, method, methods in one_source:
        for r in config.get(group, ()):
            yield EnrichRule(r.get("target", ""), (r.get("source", ""),), r.get(method, ""), methods)
    for r in config.get("score_rules", ()):
        yield EnrichRule(r.get("target", ""), tuple(r.get("sources", ())), r.get("method", ""), SCORE_METHODS)


def enrich(df: DataFrame, spec: EnrichSpec) -> DataFrame:
    known = set(df.columns)
    for rule in spec.rules:
        absent = [name for name in rule.sources if name not in known]
        if absent:
            raise ValueError(f"enrich rule for {rule.target!r}: no column {absent} among {sorted(known)}")
        known.add(rule.target)
    return derive(df, (Step(rule.target, rule.sources, rule.column()) for rule in spec.rules))
