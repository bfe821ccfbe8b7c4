"""Derived columns in order."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import fields
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame


class Step(NamedTuple):
    target: str
    reads: tuple[str, ...]
    column: Column


def derive(df: DataFrame, steps: Iterable[Step]) -> DataFrame:
    """Add columns so that each step sees the targets of the steps before it.

    Steps that do not depend on each other share one ``withColumns``, which keeps
    the logical plan short however many rules there are.
    """
    batch: dict[str, Column] = {}
    pending: set[str] = set()
    for step in steps:
        touched = {name.lower() for name in (step.target, *step.reads)}
        if touched & pending:
            df, batch, pending = df.withColumns(batch), {}, set()
        batch[step.target] = step.column
        pending.add(step.target.lower())
    return df.withColumns(batch) if batch else df


def known_options(cls: type, options: dict[str, Any]) -> dict[str, Any]:
    """The entries of a rule dict that ``cls`` has a field for."""
    names = {f.name for f in fields(cls)}
    return {k: v for k, v in options.items() if k in names and v is not None}


def require_columns(df: DataFrame, names: Iterable[str], where: str) -> None:
    absent = sorted(set(names) - set(df.columns))
    if absent:
        raise ValueError(f"{where}: no column {absent} among {sorted(df.columns)}")
