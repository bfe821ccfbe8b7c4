"""Serving data sets: join, filter, select, de-duplicate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from stackroom.functions.columns import exact_name, field, free_name
from stackroom.operators.derive import known_options
from stackroom.operators.joins import equi_join

FILTERS = {
    "is_not_null": lambda name: field(name).isNotNull(),
    "is_null": lambda name: field(name).isNull(),
}


@dataclass(frozen=True)
class JoinSpec:
    right_input: str
    left_on: tuple[str, ...]
    right_on: tuple[str, ...]
    how: str = "left"
    right_select_columns: tuple[str, ...] = ()
    #: No key repeats in the right input; a left join is cheaper then.
    right_unique: bool = False

    def __post_init__(self) -> None:
        if not self.left_on or len(self.left_on) != len(self.right_on):
            raise ValueError(f"join with {self.right_input!r}: keys {self.left_on} and {self.right_on} do not pair up")


@dataclass(frozen=True)
class ServingSpec:
    base_input: str
    select_columns: tuple[str, ...]
    joins: tuple[JoinSpec, ...] = ()
    filters: tuple[tuple[str, str], ...] = ()
    deduplicate_on: tuple[str, ...] = ()
    deduplicate_order: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if not self.base_input:
            raise ValueError("a serving data set needs a base input")
        if not self.select_columns:
            raise ValueError("a serving data set needs columns to select")
        for column, condition in self.filters:
            if condition not in FILTERS:
                raise ValueError(f"unknown filter {condition!r} on {column!r}")

    @classmethod
    def from_dict(cls, config: dict[str, Any]) -> ServingSpec:
        serving = config.get("serving", config)

        def join(options: dict[str, Any]) -> JoinSpec:
            known = known_options(JoinSpec, options)
            for name in ("left_on", "right_on", "right_select_columns"):
                if name in known:
                    known[name] = (known[name],) if isinstance(known[name], str) else tuple(known[name])
            return JoinSpec(**known)

        return cls(
            base_input=serving.get("base_input", ""),
            select_columns=tuple(serving.get("select_columns", ())),
            joins=tuple(join(j) for j in serving.get("joins", ())),
            filters=tuple((f["column"], f["condition"]) for f in serving.get("filters", ())),
            deduplicate_on=tuple(serving.get("deduplicate_on", ())),
            deduplicate_order=tuple(serving.get("deduplicate_order", ())),
        )


def serve(inputs: Mapping[str, DataFrame], spec: ServingSpec) -> DataFrame:
    wanted = [spec.base_input, *(j.right_input for j in spec.joins)]
    absent = [name for name in wanted if name not in inputs]
    if absent:
        raise ValueError(f"no input named {absent} among {sorted(inputs)}")

    df = inputs[spec.base_input]
    shared: set[str] = set()
    for join in spec.joins:
        _require_clear(join.left_on, shared)
        df, clashes = _join(df, inputs[join.right_input], join)
        shared |= clashes

    needed = [*spec.select_columns, *(column for column, _ in spec.filters)]
    _require_clear(needed, shared)
    absent = [name for name in needed if name not in df.columns]
    if absent:
        raise ValueError(f"no column {absent} among {sorted(df.columns)}")

    for column, condition in spec.filters:
        df = df.filter(FILTERS[condition](column))
    df = df.select(*[field(name) for name in spec.select_columns])
    if spec.deduplicate_on:
        df = first_per_key(df, spec.deduplicate_on, spec.deduplicate_order)
    return df


def _require_clear(names: Sequence[str], shared: set[str]) -> None:
    unclear = sorted(shared & set(names))
    if unclear:
        raise ValueError(f"{unclear} come from more than one input; project the joined input without them")


def _join(left: DataFrame, right: DataFrame, join: JoinSpec) -> tuple[DataFrame, set[str]]:
    """Join one input. Returns also the names that both sides have besides the keys.

    Such a name could not be told apart afterwards, so the right copy is dropped
    here and using the name later is an error.
    """
    if join.right_select_columns:
        right = right.select(*[field(name) for name in join.right_select_columns])
    for side, df, keys in (("left", left, join.left_on), ("right", right, join.right_on)):
        absent = [k for k in keys if k not in df.columns]
        if absent:
            raise ValueError(f"join with {join.right_input!r}: no {side} key {absent} among {sorted(df.columns)}")

    keys = list(join.left_on)
    semi = "semi" in join.how or "anti" in join.how
    same_names = join.left_on == join.right_on
    same = exact_name(left.sparkSession)
    taken, kept = {same(c) for c in left.columns}, {same(c) for c in join.right_on}
    clashes = {c for c in right.columns if same(c) in taken - kept}
    names = {same(c) for c in clashes}
    clashes |= {c for c in left.columns if same(c) in names}
    right = right.drop(*[field(name) for name in set(right.columns) & clashes])

    if same_names:
        return equi_join(left, right, keys, join.how, join.right_unique), set() if semi else clashes

    # Other key names: the right ones leave the result, and with them the key of right-only rows.
    renamed = {k: free_name(f"join_key_{i}", left, right) for i, k in enumerate(join.right_on)}
    right = right.withColumnsRenamed(renamed)
    left = left.withColumns({name: field(k) for name, k in zip(renamed.values(), keys)})
    joined = equi_join(left, right, list(renamed.values()), join.how, join.right_unique)
    return joined.drop(*renamed.values()), set() if semi else clashes


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the first by ``order_by``, then by the other columns.

    The smallest row of each key is found map-side first, so a frequent key sends
    one row per task. Maps and variants have no order; with them any row may stay.
    """
    absent = [k for k in (*keys, *order_by) if k not in df.columns]
    if absent:
        raise ValueError(f"de-duplicate: no column {absent} among {sorted(df.columns)}")
    rest = [c for c in df.columns if c not in keys]
    if not rest or any(isinstance(df.schema[c].dataType, (MapType, VariantType)) for c in rest):
        return df.dropDuplicates(list(keys))
    ranked = [c for c in order_by if c not in keys]
    ranked += [c for c in rest if c not in ranked]
    row = free_name("first_row", df)
    smallest = F.min(F.struct(*[field(c) for c in ranked])).alias(row)
    grouped = df.groupBy(*[field(k) for k in keys]).agg(smallest)
    return grouped.select(*[field(c) if c in keys else F.col(row).getField(c).alias(c) for c in df.columns])
