"""Quality checks within one table: summary, failed rows, samples and gate."""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence
from dataclasses import dataclass, replace
from datetime import date
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from stackroom.functions.columns import all_of, field, free_name, hashable, row_hash
from stackroom.functions.scoring import percent
from stackroom.operators.derive import known_options, require_columns
from stackroom.operators.joins import join_per_key

SEVERITIES = ("critical", "warning")
DUPLICATE_KEY = "duplicate_key"
DEFAULT_SAMPLE = 100

SUMMARY_SCHEMA = """
    dataset_name string, quality_dimension string, check_name string, check_type string, severity string,
    status string, total_rows long, passed_rows long, failed_rows long, failed_pct double
"""

class QualityGateError(ValueError):
    """A critical check failed."""


@dataclass(frozen=True)
class Check:
    name: str = ""
    type: str = ""
    severity: str = ""
    column: str = ""
    allowed_values: tuple = ()
    required_column: str = ""
    when_present_column: str = ""
    key_columns: tuple[str, ...] = ()
    sample_limit: int = DEFAULT_SAMPLE
    quality_dimension: str = ""

    def __post_init__(self) -> None:
        if not self.name:
            raise ValueError(f"a check needs a name: {self}")
        if self.type not in REQUIRED_OPTIONS:
            raise ValueError(f"check {self.name!r}: unknown type {self.type!r}")
        if self.severity not in SEVERITIES:
            raise ValueError(f"check {self.name!r}: severity must be one of {SEVERITIES}, not {self.severity!r}")
        for option in REQUIRED_OPTIONS[self.type]:
            if not getattr(self, option):
                raise ValueError(f"check {self.name!r}: {self.type} needs {option}")

    @property
    def reads(self) -> tuple[str, ...]:
        single = (self.column, self.required_column, self.when_present_column)
        return (*(name for name in single if name), *self.key_columns)


# The options each check type cannot do without.
REQUIRED_OPTIONS = {
    "not_null": ("column",),
    "non_negative": ("column",),
    "value_in_set": ("column", "allowed_values"),
    "not_in_future": ("column",),
    "requires_when_present": ("required_column", "when_present_column"),
    DUPLICATE_KEY: ("key_columns",),
}


def _today(as_of: date | None) -> Column:
    return F.lit(as_of) if as_of else F.current_date()


def _allowed(check: Check, is_text: bool) -> list:
    return [str(v) if is_text else v for v in check.allowed_values]


def _day(check: Check, is_text: bool) -> Column:
    return field(check.column).try_cast("date") if is_text else field(check.column)


# Types that look at one row at a time: when does a row fail? A null outcome passes, and so
# does text that is no number or date (tables read from CSV are all text).
ROW_FAILURES: dict[str, Callable[[Check, Column, bool], Column]] = {
    "not_null": lambda c, today, is_text: field(c.column).isNull(),
    "non_negative": lambda c, today, is_text: field(c.column).try_cast("double") < 0,
    "value_in_set": lambda c, today, is_text: ~field(c.column).isin(_allowed(c, is_text)),
    "not_in_future": lambda c, today, is_text: _day(c, is_text) > today,
    "requires_when_present": lambda c, today, is_text: (
        field(c.when_present_column).isNotNull() & field(c.required_column).isNull()
    ),
}


def _failure(df: DataFrame, check: Check, as_of: date | None) -> Column:
    is_text = bool(check.column) and isinstance(df.schema[check.column].dataType, StringType)
    return ROW_FAILURES[check.type](check, _today(as_of), is_text)


@dataclass(frozen=True)
class CheckSuite:
    checks: tuple[Check, ...]
    dataset_name: str = "unknown_dataset"
    quality_dimension: str = "unknown_dimension"

    def __post_init__(self) -> None:
        if not self.checks:
            raise ValueError("a check suite needs at least one check")

    @classmethod
    def from_dict(cls, config: dict[str, Any]) -> CheckSuite:
        def check(options: dict[str, Any]) -> Check:
            known = known_options(Check, options)
            return Check(**{k: tuple(v) if isinstance(v, list) else v for k, v in known.items()})

        named = {k: config[k] for k in ("dataset_name", "quality_dimension") if k in config}
        return cls(tuple(check(c) for c in config.get("checks", ())), **named)

    @property
    def row_checks(self) -> list[Check]:
        return [c for c in self.checks if c.type != DUPLICATE_KEY]

    @property
    def key_checks(self) -> list[Check]:
        return [c for c in self.checks if c.type == DUPLICATE_KEY]

    def only(self, names: Collection[str]) -> CheckSuite:
        """The suite cut down to the named checks."""
        return replace(self, checks=tuple(c for c in self.checks if c.name in names))

    def require(self, df: DataFrame) -> None:
        for check in self.checks:
            require_columns(df, check.reads, f"check {check.name!r}")


def summarize(df: DataFrame, suite: CheckSuite, as_of: date | None = None) -> DataFrame:
    """One row per check. All row checks share one pass, each key check adds one over its keys."""
    suite.require(df)
    counts = [_key_counts(df, check) for check in suite.key_checks]
    if suite.row_checks:
        counts.insert(0, _row_counts(df, suite.row_checks, as_of))
    counted = counts[0]
    for other in counts[1:]:
        counted = counted.unionAll(other)
    return counted.select(
        F.lit(suite.dataset_name).alias("dataset_name"),
        F.coalesce(F.nullif("quality_dimension", F.lit("")), F.lit(suite.quality_dimension)).alias(
            "quality_dimension"
        ),
        "check_name",
        "check_type",
        "severity",
        F.when(F.col("failed_rows") == 0, "passed").otherwise("failed").alias("status"),
        "total_rows",
        (F.col("total_rows") - F.col("failed_rows")).alias("passed_rows"),
        "failed_rows",
        percent(F.col("failed_rows"), F.col("total_rows")).alias("failed_pct"),
    )


def _labels(check: Check) -> list[Column]:
    return [
        F.lit(check.quality_dimension).alias("quality_dimension"),
        F.lit(check.name).alias("check_name"),
        F.lit(check.type).alias("check_type"),
        F.lit(check.severity).alias("severity"),
    ]


def _row_counts(df: DataFrame, checks: Sequence[Check], as_of: date | None) -> DataFrame:
    failures = [F.count_if(_failure(df, c, as_of)).alias(f"failed_{i}") for i, c in enumerate(checks)]
    per_check = [
        F.struct(*_labels(c), F.col("total_rows"), F.col(f"failed_{i}").alias("failed_rows"))
        for i, c in enumerate(checks)
    ]
    counted = df.agg(F.count(F.lit(1)).alias("total_rows"), *failures)
    return counted.select(F.inline(F.array(*per_check)))


def _key_counts(df: DataFrame, check: Check) -> DataFrame:
    """Rows, not keys, that share their key with another row."""
    groups = df.groupBy(*[field(k) for k in check.key_columns]).agg(F.count(F.lit(1)).alias("rows"))
    repeated = _complete_key(check) & (F.col("rows") > 1)
    total = F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows")
    failed = F.coalesce(F.sum(F.when(repeated, F.col("rows"))), F.lit(0)).alias("failed_rows")
    return groups.agg(total, failed).select(*_labels(check), "total_rows", "failed_rows")


def _complete_key(check: Check) -> Column:
    return all_of(field(k).isNotNull() for k in check.key_columns)


def rows_with_repeated_key(df: DataFrame, check: Check) -> DataFrame:
    """Rows whose key occurs more than once, key columns first. A null never equals a null."""
    keys = list(check.key_columns)
    complete = df.filter(_complete_key(check))
    rows = free_name("key_rows", complete)
    groups = complete.groupBy(*[field(k) for k in keys]).agg(F.count(F.lit(1)).alias(rows))
    repeated = groups.filter(F.col(rows) > 1).drop(rows)
    others = [c for c in df.columns if c not in keys]
    return join_per_key(complete, repeated, keys, "left_semi").select(*[field(c) for c in keys + others])


def failed_rows_of(df: DataFrame, check: Check, as_of: date | None = None) -> DataFrame:
    """The rows that fail one check."""
    require_columns(df, check.reads, f"check {check.name!r}")
    if check.type == DUPLICATE_KEY:
        return rows_with_repeated_key(df, check)
    return df.filter(_failure(df, check, as_of))


def failed_rows(df: DataFrame, suite: CheckSuite, as_of: date | None = None) -> DataFrame:
    """Failing rows of all checks, each under its ``check_name``, in one pass over row checks."""
    suite.require(df)
    parts = [
        rows_with_repeated_key(df, c).select(F.lit(c.name).alias("check_name"), *[field(n) for n in df.columns])
        for c in suite.key_checks
    ]
    if suite.row_checks:
        outcomes = [(c.name, _failure(df, c, as_of)) for c in suite.row_checks]
        failing = F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in outcomes]))
        # No filter before it: a row that fails nothing explodes to nothing, and a filter would be pushed down with every
        # cleaning expression in it once more, into methods too large for the JVM to compile.
        parts.insert(0, df.select(F.explode(failing).alias("check_name"), *[field(n) for n in df.columns]))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


#: Groups of failing rows per row of a sample whose least keys bound the sample.
BOUND_GROUPS = 8


def _limit_of(suite: CheckSuite) -> Column:
    limit = F.lit(None).cast("int")
    for check in suite.checks:
        limit = F.when(F.col("check_name") == check.name, check.sample_limit).otherwise(limit)
    return limit


def _sample_bounds(keys: DataFrame, suite: CheckSuite) -> DataFrame:
    """check_name and bound: no failing row above the bound can be in the check's sample.

    ``keys``: check_name, key (the leading order key) and spread (a hash of all order keys) of every failing row. Rows
    are dealt to a fixed number of groups by hash. The least key of each group belongs to a row of its own, so the
    k-th least of them has k rows at or below it. A check with fewer than k groups gets no bound.
    """
    group = F.pmod("spread", F.greatest(_limit_of(suite), F.lit(1)) * BOUND_GROUPS)
    least = keys.groupBy("check_name", group.alias("spread")).agg(F.min("key").alias("bound"))
    place = F.row_number().over(Window.partitionBy("check_name").orderBy("bound", "spread"))
    return least.select("check_name", "bound", place.alias("place")).where(F.col("place") == _limit_of(suite)).drop("place")


def failed_samples(
    df: DataFrame, suite: CheckSuite, order_by: Sequence[str] = (), as_of: date | None = None
) -> DataFrame:
    """Up to ``sample_limit`` failing rows per check: the first by ``order_by``, else by row hash.

    Two passes. The first reads the columns of checks and order only and leaves a bound for each check, from a number of
    keys that depends on the limits alone; the second takes whole rows, and only those within the bounds. Rows that tie
    with a bound come along, so an order of few distinct leading values bounds little; the window then cuts each task's rows.
    Null keys come first.
    """
    failing = failed_rows(df, suite, as_of)
    order = [field(n) for n in order_by] or [row_hash(hashable(df))]
    spread = row_hash(order_by) if order_by else order[0]
    bounds = _sample_bounds(failing.select("check_name", order[0].alias("key"), spread.alias("spread")), suite)

    name, bound = (free_name(stem, df) for stem in ("bounded_check", "bound"))
    bounds = bounds.select(F.col("check_name").alias(name), F.col("bound").alias(bound))
    # A row for each check at most.
    within = failing.join(F.broadcast(bounds), F.col("check_name") == F.col(name), "left").where(
        F.col(name).isNull() | order[0].isNull() | (order[0] <= F.col(bound))
    )
    numbered = free_name("place", failing)
    place = F.row_number().over(Window.partitionBy("check_name").orderBy(*order))
    return within.drop(name, bound).withColumn(numbered, place).filter(F.col(numbered) <= _limit_of(suite)).drop(numbered)


def roll_up(summary: DataFrame) -> DataFrame:
    """Number of checks per data set, severity and status."""
    return summary.groupBy("dataset_name", "severity", "status").agg(
        F.count(F.lit(1)).alias("checks"), F.sum("failed_rows").alias("failed_rows")
    )


def enforce(summary: DataFrame, name_column: str = "check_name") -> None:
    """Raise if a critical check failed. Only the names of failed checks reach the driver."""
    failed = summary.filter((F.col("severity") == "critical") & (F.col("status") == "failed"))
    names = sorted(row[0] for row in failed.select(name_column).collect())
    if names:
        raise QualityGateError(f"critical checks failed: {', '.join(names)}")
