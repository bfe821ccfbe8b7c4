"""Surrogate keys: number the distinct values of a column in sorted order."""

from __future__ import annotations

from dataclasses import dataclass, replace
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from stackroom.functions.columns import field
from stackroom.operators.derive import require_columns
from stackroom.sources.versions import Versions
from stackroom.sources.workspace import use_checkpoint_dir

SORTED = "row_number_sorted"

# monotonically_increasing_id holds the partition above these bits, the row below.
ROW_BITS = 33


@dataclass(frozen=True)
class SurrogateKey:
    source: str = ""
    target: str = ""
    method: str = SORTED
    start_at: int = 1
    require_unique_source: bool = True
    drop_source_after_create: bool = False

    def __post_init__(self) -> None:
        if not (self.source and self.target):
            raise ValueError("a surrogate key needs a source and a target")
        if self.method != SORTED:
            raise ValueError(f"unknown surrogate key method {self.method!r}")


def key_mapping(df: DataFrame, spec: SurrogateKey, known: DataFrame | None = None) -> DataFrame:
    """One row per distinct non-null source value with its number; values that ``known`` has are left out.

    A window over the whole table would sort it in one task. Here Spark sorts the
    distinct values in ranges, each row takes its place within its range, and the
    first number of each range is added. The sorted rows are checkpointed in
    between: a range re-cut after a lost executor would give other numbers.
    """
    require_columns(df, [spec.source], "surrogate key")
    use_checkpoint_dir(df.sparkSession)
    value = field(spec.source)
    row_id = F.monotonically_increasing_id()
    values = df.filter(value.isNotNull()).groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("rows"))
    if known is not None:
        values = values.join(known.select(value.alias("value")), "value", "left_anti")
    placed = (
        values.orderBy("value")
        .select(
            "value",
            "rows",
            F.shiftright(row_id, ROW_BITS).alias("range"),
            row_id.bitwiseAND(F.lit((1 << ROW_BITS) - 1)).alias("place"),
        )
        .checkpoint()
    )

    # One row per range, so as many as there are sort partitions.
    ranges = (
        placed.groupBy("range")
        .agg(F.count(F.lit(1)).alias("size"), F.count_if(F.col("rows") > 1).alias("repeated"))
        .orderBy("range")
        .collect()
    )
    repeated = sum(r["repeated"] for r in ranges)
    if spec.require_unique_source and repeated:
        raise ValueError(f"{repeated} values of {spec.source!r} occur more than once")

    firsts = accumulate((r["size"] for r in ranges), initial=spec.start_at)
    starts = df.sparkSession.createDataFrame(
        [(r["range"], first) for r, first in zip(ranges, firsts)], "range long, first long"
    )
    return placed.join(F.broadcast(starts), "range").select(
        F.col("value").alias(spec.source), (F.col("first") + F.col("place")).alias(spec.target)
    )


def assign_keys(df: DataFrame, spec: SurrogateKey) -> DataFrame:
    """Attach the numbers; a null source value gets a null key.

    The mapping is read from its checkpoint, so both join inputs come straight
    from a shuffle and adaptive execution can split a frequent value or null.
    """
    return _attach(df, key_mapping(df, spec), spec)


def _attach(df: DataFrame, mapping: DataFrame, spec: SurrogateKey) -> DataFrame:
    keyed = df.join(mapping, on=spec.source, how="left")
    return keyed.drop(field(spec.source)) if spec.drop_source_after_create else keyed


def extend_keys(df: DataFrame, spec: SurrogateKey, store: Versions) -> DataFrame:
    """Number the values that ``store`` does not have yet, after its greatest number, and publish them with those it had.

    Returns the mapping as published. Numbers once given never change and leave no gap. Of two runs at one time one
    publishes; the other raises ``VersionConflict`` and can be run again.
    """
    seen = store.number()
    known = store.read(StructType([df.schema[spec.source], StructField(spec.target, LongType())]))
    most = known.agg(F.max(field(spec.target))).first()[0]
    start = spec.start_at if most is None else most + 1
    fresh = key_mapping(df, replace(spec, start_at=start), known)
    store.publish([*store.manifest(seen)["parts"], store.stage(fresh)], after=seen)
    return store.read()


def assign_stable_keys(df: DataFrame, spec: SurrogateKey, store: Versions) -> DataFrame:
    """Attach numbers that stay the same from batch to batch; a null source value gets a null key."""
    return _attach(df, extend_keys(df, spec, store), spec)
