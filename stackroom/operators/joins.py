"""Equi-joins that hold up when one key has a large share of the rows.

Adaptive execution splits a hot partition of a sort-merge join, with two limits:
both inputs must come straight from a shuffle, and in an outer join only the kept
side can be split. The helpers here put joins into shapes that meet both, the same
at every size, and run nothing while a join is built. No session setting is needed,
in a chain of joins on one key neither.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, StructType, VariantType

from stackroom.functions.columns import all_of, any_of, exact_name, field, free_name


def join_per_key(rows: DataFrame, keyed: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join rows to an aggregate that has one row for each key, or any rows on a key by which they may be placed already.

    The aggregate is already placed by its key, so Spark would shuffle only the
    rows and then could not split a hot key. A second equality, on a hash of the
    key, does not fit that placement: the (smaller) aggregate is shuffled too and
    both inputs come from a shuffle. Keys of two types have no hash in common; the
    aggregate is then dealt out first, which undoes its placement as well.
    """
    if any(rows.schema[k].dataType != keyed.schema[k].dataType for k in on):
        parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return rows.join(keyed.repartition(parts), on=list(on), how=how)
    check = free_name("key_check", rows, keyed)
    value = F.xxhash64(*[field(k) for k in on])
    return rows.withColumn(check, value).join(keyed.withColumn(check, value), on=[*on, check], how=how).drop(check)


def equi_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, right_unique: bool = False
) -> DataFrame:
    """Join on columns both sides have, keeping one copy of them, key columns first.

    Semi and anti joins look at the other side's distinct keys. An outer join is one
    inner join, see ``_left`` and ``_outer``: whole rows of either side are worked out and
    read once, and the distinct keys of the right side (in a right or full join: the keys
    of both) a second time. A chain of left joins takes its first table once. If no key
    of the right side repeats, ``right_unique`` makes a left join of it, which adaptive
    execution can split as it is.
    """
    keys = list(keys)
    kind = how.lower().replace("_", "").removesuffix("outer")
    if kind in ("leftsemi", "semi", "leftanti", "anti"):
        return _by_presence(left, right, keys, "left_anti" if "anti" in kind else "left_semi")
    if kind == "left" and right_unique:
        return join_per_key(left, right, keys, "left")
    if kind == "inner" and _alike(left, right, keys):
        return join_per_key(left, right, keys, "inner")
    if kind not in ("left", "right", "full"):
        return left.join(right, on=keys, how=how)

    # Analysed only: the types and the order of columns that Spark's own join would give.
    wanted = left.join(right, on=keys, how=how).schema
    if not _alike(left, right, keys):
        return _outer_in_parts(left, right, keys, kind, wanted)
    return _left(left, right, keys, wanted) if kind == "left" else _outer(left, right, keys, kind, wanted)


def _alike(left: DataFrame, right: DataFrame, keys: list[str]) -> bool:
    """Whether each key has one type on both sides, and one that rows can be grouped by."""
    kinds = [(left.schema[k].dataType, right.schema[k].dataType) for k in keys]
    return all(a == b and isinstance(a, AtomicType) and not isinstance(a, VariantType) for a, b in kinds)


#: Stand-ins that share the rows of a left side without a match.
STAND_INS = 64


def _left(left: DataFrame, right: DataFrame, keys: list[str], wanted: StructType) -> DataFrame:
    """A left join as an inner one. Rows first learn whether the right side has their key; those without find one of some stand-ins there."""
    has = free_name("has_match", left, right)
    known = right.select(*[field(k) for k in keys]).distinct().withColumn(has, F.lit(True))
    marked = join_per_key(left, known, keys, "left")
    joins, others = [f"key_{i}" for i in range(len(keys))], [c for c in right.columns if c not in keys]
    lost = field(has).isNull()
    spread = F.pmod(F.xxhash64(*[field(k) for k in keys]), F.lit(STAND_INS))
    rows = marked.select(
        *[field(c).alias(f"left_{i}") for i, c in enumerate(left.columns)],
        *[F.when(~lost, field(k)).alias(j) for k, j in zip(keys, joins)],
        F.when(lost, spread).otherwise(F.lit(-1)).alias("group"),
    )
    offered = right.filter(all_of(field(k).isNotNull() for k in keys)).select(
        *[field(c).alias(f"right_{i}") for i, c in enumerate(others)],
        *[field(k).alias(j) for k, j in zip(keys, joins)],
        F.lit(-1).cast("long").alias("group"),
    )
    nothing = [F.lit(None).cast(right.schema[c].dataType) for c in others]
    stand_ins = right.sparkSession.range(STAND_INS).select(*nothing, *[F.lit(None).cast(right.schema[k].dataType) for k in keys], "id")
    first, second = rows.alias("first"), offered.unionAll(stand_ins).alias("second")
    same = [F.col(f"first.{j}").eqNullSafe(F.col(f"second.{j}")) for j in joins]
    met = first.join(second, all_of([*same, F.col("first.group") == F.col("second.group")]))
    same_name = exact_name(left.sparkSession)
    place = {same_name(c): f"right_{i}" for i, c in enumerate(others)} | {same_name(c): f"left_{i}" for i, c in enumerate(left.columns)}
    return met.select(*[F.col(place[same_name(c.name)]).cast(c.dataType).alias(c.name) for c in wanted])


#: Which sides have a key, as one number.
BITS = {"left": 1, "right": 2}


def _outer(left: DataFrame, right: DataFrame, keys: list[str], kind: str, wanted: StructType) -> DataFrame:
    """An outer join as one inner join, which can be split on both sides.

    A kept side's rows that would be left over find a stand-in on the other side: one
    row for each key that the other side lacks. What is lacking is an aggregate of the
    keys of both sides, so whole rows are read, worked on and shuffled once, and only key
    columns twice. Rows with a null in their key all meet one stand-in of their own.
    """
    sides = {"left": left, "right": right}
    kept = [side for side in sides if kind in (side, "full")]
    joins = [f"key_{i}" for i in range(len(keys))]

    def known(side: str) -> DataFrame:
        # A filter would go down to the scan and work a key out again, so rows without one are of no side instead.
        whole = all_of(F.col(j).isNotNull() for j in joins)
        frame = sides[side].select(*[field(k).alias(j) for k, j in zip(keys, joins)])
        return frame.withColumn("of_sides", F.when(whole, BITS[side]).otherwise(0))

    # One number for both sides: a full join asks twice, and columns of their own would be pruned to two aggregates.
    seen = known("left").unionAll(known("right")).groupBy(*joins).agg(F.bit_or("of_sides").alias("of_sides"))
    names = {side: [f"{side}_{i}" for i in range(len(df.columns))] for side, df in sides.items()}

    def filled(side: str) -> DataFrame:
        """The side's rows, and stand-ins for keys of the other side if that one is kept. ``group`` tells rows without a key apart."""
        frame, other = sides[side], "right" if side == "left" else "left"
        lost = any_of(field(k).isNull() for k in keys)
        rows = frame.select(
            *[field(c).alias(n) for c, n in zip(frame.columns, names[side])],
            *[F.when(~lost, field(k)).alias(j) for k, j in zip(keys, joins)],
            F.when(lost, side).otherwise("").alias("group"),
            F.lit(True).alias(f"of_{side}"),
        )
        if other not in kept:
            return rows
        nothing = [F.lit(None).cast(c.dataType).alias(n) for c, n in zip(frame.schema, names[side])]
        lacking = seen.filter(F.col("of_sides") == BITS[other]).select(*nothing, *joins, F.lit("").alias("group"), F.lit(False))
        no_key = [F.lit(None).cast(frame.schema[k].dataType) for k in keys]
        without = frame.sparkSession.range(1).select(*nothing, *no_key, F.lit(other).alias("group"), F.lit(False))
        return rows.unionAll(lacking).unionAll(without)

    first, second = filled("left").alias("first"), filled("right").alias("second")
    same = [F.col(f"first.{j}").eqNullSafe(F.col(f"second.{j}")) for j in joins]
    met = first.join(second, all_of([*same, F.col("first.group") == F.col("second.group")]))

    same_name = exact_name(left.sparkSession)
    place = {side: dict(zip(map(same_name, df.columns), names[side])) for side, df in sides.items()}
    of_keys = set(map(same_name, keys))

    def column(name: str) -> Column:
        name = same_name(name)
        if name not in of_keys:
            return F.col(place["left" if name in place["left"] else "right"][name])
        mine, theirs = F.col(place["left"][name]), F.col(place["right"][name])
        return {"left": mine, "right": theirs, "full": F.when(F.col("of_left"), mine).otherwise(theirs)}[kind]

    return met.select(*[column(c.name).cast(c.dataType).alias(c.name) for c in wanted])


def _outer_in_parts(left: DataFrame, right: DataFrame, keys: list[str], kind: str, wanted: StructType) -> DataFrame:
    """For keys of two types, or of types with parts: the matches, and the rows of each kept side whose key the other side lacks."""

    def shaped(df: DataFrame) -> DataFrame:
        present = set(df.columns)
        columns = [field(c.name) if c.name in present else F.lit(None) for c in wanted]
        return df.select(*[column.cast(c.dataType).alias(c.name) for column, c in zip(columns, wanted)])

    first, second = (right, left) if kind == "right" else (left, right)
    out = shaped(first.join(second, on=keys, how="inner"))
    if kind in ("left", "full"):
        out = out.unionAll(shaped(_by_presence(left, right, keys, "left_anti")))
    if kind in ("right", "full"):
        out = out.unionAll(shaped(_by_presence(right, left, keys, "left_anti")))
    return out


def _by_presence(rows: DataFrame, other: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Rows whose key the other side has (semi) or lacks (anti); a null key is never there."""
    return join_per_key(rows, other.select(*[field(k) for k in keys]).distinct(), keys, how)
