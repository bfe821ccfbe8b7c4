"""Naming helpers."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def field(name: str) -> Column:
    """Column by exact name; slashes, dots and back-ticks in it are plain characters."""
    return F.col("`" + name.replace("`", "``") + "`")


def exact_name(spark: SparkSession) -> Callable[[str], str]:
    """What decides whether Spark takes two names for one."""
    exact = spark.conf.get("spark.sql.caseSensitive", "false").lower() == "true"
    return str if exact else str.lower


def free_name(stem: str, *frames: DataFrame) -> str:
    """A column name that none of the frames has, whatever the case of letters."""
    taken = {name.lower() for df in frames for name in df.columns}
    name = stem
    while name in taken:
        name += "_"
    return name


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(and_, conditions)


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(or_, conditions)


def hashable(df: DataFrame) -> list[str]:
    """Columns that Spark can hash: all without a map or a variant somewhere in them."""
    return [c.name for c in df.schema if not any(kind in c.dataType.simpleString() for kind in ("map<", "variant"))]


def row_hash(names: Iterable[str]) -> Column:
    """Eight bytes that stand for a row, to spread or to order rows repeatably."""
    return F.xxhash64(*[field(n) for n in names])
