"""A look at a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stackroom.functions.columns import field


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, nulls and the row count, in one pass."""
    nulls = [F.count_if(field(name).isNull()).alias(f"nulls_{i}") for i, name in enumerate(df.columns)]
    lines = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("data_type"),
            F.col(f"nulls_{i}").alias("null_count"),
            F.col("row_count"),
        )
        for i, (name, kind) in enumerate(df.dtypes)
    ]
    return df.agg(F.count(F.lit(1)).alias("row_count"), *nulls).select(F.inline(F.array(*lines)))


def first_rows(df: DataFrame, n: int, order_by: Sequence[str] = ()) -> DataFrame:
    """``n`` rows: any without an order, else the first by it."""
    if order_by:
        df = df.orderBy(*[field(name) for name in order_by])
    return df.limit(n)
