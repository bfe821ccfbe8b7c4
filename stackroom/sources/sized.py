"""Parquet files of a wanted size in bytes, whatever the skew of the column that parts or orders them."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from stackroom.functions.columns import all_of, field, free_name, hashable, row_hash
from stackroom.operators.derive import require_columns
from stackroom.sources.tables import write_table
from stackroom.sources.workspace import new_folder, remove

MB = 1 << 20
SHARES = 1 << 30


def write_sized(
    df: DataFrame,
    path: str,
    by: Sequence[str],
    target_bytes: int = 256 * MB,
    folders: bool = True,
    sample_rows: int = 100_000,
    most_values: int = 10_000,
    mode: str = "overwrite",
    **settings: Any,
) -> int:
    """Write parquet files of about ``target_bytes`` each and return the number of rows.

    With ``folders`` each value of ``by`` has a folder; a large value fills several files, and one smaller than the target
    has one small file. Without, files follow the order of the values: neighbouring small values share a file, a large value
    runs through several, and rows are sorted by value within files. Three passes: one counts the rows of each value, one
    writes a sample of each value as it will be encoded, to learn its bytes a row, one writes. A value of at most
    ``sample_rows`` rows is measured whole; of others a share chosen by row hash.

    ``by`` may have ``most_values`` values, else ValueError: their counts go through the driver and are broadcast. Rows
    are dealt to files by row hash, so a retried task gives the same files; rows alike in every column stay together.
    Null is a value of its own. A table without rows is written as it is. Settings as for ``write_table``.
    """
    require_columns(df, by, "sized files")
    if not by or target_bytes <= 0:
        raise ValueError("sized files need columns and a target above 0")
    groups = df.groupBy(*map(field, by)).agg(F.count(F.lit(1)).alias(free_name("rows", df)))
    values = groups.orderBy(*map(field, by)).limit(most_values + 1).collect()
    if len(values) > most_values:
        raise ValueError(f"{', '.join(by)}: more than {most_values} values")
    if not values:
        return write_table(df, path, "parquet", mode, partition_by=tuple(by) if folders else (), **settings)

    keys, counts = [tuple(v)[:-1] for v in values], [v[-1] for v in values]
    widths = _encoded_widths(df, by, keys, counts, sample_rows, settings)
    sizes = [rows * width / target_bytes for rows, width in zip(counts, widths)]
    if folders:
        spans = [float(max(1, round(size))) for size in sizes]
        files = int(sum(spans))
    else:
        files = max(1, round(sum(sizes)))
        spans = [size * files / sum(sizes) for size in sizes]
    starts = [0.0]
    for span in spans[:-1]:
        starts.append(starts[-1] + span)

    placed, start, span = _with_numbers(df, by, keys, starts, spans)
    number = F.least(F.floor(start + _share(df) * span), F.lit(files - 1)).cast("int")
    dealt = placed.repartitionById(files, number).select(*map(field, df.columns))
    if not folders:
        dealt = dealt.sortWithinPartitions(*map(field, by))
    return write_table(dealt, path, "parquet", mode, partition_by=tuple(by) if folders else (), **settings)


def _share(df: DataFrame) -> Column:
    """Where a row stands among the rows of its value: from 0 to below 1, by hash."""
    return F.pmod(row_hash(hashable(df)), F.lit(SHARES)) / F.lit(float(SHARES))


def _with_numbers(
    df: DataFrame, by: Sequence[str], keys: Sequence[tuple], first: Sequence[float], second: Sequence[float]
) -> tuple[DataFrame, Column, Column]:
    """Every row with the two numbers of its value. The table of values is as small as ``most_values`` says."""
    names = [free_name(f"value_{i}", df) for i in range(len(by))]
    one, other = free_name("first", df), free_name("second", df)
    schema = StructType([StructField(n, df.schema[b].dataType) for n, b in zip(names, by)])
    schema = schema.add(one, DoubleType()).add(other, DoubleType())
    numbers = df.sparkSession.createDataFrame([(*k, float(a), float(b)) for k, a, b in zip(keys, first, second)], schema)
    same = all_of(field(b).eqNullSafe(F.col(n)) for n, b in zip(names, by))
    return df.join(F.broadcast(numbers), same), F.col(one), F.col(other)


def _encoded_widths(
    df: DataFrame, by: Sequence[str], keys: Sequence[tuple], counts: Sequence[int], sample_rows: int, settings: dict[str, Any]
) -> list[float]:
    """Bytes a row of each value, from one sample file each in the shared folder; the mean where the sample missed a value."""
    spark, value = df.sparkSession, free_name("value", df)
    met, number, rows = _with_numbers(df, by, keys, range(len(keys)), counts)
    sample = met.where(_share(df) * rows < sample_rows).select(*map(field, df.columns), number.cast("int").alias(value))
    folder = new_folder(spark, "sized-sample")
    sample = sample.repartitionById(len(keys), F.col(value))
    write_table(sample, folder, partition_by=(value,), **{**settings, "max_records_per_file": None})
    stored = spark.read.parquet(folder).select(value, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
    files = stored.groupBy(value, "file", "size").agg(F.count(F.lit(1)).alias("rows"))
    found = dict(files.groupBy(value).agg(F.sum("size") / F.sum("rows")).collect())
    remove(spark, folder)
    usual = sum(found.values()) / len(found)
    return [found.get(i, usual) for i in range(len(keys))]


def file_sizes(df: DataFrame, *by: str) -> DataFrame:
    """The columns ``by``, file, bytes and rows of every file that a table was read from."""
    read = df.select(*map(field, by), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
    return read.groupBy(*map(field, by), "file", "bytes").agg(F.count(F.lit(1)).alias("rows"))
