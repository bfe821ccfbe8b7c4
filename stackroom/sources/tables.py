"""Named tables, readers and writers."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

READABLE = ("parquet", "csv")

# Names of writer settings in a job config, and what Spark calls them.
WRITER_OPTIONS = {
    "max_records_per_file": "maxRecordsPerFile",
    "parquet_block_size": "parquet.block.size",
    "parquet_page_size": "parquet.page.size",
    "parquet_dictionary_size": "parquet.dictionary.page.size",
    "compression": "compression",
    "zstd_level": "parquet.compression.codec.zstd.level",
}

# Settings of tables that are one of many layers with the same texts: pages are packed more tightly, and if the first page of a
# row group has texts more than once, each is held once in the row group, up to this size.
LAYER_SETTINGS = {"compression": "zstd", "zstd_level": 9, "parquet_dictionary_size": 16 << 20}


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", **options: Any) -> DataFrame:
    """A parquet table, or a CSV table with a header and text columns."""
    if fmt not in READABLE:
        raise ValueError(f"input format must be one of {READABLE}, not {fmt!r}")
    header = {"header": True} if fmt == "csv" else {}
    return spark.read.format(fmt).options(**header, **options).load(path)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partitions: int | None = None,
    partition_by: tuple[str, ...] = (),
    **settings: Any,
) -> int:
    """Write in any format Spark knows and return the number of rows, counted on the way.

    ``partitions`` shuffles to that many files instead of lowering the parallelism
    of what comes before. Settings are the keys of ``WRITER_OPTIONS`` or Spark's own.
    """
    if partitions:
        df = df.repartition(partitions)
    seen = Observation()
    options = writer_options(settings)
    if fmt == "csv":
        options = {"header": True, **options}
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.options(**options).save(path)
    return seen.get["rows"]


def writer_options(settings: Mapping[str, Any]) -> dict[str, Any]:
    """Settings by Spark's own names."""
    return {WRITER_OPTIONS.get(k, k): v for k, v in settings.items() if v is not None}


def write_summary(df: DataFrame, path: str, fmt: str = "csv") -> int:
    """A handful of rows as one file."""
    if fmt not in READABLE:
        raise ValueError(f"summary format must be one of {READABLE}, not {fmt!r}")
    return write_table(df.coalesce(1), path, fmt)


def write_failed_rows(df: DataFrame, path: str, fmt: str = "csv") -> int:
    """Failed rows in a folder per check. The whole output is replaced, so no check keeps old rows.

    If nothing failed there are no folders; one file without rows keeps the columns, so that the output can be read.
    """
    if fmt not in READABLE:
        raise ValueError(f"failed rows format must be one of {READABLE}, not {fmt!r}")
    written = write_table(df, path, fmt, partition_by=("check_name",))
    if not written:
        write_table(df.sparkSession.createDataFrame([], df.schema).coalesce(1), path, fmt)
    return written


class Assets:
    """Paths by data set and asset name."""

    def __init__(self, paths: Mapping[str, Mapping[str, str]]):
        self.paths = paths

    def path(self, dataset: str, asset: str, override: str | None = None) -> str:
        """The explicit path if there is one, else the one on record."""
        if override:
            return override
        if dataset not in self.paths:
            raise KeyError(f"no data set {dataset!r} among {sorted(self.paths)}")
        if asset not in self.paths[dataset]:
            raise KeyError(f"data set {dataset!r} has no asset {asset!r}")
        return self.paths[dataset][asset]

    def read(
        self, spark: SparkSession, dataset: str, asset: str, fmt: str = "parquet", path: str | None = None
    ) -> DataFrame:
        return read_table(spark, self.path(dataset, asset, path), fmt)

    def write(self, df: DataFrame, dataset: str, asset: str, path: str | None = None, **options: Any) -> int:
        return write_table(df, self.path(dataset, asset, path), **options)
