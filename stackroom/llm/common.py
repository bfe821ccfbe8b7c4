"""What several operators share: tables, shared folders, and walking the rows of a task."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from stackroom.sources.workspace import free_shuffles

#: Rows that are Python objects at one time inside a task.
ROWS_AT_ONCE = 256


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder that the driver and all executors see: below ``spark.checkpoint.dir``.

    Only a local session may do without that setting. The folder goes when the driver ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="stackroom-")
        spark.conf.set("spark.checkpoint.dir", base)
    folder = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, folder)
    return folder


def _remove(spark: SparkSession, folder: str) -> None:
    context = spark.sparkContext
    if context._jsc is None or context._jvm is None:
        return
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: lineage is cut, and lost executors lose nothing."""
    spark = df.sparkSession
    folder = shared_folder(spark, label)
    df.write.parquet(folder)
    schema = df.schema
    del df
    free_shuffles(spark)
    return spark.read.schema(schema).parquet(folder)


def discard(df: DataFrame) -> None:
    """Delete what ``materialize`` wrote, once nothing will read it again."""
    for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
        _remove(df.sparkSession, folder)


def slices(batches: Iterable[pa.RecordBatch], rows: int = ROWS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def row_by_row(fn: Callable, schema: pa.Schema, rows: int = ROWS_AT_ONCE) -> Callable:
    """For ``mapInArrow``: ``fn`` gets the values of a row and gives the values of one row of ``schema``."""

    def run(batches):
        for part in slices(batches, rows):
            found = [fn(*values) for values in zip(*(part.column(i).to_pylist() for i in range(part.num_columns)))]
            columns = list(zip(*found)) if found else [[] for _ in schema]
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit integers over all 64-bit integers, one to one."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x
