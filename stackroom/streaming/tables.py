"""Tables of a folder that files keep arriving in: row-wise operators on a stream, and repeated keys by state.

A run takes what has arrived since the run before and ends. What it has read, and the state of keys, stand in the
checkpoint; what it has written stands in the log of the output folder, batch by batch. A batch that a stopped run had
begun is done again under its number and its files replace those of the try before, so each row is written once.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from stackroom.functions.columns import all_of, field
from stackroom.operators.checks import Check
from stackroom.sources.tables import LAYER_SETTINGS, writer_options

# Tasks get the functions here along with their work, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def read_arriving(spark: SparkSession, folder: str, schema: StructType, files_at_once: int | None = None) -> DataFrame:
    """Parquet files of a folder as a stream, so many files in a batch at most."""
    options = {"maxFilesPerTrigger": files_at_once} if files_at_once else {}
    return spark.readStream.schema(schema).options(**options).parquet(folder)


def write_arrived(stream: DataFrame, output: str, checkpoint: str) -> int:
    """Append what has arrived to the parquet table ``output``; returns the rows read. One checkpoint belongs to one output."""
    writer = stream.writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint)
    for name, value in writer_options(LAYER_SETTINGS).items():
        writer = writer.option(name, value)
    query = writer.outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return sum(p["numInputRows"] if isinstance(p, dict) else p.numInputRows for p in query.recentProgress)


def repeated_key_rows(stream: DataFrame, check: Check) -> DataFrame:
    """Rows of a stream whose key has come before, and the first of them once the second comes: the rows that a
    ``duplicate_key`` check fails. Rows with a null in their key never fail.

    State is a row for each key that has come once, and a mark for each that has come more often. Rows of a key come in
    pieces and go on at once, so a frequent key is never held.
    """
    keys = list(check.key_columns)
    schema = stream.schema
    complete = stream.filter(all_of(field(k).isNotNull() for k in keys))

    def watch(key, pieces: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        first = state.get[0] if state.exists else None
        often = state.exists and first is None
        for piece in pieces:
            if not often and first is None:
                first, piece = pickle.dumps(piece.iloc[:1]), piece.iloc[1:]
            if len(piece) and not often:
                yield pickle.loads(first)
                first, often = None, True
            if len(piece):
                yield piece
        state.update((first,))

    found = complete.groupBy(*[field(k) for k in keys]).applyInPandasWithState(
        watch, schema, "first binary", "append", GroupStateTimeout.NoTimeout
    )
    others = [c for c in stream.columns if c not in keys]
    return found.select(*[field(c) for c in keys + others])


def arrive(
    spark: SparkSession, folder: str, schema: StructType, build: Callable[[DataFrame], DataFrame], output: str, checkpoint: str,
    files_at_once: int | None = None,
) -> int:
    """One run: what has come into ``folder``, through ``build``, to ``output``."""
    return write_arrived(build(read_arriving(spark, folder, schema, files_at_once)), output, checkpoint)
