"""Running totals within groups, without a task that has a whole group.

A window function sorts each group in one task. Here rows are cut into sorted ranges, which may cut a group; each range runs
its own totals, and what a group has gathered in the ranges before is added afterwards. It is one row for each range.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _totals(values: np.ndarray, opens: np.ndarray, add) -> np.ndarray:
    """Running totals that start anew where ``opens``; the first row opens a group."""
    total = add.accumulate(values)
    first = np.flatnonzero(opens)
    undo = total[first - 1]
    undo[0] = 0
    undo = np.repeat(undo, np.diff(np.append(first, len(values))))
    return total ^ undo if add is np.bitwise_xor else total - undo


def _runner(group: str, sums: Sequence[str], xors: Sequence[str]):
    """For ``mapInArrow`` over one sorted range: adds totals, whether a row's group is the range's first, and whether it is the last row."""
    columns = [(c, np.add) for c in sums] + [(c, np.bitwise_xor) for c in xors]

    def run(batches):
        first = current = None
        carry = [0] * len(columns)
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                yield held(False)
            groups = batch.column(group).to_numpy(zero_copy_only=False)
            first = groups[0] if first is None else first
            opens = np.append(True, groups[1:] != groups[:-1])
            stop = int(np.argmax(groups != groups[0])) or len(groups)
            totals = []
            for i, (name, add) in enumerate(columns):
                total = _totals(batch.column(name).to_numpy(zero_copy_only=False), opens, add)
                if groups[0] == current:
                    total[:stop] = add(total[:stop], np.int64(carry[i]))
                carry[i] = total[-1]
                totals.append(pa.array(total))
            current = groups[-1]

            def held(last, batch=batch, totals=totals, head=groups == first):
                ends = np.zeros(batch.num_rows, bool)
                ends[-1] = last
                names = [*batch.schema.names, *(f"run_{c}" for c, _ in columns), "run_head", "run_last"]
                return pa.record_batch([*batch.columns, *totals, pa.array(head), pa.array(ends)], names=names)

        if held is not None:
            yield held(True)

    return run


def running(rows: DataFrame, group: str, order: Sequence[str | Column], sums: Sequence[str] = (), xors: Sequence[str] = ()) -> DataFrame:
    """``rows`` with ``run_<name>`` for each of the long columns named: their sum or exclusive or over the rows of the group up to this one.

    ``group`` is a long column without nulls. The result stands in the shared folder.
    """
    keys = [F.col(group), *order]
    ranges = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("run_part", F.spark_partition_id())
    names = [f"run_{c}" for c in (*sums, *xors)]
    added = ", ".join(f"{n} long" for n in names)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranges.schema)
    placed = materialize(ranges.mapInArrow(_runner(group, sums, xors), f"{schema}, {added}, run_head boolean, run_last boolean"), "running")

    carries, current, carried = [], None, [0] * len(names)
    for edge in placed.where("run_last").select("run_part", group, "run_head", *names).orderBy("run_part").collect():
        carries.append((edge.run_part, current, *carried))
        own = [edge[n] for n in names]
        if edge.run_head and edge[group] == current:
            own = [a + b if i < len(sums) else a ^ b for i, (a, b) in enumerate(zip(own, carried))]
        current, carried = edge[group], own
    before = rows.sparkSession.createDataFrame(carries, "run_part int, run_group long, " + ", ".join(f"{n}_before long" for n in names))
    same = F.col("run_head") & F.col(group).eqNullSafe(F.col("run_group"))

    def whole(i: int, name: str) -> Column:
        more = F.when(same, F.col(f"{name}_before")).otherwise(F.lit(0))
        return (F.col(name) + more if i < len(sums) else F.col(name).bitwiseXOR(more)).alias(name)

    # A row for each range, so no more than there are shuffle partitions.
    return placed.join(F.broadcast(before), "run_part").select(*rows.columns, *(whole(i, n) for i, n in enumerate(names)))
