"""Positions and running sums in a total order without a single-task window.

Rows are split into ranges of the order, summed per range, and shifted by the totals of the ranges before: one row per
range is all that is gathered. A group holding a third of all rows is spread over its share of the ranges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docquarry.common import materialise, small


def prefix_sums(df: DataFrame, order: list[str], value: str, out: str) -> DataFrame:
    """The rows with the sum of ``value`` over all rows before them; ``order`` must be a total order. Null counts as 0."""
    names = [c for c in df.columns]
    kinds = dict(df.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pid, total = TaskContext.get().partitionId(), 0
        for batch in batches:
            v = np.asarray(pa.compute.fill_null(batch.column(value).cast(pa.int64()), 0))
            sums = np.cumsum(v)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums - v + total), pa.array(np.full(len(v), pid, np.int32)), pa.array(v)], [*names, "__run", "__p", "__v"])
            total += int(sums[-1]) if len(sums) else 0

    import pyarrow.compute  # noqa: F401

    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in names), "__run bigint, __p int, __v bigint"])
    ranged = materialise(df.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema))
    parts = ranged.groupBy("__p").agg(F.sum("__v").alias("__t"))
    shift = parts.select("__p", F.coalesce(F.sum("__t").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__o"))
    return ranged.join(F.broadcast(shift), "__p").withColumn(out, F.col("__run") + F.col("__o")).select(*names, out)


def positions(df: DataFrame, order: list[str], out: str = "position") -> DataFrame:
    """The rows with their place (from 0) in the order."""
    return prefix_sums(df.withColumn("__one", F.lit(1)), order, "__one", out).drop("__one")


def within(df: DataFrame, group: list[str], prefix: str, out: str) -> DataFrame:
    """A running sum of the whole order made one within each group, which must lie together in that order."""
    first = df.groupBy(*(F.col(g).alias(f"__g{i}") for i, g in enumerate(group))).agg(F.min(prefix).alias("__first"))
    on = [F.col(g).eqNullSafe(F.col(f"__g{i}")) for i, g in enumerate(group)]
    return df.join(small(first), on).withColumn(out, F.col(prefix) - F.col("__first")).drop("__first", *(f"__g{i}" for i in range(len(group))))
