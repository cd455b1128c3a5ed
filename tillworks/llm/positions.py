"""Consecutive numbers for rows in a given order, without passing the rows of a key through one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillworks.llm.common import stored

#: monotonically_increasing_id has the partition above these bits and the row in it below.
_ROW_BITS = 33


def numbered_rows(frame: DataFrame, keys: list[str], order: list[str], position: str = "position", size: str = "size") -> DataFrame:
    """The rows with ``position`` (from 0, by ``order``) and ``size`` among the rows of equal ``keys``;
    null is a key of its own and comes first.

    Rows are dealt out by ranges, so a hot key lies in many partitions. Every partition's rows are
    numbered where they lie; how many rows a key has in the partitions before is a sum over one row
    for each key and partition. Without ``order`` rows are numbered as they lie.
    """
    if keys or order:
        by = [F.col(c).asc_nulls_first() for c in [*keys, *order]]
        frame = frame.repartitionByRange(*by).sortWithinPartitions(*by)
    rows = stored(frame.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_at", _ROW_BITS).cast("int")
    runs = rows.groupBy(*keys, part.alias("_part")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    # One row for each partition that a key lies in.
    of_key = Window.partitionBy(*keys)
    before = F.sum("_n").over(of_key.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumn("_before", F.coalesce(before, F.lit(0))).withColumn("_size", F.sum("_n").over(of_key))
    runs = runs.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_part").alias("_p"), "_first", "_before", "_size")
    same = F.col("_part") == F.col("_p")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return rows.withColumn("_part", part).join(runs, same).select(
        *frame.columns, (F.col("_at") - F.col("_first") + F.col("_before")).alias(position), F.col("_size").alias(size))
