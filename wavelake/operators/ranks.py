"""Dense ranks over a whole table without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavelake.session import cut


def global_rank(df: DataFrame, column: str, name: str) -> DataFrame:
    """``column, name``: each different value and its rank from 0 in ascending order; nulls have none.

    Values are range-partitioned and sorted; the numbers of values of the partitions before (one count per partition)
    shift each partition's own numbering.
    """
    v = df.select(F.col(column)).where(F.col(column).isNotNull()).distinct()
    srt = v.repartitionByRange(column).sortWithinPartitions(column)
    placed = cut(srt.withColumn("_p", F.spark_partition_id()).withColumn("_r", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)))
    counts = sorted((r["_p"], r["n"]) for r in placed.groupBy("_p").agg(F.count(F.lit(1)).alias("n")).collect())
    rows, total = [], 0
    for p, n in counts:
        rows.append((p, total))
        total += n
    base = df.sparkSession.createDataFrame(rows or [(-1, 0)], "_p int, _base bigint")
    return placed.join(F.broadcast(base), "_p").select(column, (F.col("_base") + F.col("_r")).alias(name))  # one row per partition


def ordered_distinct(df: DataFrame, column: str, position: str) -> DataFrame:
    """Different values with the position of their first appearance."""
    return df.groupBy(column).agg(F.min(position).alias(position))
