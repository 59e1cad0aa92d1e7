"""Fixed-length segments of entries: the ragged explode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def plan_segments(df: DataFrame, start: Column, end: Column, duration: Column, seg: float, hop: float, tol: float = 0.0) -> DataFrame:
    """Adds ``segment_id, seg_start, seg_end, valid_sec``: one row per segment of each entry.

    The region of an entry ends at the earlier of its end and the duration. Segments begin every ``hop`` seconds from the
    entry's start; the last ones are shorter than ``seg``. Segments after the first are kept only if they last longer than
    ``tol``. Entries whose region is empty, or with a null or NaN bound, give no rows (``empty_regions`` lists them).
    """
    if not (seg > 0 and hop > 0 and tol >= 0):
        raise ValueError("seg and hop must be positive, tol not negative")
    region = _region(end, duration)
    n = F.ceil((F.col("_to") - F.col("_from")) / F.lit(float(hop))).cast("bigint")
    at = F.col("_from") + F.lit(float(hop)) * F.col("segment_id").cast("double")
    return (
        df.withColumn("_from", start.cast("double"))
        .withColumn("_to", region.cast("double"))
        .where(F.col("_from").isNotNull() & ~F.isnan("_from") & (F.col("_to") > F.col("_from")) & (F.col("_to") < F.lit(float("inf"))))
        .withColumn("segment_id", F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1)))
        .withColumn("seg_start", at)
        .withColumn("valid_sec", F.least(F.lit(float(seg)), F.col("_to") - F.col("seg_start")))
        .where((F.col("segment_id") == 0) | (F.col("valid_sec") > F.lit(float(tol))))
        .withColumn("seg_end", F.col("seg_start") + F.col("valid_sec"))
        .drop("_from", "_to")
    )


def _region(end: Column, duration: Column) -> Column:
    """The earlier of both; null if either is null or NaN."""
    known = end.isNotNull() & ~F.isnan(end) & duration.isNotNull() & ~F.isnan(duration)
    return F.when(known, F.least(end, duration))


def empty_regions(df: DataFrame, start: Column, end: Column, duration: Column) -> DataFrame:
    """The entries that give no segment; a build stops on them."""
    return df.where(~F.coalesce((_region(end, duration) > start) & ~F.isnan(start), F.lit(False)))
