"""Join of intervals that overlap, per key, without comparing all pairs of a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Buckets that an interval covers at most at its own level, and by which the levels' widths grow.
SPAN = 64
#: Bounds from which an interval counts as infinite.
FAR = 1e19


def overlaps(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Intersection of positive length; touching intervals do not overlap."""
    return (a_start < b_end) & (a_end > b_start)


def interval_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_span: tuple[str, str], right_span: tuple[str, str], bucket: float) -> DataFrame:
    """Inner join of ``left`` and ``right`` on equal ``on`` and overlapping spans (half-open, in one unit).

    Both sides are spread over buckets and joined on key and bucket, so a key with very many intervals is spread over its buckets. Buckets of
    level 0 have width ``bucket``, those of every further level are SPAN times wider; an interval lies at the first level at which it
    covers no more than about SPAN of them, so one of any length makes few rows. A pair meets at the higher of its two levels, in the first
    bucket that both cover. The levels in use (some ten numbers at most) are looked up first; without long intervals there is one.

    Rows with a null, NaN or infinite bound, or an empty span, join nothing. Other columns keep their names and must differ
    between the sides.
    """

    def placed(df: DataFrame, span: tuple[str, str], tag: str) -> DataFrame:
        a, b = (F.col(f"`{c}`").cast("double") for c in span)
        fine = a.isNotNull() & b.isNotNull() & ~F.isnan(a) & ~F.isnan(b) & (a < b) & (F.abs(a) < FAR) & (F.abs(b) < FAR)
        long = (b - a) / F.lit(float(bucket) * SPAN)
        level = F.when(long > 1, F.ceil(F.log(long) / F.log(F.lit(float(SPAN))))).otherwise(0).cast("int")
        return df.where(fine).withColumns({f"_a{tag}": a, f"_b{tag}": b, f"_v{tag}": level})

    def spread(df: DataFrame, tag: str, levels: list[int], above: bool) -> DataFrame:
        """Rows at their own level, or at all ``levels`` from (``above``: beyond) their own."""
        if levels:
            rule = (lambda v: v > F.col(f"_v{tag}")) if above else (lambda v: v >= F.col(f"_v{tag}"))
            df = df.withColumn("_level", F.explode(F.filter(F.array(*map(F.lit, levels)), rule)))
        else:
            df = df.withColumn("_level", F.col(f"_v{tag}"))
        width = F.lit(float(bucket)) * F.pow(F.lit(float(SPAN)), "_level")
        lo, hi = F.floor(F.col(f"_a{tag}") / width), F.floor(F.col(f"_b{tag}") / width)
        return df.withColumn(f"_{tag}0", lo).withColumn("_bucket", F.explode(F.sequence(lo, hi)))

    l, r = placed(left, left_span, "l"), placed(right, right_span, "r")
    used = l.select(F.lit(0).alias("side"), F.col("_vl").alias("v")).unionByName(r.select(F.lit(1).alias("side"), F.col("_vr").alias("v"))).distinct().collect()
    lefts, rights = (sorted({x["v"] for x in used if x["side"] == s} | {0}) for s in (0, 1))
    pair = overlaps(F.col("_al"), F.col("_bl"), F.col("_ar"), F.col("_br")) & (F.col("_bucket") == F.greatest("_l0", "_r0"))
    keys = [*on, "_level", "_bucket"]
    extra = ["_al", "_bl", "_vl", "_ar", "_br", "_vr", "_l0", "_r0", "_level", "_bucket"]
    met = spread(l, "l", rights if max(rights) else [], False).join(spread(r, "r", [], False), keys).where(pair).drop(*extra)
    if max(lefts):
        met = met.unionByName(spread(l, "l", [], False).join(spread(r, "r", lefts, True), keys).where(pair).drop(*extra))
    return met
