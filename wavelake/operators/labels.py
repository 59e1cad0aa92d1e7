"""Label expressions: three states, many-hot vectors, clipped events.

States are computed as codes (0 absent, 1 uncertain, 2 present) whose maximum is the wanted precedence, since NaN is the
largest number in Spark; they become 1.0, NaN and 0.0 at the very end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavelake.operators.interval_join import interval_join, overlaps

NAN = float("nan")


def state_code(value: Column) -> Column:
    """1 for an uncertain (NaN or null) event, 2 for any other value."""
    return F.when(value.isNull() | F.isnan(value), F.lit(1)).otherwise(F.lit(2))


def state_value(code: Column) -> Column:
    """The float a code stands for."""
    return F.when(code >= 2, F.lit(1.0)).when(code == 1, F.lit(NAN)).otherwise(F.lit(0.0)).cast("float")


def multihot(indexes: Column, classes: int) -> Column:
    """1.0 at every listed class, 0.0 elsewhere; a null or empty list gives zeros."""
    return F.transform(F.sequence(F.lit(0), F.lit(classes - 1)), lambda c: F.coalesce(F.array_contains(indexes, c.cast("bigint")), F.lit(False)).cast("float"))


def clip(start: Column, end: Column, seg_start: Column, seg_end: Column) -> tuple[Column, Column]:
    """Bounds of an event inside a segment, counted from the segment's start."""
    return F.greatest(start, seg_start) - seg_start, F.least(end, seg_end) - seg_start


def clip_events(segments: DataFrame, events: DataFrame, bucket: float = 60.0) -> DataFrame:
    """Events of each segment, clipped and rebased: the columns of both, ``ev_start, ev_end`` replaced.

    ``segments`` has audio_path, seg_start, seg_end; ``events`` has audio_path, ev_start, ev_end.
    """
    met = interval_join(segments, events, ["audio_path"], ("seg_start", "seg_end"), ("ev_start", "ev_end"), bucket)
    a, b = clip(F.col("ev_start"), F.col("ev_end"), F.col("seg_start"), F.col("seg_end"))
    return met.withColumns({"ev_start": a, "ev_end": b})


def weak_codes(clipped: DataFrame, by: list[str], value: str = "value") -> DataFrame:
    """The state code of every class hit, per ``by``; classes without an event are absent (code 0)."""
    return clipped.groupBy(*by).agg(F.max(state_code(F.col(value))).alias("code"))


def event_array(events: DataFrame) -> DataFrame:
    """``audio_path, events``: the events of each recording as an array in their order.

    For recordings of ordinary length; very long ones go through ``clip_events``.
    """
    e = F.struct("ord", "target", F.col("ev_start").alias("start"), F.col("ev_end").alias("end"), "value")
    return events.groupBy("audio_path").agg(F.transform(F.array_sort(F.collect_list(e)), lambda x: F.struct(x["target"].alias("target"), x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value"))).alias("events"))


def tri_state(events: Column, classes: int) -> Column:
    """Per class the state over all events of an array (target, start, end, value)."""

    def one(c: Column) -> Column:
        codes = F.transform(F.filter(events, lambda e: e["target"] == c), lambda e: state_code(e["value"]))
        return state_value(F.coalesce(F.array_max(codes), F.lit(0)))

    return F.transform(F.sequence(F.lit(0), F.lit(classes - 1)), one)


def frame_codes(geometry: Column, events: Column, classes: int) -> Column:
    """Per frame and class the state code of the events that overlap the frame; bounds are compared as floats."""

    def cell(g: Column, c: Column) -> Column:
        hit = F.filter(events, lambda e: (e["target"] == c) & overlaps(e["start"].cast("float"), e["end"].cast("float"), g["start"], g["end"]))
        return F.coalesce(F.array_max(F.transform(hit, lambda e: state_code(e["value"]))), F.lit(0))

    return F.transform(geometry, lambda g: F.transform(F.sequence(F.lit(0), F.lit(classes - 1)), lambda c: cell(g, c)))


def frame_hits(clipped: DataFrame, step: float, valid_frames: Column, valid_sec: Column) -> DataFrame:
    """Adds ``frame``: one row per clipped event (ev_start, ev_end) and frame of the grid of ``frame_geometry`` that it overlaps.

    An event is spread over the few frames around it rather than every frame being looked at; the exact comparison of the bounds, in
    single precision, follows. An event beyond the last frame's own slot lies in the last frame, which takes what is left.
    """
    f = F.lit(step).cast("float")
    a, b, v, last = F.col("ev_start").cast("float"), F.col("ev_end").cast("float"), valid_sec.cast("float"), valid_frames.cast("bigint") - 1
    lo = F.greatest(F.lit(0), F.least(last, F.floor(a / f) - 1))
    hi = F.greatest(lo, F.least(last, F.ceil(b / f) + 1))
    spread = clipped.withColumn("_last", last).withColumn("frame", F.explode(F.sequence(lo, hi)))
    start = F.col("frame").cast("float") * f
    end = F.when(F.col("frame") == F.col("_last"), v).otherwise(F.least((F.col("frame") + 1).cast("float") * f, v))
    return spread.where(overlaps(a, b, start, end)).drop("_last")
