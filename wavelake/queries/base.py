"""Tables as the queries see them: repeated rows once, times checked. With the SQL that gives the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavelake.session import table
from wavelake.sources.manifest import entry_path

SEG = 10.0


def recordings(spark: SparkSession, d: str) -> DataFrame:
    """``audio_path, dataset, duration``: the row received last of each recording, if it has a duration."""
    r = table(spark, d, "recordings").groupBy("audio_path").agg(F.max(F.struct("received_at", "duration_sec", "dataset")).alias("x"))
    return r.select("audio_path", F.col("x.dataset").alias("dataset"), F.col("x.duration_sec").alias("duration")).where(F.col("duration") > 0)


REC = """rec AS (
  SELECT audio_path, dataset, duration_sec AS duration FROM (
    SELECT *, row_number() OVER (PARTITION BY audio_path ORDER BY received_at DESC, duration_sec DESC NULLS LAST) AS rn FROM recordings)
  WHERE rn = 1 AND duration_sec > 0)"""


def events(spark: SparkSession, d: str) -> DataFrame:
    """``audio_path, ord, class_name, ev_start, ev_end, value``: each event once, with usable times."""
    e = table(spark, d, "strong_events").groupBy("audio_path", "ord").agg(F.max(F.struct("received_at", "class_name", "start", "end", "value")).alias("x"))
    e = e.select("audio_path", "ord", F.col("x.class_name").alias("class_name"), F.col("x.start").alias("ev_start"), F.col("x.end").alias("ev_end"), F.col("x.value").alias("value"))
    return e.where(F.col("ev_start").isNotNull() & ~F.isnan("ev_start") & F.col("ev_end").isNotNull() & ~F.isnan("ev_end") & (F.col("ev_start") < F.col("ev_end")))


EV = """ev AS (
  SELECT audio_path, ord, class_name, start AS ev_start, "end" AS ev_end, value FROM (
    SELECT *, row_number() OVER (PARTITION BY audio_path, ord ORDER BY received_at DESC) AS rn FROM strong_events)
  WHERE rn = 1 AND isfinite(start) AND isfinite("end") AND start < "end")"""


def entries(spark: SparkSession, d: str) -> DataFrame:
    """``entry_id, dataset, split, entry_idx, audio_path, start, end``: each entry once, its path with forward slashes."""
    e = table(spark, d, "split_entries").groupBy("entry_id").agg(F.max(F.struct("received_at", "dataset", "split", "entry_idx", "audio_path", "start", "end")).alias("x"))
    e = e.select("entry_id", "x.dataset", "x.split", "x.entry_idx", "x.audio_path", "x.start", "x.end")
    return e.withColumn("audio_path", entry_path(F.col("audio_path")))


ENT = """ent AS (
  SELECT entry_id, dataset, split, entry_idx, regexp_replace(replace(audio_path, chr(92), '/'), '^/+', '') AS audio_path, start, "end" FROM (
    SELECT *, row_number() OVER (PARTITION BY entry_id ORDER BY received_at DESC) AS rn FROM split_entries) WHERE rn = 1)"""


def cache(spark: SparkSession, d: str) -> DataFrame:
    """The raw cache with each row_id once."""
    c = table(spark, d, "raw_cache")
    rest = [x for x in c.columns if x not in ("row_id", "received_at")]
    return c.groupBy("row_id").agg(F.max(F.struct("received_at", *rest)).alias("x")).select("row_id", *(F.col(f"x.{x}").alias(x) for x in rest))


CACHE = """cache AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY received_at DESC) AS rn FROM raw_cache) WHERE rn = 1)"""

# Segments of ten seconds over whole recordings.
SEGS = f"""segs AS (
  SELECT audio_path, dataset, duration, segment_id, segment_id * {SEG}::DOUBLE AS seg_start, least({SEG}::DOUBLE, duration - segment_id * {SEG}::DOUBLE) AS valid_sec
  FROM (SELECT *, unnest(range(0, ceil(duration / {SEG}::DOUBLE)::BIGINT)) AS segment_id FROM rec))"""
