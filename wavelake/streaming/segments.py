"""Segmentation of recordings as they arrive.

Segments of one recording depend on that recording alone, so the stream needs no state but for repeated deliveries, which are
dropped within a watermark over the time they are read. How old a recording is makes no difference, so backfills may come in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from wavelake.operators.segments import plan_segments


def stream_recordings(spark: SparkSession, folder: str, schema: StructType | str, files_per_trigger: int = 1000) -> DataFrame:
    """Recordings from Parquet files that appear in ``folder``."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def stream_segments(recordings: DataFrame, seg: float, hop: float, tol: float = 0.0, late: str = "30 days") -> DataFrame:
    """Segments of a stream of recordings (audio_path, duration_sec, received_at), each delivery of a path and length once.

    What was seen is remembered for ``late`` after it was read; a repetition after that comes again, to be removed when
    reading. No first delivery is left out.
    """
    timed = recordings.withColumn("received_at", F.col("received_at").cast("timestamp")).withColumn("_read_at", F.current_timestamp()).withWatermark("_read_at", late)
    once = timed.dropDuplicatesWithinWatermark(["audio_path", "duration_sec"])
    return plan_segments(once, F.lit(0.0), F.lit(float("inf")), F.col("duration_sec"), seg, hop, tol).select("audio_path", "received_at", "segment_id", "seg_start", "seg_end", "valid_sec")


def write_segments(segments: DataFrame, target: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Appends segments to Parquet; ``once`` works off what is there and ends."""
    w = segments.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append")
    return (w.trigger(availableNow=True) if once else w.trigger(processingTime="10 seconds")).start()
