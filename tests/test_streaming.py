from datetime import datetime

from wavelake.streaming.segments import stream_recordings, stream_segments, write_segments

SCHEMA = "audio_path string, duration_sec double, received_at timestamp_ntz"


def test_stream_equals_batch(spark, tmp_path):
    t = datetime(2024, 1, 1)
    src = str(tmp_path / "in")
    spark.createDataFrame([("a", 25.0, t), ("b", 5.0, t), ("c", None, t)], SCHEMA).coalesce(1).write.parquet(src)
    spark.createDataFrame([("a", 25.0, t), ("d", 10.0, t)], SCHEMA).coalesce(1).write.mode("append").parquet(src)
    out = str(tmp_path / "out")
    s = stream_segments(stream_recordings(spark, src, SCHEMA, 1), 10.0, 10.0)
    write_segments(s, out, str(tmp_path / "ckpt"), once=True).awaitTermination()
    got = sorted((r["audio_path"], r["segment_id"], r["valid_sec"]) for r in spark.read.parquet(out).collect())
    assert got == [("a", 0, 10.0), ("a", 1, 10.0), ("a", 2, 5.0), ("b", 0, 5.0), ("d", 0, 10.0)]


def test_backfill_in_any_order(spark, tmp_path):
    """A first delivery far older than the newest seen is kept, a repeated one is not."""
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    for rows in ([("new", 5.0, datetime(2024, 6, 1))], [("mid", 5.0, datetime(2024, 5, 31))], [("old", 5.0, datetime(2023, 1, 1)), ("new", 5.0, datetime(2024, 6, 2))], [("old", 5.0, datetime(2023, 1, 1))]):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)
        s = stream_segments(stream_recordings(spark, src, SCHEMA, 1), 10.0, 10.0)
        write_segments(s, out, str(tmp_path / "ckpt"), once=True).awaitTermination()
    assert sorted((r["audio_path"], r["received_at"].year) for r in spark.read.parquet(out).collect()) == [("mid", 2024), ("new", 2024), ("old", 2023)]
