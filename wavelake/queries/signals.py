"""Queries through front ends and encoders: vectors stand in for waveforms."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavelake.functions.frontends import FlooredMel
from wavelake.models.registry import create_model
from wavelake.session import table
from wavelake.sources.wav import list_array

RATE = 16_000
REPEATS = 500


def _waves(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of 64 numbers repeated to two seconds; the valid part is (1 + vec_id % 64) / 64 of it."""
    x = b.column("embedding").flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(b.num_rows, 64)
    n = b.column("vec_id").to_numpy() % 64 + 1
    return np.tile(x, (1, REPEATS)), (n * REPEATS / RATE).astype(np.float32)


def _vectors(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select("vec_id", "embedding").where(F.size("embedding") == 64)


def q46_frontend_logmel_arrow(spark: SparkSession, d: str) -> DataFrame:
    """Mean mel energy of every vector's valid part, and its number of frames."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        front = FlooredMel()
        for b in batches:
            if b.num_rows:
                f = front(*_args(b))
                mean = np.array([f["input_features"][i, :n].mean() for i, n in enumerate(f["valid"])], np.float64)
                yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(f["valid"]), pa.array(np.round(mean, 4))], ["vec_id", "n_frames", "mean_level"])

    return _vectors(spark, d).mapInArrow(run, "vec_id bigint, n_frames bigint, mean_level double")


def _args(b: pa.RecordBatch) -> tuple[np.ndarray, int, np.ndarray]:
    wave, seconds = _waves(b)
    return wave, RATE, seconds


def q47_toy_encoder_embed(spark: SparkSession, d: str) -> DataFrame:
    """Embeddings of every vector by the model without weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = create_model("checksum", granularity="clip")
        for b in batches:
            if b.num_rows:
                out = model.embed(*_args(b))
                yield pa.RecordBatch.from_arrays([b.column("vec_id"), list_array(out["embedding"]), list_array(out["geometry"])], ["vec_id", "embedding", "geometry"])

    got = _vectors(spark, d).mapInArrow(run, "vec_id bigint, embedding array<float>, geometry array<float>")
    return got.select("vec_id", (F.round(F.get("embedding", 0).cast("double"), 3) + 0.0).alias("total"), F.round(F.get("embedding", 1).cast("double"), 6).alias("seconds"), F.round(F.get("geometry", 1).cast("double"), 6).alias("til"))


QUERIES = {"q46_frontend_logmel_arrow": q46_frontend_logmel_arrow, "q47_toy_encoder_embed": q47_toy_encoder_embed}
SQL = {
    "q47_toy_encoder_embed": """
WITH long AS (SELECT vec_id, vec_id % 64 + 1 AS n, unnest(range(0, 64)) AS i, unnest(embedding)::DOUBLE AS v FROM embeddings WHERE len(embedding) = 64),
-- The valid part is n * 500 samples of the repeated vector: whole copies, and the first of one more.
w AS (SELECT vec_id, n, i, v, (n * 500) // 64 + CASE WHEN i < (n * 500) % 64 THEN 1 ELSE 0 END AS times FROM long)
SELECT vec_id, round(sum(v * times)::FLOAT::DOUBLE, 3) + 0.0 AS total, round(max(n) * 500 / 16000.0::DOUBLE, 6) AS seconds, round(max(n) * 500 / 16000.0::DOUBLE, 6) AS til FROM w GROUP BY vec_id"""
}
