"""Queries of arithmetic and array operators: frame laws, rounding, pooling, normalisation."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wavelake.functions.frontends import decibels, standardise
from wavelake.models.encoders import length_groups, max_mean
from wavelake.operators import geometry as g
from wavelake.queries.base import REC, SEGS
from wavelake.queries.timeline import segments
from wavelake.session import table

QUERIES: dict = {}
SQL: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")




def _wave_sql() -> str:
    steps, prev = [], "n"
    for i, (k, s) in enumerate(g.WAVE_CONVOLUTIONS):
        steps.append(f"w{i} AS (SELECT *, CASE WHEN {prev} < {k} THEN 0 ELSE ({prev} - {k}) // {s} + 1 END AS c{i} FROM {'base' if i == 0 else f'w{i - 1}'})")
        prev = f"c{i}"
    return ", ".join(steps)


@query(
    f"""WITH base AS (SELECT l_orderkey, l_linenumber, l_orderkey AS n FROM lineitem), {_wave_sql()}
SELECT l_orderkey, l_linenumber, n // 160 + 1 AS panns_frames, greatest(1, (n // 160 + 1) // 32) AS panns_tokens,
  CASE WHEN n < 400 THEN 0 ELSE least((n - 400) // 160 + 1, 1024) END AS ast_frames, least(greatest((n + 1599) // 1600, 1), 101) AS ast_tokens,
  greatest(n, 513) // 160 + 1 AS atst_frames, (greatest(n, 513) // 160 + 1) // 4 AS atst_tokens,
  (greatest(n, 2800) - 400) // 160 + 1 AS beats_frames, ((greatest(n, 2800) - 400) // 160 + 1) // 16 AS beats_tokens, c6 AS wave_tokens FROM w6"""
)
def q34_frame_count_laws(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("l_orderkey")
    laws = {"panns_frames": g.panns_frames, "panns_tokens": g.panns_tokens, "ast_frames": g.ast_frames, "ast_tokens": g.ast_tokens, "atst_frames": g.atst_frames, "atst_tokens": g.atst_tokens, "beats_frames": g.beats_frames, "beats_tokens": g.beats_tokens, "wave_tokens": g.wave_tokens}
    return _lines(spark, d).select("l_orderkey", "l_linenumber", *(f(n).cast("bigint").alias(k) for k, f in laws.items()))


def _ratio_sql(a: str, b: str) -> str:
    return f"({a} // {b} + CASE WHEN 2 * ({a} % {b}) > {b} OR (2 * ({a} % {b}) = {b} AND ({a} // {b}) % 2 = 1) THEN 1 ELSE 0 END)"


@query(f"SELECT l_orderkey, l_linenumber, {_ratio_sql('l_partkey', '(2 * l_linenumber)')} AS q FROM lineitem")
def q35_ratio_round_even(spark: SparkSession, d: str) -> DataFrame:
    return _lines(spark, d).select("l_orderkey", "l_linenumber", g.ratio_half_even(F.col("l_partkey"), F.col("l_linenumber") * 2).alias("q"))


@query(
    "SELECT l_orderkey, l_linenumber, "
    + ", ".join(f"least(greatest({_ratio_sql(f'({2 * i + 1} * (1001 + l_partkey))', '6')} - 500, 0), l_partkey) AS c{i}" for i in range(3))
    + " FROM lineitem"
)
def q36_crop_starts(spark: SparkSession, d: str) -> DataFrame:
    c = g.crop_starts(F.col("l_partkey") + 1001)
    return _lines(spark, d).select("l_orderkey", "l_linenumber", *(x.alias(f"c{i}") for i, x in enumerate(c)))


@query(
    """WITH f AS (SELECT row_number() OVER () AS rid, l_orderkey, l_linenumber, l_partkey + 900 AS frames FROM lineitem),
c AS (SELECT *, unnest(range(0, (frames - 1) // 1000 + 1)) AS chunk FROM f),
p AS (SELECT rid, l_orderkey, l_linenumber, chunk, least(1000, frames - chunk * 1000) AS size FROM c)
SELECT l_orderkey, l_linenumber, chunk, size // 4 AS patches, round((size // 4)::DOUBLE / sum(size // 4) OVER (PARTITION BY rid), 9) AS weight FROM p WHERE size >= 4"""
)
def q37_chunk_weights(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("l_partkey") + 900
    return g.with_chunks(_lines(spark, d), n).select("l_orderkey", "l_linenumber", "chunk", "patches", "weight")


def _vectors(spark: SparkSession, d: str) -> DataFrame:
    """Vectors as waveforms of which the first 1 + vec_id % 64 numbers are valid, in double precision."""
    return table(spark, d, "embeddings").select("vec_id", (F.col("vec_id") % 64 + 1).cast("int").alias("n"), F.transform("embedding", lambda x: x.cast("double")).alias("x"))


_VEC = "vec AS (SELECT vec_id, (vec_id % 64 + 1)::INT AS n, embedding::DOUBLE[] AS x FROM embeddings)"
_LONG = f"{_VEC}, long AS (SELECT vec_id, n, unnest(range(0, 64)) AS i, unnest(x) AS v FROM vec)"


def _over_vectors(spark: SparkSession, d: str, f: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """``vec_id, i, v``: the numbers of ``f`` over batches of vectors (rows x 64, lengths of the valid parts)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                y = f(np.vstack(pdf["x"].to_numpy()), pdf["n"].to_numpy())
                yield pd.DataFrame({"vec_id": np.repeat(pdf["vec_id"].to_numpy(), y.shape[1]), "i": np.tile(np.arange(y.shape[1]), len(y)), "v": y.reshape(-1)})

    return _vectors(spark, d).mapInPandas(run, "vec_id bigint, i bigint, v double")


def _long(df: DataFrame, value: Column, name: str = "v") -> DataFrame:
    return df.select("vec_id", F.posexplode(value).alias("i", name)).withColumn("i", F.col("i").cast("bigint"))


@query(
    f"""WITH {_LONG}, s AS (SELECT vec_id, avg(v) AS m, avg(v * v) AS q FROM long WHERE i < n GROUP BY vec_id)
SELECT vec_id, i, round(CASE WHEN i < n THEN (v - m) / sqrt(greatest(q - m * m, 0) + 1e-7) ELSE 0 END, 5) + 0.0 AS v FROM long JOIN s USING (vec_id)"""
)
def q38_standardise_prefix(spark: SparkSession, d: str) -> DataFrame:
    """The valid parts standardised, zeros behind them; rows of one length together, as the front ends and encoders do it."""

    def each(x: np.ndarray, n: np.ndarray) -> np.ndarray:
        out = np.zeros_like(x)
        for pick in length_groups(n):
            out[pick, : n[pick[0]]] = standardise(x[pick, : n[pick[0]]])
        return np.round(out, 5) + 0.0

    return _over_vectors(spark, d, each)


@query(
    f"""WITH {_LONG}, db AS (SELECT vec_id, i, 10 * log10(greatest(v * v, 1e-10)) AS v FROM long)
SELECT vec_id, i, round(greatest(v, max(v) OVER (PARTITION BY vec_id) - 20.0), 6) AS v FROM db"""
)
def q39_top_db_floor(spark: SparkSession, d: str) -> DataFrame:
    return _over_vectors(spark, d, lambda x, n: np.round(decibels(x * x, 20.0), 6))


@query(f"WITH {_LONG}, s AS (SELECT vec_id, sqrt(sum(v * v)) AS l FROM long GROUP BY vec_id) SELECT vec_id, i, round(v / l, 6) + 0.0 AS v FROM long JOIN s USING (vec_id) WHERE l > 0")
def q40_l2_normalise(spark: SparkSession, d: str) -> DataFrame:
    s = _vectors(spark, d).withColumn("l", F.sqrt(F.aggregate("x", F.lit(0.0), lambda a, y: a + y * y))).where("l > 0")
    return _long(s, F.transform("x", lambda y: F.round(y / F.col("l"), 6) + 0.0))


@query(f"WITH {_LONG} SELECT vec_id, round(avg(v), 6) + 0.0 AS mean, round(max(v) + avg(v), 6) + 0.0 AS max_mean, max(v) AS top FROM long WHERE i < n GROUP BY vec_id")
def q41_pooling(spark: SparkSession, d: str) -> DataFrame:
    """Pooled valid parts, rows of one length together."""

    def each(x: np.ndarray, n: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), 3))
        for pick in length_groups(n):
            h = x[pick, : n[pick[0]], None]
            out[pick] = np.concatenate([np.round(h.mean(1), 6), np.round(max_mean(h), 6), h.max(1)], 1)
        return out + 0.0

    g = _over_vectors(spark, d, each).groupBy("vec_id").pivot("i", [0, 1, 2]).agg(F.first("v"))
    return g.select("vec_id", F.col("0").alias("mean"), F.col("1").alias("max_mean"), F.col("2").alias("top"))


@query("SELECT vec_id % 64 + 1 AS n, count(*) AS n_rows FROM embeddings GROUP BY 1")
def q42_length_groups(spark: SparkSession, d: str) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            n = pdf["vec_id"].to_numpy() % 64 + 1
            groups = length_groups(n)
            yield pd.DataFrame({"n": [n[g[0]] for g in groups], "k": [len(g) for g in groups]})

    return table(spark, d, "embeddings").select("vec_id").mapInPandas(run, "n bigint, k bigint").groupBy("n").agg(F.sum("k").alias("n_rows"))


@query(f"WITH {_LONG} SELECT vec_id, count(*) FILTER (WHERE i < n) AS n_valid, 80 - count(*) FILTER (WHERE i < n) AS n_padding FROM long GROUP BY vec_id")
def q43_pad_mask(spark: SparkSession, d: str) -> DataFrame:
    v = _vectors(spark, d).withColumn("padded", F.concat(F.slice("x", F.lit(1), F.col("n")), F.array_repeat(F.lit(0.0), F.lit(80) - F.col("n")))).withColumn("mask", g.valid_mask(80, F.col("n")))
    n = F.size(F.filter("mask", lambda m: m)).cast("bigint")
    return v.select("vec_id", n.alias("n_valid"), (F.size("padded") - n).alias("n_padding"))


@query(f"WITH {REC}, {SEGS} SELECT audio_path, segment_id, seg_start, seg_start + valid_sec AS seg_end, valid_sec FROM segs")
def q44_provenance_passthrough(spark: SparkSession, d: str) -> DataFrame:
    return segments(spark, d).select("audio_path", "segment_id", "seg_start", "seg_end", "valid_sec")


@query(f"WITH {REC}, {SEGS} SELECT dataset, count(*) AS n_segments, count(DISTINCT audio_path) AS n_recordings FROM segs GROUP BY dataset")
def q45_counts_per_split(spark: SparkSession, d: str) -> DataFrame:
    """Segments and recordings per dataset; counted per recording first, so that nothing distinct is shuffled."""
    per = segments(spark, d).groupBy("dataset", "audio_path").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("dataset").agg(F.sum("n").alias("n_segments"), F.count(F.lit(1)).alias("n_recordings"))
