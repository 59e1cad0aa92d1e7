import pytest
from pyspark.sql import functions as F

from wavelake.operators import geometry as g

LAWS = [
    (g.wave_tokens, {400: 1, 719: 1, 720: 2, 16000: 49, 100: 0}),
    (g.beats_frames, {320: 16, 2799: 16, 2800: 16, 2960: 17, 16000: 98}),
    (g.atst_frames, {160: 4, 512: 4, 513: 4, 640: 5, 1600: 11, 16000: 101, 160000: 1001}),
    (g.ast_frames, {399: 0, 400: 1, 560: 2, 164080: 1024}),
    (g.ast_tokens, {1: 1, 1600: 1, 1601: 2, 170000: 101}),
    (lambda n: g.panns_tokens(n, 320), {320: 1, 320000: 31}),
]


@pytest.mark.parametrize("law,table", LAWS)
def test_laws(spark, law, table):
    df = spark.createDataFrame([(n,) for n in table], "n bigint")
    assert {r["n"]: r["v"] for r in df.select("n", law(F.col("n")).alias("v")).collect()} == table


def test_ratio_rounds_half_to_even(spark):
    df = spark.createDataFrame([(1, 2), (3, 2), (5, 2), (7, 3), (0, 5)], "a bigint, b bigint")
    assert [r[0] for r in df.select(g.ratio_half_even(F.col("a"), F.col("b"))).collect()] == [0, 2, 2, 2, 0]


def test_crops(spark):
    want = {1002: (0, 1, 1), 1137: (0, 68, 136), 2001: (0, 500, 1000), 6001: (500, 2500, 4501)}
    df = spark.createDataFrame([(n,) for n in want], "n bigint")
    assert {r["n"]: (r["a"], r["b"], r["c"]) for r in df.select("n", *(x.alias(k) for x, k in zip(g.crop_starts(F.col("n")), "abc"))).collect()} == want


def test_chunks(spark):
    df = spark.createDataFrame([(1000,), (1003,), (1004,), (3,)], "n int")
    assert [r[0] for r in df.select(g.chunk_patches(F.col("n"))).collect()] == [[250], [250], [250, 1], []]


def test_samples_round_half_to_even(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,)], "v double")
    assert [r[0] for r in df.select(g.samples(F.col("v"), 1)).collect()] == [0, 2, 2]
