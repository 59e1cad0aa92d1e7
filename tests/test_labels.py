import math

from pyspark.sql import functions as F

from wavelake.operators import geometry, labels
from wavelake.operators.interval_join import interval_join

NAN = math.nan


def show(values):
    return ["?" if math.isnan(v) else v for v in values]


def test_states(spark):
    ev = "array<struct<target:bigint,start:double,end:double,value:float>>"
    df = spark.createDataFrame([([(0, 0.0, 1.0, 1.0), (1, 0.0, 1.0, NAN), (1, 0.0, 1.0, 1.0), (2, 0.0, 1.0, NAN)],), ([],)], f"e {ev}")
    got = [show(r[0]) for r in df.select(labels.tri_state(F.col("e"), 4)).collect()]
    assert got == [[1, 1, "?", 0], [0, 0, 0, 0]]


def test_multihot(spark):
    df = spark.createDataFrame([([0, 2, 2],), ([],), (None,)], "x array<bigint>")
    assert [r[0] for r in df.select(labels.multihot(F.col("x"), 3)).collect()] == [[1, 0, 1], [0, 0, 0], [0, 0, 0]]


def test_clipping_leaves_out_what_only_touches(spark):
    seg = spark.createDataFrame([("a", 10.0, 20.0)], "audio_path string, seg_start double, seg_end double")
    ev = spark.createDataFrame([("a", 5.0, 12.0, 1.0), ("a", 18.0, 30.0, NAN), ("a", 5.0, 10.0, 1.0), ("a", 20.0, 22.0, 1.0), ("b", 11.0, 12.0, 1.0), ("a", NAN, 12.0, 1.0), ("a", None, 12.0, 1.0)], "audio_path string, ev_start double, ev_end double, value float")
    got = sorted((r["ev_start"], r["ev_end"]) for r in labels.clip_events(seg, ev, 3.0).collect())
    assert got == [(0.0, 2.0), (8.0, 10.0)]


def test_join_equals_brute_force(spark):
    import random

    rng = random.Random(3)
    make = lambda n: [(rng.choice("ab"), i, rng.uniform(0, 50), 0.0) for i in range(n)]
    left = [(k, i, s, s + rng.choice([0.5, 5, 40])) for k, i, s, _ in make(60)]
    right = [(k, i, s, s + rng.choice([0.0, 0.1, 7, 30])) for k, i, s, _ in make(60)]
    l = spark.createDataFrame(left, "k string, i int, a double, b double")
    r = spark.createDataFrame(right, "k string, j int, c double, d double")
    got = sorted((x["i"], x["j"]) for x in interval_join(l, r, ["k"], ("a", "b"), ("c", "d"), 4.0).collect())
    want = sorted((i, j) for k, i, a, b in left for q, j, c, d in right if k == q and c < d and a < d and b > c)
    assert got == want


def test_frame_labels_compare_single_precision(spark):
    # A frame's edge and an event that begins a trifle later in double precision coincide.
    df = spark.createDataFrame([([(0, 0.25 + 1e-12, 0.6, 1.0), (1, 0.1, 0.25 + 1e-12, NAN)],)], "e array<struct<target:bigint,start:double,end:double,value:float>>")
    grid = geometry.frame_geometry(3, 0.25, F.lit(3), F.lit(0.75))
    got = df.select(labels.frame_codes(grid, F.col("e"), 2)).first()[0]
    assert got == [[0, 1], [2, 0], [2, 0]]


def test_frame_grid(spark):
    df = spark.range(1)
    g = df.select(geometry.frame_geometry(3, 0.25, F.lit(2), F.lit(0.5))).first()[0]
    assert [(x["start"], x["end"]) for x in g] == [(0.0, 0.25), (0.25, 0.5), (0.0, 0.0)]
    g = df.select(geometry.frame_geometry(3, 0.25, F.lit(1), F.lit(0.2))).first()[0]
    assert round(g[0]["end"], 6) == 0.2 and g[1]["end"] == 0
    # The last valid frame takes what is left.
    assert df.select(geometry.frame_geometry(3, 0.25, F.lit(3), F.lit(1.0))).first()[0][2]["end"] == 1.0


def test_join_of_outlying_intervals(spark):
    left = [("a", 1, 0.0, 10.0), ("a", 2, 3.0, 5e14), ("a", 3, -8e12, 1.0), ("b", 4, 0.0, math.inf)]
    right = [("a", 5, 2.0, 4.0), ("a", 6, 4e14, 4e14 + 2), ("a", 7, 0.5, 8e12), ("b", 8, 1.0, 2.0), ("a", 9, -7e12, 6e14)]
    for x, y in ((left, right), (right, left)):
        l = spark.createDataFrame(x, "k string, i int, a double, b double")
        r = spark.createDataFrame(y, "k string, j int, c double, d double")
        got = sorted((r["i"], r["j"]) for r in interval_join(l, r, ["k"], ("a", "b"), ("c", "d"), 1.0).collect())
        assert got == sorted((i, j) for k, i, a, b in x for m, j, c, d in y if k == m and b < math.inf and d < math.inf and a < d and c < b)
