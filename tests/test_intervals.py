import random

from wavelake.operators.intervals import merge_intervals, periods_and_gaps, whole_ms


def brute(rows):
    by = {}
    for k, s, e in rows:
        if s is not None and e is not None and s < e:
            by.setdefault(k, set()).add((s, e))
    out = set()
    for k, iv in by.items():
        merged = []
        for s, e in sorted(iv):
            if merged and s <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], e)
                merged[-1][2] += 1
            else:
                merged.append([s, e, 1])
        for i, (s, e, n) in enumerate(merged):
            out.add((k, s, e, n > 1, merged[i + 1][0] if i + 1 < len(merged) else None))
    return out


def merged(spark, rows, block=1000):
    df = spark.createDataFrame(rows, "k string, s bigint, e bigint")
    return {(r["k"], r["from_ms"], r["to_ms"], r["many"], r["next_ms"]) for r in merge_intervals(df, ["k"], "s", "e", block).collect()}


def test_against_brute_force(spark):
    rng = random.Random(1)
    rows = []
    for k in ("a", "b", None):
        for _ in range(150):
            s = rng.randrange(0, 20000)
            rows.append((k, s, s + rng.choice([0, -5, 1, 40, 300, 4000])))
    rows += rows[:50] + [("a", None, 5), ("b", 3, None)]
    for block in (100, 1000, 10**9):
        assert merged(spark, rows, block) == brute(rows)


def test_one_hot_key_over_many_blocks(spark):
    # Two thirds of all rows are one key; a long interval carries over hundreds of blocks, most rows are copies.
    rows = [("hot", 10 * i, 10 * i + 4) for i in range(3000)] + [("hot", 5, 15_000)] + [("hot", 7, 9)] * 500 + [(f"k{i}", 0, 10) for i in range(1000)]
    assert merged(spark, rows, 50) == brute(rows)


def test_touching_and_nested_and_equal(spark):
    rows = [("a", 0, 10), ("a", 10, 20), ("b", 0, 10), ("b", 2, 5), ("c", 1, 2), ("c", 1, 2), ("d", -5, -1), ("d", 0, 3)]
    assert merged(spark, rows) == {("a", 0, 20, True, None), ("b", 0, 10, True, None), ("c", 1, 2, False, None), ("d", -5, -1, False, 0), ("d", 0, 3, False, None)}


def test_empty_and_clashing_columns(spark):
    df = spark.createDataFrame([], "k string, s bigint, e bigint, _s string, _b int")
    assert merge_intervals(df, ["k"], "s", "e").count() == 0
    df = spark.createDataFrame([("x", 1, 2, "y", 3)], "k string, s bigint, e bigint, _s string, _b int")
    assert merge_intervals(df, ["k"], "s", "e").count() == 1


def test_gaps_up_to_a_limit(spark):
    df = spark.createDataFrame([("a", 0, 10), ("a", 5, 12), ("a", 20, 30), ("a", 100, 110)], "k string, s bigint, e bigint")
    got = {(r["kind"], r["from_ms"], r["to_ms"]) for r in periods_and_gaps(merge_intervals(df, ["k"], "s", "e"), ["k"], 50).collect()}
    assert got == {("period", 0, 12), ("gap", 12, 20)}


def test_whole_ms(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1.0004999,), (float("nan"),), (float("inf"),), (None,), (2.0,)], "x double")
    assert [r[0] for r in df.select(whole_ms(F.col("x"))).collect()] == [1000, None, None, None, 2000]


def test_times_far_apart(spark):
    far = 5 * 10**17
    rows = [(f"k{i % 40}", i, i + 3) for i in range(400)] + [("k1", -far, 3), ("k2", 7, far), ("k3", far - 9, far), ("k3", far, far + 1)]
    assert merged(spark, rows, 10**16) == brute(rows)
