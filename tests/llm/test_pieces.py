import math
import random
from datetime import datetime

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from wavelake.llm import pieces as pc

INF, NAN = math.inf, math.nan
T0 = datetime(2024, 1, 1)
RAW = "row_id bigint, dataset string, audio_path string, start double, end double, valid_sec double, received_at timestamp_ntz, busy string"
EVENT = "audio_path string, class_name string, start double, end double, value float"


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 3000), st.integers(5, 200), st.lists(st.tuples(st.integers(0, 3000), st.integers(1, 300)), max_size=30))
def test_cuts_are_quiet_wherever_they_can_be(length, size, busy):
    merged = []
    for s, n in sorted(busy):
        if merged and s <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], s + n)
        else:
            merged.append([s, s + n])
    lo, hi = np.array([m[0] for m in merged], np.int64), np.array([m[1] for m in merged], np.int64)
    cuts = pc.bisect(0, length, size, lo, hi)
    edges = [0, *cuts, length]
    assert all(0 < b - a <= size for a, b in zip(edges, edges[1:])) or length <= size
    loud = lambda t: any(a <= t < b for a, b in merged)
    for c in cuts:
        if loud(c):
            # No quiet moment lay between the cuts around it when it was made.
            k = edges.index(c)
            assert all(loud(t) for t in range(edges[k - 1] + 1, edges[k + 1])) or any(not loud(x) for x in cuts)


def run(spark, raw, events, limits=(("d", 10.0, 1.0),), **sizes):
    r = spark.createDataFrame([(*x, T0, "clash") for x in raw], RAW)
    lim = spark.createDataFrame(list(limits), "dataset string, max_sec double, overlap_sec double")
    items = pc.oversized(r, lim)
    out = {}
    for p in pc.pieces(items, spark.createDataFrame(events, EVENT), **sizes).orderBy("row_id", "piece").collect():
        out.setdefault(p["row_id"], []).append((p["from_ms"], p["to_ms"], p["quiet"]))
    return out


def test_pieces(spark):
    rng = random.Random(1)
    events = [("a", "x", t, t + rng.choice([0.5, 3.0, 14.0]), rng.choice([1.0, NAN])) for t in np.arange(0, 2000, 5.0).tolist()] + [("a", "x", NAN, 3.0, 1.0), ("a", "x", 5.0, 4.0, 1.0)]
    raw = [(1, "d", "a", 0.0, 25.0, 25.0), (2, "d", "a", 100.0, NAN, 1500.0), (3, "d", "a", 0.0, 10.0, 99.0), (4, "d", "a", 0.0, None, None), (5, "d", "a", 0.0, INF, NAN), (6, "other", "a", 0.0, 500.0, 1.0), (7, "d", "b", 0.0, 10.001, 1.0), (1, "d", "a", 0.0, 25.0, 25.0), (8, "d", None, 0.0, 30.0, 1.0)]
    got = run(spark, raw, events)
    assert set(got) == {1, 2, 7, 8}
    busy = [(round(a * 1000), round(b * 1000)) for _, _, a, b, _ in events if not math.isnan(a) and b > a]
    for i, (a, b) in {1: (0, 25_000), 2: (100_000, 1_600_000), 7: (0, 10_001), 8: (0, 30_000)}.items():
        p = got[i]
        assert p[0][0] == a and p[-1][1] == b
        for (x, y, _), (u, v, quiet) in zip(p, p[1:]):
            assert u == y - 1000 and v > y
            if i in (1, 2):
                assert quiet == (not any(s <= y < e for s, e in busy))
        assert all(y - x <= 10_000 for x, y, _ in p)
    assert run(spark, [], []) == {}
    # The only quiet moment is far from the middle and is used all the same.
    one = run(spark, [(1, "d", "c", 0.0, 12.0, 1.0)], [("c", "x", 0.0, 3.2, 1.0), ("c", "x", 3.3, 12.0, 1.0)])
    assert one[1][1][2] and 3200 <= one[1][0][1] <= 3300


def test_items_of_many_stretches_are_cut_alike(spark):
    rng = random.Random(4)
    events = [(p, "x", t, t + rng.choice([0.5, 3.0, 4.9, 14.0]), 1.0) for p in "ab" for t in np.arange(0, 1500, 5.0).tolist()]
    raw = [(1, "d", "a", 0.0, 900.0, 1.0), (2, "d", "b", 3.5, 1400.0, 1.0), (3, "d", "a", 0.0, 30.0, 1.0), (4, "d", "c", 0.0, 70.0, 1.0), (5, "d", None, 0.0, 70.0, 1.0), (6, "d", "b", 700.0, 725.5, 1.0)]
    want = run(spark, raw, events)
    assert set(want) == {1, 2, 3, 4, 5, 6}
    assert run(spark, raw, events, many=7) == want == run(spark, raw, events, many=60)


def test_outlying_events(spark):
    raw = [(1, "d", "a", 0.0, 25.0, 25.0), (2, "d", "b", 0.0, 25.0, 25.0)]
    got = run(spark, raw, [("a", "x", 1.0, 5e14, 1.0), ("a", "x", -8e12, 0.5, 1.0), ("b", "x", 10.0, 8e12, 1.0), ("b", "x", 3.0, 4.0, 1.0)])
    assert got[1][0] == (0, 999, True) and not any(q for _, _, q in got[1][2:]) and [b for _, b, _ in got[2]][:2] == [4_999, 9_999]
    assert got[2][-1][1] == got[1][-1][1] == 25_000 and all(b - a <= 10_000 for p in got.values() for a, b, _ in p)
