import random
from datetime import datetime

from hypothesis import given, settings
from hypothesis import strategies as st

from wavelake.llm import related as rl

T0 = datetime(2024, 1, 1)
ENTRY = "entry_id bigint, dataset string, split string, audio_path string, received_at timestamp_ntz, unit string"


def find(edges):
    root = {}

    def f(x):
        root.setdefault(x, x)
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in edges:
        a, b = f(a), f(b)
        root[max(a, b)] = min(a, b)
    return {x: f(x) for x in root}


def test_components(spark):
    rng = random.Random(2)
    cases = [[(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 200)], [(rng.randrange(80), rng.randrange(80)) for _ in range(60)], [(99 - i, 99 - i - 1) for i in range(30)] + [(500, 7)]]
    for edges in cases:
        got = {r["node"]: r["root"] for r in rl.components(spark.createDataFrame([*edges, (None, 3)], "a bigint, b bigint")).collect()}
        want = {k: v for k, v in find([e for e in edges if e[0] != e[1]]).items()}
        assert got == want
    assert rl.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_groups(spark):
    rows = [
        (1, "fsd50k", "train", "FSD50K.dev_audio/100.wav"),
        (2, "urbansound8k", "test", "audio/fold1/0100-1-2-3.wav"),  # the same sound
        (3, "fsd50k", "train", "FSD50K.dev_audio/200.wav"),  # the same uploader as 100
        (4, "fsd50k", "test", "FSD50K.dev_audio/300.wav"),  # an unknown uploader
        (5, "fsd50k", "train", "FSD50K.dev_audio/400.wav"),
        (6, "audioset_strong", "train", "audio/train/abcdefghijk_1000.wav"),
        (7, "audioset_strong", "test", "audio/eval/abcdefghijk_2000.wav"),
        (8, "audioset_strong", "test", "audio/eval/ABCdefghijk_2000.WAV"),  # another video, but the same file where case is ignored
        (9, "audioset_strong", "train", "audio/eval/ABCdefghijk_7.wav"),
        (10, "hyenaset", "train", "wav/Collar 1/a.wav"),
        (11, "hyenaset", "validation", "WAV/collar 1/b.wav"),
        (12, "datased", "train", "sed/x.wav"),
        (13, "datased", "train", "sed/y.wav"),
        (14, None, "train", None),
        (15, "datased", "test", "sed\\x.wav"),
    ]
    e = spark.createDataFrame([(*r, T0, "clash") for r in rows + rows[:3]], ENTRY)
    d = spark.createDataFrame([(" 100", " Ann"), ("200.wav", "ANN "), ("300", "unknown"), ("400", "Unknown "), ("500", "ann"), (None, "ann"), ("x", None)], "fname string, uploader string")
    g = {r["entry_id"]: r["group_id"] for r in rl.groups(e, d).collect()}
    assert g == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 6, 7: 6, 8: 6, 9: 6, 10: 10, 11: 10, 12: 12, 13: 13, 15: 12}
    assert rl.groups(e.limit(0), d).count() == 0 and rl.groups(e, d.limit(0)).count() == 14
    torn = {(r["group_id"], r["entry_id"]) for r in rl.scattered(rl.groups(e, d), rl.assign_splits(rl.groups(e, d), [("train", 1.0)])).collect()}
    assert torn == {(k, i) for i, k in g.items() if k in (1, 6, 10, 12)}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=40), st.integers(2, 6))
def test_difference_places_every_weight(weights, bins):
    owner = rl.difference(weights, bins)
    assert len(owner) == len(weights) and all(0 <= k < bins for k in owner)
    load = [0] * bins
    for w, k in zip(weights, owner):
        load[k] += w
    if weights:
        assert max(load) - min(load) <= max(weights)


def test_difference_known_case():
    # The textbook case: 8, 7, 6, 5, 4 in two bins end two apart.
    owner = rl.difference([8, 7, 6, 5, 4], 2)
    load = [sum(w for w, k in zip([8, 7, 6, 5, 4], owner) if k == b) for b in (0, 1)]
    assert sorted(load) == [14, 16]


def test_assignment_is_whole_and_near_the_targets(spark, monkeypatch):
    # One part; several parts; parts on two levels of the tree.
    for part, fan in ((50_000, 64), (300, 64), (60, 4)):
        monkeypatch.setattr(rl, "PART", part)
        monkeypatch.setattr(rl, "FAN", fan)
        check_assignment(spark)


def check_assignment(spark):
    rows = [(i, i % 997, "train") for i in range(4000)] + [(9000 + i, 5000, "test") for i in range(2000)]  # a third of all rows is one group
    g = rl.cut(spark.createDataFrame(rows, "entry_id bigint, group_id bigint, split string"))
    a = {r["group_id"]: (r["n"], r["new_split"]) for r in rl.assign_splits(g, [("test", 0.1), ("train", 0.8), ("validation", 0.1)]).collect()}
    assert len(a) == 998 and sum(n for n, _ in a.values()) == 6000
    share = {s: sum(n for n, t in a.values() if t == s) / 6000 for s in ("train", "validation", "test")}
    assert abs(share["train"] - 0.8) < 0.01 and abs(share["test"] - 0.1) < 0.01
    empty = g.limit(0)
    assert rl.assign_splits(empty, [("train", 1.0)]).count() == 0
