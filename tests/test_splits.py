import random

import pytest
from pyspark.sql import functions as F

from wavelake.operators import ranks, splits
from wavelake.sources import manifest as mf


def by_split(df, item="item"):
    out = {}
    for r in df.collect():
        out.setdefault(r["split"], []).append(r[item])
    return out


def items(spark, n=57, label="x"):
    return spark.createDataFrame([(f"f{i}", label) for i in range(n)] + [("g1", "y"), ("g2", "y"), (None, "y")], "item string, label string")


def test_stratified_in_the_jvm(spark):
    s = splits.stratified_split(items(spark), "item", "label")
    rows = s.collect()
    n = {k: sum(r["split"] == k and r["label"] == "x" for r in rows) for k in splits.SPLITS}
    assert n == {"train": 46, "validation": 6, "test": 5}
    assert {r["split"] for r in rows if r["label"] == "y"} == {"train"}  # two of a class all train
    again = splits.stratified_split(items(spark).repartition(5), "item", "label")
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in rows}
    other = splits.stratified_split(items(spark), "item", "label", seed=1)
    assert {tuple(r) for r in other.collect()} != {tuple(r) for r in rows}
    with pytest.raises(AssertionError):
        splits.stratified_split(items(spark), "item", "label", (0.8, 0.1, 0.2))


def test_stratified_by_the_generator(spark):
    got = by_split(splits.stratified_split_shuffled(items(spark), "item", "label", seed=3).where("label = 'x'"))
    ids = sorted(f"f{i}" for i in range(57))
    random.Random("3:x").shuffle(ids)
    assert [sorted(got[s]) for s in splits.SPLITS] == [sorted(ids[:46]), sorted(ids[46:52]), sorted(ids[52:])]


def test_cut_points():
    assert [splits.cut_points(n) for n in (1, 2, 3, 5, 10, 15)] == [(1, 1), (2, 2), (2, 2), (4, 4), (8, 9), (12, 14)]


def test_greedy_covers_rare_classes():
    rng = random.Random(4)
    files = [(f"f{i:03}", frozenset(rng.sample(["a", "b", "c"], rng.randint(0, 2))), rng.uniform(1, 9)) for i in range(90)] + [(f"r{i}", frozenset(["rare"]), 2.0) for i in range(3)]
    got = splits.greedy_duration_split(files)
    assert sorted(x for v in got.values() for x in v) == sorted(f[0] for f in files)
    w = {f[0]: f[2] for f in files}
    total = sum(w.values())
    assert abs(sum(w[x] for x in got["train"]) / total - 0.8) < 0.05
    for s in ("validation", "test"):
        for c in ("a", "b", "c", "rare"):
            assert any(c in f[1] for f in files if f[0] in got[s])
    assert splits.greedy_duration_split([]) == {"train": [], "validation": [], "test": []}


def test_greedy_choices():
    # y is the rarer class, so b goes first, to training; of x validation and test lack more then, and equal needs go to the earlier split.
    assert splits.greedy_duration_split([("a", frozenset("x"), 1.0), ("b", frozenset("xy"), 4.0), ("c", frozenset(), 9.0)]) == {"train": ["b", "c"], "validation": ["a"], "test": []}
    lack = splits.Lack([frozenset("xy"), frozenset("y")], [2.0, 3.0], (0.5, 0.25, 0.25))
    assert lack.rarity == {"x": 0, "y": 1} and lack.open.tolist() == [[1.0, 0.5, 0.5], [2.5, 1.25, 1.25], [2.5, 1.25, 1.25]]
    lack.take([0, 1], 0, 2.0)
    assert lack.neediest([0]) == 1 and lack.neediest([1]) == 1 and lack.neediest([]) == 1
    place = {"a": "train", "b": "train", "c": "train"}
    splits.represent(place, [("a", frozenset("xy"), 1.0), ("b", frozenset("x"), 5.0), ("c", frozenset("x"), 4.0)])
    assert place == {"a": "train", "b": "test", "c": "validation"}


def test_folds_and_names(spark):
    df = spark.createDataFrame([(1,), (2,)], "fold int")
    assert [r[0] for r in df.select(splits.fold_split(F.col("fold"), {1: "train", 2: "test"})).collect()] == ["train", "test"]
    with pytest.raises(Exception, match="unknown fold 2"):
        df.select(splits.fold_split(F.col("fold"), {1: "train"})).collect()


def test_copy_rule(spark):
    df = spark.createDataFrame([("train", "a"), ("test", "b")], "split string, audio_path string")
    assert sorted(tuple(r) for r in splits.copy_missing(df).collect()) == [("test", "b"), ("train", "a"), ("validation", "b")]
    with pytest.raises(AssertionError):
        splits.copy_missing(df.where("split = 'test'"))


def test_ranks(spark):
    rng = random.Random(0)
    names = [f"n{rng.randrange(500):03}é" for _ in range(2000)]
    df = spark.createDataFrame([(n,) for n in names] + [(None,)], "name string")
    got = {r[0]: r[1] for r in ranks.global_rank(df.repartition(6), "name", "id").collect()}
    assert got == {n: i for i, n in enumerate(sorted(set(names)))}
    assert ranks.global_rank(df.limit(0), "name", "id").count() == 0


E0 = mf.entry
CASES = [
    ({"train": [E0("a.wav")], "validation": [E0("b.wav")], "test": [E0("c.wav", 0, 20)]}, None),
    ({"train": [E0("a.wav", 0, 10), E0("a.wav", 10, 20)], "validation": [E0("b.wav")], "test": [E0("c.wav")]}, "more than once"),
    ({"train": [E0("a.wav")], "validation": [E0("b.wav")], "test": [E0("b.wav")]}, None),
    ({"train": [E0("a.wav", 0, 20)], "validation": [E0("a.wav", 20, 40)], "test": [E0("c.wav")]}, None),
    ({"train": [E0("a.wav", 0, 25)], "validation": [E0("a.wav", 20, 40)], "test": [E0("c.wav")]}, "overlap"),
]


@pytest.mark.parametrize("content,error", CASES)
def test_manifests(spark, tmp_path, content, error):
    p = str(tmp_path / "m.json")
    mf.write_manifest(content, p)
    if error:
        with pytest.raises(ValueError, match=error):
            mf.read_manifest(spark, p)
        return
    df = mf.read_manifest(spark, p)
    got = {s: [] for s in content}
    for r in df.orderBy("entry_idx").collect():
        got[r["split"]].append({"audio_path": r["audio_path"], "start": r["start"], "end": r["end"]})
    assert got == content
    v = mf.verify(df)
    assert v["paths"] == {s: len(content[s]) for s in content}


def test_broken_manifests(spark, tmp_path):
    p = tmp_path / "m.json"
    p.write_text('{"train": [], "validation": []}')
    with pytest.raises(ValueError, match="missing split"):
        mf.read_manifest(spark, str(p))
    p.write_text('{"train": [{"audio_path": "a", "start": 20, "end": 20}], "validation": [], "test": []}')
    with pytest.raises(ValueError, match="not below"):
        mf.read_manifest(spark, str(p))
    with pytest.raises(AssertionError):
        mf.write_manifest({"train": []}, str(p))
    assert E0("/x\\y".replace("\\", "/"))["audio_path"] == "x/y"
