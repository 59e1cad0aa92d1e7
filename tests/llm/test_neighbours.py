from datetime import datetime

import numpy as np
import pytest

from wavelake.llm import neighbours as nb

T0 = datetime(2024, 1, 1)
SCHEMA = "vec_id bigint, embedding array<float>, received_at timestamp_ntz, wanted string"


def clustered(n, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((n // 20 + 1, nb.DIM))
    return (centres[rng.integers(0, len(centres), n)] + 0.3 * rng.standard_normal((n, nb.DIM))).astype(np.float32) * rng.uniform(0.1, 9, (n, 1)).astype(np.float32)


def brute(ids, x, wanted, k):
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    out = {}
    for i in np.flatnonzero(np.isin(ids, wanted)):
        s = u @ u[i]
        s[i] = -9
        out[int(ids[i])] = [int(ids[j]) for j in sorted(range(len(s)), key=lambda j: (-s[j], ids[j]))[:k]]
    return out


def run(spark, rows, wanted, **kw):
    df = spark.createDataFrame([(i, None if e is None else [None if y is None else float(y) for y in e], T0, "clash") for i, e in rows], SCHEMA)
    v = nb.last_vectors(df).withColumn("wanted", nb.F.col("vec_id").isin(wanted) if wanted else nb.F.lit(False))
    got = {}
    for r in nb.neighbours(v, **kw).orderBy("qid", "rank").collect():
        got.setdefault(r["qid"], []).append(r["vec_id"])
    return got


def test_exact_with_factor_one(spark, monkeypatch):
    monkeypatch.setattr(nb, "LEAF", 32)
    x = clustered(900)
    ids = np.arange(900) * 3 + 1
    wanted = [int(i) for i in ids[::20]]
    # One shard, several shards of several cells each, and cells spread over several shards.
    for sizes in ({}, {"per_cell": 40, "shard": 200}, {"per_cell": 300, "shard": 90}):
        assert run(spark, zip(ids.tolist(), x), wanted, k=8, factor=1.0, **sizes) == brute(ids, x, wanted, 8)


def test_equal_vectors_go_by_their_ids(spark, monkeypatch):
    monkeypatch.setattr(nb, "LEAF", 16)
    x = clustered(200, 2)
    same = np.random.default_rng(5).choice(200, 60, replace=False)
    x[same] = x[same[0]]
    ids = np.arange(200) * 7 % 1009
    wanted = [int(i) for i in ids[same[:5]]] + [int(i) for i in ids[:20]]
    for sizes in ({}, {"per_cell": 20, "shard": 25}):
        assert run(spark, zip(ids.tolist(), x), wanted, k=8, factor=1.0, **sizes) == brute(ids, x, wanted, 8)


@pytest.mark.parametrize("factor,least", [(1.0, 1.0), (nb.FACTOR, 0.95)])
def test_recall_and_work(spark, factor, least):
    x = clustered(3000, 4)
    ids = np.arange(3000)
    wanted = [int(i) for i in ids[::20]]
    df = spark.createDataFrame([(int(i), [float(y) for y in e], bool(i % 20 == 0)) for i, e in zip(ids, x)], "vec_id bigint, e array<float>, wanted boolean")
    found = nb.hits(df, 8, factor, per_cell=60, shard=500).cache()
    got = {}
    for r in nb.ranked(found, 8).orderBy("qid", "rank").collect():
        got.setdefault(r["qid"], []).append(r["vec_id"])
    want = brute(ids, x, wanted, 8)
    assert np.mean([len(set(got[q]) & set(want[q])) / 8 for q in wanted]) >= least
    compared = found.where("qid is null").agg({"compared": "sum"}).first()[0]
    assert compared < len(wanted) * 3000 * 0.9


def test_unusable_vectors_and_copies(spark):
    x = clustered(30)
    rows = [(i, e) for i, e in enumerate(x)] + [(0, x[0]), (100, None), (101, np.zeros(nb.DIM)), (102, x[0][:32]), (103, np.r_[np.nan, x[0][1:]]), (104, np.r_[np.inf, x[0][1:]]), (107, [None, *x[0][1:]]), (None, x[0]), (105, x[3]), (106, x[3] * np.float32(2.0**-80))]
    got = run(spark, rows, [0, 3, 100, 101, 103, 107, 999], k=3)
    assert set(got) == {0, 3} and got[3][:2] == [105, 106] and 0 not in got[0]
    assert run(spark, [(1, x[0]), (2, x[1])], [1], k=8) == {1: [2]}
    assert run(spark, [(1, x[0])], [1], k=8) == {}
    assert run(spark, [], [1]) == {}
    assert run(spark, [(1, x[0]), (2, x[1])], []) == {}
