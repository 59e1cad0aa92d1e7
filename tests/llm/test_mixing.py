import os

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wavelake.llm import mixing as mx

DOC = "doc_id bigint, source string, text string, tokens string"
SIZES = "doc_id bigint, source string, tokens bigint"
TARGET = "source string, target_share double, max_repeats int"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.floats(0, 1), max_size=60), st.integers(0, 5))
def test_pivotal_keeps_the_mass(p, tag):
    whole, open_, mass = mx.pivotal(p, str(tag))
    assert set(whole) <= {0, 1} and 0 <= mass < 1 and (open_ >= 0) == (mass > 0)
    assert abs(sum(whole) + mass - sum(p)) < 1e-6
    assert open_ < 0 or whole[open_] == 0


def test_pivotal_is_fair():
    p = [0.2, 0.7, 0.5, 0.9, 0.4]
    got = np.zeros(5)
    for i in range(4000):
        whole, open_, mass = mx.pivotal(p, f"fair{i}")
        got += whole
        if open_ >= 0:
            got[open_] += mass
    assert np.abs(got / 4000 - p).max() < 0.03


@pytest.mark.skipif(not os.path.isdir(mx.TOKENIZERS), reason="no tokenizers")
def test_sizes(spark):
    d = spark.createDataFrame([(1, "a", "ein Test", "x"), (2, None, None, "x"), (3, "b", "", "x"), (4, "b", "x" * 200_000, "x")], DOC)
    got = {r["doc_id"]: r["tokens"] for r in mx.token_sizes(d).collect()}
    assert got[1] == len(mx.tokenizer().encode("ein Test")) and got[2] == got[3] == 0 and got[4] > 1000


def test_mix_over_several_parts(spark, monkeypatch):
    monkeypatch.setattr(mx, "PART", 100)
    monkeypatch.setattr(mx, "FAN", 3)  # several levels of the tree
    rng = np.random.default_rng(1)
    rows = [(i, "big" if i % 3 else "small", int(rng.integers(1, 400))) for i in range(3000)] + [(9000 + i, None, 50) for i in range(100)] + [(9500, "other", 10), (9600, "zero", 0)]
    s = mx.cut(spark.createDataFrame(rows, SIZES))
    t = spark.createDataFrame([("big", 0.3, 1), ("small", 0.5, 2), ("none", 0.1, 3), ("zero", 0.1, 3), (None, 0.5, 1)], TARGET)
    total = sum(n for _, src, n in rows if src is not None)
    have = {x: sum(n for _, src, n in rows if src == x) for x in ("big", "small")}
    got = mx.mix(s, t).collect()
    assert {r["source"] for r in got} == {"big", "small"} and len({r["doc_id"] for r in got}) == len(got)
    for src, share, most in (("big", 0.3, 1), ("small", 0.5, 2)):
        want = min(share * total, most * have[src])
        size = sum(r["tokens"] * r["copies"] for r in got if r["source"] == src)
        assert abs(size - want) < 0.01 * want and max(r["copies"] for r in got if r["source"] == src) <= most
    d = {r["source"]: r for r in mx.demands(s, t).collect()}
    assert d["none"]["have"] == 0 and d["none"]["copies"] == 0 and d["small"]["have"] == have["small"]
    assert {(r["doc_id"], r["copies"]) for r in mx.mix(s.repartition(5), t).collect()} == {(r["doc_id"], r["copies"]) for r in got}


def test_nothing(spark):
    t = spark.createDataFrame([("a", 0.5, 1)], TARGET)
    assert mx.mix(spark.createDataFrame([], SIZES), t).count() == 0
    assert mx.mix(spark.createDataFrame([(1, "a", 5)], SIZES), t.limit(0)).count() == 0


def test_found_runs_the_mix(spark, data, monkeypatch):
    real, runs = mx.mix, []
    monkeypatch.setattr(mx, "mix", lambda *a: runs.append(1) or real(*a))
    got = {r["source"] for r in mx.p9_found(spark, data).collect()}
    x = mx.demands(mx._sizes(spark, data), mx.table(spark, data, "source_targets")).where("have * max_repeats < want")
    assert runs and got == {r["source"] for r in x.collect()}
