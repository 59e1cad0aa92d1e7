from datetime import datetime

from hypothesis import given, settings
from hypothesis import strategies as st

from wavelake.llm import quota as qt

T0 = datetime(2024, 1, 1)
RAW = "row_id bigint, label_idx bigint, label_idxs array<bigint>, received_at timestamp_ntz, classes string, key int"
TARGET = "label_idx bigint, target_share double, min_rows bigint"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 20), st.integers(0, 10), st.integers(0, 200)), min_size=1, max_size=12), st.integers(0, 400))
def test_quotas(cells, n):
    classes = [(k, float(s), f, h) for k, (s, f, h) in enumerate(cells)]
    q = qt.quotas(classes, n)
    assert set(q) == {c for c, *_ in classes}
    for c, s, f, h in classes:
        assert min(f, h) <= q[c] <= h
    floors = sum(min(f, h) for _, _, f, h in classes)
    room = sum(h for _, s, _, h in classes if s > 0) + sum(min(f, h) for _, s, f, h in classes if s == 0)
    if floors <= n <= room:
        assert sum(q.values()) == n


def test_largest_remainder():
    assert qt.quotas([(0, 0.5, 0, 99), (1, 0.3, 0, 99), (2, 0.2, 0, 99)], 7) == {0: 4, 1: 2, 2: 1}
    assert qt.quotas([(0, 0.9, 0, 3), (1, 0.1, 2, 99)], 10) == {0: 3, 1: 7}


def make(spark, rows):
    return spark.createDataFrame([(i, a, b, T0, "clash", 0) for i, a, b in rows], RAW)


def test_sample_and_report(spark):
    rows = [(i, i % 3 if i % 2 else None, [0, 0, i % 5] if not i % 2 else None) for i in range(600)] + [(1000 + i, 7, None) for i in range(300)] + [(2000, None, None), (2001, None, []), (2002, None, [None])]
    rows += rows[:20]
    t = spark.createDataFrame([(0, 0.5, 1), (2, 0.3, 1), (7, 0.1, 1), (9, 0.1, 4), (None, 0.5, 1)], TARGET)
    lab = qt.labelled(make(spark, rows))
    assert lab.count() == 900
    sample, report = qt.draw(qt.cut(lab), t)
    r = {x["label_idx"]: x for x in report.collect()}
    assert r[9]["have"] == 0 and r[9]["short"] == 9 and sum(x["quota"] for x in r.values()) == 90
    got = sample.collect()
    per = {}
    for x in got:
        per.setdefault(x["label_idx"], set()).add(x["row_id"])
    assert {c: len(v) for c, v in per.items()} == {c: x["quota"] for c, x in r.items() if x["quota"]}
    assert len({x["row_id"] for x in got}) == len(got) == 90
    have = {i: {c for c in [a, *(b or [])] if c is not None} for i, a, b in rows}
    assert all(c in have[i] for c, ids in per.items() for i in ids)
    # The same rows whatever the layout.
    again, _ = qt.draw(qt.cut(lab.repartition(7)), t)
    assert {(x[0], x[1]) for x in again.collect()} == {(x[0], x[1]) for x in got}


def test_rows_of_several_classes_go_where_they_are_needed(spark):
    # Class 1 needs nearly all its rows, every one of which class 0 could take too; class 2 is as scarce, with rows of its own.
    rows = [(i, None, [0, 1]) for i in range(100)] + [(1000 + i, 0, None) for i in range(850)] + [(3000 + i, 2, None) for i in range(50)]
    t = spark.createDataFrame([(0, 0.1, 1), (1, 0.85, 1), (2, 0.05, 20)], TARGET)
    sample, report = qt.draw(qt.cut(qt.labelled(make(spark, rows))), t)
    r = {x["label_idx"]: x for x in report.collect()}
    assert all(x["short"] == 0 for x in r.values()) and r[1]["quota"] >= 68 and r[2]["quota"] == 20 and sum(x["quota"] for x in r.values()) == 100
    got = sample.collect()
    assert len({x["row_id"] for x in got}) == 100


def test_nothing(spark):
    t = spark.createDataFrame([(0, 0.5, 1)], TARGET)
    s, r = qt.draw(qt.labelled(make(spark, [])), t)
    assert s.count() == 0 and r.first()["short"] == 1
    s, r = qt.draw(qt.labelled(make(spark, [(1, 1, None)])), t.limit(0))
    assert s.count() == 0 and r.count() == 0


def test_found_draws_the_sample(spark, data, monkeypatch):
    real, runs = qt.draw, []
    monkeypatch.setattr(qt, "draw", lambda *a: runs.append(1) or real(*a))
    got = {r["label_idx"] for r in qt.p7_found(spark, data).collect()}
    x = qt.shortfalls(qt.labelled(qt.table(spark, data, "raw_cache")), qt.table(spark, data, "sample_targets")).where("have < want or have < min_rows")
    assert runs and got == {r["label_idx"] for r in x.collect()}
    # A class whose quota the sample does not reach is found too.
    monkeypatch.setattr(qt, "draw", lambda *a: (real(*a)[0].limit(0), real(*a)[1]))
    assert got < {r["label_idx"] for r in qt.p7_found(spark, data).collect()}
