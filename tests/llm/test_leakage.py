import random
import unicodedata
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
import numpy as np

from wavelake.llm import leakage as lk

DOC = "doc_id bigint, text string, words string"
ITEM = "item_id bigint, split string, text string"


def brute(docs, items):
    out = set()
    for i, t in items:
        w = lk.words(t)
        n = min(lk.ANSWER, len(w))
        if not n:
            continue
        grams = {tuple(w[a : a + n]) for a in range(len(w) - n + 1)}
        for d, text in docs:
            v = lk.words(text)
            if any(tuple(v[a : a + n]) in grams for a in range(len(v) - n + 1)):
                out.add((i, d))
    return out


def world(seed=0, n=300):
    rng = random.Random(seed)
    common = "the of and a in to by near while after before wind rain clip sound take".split()
    rare = [f"{rng.choice('bdfgklmnprst')}{rng.choice('aeiou')}{rng.choice('lnrst')}{k}" for k in range(900)]
    text = lambda k: " ".join(rng.choice(common) if rng.random() < 0.5 else rng.choice(rare) for _ in range(k))
    items = [(i, text(rng.choice([5, 9, 12, 30, 60]))) for i in range(40)]
    docs = []
    for d in range(n):
        body = text(rng.choice([1, 30, 120]))
        if d % 3 == 0:
            w = rng.choice(items)[1].split()
            k = rng.choice([6, 11, 12, 13, 20])
            a = rng.randrange(max(1, len(w) - k + 1))
            body += " " + " ".join(w[a : a + k]) + " " + text(20)
        docs.append((d, rng.choice([body, body.upper(), body.replace(" ", ",\n "), unicodedata.normalize("NFD", body)])))
    return docs, items


def test_recall_against_brute_force(spark):
    docs, items = world()
    docs += [(1000, None), (1001, ""), (1002, "  …"), (1003, "the " * 60_000 + items[3][1])] + docs[:3]
    got = {(r["item_id"], r["doc_id"]) for r in lk.leaks(spark.createDataFrame([(*d, "clash") for d in docs], DOC), spark.createDataFrame([(i, "test", t) for i, t in items + [(900, None), (901, "!")]], ITEM)).where("run >= least(12, n_words)").collect()}
    want = brute(docs, items)
    assert got <= want and len(got & want) >= 0.9 * len(want) and len(want) > 30


def test_paraphrases(spark):
    docs, items = world(3)
    w = items[3][1].split()
    near = [x for k, x in enumerate(w) if k % 9 != 4]
    got = lk.leaks(spark.createDataFrame([(7, "wind and rain " + " ".join(near), ""), *((i + 10, t, "") for i, t in docs[:50])], DOC), spark.createDataFrame([(3, "test", items[3][1])], ITEM), paraphrases=True).where("doc_id = 7").collect()
    assert got and got[0]["subsequence"] >= 0.8 * len(w)


def test_nothing(spark):
    d = spark.createDataFrame([(1, "some text", "")], DOC)
    i = spark.createDataFrame([(1, "test", "some other text here")], ITEM)
    assert lk.leaks(d, i.limit(0)).count() == 0 and lk.leaks(d.limit(0), i).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-1, 5), min_size=0, max_size=24), st.lists(st.integers(0, 5), min_size=1, max_size=30))
def test_checks_agree(doc, item):
    d, w = np.array(doc, np.int32), np.array(item, np.int32)
    p = np.full((1, 24), -1, np.int32)
    p[0, : len(d)] = d
    run, sub = lk.bulk_checks(p, w[None, :])
    assert run[0] == lk.longest_run(d, w) and sub[0] == lk.common_subsequence(d, w)
    t = np.zeros((len(doc) + 1, len(item) + 1), int)
    for i, x in enumerate(doc):
        for j, y in enumerate(item):
            t[i + 1, j + 1] = t[i, j] + 1 if x == y else max(t[i, j + 1], t[i + 1, j])
    assert sub[0] == t[-1, -1]


def test_sums_over_passages():
    rng = np.random.default_rng(0)
    docs = [rng.integers(-1, 7, n).astype(np.int32) for n in (0, 5, 12, 13, 24, 25, 100)]
    p = lk.Passages([d.tobytes() for d in docs])
    per = rng.standard_normal((7, 2))
    got = p.sums(per)
    k = 0
    for d in docs:
        halves = max(1, -(-len(d) // 12))
        for h in range(halves):
            begins = h + 1 < halves or halves == 1
            want = sum((per[w] for w in d[h * 12 : h * 12 + 24] if w >= 0), np.zeros(2)) if begins else np.zeros(2)
            assert np.allclose(got[k], want) and p.begins[k] == begins
            if p.ends[k] > p.starts[k] and begins:
                assert np.allclose(p.sums_at(np.array([k]), per)[0], want)
            k += 1


def test_answers_among_other_words(spark):
    """Answers of words that stand nowhere else, next to words of other items that stand everywhere: the leading directions hold little of them."""
    rng = random.Random(8)
    often = [[f"t{k}x{j}" for j in range(12)] for k in range(100)]
    rare = iter([f"w{k}" for k in range(3000)])
    items = [(k, " ".join(w)) for k, w in enumerate(often)] + [(200 + k, " ".join(next(rare) for _ in range(rng.choice([9, 12, 30])))) for k in range(60)]
    docs = [(d, " ".join(x for _ in range(6) for x in rng.sample(rng.choice(often), 12))) for d in range(900)]
    for d, (_, t) in enumerate(items[100:], 1000):
        w = t.split()
        a = rng.randrange(max(1, len(w) - 11))
        docs.append((d, " ".join([*rng.sample(rng.choice(often), 12), *w[a : a + 12], *rng.sample(rng.choice(often), 12)])))
    got = lk.leaks(spark.createDataFrame([(*d, "") for d in docs], DOC), spark.createDataFrame([(i, "test", t) for i, t in items], ITEM)).where("run >= least(12, n_words)")
    assert {(r["item_id"], r["doc_id"]) for r in got.collect()} == brute(docs, items)


def test_squares():
    rng = np.random.default_rng(1)
    t, w = rng.integers(-1, 5, (20, 24)).astype(np.int32), rng.random(5)
    want = [((np.bincount(r[r >= 0], minlength=5) * w) ** 2).sum() for r in t]
    assert np.allclose(lk.squares(t, w), want)


def test_paraphrase_away_from_a_quote(spark):
    docs, items = world(3)
    w = next(t for _, t in items if len(t.split()) == 60).split()
    near = [x for k, x in enumerate(w) if k % 9 != 4]
    far = " ".join(f"other{k}" for k in range(200))
    text = [f"{' '.join(w[20:31])} {far} {' '.join(near)}", f"{' '.join(near)} {far} {' '.join(w[20:31])}", f"{' '.join(w[20:31])} {far}"]
    got = lk.leaks(spark.createDataFrame([*((k, t, "") for k, t in enumerate(text)), *((i + 10, t, "") for i, t in docs[:50])], DOC), spark.createDataFrame([(3, "test", " ".join(w))], ITEM), paraphrases=True)
    assert {r["doc_id"]: r["subsequence"] for r in got.where("doc_id < 3").collect()} == {0: len(near), 1: len(near)}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-1, 5), max_size=40), st.lists(st.integers(0, 5), min_size=1, max_size=30))
def test_shared_bounds_subsequence(doc, item):
    d, w = np.array(doc, np.int32), np.array(item, np.int32)
    assert lk.common_subsequence(d, w) <= lk.shared([d], w)[0] == (Counter(doc) & Counter(item)).total()


def test_stretches():
    doc = np.arange(300)
    assert [(int(s[0]), int(s[-1]) + 1) for s in lk.stretches(doc, [0, 12, 96, 288], 10)] == [(0, 34), (2, 46), (86, 130), (278, 300)]


def test_blocks_of_items(spark):
    docs, items = world(5, 120)
    d, i = spark.createDataFrame([(*d, "clash") for d in docs], DOC), spark.createDataFrame([(k, "test", t) for k, t in items], ITEM)
    got = [{(r["item_id"], r["doc_id"], r["run"]) for r in lk.leaks(d, i, block=b).where("run >= least(12, n_words)").collect()} for b in (10**6, 1500)]
    assert got[0] == got[1] and {x[:2] for x in got[0]} == brute(docs, items)
