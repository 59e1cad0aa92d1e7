import os
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wavelake.llm import language as lg
from wavelake.llm.mixing import TOKENIZERS

pytestmark = pytest.mark.skipif(not os.path.isdir(TOKENIZERS), reason="no tokenizers")
DOC = "doc_id bigint, lang string, text string, language string"

TRAIN = {
    "en": "The wind was loud. We heard the dogs near the house and the rain on the roof. Nobody could say what it was. The second microphone failed in the morning.",
    "de": "Der Wind war laut. Wir hörten die Hunde beim Haus und den Regen auf dem Dach. Niemand konnte sagen, was das war. Das zweite Mikrofon fiel am Morgen aus.",
    "fr": "Le vent était fort. On entend les chiens près de la maison et la pluie sur le toit. Personne ne savait ce que c'était. Le second micro est tombé en panne le matin.",
    "es": "El viento era fuerte. Se oyen los perros cerca de la casa y la lluvia sobre el techo. Nadie sabía qué era. El segundo micrófono falló por la mañana.",
    "ru": "Ветер был сильный. Мы слышали собак возле дома и дождь по крыше. Никто не понял, что это было. Второй микрофон отказал утром.",
    "zh": "风声很大。我们听到房子附近的狗叫声和屋顶上的雨声。没有人知道那是什么。第二只话筒早上坏了。",
    "nl": "De wind was hard. We hoorden de honden bij het huis en de regen op het dak. Niemand kon zeggen wat het was. De tweede microfoon viel in de ochtend uit.",
    "pt": "O vento era forte. Ouvem-se os cães perto da casa e a chuva no telhado. Ninguém sabia o que era. O segundo microfone falhou de manhã.",
}


@pytest.fixture(scope="module")
def models():
    lattice = lg.Lattice()
    return lattice, lg.fit({k: Counter(w for _, _, s in lg.sentences(t) for w in s) for k, t in TRAIN.items()}, lattice)


def test_forward_sums_all_segmentations(models):
    lattice, logp = models
    for word in ("wind", "hörten", "风声", "ж", "日𝄞x"):
        w = "▁" + word

        def total(i, w=w):
            if i == len(w):
                return np.ones(len(lg.LANGUAGES))
            out = 0
            for j in range(i + 1, min(len(w), i + lattice.longest) + 1):
                k = lattice.ids.get(w[i:j])
                if k is not None:
                    out = out + np.exp(logp[k]) * total(j)
            if w[i] not in lattice.chars:
                out = out + np.exp(logp[[int(lattice.bytes[b]) for b in w[i].encode()]].sum(0)) * total(i + 1)
            return out

        assert np.allclose(lg.forward(lattice.edges(word), logp), np.log(total(0)))


def test_batches_equal_single_words(models):
    lattice, logp = models
    every = ["wind", "regn", "ж", "日𝄞x", "хж", "y" * 35, "y" * 90, "z" * 30]
    s = lg.Scorer(logp, lattice)
    got = s.words([[w] for w in every] + [every[:3]])
    want = np.array([lg.forward(lattice.edges(w), logp) for w in every])
    assert np.allclose(got[:-1], want) and np.allclose(got[-1], want[:3].sum(0)) and np.allclose(s.words([["regn"]])[0], want[1])


def test_letters_outside_the_vocabulary(models):
    """A word of them leaves the range of plain probabilities long before 30 letters; its text is judged by the rest."""
    lattice, logp = models
    s = lg.Scorer(logp, lattice)
    every = ["𐎠" * k for k in range(1, 33)] + ["rain" + "𐎠" * 26]
    want = np.array([lg.forward(lattice.edges(w), logp) for w in every])
    assert not set("𐎠") & lattice.chars and want.min() < -750
    assert np.allclose(s.words([[w] for w in every]), want)
    p = s.texts([f"{TRAIN['fr']} {'𐎠' * 30}"])[3]
    assert np.isfinite(p).all() and all(lg.LANGUAGES[k] == "fr" for k in p.argmax(1)[:-1])


def test_expected_counts(models):
    """Against the counts over all segmentations written out."""
    lattice, logp = models
    p = np.exp(logp[:, 0]).tolist()
    for word in ("wind", "жa", "x" * 70):
        w = "▁" + word
        into = [0.0] * lattice.size
        lg.expected(lattice.edges(word), p, 2.0, into)
        if len(w) < 9:
            ways = []

            def walk(i, used, q, w=w, ways=ways):
                if i == len(w):
                    ways.append((used, q))
                    return
                for j in range(i + 1, len(w) + 1):
                    k = lattice.ids.get(w[i:j])
                    if k is not None:
                        walk(j, [*used, k], q * p[k])
                if w[i] not in lattice.chars:
                    b = [int(lattice.bytes[x]) for x in w[i].encode()]
                    walk(i + 1, used + b, q * float(np.prod([p[k] for k in b])))

            walk(0, [], 1.0)
            want = np.zeros(lattice.size)
            for used, q in ways:
                for k in used:
                    want[k] += 2.0 * q / sum(x for _, x in ways)
            assert np.allclose(into, want)
        # Every way spells the word once.
        size = np.array([len(lattice.ids and next((x for x, i in lattice.ids.items() if i == k), "")) for k in np.flatnonzero(into)])
        if all(c in lattice.chars for c in w):
            assert np.isclose((np.array(into)[np.flatnonzero(into)] * size).sum(), 2.0 * len(w))


def test_fit_gives_distributions(models):
    assert np.allclose(np.exp(models[1]).sum(0), 1)


def test_texts(spark, models):
    lattice, logp = models
    mixed = "We heard the rain on the roof. Nobody could say what it was. Niemand konnte sagen, was das war. Wir hörten den Regen auf dem Dach."
    rows = [(1, "en", TRAIN["en"]), (2, "en-GB", TRAIN["en"].upper()), (3, "ENGLISH", TRAIN["en"]), (4, None, TRAIN["fr"]), (5, "xx", TRAIN["zh"]), (6, "de", TRAIN["ru"]), (7, "de", mixed), (8, "zho", TRAIN["zh"] * 40), (9, "en", None), (10, "en", " \n"), (11, "en", "123 45.6 -- 7"), (12, "fra", TRAIN["fr"] + "\nsr=16000 ch=1 bits=24\ntake_12.wav")]
    segs = lg.segments(spark.createDataFrame([(*r, "clash") for r in rows], DOC), logp)
    per = lg.languages(segs)
    wrong = ~F.coalesce(lg.label_language(F.col("label")) == F.col("language"), F.lit(False))
    found = {(r["doc_id"], r["language"]) for r in per.where((F.col("n_languages") >= 2) | wrong).collect()}
    assert found == {(4, "fr"), (5, "zh"), (6, "ru"), (7, "en"), (7, "de")}
    s = {}
    for r in segs.orderBy("doc_id", "segment").collect():
        s.setdefault(r["doc_id"], []).append((r["language"], r["n_sentences"], r["confidence"]))
    assert [x[:2] for x in s[7]] == [("en", 2), ("de", 2)] and all(x[2] > 0.8 for x in s[7])
    assert s[11] == [(None, 0, 0.0)] and 9 not in s and 10 not in s
    empty = spark.createDataFrame([], DOC)
    assert lg.segments(empty).count() == 0


def test_held_out_accuracy(spark):
    """Fitted on a tenth of the labelled texts of a test table, right on nearly all sentences of another part."""
    path = "/root/testdata/sf0.01/documents.parquet"
    if not os.path.exists(path):
        pytest.skip("no test tables here")
    d = spark.read.parquet(path).where(lg.label_language(F.col("lang")).isNotNull() & F.col("text").isNotNull())
    fit_on = d.where("doc_id % 3 = 0").select(lg.label_language(F.col("lang")).alias("code"), "text").toPandas()
    scorer = lg.Scorer(lg.train(fit_on), lg.Lattice())
    test = d.where("doc_id % 3 = 1").select(lg.label_language(F.col("lang")).alias("code"), "text").toPandas()
    of, _, _, p = scorer.texts(test["text"].tolist())
    n = np.searchsorted(of, np.arange(len(test) + 1))
    right = [lg.NAMES[int(p[a:b].sum(0).argmax())] == code for code, a, b in zip(test["code"], n, n[1:]) if b > a]
    # About one label in fourteen is wrong by design of the table.
    assert np.mean(right) > 0.88


def test_labels(spark):
    given = {"en": "en", "EN": "en", "en_US": "en", "zh-Hans": "zh", "Dutch": "nl", " fra ": "fr", "und": None, "-": None, "": None, "unknown": None, "n/a": None, "entropy": None}
    df = spark.createDataFrame([(k,) for k in given], "lang string")
    assert {r[0]: r[1] for r in df.select("lang", lg.label_language(F.col("lang"))).collect()} == given


# Sentences of languages that the models do not know.
STRANGE = {
    "Polish": "Dzień dobry, nazywam się Jan i mieszkam w Warszawie od wielu lat. Wczoraj poszedłem do sklepu po świeży chleb.",
    "Thai": "สวัสดีครับ ผมชื่อสมชาย และผมอาศัยอยู่ในกรุงเทพ เมื่อวานฉันไปตลาด",
    "Greek": "Καλημέρα, με λένε Γιώργο και μένω στην Αθήνα. Χθες πήγα στην αγορά.",
    "Hebrew": "שלום, שמי דוד ואני גר בירושלים. אתמול הלכתי לשוק.",
    "Swedish": "Hej, jag heter Anna och bor i Stockholm sedan många år. Igår gick jag till affären för att köpa bröd.",
}


def test_other_languages(spark):
    path = "/root/testdata/sf0.01/documents.parquet"
    if not os.path.exists(path):
        pytest.skip("no test tables here")
    d = spark.read.parquet(path).where(lg.label_language(F.col("lang")).isNotNull() & F.col("text").isNotNull())
    scorer = lg.Scorer(lg.train(d.select(lg.label_language(F.col("lang")).alias("code"), "text").toPandas()), lg.Lattice())
    of, _, _, p = scorer.texts([*STRANGE.values(), *TRAIN.values()])
    got = [[lg.NAMES[k] for k in p[of == i].argmax(1)] for i in range(len(STRANGE) + len(TRAIN))]
    assert all(set(x) == {lg.OTHER} for x in got[: len(STRANGE)])
    assert [max(x, key=x.count) for x in got[len(STRANGE) :]] == list(TRAIN)


def test_ends_of_sentences():
    text = "声音。Ik heb \"dat.\" Een\x00 twee! a.b c=d.e\nLaatste"
    got = [(text[a:b], w) for a, b, w in lg.sentences(text)]
    assert got == [("声音。", ["声音"]), ('Ik heb "dat."', ["ik", "heb", "dat"]), (" Een\x00 twee!", ["een", "twee"]), (" a.b c=d.e\n", ["a", "b"]), ("Laatste", ["laatste"])]
    units, text_of, begin, end = lg.split(["", "é. x", "…"])
    assert text_of.tolist() == [0, 1, 1, 2, 2] and begin.tolist() == [0, 0, 2, 0, 1] and end.tolist() == [0, 2, 4, 1, 1]
