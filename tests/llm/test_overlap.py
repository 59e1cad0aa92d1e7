import math
import random
from datetime import datetime

from wavelake.llm import overlap as ov

INF, NAN = math.inf, math.nan
T0 = datetime(2024, 1, 1)
ENTRY = "entry_id bigint, dataset string, split string, entry_idx int, audio_path string, start double, end double, received_at timestamp_ntz, rec string"
REC = "audio_path string, dataset string, duration_sec double, sr bigint, recorded_at timestamp_ntz, received_at timestamp_ntz"


def run(spark, entries, recordings, **sizes):
    e = spark.createDataFrame([(i, "datased", s, 0, p, a, b, T0, "clash") for i, s, p, a, b in entries], ENTRY)
    r = spark.createDataFrame([(p, "datased", d, 1, T0, T0) for p, d in recordings], REC)
    e = ov.cut(ov.timed_entries(e, r))
    m = ov.cut(ov.matched_recordings(e, **sizes))
    return e, m, ov.cut(ov.coverage(e, m))


def pairs(stages):
    return {(r["train_id"], r["eval_id"]) for r in ov.overlaps(*stages).collect()}


def brute(entries, dur):
    rows = {}
    for i, s, p, a, b in entries:
        if p is None or a is None or b is None or math.isnan(a) or math.isnan(b):
            continue
        d = dur.get(p)
        b = min(b, d) if d else b
        if b > a:
            rows[i] = (s, p, a, b)
    out = set()
    for i, (s, p, a, b) in rows.items():
        for j, (t, q, c, e) in rows.items():
            if s == "train" and t in ("validation", "test") and p == q and min(b, e) - max(a, c) >= 0.8 * (e - c) - 1e-9:
                out.add((i, j))
    return out


def test_against_brute_force(spark):
    rng = random.Random(5)
    dur = {f"sed/{k}.wav": rng.choice([5.0, 100.0, None]) for k in "abc"}
    entries = []
    for i in range(240):
        a = rng.choice([0.0, rng.uniform(0, 90), NAN, None])
        b = rng.choice([INF, (a or 0.0) + rng.choice([0.0, 0.3, 4.0, 60.0]), None, NAN])
        entries.append((i, rng.choice(["train", "train", "validation", "test"]), rng.choice([*dur, None]), a, b))
    got = pairs(run(spark, entries, dur.items()))
    want = brute(entries, dur)
    assert got == want and len(want) > 30


def test_one_recording_with_most_rows(spark):
    entries = [(i, "train" if i % 4 else "test", "sed/hot.wav", float(i % 100), float(i % 100 + 5)) for i in range(400)] + [(1000 + i, "train", f"sed/{i}.wav", 0.0, INF) for i in range(50)]
    dur = {"sed/hot.wav": None}
    assert pairs(run(spark, entries, dur.items())) == brute(entries, dur)


def test_spelling_and_cover(spark):
    entries = [(1, "train", "sed/A.wav", 0.0, 8.0), (2, "test", "SED\\x\\..\\a.WAV", 0.0, 10.0), (3, "validation", "sed/a.wav", 0.0, 10.1), (4, "train", "sed/a.wav", 20.0, INF), (5, "test", "sed/a.wav", 21.0, INF)]
    stages = run(spark, entries, [])
    assert pairs(stages) == {(1, 2), (4, 5)}
    c = {r["eval_id"]: (r["size_ms"], r["covered_ms"]) for r in stages[2].collect()}
    assert c[2] == (10_000, 8_000) and c[3] == (10_100, 8_000) and c[5][0] == c[5][1]


def test_coverage_by_parts_of_several_entries(spark):
    entries = [(1, "train", "sed/a.wav", 0.0, 5.0), (2, "train", "x/sed/a.wav", 4.0, 9.5), (3, "test", "SED/a.wav", 0.0, 10.0), (4, "test", "sed/a.wav", 9.0, 20.0), (5, "test", "sed/b.wav", 0.0, 1.0), (6, "validation", "sed/a.wav", 9.5, 20.0)]
    stages = run(spark, entries, [])
    assert pairs(stages) == set()
    assert {r["eval_id"]: (r["size_ms"], r["covered_ms"]) for r in stages[2].collect()} == {3: (10_000, 9_500), 4: (11_000, 500)}


def test_one_file_name_in_every_folder(spark):
    """Patterns and texts of a file name that all share are cut into parts; a path matches as the end of a longer one only below its root."""
    entries = [(i, "train" if i % 3 else "test", f"wav/{i // 6}/audio.wav" if i % 2 else f"/mnt/{i}/wav/{i // 6}/audio.wav", 0.0, 5.0) for i in range(240)]
    rows = [(i, "hyenaset", s, 0, p, a, b, T0, "clash") for i, s, p, a, b in entries] + [(900, None, "train", 0, "x/y/audio.wav", 0.0, 5.0, T0, "c"), (901, None, "test", 0, "y/audio.wav", 0.0, 5.0, T0, "c"), (902, None, "test", 0, "X/y/audio.wav", 0.0, 5.0, T0, "c")]
    e = ov.cut(ov.timed_entries(spark.createDataFrame(rows, ENTRY), spark.createDataFrame([], REC)))
    m = ov.cut(ov.matched_recordings(e, shard=4, texts=8))
    want = {(i, j) for i in range(240) for j in range(240) if i % 3 and j % 3 == 0 and i // 6 == j // 6} | {(900, 902)}
    assert pairs((e, m, ov.coverage(e, m))) == want


def test_repeated_and_empty(spark):
    assert pairs(run(spark, [], [])) == set()
    entries = [(1, "train", "sed/a.wav", 0.0, 8.0)] * 3 + [(2, "test", "sed/a.wav", 0.0, 8.0)] * 2
    assert pairs(run(spark, entries, [])) == {(1, 2)}
