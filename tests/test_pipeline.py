"""Both builds end to end on small recordings made here."""

import json
import math
import os

import numpy as np
import pytest

from wavelake.cli import main, parser
from wavelake.models.registry import create_model
from wavelake.plans import config as cf
from wavelake.plans.pipeline import prepare_dataset, prepare_embeddings, read_table, state_matrix
from wavelake.plans.storage import Folder, decide, resolve
from wavelake.sources.annotations import Annotation
from wavelake.sources.manifest import entry, write_manifest
from wavelake.sources.wav import load_segment, probe, read_frames, write_wav

NAN = math.nan
RATE = 6000
# Two frogs and some birds on three recordings; one bird is uncertain and ends with its recording.
SECONDS = {"reed": 2.25, "mill": 1.0, "dam": 4.0}
EVENTS = [
    ("dam.wav", "bird", 3.0, 4.0, NAN),
    ("dam.wav", "frog", 0.4, 0.65, 1.0),
    ("mill.wav", "bird", 0.0, 1.0, 1.0),
    ("reed.wav", "frog", 0.3, 1.25, 1.0),
    ("reed.wav", "bird", 1.5, 1.8, NAN),
    ("reed.wav", "bird", 2.05, 2.2, 1.0),
]


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    d = tmp_path_factory.mktemp("set")
    for k, (name, sec) in enumerate(SECONDS.items()):
        t = np.arange(int(sec * RATE)) / RATE
        write_wav(str(d / f"{name}.wav"), np.sin(2 * np.pi * (300 + 70 * k) * t) * (0.2 + 0.1 * k), RATE)
    write_manifest({"train": [entry("reed.wav")], "validation": [entry("mill.wav")], "test": [entry("dam.wav")]}, str(d / "split.json"))
    return str(d)


def strong(spark):
    ev = spark.createDataFrame([(p, i, *r) for i, (p, *r) in enumerate(EVENTS)], "audio_path string, ord bigint, class_name string, start double, end double, value float")
    return Annotation("multilabel", "strong", ev.select("class_name").distinct(), events=ev)


def weak(spark, kind):
    rows = [("reed.wav", ["frog", "bird"] if kind == "multilabel" else ["frog"]), ("mill.wav", ["bird"]), ("dam.wav", ["frog"])]
    w = spark.createDataFrame(rows, "audio_path string, classes array<string>")
    return Annotation(kind, "weak", spark.createDataFrame([("bird",), ("frog",)], "class_name string"), weak=w)


def settings(root, out, **more):
    return cf.resolve_prep("toy", root, str(out), f"{root}/split.json", sr=RATE, seg_sec=1.0, hop_sec=1.0, **more)


def rows(spark, path):
    return {(r["audio_path"], r["segment_id"]): r for r in read_table(spark, path).collect()}


def states(x):
    return ["?" if math.isnan(v) else v for v in x]


def test_raw_table(spark, root, tmp_path):
    c = settings(root, tmp_path / "raw")
    path = prepare_dataset(spark, c, weak(spark, "multiclass"))
    got = rows(spark, path)
    assert sorted(got) == [("dam.wav", 0), ("dam.wav", 1), ("dam.wav", 2), ("dam.wav", 3), ("mill.wav", 0), ("reed.wav", 0), ("reed.wav", 1), ("reed.wav", 2)]
    assert {k[0]: r["audio_id"] for k, r in got.items()} == {"dam.wav": 0, "mill.wav": 1, "reed.wav": 2}
    tail = got["reed.wav", 2]
    assert tail["valid_sec"] == 0.25 and tail["end"] == 2.25 and len(tail["raw"]) == RATE and any(tail["raw"]) and not any(tail["raw"][RATE // 4 :])
    # At its own rate a recording is read sample by sample.
    assert np.array_equal(np.array(got["reed.wav", 1]["raw"], np.float32), read_frames(f"{root}/reed.wav", RATE, RATE)[0])
    assert {k: r["label"] for k, r in got.items() if k[1] == 0} == {("reed.wav", 0): 1, ("mill.wav", 0): 0, ("dam.wav", 0): 1}
    assert json.load(open(f"{path}/label_index.json")) == {"bird": 0, "frog": 1}
    # The same settings keep it, others are an error, overwriting builds again.
    assert prepare_dataset(spark, c, weak(spark, "multiclass")) == path
    with pytest.raises(ValueError):
        prepare_dataset(spark, settings(root, tmp_path / "raw", tol_sec=0.6), weak(spark, "multiclass"))
    prepare_dataset(spark, settings(root, tmp_path / "raw", tol_sec=0.6, overwrite=True), weak(spark, "multiclass"))
    assert ("reed.wav", 2) not in rows(spark, path)
    os.remove(f"{path}/prep_config.json")
    with pytest.raises(ValueError):
        prepare_dataset(spark, c, weak(spark, "multiclass"))


def test_labels_of_every_kind(spark, root, tmp_path):
    got = rows(spark, prepare_dataset(spark, settings(root, tmp_path / "m"), weak(spark, "multilabel")))
    assert got["reed.wav", 0]["label"] == [1, 1] and got["mill.wav", 0]["label"] == [1, 0] and got["dam.wav", 3]["label"] == [0, 1]
    got = rows(spark, prepare_dataset(spark, settings(root, tmp_path / "w"), strong(spark)))
    assert {k: states(r["label"]) for k, r in got.items()} == {
        ("reed.wav", 0): [0, 1], ("reed.wav", 1): ["?", 1], ("reed.wav", 2): [1, 0], ("mill.wav", 0): [1, 0],
        ("dam.wav", 0): [0, 1], ("dam.wav", 1): [0, 0], ("dam.wav", 2): [0, 0], ("dam.wav", 3): ["?", 0],
    }
    got = rows(spark, prepare_dataset(spark, settings(root, tmp_path / "s", label_type="strong"), strong(spark)))
    e = got["reed.wav", 1]["label"]
    assert [(x["target"], round(x["start"], 6), round(x["end"], 6)) for x in e] == [(1, 0.0, 0.25), (0, 0.5, 0.8)] and math.isnan(e[1]["value"])
    assert got["dam.wav", 1]["label"] == []


def test_errors_before_anything_is_built(spark, root, tmp_path):
    with pytest.raises(ValueError, match="weak labels only"):
        prepare_dataset(spark, settings(root, tmp_path / "x", label_type="strong"), weak(spark, "multilabel"))
    a = weak(spark, "multiclass")
    part = Annotation("multiclass", "weak", a.classes, weak=a.weak.where("audio_path <> 'mill.wav'"))
    with pytest.raises(ValueError, match="mill.wav"):
        prepare_dataset(spark, settings(root, tmp_path / "y"), part)
    heard = Annotation("multilabel", "strong", strong(spark).classes, events=strong(spark).events, annotated=a.weak.select("audio_path").where("audio_path <> 'dam.wav'"))
    with pytest.raises(ValueError, match="dam.wav"):
        prepare_dataset(spark, settings(root, tmp_path / "h"), heard)
    twice = Annotation("multiclass", "weak", a.classes.unionAll(a.classes), weak=a.weak)
    with pytest.raises(ValueError, match="twice"):
        prepare_dataset(spark, settings(root, tmp_path / "z"), twice)
    write_manifest({"train": [entry("reed.wav")], "validation": [entry("mill.wav")], "test": [entry("dam.wav", 5.0, 6.0)]}, str(tmp_path / "s.json"))
    with pytest.raises(ValueError, match="without a segment"):
        prepare_dataset(spark, cf.resolve_prep("toy", root, str(tmp_path / "v"), str(tmp_path / "s.json"), sr=RATE), weak(spark, "multiclass"))
    with pytest.raises(ValueError):
        cf.resolve_prep("toy", None)
    with pytest.raises(ValueError):
        cf.resolve_prep("toy", root, label_type="other", split_json=f"{root}/split.json")
    with pytest.raises(FileNotFoundError):
        cf.resolve_prep("toy", root, split_json="/no/such.json")


@pytest.mark.parametrize("granularity", ["clip", "frame"])
def test_embeddings(spark, root, tmp_path, granularity):
    raw = prepare_dataset(spark, settings(root, tmp_path / "raw", label_type="strong"), strong(spark))
    c = cf.resolve_emb(spark, raw, "checksum", granularity, str(tmp_path / "emb"))
    path = prepare_embeddings(spark, c)
    assert path.endswith(f"/emb/toy/checksum/{c.config_hash}") and prepare_embeddings(spark, c) == path
    got, src = rows(spark, path), rows(spark, raw)
    for k, r in got.items():
        assert all(r[x] == src[k][x] for x in ("audio_id", "start", "end", "valid_sec"))
    tail = got["reed.wav", 2]
    if granularity == "clip":
        assert len(tail["embedding"]) == 4 and abs(tail["embedding"][1] - 0.25) < 1e-6
        assert states(got["reed.wav", 1]["label"]) == ["?", 1]
    else:
        assert len(tail["embedding"]) == 4 and tail["valid_mask"] == [True, False, False, False]
        assert tail["embedding"][1] == [0, 0, 0, 0] and tail["geometry"][0] == [0, 0.25] and tail["geometry"][3] == [0, 0]
        assert [states(x) for x in got["reed.wav", 0]["label"]] == [[0, 0], [0, 1], [0, 1], [0, 1]]
        assert [states(x) for x in got["mill.wav", 0]["label"]] == [[1, 0]] * 4
    # However the rows are laid out, the results are the same.
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000"
    again = prepare_embeddings(spark, cf.resolve_emb(spark, raw, "checksum", granularity, str(tmp_path / "other"), batch_size=1))
    assert {k: r["embedding"] for k, r in rows(spark, again).items()} == {k: r["embedding"] for k, r in got.items()}


def test_frame_states():
    spans = np.array([[0, 0.25], [0.25, 0.5], [0.5, 1.0]], np.float32)
    ev = [{"target": 2, "start": 0.1, "end": 0.5, "value": 1.0}, {"target": 1, "start": 0.0, "end": 0.25, "value": NAN}, {"target": 1, "start": 0.3, "end": 0.4, "value": 1.0}, {"target": 0, "start": 0.5, "end": 0.6, "value": 1.0}]
    assert [states(x) for x in state_matrix(spans, ev, 3)] == [[0, "?", 1], [0, 1, 1], [1, 0, 0]]


def test_digests():
    a = cf.digest({"x": 1, "y": 2})
    assert a == cf.digest({"y": 2, "x": 1}) and a != cf.digest({"x": 1})


def test_model_settings(spark, root, tmp_path):
    raw = prepare_dataset(spark, settings(root, tmp_path / "raw"), weak(spark, "multilabel"))
    make = lambda kw: cf.resolve_emb(spark, raw, "checksum", "clip", "o", kw).config_hash
    assert make(None) == make({}) != make({"a": 1, "b": 2}) == make({"b": 2, "a": 1})
    with pytest.raises(ValueError):
        make({"granularity": "frame"})
    with pytest.raises(FileNotFoundError):
        cf.resolve_emb(spark, str(tmp_path / "none"), "checksum", "clip", "o")
    with pytest.raises(KeyError):
        create_model("none", granularity="clip")
    with pytest.raises(TypeError):
        create_model("panns-32k-cnn14-max_mean", granularity="clip", pooling="max_mean")
    with pytest.raises(TypeError):
        create_model("checksum", granularity="clip", stray=1)
    with pytest.raises(ValueError):
        create_model("laion/clap-htsat-fused", granularity="frame")
    with pytest.raises(FileNotFoundError):
        create_model("MIT/ast-finetuned-audioset-10-10-0.4593", granularity="clip")


def test_targets(spark, tmp_path):
    assert resolve("s3://b/x/") == "s3a://b/x"
    with pytest.raises(ValueError):
        resolve("s3://bucket/")
    f = Folder(spark, str(tmp_path / "t"))
    assert decide(f, "m", False)
    f.write_json("x", {"é": 1})
    assert f.read("x") == '{\n    "é": 1\n}'
    with pytest.raises(ValueError):
        decide(f, "m", False)
    f.write_json("m", {"config_hash": "h"})
    assert not decide(f, "m", False, "h") and not decide(f, "m", False)
    assert decide(f, "m", True) and not f.exists()


def test_wave_files(tmp_path):
    import struct
    import wave

    p = str(tmp_path / "x.wav")
    for width, scale in ((1, 128), (2, 2**15), (3, 2**23), (4, 2**31)):
        v = np.array([[0.5, -0.25], [0.0, 0.75]])
        ints = np.round(v * scale).astype(np.int64)
        raw = b"".join((int(i) + 128).to_bytes(1, "little") if width == 1 else int(i).to_bytes(width, "little", signed=True) for i in ints.reshape(-1))
        with wave.open(p, "wb") as w:
            w.setnchannels(2), w.setsampwidth(width), w.setframerate(100), w.writeframes(raw)
        assert np.allclose(read_frames(p), v.T) and probe(p).duration == 0.02
    write_wav(p, np.stack([np.ones(100), np.zeros(100)]), 100)
    assert np.allclose(load_segment(p, 0.5, 1.0, 100, True, 80), [0.5] * 50 + [0] * 30)
    assert load_segment(p, 0.0, 1.0, 50, False, 50).shape == (2, 50)
    open(p, "wb").write(b"RIFF" + struct.pack("<I", 4) + b"WAVE")
    with pytest.raises(ValueError):
        probe(p)


def test_command_line(spark, root, tmp_path):
    with pytest.raises(SystemExit):
        parser().parse_args(["emb", "--cache_dir", "x", "--model_name", "m", "--granularity", "clip", "--output_dir", "o", "--model_kwargs", "[1]"])
    d = tmp_path / "esc"
    (d / "meta").mkdir(parents=True), (d / "audio").mkdir()
    lines = ["filename,fold,target,category"]
    for k in range(1, 6):
        write_wav(str(d / "audio" / f"{k}.wav"), np.ones(RATE), RATE)
        lines.append(f"{k}.wav,{k},0,{'dog' if k % 2 else 'cat'}")
    (d / "meta" / "esc50.csv").write_text("\n".join([*lines, "gone.wav,1,0,dog"]) + "\n")
    s = str(tmp_path / "m.json")
    assert main(["split", "--dataset_name", "ESC-50", "--dataset_dir", str(d), "--output", s]) == s
    m = json.load(open(s))
    assert [len(m[x]) for x in ("train", "validation", "test")] == [3, 1, 1] and m["test"][0] == {"audio_path": "audio/5.wav", "start": 0.0, "end": "inf"}
    out = main(["raw", "--dataset_name", "ESC-50", "--dataset_dir", str(d), "--cache_dir", str(tmp_path / "r"), "--split_json", s, "--sr", str(RATE), "--seg_sec", "0.5", "--hop_sec", "0.5"])
    assert read_table(spark, out).count() == 10
