"""The HDF5 sources, over a stand-in for the h5py module: its files are .npz archives whose names are the members' paths."""

import sys

import numpy as np
import pytest

from wavelake.operators.generators import GENERATORS
from wavelake.sources import annotations as an
from wavelake.sources.wav import durations, load_segment

STUB = '''
import numpy as np


class Group:
    def __init__(self, members, prefix):
        self.members, self.prefix = members, prefix

    def __iter__(self):
        return iter(sorted({k[len(self.prefix):].split("/")[0] for k in self.members if k.startswith(self.prefix)}))

    def __getitem__(self, name):
        full = self.prefix + name
        return self.members[full] if full in self.members else Group(self.members, full + "/")


class File(Group):
    def __init__(self, path, mode="r"):
        with open(path, "rb") as f:
            super().__init__(dict(np.load(f, allow_pickle=False)), "")

    def __enter__(self):
        return self

    def __exit__(self, *_):
        pass
'''


@pytest.fixture
def h5py(spark, tmp_path, monkeypatch):
    if "h5py" in sys.modules:
        pytest.skip("the real module is here")
    p = tmp_path / "stub"
    p.mkdir()
    (p / "h5py.py").write_text(STUB)
    spark.sparkContext.addPyFile(str(p / "h5py.py"))
    monkeypatch.syspath_prepend(str(p))
    yield
    sys.modules.pop("h5py", None)


def save(path, **members):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "wb") as f:
        np.savez(f, **{k.replace("__", "/"): v for k, v in members.items()})


def test_birdvox(spark, tmp_path, h5py):
    root = tmp_path / "bv"
    for k, code in enumerate(an.SPECIES):
        save(root / f"BirdVox-14SD_{code.replace('.', '-')}_original.h5", sample_rate=np.array(100), **{f"waveforms__{i}": np.arange(50 + k, dtype=np.int16) for i in range(k % 3 + 1)})
    a = an.load_annotation(spark, "BirdVox-14SD", str(root))
    got = {r["audio_path"]: r["classes"] for r in a.weak.collect()}
    assert len(got) == sum(k % 3 + 1 for k in range(14)) and got["BirdVox-14SD_1-4-7_original.h5::waveforms/1"] == ["Ovenbird"]
    entries = GENERATORS["BirdVox-14SD"](spark, str(root))
    assert {r["audio_path"] for r in entries.collect()} == set(got)
    d = {r["audio_path"]: r["duration"] for r in durations(entries, str(root)).collect()}
    assert d["BirdVox-14SD_1-1-2_original.h5::waveforms/0"] == 0.51
    x = load_segment(str(root / "BirdVox-14SD_1-1-2_original.h5::waveforms/0"), 0.1, 0.2, 100, True, 30)
    assert x[:20].tolist() == list(range(10, 30)) and not x[20:].any()


def test_hyenas(spark, tmp_path, h5py):
    root = tmp_path / "hy"
    save(root / "lbl" / "c1" / "a.h5", lbl=np.array([b"whoop", b"giggle"]), start_time_lbl=np.array([0.5, 2.0]), end_time_lbl=np.array([1.0, 2.5]), foc=np.array([1, 0]))
    save(root / "lbl" / "c1" / "empty.h5", lbl=np.array([], "S5"), start_time_lbl=np.array([]), end_time_lbl=np.array([]))
    a = an.load_annotation(spark, "HyenaSET", str(root))
    ev = sorted((r["audio_path"], r["ord"], r["class_name"], r["start"], r["end"]) for r in a.events.collect())
    assert ev == [("wav/c1/a.wav", 0, "whoop", 0.5, 1.0), ("wav/c1/a.wav", 1, "giggle", 2.0, 2.5)]
    assert {r[0] for r in a.classes.collect()} == {"whoop", "giggle"}
    # A recording whose file is empty has an annotation, one without a file has none.
    assert {r[0] for r in a.annotated.collect()} == {"wav/c1/a.wav", "wav/c1/empty.wav"}
