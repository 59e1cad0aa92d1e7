import numpy as np
import pytest

from wavelake.functions import dsp
from wavelake.functions import frontends as fe
from wavelake.models import layers as L
from wavelake.models.encoders import chunks, frame_grid, length_groups
from wavelake.models.registry import ModelSpec, create_model, list_models, register_model

RNG = np.random.default_rng(0)
FRONTS = [fe.LogMel(32_000), fe.LogMel(16_000), fe.FixedFbank(), fe.FusedLogMel(), fe.Waveform(), fe.FlooredMel(), fe.PoveyFbank()]
TINY = {
    "panns-32k-cnn14-max_mean": dict(width=2),
    "panns-32k-cnn14-decision_level_max": dict(width=2),
    "MIT/ast-finetuned-audioset-10-10-0.4593": dict(dim=24, depth=1, n_heads=2),
    "laion/clap-htsat-fused": dict(dim=16, width=24, depths=(2, 2), side=128),
    "facebook/wav2vec2-base": dict(dim=32, depth=1, n_heads=2, channels=8),
    "atst-clip-small": dict(depth=2, n_blocks=2),
    "atst-frame-small": dict(depth=2, n_blocks=2),
    "beats_iter1": dict(dim=32, depth=2, n_heads=2, embed=16),
}


@pytest.mark.parametrize("front", FRONTS, ids=lambda f: f"{type(f).__name__}{f.rate}")
@pytest.mark.parametrize("rate", [16_000, 22_050])
def test_rows_are_independent(front, rate):
    x = RNG.standard_normal((3, 2, rate)).astype(np.float32)
    v = np.array([1.0, 0.5, 0.0301], np.float32)
    got = front(x, rate, v)
    noisy = x.copy()
    for i, s in enumerate(v):
        noisy[i, :, round(float(s) * rate) :] = 7.5
    assert np.array_equal(front(noisy, rate, v)["input_features"], got["input_features"])
    for i in range(3):
        one = front(x[i : i + 1].mean(1), rate, v[i : i + 1])
        n = one["input_features"].shape[front.time_axis]
        assert np.allclose(one["input_features"][0], np.moveaxis(np.moveaxis(got["input_features"][i], front.time_axis - 1, 0)[:n], 0, front.time_axis - 1), atol=1e-5)
        assert one["valid"][0] == got["valid"][i]


def test_contract():
    f = fe.Waveform()
    for bad, error in (((np.zeros((1, 4), int), 8000), TypeError), ((np.zeros(4), 8000), TypeError), ((np.zeros((1, 500)), 16_000.0), TypeError), ((np.zeros((1, 0)), 8000), ValueError), ((np.zeros((1, 399)), 16_000), ValueError), ((np.zeros((1, 500)), 16_000, np.array([1.0])), ValueError)):
        with pytest.raises(error):
            f(*bad)
    with pytest.raises(ValueError):
        fe.FixedFbank()(np.zeros((1, 164_081), np.float32), 16_000)
    with pytest.raises(ValueError):
        fe.LogMel(8000)


def test_frame_counts():
    n = lambda f, table: all(f.frames(k) == v for k, v in table.items())
    assert n(fe.PoveyFbank(), {320: 16, 2800: 16, 2960: 17, 16000: 98}) and n(fe.FlooredMel(), {160: 4, 513: 4, 640: 5, 160000: 1001})
    for f in FRONTS:
        x = RNG.standard_normal((1, f.rate)).astype(np.float32)
        assert f(x, f.rate)["input_features"].shape[1] >= min(f.frames(f.rate), 4 if isinstance(f, fe.FusedLogMel) else 10**9)


def test_spectra_against_a_plain_transform():
    x = RNG.standard_normal(1200)
    got = dsp.power_spectrum(x, 256, 64)
    pad = np.concatenate([x[128:0:-1], x, x[-2:-130:-1]])
    w = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(256) / 256)
    k = np.arange(129)[:, None] * np.arange(256)[None, :]
    for t in (0, 5, len(got) - 1):
        assert np.allclose(got[t], np.abs((pad[t * 64 : t * 64 + 256] * w * np.exp(-2j * np.pi * k / 256)).sum(1)) ** 2)


def test_mel_banks():
    for scale in ("htk", "slaney", "kaldi"):
        f = np.array([60.0, 999.0, 1001.0, 7000.0])
        assert np.allclose(dsp.mel_to_hz(dsp.hz_to_mel(f, scale), scale), f)
        b = dsp.mel_bank(16_000, 1024, 40, 60.0, 7800.0, scale)
        assert (b >= 0).all() and (b.sum(1) > 0).all() and b.shape == (40, 513)
    assert np.isclose(dsp.hz_to_mel(1000, "slaney"), 15) and np.isclose(dsp.hz_to_mel(700, "htk"), 2595 * np.log10(2))
    assert not dsp.mel_bank(16_000, 512, 128, 20.0, 8000.0, "kaldi")[:, -1].any()


def test_resampling():
    t = np.arange(48_000) / 48_000
    tone = np.sin(2 * np.pi * 440 * t)
    for rate in (16_000, 44_100, 22_050):
        y = dsp.resample(tone, 48_000, rate)
        assert len(y) == rate
        want = np.sin(2 * np.pi * 440 * np.arange(rate) / rate)
        assert np.abs(y[200:-200] - want[200:-200]).max() < 5e-3
    assert dsp.resample(tone, 8000, 8000) is tone
    assert dsp.resample(np.ones((2, 7)), 3, 2).shape == (2, 5)


def test_short_signals_are_repeated():
    x = RNG.standard_normal((1, 48_000)).astype(np.float32)
    f = fe.FusedLogMel()
    got = f(x, 48_000)["input_features"]
    assert got.shape == (1, 4, 1001, 64) and np.array_equal(got[:, 0], got[:, 3])
    assert np.allclose(got, f(np.tile(x, (1, 10)), 48_000)["input_features"])
    long = f(RNG.standard_normal((1, 600_000)).astype(np.float32), 48_000)["input_features"]
    assert not np.array_equal(long[:, 1], long[:, 3])


@pytest.mark.parametrize("name", TINY)
@pytest.mark.parametrize("granularity", ["clip", "frame"])
def test_encoders(name, granularity):
    if granularity == "frame" and name in ("laion/clap-htsat-fused", "atst-clip-small"):
        with pytest.raises(ValueError):
            create_model(name, granularity=granularity, pretrained=False, **TINY[name])
        return
    m = create_model(name, granularity=granularity, pretrained=False, **TINY[name])
    x = RNG.standard_normal((3, 32_000)).astype(np.float32)
    v = np.array([2.0, 0.9, 0.5], np.float32)
    got = m.embed(x, 16_000, v)
    noisy = x.copy()
    noisy[1, 14_400:] = noisy[2, 8000:] = 7.5
    assert np.array_equal(m.embed(noisy, 16_000, v)["embedding"], got["embedding"])
    assert np.isfinite(got["embedding"]).all() and got["embedding"].shape[-1] == m.encoder.dim
    if granularity == "clip":
        assert got["embedding"].shape == (3, m.encoder.dim) and got["valid_mask"].all() and np.allclose(got["geometry"][:, 1], v)
    else:
        mask = got["valid_mask"]
        assert not got["embedding"][~mask].any() and not got["geometry"][~mask].any()
        for i in range(3):
            assert np.isclose(got["geometry"][i, mask[i].sum() - 1, 1], v[i])
        assert m.frame_count(10.0) >= mask.sum(1).max()
    one = m.embed(x[1:2], 16_000, v[1:2])["embedding"][0]
    assert np.allclose(one, got["embedding"][1][: len(one)] if granularity == "frame" else got["embedding"][1], atol=1e-5)


def test_long_signals_in_chunks():
    m = create_model("atst-frame-small", granularity="frame", pretrained=False, depth=1)
    got = m.embed(RNG.standard_normal((1, 16_000 * 11)).astype(np.float32), 16_000)
    assert got["valid_mask"].sum() == got["embedding"].shape[1] == 275
    assert chunks(1003) == [(0, 1000)] and chunks(1004) == [(0, 1000), (1000, 1004)] and chunks(3) == []
    with pytest.raises(ValueError):
        create_model("atst-frame-small", granularity="clip", pretrained=False, n_blocks=13)
    with pytest.raises(TypeError):
        create_model("atst-frame-small", granularity="clip", pretrained=False, n_blocks="2")


def test_pieces():
    assert [g.tolist() for g in length_groups(np.array([3, 1, 3, 2]))] == [[1], [3], [0, 2]]
    assert frame_grid(4, 0.25, 3, 1.0).tolist() == [[0, 0.25], [0.25, 0.5], [0.5, 1.0], [0, 0]]
    import math

    x = np.linspace(-4, 4, 81)
    assert np.abs(L.gelu(x) - np.array([v * 0.5 * (1 + math.erf(v / math.sqrt(2))) for v in x])).max() < 1e-6


def test_weights_from_a_file(tmp_path):
    kw = TINY["beats_iter1"]
    m = create_model("beats_iter1", granularity="clip", pretrained=False, **kw)
    x = RNG.standard_normal((1, 16_000)).astype(np.float32)
    want = m.embed(x, 16_000)["embedding"]
    np.savez(tmp_path / "beats_iter1.npz", **m.encoder.p.made)
    again = create_model("beats_iter1", granularity="clip", pretrained_dir=str(tmp_path), seed=5, **kw)
    assert np.array_equal(again.embed(x, 16_000)["embedding"], want)
    with pytest.raises(ValueError):
        L.Params(path=str(tmp_path / "beats_iter1.npz"), sha256="0" * 64)
    assert L.Params(path=str(tmp_path / "beats_iter1.npz"), sha256=L.digest(str(tmp_path / "beats_iter1.npz"))).loaded is not None


def test_registry():
    names = list_models()
    assert len([n for n in names if "beats" in n]) == 15 and len([n for n in names if n.startswith("atst-")]) == 4 and names == sorted(names)
    with pytest.raises(ValueError):
        ModelSpec(fe.Waveform, object, {"granularity": "clip"})
    register_model("mine", ModelSpec(lambda: fe.Waveform(False), type(create_model("checksum", granularity="clip").encoder)))
    assert "mine" in list_models() and create_model("mine", granularity="frame").frame_count(1.0) == 4
