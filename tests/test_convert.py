"""Small states with the names of the published checkpoints load into every family of encoders."""

import numpy as np
import pytest

from wavelake.models import convert as cv
from wavelake.models import encoders as en
from wavelake.models import layers as L
from wavelake.models.registry import create_model

RNG = np.random.default_rng(1)


def lin(name, out, inn, *more, bias=True):
    s = {f"{name}.weight": RNG.standard_normal((out, inn, *more)) * 0.1}
    return s | ({f"{name}.bias": RNG.standard_normal(out) * 0.1} if bias else {})


def norm(name, n, stats=False):
    s = {f"{name}.weight": RNG.uniform(0.5, 1.5, n), f"{name}.bias": RNG.standard_normal(n)}
    return s | ({f"{name}.running_mean": RNG.standard_normal(n), f"{name}.running_var": RNG.uniform(0.5, 2, n)} if stats else {})


def every(*parts):
    return {k: v for p in parts for k, v in p.items()}


def panns():
    s, c = every(norm("bn0", 64, True), lin("fc1", 64, 64)), 1
    for k in range(6):
        n = 2 << k
        s |= every(lin(f"conv_block{k + 1}.conv1", n, c, 3, 3, bias=False), norm(f"conv_block{k + 1}.bn1", n, True), lin(f"conv_block{k + 1}.conv2", n, n, 3, 3, bias=False), norm(f"conv_block{k + 1}.bn2", n, True))
        c = n
    return s


def ast(d=8):
    s = {"embeddings.cls_token": RNG.standard_normal((1, 1, d)), "embeddings.distillation_token": RNG.standard_normal((1, 1, d)), "embeddings.position_embeddings": RNG.standard_normal((1, 2 + 12 * 101, d))}
    s |= every(lin("embeddings.patch_embeddings.projection", d, 1, 16, 16), norm("layernorm", d))
    p = "encoder.layer.0."
    s |= every(*(lin(p + x, d, d) for x in ("attention.attention.query", "attention.attention.key", "attention.attention.value", "attention.output.dense")), lin(p + "intermediate.dense", 4 * d, d), lin(p + "output.dense", d, 4 * d), norm(p + "layernorm_before", d), norm(p + "layernorm_after", d))
    return {f"audio_spectrogram_transformer.{k}": v for k, v in s.items()} | {"classifier.dense.bias": np.zeros(3)}


def wav2vec2(d=16, c=4):
    s = every(norm("feature_extractor.conv_layers.0.layer_norm", c), norm("feature_projection.layer_norm", c), lin("feature_projection.projection", d, c), norm("encoder.layer_norm", d))
    for k, (kernel, _) in enumerate(en.WAVE_CONVOLUTIONS):
        s |= lin(f"feature_extractor.conv_layers.{k}.conv", c, c if k else 1, kernel, bias=False)
    s |= {"encoder.pos_conv_embed.conv.weight_g": RNG.uniform(1, 2, (1, 1, 128)), "encoder.pos_conv_embed.conv.weight_v": RNG.standard_normal((d, d // 16, 128)), "encoder.pos_conv_embed.conv.bias": RNG.standard_normal(d)}
    p = "encoder.layers.0."
    s |= every(*(lin(f"{p}attention.{x}_proj", d, d) for x in ("q", "k", "v", "out")), lin(p + "feed_forward.intermediate_dense", 4 * d, d), lin(p + "feed_forward.output_dense", d, 4 * d), norm(p + "layer_norm", d), norm(p + "final_layer_norm", d))
    return {f"wav2vec2.{k}": v for k, v in s.items()} | {"quantizer.codevectors": np.zeros(2)}


def atst(clip, d=8):
    s = every(lin("patch_embed.patch_embed", d, 256), {"pos_embed": RNG.standard_normal((1, 251, d)), "mask_embed": RNG.standard_normal((1, 1, d))})
    p = "blocks.0."
    s |= every(lin(p + "attn.qkv", 3 * d, d, bias=False), lin(p + "attn.proj", d, d), lin(p + "mlp.fc1", 4 * d, d), lin(p + "mlp.fc2", d, 4 * d), norm(p + "norm1", d), norm(p + "norm2", d), norm("norm" if clip else "norm_frame", d))
    s |= {"cls_token": RNG.standard_normal((1, 1, d))} if clip else {}
    return {("module.backbone." if clip else "model.teacher.encoder.") + k: v for k, v in s.items()} | {"model.student.encoder.pos_embed": np.zeros(3)}


def beats(d=16, e=8):
    s = every(lin("patch_embedding", e, 1, 16, 16, bias=False), norm("layer_norm", e), lin("post_extract_proj", d, e), norm("encoder.layer_norm", d), {"encoder.pos_conv.0.weight_g": RNG.uniform(1, 2, (1, 1, 128)), "encoder.pos_conv.0.weight_v": RNG.standard_normal((d, d // 16, 128)), "encoder.pos_conv.0.bias": np.zeros(d)})
    s["encoder.layers.0.self_attn.relative_attention_bias.weight"] = RNG.standard_normal((320, 2))
    p = "encoder.layers.0."
    s |= every(*(lin(f"{p}self_attn.{x}_proj", d, d) for x in ("q", "k", "v", "out")), lin(p + "self_attn.grep_linear", 8, d // 2), {p + "self_attn.grep_a": RNG.uniform(0.5, 2, (1, 2, 1, 1))}, lin(p + "fc1", 4 * d, d), lin(p + "fc2", d, 4 * d), norm(p + "self_attn_layer_norm", d), norm(p + "final_layer_norm", d))
    return s


def clap(w=24, dim=16):
    a = "audio_model.audio_encoder."
    s = every(norm("batch_norm", 64, True), lin("patch_embed.proj", w, 1, 4, 4), lin("patch_embed.mel_conv2d", w, 1, 4, 12), norm("patch_embed.norm", w), norm("norm", 2 * w))
    for f, at in (("local_att", 0), ("global_att", 1)):
        f = f"patch_embed.fusion_model.{f}."
        s |= every(lin(f"{f}{at}", w // 4, w, 1, 1), norm(f"{f}{at + 1}", w // 4, True), lin(f"{f}{at + 3}", w, w // 4, 1, 1), norm(f"{f}{at + 4}", w, True))
    for i in range(2):
        for j in range(2):
            p, d = f"layers.{i}.blocks.{j}.", w << i
            s |= every(*(lin(f"{p}attention.self.{x}", d, d) for x in ("query", "key", "value")), lin(p + "attention.output.dense", d, d), lin(p + "intermediate.dense", 4 * d, d), lin(p + "output.dense", d, 4 * d), norm(p + "layernorm_before", d), norm(p + "layernorm_after", d))
            s[f"{p}attention.self.relative_position_bias_table"] = RNG.standard_normal((225, 1 << i))
    s |= every(lin("layers.0.downsample.reduction", 2 * w, 4 * w, bias=False), norm("layers.0.downsample.norm", 4 * w))
    s = {a + k: v for k, v in s.items()}
    return s | every(lin("audio_projection.linear1", dim, 2 * w), lin("audio_projection.linear2", dim, dim))


CASES = {
    "panns-32k-cnn14-max_mean": ("panns", panns, dict(width=2)),
    "MIT/ast-finetuned-audioset-10-10-0.4593": ("ast", ast, dict(dim=8, depth=1, n_heads=2)),
    "laion/clap-htsat-fused": ("clap", clap, dict(dim=16, width=24, depths=(2, 2), side=128)),
    "facebook/wav2vec2-base": ("wav2vec2", wav2vec2, dict(dim=16, depth=1, n_heads=2, channels=4)),
    "atst-clip-small": ("atst", lambda: atst(True), dict(depth=1)),
    "atst-frame-small": ("atst", lambda: atst(False), dict(depth=1)),
    "beats_iter3": ("beats", beats, dict(dim=16, depth=1, n_heads=2, embed=8)),
}


@pytest.mark.parametrize("name", list(CASES))
def test_a_published_state_loads(tmp_path, name):
    family, make, sizes = CASES[name]
    if name.startswith("atst"):  # width and heads are part of the name
        spec = en.ChunkedTransformer("clip", width=8, n_heads=2, class_token=name == "atst-clip-small", **sizes)
    source, target = str(tmp_path / "s.npz"), str(tmp_path / f"{name.replace('/', '--')}.npz")
    np.savez(source, **make())
    cv.main([family, source, target])
    assert open(f"{target}.sha256").read().strip() == L.digest(target)
    t = np.arange(11 * 48_000) / 48_000
    wave = np.stack([np.sin(2 * np.pi * 440 * t), np.sin(2 * np.pi * 200 * t * t)]).astype(np.float32)
    seconds = np.array([1.0, 2.0 if family != "clap" else 10.5], np.float32)  # the second is long enough for the crops of clap
    if name.startswith("atst"):
        front = create_model(name, granularity="clip", pretrained=False).front
        spec.p = L.Params(path=target)
        encoder = spec
    else:
        m = create_model(name, granularity="clip", pretrained_dir=str(tmp_path), **sizes)
        front, encoder = m.front, m.encoder
    out = encoder.encode(front(wave, 48_000, seconds))["embedding"]
    assert np.isfinite(out).all() and not np.allclose(out[0], out[1])
    # Every weight of the file is used, and nothing else is asked for.
    assert set(encoder.p.made) == set(np.load(target).files)
    open(f"{target}.sha256", "w").write("0" * 64)
    if not name.startswith("atst"):
        with pytest.raises(ValueError, match="digest"):
            create_model(name, granularity="clip", pretrained_dir=str(tmp_path), **sizes)


def test_layouts():
    s = atst(True)
    w = s["module.backbone.patch_embed.patch_embed.weight"]
    x = RNG.standard_normal((4, 64))  # frames x bands
    assert np.allclose(x.reshape(-1) @ cv.convert("atst", s)["patch.w"], w @ x.T.reshape(-1), atol=1e-4)
    s = wav2vec2()
    v, g = (s[f"wav2vec2.encoder.pos_conv_embed.conv.weight_{k}"] for k in "vg")
    full = v * g / np.sqrt((v**2).sum((0, 1), keepdims=True))
    p = L.Params()
    p.made = cv.convert("wav2vec2", s)
    h = RNG.standard_normal((1, 150, 16)).astype(np.float32)
    got = L.conv1d(p, "position", h, 16, 128, groups=16)
    want = np.array([[(h[0, a : a + 128, c] * full[c, 0]).sum() + s["wav2vec2.encoder.pos_conv_embed.conv.bias"][c] for c in range(16)] for a in range(23)])
    assert np.allclose(got[0], want, atol=1e-3)
    s = clap()
    c = cv.convert("clap", s)
    x = RNG.standard_normal((2, 2, 24))  # two by two cells
    theirs = np.concatenate([x[0, 0], x[1, 0], x[0, 1], x[1, 1]])
    assert np.allclose(x.reshape(-1) @ c["merge0.w"], s["audio_model.audio_encoder.layers.0.downsample.reduction.weight"] @ theirs, atol=1e-4)
    s = panns()
    x = RNG.standard_normal(64)
    c = cv.convert("panns", s)
    assert np.allclose(x * c["bn0.g"] + c["bn0.b"], (x - s["bn0.running_mean"]) / np.sqrt(s["bn0.running_var"] + 1e-5) * s["bn0.weight"] + s["bn0.bias"], atol=1e-4)


def test_a_missing_name_is_told():
    s = panns()
    del s["fc1.weight"]
    with pytest.raises(KeyError, match="fc1.weight"):
        cv.convert("panns", s)
    with pytest.raises(KeyError, match="unknown family"):
        cv.convert("other", s)


def test_safetensors(tmp_path):
    import json

    x = np.arange(6, dtype=np.float32).reshape(2, 3)
    half = np.array([1.5, -2.0], np.float32)
    raw = x.tobytes() + (half.view(np.uint32) >> 16).astype(np.uint16).tobytes()
    head = json.dumps({"__metadata__": {}, "a": {"dtype": "F32", "shape": [2, 3], "data_offsets": [0, 24]}, "b": {"dtype": "BF16", "shape": [2], "data_offsets": [24, 28]}}).encode()
    p = tmp_path / "x.safetensors"
    p.write_bytes(len(head).to_bytes(8, "little") + head + raw)
    got = cv.read_safetensors(str(p))
    assert np.array_equal(got["a"], x) and np.array_equal(got["b"], half)


def test_cubic_interpolation_keeps_its_places():
    x = RNG.standard_normal((1, 11, 3))
    assert np.allclose(en.stretch(x, 11), x) and np.allclose(en.stretch(x, 21)[:, ::2], x)
    assert np.allclose(en.stretch(np.ones((1, 11, 1)), 64), 1)
