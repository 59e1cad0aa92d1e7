"""Published weights brought to the names and layouts of the encoders here.

``convert(family, state)`` takes a state dictionary with the names of the published checkpoint (arrays by name) and returns what
``Params`` reads from an ``.npz`` file. On the command line::

    python -m wavelake.models.convert FAMILY SOURCE TARGET.npz

SOURCE is an ``.npz`` or ``.safetensors`` file, or a torch checkpoint where torch is installed. The digest of TARGET is written beside it.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Callable, Mapping

import numpy as np

from wavelake.models.layers import digest

State = Mapping[str, np.ndarray]


class Target(dict):
    """Converted weights, filled from a state below some prefix."""

    def __init__(self, state: State, *prefixes: str):
        super().__init__()
        prefix = next((p for p in prefixes if any(k.startswith(p) for k in state)), "")
        self.state = {k.removeprefix(prefix): np.asarray(v, np.float32) for k, v in state.items() if k.startswith(prefix)}

    def get_(self, *names: str) -> np.ndarray:
        """The first of some names that the state has."""
        for n in names:
            if n in self.state:
                return self.state[n]
        raise KeyError(f"the weights lack {' or '.join(names)}")

    def count(self, pattern: str) -> int:
        """How many numbers the group of ``pattern`` takes from 0 on."""
        return 1 + max((int(m[1]) for k in self.state if (m := re.match(pattern, k))), default=-1)

    def linear(self, to: str, of: str, bias: bool = True) -> None:
        """Point-wise and patch layers: inputs x outputs."""
        w = self.get_(f"{of}.weight")
        self[f"{to}.w"] = w.reshape(len(w), -1).T
        if bias:
            self[f"{to}.b"] = self.state.get(f"{of}.bias", np.zeros(len(w), np.float32))

    def norm(self, to: str, of: str) -> None:
        self[f"{to}.g"], self[f"{to}.b"] = self.get_(f"{of}.weight"), self.get_(f"{of}.bias")

    def folded(self, g: str, b: str, of: str, eps: float = 1e-5) -> None:
        """A batch normalisation with its running statistics as one scale and shift."""
        scale = self.get_(f"{of}.weight") / np.sqrt(self.get_(f"{of}.running_var") + eps)
        self[g], self[b] = scale, self.get_(f"{of}.bias") - self.get_(f"{of}.running_mean") * scale

    def grouped(self, to: str, of: str, groups: int) -> None:
        """A convolution over time whose weight may come as length and direction."""
        v = self.state.get(f"{of}.weight")
        if v is None:
            g = self.get_(f"{of}.weight_g", f"{of}.parametrizations.weight.original0")
            v = self.get_(f"{of}.weight_v", f"{of}.parametrizations.weight.original1")
            v = v * g / np.sqrt((v**2).sum((0, 1), keepdims=True))
        self[f"{to}.w"] = v.reshape(groups, len(v) // groups, -1).transpose(0, 2, 1)
        self[f"{to}.b"] = self.state.get(f"{of}.bias", np.zeros(len(v), np.float32))

    def layers(self, to: str, of: str, n: int, parts: Mapping[str, str], norms: Mapping[str, str]) -> None:
        for k in range(n):
            for mine, theirs in parts.items():
                self.linear(f"{to}{k}.{mine}", f"{of}{k}.{theirs}")
            for mine, theirs in norms.items():
                self.norm(f"{to}{k}.{mine}", f"{of}{k}.{theirs}")


def _groups(dim: int) -> int:
    return 16 if dim % 16 == 0 else 1


def panns(state: State) -> Target:
    t = Target(state)
    t.folded("bn0.g", "bn0.b", "bn0")
    for k in range(6):
        for i in (1, 2):
            t.linear(f"block{k}.conv{i}", f"conv_block{k + 1}.conv{i}", bias=False)
            t.folded(f"block{k}.bn{i}.g", f"block{k}.bn{i}.b", f"conv_block{k + 1}.bn{i}")
    t.linear("fc", "fc1")
    return t


def ast(state: State) -> Target:
    t = Target(state, "audio_spectrogram_transformer.")
    t["extra"] = np.concatenate([t.get_("embeddings.cls_token"), t.get_("embeddings.distillation_token")], 1)
    t["position"] = t.get_("embeddings.position_embeddings")
    t.linear("patch", "embeddings.patch_embeddings.projection")
    att = "attention.attention."
    parts = {"att.q": f"{att}query", "att.k": f"{att}key", "att.v": f"{att}value", "att.o": "attention.output.dense", "mlp.1": "intermediate.dense", "mlp.2": "output.dense"}
    t.layers("layer", "encoder.layer.", t.count(r"encoder\.layer\.(\d+)\."), parts, {"n1": "layernorm_before", "n2": "layernorm_after"})
    t.norm("norm", "layernorm")
    return t


def wav2vec2(state: State) -> Target:
    t = Target(state, "wav2vec2.")
    for k in range(t.count(r"feature_extractor\.conv_layers\.(\d+)\.")):
        t.grouped(f"conv{k}", f"feature_extractor.conv_layers.{k}.conv", 1)
    t.norm("conv0.n", "feature_extractor.conv_layers.0.layer_norm")
    t.norm("project.n", "feature_projection.layer_norm")
    t.linear("project", "feature_projection.projection")
    t.grouped("position", "encoder.pos_conv_embed.conv", _groups(len(t["project.b"])))
    t.norm("norm", "encoder.layer_norm")
    parts = {"att.q": "attention.q_proj", "att.k": "attention.k_proj", "att.v": "attention.v_proj", "att.o": "attention.out_proj", "mlp.1": "feed_forward.intermediate_dense", "mlp.2": "feed_forward.output_dense"}
    t.layers("layer", "encoder.layers.", t.count(r"encoder\.layers\.(\d+)\."), parts, {"n1": "layer_norm", "n2": "final_layer_norm"})
    return t


def atst(state: State, bands: int = 64) -> Target:
    """Clip and frame models; of a whole archive the teacher's encoder is taken."""
    t = Target(state, "model.teacher.encoder.", "module.backbone.")
    w = t.get_("patch_embed.patch_embed.weight")
    # Numbers of a patch run over bands first there, over frames first here.
    t["patch.w"] = w.reshape(len(w), bands, -1).transpose(0, 2, 1).reshape(len(w), -1).T
    t["patch.b"] = t.get_("patch_embed.patch_embed.bias")
    t["position"] = t.get_("pos_embed")
    n = t.count(r"blocks\.(\d+)\.")
    t.layers("layer", "blocks.", n, {"att.o": "attn.proj", "mlp.1": "mlp.fc1", "mlp.2": "mlp.fc2"}, {"n1": "norm1", "n2": "norm2"})
    for k in range(n):
        w = t.get_(f"blocks.{k}.attn.qkv.weight")
        b = t.state.get(f"blocks.{k}.attn.qkv.bias", np.zeros(len(w), np.float32))
        for c, x, y in zip("qkv", np.split(w, 3), np.split(b, 3)):
            t[f"layer{k}.att.{c}.w"], t[f"layer{k}.att.{c}.b"] = x.T, y
    if "norm_frame.weight" in t.state:
        t.norm("norm", "norm_frame")
    else:
        t["class"] = t.get_("cls_token")
        t.norm("norm", "norm")
    return t


def beats(state: State) -> Target:
    t = Target(state)
    t.linear("patch", "patch_embedding", bias=False)
    t.norm("patch.n", "layer_norm")
    t.linear("project", "post_extract_proj")
    t.grouped("position", "encoder.pos_conv.0", _groups(len(t["project.b"])))
    t.norm("norm", "encoder.layer_norm")
    t["relative"] = t.get_("encoder.layers.0.self_attn.relative_attention_bias.weight")
    n = t.count(r"encoder\.layers\.(\d+)\.")
    parts = {"att.q": "self_attn.q_proj", "att.k": "self_attn.k_proj", "att.v": "self_attn.v_proj", "att.o": "self_attn.out_proj", "gate": "self_attn.grep_linear", "mlp.1": "fc1", "mlp.2": "fc2"}
    t.layers("layer", "encoder.layers.", n, parts, {"n1": "self_attn_layer_norm", "n2": "final_layer_norm"})
    for k in range(n):
        t[f"layer{k}.scale"] = t.get_(f"encoder.layers.{k}.self_attn.grep_a").reshape(-1, 1, 1)
    return t


def clap(state: State) -> Target:
    t = Target({k.replace("audio_model.audio_encoder.", ""): v for k, v in state.items()})
    t.folded("bn0.g", "bn0.b", "batch_norm")
    t.linear("patch", "patch_embed.proj")
    t.linear("crop", "patch_embed.mel_conv2d")
    # Point-wise layers and their normalisations: the same numbers in both gates, one later where the mean is taken first.
    for to, of, at in (("near", "patch_embed.fusion_model.local_att", 0), ("far", "patch_embed.fusion_model.global_att", 1)):
        for k, step in ((1, 0), (2, 3)):
            t.linear(f"{to}.{k}", f"{of}.{at + step}")
            t.folded(f"{to}.{k}.g", f"{to}.{k}.s", f"{of}.{at + step + 1}")
    t.norm("patch.n", "patch_embed.norm")
    att = "attention.self."
    parts = {"att.q": f"{att}query", "att.k": f"{att}key", "att.v": f"{att}value", "att.o": "attention.output.dense", "mlp.1": "intermediate.dense", "mlp.2": "output.dense"}
    stages = t.count(r"layers\.(\d+)\.")
    for i in range(stages):
        n = t.count(rf"layers\.{i}\.blocks\.(\d+)\.")
        t.layers(f"stage{i}.", f"layers.{i}.blocks.", n, parts, {"n1": "layernorm_before", "n2": "layernorm_after"})
        for j in range(n):
            t[f"stage{i}.{j}.rel"] = t.get_(f"layers.{i}.blocks.{j}.{att}relative_position_bias_table").T
        if i + 1 < stages:
            # The four cells that are merged: columns before rows there, rows before columns here.
            turn = lambda w: w.reshape(*w.shape[:-1], 4, -1)[..., [0, 2, 1, 3], :].reshape(w.shape)
            t[f"merge{i}.w"] = turn(t.get_(f"layers.{i}.downsample.reduction.weight")).T
            t[f"merge{i}.n.g"], t[f"merge{i}.n.b"] = (turn(t.get_(f"layers.{i}.downsample.norm.{x}")) for x in ("weight", "bias"))
    t.norm("norm", "norm")
    t.linear("proj1", "audio_projection.linear1")
    t.linear("proj2", "audio_projection.linear2")
    return t


FAMILIES: dict[str, Callable[[State], Target]] = {"panns": panns, "ast": ast, "clap": clap, "wav2vec2": wav2vec2, "atst": atst, "beats": beats}


def convert(family: str, state: State) -> dict[str, np.ndarray]:
    """Weights of the family's encoder from a published state dictionary; a name that is missing is a KeyError."""
    if family not in FAMILIES:
        raise KeyError(f"unknown family {family}; known: {', '.join(FAMILIES)}")
    return {k: np.ascontiguousarray(v, np.float32) for k, v in FAMILIES[family](state).items()}


def read_safetensors(path: str) -> dict[str, np.ndarray]:
    """Arrays of a safetensors file: a length, a JSON head, and the numbers."""
    kinds = {"F64": np.float64, "F32": np.float32, "F16": np.float16, "I64": np.int64, "I32": np.int32}
    with open(path, "rb") as f:
        head = json.loads(f.read(int.from_bytes(f.read(8), "little")))
        base = f.tell()
        out = {}
        for name, x in head.items():
            if name == "__metadata__":
                continue
            a, b = x["data_offsets"]
            f.seek(base + a)
            raw = f.read(b - a)
            if x["dtype"] == "BF16":
                out[name] = (np.frombuffer(raw, np.uint16).astype(np.uint32) << 16).view(np.float32).reshape(x["shape"])
            else:
                out[name] = np.frombuffer(raw, kinds[x["dtype"]]).reshape(x["shape"])
    return out


def read_state(path: str) -> dict[str, np.ndarray]:
    if path.endswith(".npz"):
        return dict(np.load(path, allow_pickle=False))
    if path.endswith(".safetensors"):
        return read_safetensors(path)
    try:
        import torch
    except ImportError as e:
        raise ImportError("torch checkpoints need the torch package; save the state dictionary as .npz or .safetensors instead") from e
    state = torch.load(path, map_location="cpu", weights_only=True)
    for key in ("model", "state_dict", "teacher"):
        state = state.get(key, state) if isinstance(state.get(key), dict) else state
    return {k: v.numpy() for k, v in state.items() if hasattr(v, "numpy")}


def main(argv: list[str]) -> None:
    family, source, target = argv
    np.savez(target, **convert(family, read_state(source)))
    with open(f"{target}.sha256", "w") as f:
        f.write(digest(target) + "\n")


if __name__ == "__main__":
    main(sys.argv[1:])
