"""Registry of models: which front end and encoder a name stands for."""

from __future__ import annotations

import inspect
import os
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from types import MappingProxyType

import numpy as np

from wavelake.functions import frontends as fe
from wavelake.models import encoders as en
from wavelake.models.layers import Params

#: Names that every model takes and none may fix.
PUBLIC_PARAMETERS = frozenset({"granularity", "pretrained", "pretrained_dir"})


@dataclass(frozen=True)
class ModelSpec:
    front: Callable
    encoder: Callable
    fixed: Mapping = field(default_factory=dict)

    def __post_init__(self):
        clash = PUBLIC_PARAMETERS & set(self.fixed)
        if clash:
            raise ValueError(f"fixed arguments may not be {sorted(clash)}")
        object.__setattr__(self, "fixed", MappingProxyType(dict(self.fixed)))


@dataclass
class ModelPair:
    """A front end and an encoder; ``embed`` runs both on a batch of waveforms."""

    front: fe.FrontEnd
    encoder: en.Encoder

    def embed(self, wave: np.ndarray, rate: int, valid_seconds: np.ndarray | None = None) -> dict[str, np.ndarray]:
        return self.encoder.encode(self.front(wave, rate, valid_seconds))

    def frame_count(self, seg_sec: float) -> int:
        """Frames of a whole segment; no shorter one has more."""
        return self.encoder.canvas(int(fe.valid_samples(np.array([seg_sec]), self.front.rate)[0]))


_MODELS: dict[str, ModelSpec] = {}


def register_model(name: str, spec: ModelSpec) -> None:
    _MODELS[name] = spec


def list_models() -> list[str]:
    return sorted(_MODELS)


def _accepted(f: Callable) -> set[str]:
    names = [p.name for p in inspect.signature(f.__init__ if inspect.isclass(f) else f).parameters.values() if p.kind in (p.POSITIONAL_OR_KEYWORD, p.KEYWORD_ONLY)]
    return set(names) - {"self", "granularity", "params"}


def create_model(name: str, *, granularity: str, pretrained: bool = True, pretrained_dir: str | None = None, seed: int = 0, **kwargs) -> ModelPair:
    """The model of that name.

    Every further argument goes to whichever of front end and encoder declares it, to both if both do; one that neither declares, or
    that the model fixes, is a TypeError. Weights come from ``{pretrained_dir}/{name}.npz`` (with ``--`` for ``/``;
    ``models.convert`` makes such files), whose digest must be that of a ``.sha256`` file beside it, if there is one; without ``pretrained`` they are drawn.
    The granularity is checked before any weights are looked for.
    """
    if name not in _MODELS:
        raise KeyError(f"unknown model {name}; known: {', '.join(list_models())}")
    spec = _MODELS[name]
    fixed = set(kwargs) & set(spec.fixed)
    if fixed:
        raise TypeError(f"{name} fixes {sorted(fixed)}")
    to_front, to_encoder = _accepted(spec.front), _accepted(spec.encoder)
    stray = set(kwargs) - to_front - to_encoder
    if stray:
        raise TypeError(f"{name} takes no {sorted(stray)}")
    every = {**spec.fixed, **kwargs}
    enc = {k: v for k, v in every.items() if k in to_encoder}
    encoder = spec.encoder(granularity, Params(seed), **enc)
    if pretrained and spec.encoder is not en.Checksum:
        if pretrained_dir is None:
            raise FileNotFoundError(f"{name}: weights are only read from a local folder; name it in pretrained_dir, or say pretrained=False")
        path = os.path.join(pretrained_dir, f"{name.replace('/', '--')}.npz")
        # Beside the weights may lie the digest that they must have.
        want = open(f"{path}.sha256").read().split()[0] if os.path.isfile(f"{path}.sha256") else None
        encoder.p = Params(seed, path, want)
    front = spec.front(**{k: v for k, v in every.items() if k in to_front})
    if isinstance(front, fe.LogMel) and encoder.p.loaded is not None:
        # The normalisation of the bands is part of the weights.
        front.scale, front.shift = encoder.p("bn0.g", (64,)), encoder.p("bn0.b", (64,))
    return ModelPair(front, encoder)


# Names of five pretrained checkpoints of one architecture, and of two tuned versions of each.
BEATS = (
    "beats_iter1",
    "beats_iter2",
    "beats_iter3",
    "beats_iter3_plus_as20k",
    "beats_iter3_plus_as2m",
    "fine_tuned_beats_iter1_cpt1",
    "fine_tuned_beats_iter1_cpt2",
    "fine_tuned_beats_iter2_cpt1",
    "fine_tuned_beats_iter2_cpt2",
    "fine_tuned_beats_iter3_cpt1",
    "fine_tuned_beats_iter3_cpt2",
    "fine_tuned_beats_iter3_plus_as20k_cpt1",
    "fine_tuned_beats_iter3_plus_as20k_cpt2",
    "fine_tuned_beats_iter3_plus_as2m_cpt1",
    "fine_tuned_beats_iter3_plus_as2m_cpt2",
)


def _built_in() -> None:
    for rate, pooling in ((32_000, "max_mean"), (32_000, "decision_level_max"), (16_000, "max_mean")):
        hop = 320 if rate == 32_000 else 160
        register_model(f"panns-{rate // 1000}k-cnn14-{pooling}", ModelSpec(fe.LogMel, en.ConvNet, {"rate": rate, "pooling": pooling, "hop": hop}))
    # Names of published checkpoints.
    register_model("MIT/ast-finetuned-audioset-10-10-0.4593", ModelSpec(fe.FixedFbank, en.PatchTransformer))
    register_model("laion/clap-htsat-fused", ModelSpec(fe.FusedLogMel, en.ShiftedWindows))
    register_model("facebook/wav2vec2-base", ModelSpec(fe.Waveform, en.WaveTransformer, {"standardise": True}))
    for size, width, n in (("small", 384, 6), ("base", 768, 12)):
        register_model(f"atst-clip-{size}", ModelSpec(fe.FlooredMel, en.ChunkedTransformer, {"width": width, "n_heads": n, "class_token": True}))
        register_model(f"atst-frame-{size}", ModelSpec(fe.FlooredMel, en.ChunkedTransformer, {"width": width, "n_heads": n, "class_token": False}))
    for name in BEATS:
        register_model(name, ModelSpec(fe.PoveyFbank, en.GatedTransformer))
    register_model("checksum", ModelSpec(lambda: fe.Waveform(False), en.Checksum))


_built_in()
