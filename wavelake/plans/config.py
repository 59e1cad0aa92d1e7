"""Settings of the two builds, their digests and default places."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Mapping
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import SparkSession

from wavelake.models.registry import PUBLIC_PARAMETERS
from wavelake.plans.storage import Folder

LABEL_TYPES = ("weak", "strong")
RAW_MARKER, EMB_MARKER, LABELS = "prep_config.json", "emb_config.json", "label_index.json"


def digest(values: Mapping) -> str:
    """A short digest of settings: the order of their keys does not matter."""
    return hashlib.sha256(json.dumps(values, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()[:16]


@dataclass(frozen=True)
class PrepConfig:
    """Settings of a raw table. The digest covers what its rows depend on: neither folders nor batch sizes."""

    dataset_name: str
    dataset_dir: str
    split_json: str
    split_digest: str
    sr: int = 16_000
    mono: bool = True
    seg_sec: float = 10.0
    hop_sec: float = 10.0
    tol_sec: float = 0.0
    label_type: str = "weak"
    cache_dir: str = ""
    batch_size: int = 16
    overwrite: bool = False
    config_hash: str = ""

    HASHED = ("dataset_name", "split_digest", "sr", "mono", "seg_sec", "hop_sec", "tol_sec", "label_type")

    def sidecar(self) -> dict:
        return {k: v for k, v in asdict(self).items() if k != "overwrite"}


def split_path(dataset_name: str, split_json: str | None, assets: str, generate=None) -> str:
    """The manifest: the one named, which must exist, or the default one, which ``generate(path)`` makes if it is missing."""
    if split_json is not None:
        if not os.path.isfile(split_json):
            raise FileNotFoundError(split_json)
        return split_json
    path = os.path.join(assets, dataset_name, "default.json")
    if not os.path.isfile(path):
        if generate is None:
            raise FileNotFoundError(f"{path} is missing and {dataset_name} has no split generator")
        generate(path)
    return path


def resolve_prep(dataset_name: str, dataset_dir: str | None, cache_dir: str | None = None, split_json: str | None = None, assets: str = "assets/splits", generate=None, **settings) -> PrepConfig:
    if not dataset_dir:
        raise ValueError("dataset_dir is missing")
    if settings.get("label_type", "weak") not in LABEL_TYPES:
        raise ValueError(f"label_type is one of {LABEL_TYPES}")
    for k in ("sr", "seg_sec", "hop_sec"):
        if k in settings and not settings[k] > 0:
            raise ValueError(f"{k} must be positive")
    path = split_path(dataset_name, split_json, assets, generate)
    with open(path, "rb") as f:
        content = hashlib.sha256(f.read()).hexdigest()
    c = PrepConfig(dataset_name, dataset_dir, path, content, **settings)
    c = replace(c, seg_sec=float(c.seg_sec), hop_sec=float(c.hop_sec), tol_sec=float(c.tol_sec))
    h = digest({k: getattr(c, k) for k in PrepConfig.HASHED})
    return replace(c, config_hash=h, cache_dir=cache_dir or os.path.join(os.getcwd(), dataset_name, h))


@dataclass(frozen=True)
class EmbConfig:
    """Settings of an embedding table; it lies at a path that its settings determine."""

    raw_dir: str
    dataset_name: str
    raw_hash: str
    sr: int
    seg_sec: float
    label_type: str
    model_name: str
    granularity: str
    output_dir: str
    pretrained: bool = True
    pretrained_dir: str | None = None
    model_kwargs: Mapping = field(default_factory=dict)
    batch_size: int = 32
    overwrite: bool = False
    config_hash: str = ""

    def sidecar(self) -> dict:
        return {k: (dict(v) if isinstance(v, Mapping) else v) for k, v in self.__dict__.items() if k != "overwrite"}


def resolve_emb(spark: SparkSession, raw_dir: str, model_name: str, granularity: str, output_root: str, model_kwargs: Mapping | None = None, **settings) -> EmbConfig:
    kwargs = dict(model_kwargs or {})
    clash = PUBLIC_PARAMETERS & set(kwargs)
    if clash:
        raise ValueError(f"model_kwargs may not hold {sorted(clash)}")
    raw = Folder(spark, raw_dir)
    meta = raw.read_json(RAW_MARKER)
    values = {"raw_hash": meta["config_hash"], "model_name": model_name, "granularity": granularity}
    if kwargs:
        values["model_kwargs"] = kwargs
    h = digest(values)
    out = "/".join((output_root.rstrip("/"), meta["dataset_name"], model_name.replace("/", "--"), h))
    return EmbConfig(raw.path, meta["dataset_name"], meta["config_hash"], meta["sr"], meta["seg_sec"], meta["label_type"], model_name, granularity, out, model_kwargs=kwargs, config_hash=h, **settings)
