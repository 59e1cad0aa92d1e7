"""Building blocks of the encoders, as functions over arrays; weights come from a ``Params`` store."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable

import numpy as np


class Params:
    """Weights by name: from a local ``.npz`` file, or drawn by a generator seeded with the name."""

    def __init__(self, seed: int = 0, path: str | None = None, sha256: str | None = None):
        self.seed, self.made = seed, {}
        self.loaded = None
        if path is not None:
            if not os.path.isfile(path):
                raise FileNotFoundError(f"no weights at {path}")
            if sha256 is not None and digest(path) != sha256:
                raise ValueError(f"{path} has another digest than expected")
            self.loaded = np.load(path, allow_pickle=False)

    def __call__(self, name: str, shape: tuple[int, ...], fill: float | None = None) -> np.ndarray:
        if name not in self.made:
            if self.loaded is not None:
                x = self.loaded[name].astype(np.float32)
                if x.shape != shape:
                    raise ValueError(f"{name} has shape {x.shape}, not {shape}")
            elif fill is not None:
                x = np.full(shape, fill, np.float32)
            else:
                rng = np.random.default_rng(int.from_bytes(hashlib.sha256(f"{self.seed}:{name}".encode()).digest()[:8], "big"))
                x = (rng.standard_normal(shape) / np.sqrt(np.prod(shape[:-1]))).astype(np.float32)
            self.made[name] = x
        return self.made[name]


def digest(path: str) -> str:
    h = hashlib.sha256()
    with open(path, "rb") as f:
        while block := f.read(1 << 20):
            h.update(block)
    return h.hexdigest()


def linear(p: Params, name: str, x: np.ndarray, out: int, bias: bool = True) -> np.ndarray:
    y = x @ p(f"{name}.w", (x.shape[-1], out))
    return y + p(f"{name}.b", (out,), 0.0) if bias else y


def layer_norm(p: Params, name: str, x: np.ndarray, eps: float = 1e-5) -> np.ndarray:
    d = x.shape[-1]
    m = x.mean(-1, keepdims=True)
    return (x - m) / np.sqrt(x.var(-1, keepdims=True) + eps) * p(f"{name}.g", (d,), 1.0) + p(f"{name}.b", (d,), 0.0)


def gelu(x: np.ndarray) -> np.ndarray:
    """Gaussian error linear unit, with the error function by a rational approximation (error below 1.5e-7)."""
    z = np.abs(x) / np.sqrt(2.0)
    t = 1 / (1 + 0.3275911 * z)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return x * 0.5 * (1 + np.sign(x) * (1 - poly * np.exp(-z * z)))


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def heads(x: np.ndarray, n: int) -> np.ndarray:
    """(..., tokens, dim) as (..., heads, tokens, dim / heads)."""
    return np.swapaxes(x.reshape(*x.shape[:-1], n, -1), -2, -3)


def attention(p: Params, name: str, x: np.ndarray, n_heads: int, bias: Callable | np.ndarray | None = None) -> np.ndarray:
    """Self-attention; ``bias`` is added to the scores, or computed from the heads' unscaled queries."""
    d = x.shape[-1]
    q, k, v = (heads(linear(p, f"{name}.{c}", x, d), n_heads) for c in "qkv")
    s = q @ np.swapaxes(k, -1, -2) / np.sqrt(d / n_heads)
    if bias is not None:
        s = s + (bias(q) if callable(bias) else bias)
    y = np.swapaxes(softmax(s) @ v, -2, -3)
    return linear(p, f"{name}.o", y.reshape(*x.shape), d)


def mlp(p: Params, name: str, x: np.ndarray, ratio: float = 4.0) -> np.ndarray:
    return linear(p, f"{name}.2", gelu(linear(p, f"{name}.1", x, int(x.shape[-1] * ratio))), x.shape[-1])


def block(p: Params, name: str, x: np.ndarray, n_heads: int, norm_first: bool = True, bias=None, residual: float = 1.0, eps: float = 1e-5) -> np.ndarray:
    """One transformer layer; ``residual`` scales the path around (deep norm)."""
    if norm_first:
        x = x + attention(p, f"{name}.att", layer_norm(p, f"{name}.n1", x, eps), n_heads, bias)
        return x + mlp(p, f"{name}.mlp", layer_norm(p, f"{name}.n2", x, eps))
    x = layer_norm(p, f"{name}.n1", residual * x + attention(p, f"{name}.att", x, n_heads, bias), eps)
    return layer_norm(p, f"{name}.n2", residual * x + mlp(p, f"{name}.mlp", x), eps)


def patches(x: np.ndarray, size: tuple[int, int], step: tuple[int, int]) -> np.ndarray:
    """(batch, rows, columns) as (batch, row patches, column patches, numbers of a patch)."""
    w = np.lib.stride_tricks.sliding_window_view(x, size, axis=(1, 2))[:, :: step[0], :: step[1]]
    return w.reshape(*w.shape[:3], -1)


def conv1d(p: Params, name: str, x: np.ndarray, out: int, kernel: int, stride: int = 1, groups: int = 1, pad: int = 0) -> np.ndarray:
    """(batch, time, channels) to (batch, time', out)."""
    if pad:
        x = np.pad(x, ((0, 0), (pad, pad), (0, 0)))
    w = np.lib.stride_tricks.sliding_window_view(x, kernel, axis=1)[:, ::stride]  # batch, time, channels, kernel
    b, t, c, _ = w.shape
    w = w.reshape(b, t, groups, c // groups * kernel)
    k = p(f"{name}.w", (groups, c // groups * kernel, out // groups))
    return np.einsum("btgi,gio->btgo", w, k, optimize=True).reshape(b, t, out) + p(f"{name}.b", (out,), 0.0)


def conv2d_same(p: Params, name: str, x: np.ndarray, out: int) -> np.ndarray:
    """3 x 3 convolution of (batch, rows, columns, channels) without bias."""
    x = np.pad(x, ((0, 0), (1, 1), (1, 1), (0, 0)))
    w = np.lib.stride_tricks.sliding_window_view(x, (3, 3), axis=(1, 2))
    return w.reshape(*w.shape[:3], -1) @ p(f"{name}.w", (x.shape[-1] * 9, out))


def relu(x: np.ndarray) -> np.ndarray:
    return np.maximum(x, 0)


def pool3(x: np.ndarray, how: str) -> np.ndarray:
    """Mean or maximum over three neighbouring frames of (batch, time, dim)."""
    pad = 0.0 if how == "mean" else -np.inf
    w = np.lib.stride_tricks.sliding_window_view(np.pad(x, ((0, 0), (1, 1), (0, 0)), constant_values=pad), 3, axis=1)
    return w.mean(-1) if how == "mean" else w.max(-1)
