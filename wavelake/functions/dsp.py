"""Signal arithmetic in numpy: resampling, filter banks, spectra. All functions take whole arrays of equal-length signals."""

from __future__ import annotations

from functools import lru_cache
from math import ceil, gcd

import numpy as np

#: Half width (in zero crossings) and roll-off of the windowed sinc of the resampler.
ZEROS = 6
ROLLOFF = 0.99


@lru_cache(32)
def _sinc_kernels(src: int, dst: int) -> tuple[np.ndarray, int]:
    """One filter per output phase, for reduced rates; and the padding on the left."""
    cutoff = min(src, dst) * ROLLOFF
    half = ceil(ZEROS * src / cutoff)
    taps = np.arange(-half, half + src, dtype=np.float64) / src
    t = np.clip((taps[None, :] - np.arange(dst)[:, None] / dst) * cutoff, -ZEROS, ZEROS)
    return np.sinc(t) * np.cos(t * np.pi / (2 * ZEROS)) ** 2 * (cutoff / src), half


def resample(x: np.ndarray, src: int, dst: int) -> np.ndarray:
    """``x`` (..., n) at rate ``src`` as ceil(n * dst / src) samples at rate ``dst``; equal rates give the very samples."""
    if src == dst:
        return x
    if src <= 0 or dst <= 0:
        raise ValueError("sample rates must be positive")
    g = gcd(src, dst)
    src, dst = src // g, dst // g
    kernels, half = _sinc_kernels(src, dst)
    n = x.shape[-1]
    out = ceil(n * dst / src)
    padded = np.pad(x, [(0, 0)] * (x.ndim - 1) + [(half, half + src)])
    frames = np.lib.stride_tricks.sliding_window_view(padded, kernels.shape[1], axis=-1)[..., ::src, :]
    return (frames @ kernels.T).reshape(*x.shape[:-1], -1)[..., :out].astype(x.dtype, copy=False)


def hz_to_mel(f, scale: str):
    """Mel of a frequency: ``htk`` (2595 log10), ``kaldi`` (1127 ln) or ``slaney`` (linear below 1000 Hz)."""
    f = np.asarray(f, np.float64)
    if scale == "htk":
        return 2595.0 * np.log10(1 + f / 700.0)
    if scale == "kaldi":
        return 1127.0 * np.log(1 + f / 700.0)
    return np.where(f < 1000, f * 3 / 200, 15 + np.log(np.maximum(f, 1e-9) / 1000) * 27 / np.log(6.4))


def mel_to_hz(m, scale: str):
    m = np.asarray(m, np.float64)
    if scale == "htk":
        return 700.0 * (10 ** (m / 2595.0) - 1)
    if scale == "kaldi":
        return 700.0 * (np.exp(m / 1127.0) - 1)
    return np.where(m < 15, m * 200 / 3, 1000 * np.exp((m - 15) * np.log(6.4) / 27))


@lru_cache(32)
def mel_bank(rate: int, n_fft: int, bands: int, low: float, high: float, scale: str, area: bool = False) -> np.ndarray:
    """Triangular filters, bands x (n_fft / 2 + 1).

    The ``kaldi`` filters are triangles over mel, the others over frequency; ``area`` scales each to unit area. The Kaldi bank gives the
    highest bin no weight.
    """
    edges = np.linspace(hz_to_mel(low, scale), hz_to_mel(high, scale), bands + 2)
    freq = np.arange(n_fft // 2 + 1) * rate / n_fft
    if scale == "kaldi":
        x, at = hz_to_mel(freq, scale), edges
    else:
        x, at = freq, mel_to_hz(edges, scale)
    up = (x[None, :] - at[:-2, None]) / (at[1:-1] - at[:-2])[:, None]
    down = (at[2:, None] - x[None, :]) / (at[2:] - at[1:-1])[:, None]
    bank = np.maximum(0, np.minimum(up, down))
    if area:
        bank *= (2 / (at[2:] - at[:-2]))[:, None]
    if scale == "kaldi":
        bank[:, -1] = 0
    return bank


def hann(n: int, periodic: bool = True) -> np.ndarray:
    return 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(n) / (n if periodic else n - 1))


def frames(x: np.ndarray, size: int, hop: int) -> np.ndarray:
    """(..., count, size): every frame that fits."""
    return np.lib.stride_tricks.sliding_window_view(x, size, axis=-1)[..., ::hop, :]


def centred(x: np.ndarray, n_fft: int) -> np.ndarray:
    """Half a window on both sides: mirrored, or zeros where the signal is too short to mirror."""
    mode = "reflect" if x.shape[-1] > n_fft // 2 else "constant"
    return np.pad(x, [(0, 0)] * (x.ndim - 1) + [(n_fft // 2, n_fft // 2)], mode=mode)


def power_spectrum(x: np.ndarray, n_fft: int, hop: int) -> np.ndarray:
    """(..., time, bins) of centred frames under a periodic Hann window."""
    s = np.fft.rfft(frames(centred(x, n_fft), n_fft, hop) * hann(n_fft), axis=-1)
    return s.real**2 + s.imag**2


def kaldi_fbank(x: np.ndarray, rate: int, bands: int, window: np.ndarray, n_fft: int, hop: int, low: float = 20.0, emphasis: float = 0.97) -> np.ndarray:
    """Log filter-bank energies (..., time, bands) of frames without mean and with pre-emphasis."""
    f = frames(x, len(window), hop)
    f = f - f.mean(-1, keepdims=True)
    f = (f - emphasis * np.concatenate([f[..., :1], f[..., :-1]], -1)) * window
    s = np.fft.rfft(f, n_fft, axis=-1)
    mel = (s.real**2 + s.imag**2) @ mel_bank(rate, n_fft, bands, low, rate / 2, "kaldi").T
    return np.log(np.maximum(mel, np.finfo(np.float32).eps))


def fit_length(x: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` samples, zeros where there are fewer."""
    return x[..., :n] if x.shape[-1] >= n else np.pad(x, [(0, 0)] * (x.ndim - 1) + [(0, n - x.shape[-1])])


def half_even_ratio(a: int, b: int) -> int:
    """a / b of whole numbers that are not negative, halves to even."""
    q, r = divmod(a, b)
    return q + (2 * r > b or (2 * r == b and q % 2 == 1))
