"""Front ends: waveforms to the features an encoder takes.

All share one contract: ``front(wave, rate, valid_seconds)`` with ``wave`` (batch, n) or (batch, channels, n). Channels are averaged, the valid
prefix alone is resampled and analysed, so neither what follows it nor the rest of the batch has any influence. Rows of one
valid length are computed together.
"""

from __future__ import annotations

import numpy as np

from wavelake.functions import dsp


def valid_samples(seconds: np.ndarray, rate: int) -> np.ndarray:
    """Seconds times rate in single precision, halves to even."""
    return np.rint(np.asarray(seconds, np.float32) * np.float32(rate)).astype(np.int64)


class FrontEnd:
    rate = 16_000

    def __call__(self, wave: np.ndarray, rate: int, valid_seconds: np.ndarray | None = None) -> dict[str, np.ndarray]:
        """Features of a batch, padded with zeros to the longest, and the number of valid frames (or samples) of each row."""
        wave = np.asarray(wave)
        if wave.ndim not in (2, 3) or not np.issubdtype(wave.dtype, np.floating):
            raise TypeError("a waveform is a float array (batch, samples) or (batch, channels, samples)")
        if not isinstance(rate, int) or isinstance(rate, bool) or rate <= 0:
            raise TypeError("the sample rate is a positive whole number")
        if wave.shape[0] == 0 or wave.shape[-1] == 0:
            raise ValueError("an empty waveform")
        mono = wave.mean(1) if wave.ndim == 3 else wave
        mono = mono.astype(np.float32)
        n = mono.shape[-1]
        if valid_seconds is None:
            have = np.full(len(mono), n)
            target = np.full(len(mono), dsp.half_even_ratio(n * self.rate, rate))
            seconds = np.full(len(mono), n / rate, np.float32)
        else:
            seconds = np.asarray(valid_seconds, np.float32)
            if seconds.shape != (len(mono),):
                raise ValueError("valid_seconds has one number per row")
            if not ((seconds > 0) & (seconds <= np.float32(n / rate) + np.float32(1e-6))).all():
                raise ValueError("valid_seconds lies outside the waveform")
            have = np.clip(valid_samples(seconds, rate), 1, n)
            target = valid_samples(seconds, self.rate)
        target = np.maximum(target, 1)
        self.check(target)
        groups, rows = [], []
        for h, t in sorted({*zip(have.tolist(), target.tolist())}):
            pick = np.flatnonzero((have == h) & (target == t))
            x = dsp.fit_length(dsp.resample(mono[pick, :h], rate, self.rate), t)
            groups.append(self.features(x))
            rows.append(pick)
        longest = max(g.shape[self.time_axis] for g in groups)
        out, valid = None, np.zeros(len(mono), np.int64)
        for g, pick in zip(groups, rows):
            pad = [(0, 0)] * g.ndim
            pad[self.time_axis] = (0, longest - g.shape[self.time_axis])
            g2 = np.pad(g, pad)
            if out is None:
                out = np.zeros((len(mono), *g2.shape[1:]), np.float32)
            out[pick] = g2
            valid[pick] = self.frames(int(target[pick[0]]))
        return {"input_features": out, "valid_seconds": seconds, "valid": valid, "samples": target}

    #: Axis along which the features of rows differ in length.
    time_axis = 1

    def check(self, samples: np.ndarray) -> None:
        """Raises for lengths the front end does not take."""

    def frames(self, samples: int) -> int:
        """Valid frames of a row with so many samples at the front end's rate."""
        raise NotImplementedError

    def features(self, x: np.ndarray) -> np.ndarray:
        raise NotImplementedError


class LogMel(FrontEnd):
    """Log-mel energies in dB with batch normalisation per band; the time axis is filled to 32 frames with silence."""

    def __init__(self, rate: int = 32_000, scale: np.ndarray | None = None, shift: np.ndarray | None = None):
        # Window, hop and band of the two rates.
        layouts = {16_000: (512, 160, 50.0, 8000.0), 32_000: (1024, 320, 50.0, 14000.0)}
        if rate not in layouts:
            raise ValueError("the rate is 16000 or 32000")
        self.rate = rate
        self.n_fft, self.hop, self.low, self.high = layouts[rate]
        self.scale = np.ones(64) if scale is None else scale
        self.shift = np.zeros(64) if shift is None else shift

    def frames(self, samples: int) -> int:
        return samples // self.hop + 1

    def features(self, x):
        p = dsp.power_spectrum(x.astype(np.float64), self.n_fft, self.hop) @ dsp.mel_bank(self.rate, self.n_fft, 64, self.low, self.high, "slaney", True).T
        db = 10 * np.log10(np.maximum(p, 1e-10))
        if db.shape[1] < 32:
            db = np.concatenate([db, np.full((len(db), 32 - db.shape[1], 64), -100.0)], 1)
        return (db * self.scale + self.shift).astype(np.float32)


class FixedFbank(FrontEnd):
    """Kaldi energies on a canvas of 1024 frames; rows beyond the valid ones are zero before they are normalised."""

    LONGEST = 164_080
    MEAN, SPREAD = -4.2677393, 4.5689974

    def check(self, samples):
        if (samples > self.LONGEST).any():
            raise ValueError("longer than 10.255 seconds")

    def frames(self, samples: int) -> int:
        return 0 if samples < 400 else min((samples - 400) // 160 + 1, 1024)

    def features(self, x):
        n = self.frames(x.shape[-1])
        out = np.zeros((len(x), 1024, 128))
        if n:
            out[:, :n] = dsp.kaldi_fbank(x.astype(np.float64), 16_000, 128, dsp.hann(400, False), 512, 160)[:, :n]
        return ((out - self.MEAN) / (2 * self.SPREAD)).astype(np.float32)


class FusedLogMel(FrontEnd):
    """Four channels of 1001 log-mel frames: the whole signal shrunk to that many, and three crops; short signals are repeated."""

    rate = 48_000
    CANVAS, LONG, FRAMES = 480_000, 480_480, 1001

    def frames(self, samples: int) -> int:
        return self.FRAMES

    def _mel(self, x):
        p = dsp.power_spectrum(x.astype(np.float64), 1024, 480) @ dsp.mel_bank(48_000, 1024, 64, 50.0, 14000.0, "htk").T
        return (10 * np.log10(np.maximum(p, 1e-10))).astype(np.float32)

    def features(self, x):
        n = x.shape[-1]
        if n < self.LONG:
            if n < self.CANVAS:
                x = dsp.fit_length(np.tile(x, self.CANVAS // n), self.CANVAS)
            return np.repeat(self._mel(x)[:, None, : self.FRAMES], 4, 1)
        m = self._mel(x)
        half = (self.FRAMES - 1) // 2
        total = m.shape[1]
        starts = [min(max(dsp.half_even_ratio((2 * i + 1) * total, 6) - half, 0), total - self.FRAMES) for i in range(3)]
        return np.stack([_shrink(m, self.FRAMES), *(m[:, s : s + self.FRAMES] for s in starts)], 1)


def _shrink(m: np.ndarray, n: int) -> np.ndarray:
    """Linear interpolation along time to ``n`` frames, at the centres of the new frames."""
    at = np.clip((np.arange(n) + 0.5) * m.shape[1] / n - 0.5, 0, m.shape[1] - 1)
    lo = np.floor(at).astype(int)
    hi = np.minimum(lo + 1, m.shape[1] - 1)
    w = (at - lo).astype(np.float32)[None, :, None]
    return m[:, lo] * (1 - w) + m[:, hi] * w


def standardise(x: np.ndarray) -> np.ndarray:
    """Rows with mean 0 and variance 1, but for what 1e-7 adds to it."""
    return (x - x.mean(-1, keepdims=True)) / np.sqrt(x.var(-1, keepdims=True) + 1e-7)


def decibels(power: np.ndarray, depth: float) -> np.ndarray:
    """Powers in dB (1e-10 at least), none more than ``depth`` below its row's peak."""
    db = 10 * np.log10(np.maximum(power, 1e-10))
    return np.maximum(db, db.max(tuple(range(1, db.ndim)), keepdims=True) - depth)


class Waveform(FrontEnd):
    """The samples themselves, standardised over the valid prefix if wanted."""

    def __init__(self, standardise: bool = True):
        self.standardise = standardise

    def check(self, samples):
        if (samples < 400).any():
            raise ValueError("shorter than 400 samples")

    def frames(self, samples: int) -> int:
        return samples

    def features(self, x):
        return (standardise(x.astype(np.float64)) if self.standardise else x).astype(np.float32)


class FlooredMel(FrontEnd):
    """Mel energies in dB, floored 80 dB below the row's own peak, scaled to -1..1 between fixed bounds."""

    LOW, HIGH = -79.6482, 50.6842

    def frames(self, samples: int) -> int:
        return max(samples, 513) // 160 + 1

    def features(self, x):
        x = dsp.fit_length(x, max(513, x.shape[-1])).astype(np.float64)
        db = decibels(dsp.power_spectrum(x, 1024, 160) @ dsp.mel_bank(16_000, 1024, 64, 60.0, 7800.0, "htk").T, 80.0)
        return ((db - self.LOW) / (self.HIGH - self.LOW) * 2 - 1).astype(np.float32)


class PoveyFbank(FrontEnd):
    """Kaldi energies of the waveform in 16-bit scale under the povey window, normalised by fixed numbers."""

    MEAN, SPREAD = 15.41663, 6.55582

    def frames(self, samples: int) -> int:
        return (max(samples, 2800) - 400) // 160 + 1

    def features(self, x):
        x = dsp.fit_length(x, max(2800, x.shape[-1])).astype(np.float64) * 2**15
        f = dsp.kaldi_fbank(x, 16_000, 128, dsp.hann(400, False) ** 0.85, 512, 160)
        return ((f - self.MEAN) / (2 * self.SPREAD)).astype(np.float32)
