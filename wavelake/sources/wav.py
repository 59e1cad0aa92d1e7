"""Wave files: header probe, slice decode, and the Spark operators over them."""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator
from contextlib import nullcontext
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema

from wavelake.functions import dsp


@dataclass(frozen=True)
class Header:
    rate: int
    channels: int
    bits: int
    is_float: bool
    begin: int  # of the samples in the file
    frames: int

    @property
    def duration(self) -> float:
        return self.frames / self.rate


def open_binary(path: str):
    """A file to read: a local one, or by its URI one of a file system that pyarrow knows (s3, gs, hdfs, ...)."""
    if "://" not in path:
        return open(path, "rb")
    from pyarrow import fs

    where, name = fs.FileSystem.from_uri(path)
    return where.open_input_file(name)


class Recording:
    """An open RIFF/WAVE file with its header; segments are read by seeking."""

    def __init__(self, path: str):
        self.path, self.file = path, open_binary(path)
        try:
            self.header = self._probe()
        except BaseException:
            self.file.close()
            raise

    def __enter__(self) -> Recording:
        return self

    def __exit__(self, *_) -> None:
        self.file.close()

    def _probe(self) -> Header:
        f, path = self.file, self.path
        f.seek(0, 2)
        size = f.tell()
        f.seek(0)
        head = f.read(12)
        if len(head) < 12 or head[:4] not in (b"RIFF", b"RF64") or head[8:] != b"WAVE":
            raise ValueError(f"{path} is no wave file")
        fmt = None
        while len(h := f.read(8)) == 8:
            name, n = h[:4], struct.unpack("<I", h[4:])[0]
            if name == b"fmt ":
                raw = f.read(n + (n & 1))
                tag, channels, rate, _, block, bits = struct.unpack("<HHIIHH", raw[:16])
                if tag == 0xFFFE and len(raw) >= 26:
                    tag = struct.unpack("<H", raw[24:26])[0]
                if tag not in (1, 3) or (tag == 1 and bits not in (8, 16, 24, 32)) or (tag == 3 and bits not in (32, 64)):
                    raise ValueError(f"{path}: unknown sample format {tag}/{bits}")
                fmt = (rate, channels, bits, tag == 3, block)
            elif name == b"data":
                if fmt is None:
                    raise ValueError(f"{path}: samples before their format")
                begin = f.tell()
                rate, channels, bits, is_float, block = fmt
                # A size that was never filled in ends with the file.
                return Header(rate, channels, bits, is_float, begin, min(n, size - begin) // block)
            else:
                f.seek(n + (n & 1), 1)
        raise ValueError(f"{path}: no samples")

    def frames(self, first: int = 0, count: int | None = None) -> np.ndarray:
        """``channels x frames`` as floats; whole numbers are scaled to -1..1."""
        h = self.header
        first = min(max(first, 0), h.frames)
        count = h.frames - first if count is None else max(0, min(count, h.frames - first))
        width = h.bits // 8
        self.file.seek(h.begin + first * width * h.channels)
        raw = self.file.read(count * width * h.channels)
        if h.is_float:
            x = np.frombuffer(raw, f"<f{width}").astype(np.float32)
        elif width == 1:
            x = (np.frombuffer(raw, np.uint8).astype(np.float32) - 128) / 128
        elif width == 3:
            b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
            x = ((b[:, 0] | b[:, 1] << 8 | b[:, 2] << 16) << 8 >> 8).astype(np.float32) / 2**23
        else:
            x = np.frombuffer(raw, f"<i{width}").astype(np.float32) / 2 ** (h.bits - 1)
        return x.reshape(-1, h.channels).T


def probe(path: str) -> Header:
    """Rate, layout and length of a RIFF/WAVE file; only its chunk heads are read."""
    with Recording(path) as r:
        return r.header


def read_frames(path: str, first: int = 0, count: int | None = None) -> np.ndarray:
    """``channels x frames`` of a file as floats; whole numbers are scaled to -1..1."""
    with Recording(path) as r:
        return r.frames(first, count)


def write_wav(path: str, x: np.ndarray, rate: int) -> None:
    """Writes ``channels x frames`` (or frames) as 32-bit float samples."""
    x = np.atleast_2d(np.asarray(x, "<f4"))
    raw = np.ascontiguousarray(x.T).tobytes()
    fmt = struct.pack("<HHIIHH", 3, len(x), rate, rate * 4 * len(x), 4 * len(x), 32)
    with open(path, "wb") as f:
        f.write(b"RIFF" + struct.pack("<I", 4 + 8 + len(fmt) + 8 + len(raw)) + b"WAVE" + b"fmt " + struct.pack("<I", len(fmt)) + fmt + b"data" + struct.pack("<I", len(raw)) + raw)


def load_segment(path: str, offset: float, duration: float, rate: int, mono: bool, samples: int, held: Recording | None = None) -> np.ndarray:
    """A slice of a recording at ``rate``: ``samples`` floats, or channels x samples where not mono; zeros behind its end.

    ``file::dataset`` names a signal inside an HDF5 file (whole numbers are not scaled there, and bounds are rounded); in a file
    bounds are cut to whole samples. ``held`` is the recording at ``path`` where it is open already.
    """
    if "::" in path:
        from wavelake.sources.annotations import need_h5py

        name, member = path.split("::", 1)
        with need_h5py().File(name, "r") as h:
            src = int(h["sample_rate"][()])
            a = round(offset * src)
            x = np.atleast_2d(np.asarray(h[member][a : a + round(duration * src)], np.float32))
    else:
        with nullcontext(held) if held else Recording(path) as r:
            src = r.header.rate
            x = r.frames(int(offset * src), int(duration * src))
        if mono and len(x) > 1:
            x = x.mean(0, keepdims=True)
    x = dsp.fit_length(dsp.resample(x, src, rate), samples)
    return x[0] if mono else x


def probe_duration(path: str) -> float:
    """Seconds of a recording, from its head alone."""
    if "::" in path:
        from wavelake.sources.annotations import need_h5py

        name, member = path.split("::", 1)
        with need_h5py().File(name, "r") as h:
            return len(h[member]) / float(h["sample_rate"][()])
    return probe(path).duration


def durations(paths: DataFrame, root: str) -> DataFrame:
    """``audio_path, duration`` of every recording, probed in the tasks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"audio_path": pdf["audio_path"], "duration": [probe_duration(os.path.join(root, p)) for p in pdf["audio_path"]]})

    return paths.select("audio_path").distinct().mapInPandas(run, "audio_path string, duration double")


def list_array(x: np.ndarray) -> pa.Array:
    """A numpy array as (nested) Arrow lists, one per row; NaN stays NaN."""
    out = pa.array(np.ascontiguousarray(x).reshape(-1))
    for axis in range(x.ndim - 1, 0, -1):
        n = int(np.prod(x.shape[:axis]))
        out = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * x.shape[axis]), out)
    return out


def decode(segments: DataFrame, root: str, rate: int, mono: bool, samples: int, schema) -> DataFrame:
    """Adds ``raw`` to segments (audio_path, start, valid_sec): each slice is read by itself; a file is opened once for its neighbouring slices.

    The other columns pass through as they are. ``schema`` gives the order of the columns.
    """
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Recording | None = None
        for b in batches:
            if not b.num_rows:
                continue
            x = []
            for p, a, v in zip(*(b.column(c).to_pylist() for c in ("audio_path", "start", "valid_sec"))):
                path = os.path.join(root, p)
                if "::" not in path and (held is None or held.path != path):
                    if held:
                        held.file.close()
                    held = Recording(path)
                x.append(load_segment(path, a, v, rate, mono, samples, None if "::" in path else held).astype(np.float32))
            if len({y.shape for y in x}) == 1:
                raw = list_array(np.stack(x))
            else:  # recordings of one batch with different numbers of channels
                raw = pa.array([y.tolist() for y in x], arrow.field("raw").type)
            yield pa.RecordBatch.from_arrays([(raw if f.name == "raw" else b.column(f.name)).cast(f.type) for f in arrow], schema=arrow)
        if held:
            held.file.close()

    return segments.sortWithinPartitions("audio_path", "start").mapInArrow(run, schema)


def raw_type(mono: bool) -> str:
    return "array<float>" if mono else "array<array<float>>"


