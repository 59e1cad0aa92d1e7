"""Frame grids, frame-count laws and rounding rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clip_geometry(valid_sec: Column) -> Column:
    """The whole clip as one frame."""
    return F.array(F.lit(0.0).cast("float"), valid_sec.cast("float"))


def frame_geometry(frames: int, step: float, valid_frames: Column, valid_sec: Column) -> Column:
    """Array of ``start, end`` (floats) of ``frames`` frames.

    Frame t covers [t * step, (t + 1) * step), cut at the valid length; the last valid frame ends at the valid length whatever its
    own; frames beyond are (0, 0). All in single precision.
    """
    v = valid_sec.cast("float")
    edge = lambda t: t.cast("float") * F.lit(step).cast("float")
    zero = F.lit(0.0).cast("float")

    def one(t: Column) -> Column:
        ok = t < valid_frames
        end = F.when(t == valid_frames - 1, v).otherwise(F.least(edge(t + 1), v))
        return F.struct(F.when(ok, edge(t)).otherwise(zero).alias("start"), F.when(ok, end).otherwise(zero).alias("end"))

    return F.transform(F.sequence(F.lit(0), F.lit(frames - 1)), one)


def valid_mask(frames: int, valid_frames: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(frames - 1)), lambda t: t < valid_frames)


def samples(valid_sec: Column, rate: int) -> Column:
    """Valid samples: seconds times rate in single precision, halves to even."""
    return F.rint((valid_sec.cast("float") * F.lit(float(rate)).cast("float")).cast("double")).cast("bigint")


def ratio_half_even(a: Column, b: Column) -> Column:
    """a / b of whole numbers, rounded with halves to even, exactly."""
    a, b = a.cast("bigint"), b.cast("bigint")
    q = ((a - F.pmod(a, b)) / b).cast("bigint")
    r2 = F.pmod(a, b) * 2
    up = (r2 > b) | ((r2 == b) & (F.pmod(q, F.lit(2)) == 1))
    return F.when(up, q + 1).otherwise(q)


def crop_starts(frames: Column, window: int = 1001) -> list[Column]:
    """Begins of three crops of ``window`` frames centred at 1/6, 1/2 and 5/6 of all frames, moved inside where they stand out."""
    frames = frames.cast("bigint")
    half = (window - 1) // 2
    return [F.least(F.greatest(ratio_half_even(F.lit(2 * i + 1) * frames, F.lit(6)) - half, F.lit(0)), frames - window) for i in range(3)]


# Frame-count laws, all from the number of samples at the front end's rate.


def panns_frames(n: Column, hop: int = 160) -> Column:
    """Mel frames; the encoder makes a thirty-second of them, at least one."""
    return (n - F.pmod(n, F.lit(hop))) / hop + 1


def panns_tokens(n: Column, hop: int = 160) -> Column:
    f = panns_frames(n, hop).cast("bigint")
    return F.greatest(F.lit(1), ((f - F.pmod(f, F.lit(32))) / 32).cast("bigint"))


def _div(a: Column, b: int) -> Column:
    """Floor division of a number that is not negative."""
    return ((a - F.pmod(a, F.lit(b))) / b).cast("bigint")


def ast_frames(n: Column) -> Column:
    return F.when(n < 400, F.lit(0)).otherwise(F.least(_div(F.greatest(n - 400, F.lit(0)), 160) + 1, F.lit(1024)))


def ast_tokens(n: Column) -> Column:
    return F.least(F.greatest(_div(n + 1599, 1600), F.lit(1)), F.lit(101))


def atst_frames(n: Column) -> Column:
    return _div(F.greatest(n, F.lit(513)), 160) + 1


def atst_tokens(n: Column) -> Column:
    return _div(atst_frames(n), 4)


def beats_frames(n: Column) -> Column:
    return _div(F.greatest(n, F.lit(2800)) - 400, 160) + 1


def beats_tokens(n: Column) -> Column:
    return _div(beats_frames(n), 16)


# Kernel and stride of the seven convolutions over the waveform.
WAVE_CONVOLUTIONS = ((10, 5), (3, 2), (3, 2), (3, 2), (3, 2), (2, 2), (2, 2))


def wave_tokens(n: Column) -> Column:
    for kernel, stride in WAVE_CONVOLUTIONS:
        n = F.greatest(_div(F.greatest(n - kernel, F.lit(-stride)) + stride, stride), F.lit(0))
    return n


def _chunks(mel_frames: Column, chunk: int, least: int) -> tuple[Column, Column]:
    """Whole chunks, and patches of the tail behind them: zero where it has fewer than ``least`` frames. Neither is above zero without frames."""
    n = mel_frames.cast("bigint")
    tail = n % chunk
    return F.call_function("div", n, F.lit(chunk)), F.when(tail >= least, F.call_function("div", tail, F.lit(4))).otherwise(0)


def chunk_patches(mel_frames: Column, chunk: int = 1000, least: int = 4) -> Column:
    """Patches of every chunk of mel frames; a tail of fewer than ``least`` frames is dropped."""
    whole, tail = _chunks(mel_frames, chunk, least)
    return F.concat(F.array_repeat(F.lit(chunk // 4), whole.cast("int")), F.array_repeat(tail.cast("int"), (tail > 0).cast("int")))


def with_chunks(df: DataFrame, mel_frames: Column, chunk: int = 1000, least: int = 4) -> DataFrame:
    """Every row once for each of its chunks: ``chunk``, ``patches`` and ``weight``, its part of the row's patches with nine digits.

    A row's chunks have only two weights, of a whole chunk and of the tail, which are worked out below the explode. They are rounded by
    arithmetic, as none is negative: ``round`` goes over decimal numbers. The expressions are kept short, since Java does not compile a
    method of over 8,000 bytes and the loop over the chunks stands in the same one.
    """
    whole, tail = _chunks(mel_frames, chunk, least)
    rows = df.select("*", whole.alias("_whole"), tail.alias("_tail")).where("_whole + _tail > 0")
    total = F.col("_whole") * (chunk // 4) + F.col("_tail")
    weight = lambda p: F.floor(p.cast("double") / total * 1e9 + 0.5) / 1e9
    rows = rows.select("*", weight(F.lit(chunk // 4)).alias("_whole_weight"), weight(F.col("_tail")).alias("_tail_weight"))
    last = F.col("_whole") - F.when(F.col("_tail") > 0, 0).otherwise(1)
    is_whole = F.col("chunk") < F.col("_whole")
    patches = F.when(is_whole, F.lit(chunk // 4).cast("bigint")).otherwise(F.col("_tail"))
    at = rows.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("chunk"))
    return at.select(*df.columns, "chunk", patches.alias("patches"), F.when(is_whole, F.col("_whole_weight")).otherwise(F.col("_tail_weight")).alias("weight"))
