"""Merging of intervals into continuous periods, with the gaps between them.

The classic plan (sort by start, compare with the running maximum of the ends before, number the
islands, aggregate) needs all intervals of one key in one task. Here it runs on three levels, so that no key, however
hot, meets in one task:

1. while scanning, the intervals of a batch of rows are merged (a union of intervals can be taken in any order), so a dense hot
   key shrinks before it is shuffled;
2. rows are windowed per key and block of time, so a long hot key is spread over its blocks;
3. per key, only one summary row per block is windowed: how far the earlier blocks reach.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wavelake.session import cut

#: Width of a time block in the unit of the intervals (an hour of milliseconds).
BLOCK_MS = 3_600_000


def whole_ms(seconds: Column) -> Column:
    """Seconds as whole milliseconds (half-even); null for null, NaN and infinite times, and for those whose sums leave the range of bigint."""
    ok = seconds.isNotNull() & ~F.isnan(seconds) & (F.abs(seconds) < F.lit(4e15))
    return F.when(ok, F.rint(seconds * F.lit(1000.0)).cast("bigint"))


#: Rows that are merged together while scanning.
BATCH = 100_000


def merge_sorted(group: np.ndarray, s: np.ndarray, e: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Islands of intervals sorted by (group, s): ``(row of the first, starts, ends, many)``.

    ``many`` tells whether an island holds two or more different intervals.
    """
    if not len(s):
        return np.zeros(0, np.int64), s, e, many
    head = np.r_[True, group[1:] != group[:-1]]
    base, span = int(s.min()), int(e.max()) - int(s.min()) + 2
    lo, hi = s, e
    if span * (int(group[-1]) + 1) >= 1 << 62:
        # Times so far apart that groups cannot be laid one above the other: their ranks keep the order and are small.
        times, ranks = np.unique(np.concatenate([s, e]), return_inverse=True)
        lo, hi, base, span = ranks[: len(s)], ranks[len(s) :], 0, len(times) + 1
    # One running maximum over all groups: each group lies above the one before.
    reach = np.maximum.accumulate(hi - base + group * span)
    new = head.copy()
    new[1:] |= lo[1:] - base + group[1:] * span > reach[:-1]
    at = np.flatnonzero(new)
    lo, hi = s[at], np.maximum.reduceat(e, at)
    differ = (np.maximum.reduceat(s, at) > lo) | (np.minimum.reduceat(e, at) < hi)
    return at, lo, hi, differ | np.logical_or.reduceat(many, at)


def _premerge(names: list[str]):
    def flush(batches: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
        t = pa.Table.from_batches(batches).combine_chunks()
        code = np.zeros(t.num_rows, np.int64)
        for n in names:
            col = t.column(n)
            col = (col.chunk(0) if col.num_chunks else pa.array([], col.type)).dictionary_encode()
            code = code * max(1, len(col.dictionary)) + col.indices.to_numpy(zero_copy_only=False)
            code = np.unique(code, return_inverse=True)[1].astype(np.int64)
        s, e = (t.column(c).to_numpy() for c in ("_s", "_e"))
        order = np.lexsort((e, s, code))
        first, lo, hi, many = merge_sorted(code[order], s[order], e[order], np.zeros(len(order), bool))
        kept = t.select(names).take(pa.array(order[first])).combine_chunks()
        cols = [kept.column(n) for n in names] + [pa.array(lo), pa.array(hi), pa.array(many)]
        return pa.Table.from_arrays(cols, names=[*names, "_s", "_e", "_many"]).combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            n += b.num_rows
            if n >= BATCH:
                yield from flush(held)
                held, n = [], 0
        if held:
            yield from flush(held)

    return run


def merge_intervals(df: DataFrame, keys: Sequence[str], start: str, end: str, block: int = BLOCK_MS) -> DataFrame:
    """Continuous periods of each key.

    ``start`` and ``end`` are whole numbers. Returns ``keys..., from_ms, to_ms, many, next_ms``: the period, whether it is
    formed by two or more different intervals, and the start of the key's next period (null for the last).

    * rows with a null time or an end not after the start are left out; equal intervals count once
    * touching, nested and overlapping intervals form one period
    * keys are strings or numbers; null keys are a group of their own; an empty table gives an empty result
    * other columns of ``df`` are ignored, whatever their names
    """
    keys = list(keys)
    # Keys are joined on: a null is replaced, and a bit mask of the nulls is a key as well. So joins are plain
    # equalities that keep the partitioning.
    types = [df.schema[k].dataType for k in keys]
    null = sum((F.col(f"`{k}`").isNull().cast("bigint") * F.lit(2**i) for i, k in enumerate(keys)), F.lit(0).cast("bigint"))
    filled = [F.coalesce(F.col(f"`{k}`"), F.lit("" if isinstance(t, T.StringType) else 0).cast(t)) for k, t in zip(keys, types)]
    names = [f"_k{i}" for i in range(len(keys))] + ["_z"]
    place = [*names, "_b"]
    s, e = F.col("_s"), F.col("_e")
    rows = df.select(*(x.alias(n) for x, n in zip([*filled, null], names)), F.col(f"`{start}`").cast("bigint").alias("_s"), F.col(f"`{end}`").cast("bigint").alias("_e")).where(s < e)
    schema = T.StructType([*rows.schema.fields, T.StructField("_many", T.BooleanType())])
    rows = rows.mapInArrow(_premerge(names), schema).withColumn("_b", F.floor(s / F.lit(block)).cast("bigint"))
    # Islands inside each block; they are read several times.
    seq = W.partitionBy(*place).orderBy("_s", "_e")
    before, upto = seq.rowsBetween(W.unboundedPreceding, -1), seq.rowsBetween(W.unboundedPreceding, 0)
    local = cut(
        rows.withColumn("_m", F.max("_e").over(before))
        .withColumn("_i", F.sum(F.when(F.col("_m") >= s, 0).otherwise(1)).over(upto))
        .groupBy(*place, "_i")
        .agg(F.min("_s").alias("_lo"), F.max("_e").alias("_hi"), (F.max("_many") | (F.min("_s") < F.max("_s")) | (F.min("_e") < F.max("_e"))).alias("_many"))
        .select(*place, F.col("_lo").alias("_s"), F.col("_hi").alias("_e"), "_many")
    )
    # How far earlier blocks of the key reach into each block. An island that begins beyond begins a period.
    blocks = W.partitionBy(*names).orderBy("_b")
    earlier, later = blocks.rowsBetween(W.unboundedPreceding, -1), blocks.rowsBetween(1, W.unboundedFollowing)
    reach = local.groupBy(*place).agg(F.max("_e").alias("_r")).withColumn("_r", F.max("_r").over(earlier))
    begins = F.col("_r").isNull() | (s > F.col("_r"))
    known = local.join(reach, place).withColumn("_new", begins)
    # The other islands go on with the last period begun in an earlier block.
    begun = F.when(begins, s)
    marks = (
        local.select(*place, "_s")
        .join(reach, place)
        .groupBy(*place)
        .agg(F.min(begun).alias("_first"), F.max(begun).alias("_last"))
        .withColumn("_owner", F.max("_last").over(earlier))
        .withColumn("_next", F.min("_first").over(later))
        .select(*place, "_owner", "_next")
    )
    lead = F.lead("_s").over(W.partitionBy(*place).orderBy("_s"))
    owned = (
        known.withColumn("_lead", lead)
        .join(marks, place)
        .select(*names, F.when(F.col("_new"), s).otherwise(F.col("_owner")).alias("_o"), "_s", "_e", "_many", F.when(F.col("_new"), F.coalesce("_lead", "_next")).alias("_next"))
    )
    many = F.max("_many") | (F.min("_s") < F.max("_s")) | (F.min("_e") < F.max("_e"))
    return (
        owned.groupBy(*names, "_o")
        .agg(F.max("_e").alias("to_ms"), many.alias("many"), F.max("_next").alias("next_ms"))
        .select(*(F.when(F.col("_z").bitwiseAND(2**i) == 0, F.col(n)).alias(k) for i, (n, k) in enumerate(zip(names, keys))), F.col("_o").alias("from_ms"), "to_ms", "many", "next_ms")
    )


def periods_and_gaps(periods: DataFrame, keys: Sequence[str], max_gap: int | None = None) -> DataFrame:
    """Long form of ``merge_intervals``: kind ``period`` (of two or more intervals) and kind ``gap``.

    A gap is the stretch to the key's next period; with ``max_gap`` only gaps no longer than that.
    """
    gap = F.col("next_ms").isNotNull()
    if max_gap is not None:
        gap &= F.col("next_ms") - F.col("to_ms") <= F.lit(max_gap)
    item = lambda kind, a, b: F.struct(F.lit(kind).alias("kind"), F.col(a).alias("from_ms"), F.col(b).alias("to_ms"))
    both = F.array_compact(F.array(F.when(F.col("many"), item("period", "from_ms", "to_ms")), F.when(gap, item("gap", "to_ms", "next_ms"))))
    return periods.select(*keys, F.explode(both).alias("_x")).select(*keys, "_x.*")
