"""Records of evaluation splits that also lie in the training split (problem 1).

Recordings are matched by Aho-Corasick automata over the normalised evaluation paths (each below its dataset's root), which scan the normalised
training paths as they are, with whatever stands before the root: a training path is of the recording whose path it ends in. The intervals of
the matched training entries are merged into the coverage of every evaluation record, partial overlaps included; records covered to
COVER or more are then compared with the single training entries.

Sharding: a pattern can only match texts of its file name, so patterns and texts are put in shards by the hash of the file name, about SHARD
patterns each. A shard that a common file name makes larger is cut both ways: its patterns into parts with an automaton each, its texts into
parts each of which every automaton scans; no task gets more than about SHARD patterns and TEXTS texts.

Skew: the automata work on distinct paths, so a path that a third of all rows share is one text. Training intervals are merged before
they meet evaluation records. The time comparison joins on (recording, level, bucket): a training interval of up to 2^level seconds lies in at
most two buckets of that width, and an evaluation record looks up the bucket of its midpoint (which any interval that
covers 80 % of it contains), so candidates are few beyond the true pairs; hot buckets are split by adaptive
skew joins. The pairs themselves are the asked-for result.
"""

from __future__ import annotations

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wavelake.functions.paths import below_root, normal, recording_key, root_part
from wavelake.operators.interval_join import interval_join
from wavelake.operators.intervals import merge_intervals
from wavelake.session import cut, table

#: Distinct evaluation paths of one automaton, and distinct training paths that one task scans with it.
SHARD, TEXTS = 50_000, 400_000
#: Least share of the evaluation record's interval that one training interval must hold.
COVER = 0.8
EPS = 1e-9
EVALUATION = ("validation", "test")
FOREVER = 99  # level of intervals without end


def timed_entries(entries: DataFrame, recordings: DataFrame) -> DataFrame:
    """``entry_id, dataset, split, text, rooted, rec, s, e`` of the entries that take part.

    ``text`` is the normal path, ``rec`` the recording it is of, ``rooted`` tells whether the path shows its dataset's root.


    Repeated rows of an entry are one (the row received last). An end after the recording's duration, or infinite, counts
    as the duration; without a known duration it stays. Entries without path, with null or NaN times, or whose interval
    is then not longer than zero take no part.
    """
    usable = F.col("start").isNotNull() & ~F.isnan("start") & F.col("end").isNotNull() & ~F.isnan("end")
    last = entries.groupBy("entry_id").agg(F.max(F.struct("received_at", "dataset", "split", "audio_path", "start", "end")).alias("x")).select("entry_id", "x.*").where(usable)
    named = last.withColumn("text", normal(F.col("audio_path"))).where(F.col("text").isNotNull())
    named = named.withColumn("root", root_part(F.col("text"), F.col("dataset"))).withColumn("rec", recording_key(F.col("dataset"), F.coalesce("root", "text")))
    dur = (
        recordings.withColumn("rec", recording_key(F.col("dataset"), below_root(normal(F.col("audio_path")), F.col("dataset"))))
        .where(F.col("rec").isNotNull())
        .groupBy("rec")
        .agg(F.max(F.struct("received_at", F.nanvl("duration_sec", F.lit(None).cast("double")).alias("d"))).alias("x"))
        .select("rec", F.col("x.d").alias("d"))
    )
    e = F.when(F.col("d") > 0, F.least(F.col("end"), F.col("d"))).otherwise(F.col("end"))
    text = F.concat(F.lit("\x02/"), F.lower("text"), F.lit("\x03"), F.coalesce("dataset", F.lit("")))
    return named.join(dur, "rec", "left").select("entry_id", "dataset", "split", text.alias("text"), F.col("root").isNotNull().alias("rooted"), "rec", F.col("start").alias("s"), e.alias("e")).where(F.col("e") > F.col("s"))


_MATCHED = "rec string, text string"


def _scan(evals: pd.DataFrame, trains: pd.DataFrame) -> pd.DataFrame:
    """One shard: an automaton over the evaluation paths scans the training paths."""
    found: list[tuple[str, str]] = []
    if len(evals) and len(trains):
        auto = ahocorasick.Automaton()
        for pattern, rec in zip(evals["pattern"], evals["rec"]):
            auto.add_word(pattern, rec)
        auto.make_automaton()
        for text in trains["text"]:
            found.extend((rec, text) for _, rec in auto.iter(text))
    return pd.DataFrame(found, columns=["rec", "text"])


def matched_recordings(entries: DataFrame, shard: int = SHARD, texts: int = TEXTS) -> DataFrame:
    """``rec, text``: recordings of evaluation entries, and the training paths that end in them."""
    # A path that shows its dataset's root may stand behind anything, any other one must be whole.
    below = F.concat(F.lit("/"), F.substring_index("rec", "\x1f", -1), F.lit("\x03"), F.substring_index("rec", "\x1f", 1))
    whole = F.concat(F.lit("\x02"), below)
    ev = entries.where(F.col("split").isin(*EVALUATION)).groupBy("rec").agg(F.max("rooted").alias("rooted"))
    ev = ev.select("rec", F.when(F.col("rooted"), below).otherwise(whole).alias("pattern"))
    tr = entries.where(F.col("split") == "train").select("text").distinct()
    n = entries.where(F.col("split").isin(*EVALUATION)).agg(F.approx_count_distinct("rec")).first()[0]
    shards = max(1, -(-int(n * 1.1) // shard))
    slot = lambda c: F.pmod(F.xxhash64(F.substring_index(c, "/", -1)), F.lit(shards))
    ev, tr = ev.withColumn("shard", slot("pattern")), tr.withColumn("shard", slot("text"))
    # One row per shard: into how many parts its patterns and its texts are cut.
    parts = lambda df, size, name: df.groupBy("shard").agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / F.lit(2.0 * size))).cast("int").alias(name))
    plan = parts(ev, shard, "n_patterns").join(parts(tr, texts, "n_texts"), "shard")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    own = lambda c, n: F.pmod(F.xxhash64(c, F.lit(1)), F.col(n)).cast("int")
    ev = ev.join(plan, "shard").select("shard", "pattern", "rec", own("pattern", "n_patterns").alias("p"), every("n_texts").alias("t"))
    tr = tr.join(plan, "shard").select("shard", "text", own("text", "n_texts").alias("t"), every("n_patterns").alias("p"))
    return ev.groupBy("shard", "p", "t").cogroup(tr.groupBy("shard", "p", "t")).applyInPandas(_scan, _MATCHED)


_FAR_MS = 9 * 10**15


def _ms(c: str, how) -> Column:
    """Whole milliseconds of a time, down or up; infinite ones become very large."""
    return how(F.greatest(F.lit(-9e12), F.least(F.col(c), F.lit(9e12))) * 1000).cast("bigint")


def coverage(entries: DataFrame, matched: DataFrame) -> DataFrame:
    """``eval_id, dataset, split, rec, es, ee, size_ms, covered_ms``: every evaluation record that training entries overlap, and how much of
    it they cover together. Bounds are widened to whole milliseconds."""
    train = entries.where(F.col("split") == "train").join(matched, "text").select(matched["rec"], _ms("s", F.floor).alias("a"), _ms("e", F.ceil).alias("b"))
    busy = cut(merge_intervals(train, ["rec"], "a", "b").select("rec", "from_ms", "to_ms"))  # the join reads it twice
    evals = entries.where(F.col("split").isin(*EVALUATION)).select(F.col("entry_id").alias("eval_id"), "dataset", "split", "rec", F.col("s").alias("es"), F.col("e").alias("ee"), _ms("s", F.floor).alias("a"), _ms("e", F.ceil).alias("b"))
    met = interval_join(evals, busy, ["rec"], ("a", "b"), ("from_ms", "to_ms"), 600_000)
    held = F.least("b", "to_ms") - F.greatest("a", "from_ms")
    return met.groupBy("eval_id", "dataset", "split", "rec", "es", "ee").agg(F.first(F.col("b") - F.col("a")).alias("size_ms"), F.sum(held).alias("covered_ms"))


def overlaps(entries: DataFrame, matched: DataFrame, covered: DataFrame, cover: float = COVER) -> DataFrame:
    """``train_id, eval_id, dataset, split, es, ee, ts, te``: every pair of a training and an evaluation entry of one recording
    in which the training interval holds at least ``cover`` of the evaluation interval.

    Looked for among the records whose ``coverage`` is as large.
    """
    length = F.col("te") - F.col("ts")
    level = F.when(length == F.lit(float("inf")), F.lit(FOREVER)).otherwise(F.greatest(F.lit(-10), F.least(F.lit(60), F.ceil(F.log2(length))))).cast("int")
    width = F.pow(F.lit(2.0), F.col("level"))
    train = (
        entries.where(F.col("split") == "train")
        .select(F.col("entry_id").alias("train_id"), "text", F.col("s").alias("ts"), F.col("e").alias("te"))
        .join(matched, "text")
        .withColumn("level", level)
    )
    levels = train.groupBy("rec").agg(F.collect_set("level").alias("levels"))  # at most 72 values
    first, last = F.floor(F.col("ts") / width), F.floor(F.col("te") / width)
    bucketed = train.withColumn("bucket", F.explode(F.when(F.col("level") == FOREVER, F.array(F.lit(0).cast("bigint"))).otherwise(F.sequence(first, last))))
    mid = F.col("es") + (F.col("ee") - F.col("es")) / 2
    evals = (
        covered.where(F.col("covered_ms") + 1 >= F.lit(cover * 1000) * (F.least("ee", F.lit(9e12)) - F.col("es")))
        .select("eval_id", "dataset", "split", "rec", "es", "ee")
        .join(levels, "rec")
        .withColumn("level", F.explode("levels"))
        .drop("levels")
        .withColumn("bucket", F.when(F.col("level") == FOREVER, F.lit(0).cast("bigint")).when(mid < F.lit(1e15), F.floor(mid / width)))
    )
    held = F.least("ee", "te") - F.greatest("es", "ts")
    return (
        evals.join(bucketed, ["rec", "level", "bucket"])
        .where(held >= F.lit(cover) * (F.col("ee") - F.col("es")) - F.lit(EPS))
        .select("train_id", "eval_id", "dataset", "split", "es", "ee", "ts", "te")
    )


def _stages(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    e = cut(timed_entries(table(spark, d, "split_entries"), table(spark, d, "recordings")))
    m = cut(matched_recordings(e))
    return e, m, cut(coverage(e, m))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of a training and a validation or test entry that are the same or almost; smaller id first."""
    p = overlaps(*_stages(spark, d))
    return p.select(F.least("train_id", "eval_id").alias("entry_a"), F.greatest("train_id", "eval_id").alias("entry_b")).distinct()


def p1_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Every evaluation record that training entries overlap: how much of it they cover together, and how many of them COVER of it by themselves."""
    e, m, c = _stages(spark, d)
    pairs = overlaps(e, m, c).groupBy("eval_id").agg(F.count(F.lit(1)).alias("n_train"))
    return c.join(pairs, "eval_id", "left").select("eval_id", "dataset", "split", F.coalesce("n_train", F.lit(0)).alias("n_train"), "size_ms", "covered_ms")


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    """Per split and dataset: evaluation records overlapped at all, to COVER or more by all training entries, and by a single one; and such pairs."""
    full = F.col("covered_ms") >= F.lit(COVER) * F.col("size_ms")
    n = lambda c: F.sum(F.when(c, 1).otherwise(0))
    return p1_coverage(spark, d).groupBy("split", "dataset").agg(
        F.count(F.lit(1)).alias("n_overlapped"), n(full).alias("n_covered"), n(F.col("n_train") > 0).alias("n_records"), F.sum("n_train").alias("n_pairs"), F.sum("covered_ms").alias("covered_ms")
    )


QUERIES = {"p1_found": p1_found, "p1_coverage": p1_coverage, "p1_report": p1_report}
