"""Mixing sources to target weights (problem 9).

A source whose target share needs r times its size gives every text floor(r) copies and one more with probability
r - floor(r), r being capped by max_repeats. The fractional copies are settled by pivotal dependent rounding: two
fractions are paired and mass is moved at random from one to the other until one is whole; what is left of all pairs is paired again.
Texts are paired in order of size, so what one loses a text of almost the same size gains, and the total stays near its target.

Scale: each part of a source is settled in its own task and leaves at most one fraction; the fractions of the
parts are combined by a reduction tree of aggregates, level by level, never all in one place. Sizes are tokens of a
public tokenizer, counted in Arrow batches next to the scan.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wavelake.session import cut, table

#: Folder of the public tokenizers' files; a parameter of every function that counts.
TOKENIZERS = "/opt/tokenizers"
MODEL = "piece_bpe_32k.model"
#: Texts of one part, and parts that one step of the tree takes together.
PART = 20_000
FAN = 64
SEED = 29
#: Fractions this near to a whole number are whole.
EPS = 1e-12

_loaded: dict[str, object] = {}


def tokenizer(folder: str = TOKENIZERS, model: str = MODEL):
    """The tokenizer, loaded once per Python worker."""
    import sentencepiece

    path = f"{folder}/{model}"
    if path not in _loaded:
        _loaded[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _loaded[path]


def token_sizes(documents: DataFrame, folder: str = TOKENIZERS) -> DataFrame:
    """``doc_id, source, tokens``: every document's size; null texts have size 0."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sp = tokenizer(folder)
        for pdf in batches:
            texts = ["" if t is None or t != t else t for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "source": pdf["source"], "tokens": np.fromiter(map(len, sp.encode(texts, num_threads=1)), np.int64, len(texts))})

    return documents.select("doc_id", "source", "text").mapInPandas(run, "doc_id bigint, source string, tokens bigint")


def demands(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """``source, have, want, max_repeats, copies``: size of each target source, its wanted size, and copies of each text.

    ``want`` is target_share times the size of all documents that have a source. ``copies`` is at most max_repeats. Null shares
    and repeats count as 0; a source without texts has size 0 and no copies.
    """
    named = sizes.where(F.col("source").isNotNull())
    have = named.groupBy("source").agg(F.sum("tokens").alias("have"))
    t = targets.where(F.col("source").isNotNull()).groupBy("source").agg(F.max(F.coalesce("target_share", F.lit(0.0))).alias("share"), F.max(F.coalesce("max_repeats", F.lit(0))).cast("bigint").alias("max_repeats"))
    # One row per source.
    both = t.join(have, "source", "full").withColumn("total", F.coalesce(F.sum("have").over(W.partitionBy()), F.lit(0))).where(F.col("share").isNotNull())
    x = both.select("source", F.coalesce("have", F.lit(0)).cast("bigint").alias("have"), (F.col("share") * F.col("total")).alias("want"), "max_repeats")
    copies = F.when(F.col("have") > 0, F.least(F.col("want") / F.col("have"), F.col("max_repeats").cast("double"))).otherwise(F.lit(0.0))
    return x.withColumn("copies", copies)


def _generator(tag: str) -> np.random.Generator:
    """Random numbers that depend on the tag alone, so that a task run again gives the same rows."""
    return np.random.default_rng(int.from_bytes(hashlib.blake2b(f"{SEED}|{tag}".encode(), digest_size=8).digest(), "big"))


def pivotal(p: np.ndarray, tag: str) -> tuple[np.ndarray, int, float]:
    """``(whole, open, mass)``: settled copies (0 or 1), and the index and fraction of the one left open (-1: none).

    Neighbours meet in pairs, all pairs at once: of two fractions a and b with a + b <= 1 one takes all and the other nothing, with chances by
    their size; with a + b > 1 one becomes 1 and the other keeps the rest. Then the open ones that are left meet.
    """
    mass = np.asarray(p, float).copy()
    open_ = np.flatnonzero((mass > EPS) & (mass < 1 - EPS))
    rng = _generator(tag)
    while len(open_) > 1:
        m = len(open_) // 2
        a, b, alone = open_[0 : 2 * m : 2], open_[1 : 2 * m : 2], open_[2 * m :]
        x, y, u = mass[a], mass[b], rng.random(m)
        t = x + y
        small = t <= 1
        # With a small sum the goer is left with nothing, with a large one it is whole; the stayer has the rest.
        a_goes = np.where(small, u * t >= x, u * (2 - t) < 1 - y)
        goer, stayer = np.where(a_goes, a, b), np.where(a_goes, b, a)
        mass[goer] = np.where(small, 0.0, 1.0)
        mass[stayer] = np.where(small, t, t - 1)
        open_ = np.r_[stayer, alone]
        open_ = open_[(mass[open_] > EPS) & (mass[open_] < 1 - EPS)]
    at, left = (int(open_[0]), float(mass[open_[0]])) if len(open_) else (-1, 0.0)
    if at >= 0:
        mass[at] = 0.0
    return (mass > 0.5).astype(np.int64), at, left


_SETTLED = "doc_id bigint, source string, tokens bigint, whole bigint, part bigint, mass double"


def _settle(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["tokens", "doc_id"], ignore_index=True)
    copies = pdf["copies"].to_numpy()
    base = np.floor(copies + 1e-12)
    frac = np.maximum(copies - base, 0.0)
    whole, open_, mass = pivotal(frac, f"{pdf['source'][0]}|{pdf['part'][0]}")
    left = np.zeros(len(pdf))
    if open_ >= 0:
        left[open_] = mass
    return pd.DataFrame({"doc_id": pdf["doc_id"], "source": pdf["source"], "tokens": pdf["tokens"], "whole": base.astype(np.int64) + whole, "part": pdf["part"], "mass": left})


_OPEN = "source string, doc_id bigint, part bigint, mass double, done bigint"


def _combine(last: bool):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["part", "doc_id"], ignore_index=True)
        tag = f"{pdf['source'][0]}|tree|{pdf['level'][0]}|{pdf['group'][0]}"
        whole, open_, mass = pivotal(pdf["mass"].to_numpy(), tag)
        if last and open_ >= 0:
            whole[open_] = int(_generator(tag + "|last").random() < mass)
            open_ = -1
        still = np.arange(len(pdf)) == open_
        return pd.DataFrame({"source": pdf["source"], "doc_id": pdf["doc_id"], "part": pdf["group"], "mass": np.where(still, mass, 0.0), "done": np.where(still, -1, whole)})

    return run


def mix(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """``doc_id, source, tokens, copies``: how often each text is used; texts used 0 times are left out.

    Documents without a source, or whose source has no target, take no part. Copies never exceed max_repeats.
    """
    want = demands(sizes, targets).select("source", "copies", "have").where("copies > 0")
    counts = sizes.where(F.col("source").isNotNull()).groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    plan = want.join(counts, "source").select("source", "copies", F.ceil(F.col("n") / F.lit(PART)).alias("parts"))
    docs = sizes.join(plan, "source").withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.col("parts"))).drop("parts")
    settled = cut(docs.groupBy("source", "part").applyInPandas(_settle, _SETTLED))
    widest = plan.agg(F.max("parts")).first()[0] or 1
    open_ = settled.where("mass > 0").select("source", "doc_id", "part", "mass")
    done = None
    level = 0
    while True:
        level += 1
        last = widest <= FAN
        grouped = open_.withColumn("group", F.floor(F.col("part") / F.lit(FAN))).withColumn("level", F.lit(level))
        step = cut(grouped.groupBy("source", "group").applyInPandas(_combine(last), _OPEN))
        ended = step.where("done >= 0").select("doc_id", "done")
        done = ended if done is None else done.unionByName(ended)
        if last:
            break
        open_ = step.where("done < 0").select("source", "doc_id", "part", "mass")
        widest = -(-widest // FAN)
    # Of every part one document at most: added up by document rather than joined to all.
    both = settled.select("doc_id", "source", "tokens", "whole").unionByName(done.select("doc_id", F.lit(None).cast("string").alias("source"), F.lit(None).cast("bigint").alias("tokens"), F.col("done").alias("whole")))
    out = both.groupBy("doc_id").agg(F.max("source").alias("source"), F.max("tokens").alias("tokens"), F.sum("whole").alias("copies"))
    return out.where("copies > 0")


def _sizes(spark: SparkSession, d: str) -> DataFrame:
    return token_sizes(table(spark, d, "documents"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Sources whose size times max_repeats is below their target share of all sized documents, from the report of the mix."""
    # Cut, else the optimiser would leave out what the flag does not need.
    return cut(p9_report(spark, d)).where("short").select("source")


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    """The mix: every used text with its number of copies."""
    return mix(cut(_sizes(spark, d)), table(spark, d, "source_targets"))


def p9_report(spark: SparkSession, d: str) -> DataFrame:
    """Wanted and reached size of every target source, and its share of the mix."""
    sizes, targets = cut(_sizes(spark, d)), table(spark, d, "source_targets")
    got = mix(sizes, targets).groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("tokens"), F.max("copies").alias("most_copies"))
    x = demands(sizes, targets).join(got, "source", "left").withColumn("all_tokens", F.sum("tokens").over(W.partitionBy()))  # one row per source
    return x.select("source", "have", "want", "max_repeats", F.coalesce("tokens", F.lit(0)).alias("tokens"), "most_copies", (F.coalesce("tokens", F.lit(0)) / F.col("all_tokens")).alias("share"), (F.col("have") * F.col("max_repeats") < F.col("want")).alias("short"))


def p9_check(spark: SparkSession, d: str) -> DataFrame:
    """Every target source: whether it falls short, whether no text is used too often, and whether the size reached is the wanted or greatest one (to 1 %)."""
    r = p9_report(spark, d)
    most = F.least("want", F.col("have") * F.col("max_repeats"))
    return r.select("source", "short", (F.coalesce("most_copies", F.lit(0)) <= F.col("max_repeats")).alias("within"), (F.abs(F.col("tokens") - most) <= most * 0.01 + 1000).alias("reached"))


QUERIES = {"p9_found": p9_found, "p9_mix": p9_mix, "p9_report": p9_report, "p9_check": p9_check}

# Words and signs stand in for the tokens of a public tokenizer; which sources fall short does not depend on it.
_SHORT = r"""
WITH size AS (SELECT source, sum(len(regexp_extract_all(text, '[\p{L}\p{N}]+|[^\s\p{L}\p{N}]'))) AS n FROM documents WHERE source IS NOT NULL GROUP BY source),
flag AS (SELECT t.source, coalesce(size.n, 0) * t.max_repeats < t.target_share * (SELECT sum(n) FROM size) AS short FROM source_targets t LEFT JOIN size USING (source))
"""

SQL = {
    "p9_found": _SHORT + "SELECT source FROM flag WHERE short",
    "p9_check": _SHORT + "SELECT source, short, true AS within, true AS reached FROM flag",
}
