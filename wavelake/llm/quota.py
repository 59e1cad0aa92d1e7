"""Samples that match target category shares (problem 7).

Count the categories, allocate whole quotas by largest remainder with minimum floors and availability caps, take the
rows with the smallest random keys of each category, report what cannot be met.

A row is drawn once at most, so a row with several wanted classes first goes to one of them: at random, with weights that grow with what
a class needs of what it has, and that are raised for classes which would end below their need.

The keys are hashes of the row id, so the sample is the same on every run. No category is sorted in one task: a
histogram of the leading key bits per category (at most 2^BITS counts each) gives the slice in which the quota is
reached; rows of lower slices are taken whole, and only that one slice is ranked.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wavelake.session import cut, table

#: Leading bits of the key that the histogram counts.
BITS = 16
#: Rows wanted, as a part of the labelled rows.
TENTH = 10
#: Most categories of a target table; their counts are gathered on the driver.
MAX_CATEGORIES = 100_000
#: Times that the weights of classes are raised at most, and the largest weight.
ROUNDS = 12
FIRST = 1e9


def labelled(raw: DataFrame) -> DataFrame:
    """``row_id, classes``: the rows with a label, repeated rows once (the row received last), each class of a row once.

    Rows whose label_idx is null and whose label_idxs is null or empty have no label; null classes in a list do not count.
    """
    last = raw.groupBy("row_id").agg(F.max(F.struct("received_at", "label_idx", "label_idxs")).alias("x")).select("row_id", "x.label_idx", "x.label_idxs")
    every = F.concat(F.coalesce("label_idxs", F.array().cast("array<bigint>")), F.array("label_idx"))
    return last.select("row_id", F.array_distinct(F.array_compact(every)).alias("classes")).where(F.size("classes") > 0)


def shortfalls(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """``label_idx, have, want, min_rows, n``: every class of ``targets`` with what it has and what it should give.

    ``n`` is a tenth of the labelled rows, rounded down; ``want`` = target_share * n. A null share or minimum counts as zero.
    """
    # Every row counts once more under the null class, so one aggregate gives the classes and the rows.
    every = F.concat("classes", F.array(F.lit(None).cast("bigint")))
    have = rows.select(F.explode(every).alias("label_idx")).groupBy("label_idx").agg(F.count(F.lit(1)).alias("have"))
    t = targets.where(F.col("label_idx").isNotNull()).groupBy("label_idx").agg(F.max(F.coalesce("target_share", F.lit(0.0))).alias("share"), F.max(F.coalesce("min_rows", F.lit(0))).alias("min_rows"))
    # One row per class from here on.
    both = t.join(have, "label_idx", "full")
    n = F.floor(F.coalesce(F.max(F.when(F.col("label_idx").isNull(), F.col("have"))).over(W.partitionBy()), F.lit(0)) / F.lit(TENTH)).cast("bigint")
    known = both.withColumn("n", n).where(F.col("share").isNotNull())
    return known.select("label_idx", F.coalesce("have", F.lit(0)).cast("bigint").alias("have"), (F.col("share") * F.col("n")).alias("want"), "min_rows", "n")


def quotas(classes: list[tuple[int, float, int, int]], n: int) -> dict[int, int]:
    """Whole quotas of ``(class, share, floor, available)`` that sum to ``n`` where availability allows.

    Largest remainder over the shares; a class gets at least its floor and at most what is available. What caps
    free goes to the uncapped classes by share, again by largest remainder.
    """
    fixed: dict[int, int] = {}
    open_ = {c: (share, min(floor, have), have) for c, share, floor, have in classes}
    while open_:
        left = n - sum(fixed.values())
        total = sum(s for s, _, _ in open_.values())
        ideal = {c: (left * s / total if total > 0 else 0.0) for c, (s, _, _) in open_.items()}
        capped = {c: v[2] for c, v in open_.items() if ideal[c] > v[2]}
        floored = {c: v[1] for c, v in open_.items() if ideal[c] < v[1]}
        # Fix the side whose total violation is larger, so that the rest is shared out again.
        over = sum(ideal[c] - v for c, v in capped.items())
        under = sum(v - ideal[c] for c, v in floored.items())
        bound = capped if over >= under else floored
        if not bound:
            whole = {c: min(v[2], math.floor(ideal[c] + 1e-9)) for c, v in open_.items()}
            rest = max(0, round(left - sum(whole.values())))
            order = sorted((c for c in open_ if whole[c] < open_[c][2]), key=lambda c: (-(ideal[c] - whole[c]), c))
            for c in order[:rest]:
                whole[c] += 1
            return fixed | whole
        fixed |= bound
        for c in bound:
            del open_[c]
    return fixed


def weights(patterns: DataFrame, need: dict[int, int], have: dict[int, int]) -> dict[int, float]:
    """Weight of every class, from ``classes, n``: how many rows carry which of the wanted classes.

    Rows of several classes are shared out by weight. Classes that would get fewer rows than they need gain weight, round by round.
    """
    w = {c: FIRST if need[c] >= have[c] else max(need[c], 1) / have[c] for c in need if have[c]}
    numbered = cut(patterns.withColumn("pattern", F.monotonically_increasing_id()))
    each = numbered.select("pattern", "n", F.explode("classes").alias("label_idx"))
    for _ in range(ROUNDS):
        if not w:
            break
        known = patterns.sparkSession.createDataFrame(sorted(w.items()), "label_idx bigint, w double")
        e = each.join(known, "label_idx")
        total = e.groupBy("pattern").agg(F.sum("w").alias("total"))
        got = {r[0]: r[1] for r in e.join(total, "pattern").groupBy("label_idx").agg(F.sum(F.col("n") * F.col("w") / F.col("total"))).collect()}  # one row per class
        low = [c for c in w if w[c] < FIRST and got.get(c, 0.0) < need[c] * 1.02]
        if not low:
            break
        for c in low:
            w[c] = min(FIRST / 10, w[c] * max(1.5, (need[c] / max(got.get(c, 0.0), 0.5)) ** 2))
    return w


def shared_out(rows: DataFrame, need: dict[int, int], have: dict[int, int], seed: int) -> DataFrame:
    """``row_id, label_idx``: every row that carries wanted classes, and the one of them that it may serve."""
    spark = rows.sparkSession
    wanted = spark.createDataFrame([(c,) for c in sorted(need)], "label_idx bigint")
    # Rows of one class, which are most, are not shuffled.
    single = rows.where(F.size("classes") == 1).select("row_id", F.get("classes", 0).alias("label_idx")).join(F.broadcast(wanted), "label_idx").select("row_id", "label_idx")  # at most MAX_CATEGORIES rows
    several = rows.where(F.size("classes") > 1).select("row_id", F.explode("classes").alias("label_idx")).join(F.broadcast(wanted), "label_idx")
    several = cut(several.groupBy("row_id").agg(F.array_sort(F.collect_set("label_idx")).alias("classes")))  # the classes of one row
    counted = several.groupBy("classes").agg(F.count(F.lit(1)).alias("n"))
    alone = single.groupBy(F.array("label_idx").alias("classes")).agg(F.count(F.lit(1)).alias("n"))
    w = weights(counted.unionByName(alone), need, have)
    known = spark.createDataFrame(sorted(w.items()), "label_idx bigint, w double")
    u = (F.pmod(F.xxhash64("row_id", "label_idx", F.lit(seed)), F.lit(1 << 40)) + 1) / F.lit(float((1 << 40) + 1))
    scored = several.select("row_id", F.explode("classes").alias("label_idx")).join(F.broadcast(known), "label_idx").withColumn("score", -F.log(u) / F.col("w"))
    return single.unionByName(scored.groupBy("row_id").agg(F.min_by("label_idx", F.struct("score", "label_idx")).alias("label_idx")))


def draw(rows: DataFrame, targets: DataFrame, seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """``(sample, report)``.

    ``sample`` is ``label_idx, row_id``: the rows and the class whose quota each serves; no row comes twice. ``report`` is ``label_idx, have,
    usable, want, min_rows, quota, short``: rows that carry the class, rows of it that serve no other class, the wanted number, the minimum,
    the quota (at most ``usable``), and the rows missing to the share or the minimum whatever the others get.
    """
    spark = rows.sparkSession
    state = shortfalls(rows, targets).limit(MAX_CATEGORIES + 1).collect()
    if len(state) > MAX_CATEGORIES:
        raise ValueError(f"more than {MAX_CATEGORIES} categories")
    n = state[0]["n"] if state else 0
    share = {r["label_idx"]: (r["want"] / n if n else 0.0) for r in state}
    need = {r["label_idx"]: max(math.ceil(r["want"]), r["min_rows"]) for r in state}
    served = cut(shared_out(rows, need, {r["label_idx"]: r["have"] for r in state}, seed))
    usable = dict(map(tuple, served.groupBy("label_idx").agg(F.count(F.lit(1))).collect()))  # one row per class
    # Scaled to n by the sum of the shares where they do not sum to one.
    q = quotas([(c, share[c], r["min_rows"], usable.get(c, 0)) for r in state for c in [r["label_idx"]]], n)
    plan = spark.createDataFrame([(r["label_idx"], r["have"], usable.get(r["label_idx"], 0), r["want"], r["min_rows"], q[r["label_idx"]]) for r in state], "label_idx bigint, have bigint, usable bigint, want double, min_rows bigint, quota bigint")
    keyed = served.withColumn("key", F.xxhash64("row_id", F.lit(seed))).join(F.broadcast(plan.where("quota > 0").select("label_idx", "quota")), "label_idx").withColumn("slice", F.shiftright("key", 64 - BITS))
    below = W.partitionBy("label_idx").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    hist = keyed.groupBy("label_idx", "slice", "quota").agg(F.count(F.lit(1)).alias("c")).withColumn("before", F.coalesce(F.sum("c").over(below), F.lit(0)))
    edge = hist.where((F.col("before") < F.col("quota")) & (F.col("before") + F.col("c") >= F.col("quota"))).select("label_idx", F.col("slice").alias("edge"), "before")
    near = keyed.join(F.broadcast(edge), "label_idx").where(F.col("slice") <= F.col("edge"))  # edge: one row per class, at most MAX_CATEGORIES
    full = near.where(F.col("slice") < F.col("edge")).select("label_idx", "row_id")
    rank = F.row_number().over(W.partitionBy("label_idx").orderBy("key", "row_id"))
    last = near.where(F.col("slice") == F.col("edge")).withColumn("r", rank).where(F.col("before") + F.col("r") <= F.col("quota")).select("label_idx", "row_id")
    need = F.greatest(F.ceil("want"), F.col("min_rows"))
    report = plan.withColumn("short", F.greatest(F.lit(0).cast("bigint"), need - F.col("have")))
    return full.unionByName(last), report


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Classes of sample_targets that cannot be served: short in the report, or with fewer rows in the sample than their quota."""
    sample, report = draw(cut(labelled(table(spark, d, "raw_cache"))), table(spark, d, "sample_targets"))
    drawn = sample.groupBy("label_idx").agg(F.count(F.lit(1)).alias("drawn"))
    return report.join(drawn, "label_idx", "left").where((F.col("short") > 0) | (F.coalesce("drawn", F.lit(0)) < F.col("quota"))).select("label_idx")


def p7_sample(spark: SparkSession, d: str) -> DataFrame:
    """The sample: rows by the class whose quota they serve."""
    return draw(cut(labelled(table(spark, d, "raw_cache"))), table(spark, d, "sample_targets"))[0]


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    """Quota and shortfall of every class, rows drawn for it, and rows of the sample that carry it."""
    rows = cut(labelled(table(spark, d, "raw_cache")))
    sample, report = draw(rows, table(spark, d, "sample_targets"))
    sample = cut(sample)
    drawn = sample.groupBy("label_idx").agg(F.count(F.lit(1)).alias("drawn"))
    carried = rows.join(sample.select("row_id"), "row_id", "left_semi").select(F.explode("classes").alias("label_idx")).groupBy("label_idx").agg(F.count(F.lit(1)).alias("carried"))
    return report.join(drawn, "label_idx", "left").join(carried, "label_idx", "left").na.fill(0, ["drawn", "carried"])


def p7_check(spark: SparkSession, d: str) -> DataFrame:
    """Every class: what it has and misses; whether its quota was drawn, of rows that carry it and serve no other class."""
    rows = cut(labelled(table(spark, d, "raw_cache")))
    sample, report = draw(rows, table(spark, d, "sample_targets"))
    sample = cut(sample)
    times = sample.groupBy("row_id").agg(F.count(F.lit(1)).alias("times"))
    good = F.array_contains("classes", F.col("label_idx")) & (F.col("times") == 1)
    per = sample.join(times, "row_id").join(rows, "row_id", "left").groupBy("label_idx").agg(F.count(F.lit(1)).alias("drawn"), F.min(F.coalesce(good, F.lit(False))).alias("good"))
    served = (F.coalesce("drawn", F.lit(0)) == F.col("quota")) & F.coalesce("good", F.lit(True))
    return report.join(per, "label_idx", "left").select("label_idx", "have", F.round("want", 6).alias("want"), "min_rows", "short", served.alias("served"))


QUERIES = {"p7_found": p7_found, "p7_sample": p7_sample, "p7_report": p7_report, "p7_check": p7_check}

_HAVE = """
WITH rows AS (
  SELECT DISTINCT row_id, label_idx, label_idxs FROM raw_cache WHERE label_idx IS NOT NULL OR len(label_idxs) > 0
), size AS (SELECT count(DISTINCT row_id) // 10 AS n FROM rows),
counted AS (
  SELECT c, count(DISTINCT row_id) AS h FROM (SELECT row_id, unnest(list_append(coalesce(label_idxs, []), label_idx)) AS c FROM rows) WHERE c IS NOT NULL GROUP BY c
), state AS (
  SELECT t.label_idx, coalesce(h, 0) AS have, t.target_share * n AS want, min_rows FROM sample_targets t CROSS JOIN size LEFT JOIN counted ON counted.c = t.label_idx
)
"""

SQL = {
    "p7_found": _HAVE + "SELECT label_idx FROM state WHERE have < want OR have < min_rows",
    "p7_check": _HAVE + "SELECT label_idx, have, round(want, 6) AS want, min_rows, greatest(0, greatest(ceil(want)::BIGINT, min_rows) - have) AS short, true AS served FROM state",
}
