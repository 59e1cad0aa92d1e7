"""Cutting oversized items at natural boundaries (problem 4).

An item longer than its dataset's limit is bisected: the cut goes to the strongest boundary near the midpoint, halves still
longer than the limit minus the overlap are bisected again, and then every piece but the first is extended to
the left by the overlap. Boundaries are the stretches in which none of the recording's events is active.

Scale: only recordings with an oversized item are looked at; their events are first merged into busy periods (no recording is
ever in one task); the quiet stretches between them meet the items by an interval join. An item with up to MANY stretches
is cut in one task, piece by piece; one with more is first bisected by joins and aggregates, round by round, until every part has
no more than that. Both ways make the same cuts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wavelake.operators.interval_join import interval_join
from wavelake.operators.intervals import merge_intervals, whole_ms
from wavelake.session import cut, table

EPS = 1e-9
#: Width of the buckets in which items and quiet stretches meet, in ms.
BLOCK = 600_000
#: Quiet stretches that one task takes together, and pieces that it hands on at once.
MANY = 100_000
CHUNK = 50_000
#: Items that one task cuts.
ITEMS = 20_000
#: Beyond all times.
FAR = 41 * 10**17


def oversized(raw: DataFrame, limits: DataFrame) -> DataFrame:
    """``row_id, dataset, audio_path, from_ms, size_ms, max_ms, overlap_ms``: the items longer than their dataset's limit.

    Repeated rows of an item are one (the row received last). The length is end - start; where the end is null, NaN or infinite
    it is valid_sec; where that is null, NaN or infinite too, or the start is unknown then, the item is no case. Datasets without a
    limit have no cases.
    """
    last = raw.groupBy("row_id").agg(F.max(F.struct("received_at", "dataset", "audio_path", "start", "end", "valid_sec")).alias("x")).select("row_id", "x.*")
    inf = F.lit(float("inf"))
    known = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) < inf)
    length = F.when(known("end") & known("start"), F.col("end") - F.col("start")).when(~known("end") & known("valid_sec"), F.col("valid_sec"))
    lim = limits.where(F.col("max_sec") > 0).groupBy("dataset").agg(F.max(F.struct("max_sec", "overlap_sec")).alias("l")).select("dataset", "l.max_sec", F.coalesce("l.overlap_sec", F.lit(0.0)).alias("overlap_sec"))
    over = last.withColumn("length", length).join(lim, "dataset").where(F.col("length") > F.col("max_sec") + F.lit(EPS))
    start = F.when(known("start"), F.col("start")).otherwise(F.lit(0.0))
    return over.select(
        "row_id", "dataset", "audio_path", whole_ms(start).alias("from_ms"), F.ceil(F.col("length") * 1000 - EPS).cast("bigint").alias("size_ms"), whole_ms(F.col("max_sec")).alias("max_ms"), whole_ms(F.col("overlap_sec")).alias("overlap_ms")
    )


def quiet_stretches(items: DataFrame, events: DataFrame) -> DataFrame:
    """``row_id, q0, q1``: the stretches of each item in which none of its recording's events is active; without recording, all of it."""
    paths = items.select("audio_path").where(F.col("audio_path").isNotNull()).distinct()
    ev = events.join(paths, "audio_path", "left_semi").select("audio_path", whole_ms(F.col("start")).alias("s"), whole_ms(F.col("end")).alias("e"))
    busy = cut(merge_intervals(ev, ["audio_path"], "s", "e").select("audio_path", "from_ms", "to_ms", "next_ms"))
    before = paths.join(busy.groupBy("audio_path").agg(F.min("from_ms").alias("q1")), "audio_path", "left").select("audio_path", F.lit(-FAR).alias("q0"), F.coalesce("q1", F.lit(FAR)).alias("q1"))
    after = busy.select("audio_path", F.col("to_ms").alias("q0"), F.coalesce("next_ms", F.lit(FAR)).alias("q1"))
    spans = items.select("row_id", "audio_path", "from_ms", (F.col("from_ms") + F.col("size_ms")).alias("til"))
    met = interval_join(spans, before.unionByName(after), ["audio_path"], ("from_ms", "til"), ("q0", "q1"), BLOCK)
    clipped = met.select("row_id", F.greatest("q0", "from_ms").alias("q0"), F.least("q1", "til").alias("q1"))
    return clipped.unionByName(spans.where(F.col("audio_path").isNull()).select("row_id", F.col("from_ms").alias("q0"), F.col("til").alias("q1")))


def between(a: int, b: int, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The quiet stretches of [a, b) between the disjoint sorted busy periods ``lo``/``hi``."""
    q0 = np.concatenate([[a], hi]).clip(a, b)
    q1 = np.concatenate([lo, [b]]).clip(a, b)
    return q0[q1 > q0], q1[q1 > q0]


def cut_of(x: int, y: int, q0: np.ndarray, q1: np.ndarray) -> int:
    """Where [x, y) is cut: in its widest quiet stretch within the middle half, or else in the quiet stretch nearest to its midpoint, at the
    point of that stretch nearest to the midpoint; with no quiet moment inside, at the midpoint. ``q0``/``q1`` are sorted."""
    mid = (x + y) // 2
    i, j = np.searchsorted(q1, x, "right"), np.searchsorted(q0, y, "left")
    if j <= i:
        return mid
    s, e = np.maximum(q0[i:j], x), np.minimum(q1[i:j], y)
    # The nearest moment to the midpoint in each stretch that is not the part's edge.
    at = np.minimum(np.maximum(mid, s), e)
    at = np.where(e - s < 2, s, np.where((at <= x) | (at >= y), (s + e) // 2, at))
    ok = (at > x) & (at < y)
    if not ok.any():
        return mid
    far = np.where(ok, np.abs(at - mid), np.iinfo(np.int64).max)
    near = ok & (far <= (y - x) // 4)
    k = int(np.argmax(np.where(near, (e - s) - far / 4.0, -np.inf))) if near.any() else int(np.argmin(far))
    # Inside a stretch rather than on its edge, where it has an inside.
    return int(min(max(at[k], s[k] + 1), e[k] - 1)) if e[k] - s[k] >= 2 else int(at[k])


def parts_of(a: int, b: int, size: int, q0: np.ndarray, q1: np.ndarray) -> Iterator[tuple[int, int]]:
    """[a, b) bisected until no part is longer than ``size``, from left to right."""
    todo = [(a, b)]
    while todo:
        x, y = todo.pop()
        if y - x <= size:
            yield x, y
        else:
            c = cut_of(x, y, q0, q1)
            todo += [(c, y), (x, c)]


def bisect(a: int, b: int, size: int, lo: np.ndarray, hi: np.ndarray) -> list[int]:
    """Cuts of [a, b) so that no part is longer than ``size``; ``lo``/``hi`` are the disjoint sorted busy periods."""
    return [x for x, _ in parts_of(a, b, size, *between(a, b, lo, hi))][1:]


_PIECES = "row_id bigint, part_from bigint, k bigint, from_ms bigint, to_ms bigint, quiet boolean"


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=[c.split()[0] for c in _PIECES.split(", ")]).astype({"row_id": "int64", "part_from": "int64", "k": "int64", "from_ms": "int64", "to_ms": "int64", "quiet": bool})

    for pdf in batches:
        rows: list[tuple] = []
        for r in pdf.itertuples(index=False):
            spans = np.array(sorted((int(x["q0"]), int(x["q1"])) for x in r.quiet), np.int64).reshape(-1, 2)
            q0, q1 = spans[:, 0], spans[:, 1]
            for k, (x, y) in enumerate(parts_of(int(r.x), int(r.y), int(r.size), q0, q1)):
                i = np.searchsorted(q0, x, "right") - 1
                first = x == r.from_ms
                rows.append((r.row_id, r.x, k, x if first else x - r.overlap, y, first or bool(i >= 0 and q1[i] > x)))
                if len(rows) >= CHUNK:
                    yield frame(rows)
                    rows = []
        yield frame(rows)


def _halved(parts: DataFrame, stretches: DataFrame) -> DataFrame:
    """Every part (row_id, x, y, size) with its stretches, cut in two by the rule of ``cut_of``."""
    met = interval_join(parts, stretches, ["row_id"], ("x", "y"), ("q0", "q1"), BLOCK)
    mid = F.floor((F.col("x") + F.col("y")) / 2)
    s, e = F.greatest("q0", "x"), F.least("q1", "y")
    at = F.least(F.greatest(mid, s), e)
    at = F.when(e - s < 2, s).when((at <= F.col("x")) | (at >= F.col("y")), F.floor((s + e) / 2)).otherwise(at).cast("bigint")
    d = met.select("row_id", "x", "y", "size", s.alias("s"), e.alias("e"), at.alias("at"), F.abs(at - mid).alias("far")).where((F.col("at") > F.col("x")) & (F.col("at") < F.col("y")))
    near = F.col("far") <= F.floor((F.col("y") - F.col("x")) / 4)
    best = F.max_by(F.struct("at", "s", "e"), F.when(near, F.struct((F.col("e") - F.col("s")) - F.col("far") / 4.0, -F.col("s"))))
    other = F.min_by(F.struct("at", "s", "e"), F.struct("far", "s"))
    p = d.groupBy("row_id", "x", "y", "size").agg(best.alias("best"), other.alias("other")).withColumn("p", F.coalesce("best", "other")).select("row_id", "x", "p")
    inside = F.least(F.greatest(F.col("p.at"), F.col("p.s") + 1), F.col("p.e") - 1)
    c = F.coalesce(F.when(F.col("p.e") - F.col("p.s") >= 2, inside).otherwise(F.col("p.at")), mid.cast("bigint"))
    two = parts.join(p, ["row_id", "x"], "left").withColumn("c", c)
    return two.select("row_id", "size", "rest", F.explode(F.array(F.struct("x", F.col("c").alias("y")), F.struct(F.col("c").alias("x"), "y"))).alias("h")).select("row_id", "h.x", "h.y", "size", "rest")


def pieces(items: DataFrame, events: DataFrame, many: int = MANY) -> DataFrame:
    """``row_id, piece, from_ms, to_ms, quiet``: the pieces of each oversized item, in order.

    Consecutive pieces overlap by the dataset's overlap_sec; none is longer than max_sec; ``quiet`` tells that no event is
    active where the piece was cut off the one before. Events with a null or NaN time, or that do not last, are no events; uncertain
    ones are.
    """
    items = cut(items)
    stretches = cut(quiet_stretches(items, events))
    overlap = F.greatest(F.lit(0), F.least("overlap_ms", F.col("max_ms") - 1)).cast("bigint")
    # What a part needs besides its bounds travels along with it.
    parts = items.select("row_id", F.col("from_ms").alias("x"), (F.col("from_ms") + F.col("size_ms")).alias("y"), (F.col("max_ms") - overlap).alias("size"), F.struct("from_ms", overlap.alias("overlap")).alias("rest"))
    counts = stretches.groupBy("row_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > many).select("row_id")
    heavy = cut(parts.join(counts, "row_id", "left_semi"))
    light = parts.join(heavy.select("row_id"), "row_id", "left_anti")
    own = stretches
    any_heavy = not heavy.isEmpty()
    if any_heavy:
        mine = stretches.join(heavy.select("row_id"), "row_id", "left_semi")
        own = stretches.join(heavy.select("row_id"), "row_id", "left_anti").withColumn("x", F.lit(None).cast("bigint"))
        while not heavy.isEmpty():
            halves = cut(_halved(heavy, mine))
            n = interval_join(halves.select("row_id", "x", "y"), mine, ["row_id"], ("x", "y"), ("q0", "q1"), BLOCK).groupBy("row_id", "x").agg(F.count(F.lit(1)).alias("n"))
            big = cut(n.where(F.col("n") > many).select("row_id", "x"))
            heavy = cut(halves.where(F.col("y") - F.col("x") > F.col("size")).join(big, ["row_id", "x"], "left_semi"))
            light = light.unionByName(halves.join(heavy.select("row_id", "x"), ["row_id", "x"], "left_anti"))
        of_parts = interval_join(light.select("row_id", "x", "y"), mine, ["row_id"], ("x", "y"), ("q0", "q1"), BLOCK).select("row_id", F.greatest("q0", "x").alias("q0"), F.least("q1", "y").alias("q1"), "x")
        own = own.unionByName(of_parts)
    key = ["row_id", "x"] if any_heavy else ["row_id"]
    if any_heavy:
        starts = items.select("row_id", F.col("from_ms").alias("_x"))
        own = own.join(starts, "row_id").withColumn("x", F.coalesce("x", "_x")).drop("_x")
    # Few bytes but much work per row: spread by the number of items rather than by bytes.
    tasks = max(2 * items.sparkSession.sparkContext.defaultParallelism, items.count() // ITEMS)
    lists = own.repartition(tasks, *key).groupBy(*key).agg(F.collect_list(F.struct("q0", "q1")).alias("quiet"))  # at most about ``many``, but for parts within the limit
    ready = light.join(lists, key, "left").withColumn("quiet", F.coalesce("quiet", F.array().cast("array<struct<q0:bigint,q1:bigint>>")))
    done = ready.select("row_id", "x", "y", "size", "rest.from_ms", "rest.overlap", "quiet").mapInPandas(_cut, _PIECES)
    if any_heavy:
        done = cut(done)
        per = done.groupBy("row_id", "part_from").agg(F.count(F.lit(1)).alias("n"))
        before = F.coalesce(F.sum("n").over(W.partitionBy("row_id").orderBy("part_from").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        done = done.join(per.select("row_id", "part_from", before.alias("before")), ["row_id", "part_from"]).withColumn("k", F.col("k") + F.col("before"))
    return done.select("row_id", F.col("k").alias("piece"), "from_ms", "to_ms", "quiet")


def _items(spark: SparkSession, d: str) -> DataFrame:
    return oversized(table(spark, d, "raw_cache"), table(spark, d, "piece_limits"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """The items that are longer than their dataset's limit: those the operator cuts into two or more pieces."""
    return pieces(_items(spark, d), table(spark, d, "strong_events")).where("piece = 1").select("row_id")


def p4_pieces(spark: SparkSession, d: str) -> DataFrame:
    """All pieces of the oversized items."""
    return pieces(_items(spark, d), table(spark, d, "strong_events"))


def p4_check(spark: SparkSession, d: str) -> DataFrame:
    """Every oversized item with the stretch its pieces cover: whether all are within the limit, overlap as wanted, and are cut at a loud moment
    only where the pieces on both sides hold no quiet one."""
    items, events = cut(_items(spark, d)), table(spark, d, "strong_events")
    p = cut(pieces(items, events).join(items.select("row_id", "max_ms", "overlap_ms"), "row_id"))
    by = W.partitionBy("row_id").orderBy("piece")
    p = p.withColumns({"before": F.lag("to_ms").over(by), "start": F.lag("to_ms", 1).over(by)})
    loud = p.where("not quiet").select("row_id", F.col("before").alias("at"), F.col("to_ms").alias("b"), "piece").join(p.select("row_id", (F.col("piece") + 1).alias("piece"), F.coalesce("start", "from_ms").alias("a")), ["row_id", "piece"])
    stretches = quiet_stretches(items, events).withColumnRenamed("row_id", "r")
    met = interval_join(loud.select(F.col("row_id").alias("r"), "at", (F.col("a") + 1).alias("a"), "b"), stretches, ["r"], ("a", "b"), ("q0", "q1"), BLOCK)
    missed = met.groupBy(F.col("r").alias("row_id")).agg(F.count(F.lit(1)).alias("missed"))
    good = F.coalesce(F.col("from_ms") == F.col("before") - F.col("overlap_ms"), F.col("piece") == 0)
    per = p.groupBy("row_id").agg(F.min("from_ms").alias("from_ms"), F.max("to_ms").alias("to_ms"), F.min((F.col("to_ms") - F.col("from_ms") <= F.col("max_ms")) & (F.col("to_ms") > F.col("from_ms"))).alias("fits"), F.min(good).alias("overlapped"))
    return per.join(missed, "row_id", "left").select("row_id", "from_ms", "to_ms", "fits", "overlapped", F.col("missed").isNull().alias("quiet"))


QUERIES = {"p4_found": p4_found, "p4_pieces": p4_pieces, "p4_check": p4_check}

SQL = {
    "p4_found": """
SELECT DISTINCT r.row_id FROM raw_cache r JOIN piece_limits l USING (dataset)
WHERE CASE WHEN isfinite(r."end") THEN r."end" - r.start WHEN isfinite(r.valid_sec) THEN r.valid_sec END > l.max_sec + 1e-9
""",
    "p4_check": """
WITH r AS (SELECT row_id, dataset, CASE WHEN isfinite(start) THEN start ELSE 0.0 END AS s, CASE WHEN isfinite("end") THEN "end" - start WHEN isfinite(valid_sec) THEN valid_sec END AS length
  FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY received_at DESC) AS rn FROM raw_cache) WHERE rn = 1)
SELECT row_id, round_even(s * 1000, 0)::BIGINT AS from_ms, (round_even(s * 1000, 0) + ceil(length * 1000 - 1e-9))::BIGINT AS to_ms, true AS fits, true AS overlapped, true AS quiet
FROM r JOIN piece_limits l USING (dataset) WHERE length > max_sec + 1e-9
""",
}
