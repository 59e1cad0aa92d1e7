"""Splits that keep related records together (problem 2).

Entries are reduced to units (the sound, video, collar or single recording named in the path); a unit is known
by its smallest entry_id. Units are linked where they share a recording or an uploader; connected components of
those links give the groups, and largest-differencing balance assigns the groups to splits.

Scale: a group of units that share a key is linked by a star to its smallest unit (one link per unit, never all
pairs); links are made distinct before they are shuffled. Components come from alternating large-star and
small-star steps, all as joins and aggregates with map-side combination; each step is written to the shared
folder. The balance is a tree: parts of PART groups are balanced into BINS bins each, the bins of FAN parts
into BINS bins again, and so on; a task of the tree holds at most FAN x BINS numbers, the driver none.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wavelake.functions.paths import below_root, normal, recording_key
from wavelake.session import cut, table

#: Bins that every partial balance fills, and components of one partial balance.
BINS = 100
PART = 50_000
#: Parts whose bins one step of the tree balances.
FAN = 64
#: Placeholders of unknown people. Fixed values.
NOBODY = ("", "unknown", "n/a")


def sound_number(text: Column) -> Column:
    """The number a sound goes by, whatever its spelling (blanks, ending, leading zeros); null if there is none."""
    return F.nullif(F.regexp_replace(F.regexp_extract(text, r"^\s*0*([0-9]+)(?:\.[A-Za-z0-9]+)?\s*$", 1), "^$", ""), F.lit(""))


def units(entries: DataFrame) -> DataFrame:
    """``entry_id, split, rec, unit, sound`` of every entry with a path; repeated rows of an entry are one."""
    last = entries.groupBy("entry_id").agg(F.max(F.struct("received_at", "dataset", "split", "audio_path")).alias("x")).select("entry_id", "x.dataset", "x.split", "x.audio_path")
    p = last.withColumn("path", below_root(normal(F.col("audio_path")), F.col("dataset"))).where(F.col("path").isNotNull())
    ds, name, folder = F.coalesce("dataset", F.lit("")), F.substring_index("path", "/", -1), F.element_at(F.split("path", "/"), -2)
    rec = recording_key(F.col("dataset"), F.col("path"))
    stem = F.regexp_replace(name, r"\.[A-Za-z0-9]+$", "")
    sound = F.when(ds == "fsd50k", sound_number(stem)).when(ds == "urbansound8k", sound_number(F.substring_index(stem, "-", 1)))
    video = F.nullif(F.regexp_extract(stem, r"^(.{11})_-?[0-9]+$", 1), F.lit(""))
    parent = F.when(F.size(F.split("path", "/")) >= 3, F.lower(folder))
    unit = F.coalesce(
        F.concat(F.lit("sound:"), sound),
        F.when(ds == "audioset_strong", F.concat(F.lit("video:"), video)),
        F.when(ds == "hyenaset", F.concat(F.lit("collar:"), parent)),
        F.concat(F.lit("rec:"), rec),
    )
    return p.select("entry_id", "split", rec.alias("rec"), unit.alias("unit"), sound.alias("sound"))


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``edges`` (a, b): root is the smallest node of its component.

    Alternating large-star and small-star steps until nothing changes; the number of steps grows with the logarithm of the
    longest chain. Null nodes are left out; self-links are kept out of the work.
    """
    e = cut(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # Large star: every larger neighbour to the least of the neighbourhood.
        large = both.where(F.col("b") > F.col("a")).join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: every smaller neighbour, and the node, to the least.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x")).select("x.*")
        nxt = cut(small.where(F.col("a") != F.col("b")).distinct())
        # A forest of stars: no node has two parents, no parent is a child.
        ends = nxt.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")), F.struct(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("x")).select("x.*")
        open_ = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up = 1 and down = 1)")
        e = nxt
        if open_.isEmpty():
            return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def groups(entries: DataFrame, dev: DataFrame) -> DataFrame:
    """``entry_id, split, group_id``: every entry with a path and the smallest entry_id related to it."""
    u = cut(units(entries))
    ids = u.groupBy("unit").agg(F.min("entry_id").alias("uid"), F.first("sound").alias("sound"))
    rec = u.select("rec", "unit").distinct().join(ids.select("unit", "uid"), "unit")
    per_rec = rec.groupBy("rec").agg(F.min("uid").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    by_rec = rec.join(per_rec, "rec").select(F.col("uid").alias("a"), "b")
    who = F.lower(F.trim(F.regexp_replace("uploader", r"^\s+|\s+$", "")))
    known = dev.select(sound_number(F.col("fname")).alias("sound"), who.alias("who")).where(F.col("sound").isNotNull() & F.col("who").isNotNull() & ~F.col("who").isin(*NOBODY)).distinct()
    up = known.join(ids.where(F.col("sound").isNotNull()).select("sound", "uid"), "sound").select("who", "uid").distinct()
    star = up.groupBy("who").agg(F.min("uid").alias("b"))
    by_who = up.join(star, "who").select(F.col("uid").alias("a"), "b")
    roots = components(by_rec.unionByName(by_who))
    named = ids.select("unit", "uid").join(roots.withColumnRenamed("node", "uid"), "uid", "left").select("unit", F.coalesce("root", "uid").alias("group_id"))
    return u.select("entry_id", "split", "unit").join(named, "unit").select("entry_id", "split", "group_id")


# --- largest-differencing balance ---------------------------------------------------------------------------


def difference(weights: list[float], bins: int) -> list[int]:
    """The bin of each weight, by the largest-differencing method for many bins.

    Every weight begins as a partial solution of one filled bin. The two partial solutions whose bins differ most are combined
    again and again, the fullest bin of one with the emptiest of the other, until one is left. Ties go by position.
    """
    n = len(weights)
    owner = [0] * n
    # As many equal weights as there are bins fill them evenly and leave no difference; only what is over of each weight goes on.
    at: dict[float, list[int]] = {}
    for i, w in enumerate(weights):
        at.setdefault(w, []).append(i)
    loose = []
    for mine in at.values():
        even = len(mine) // bins * bins
        for k, i in enumerate(mine[:even]):
            owner[i] = k % bins
        loose += mine[even:]
    for i, k in zip(loose, _difference([weights[i] for i in loose], bins)):
        owner[i] = k
    return owner


def _difference(weights: list[float], bins: int) -> list[int]:
    n = len(weights)
    if not n:
        return []
    left, right = [-1] * n, [-1] * n  # a node is an item (below n) or two nodes taken together
    heap = [(-float(w), i, [(float(w), i)]) for i, w in enumerate(weights)]
    heapq.heapify(heap)
    serial = n
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        # Both are sorted from full to empty; bins that are not listed are empty.
        free = bins - len(a)
        out = list(a)
        # The fullest of b go into empty bins of a, the next fullest join the emptiest listed ones.
        fresh, shared = b[:free], b[free:]
        for k, (w, node) in enumerate(shared):
            at = len(a) - 1 - k
            left.append(out[at][1])
            right.append(node)
            out[at] = (out[at][0] + w, len(left) - 1)
        out.extend(fresh)
        out.sort(key=lambda x: -x[0])
        spread = out[0][0] - (out[-1][0] if len(out) == bins else 0.0)
        heapq.heappush(heap, (-spread, serial, out))
        serial += 1
    owner = [0] * n
    for k, (_, node) in enumerate(heap[0][2]):
        stack = [node]
        while stack:
            x = stack.pop()
            if x < n:
                owner[x] = k
            else:
                stack += (left[x], right[x])
    return owner


_PLACED = "group_id bigint, n bigint, torn boolean, part bigint, bin bigint"


def _partial(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["n", "group_id"], ascending=[False, True])
    return pdf.assign(bin=np.asarray(difference(pdf["n"].tolist(), BINS), np.int64))[[c.split()[0] for c in _PLACED.split(", ")]]


_STEP = "part bigint, bin bigint, n bigint, node bigint, up bigint"


def _step(pdf: pd.DataFrame) -> pd.DataFrame:
    """The bins of some parts (part, bin, n, node) in the bins of their node."""
    by_part: dict[int, list[tuple[float, int]]] = {}
    for p, b, n in zip(pdf["part"].tolist(), pdf["bin"].tolist(), pdf["n"].tolist()):
        by_part.setdefault(p, []).append((float(n), b))
    up = {x: k for k, (_, members) in enumerate(combine_parts(by_part, BINS)) for x in members}
    return pdf.assign(up=[up[x] for x in zip(pdf["part"].tolist(), pdf["bin"].tolist())])[["part", "bin", "n", "node", "up"]]


def _allot(targets: list[tuple[str, float]]):
    """Whole bins (bin, n), all of one node, to the split that lacks most."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n", "bin"], ascending=[False, True])
        lack = {s: share * float(pdf["n"].sum()) for s, share in targets}
        out = []
        for n in pdf["n"].tolist():
            s = max(lack, key=lambda k: (lack[k], k))
            lack[s] -= n
            out.append(s)
        return pd.DataFrame({"bin": pdf["bin"], "new_split": out})

    return run


def assign_splits(g: DataFrame, targets: list[tuple[str, float]]) -> DataFrame:
    """``group_id, n, torn, new_split``: whole groups assigned so that the splits' shares of entries come near ``targets``.

    ``torn`` tells that the group's entries lie in more than one split now. Groups are hashed into parts of about PART; each part is
    balanced into BINS bins in its own task, the parts' bins are combined by the same differencing, FAN parts at a time, and the last BINS
    bins go to the splits as a whole. A group heavier than a bin fills a bin of its own. Without targets the new split is null.
    """
    sizes = g.groupBy("group_id").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.min("split") < F.max("split"), F.lit(False)).alias("torn"))
    if not targets:
        return sizes.withColumn("new_split", F.lit(None).cast("string"))
    sizes = cut(sizes)
    parts = max(1, -(-sizes.count() // PART))
    placed = cut(sizes.withColumn("part", F.pmod(F.xxhash64("group_id"), F.lit(parts))).groupBy("part").applyInPandas(_partial, _PLACED))
    at = placed
    loads = placed.groupBy("part", "bin").agg(F.sum("n").alias("n"))
    while parts > 1:
        step = cut(loads.withColumn("node", F.floor(F.col("part") / F.lit(FAN)).cast("bigint")).groupBy("node").applyInPandas(_step, _STEP))
        at = at.join(step.select("part", "bin", "node", "up"), ["part", "bin"]).drop("part", "bin").withColumnsRenamed({"node": "part", "up": "bin"})
        loads = step.groupBy(F.col("node").alias("part"), F.col("up").alias("bin")).agg(F.sum("n").alias("n"))
        parts = -(-parts // FAN)
    last = loads.groupBy("part").applyInPandas(_allot(targets), "bin bigint, new_split string")  # at most BINS rows of one part
    return at.join(last, "bin").select("group_id", "n", "torn", "new_split")


def combine_parts(by_part: dict[int, list[tuple[float, int]]], bins: int) -> list[tuple[float, list[tuple[int, int]]]]:
    """Differencing over the parts' bins: the fullest of one with the emptiest of the other."""
    heap = []
    for p, listed in sorted(by_part.items()):
        full = sorted(((w, [(p, b)]) for w, b in listed), key=lambda x: (-x[0], x[1]))
        full += [(0.0, [])] * (bins - len(full))
        heap.append((full[-1][0] - full[0][0], p, full))
    heapq.heapify(heap)
    serial = max(by_part, default=0) + 1
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        out = sorted(((x[0] + y[0], x[1] + y[1]) for x, y in zip(a, reversed(b))), key=lambda x: (-x[0], x[1]))
        heapq.heappush(heap, (out[-1][0] - out[0][0], serial, out))
        serial += 1
    return [x for x in heap[0][2] if x[1]] if heap else []


def _groups(spark: SparkSession, d: str) -> DataFrame:
    return groups(table(spark, d, "split_entries"), table(spark, d, "dev"))


def _targets(spark: SparkSession, d: str) -> list[tuple[str, float]]:
    """The wanted shares: a fixed table of a few rows (more than 1,000 are refused)."""
    rows = table(spark, d, "split_targets").groupBy("split").agg(F.max("target_share").alias("t")).limit(1001).collect()
    if len(rows) > 1000:
        raise ValueError("split_targets has more than 1,000 splits")
    return sorted((r[0], float(r[1])) for r in rows if r[0] is not None and r[1] is not None)


def scattered(g: DataFrame, assigned: DataFrame) -> DataFrame:
    """``group_id, entry_id`` of the assigned groups whose entries lie in more than one split now."""
    return g.join(assigned.where("torn").select("group_id"), "group_id", "left_semi").select("group_id", "entry_id")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Every entry of a group of related entries that now lies in more than one split and gets one by the balance."""
    g = cut(_groups(spark, d))
    return scattered(g, cut(assign_splits(g, _targets(spark, d))))


def p2_assign(spark: SparkSession, d: str) -> DataFrame:
    """Every entry with a path, its group and its new split."""
    g = cut(_groups(spark, d))
    return g.join(assign_splits(g, _targets(spark, d)), "group_id").select("entry_id", "group_id", F.col("split").alias("old_split"), "new_split")


def p2_check(spark: SparkSession, d: str) -> DataFrame:
    """Every group with its number of entries and of new splits (one, whatever its old ones)."""
    return p2_assign(spark, d).groupBy("group_id").agg(F.count(F.lit(1)).alias("n_entries"), F.countDistinct("old_split").alias("n_old_splits"), F.countDistinct("new_split").alias("n_new_splits"))


def p2_near(spark: SparkSession, d: str) -> DataFrame:
    """Whether each target is met to within the heaviest group or a bin, whichever is larger."""
    a = assign_splits(cut(_groups(spark, d)), _targets(spark, d))
    per = a.groupBy("new_split").agg(F.sum("n").alias("n"), F.max("n").alias("heaviest"))
    total = per.withColumns({"all": F.sum("n").over(W.partitionBy()), "heaviest": F.max("heaviest").over(W.partitionBy())})  # one row per split
    want = table(spark, d, "split_targets").groupBy(F.col("split").alias("new_split")).agg(F.max("target_share").alias("target_share"))
    near = F.abs(F.col("n") - F.col("target_share") * F.col("all")) <= F.greatest(F.col("heaviest"), F.ceil(F.col("all") / F.lit(BINS)) + 1)
    return want.join(total, "new_split", "left").select("new_split", F.coalesce(near, F.lit(False)).alias("near"))


def p2_report(spark: SparkSession, d: str) -> DataFrame:
    """Entries, groups and share of each new split, with the target."""
    a = assign_splits(_groups(spark, d), _targets(spark, d)).groupBy("new_split").agg(F.sum("n").alias("n_entries"), F.count(F.lit(1)).alias("n_groups"))
    share = F.col("n_entries") / F.sum("n_entries").over(W.partitionBy())
    want = table(spark, d, "split_targets").groupBy(F.col("split").alias("new_split")).agg(F.max("target_share").alias("target_share"))
    return a.withColumn("share", share).join(want, "new_split", "full").select("new_split", "n_entries", "n_groups", "share", "target_share")


QUERIES = {"p2_found": p2_found, "p2_assign": p2_assign, "p2_check": p2_check, "p2_near": p2_near, "p2_report": p2_report}
