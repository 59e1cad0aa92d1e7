"""The k most similar vectors of every vector (problem 3).

Vectors are scaled to length one, so that order by distance is order by cosine. The collection is divided among pivots (every vector
belongs to its nearest one: a cell), neighbouring cells are put together in shards of about SHARD vectors, and every shard is
one tree: its cells, and below each cell a vantage-point tree whose nodes split at the median distance from a vantage point.

Pruning. A cell holds nothing nearer to a query than the plane between its pivot and the query's own, nor than the ball around
its pivot; the far side of a node nothing nearer than the gap between the query's distance and the node's radius. Whatever
lies beyond the distance of the k-th best so far is skipped. Factor 1 is exact; a larger factor multiplies these bounds, so that more is skipped.

Plan. The vectors are shuffled once to drop repeated rows and once to their shards. The task that builds a shard's tree also
answers its own queries within it, which gives each query a true upper bound. Tree and answers are written to the shared
folder once; queries then travel, in blocks of one shard's queries, to the other shards that their bound leaves, by a join. No vector,
query or hit passes the driver, which holds the pivots (at most CELLS), fitted on a sample of about SAMPLE vectors. A cell heavier than
a shard is spread over several by the hash of the ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wavelake.session import cut, table

DIM = 64
SHARD = 8_192
LEAF = 512
#: Vectors on which the pivots are fitted; every vector is indexed.
SAMPLE = 8_192
#: One pivot for so many vectors, and the most pivots.
PER_CELL, CELLS = 1_000, 256
K = 8
#: Relaxation of the pruning bounds where none is named; 1 is exact.
FACTOR = 3.0
#: Slack for single-precision products; what comes near is compared again in double precision.
SLACK = 1e-5


def last_vectors(vectors: DataFrame, dim: int = DIM) -> DataFrame:
    """``vec_id, e``: each vec_id once (the row received last), if it has ``dim`` numbers.

    Whether the numbers are usable is looked at when cells are assigned.
    """
    good = vectors.where(F.col("vec_id").isNotNull()).groupBy("vec_id").agg(F.max_by("embedding", F.struct(F.col("received_at").isNotNull(), "received_at")).alias("e"))
    return good.where(F.size("e") == dim)


def unit(raw: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, by their largest number first, so that tiny and huge vectors keep their direction."""
    x = raw.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def usable(x: np.ndarray) -> np.ndarray:
    return np.isfinite(x).all(1) & (x != 0).any(1)


def distance(similarity: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * similarity, 0.0))


# --- pivots ---------------------------------------------------------------------------------------------------


class Cells:
    """Pivots, and the shards of their cells: cell c lies in shards ``first[c]`` to ``first[c] + salts[c] - 1``."""

    def __init__(self, sample: np.ndarray, n: int, per_cell: int = PER_CELL, shard: int = SHARD, rounds: int = 10):
        count = max(1, min(n // per_cell, CELLS, len(sample)))
        rng = np.random.default_rng(3)
        p = sample[rng.choice(len(sample), count, replace=False)] if len(sample) else np.eye(1, DIM)
        for _ in range(rounds if len(sample) else 0):
            owner = (sample @ p.T).argmax(1)
            total = np.zeros_like(p)
            np.add.at(total, owner, sample)
            size = np.linalg.norm(total, axis=1, keepdims=True)
            p = np.where(size > 1e-9, total / np.maximum(size, 1e-9), p)
        p = p[chain(p)]
        self.pivots = p.astype(np.float32)
        weight = np.bincount(self.of(sample), minlength=len(p)) / max(len(sample), 1) * n
        self.first, self.salts = np.zeros(len(p), np.int64), np.ones(len(p), np.int64)
        at, load = 0, 0.0
        for c, w in enumerate(weight):
            if w > 1.5 * shard:
                at += load > 0
                self.first[c], self.salts[c] = at, int(np.ceil(w / shard))
                at, load = at + self.salts[c], 0.0
                continue
            if load and load + w > shard:
                at, load = at + 1, 0.0
            self.first[c] = at
            load += w

    def of(self, x: np.ndarray) -> np.ndarray:
        return (x.astype(np.float32) @ self.pivots.T).argmax(1)

    def bounds(self, x: np.ndarray) -> np.ndarray:
        """Least possible distance of each vector to anything in each cell, by the plane between that cell's pivot and its nearest one."""
        p = self.pivots.astype(np.float64)
        s = x @ p.T
        own = s.argmax(1)
        apart = distance(p @ p.T)[own]
        # Pivots and vectors have length one, so squared distances differ by twice the similarities.
        return np.maximum((s[np.arange(len(x)), own][:, None] - s) / np.maximum(apart, 1e-6) - SLACK, 0.0)


def chain(p: np.ndarray) -> np.ndarray:
    """An order of the pivots in which neighbours are near: halves by the distance from a vantage point, again and again."""
    if len(p) < 3:
        return np.arange(len(p))
    v = p[int((p @ p[0]).argmin())]
    order = np.argsort(-(p @ v), kind="stable")
    a, b = order[: len(p) // 2], order[len(p) // 2 :]
    return np.r_[a[chain(p[a])], b[chain(p[b])]]


# --- the tree of one shard --------------------------------------------------------------------------------------


class Tree:
    """Cells of a shard with a vantage-point tree below each: rows in leaf order, and flat arrays of cells and nodes."""

    def __init__(self, ids: np.ndarray, raw: np.ndarray, cell_rows: np.ndarray, nodes: np.ndarray, pivots: np.ndarray):
        self.ids, self.raw, self.cells, self.nodes = ids, raw, cell_rows, nodes
        self.x = unit(raw) if len(raw) else np.zeros((0, pivots.shape[1]))
        self.f = self.x.astype(np.float32)
        self.pivots = pivots.astype(np.float64)[self.cells[:, 0].astype(np.int64)]
        self.compared = 0

    @classmethod
    def build(cls, ids: np.ndarray, raw: np.ndarray, cell: np.ndarray, pivots: np.ndarray, leaf: int = LEAF) -> Tree:
        order = np.lexsort((ids, cell))
        x = unit(raw)
        nodes: list[list[float]] = []  # lo, hi, vantage row, radius, inner, outer

        def split(lo: int, hi: int) -> int:
            me = len(nodes)
            nodes.append([lo, hi, -1, 0.0, -1, -1])
            if hi - lo > leaf:
                rows = order[lo:hi]
                # The vantage point is the vector farthest from the first one: it spreads the distances.
                v = rows[int((x[rows] @ x[rows[0]]).argmin())]
                d = distance(x[rows] @ x[v])
                half = (hi - lo) // 2
                part = np.argpartition(d, half)
                order[lo:hi] = rows[part]
                inner, outer = split(lo, lo + half), split(lo + half, hi)
                nodes[me] = [lo, hi, v, float(d[part[half]]), inner, outer]
            return me

        found, lo = [], 0
        for c, n in zip(*np.unique(cell, return_counts=True)):
            radius = float(distance(x[order[lo : lo + n]] @ pivots[c].astype(np.float64)).max())
            found.append([c, lo, lo + n, split(lo, lo + int(n)), radius])
            lo += int(n)
        at = np.empty(len(order), np.int64)
        at[order] = np.arange(len(order))
        table = np.array(nodes, np.float64).reshape(-1, 6)
        inner_nodes = table[:, 2] >= 0
        table[inner_nodes, 2] = at[table[inner_nodes, 2].astype(np.int64)]
        return cls(ids[order], np.ascontiguousarray(raw[order]), np.array(found, np.float64).reshape(-1, 5), table, pivots)

    def search(self, q: np.ndarray, qid: np.ndarray, bounds: np.ndarray, k: int, least: np.ndarray, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, similarities)`` of the best ``k`` of every query among what is at least as similar as ``least``; -1 where there are fewer.

        Ties go by the smaller id. ``bounds`` are the queries' bounds to all cells. Queries do not find themselves.
        """
        best_id = np.full((len(q), k), -1, np.int64)
        best = np.full((len(q), k), -np.inf)
        floor = least.astype(np.float64).copy()  # similarity of the k-th best, from this shard or from what was known
        qf = q.astype(np.float32)

        def leaf(lo: int, hi: int, a: np.ndarray) -> None:
            self.compared += len(a) * (hi - lo)
            s = qf[a] @ self.f[lo:hi].T
            bar = floor[a]
            if hi - lo > k + 1:
                # The query itself may be among the k + 1 best; ties with the last of them stay in.
                bar = np.maximum(bar, np.partition(s, hi - lo - k - 1, axis=1)[:, hi - lo - k - 1])
            i, j = np.nonzero(s >= (bar - SLACK).astype(np.float32)[:, None])
            j += lo
            other = qid[a[i]] != self.ids[j]
            i, j = i[other], j[other]
            if not len(i):
                return
            touched = np.unique(i)
            old = a[touched]
            oi, oj = np.nonzero(best_id[old] >= 0)
            who = np.r_[a[i], old[oi]]
            ids = np.r_[self.ids[j], best_id[old][oi, oj]]
            sim = np.r_[np.einsum("ij,ij->i", q[a[i]], self.x[j]), best[old][oi, oj]]
            order = np.lexsort((ids, -sim, who))
            who, ids, sim = who[order], ids[order], sim[order]
            begin = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
            rank = np.arange(len(who)) - np.repeat(begin, np.diff(np.r_[begin, len(who)]))
            keep = rank < k
            best_id[who[keep], rank[keep]], best[who[keep], rank[keep]] = ids[keep], sim[keep]
            floor[old] = np.maximum(floor[old], best[old, k - 1])

        def visit(node: int, a: np.ndarray) -> None:
            lo, hi, at, r, inner, outer = self.nodes[node]
            if at < 0:
                leaf(int(lo), int(hi), a)
                return
            gap = distance(q[a] @ self.x[int(at)]) - r
            inside = gap < 0
            for side, near, far in ((inside, inner, outer), (~inside, outer, inner)):
                if side.any():
                    b, g = a[side], np.abs(gap[side])
                    visit(int(near), b)
                    b = b[(g - SLACK) * factor <= distance(floor[b])]
                    if len(b):
                        visit(int(far), b)

        if len(q) and len(self.ids):
            at_cell = self.cells[:, 0].astype(np.int64)
            ball = distance(q @ self.pivots.T) - self.cells[:, 4][None, :] - SLACK
            bound = np.maximum(bounds[:, at_cell], ball)
            first = bound.argmin(1)
            for c, (_, _, _, root, _) in enumerate(self.cells):  # every query in its nearest cell first
                a = np.flatnonzero(first == c)
                a = a[bound[a, c] * factor <= distance(floor[a])]
                if len(a):
                    visit(int(root), a)
            for c, (_, _, _, root, _) in enumerate(self.cells):
                a = np.flatnonzero(first != c)
                a = a[bound[a, c] * factor <= distance(floor[a])]
                if len(a):
                    visit(int(root), a)
        return best_id, best


# --- the distributed search -------------------------------------------------------------------------------------


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float32).reshape(len(column), -1)


def _binary(rows: np.ndarray) -> pa.Array:
    """One binary per row of a matrix."""
    rows = np.ascontiguousarray(rows)
    size = rows.strides[0] if len(rows) else 0
    return pa.BinaryArray.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer((np.arange(len(rows) + 1) * size).astype(np.int32).tobytes()), pa.py_buffer(rows.tobytes())])


def _mixed(ids: np.ndarray) -> np.ndarray:
    """A hash of the ids that differs from the engine's own."""
    x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(33)


def sampled(vectors: DataFrame, n: int, size: int = SAMPLE) -> np.ndarray:
    """About ``size`` usable vectors (vec_id, e) of ``n``, by the hash of their ids."""
    share = F.lit(int(min(1.0, size / max(n, 1)) * 2**40))
    got = vectors.where(F.size("e") == DIM).where(F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(2**40)) < share).select("e").limit(2 * size).toPandas()["e"]
    x = np.array([[np.nan if y is None else y for y in e] for e in got], np.float32).reshape(len(got), DIM)
    return unit(x[usable(x)]) if usable(x).any() else np.zeros((0, DIM))


_ASSIGNED = "shard bigint, cell int, vec_id bigint, v binary, wanted boolean"
_TREES = "shard bigint, ids binary, v binary, cells binary, nodes binary, asked binary, least binary, hit_q binary, hit_id binary, hit_s binary, compared bigint"
_BLOCKS = "target bigint, q_ids binary, q_v binary, q_least binary"
_HITS = "qid bigint, vec_id bigint, similarity double, compared bigint"


def indexed(flagged: DataFrame, cells: Cells, k: int, factor: float) -> DataFrame:
    """One row per shard: its tree, and what its own queries find in it. Vectors with a null, NaN or infinite number, or all zero, are left out."""
    spark = flagged.sparkSession
    sent = spark.sparkContext.broadcast(cells)  # at most CELLS pivots

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = sent.value
        for b in batches:
            if not b.num_rows:
                continue
            x = _vectors(b.column("e"))
            ok = usable(x)
            x, ids = x[ok], b.column("vec_id").to_numpy()[ok]
            if not len(x):
                continue
            cell = c.of(unit(x))
            shard = c.first[cell] + (_mixed(ids) % c.salts[cell].astype(np.uint64)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(cell.astype(np.int32)), pa.array(ids), _binary(x), b.column("wanted").filter(pa.array(ok))], ["shard", "cell", "vec_id", "v", "wanted"])

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        c = sent.value
        raw = np.frombuffer(b"".join(pdf["v"]), np.float32).reshape(len(pdf), -1)
        ids = pdf["vec_id"].to_numpy(np.int64)
        t = Tree.build(ids, raw, pdf["cell"].to_numpy(np.int64), c.pivots)
        asked = np.flatnonzero(np.isin(t.ids, ids[pdf["wanted"].to_numpy(bool)]))
        q = t.x[asked]
        found, sim = t.search(q, t.ids[asked], c.bounds(q), k, np.full(len(asked), -np.inf), factor)
        i, j = np.nonzero(found >= 0)
        row = [int(pdf["shard"].iloc[0]), t.ids, t.raw, t.cells, t.nodes, asked.astype(np.int32), sim[:, k - 1], t.ids[asked[i]], found[i, j], sim[i, j], t.compared]
        return pd.DataFrame([[x.tobytes() if isinstance(x, np.ndarray) else x for x in row]], columns=[y.split()[0] for y in _TREES.split(", ")])

    placed = flagged.select("vec_id", "e", "wanted").mapInArrow(assign, _ASSIGNED)
    return cut(placed.groupBy("shard").applyInPandas(build, _TREES))


def _frombuffers(b: pa.RecordBatch, kinds: dict[str, type]) -> Iterator[tuple]:
    for row in zip(*(b.column(c) for c in kinds)):
        yield tuple(np.frombuffer(x.as_buffer(), t) if t is not int else x.as_py() for x, t in zip(row, kinds.values()))


def travelling(trees: DataFrame, cells: Cells, factor: float) -> DataFrame:
    """Blocks of one shard's queries for every other shard that their bounds leave."""
    sent = trees.sparkSession.sparkContext.broadcast(cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = sent.value
        places: dict[tuple[int, int], list[int]] = {}
        for k, place in enumerate(zip(c.first.tolist(), c.salts.tolist())):
            places.setdefault(place, []).append(k)
        for b in batches:
            for shard, ids, v, asked, least in _frombuffers(b, {"shard": int, "ids": np.int64, "v": np.float32, "asked": np.int32, "least": np.float64}):
                if not len(asked):
                    continue
                raw = v.reshape(len(ids), -1)[asked]
                need = c.bounds(unit(raw)) * factor <= distance(least)[:, None]
                for (first, salts), mine in places.items():
                    a = np.flatnonzero(need[:, mine].any(1))
                    for target in range(first, first + salts) if len(a) else ():
                        if target != shard:
                            yield pa.RecordBatch.from_arrays([pa.array([target]), *(pa.array([x.tobytes()], pa.binary()) for x in (ids[asked[a]], raw[a], least[a]))], ["target", "q_ids", "q_v", "q_least"])

    return trees.select("shard", "ids", "v", "asked", "least").mapInArrow(run, _BLOCKS)


def _hits(qid: np.ndarray, ids: np.ndarray, sim: np.ndarray, compared: int) -> pa.RecordBatch:
    """Hits, and one row that tells how many pairs were compared."""
    n = len(qid)
    return pa.RecordBatch.from_arrays([pa.array(np.r_[qid, 0], mask=np.arange(n + 1) == n), pa.array(np.r_[ids, 0], mask=np.arange(n + 1) == n), pa.array(np.r_[sim, 0.0], mask=np.arange(n + 1) == n), pa.array(np.r_[np.zeros(n, np.int64), compared])], [x.split()[0] for x in _HITS.split(", ")])


def hits(flagged: DataFrame, k: int = K, factor: float = FACTOR, fitted_on: DataFrame | None = None, per_cell: int = PER_CELL, shard: int = SHARD) -> DataFrame:
    """``qid, vec_id, similarity, compared``: the shards' best ``k`` of every wanted vector; rows without qid count compared pairs.

    ``flagged`` is vec_id, e, wanted. ``fitted_on`` (vec_id, e) gives the pivots' sample, repeated rows or not.
    """
    base = flagged if fitted_on is None else fitted_on
    n = base.count()
    cells = Cells(sampled(base, n), n, per_cell, shard)
    trees = indexed(flagged, cells, k, factor)
    sent = flagged.sparkSession.sparkContext.broadcast(cells)

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for q, i, s, n in _frombuffers(b, {"hit_q": np.int64, "hit_id": np.int64, "hit_s": np.float64, "compared": int}):
                yield _hits(q, i, s, n)

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = sent.value
        held: tuple[int, Tree] | None = None
        for b in batches:
            kinds = {"shard": int, "ids": np.int64, "v": np.float32, "cells": np.float64, "nodes": np.float64, "q_ids": np.int64, "q_v": np.float32, "q_least": np.float64}
            for at, ids, v, rows, nodes, qid, qv, least in _frombuffers(b, kinds):
                if held is None or held[0] != at:
                    held = at, Tree(ids, v.reshape(len(ids), -1), rows.reshape(-1, 5), nodes.reshape(-1, 6), c.pivots)
                t = held[1]
                t.compared = 0
                q = unit(qv.reshape(len(qid), -1))
                found, sim = t.search(q, qid, c.bounds(q), k, least, factor)
                i, j = np.nonzero(found >= 0)
                yield _hits(qid[i], found[i, j], sim[i, j], t.compared)

    met = travelling(trees, cells, factor).join(trees.select("shard", "ids", "v", "cells", "nodes"), F.col("target") == F.col("shard"))
    far = met.select("shard", "ids", "v", "cells", "nodes", "q_ids", "q_v", "q_least").mapInArrow(others, _HITS)
    return trees.select("hit_q", "hit_id", "hit_s", "compared").mapInArrow(own, _HITS).unionByName(far)


def ranked(found: DataFrame, k: int = K) -> DataFrame:
    rank = F.row_number().over(W.partitionBy("qid").orderBy(F.desc("similarity"), "vec_id"))
    return found.where(F.col("qid").isNotNull()).drop("compared").withColumn("rank", rank).where(F.col("rank") <= k)


def neighbours(flagged: DataFrame, k: int = K, factor: float = FACTOR, fitted_on: DataFrame | None = None, **sizes) -> DataFrame:
    """``qid, vec_id, similarity, rank``: the ``k`` most similar other vectors of every wanted vector of ``flagged`` (vec_id, e, wanted).

    Exact with factor 1. Ties go by the smaller vec_id. Wanted vectors that are not usable have no rows; fewer than ``k`` others give fewer rows.
    """
    return ranked(hits(flagged, k, factor, fitted_on, **sizes), k)


def _raw(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "emb_cache").select("vec_id", F.col("embedding").alias("e"))


def _twentieth(spark: SparkSession, d: str) -> DataFrame:
    return last_vectors(table(spark, d, "emb_cache")).withColumn("wanted", F.col("vec_id") % 20 == 0)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """The pairs of every probe vector with its K most similar other vectors; smaller id first, each pair once."""
    probes = table(spark, d, "probe_vectors").select("vec_id", F.lit(True).alias("wanted")).where("vec_id is not null").distinct()
    v = last_vectors(table(spark, d, "emb_cache")).join(probes, "vec_id", "left").withColumn("wanted", F.coalesce("wanted", F.lit(False)))
    return neighbours(v, fitted_on=_raw(spark, d)).select(F.least("qid", "vec_id").alias("vec_a"), F.greatest("qid", "vec_id").alias("vec_b")).distinct()


def p3_similar(spark: SparkSession, d: str) -> DataFrame:
    """The K most similar other vectors of every usable vector whose vec_id is divisible by 20, against all vectors."""
    return neighbours(_twentieth(spark, d), fitted_on=_raw(spark, d)).select("qid", "vec_id", F.round("similarity", 6).alias("similarity"), "rank")


def p3_exact(spark: SparkSession, d: str) -> DataFrame:
    """The same with factor 1: the exact answer."""
    return neighbours(_twentieth(spark, d), factor=1.0, fitted_on=_raw(spark, d)).select("qid", "vec_id", F.round("similarity", 6).alias("similarity"), "rank")


def p3_report(spark: SparkSession, d: str) -> DataFrame:
    """Queries answered, and pairs compared for them, at the published factor."""
    h = hits(_twentieth(spark, d), fitted_on=_raw(spark, d))
    return h.agg(F.countDistinct("qid").alias("n_queries"), F.sum("compared").alias("n_compared"))


QUERIES = {"p3_found": p3_found, "p3_similar": p3_similar, "p3_exact": p3_exact, "p3_report": p3_report}
