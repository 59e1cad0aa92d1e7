"""Evaluation texts that leak into a training corpus (problem 8).

Latent semantic retrieval: passages of 24 words (12 apart) of every document are TF-IDF vectors over the words of the evaluation items;
a distributed randomised SVD of that matrix gives a latent space, in which document passages near an evaluation passage
become candidates. Candidates are checked on the whole document: the longest common run of words (the answer
check: does the item, or twelve words of it on end, stand there), and the longest common subsequence for paraphrases.

A passage and an item meet only if the passage holds as many words of the item as what is looked for needs (counted at once for all items of
a block, exact). Such pairs are compared in the latent space. Candidates for answers lose none there: a passage x that holds an
answer q has every word of q at least as often, so x.q >= |q|^2 in the weighted words; and x.q is at most the product of their latent vectors
plus the product of the lengths of what the latent space leaves out of each. Passages below |q|^2 by that bound hold no answer. Candidates
for paraphrases have a cosine of COSINE with an evaluation passage in the latent space, which is no bound.

Words outside the evaluation items weigh nothing in an evaluation passage, so the matrix needs their columns only; its statistics
come from all passages of all documents. Any run of 12 words lies wholly in one passage. A passage with fewer words
of the items than the shortest answer or paraphrase of one needs is not searched; no other passage is skipped.

Scale: items come in blocks of about BLOCK characters, each with a latent space of its own, so driver and tasks hold no more than one block's
words, passages and latent vectors, however many items there are. For every block the documents are kept as word numbers; the
passes over them need no shuffle and send per task one matrix of (words of the block) x (rank), added up by blocks of words.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavelake.session import cut, table

STRIDE = 12  # half a passage
ANSWER = 12  # consecutive words that make a leak
RANK = 64
EXTRA = 16  # more columns than the rank in the random projection
COSINE = 0.4
QUERY_STRIDE = 4
#: Share of an item's words in the longest common subsequence from which a document paraphrases it.
PARAPHRASE = 0.8
#: Characters, and number, of the evaluation items of one block.
BLOCK, MOST = 250_000, 1_000
#: Rows of the projected matrix that are added up together.
ROWS = 256

_WORD = re.compile(r"[^\W_]+")


def words(text: str | None) -> list[str]:
    """Runs of letters and digits; case and Unicode form make no difference. A null text has none."""
    if text is None or text != text:
        return []
    if text.isascii():
        return _WORD.findall(text.lower())
    return _WORD.findall(unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold()))


class Items:
    """The evaluation items as numbers of their words."""

    def __init__(self, rows: list[tuple[int, str | None]]):
        split = {i: words(t) for i, t in rows if i is not None}
        self.ids = sorted(i for i, w in split.items() if w)
        self.vocabulary = {w: k for k, w in enumerate(sorted({w for i in self.ids for w in split[i]}))}
        self.words = [np.array([self.vocabulary[w] for w in split[i]], np.int32) for i in self.ids]

    def passages(self) -> list[list[np.ndarray]]:
        """Per item the evaluation passages of up to ANSWER words, QUERY_STRIDE apart."""
        starts = lambda last: sorted({*range(0, last + 1, QUERY_STRIDE), last})
        return [[w[a : a + ANSWER] for a in starts(max(0, len(w) - ANSWER))] for w in self.words]

    def answers(self) -> list[np.ndarray]:
        """Per item every answer: ANSWER words on end, or all of a shorter one, padded with -1."""
        out = []
        for w in self.words:
            n = min(ANSWER, len(w))
            a = np.full((len(w) - n + 1, ANSWER), -1, np.int32)
            a[:, :n] = np.lib.stride_tricks.sliding_window_view(w, n)
            out.append(a)
        return out


def numbered(documents: DataFrame, items: Items) -> DataFrame:
    """``doc_id, words``: each document's words as packed numbers, -1 for a word of no item."""
    sent = documents.sparkSession.sparkContext.broadcast(items.vocabulary)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v = sent.value
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "words": [np.array([v.get(w, -1) for w in words(t)], np.int32).tobytes() for t in pdf["text"]]})

    return documents.select("doc_id", "text").mapInPandas(run, "doc_id bigint, words binary")


class Passages:
    """The passages of a batch of documents, as sums over half passages."""

    def __init__(self, packed: list[bytes]):
        self.docs = [np.frombuffer(b, np.int32) for b in packed]
        n = np.array([len(d) for d in self.docs], np.int64)
        halves = np.maximum(1, -(-n // STRIDE))
        first = np.cumsum(halves) - halves
        self.size = int(halves.sum())
        flat = np.concatenate(self.docs) if self.docs else np.zeros(0, np.int32)
        start = np.cumsum(n) - n
        pos = np.arange(len(flat)) - np.repeat(start, n)
        half = np.repeat(first, n) + pos // STRIDE
        keep = flat >= 0
        self.term, self.half = flat[keep], half[keep]
        self.doc_of = np.repeat(np.arange(len(self.docs)), halves)
        # A passage is a half and the next one of the same document; a document's last half begins none, unless alone.
        self.paired = np.zeros(self.size, bool)
        if self.size:
            self.paired[:-1] = self.doc_of[1:] == self.doc_of[:-1]
        self.begins = self.paired | (np.repeat(halves, halves) == 1)
        self.at = np.flatnonzero(np.r_[True, self.half[1:] != self.half[:-1]]) if len(self.half) else np.zeros(0, np.int64)
        self.ends = np.searchsorted(self.half, np.arange(self.size) + self.paired, "right")
        self.starts = np.searchsorted(self.half, np.arange(self.size), "left")

    def texts(self, halves: np.ndarray) -> np.ndarray:
        """The words of the passages that begin at ``halves``, padded with -1."""
        out = np.full((len(halves), 2 * STRIDE), -1, np.int32)
        first = np.searchsorted(self.doc_of, np.arange(len(self.docs)))
        for k, (h, d) in enumerate(zip(halves.tolist(), self.doc_of[halves].tolist())):
            a = (h - first[d]) * STRIDE
            w = self.docs[d][a : a + 2 * STRIDE]
            out[k, : len(w)] = w
        return out

    def sums(self, per_term: np.ndarray) -> np.ndarray:
        """Per passage (at its first half) the sum over its words of ``per_term``."""
        h = np.zeros((self.size, *per_term.shape[1:]), per_term.dtype)
        if len(self.at):
            h[self.half[self.at]] = np.add.reduceat(per_term[self.term], self.at, axis=0)
        out = h.copy()
        out[:-1][self.paired[:-1]] += h[1:][self.paired[:-1]]
        out[~self.begins] = 0
        return out

    def sums_at(self, halves: np.ndarray, per_term: np.ndarray) -> np.ndarray:
        """``sums`` of some passages only, all of which hold a word; their words lie side by side."""
        n = self.ends[halves] - self.starts[halves]
        at = np.cumsum(n) - n
        pos = np.arange(int(n.sum())) + np.repeat(self.starts[halves] - at, n)
        return np.add.reduceat(per_term[self.term[pos]], at, axis=0)

    def spread(self, per_passage: np.ndarray) -> np.ndarray:
        """Per half the sum over the passages that hold it."""
        out = per_passage.copy()
        out[1:][self.paired[:-1]] += per_passage[:-1][self.paired[:-1]]
        return out


#: Documents whose sums stay in a processor's cache.
FEW = 256


def _few(batches: Iterator[pd.DataFrame]) -> Iterator[Passages]:
    for pdf in batches:
        packed = list(pdf["words"])
        for k in range(0, len(packed), FEW):
            yield Passages(packed[k : k + FEW])


def idf(docs: DataFrame, size: int) -> np.ndarray:
    """Inverse passage frequency of every word of the items, over all passages of all documents."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, df = 0, np.zeros(size, np.int64)
        for p in _few(batches):
            n += int(p.begins.sum())
            if len(p.term):
                pairs = np.unique(np.concatenate([p.half * size + p.term, (p.half[(b := p.half > 0)] - 1) * size + p.term[b]]))
                h, t = pairs // size, pairs % size
                own = np.unique(p.half * size + p.term)
                ok = p.begins[h] & (p.paired[h] | np.isin(pairs, own))
                df += np.bincount(t[ok], minlength=size)
        yield pd.DataFrame({"term": np.r_[-1, np.arange(size)], "n": np.r_[n, df]})

    got = docs.select("words").mapInPandas(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).toPandas().set_index("term")["n"]
    df = got.reindex(range(size)).fillna(0).to_numpy(float)
    return np.log((1.0 + float(got.get(-1, 0))) / (1.0 + df)) + 1.0


def project(docs: DataFrame, weight: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """A'(A basis) for the matrix A of all passages, rows scaled to length one."""
    sent = docs.sparkSession.sparkContext.broadcast((weight.astype(np.float32), (weight[:, None] * basis).astype(np.float32)))
    terms, cols = basis.shape

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w, wb = sent.value
        total = np.zeros((terms, cols), np.float64)
        for p in _few(batches):
            if not len(p.term):
                continue
            norm = p.sums(w * w)
            y = p.sums(wb) / np.maximum(norm, 1e-12)[:, None]
            y = p.spread(y)
            order = np.argsort(p.term, kind="stable")
            t = p.term[order]
            at = np.flatnonzero(np.r_[True, t[1:] != t[:-1]])
            total[t[at]] += w[t[at]][:, None] * np.add.reduceat(y[p.half[order]], at, axis=0)
        for k in range(0, terms, ROWS):
            yield pd.DataFrame({"k": [k], "m": [total[k : k + ROWS].tobytes()]})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"k": pdf["k"][:1], "m": [sum(np.frombuffer(m, np.float64) for m in pdf["m"]).tobytes()]})

    parts = docs.select("words").mapInPandas(run, "k bigint, m binary").groupBy("k").applyInPandas(add, "k bigint, m binary").orderBy("k").collect()
    return np.vstack([np.frombuffer(r["m"], np.float64).reshape(-1, cols) for r in parts]) if parts else np.zeros((terms, cols))


def latent_space(docs: DataFrame, weight: np.ndarray, rank: int = RANK) -> np.ndarray:
    """Words x rank: the leading right singular vectors of the passage matrix, by randomised subspace iteration."""
    terms = len(weight)
    cols = min(terms, rank + EXTRA)
    q = np.linalg.qr(np.random.default_rng(5).standard_normal((terms, cols)))[0]
    q = np.linalg.qr(project(docs, weight, q))[0]
    b = project(docs, weight, q)
    values, vectors = np.linalg.eigh((q.T @ b + b.T @ q) / 2)
    return q @ vectors[:, np.argsort(-values)[:rank]]


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


#: Rounding that the bound on answers allows for, as a part of |q|^2.
SLACK = 1e-3


def squares(texts: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Squared length of each text's vector of weighted word counts; texts are padded with -1."""
    w = np.where(texts >= 0, weight[texts] ** 2, 0.0)
    out = np.zeros(len(texts))
    for j in range(texts.shape[1]):
        out += w[:, j] * (texts == texts[:, j : j + 1]).sum(1)
    return out


def with_rest(latent: np.ndarray, square: np.ndarray) -> np.ndarray:
    """Latent vectors with the length of what the latent space leaves out of each as one more column."""
    return np.column_stack([latent, np.sqrt(np.maximum(square - (latent**2).sum(1), 0.0))])


def longest_run(doc: np.ndarray, item: np.ndarray) -> int:
    """Longest run of words that stands in both."""
    if not len(doc) or not len(item):
        return 0
    run = np.zeros(len(doc) + 1, np.int32)
    best = 0
    for w in item:
        run[1:] = np.where(doc == w, run[:-1] + 1, 0)
        best = max(best, int(run.max()))
    return best


def common_subsequence(doc: np.ndarray, item: np.ndarray) -> int:
    """Length of the longest common subsequence, by the bit-parallel recurrence over the words of the document."""
    masks: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        masks[w] = masks.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    v = full
    for w in doc.tolist():
        m = masks.get(w)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(item) - v.bit_count()


def shared(docs: list[np.ndarray], item: np.ndarray) -> list[int]:
    """How many words of the item each of some texts holds, each as often as it stands in both: bounds on the common subsequences."""
    w, n = np.unique(item, return_counts=True)
    out = []
    for d in docs:
        k = np.minimum(np.searchsorted(w, d), len(w) - 1)
        out.append(int(np.minimum(np.bincount(k[w[k] == d], minlength=len(w)), n).sum()))
    return out


def stretches(doc: np.ndarray, starts: list[int], size: int) -> list[np.ndarray]:
    """The stretch of ``size`` words before and after each passage that begins at one of ``starts``.

    Stretches that touch stay apart, as words of an item that lie scattered over a long text are no paraphrase of it.
    """
    return [doc[max(0, a - size) : a + 2 * STRIDE + size] for a in starts]


def bulk_checks(passages: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Longest run and longest common subsequence of many passages (n, 24) and items (n, longest), all pairs at once.

    Both are padded, passages with -1 and items with -2, which equal nothing. The subsequence runs on bit vectors of the passage.
    """
    n, width = passages.shape
    run = np.zeros((n, width + 1), np.int8)
    best = np.zeros(n, np.int8)
    powers = np.uint64(1) << np.arange(width, dtype=np.uint64)
    full = np.uint64((1 << width) - 1)
    v = np.full(n, full, np.uint64)
    for j in range(items.shape[1]):
        eq = passages == items[:, j : j + 1]
        run[:, 1:] = (run[:, :-1] + 1) * eq
        np.maximum(best, run.max(1), out=best)
        u = v & (eq @ powers)
        v = ((v + u) | (v - u)) & full
    return best.astype(np.int64), width - np.bitwise_count(v).astype(np.int64)


class Search:
    """The search for the items of one block in batches of documents."""

    def __init__(self, it: Items, weight: np.ndarray, latent: np.ndarray, cosine: float, paraphrases: bool):
        self.ids, self.words, self.weight, self.cosine, self.paraphrases = it.ids, it.words, weight, cosine, paraphrases
        self.space = (weight[:, None] * latent).astype(np.float32)
        self.lengths = np.array([len(w) for w in it.words])
        self.answer = np.minimum(ANSWER, self.lengths)
        # An answer needs all its words in one passage, a paraphrase of it a share of them.
        self.share = PARAPHRASE if paraphrases else 1.0
        self.need = np.ceil(self.share * self.answer - 1e-9).astype(np.int64)
        self.has = np.zeros((len(weight), len(it.words)), np.uint8)  # words x items
        self.padded = np.full((len(it.words), self.lengths.max()), -2, np.int32)
        for j, w in enumerate(it.words):
            self.has[w, j] = 1
            self.padded[j, : len(w)] = w
        self.queries = [_unit(np.array([self.space[p].sum(0) for p in of])).astype(np.float32) for of in it.passages()]
        self.bounds = []
        for wide in it.answers():
            square = squares(wide, weight)
            inside = np.where(wide[..., None] >= 0, self.space[wide], 0).sum(1)
            self.bounds.append((with_rest(inside, square) / square[:, None]).astype(np.float32))

    def pairs(self, p: Passages) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(half, item, cosine)`` of the passages that may hold an answer or a paraphrase of an item."""
        inside = p.sums(np.ones(len(self.space), np.int32))
        at = np.flatnonzero(p.begins & (inside >= self.need.min()))
        i, j = np.nonzero(p.sums_at(at, self.has) >= self.need) if len(at) else (at, at)
        if not len(i):
            return (np.zeros(0, np.int64),) * 2 + (np.zeros(0),)
        used, i = np.unique(i, return_inverse=True)
        at = at[used]
        latent = p.sums_at(at, self.space)
        unit_, x = _unit(latent), with_rest(latent, squares(p.texts(at), self.weight)).astype(np.float32)
        order = np.argsort(j, kind="stable")
        i, j = i[order], j[order]
        cos, near = np.empty(len(i)), np.empty(len(i), bool)
        for mine in np.split(np.arange(len(i)), np.flatnonzero(np.diff(j)) + 1):
            k = j[mine[0]]
            cos[mine] = (unit_[i[mine]] @ self.queries[k].T).max(1)
            near[mine] = (x[i[mine]] @ self.bounds[k].T).max(1) >= 1 - SLACK
        keep = near | (cos >= self.cosine) if self.paraphrases else near
        return at[i[keep]], j[keep], cos[keep]

    def _held(self, p: Passages, docs: np.ndarray) -> np.ndarray:
        """How many words of every item stand before each half, counting some documents only."""
        mine = np.zeros(len(p.docs), bool)
        mine[docs] = True
        keep = mine[p.doc_of[p.half]]
        half, term = p.half[keep], p.term[keep]
        out = np.zeros((p.size + 1, self.has.shape[1]), np.int32)
        if len(half):
            at = np.flatnonzero(np.r_[True, half[1:] != half[:-1]])
            out[half[at] + 1] = np.add.reduceat(self.has[term], at, axis=0)
        return np.cumsum(out, axis=0, out=out)

    def batch(self, doc_ids: np.ndarray, packed: list[bytes]) -> list[tuple]:
        p = Passages(packed)
        half, item, cos = self.pairs(p)
        order = np.argsort(self.lengths[item], kind="stable")  # items of like length share a step
        half, item, cos = half[order], item[order], cos[order]
        hit, answer = np.zeros(len(item), bool), np.zeros(len(item), bool)
        for k in range(0, len(item), 5_000):
            at = slice(k, k + 5_000)
            run, sub = bulk_checks(p.texts(half[at]), self.padded[item[at], : self.lengths[item[at]].max()])
            answer[at] = run >= self.answer[item[at]]
            hit[at] = answer[at] | (sub >= self.share * self.answer[item[at]])
        if self.paraphrases:
            # Around a paraphrase the halves that its stretch touches hold words of the item as often as all of it needs.
            held = self._held(p, p.doc_of[half[hit & ~answer]])
            first = np.searchsorted(p.doc_of, np.arange(len(p.docs) + 1))
            d, reach = p.doc_of[half], -(-self.lengths[item] // STRIDE)
            lo, hi = np.maximum(half - reach, first[d]), np.minimum(half + 2 + reach, first[d + 1])
            hit &= answer | (held[hi, item] - held[lo, item] >= PARAPHRASE * self.lengths[item])
        else:
            hit &= answer
        best: dict[tuple[int, int], tuple[bool, float, int]] = {}
        hits: dict[tuple[int, int], list[int]] = {}
        for d, j, c, h, r in zip(p.doc_of[half[hit]].tolist(), item[hit].tolist(), cos[hit].tolist(), half[hit].tolist(), answer[hit].tolist()):
            if (d, j) not in best or (r, c) > best[d, j][:2]:
                best[d, j] = (r, c, h)
            hits.setdefault((d, j), []).append(h)
        first = np.searchsorted(p.doc_of, np.arange(len(p.docs)))
        out = []
        for (d, j), (answered, c, h) in best.items():
            w, doc = self.words[j], p.docs[d]
            starts = np.array([h] if answered else hits[d, j]) * STRIDE - first[d] * STRIDE
            near = stretches(doc, starts.tolist(), len(w))
            sub = 0
            for x, most in zip(near, [len(w)] if answered else shared(near, w)):
                # Stretches with too few words of the item for a paraphrase of all of it, or for a longer one, are not searched.
                if most > sub and (answered or most >= PARAPHRASE * len(w)):
                    sub = max(sub, common_subsequence(x, w))
            if answered or sub >= PARAPHRASE * len(w):
                out.append((self.ids[j], doc_ids[d], c, longest_run(doc, w), sub, len(w)))
        return out


_LEAKS = "item_id bigint, doc_id bigint, cosine double, run bigint, subsequence bigint, n_words bigint"


def _leaks_of(documents: DataFrame, it: Items, cosine: float, rank: int, paraphrases: bool) -> DataFrame:
    docs = cut(numbered(documents, it))
    weight = idf(docs, len(it.vocabulary))
    sent = documents.sparkSession.sparkContext.broadcast((it, weight, latent_space(docs, weight, rank).astype(np.float32)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        search = Search(*sent.value, cosine, paraphrases)
        for pdf in batches:
            ids, packed = pdf["doc_id"].to_numpy(), list(pdf["words"])
            out = [x for k in range(0, len(packed), FEW) for x in search.batch(ids[k : k + FEW], packed[k : k + FEW])]
            yield pd.DataFrame(out, columns=[c.split()[0] for c in _LEAKS.split(", ")]).astype({"item_id": "int64", "doc_id": "int64", "cosine": float, "run": "int64", "subsequence": "int64", "n_words": "int64"})

    return docs.mapInPandas(run, _LEAKS)


def leaks(documents: DataFrame, items: DataFrame, cosine: float = COSINE, rank: int = RANK, paraphrases: bool = True, block: int = BLOCK) -> DataFrame:
    """``item_id, doc_id, cosine, run, subsequence, n_words``: every document that holds an answer of an item, or (with
    ``paraphrases``) a paraphrase of all of it.

    ``run`` is the longest run of the item's words in the document, ``subsequence`` the longest common subsequence within
    the stretch of the document around any passage found (with an answer, the best one), ``n_words`` the item's length. Null
    and empty texts leak nothing. Of repeated item_ids the greatest text counts. Items are taken in blocks by the hash of their ids.
    """
    own = items.where(F.col("item_id").isNotNull()).groupBy("item_id").agg(F.max("text").alias("text"))
    size, n = own.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)), F.count(F.lit(1))).first()
    blocks = max(1, -(-size // block), -(-n // MOST))
    out = documents.sparkSession.createDataFrame([], _LEAKS)
    for k in range(blocks):
        it = Items([tuple(r) for r in own.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k).collect()])  # about ``block`` characters
        if it.ids:
            out = out.unionByName(_leaks_of(documents, it, cosine, rank, paraphrases))
    return out


def _leaks(spark: SparkSession, d: str, **options) -> DataFrame:
    return leaks(table(spark, d, "documents"), table(spark, d, "eval_items"), **options)


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Items and the documents that hold at least ANSWER consecutive words of them, or all of a shorter item; paraphrases are searched too and left out here."""
    return _leaks(spark, d).where(F.col("run") >= F.least(F.lit(ANSWER), "n_words")).select("item_id", "doc_id")


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    """Leaked items: how many documents hold all of the item, a passage of it, or a paraphrase."""
    x = _leaks(spark, d)
    kind = F.when(F.col("run") == F.col("n_words"), "whole").when(F.col("run") >= F.least(F.lit(ANSWER), "n_words"), "passage").when(F.col("subsequence") >= F.lit(PARAPHRASE) * F.col("n_words"), "paraphrase")
    return x.withColumn("kind", kind).where(F.col("kind").isNotNull()).groupBy("item_id", "kind").agg(F.count(F.lit(1)).alias("n_documents"))


QUERIES = {"p8_found": p8_found, "p8_report": p8_report}
