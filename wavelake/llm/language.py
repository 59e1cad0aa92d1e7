"""Languages of documents and of the segments of mixed documents (problem 10).

Every language has a unigram model over the pieces of one fixed public vocabulary. The probability of a word is the
sum over all its segmentations into pieces, by the forward algorithm; that of a sentence is the product over its words.
Pieces of the vocabulary never span white space, so words are scored by themselves and remembered per worker:
each distinct word is summed once, for all languages at once.

The models are fitted by expectation-maximisation (forward and backward sums) on a bounded sample of labelled texts,
SAMPLE per language, and refitted once on the sentences that the first models place in the language of their label. All
documents are then scored whole, each by itself; nothing but the models (a table of the vocabulary's size) is sent around.

The set of languages is open: one more model, OTHER, mixes the mean of all languages with an even one over the vocabulary. A text of another
language or script is cut into pieces that are common everywhere or nowhere, which that model explains best; so it comes out as
OTHER rather than as the nearest of the known ones.
"""

from __future__ import annotations

import re
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wavelake.llm.mixing import tokenizer
from wavelake.session import table

# The languages, and the spellings of their labels besides the two-letter code.
LANGUAGES = ("de", "en", "es", "fr", "nl", "pt", "ru", "zh")
SPELLINGS = {
    "de": ("deu", "ger", "german"),
    "en": ("eng", "english"),
    "es": ("spa", "spanish"),
    "fr": ("fra", "fre", "french"),
    "nl": ("nld", "dut", "dutch"),
    "pt": ("por", "portuguese"),
    "ru": ("rus", "russian"),
    "zh": ("zho", "chi", "chinese"),
}
#: Labelled texts per language on which the models are fitted.
SAMPLE = 600
ROUNDS = 2
#: Added to every piece's count, so that no piece of the vocabulary is impossible.
SMOOTH = 0.1
#: Share of a text's sentences from which a language is in the text.
SHARE = 0.2
#: What a sentence of none of the languages is called, the even part of its model, and its prior against each of the languages.
OTHER = "other"
EVEN = 0.6
RARE = 0.2
NAMES = (*LANGUAGES, OTHER)
#: Words remembered per worker, and characters that are split together.
MEMORY = 300_000
CHARS = 4_000_000

_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
#: Words, ends of sentences (1) and of texts (0).
_UNIT = re.compile(rf"{_WORD.pattern}|[\x00\x01]")
_CONTROL = {0: " ", 1: " "}


def _ascii(characters: str) -> np.ndarray:
    """Which of the ASCII characters (and, last, of all others) are listed."""
    out = np.zeros(129, bool)
    out[[ord(c) for c in characters]] = True
    return out


_STOP, _CLOSE, _SPACE = _ascii(".!?"), _ascii("\"')]"), _ascii("\x00\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f ")
_SPACE[128] = True
_FULL_STOPS = [ord(c) for c in "。！？"]
_SIGNS, _LOWER, _UPPER, _DIGIT = _ascii("=_\\@"), _ascii("abcdefghijklmnopqrstuvwxyz"), _ascii("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _ascii("0123456789")
_PRINTED = _ascii("".join(map(chr, range(33, 127))))


def label_language(label: Column) -> Column:
    """The two-letter code a label stands for (any case, with or without region, three letters, English name); else null."""
    base = F.lower(F.trim(F.regexp_replace(label, r"^\s+|\s+$", "")))
    base = F.regexp_extract(base, r"^([a-z]+)(?:[-_][a-z0-9]+)*$", 1)
    out = F.lit(None).cast("string")
    for code, names in SPELLINGS.items():
        out = F.when(base.isin(code, *names), F.lit(code)).otherwise(out)
    return out


def _follows(code: np.ndarray, text: str) -> np.ndarray:
    """Where ``text`` begins."""
    hit = np.ones(len(code), bool)
    for k, c in enumerate(text):
        hit[: len(code) - k] &= code[k:] == ord(c)
        hit[len(code) - k :] = False
    return hit


def _technical(code: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Characters of tokens (runs of printed ASCII characters) that no language is read from: settings, file names, numbers with units, addresses."""
    letter, digit, small = (_LOWER | _UPPER)[kind], _DIGIT[kind], (_LOWER | _DIGIT)[kind]
    mark = _SIGNS[kind] | _follows(code, "://") | _follows(code, "www.")
    mark[:-1] |= (letter[:-1] & digit[1:]) | (digit[:-1] & letter[1:])
    # A dot and two to four small letters or digits, after which the word ends.
    dot = np.flatnonzero(code[:-1] == ord("."))
    stop = np.append(np.flatnonzero(~small), len(code))
    end = stop[np.searchsorted(stop, dot + 1)]
    after = kind[np.minimum(end, len(code) - 1)]
    mark[dot[(end - dot >= 3) & (end - dot <= 5) & ~(_UPPER[after] | (code[np.minimum(end, len(code) - 1)] == ord("_")))]] = True
    printed = _PRINTED[kind]
    first = printed & ~np.r_[False, printed[:-1]]
    token = np.cumsum(first)  # of a printed character
    return printed & (np.bincount(token[mark & printed], minlength=int(token[-1]) + 1) > 0)[token]


def _ends(code: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Positions behind the sentences: behind a run of full stops and closing quotes that a blank, an end or another script follows (anything, if
    the script is written without blanks), and behind line ends."""
    wide = np.isin(code, _FULL_STOPS)
    stop = _STOP[kind] | wide | (code == ord("…"))
    run = stop | _CLOSE[kind] | (code == ord("”")) | (code == ord("’"))
    edge = np.diff(np.r_[0, run.astype(np.int8), 0])
    a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    stops, wides = np.r_[0, np.cumsum(stop)], np.r_[0, np.cumsum(wide)]
    ends = b[(stops[b] > stops[a]) & (_SPACE[kind[np.minimum(b, len(kind) - 1)]] | (wides[b] > wides[a]))]
    return np.unique(np.r_[ends, np.flatnonzero(code == ord("\n")) + 1])


def split(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """``(units, text, begin, end)`` of all sentences of some texts, one after another.

    Sentences end at a full stop, its kin, or a line end; in technical tokens nothing ends and no word is read. ``units`` are their words (runs of
    letters in one case and Unicode form), each sentence followed by a mark; ``begin`` and ``end`` are its characters in the text.
    """
    big = "\x00".join([t.translate(_CONTROL) if "\x00" in t or "\x01" in t else t for t in texts]) + "\x00"
    code = np.frombuffer(big.encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    kind = np.minimum(code, 128)
    blank = _technical(code, kind)
    code[blank], kind[blank] = ord(" "), ord(" ")
    ends, last = _ends(code, kind), np.flatnonzero(code == 0)
    at = np.r_[ends, last]
    order = np.lexsort((np.arange(len(at)) >= len(ends), at))
    at, closes = at[order], order >= len(ends)
    text = np.cumsum(closes) - closes
    end = at - np.r_[0, last[:-1] + 1][text]
    begin = np.where(np.r_[True, closes[:-1]], 0, np.r_[0, end[:-1]])
    big = np.insert(code, ends, 1).tobytes().decode("utf-32-le", "surrogatepass")
    units = _UNIT.findall(big.lower() if big.isascii() else unicodedata.normalize("NFKC", big).casefold())
    return units, text, begin, end


def sentences(text: str) -> list[tuple[int, int, list[str]]]:
    """Begin, end and words of the sentences of a text that have words."""
    units, _, begin, end = split([text])
    at = np.flatnonzero([u < "\x02" for u in units])
    return [(int(a), int(b), units[i:j]) for a, b, i, j in zip(begin, end, np.r_[0, at[:-1] + 1], at) if j > i]


class Lattice:
    """All pieces of the vocabulary that a word can be cut into."""

    def __init__(self, folder: str | None = None):
        sp = tokenizer(*([folder] if folder else []))
        self.size = sp.get_piece_size()
        self.ids = {sp.id_to_piece(i): i for i in range(self.size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))}
        self.bytes = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        self.longest = max(map(len, self.ids))
        self.chars = {c for p in self.ids for c in p if len(p) == 1}

    def edges(self, word: str) -> list[tuple[int, list[int], list[list[int]]]]:
        """Per end position: the starts, and the pieces (a run of byte pieces for a character outside the vocabulary)."""
        w = "▁" + word
        out = []
        for end in range(1, len(w) + 1):
            starts, pieces = [], []
            for start in range(max(0, end - self.longest), end):
                i = self.ids.get(w[start:end])
                if i is not None:
                    starts.append(start)
                    pieces.append([i])
            c = w[end - 1]
            if c not in self.chars:
                starts.append(end - 1)
                pieces.append([int(self.bytes[b]) for b in c.encode("utf-8", "replace")])
            out.append((end, starts, pieces))
        return out


def forward(edges, logp: np.ndarray) -> np.ndarray:
    """Log probability of a word in every language: the sum over all segmentations. ``logp`` is pieces x languages."""
    alpha = np.full((len(edges) + 1, logp.shape[1]), -np.inf)
    alpha[0] = 0.0
    for end, starts, pieces in edges:
        x = np.array([alpha[s] + (logp[p[0]] if len(p) == 1 else logp[p].sum(0)) for s, p in zip(starts, pieces)])
        top = x.max(0)
        alpha[end] = top + np.log(np.exp(x - top).sum(0))
    return alpha[-1]


def expected(edges, p: list[float], weight: float, into: list[float]) -> None:
    """Adds the expected piece counts of a word of one language, by forward and backward sums over plain probabilities.

    Partial sums are scaled at every position, so that words of any length keep their precision.
    """
    n = len(edges)
    alpha, scale = [1.0] + [0.0] * n, [1.0] * (n + 1)
    arcs = []
    for end, starts, pieces in edges:
        total, row = 0.0, []
        for s, piece in zip(starts, pieces):
            v = 1.0
            for i in piece:
                v *= p[i]
            # alpha[s] is scaled up to s only.
            for k in range(s + 1, end):
                v *= scale[k]
            row.append((s, end, piece, v))
            total += alpha[s] * v
        scale[end] = 1.0 / total
        alpha[end] = 1.0
        arcs += [(s, e, piece, v * scale[end]) for s, e, piece, v in row]
    beta = [0.0] * n + [1.0]
    for s, e, piece, v in reversed(arcs):
        beta[s] += v * beta[e]
    for s, e, piece, v in arcs:
        g = weight * alpha[s] * v * beta[e]
        for i in piece:
            into[i] += g


def _folded(word: str) -> str:
    return unicodedata.normalize("NFKD", word).encode("ascii", "ignore").decode()


def fit(samples: dict[str, Counter], lattice: Lattice, rounds: int = ROUNDS) -> np.ndarray:
    """Log piece probabilities, pieces x languages, from word counts per language.

    Accented words count a little in their folded spelling too, as texts come folded to ASCII.
    """
    known: dict[str, list] = {}
    out = np.zeros((lattice.size, len(LANGUAGES)))
    for k, lang in enumerate(LANGUAGES):
        counts = Counter(samples.get(lang, {}))
        for w, c in list(counts.items()):
            f = _folded(w)
            if f and f != w:
                counts[f] += 0.1 * c
        logp = np.full(lattice.size, -np.log(lattice.size))
        for _ in range(rounds):
            into, p = [SMOOTH] * lattice.size, np.exp(logp).tolist()
            for w, c in counts.items():
                if w not in known:
                    known[w] = lattice.edges(w)
                expected(known[w], p, c, into)
            logp = np.log(np.array(into) / sum(into))
        out[:, k] = logp
    return out


def with_other(logp: np.ndarray) -> np.ndarray:
    """The languages' models and, as the last column, that of any other language."""
    return np.column_stack([logp, np.log(EVEN / len(logp) + (1 - EVEN) * np.exp(logp).mean(1))])


class Scorer:
    """Scores texts in batches; the words' probabilities lie in one table that grows as new words are met."""

    def __init__(self, logp: np.ndarray, lattice: Lattice):
        self.logp, self.lattice = logp, lattice
        # Plain probabilities; the last row is the piece that there is not. Characters outside the vocabulary get rows behind it.
        self.p = np.concatenate([np.exp(logp), np.zeros((1, logp.shape[1]))])
        self.none = len(logp)
        self.chars: dict[str, int] = {}
        self._forget()

    def _forget(self) -> None:
        # The marks of ends are words that weigh nothing.
        self.seen: dict[str, int] = {"\x00": 0, "\x01": 1}
        self.table = np.zeros((1024, self.p.shape[1]))

    def _characters(self, words: list[str]) -> None:
        """Rows for characters outside the vocabulary, by their bytes."""
        new = sorted(set().union(*words) - self.lattice.chars - self.chars.keys())
        if new:
            rows = [np.exp(self.logp[self.lattice.bytes[list(c.encode("utf-8", "replace"))]].sum(0)) for c in new]
            self.chars.update((c, len(self.p) + k) for k, c in enumerate(new))
            self.p = np.concatenate([self.p, np.array(rows)])

    def _together(self, same: list[str]) -> np.ndarray:
        """The forward sums of words of one length, position by position for all of them at once, as logarithms.

        Sums are plain; where one gets small, it and those before it that are still needed are scaled up together.
        """
        n, size = len(same), len(same[0]) + 1
        spans = min(size, self.lattice.longest)
        arcs = np.full((n, size, spans), self.none, np.int64)
        get, chars = self.lattice.ids.get, self.chars
        for r, w in enumerate(same):
            t = "▁" + w
            row = arcs[r]
            for end in range(1, size + 1):
                for start in range(max(0, end - spans), end):
                    k = get(t[start:end])
                    if k is not None:
                        row[end - 1, end - start - 1] = k
                k = chars.get(t[end - 1])
                if k is not None:
                    row[end - 1, 0] = k
        alpha = np.zeros((size + 1, n, self.p.shape[1]))
        alpha[0] = 1.0
        scaled = np.zeros(alpha.shape[1:])
        for end in range(1, size + 1):
            for span in range(1, min(end, spans) + 1):
                alpha[end] += alpha[end - span] * self.p[arcs[:, end - 1, span - 1]]
            small = alpha[end] < 1e-60
            if small.any():
                window = alpha[max(0, end - spans) : end + 1]
                # What would leave the range lies before a character outside the vocabulary, which no longer piece spans.
                window[:, small] = np.minimum(window[:, small] * 1e60, 1e300)
                scaled += small
        return np.log(alpha[size]) - scaled * np.log(1e60)

    def _learn(self, new: list[str]) -> None:
        self._characters(new)
        by_length: dict[int, list[str]] = {}
        for w in new:
            by_length.setdefault(len(w), []).append(w)
        for size, every in by_length.items():
            step = max(1, 2_000_000 // ((size + 1) * self.lattice.longest))  # words whose lattices fit side by side
            for a in range(0, len(every), step):
                same = every[a : a + step]
                k = len(self.seen)
                while k + len(same) > len(self.table):
                    self.table = np.concatenate([self.table, np.zeros_like(self.table)])
                self.table[k : k + len(same)] = self._together(same)
                for w in same:
                    self.seen[w] = len(self.seen)

    def rows(self, units: list[str]) -> np.ndarray:
        """The rows of the table that hold the units."""
        if len(self.seen) > MEMORY:
            self._forget()
        codes, distinct = pd.factorize(np.array(units, object))
        new = [w for w in distinct if w not in self.seen]
        if new:
            self._learn(new)
        return np.fromiter(map(self.seen.__getitem__, distinct), np.int64, len(distinct))[codes]

    def words(self, sentences_: list[list[str]]) -> np.ndarray:
        """Log probabilities of sentences (each with a word or more), per language."""
        n = np.array([len(s) for s in sentences_])
        rows = self.rows([w for s in sentences_ for w in s])
        return np.add.reduceat(self.table[rows], np.cumsum(n) - n, axis=0) if len(n) else np.zeros((0, self.p.shape[1]))

    def texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``(text, begin, end, probabilities)`` of the sentences with words, text after text.

        The sentences of a text share a prior over languages, fitted to the text, so that a sentence that says little by
        itself goes with the rest.
        """
        size = np.cumsum([len(t) for t in texts])
        parts = []
        for k in np.unique(size // CHARS) if len(texts) else ():
            mine = np.flatnonzero(size // CHARS == k)
            units, text, begin, end = split([texts[i] for i in mine])
            rows = self.rows(units)
            at = np.flatnonzero(rows < 2)
            full = np.diff(np.r_[-1, at]) > 1
            # A sentence's mark weighs nothing, so its sum may include it.
            s = np.add.reduceat(self.table[rows], np.r_[0, at[:-1] + 1], axis=0)[full]
            parts.append((mine[text[full]], begin[full], end[full], s))
        if not parts:
            return (np.zeros(0, np.int64),) * 3 + (np.zeros((0, self.p.shape[1])),)
        of, begin, end, s = (np.concatenate(x) for x in zip(*parts))
        if not len(of):
            return of, begin, end, s
        s[:, len(LANGUAGES) :] += np.log(RARE)
        s = s - s.max(1, keepdims=True)
        at = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        n = np.diff(np.r_[at, len(of)])
        place = np.repeat(np.arange(len(at)), n)
        prior = np.full((len(at), s.shape[1]), 1 / s.shape[1])
        for _ in range(8):
            x = s + np.log(prior)[place]
            x = np.exp(x - x.max(1, keepdims=True))
            x /= x.sum(1, keepdims=True)
            prior = (np.add.reduceat(x, at, axis=0) + 0.01) / (n[:, None] + 0.01 * s.shape[1])
        return of, begin, end, x


def labelled_sample(documents: DataFrame, per_language: int = SAMPLE) -> pd.DataFrame:
    """At most about ``per_language`` labelled texts of each language, by the hash of their doc_id.

    The first pass reads the labels only; the share it gives selects the texts in the second.
    """
    named = documents.select("doc_id", label_language(F.col("lang")).alias("code"), "text").where(F.col("code").isNotNull())
    counts = {r["code"]: r["n"] for r in named.groupBy("code").agg(F.count(F.lit(1)).alias("n")).collect()}
    part = F.lit(0.0)
    for code, n in counts.items():
        part = F.when(F.col("code") == code, F.lit(min(1.0, per_language / n))).otherwise(part)
    draw = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1_000_000)) < part * 1_000_000
    return named.where(draw & F.col("text").isNotNull()).select("code", "text").limit(2 * per_language * len(LANGUAGES)).toPandas()


def train(sample: pd.DataFrame, lattice: Lattice | None = None) -> np.ndarray:
    """Models from labelled texts: fitted, refitted on the sentences that agree with their label, and the model of other languages."""
    lattice = lattice or Lattice()
    labelled = [(c, w) for c, t in zip(sample["code"], sample["text"]) for _, _, w in sentences(t)]
    counts: dict[str, Counter] = {c: Counter() for c in LANGUAGES}
    for c, w in labelled:
        counts[c].update(w)
    first = Scorer(fit(counts, lattice, 1), lattice).words([w for _, w in labelled])
    counts = {c: Counter() for c in LANGUAGES}
    for (c, w), k in zip(labelled, first.argmax(1).tolist() if len(labelled) else []):
        if LANGUAGES[k] == c:
            counts[c].update(w)
    return with_other(fit(counts, lattice))


_scorers: dict[str, Scorer] = {}


def _scorer(tag: str, sent) -> Scorer:
    """The models of one query, kept by the worker with the words it has scored."""
    if tag not in _scorers:
        _scorers.clear()
        _scorers[tag] = Scorer(sent.value, Lattice())
    return _scorers[tag]


_SEGMENTS = "doc_id bigint, label string, segment bigint, from_char bigint, to_char bigint, n_sentences bigint, language string, confidence double"


def segments(documents: DataFrame, logp: np.ndarray | None = None) -> DataFrame:
    """Consecutive sentences of one language (or OTHER), in order, with the mean probability of that language.

    A text without letters has one segment without language and confidence 0; null and blank texts have none.
    """
    tag = uuid.uuid4().hex
    sent = documents.sparkSession.sparkContext.broadcast(train(labelled_sample(documents)) if logp is None else logp)
    names = np.array([*NAMES, None], object)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = _scorer(tag, sent)
        for pdf in batches:
            texts = pdf["text"].tolist()
            of, begin, end, p = scorer.texts(texts)
            best, top = (p.argmax(1), p.max(1)) if len(p) else (of, np.zeros(0))
            first = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]) | (best[1:] != best[:-1])]) if len(of) else of
            size = np.diff(np.r_[first, len(of)])
            doc = of[first]
            head = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if len(doc) else doc
            number = np.arange(len(doc)) - np.repeat(head, np.diff(np.r_[head, len(doc)]))
            mean = np.add.reduceat(top, first) / size if len(first) else np.zeros(0)
            # Texts without a sentence that has words.
            bare = np.setdiff1d(np.arange(len(texts)), doc)
            zero = np.zeros(len(bare), np.int64)
            row = np.r_[doc, bare]
            yield pd.DataFrame(
                {
                    "doc_id": pdf["doc_id"].to_numpy()[row],
                    "label": pdf["label"].to_numpy()[row],
                    "segment": np.r_[number, zero],
                    "from_char": np.r_[begin[first], zero],
                    "to_char": np.r_[end[first + size - 1], np.array([len(texts[i]) for i in bare], np.int64)],
                    "n_sentences": np.r_[size, zero],
                    "language": names[np.r_[best[first], np.full(len(bare), -1)]],
                    "confidence": np.r_[mean, np.zeros(len(bare))],
                }
            )

    full = documents.where(F.col("text").isNotNull() & F.col("text").rlike(r"(?U)\S"))
    return full.select("doc_id", F.col("lang").alias("label"), "text").mapInPandas(run, _SEGMENTS)


def languages(segs: DataFrame, share: float = SHARE) -> DataFrame:
    """``doc_id, label, language, share, confidence, n_languages``: the languages that make up at least ``share`` of a text's sentences."""
    per = segs.where(F.col("language").isNotNull()).groupBy("doc_id", "language").agg(F.first("label").alias("label"), F.sum("n_sentences").alias("n"), (F.sum(F.col("n_sentences") * F.col("confidence")) / F.sum("n_sentences")).alias("confidence"))
    # At most nine languages per text.
    texts = per.groupBy("doc_id").agg(F.first("label").alias("label"), F.sum("n").alias("total"), F.collect_list(F.struct("language", "n", "confidence")).alias("l"))
    kept = texts.withColumn("l", F.filter("l", lambda x: x["n"] >= F.lit(share - 1e-9) * F.col("total"))).withColumn("n_languages", F.size("l"))
    return kept.select("doc_id", "label", "total", "n_languages", F.explode("l").alias("x")).select("doc_id", "label", F.col("x.language").alias("language"), (F.col("x.n") / F.col("total")).alias("share"), "x.confidence", "n_languages")


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """Known languages of the texts with two or more, and of those whose label does not name their only language."""
    x = languages(segments(table(spark, d, "documents")))
    wrong = ~F.coalesce(label_language(F.col("label")) == F.col("language"), F.lit(False))
    return x.where(((F.col("n_languages") >= 2) | wrong) & (F.col("language") != OTHER)).select("doc_id", F.col("language").alias("found_lang"))


def p10_languages(spark: SparkSession, d: str) -> DataFrame:
    """Every text's languages with share and confidence."""
    return languages(segments(table(spark, d, "documents")))


def p10_segments(spark: SparkSession, d: str) -> DataFrame:
    """Every segment of every text with its language and confidence."""
    return segments(table(spark, d, "documents")).drop("label")


QUERIES = {"p10_found": p10_found, "p10_languages": p10_languages, "p10_segments": p10_segments}
