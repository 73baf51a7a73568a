"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

A text becomes `FEATURES` numbers: densities and counts of words of a lexicon learned
from labelled documents (whole words, and stems of 4 to 7 letters), of a short fixed
list of insults, how many of these stand near a second-person word, rates of
capitals, punctuation and symbols, and of obfuscated words (`1d10t`, `i.d.i.o.t`,
`stuuupid`), which are read as what they spell. Trees on histograms of these are
boosted by Newton's steps, and their margin becomes a probability by isotonic
regression on documents that neither the lexicon nor the trees have seen. Whole
texts are read.

Bounds: `SAMPLE` labelled documents of each class, drawn by a hash of the id. A fifth
is for the calibration. The others are cut in two halves, and the features of each that
the trees learn from come from a lexicon of the other half, so that no document
meets its own words; texts are scored with the lexicon of both halves. A lexicon keeps terms found in `SUPPORT` toxic documents or more whose odds are
`exp(ODDS)` times those of clean ones, at most `LEXICON` of them by weight.

Defined cases: a null text counts as empty, and an empty text has features of its
own (all 0); ids with both labels, and null labels, are left out of training; without
both classes every text gets the share of label 1 (0.5 without labels); rows that
repeat get the same score; other columns stay.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkgauge.llm.common import crc_of, fresh
from talkgauge.plans.staging import stage

SAMPLE, LEXICON, SUPPORT, ODDS = 6_000, 5_000, 3, 1.5
#: Tokens that a worker remembers.
KNOWN = 400_000
TREES, DEPTH, BINS, RATE, RIDGE, LEAST = 120, 3, 64, 0.1, 1.0, 2.0
STEMS, NEAR = (4, 5, 6, 7), 3
FEATURES = ("log_words", "lexicon_rate", "lexicon_log", "lexicon_distinct", "weight_rate", "weight_most",
            "stem_rate", "stem_log", "stem_weight_rate", "insult_rate", "insult_log", "you_rate", "near_you_rate",
            "near_you_log", "capital_rate", "capital_words", "mark_rate", "shout_rate", "shout_run", "symbol_rate",
            "obfuscated_rate", "obfuscated_hits")

# Insults and second-person words of four languages, and characters written for letters.
INSULTS = frozenset(
    "idiot idiots moron morons stupid dumb fool imbecile loser losers trash garbage scum worthless pathetic "
    "disgusting clown jerk bastard bitch asshole shit fuck fucking retard "
    "dummkopf arschloch scheisse scheiße trottel depp abschaum wertlos "
    "connard imbécile crétin débile salaud ordure merde nul "
    "idiota imbécil estúpido tonto basura escoria inútil mierda cabrón".split())
SECOND_PERSON = frozenset(
    "you your yours yourself you're youre u ur du dich dir dein deine euch ihr tu te toi ton ta vous votre vos "
    "tú ti usted ustedes tus vosotros".split())
LOOKALIKES = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
                            "@": "a", "$": "s", "!": "i", "|": "l", "€": "e"})

#: Marks a word whose letters were set apart.
GLUE = "\u2060"
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_INNER = re.compile(r"[^\w'’-]|[\d_]")
_LETTERS = re.compile(r"[\W\d_]+")
_RUN = re.compile(r"(.)\1{2,}")
_SPACED = re.compile(r"(?<!\S)[^\W\d_]([ .*_-])(?:[^\W\d_]\1)+[^\W\d_](?![^\W_])")
_MARK = re.compile(r"[^\w\s]")
_SYMBOL = re.compile(r"[#$%&*@^~|]")
_CAPITAL = re.compile(r"[A-ZÀ-ÖØ-Þ]")


def spelled(token: str) -> tuple[str, bool]:
    """The word that a token spells, in small letters, and whether it is written in disguise."""
    if token.isascii() and token.isalpha():
        core = token.lower()
        return (plain := _RUN.sub(r"\1", core) if _RUN.search(core) else core), plain != core
    core = _EDGE.sub("", token).lower()
    if token[:1] in "@$" and core:
        core = token[0] + core
    if core.isalpha():
        plain = _RUN.sub(r"\1", core) if _RUN.search(core) else core
        return plain, plain != core
    letters = sum(map(str.isalpha, core))
    if letters < 2 or core.startswith(("http", "www")) or not _INNER.search(core):
        return _LETTERS.sub("", core), False
    return _RUN.sub(r"\1", _LETTERS.sub("", core.translate(LOOKALIKES))), True


#: Whether a character is a capital, a mark, a symbol.
_classes: dict[int, tuple[bool, bool, bool]] = {}


def _apart(token: str) -> int:
    """How many of the letters set apart a token can hold: none, one, or more."""
    if len(token) == 1:
        return int(token.isalpha())
    return 2 * (token[1] in ".*_-" and token[0].isalpha())


def _glued(text: str) -> str:
    return _SPACED.sub(lambda m: GLUE + _LETTERS.sub("", m[0]), text)


def _read(token: str) -> tuple[str, bool]:
    word, hidden = spelled(token.lstrip(GLUE))
    return word, hidden or token[:1] == GLUE


def words_of(text: str) -> list[tuple[str, bool]]:
    """Words in order, letters set apart by spaces or points put together."""
    if _SPACED.search(text):
        text = _glued(text)
    tokens = text.split()
    known = {t: _read(t) for t in set(tokens)}
    return [w for w in map(known.__getitem__, tokens) if w[0]]


@dataclass
class Verdict:
    """What the features need to know of a token: its word, weights, and whether it is of some class."""
    word: tuple[str, bool]
    upper: bool
    apart: int
    weight: float
    stem: float
    insult: bool
    second: bool


class Reader:
    """Verdicts on tokens by a lexicon; most tokens count as a word and nothing else, and are remembered as such."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.heads = {t[:STEMS[0]] for t in lexicon if t.endswith("*")}
        self.dull: set[str] = set()
        self.known: dict[str, Verdict] = {}

    def judge(self, token: str) -> Verdict | None:
        """The verdict on a token that is not known; None if it is dull."""
        word, hidden = _read(token)
        stem = 0.0
        if word[:STEMS[0]] in self.heads:
            stem = max((self.lexicon.get(word[:n] + "*", 0.0) for n in STEMS if len(word) > n), default=0.0)
        weight, apart, upper = self.lexicon.get(word, 0.0), _apart(token), token.isupper()
        insult, second = word in INSULTS, word in SECOND_PERSON
        if word and not (hidden or stem or weight or apart or upper or insult or second):
            if len(self.dull) >= KNOWN:
                self.dull.clear()
            self.dull.add(token)
            return None
        if len(self.known) >= KNOWN:
            self.known.clear()
        out = self.known[token] = Verdict((word, hidden), upper, apart, weight, stem, insult, second)
        return out

    def verdicts(self, counts: Counter) -> list[tuple[Verdict, int]]:
        """The verdicts on the tokens that are not dull, by first occurrence, and how often each occurs."""
        dull, known, judge = self.dull, self.known, self.judge
        some = [t for t in counts if t not in dull]
        return [(v, counts[t]) for t in some if (v := known.get(t) or judge(t)) is not None]

    def read(self, text: str) -> tuple[int, int, dict[tuple[str, bool], tuple[Verdict, int]]]:
        """The number of words, of tokens in capitals, and each word that is not dull with a verdict and its number."""
        tokens = text.split()
        found = self.verdicts(Counter(tokens))
        shouted = sum(n for v, n in found if v.upper)
        if sum(n * v.apart for v, n in found) > 1 and _SPACED.search(text):
            tokens = _glued(text).split()
            found = self.verdicts(Counter(tokens))
        words: dict[tuple[str, bool], tuple[Verdict, int]] = {}
        total = len(tokens)
        for v, n in found:
            if v.word[0]:
                words[v.word] = v, n + (words[v.word][1] if v.word in words else 0)
            else:
                total -= n
        return total, shouted, words


def characters(text: str) -> tuple[int, int, int, int, int]:
    """Capitals, marks, symbols, `!` and `?`, and the longest run of these."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    counts = np.bincount(codes)
    totals = [0, 0, 0]
    for code in np.flatnonzero(counts).tolist():
        if (of := _classes.get(code)) is None:
            c = chr(code)
            of = _classes[code] = tuple(bool(p.match(c)) for p in (_CAPITAL, _MARK, _SYMBOL))
        for k in range(3):
            if of[k]:
                totals[k] += int(counts[code])
    at = np.flatnonzero((codes == 33) | (codes == 63))
    ends = np.flatnonzero(np.append(np.diff(at) > 1, True)) if len(at) else at
    return *totals, len(at), int(np.diff(ends, prepend=-1).max(initial=0))


def terms_of(text: str) -> set[str]:
    """The words of a text and their stems, which end in `*`."""
    words = {w for w, _ in words_of(text)}
    return words | {w[:n] + "*" for w in words for n in STEMS if len(w) > n}


def features(texts: list[str | None], lexicon: dict[str, float], reader: Reader | None = None) -> np.ndarray:
    """One row a text; `reader` is of the same lexicon and remembers tokens of earlier calls."""
    out = np.zeros((len(texts), len(FEATURES)))
    reader = reader or Reader(lexicon)
    for k, text in enumerate(texts):
        if not text:
            continue
        total, shouted, words = reader.read(text)
        n = total or 1
        hits = stems = insults = you = hidden = hidden_hits = 0
        weight = stem_weight = most = 0.0
        distinct, marked = 0, set()
        for (word, disguised), (v, count) in words.items():
            w, s, insult = v.weight, v.stem, v.insult
            you += count * v.second
            hidden += count * disguised
            if w or s or insult:
                hits += count * (w > 0)
                stems += count * (s > 0)
                insults += count * insult
                weight += w * count
                stem_weight += s * count
                most = max(most, w)
                distinct += 1
                hidden_hits += count * disguised
                if w or insult:
                    marked.add(word)
        near = 0
        if you and marked:
            order = words_of(text)
            at = np.flatnonzero([w in SECOND_PERSON for w, _ in order])
            for i, (word, _) in enumerate(order):
                if word in marked:
                    p = np.searchsorted(at, i)
                    near += any(abs(int(at[q]) - i) <= NEAR for q in (p - 1, p) if 0 <= q < len(at))
        capitals, marks, symbols, shouts, run = characters(text)
        chars = len(text)
        out[k] = (math.log1p(total), hits / n, math.log1p(hits), math.log1p(distinct), weight / n, most,
                  stems / n, math.log1p(stems), stem_weight / n, insults / n, math.log1p(insults), you / n, near / n,
                  math.log1p(near), capitals / chars, shouted / n, marks / chars, shouts / n, min(8, run),
                  symbols / chars, hidden / n, hidden_hits / n)
    return out


@dataclass
class Forest:
    """Complete trees of `DEPTH` levels: the feature and cut of each inner node, the value of each leaf."""
    start: float
    axes: np.ndarray = field(default_factory=lambda: np.zeros((0, 2 ** DEPTH - 1), np.int64))
    cuts: np.ndarray = field(default_factory=lambda: np.zeros((0, 2 ** DEPTH - 1)))
    values: np.ndarray = field(default_factory=lambda: np.zeros((0, 2 ** DEPTH)))

    def margin(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.start), np.arange(len(x))
        for axis, cut, value in zip(self.axes, self.cuts, self.values, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, axis[at]] > cut[at])
            out += value[at - (2 ** DEPTH - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Forest:
    """Trees by Newton's steps on the logistic loss, splits by histograms of `BINS` quantiles."""
    share = float(np.clip(np.average(y, weights=weight), 1e-6, 1 - 1e-6))
    forest = Forest(math.log(share / (1 - share)))
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    features_, margin = x.shape[1], np.full(len(x), forest.start)
    trees = []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = weight * (y - p), weight * p * (1 - p)
        axis, cut = np.zeros(2 ** DEPTH - 1, np.int64), np.full(2 ** DEPTH - 1, np.inf)
        at = np.zeros(len(x), np.int64)
        for level in range(DEPTH):
            first = 2 ** level - 1
            nodes = 2 ** level
            place = ((at - first)[:, None] * features_ + np.arange(features_)) * BINS + binned
            g, h, n = (np.bincount(place.ravel(), np.repeat(v, features_), nodes * features_ * BINS).reshape(
                nodes, features_, BINS).cumsum(axis=2) for v in (grad, hess, np.ones(len(x))))
            gain = _gain(g, h) + _gain(g[..., -1:] - g, h[..., -1:] - h) - _gain(g[..., -1:], h[..., -1:])
            gain[(n < LEAST) | (n[..., -1:] - n < LEAST)] = 0
            best = gain.reshape(nodes, -1).argmax(axis=1)
            for node, where in enumerate(best):
                j, b = divmod(int(where), BINS)
                if gain[node, j, b] > 1e-9 and b < len(edges[j]):
                    axis[first + node], cut[first + node] = j, edges[j][b]
            at = 2 * at + 1 + (x[np.arange(len(x)), axis[at]] > cut[at])
        leaf = at - (2 ** DEPTH - 1)
        g, h = (np.bincount(leaf, v, 2 ** DEPTH) for v in (grad, hess))
        value = RATE * g / (h + RIDGE)
        margin = margin + value[leaf]
        trees.append((axis, cut, value))
    forest.axes, forest.cuts, forest.values = (np.array(t) for t in zip(*trees, strict=True))
    return forest


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + RIDGE)


def isotonic(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points (margin, probability) of the rising step function nearest to `y`, by pooling adjacent violators."""
    blocks: list[list[float]] = []  # least and largest margin, weight, sum
    for i in np.argsort(margin, kind="stable"):
        blocks.append([margin[i], margin[i], weight[i], weight[i] * y[i]])
        while len(blocks) > 1 and (blocks[-2][3] * blocks[-1][2] >= blocks[-1][3] * blocks[-2][2]
                                   or blocks[-2][1] == blocks[-1][0]):
            low, high = blocks[-2], blocks.pop()
            low[1], low[2], low[3] = high[1], low[2] + high[2], low[3] + high[3]
    share = np.average(y, weights=weight)
    ends = [(m, (total + 0.5 * share) / (size + 0.5)) for low, high, size, total in blocks for m in (low, high)]
    x, p = (np.array(c) for c in zip(*ends, strict=True))
    return x, np.maximum.accumulate(p)


@dataclass
class Model:
    prior: float
    lexicon: dict[str, float] = field(default_factory=dict)
    forest: Forest | None = None
    points: tuple[np.ndarray, np.ndarray] | None = None

    def score(self, texts: list[str | None], reader: Reader | None = None) -> np.ndarray:
        margin = self.forest.margin(features(texts, self.lexicon, reader))
        if self.points is None:
            return 1 / (1 + np.exp(-margin))
        return np.interp(margin, *self.points)


def learn_lexicon(rows: DataFrame, text: str) -> dict[str, float]:
    """Weights of terms that toxic texts hold far more often than clean ones; `rows` has `y`."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for y, value in zip(batch["y"].to_pylist(), batch["text"].to_pylist(), strict=True):
                counts.update((t, y) for t in terms_of(value or ""))
            yield pa.RecordBatch.from_pydict({"term": [t for t, _ in counts], "y": pa.array([y for _, y in counts], pa.int32()),
                                              "n": list(counts.values())})

    totals = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    if len(totals) < 2:
        return {}
    bad, good = totals[1], totals[0]
    weight = F.log((F.col("bad") + 0.5) / (bad + 1)) - F.log((F.col("good") + 0.5) / (good + 1))
    found = rows.select("y", F.col(text).alias("text")).mapInArrow(split, "term string, y int, n long").groupBy("term").agg(
        F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("bad"),
        F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("good"))
    kept = found.where(F.col("bad") >= SUPPORT).withColumn("weight", weight).where(F.col("weight") >= ODDS)
    return {r["term"]: r["weight"] for r in kept.orderBy(F.desc("weight"), "term").limit(LEXICON).collect()}


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
        label: str = "toxic", sample: int = SAMPLE) -> Model:
    """The model of `docs` and the 0/1 labels of some of them."""
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y")).where(
        "id IS NOT NULL AND y IN (0, 1)").groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("top")).where("y = top")
    totals = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    prior = totals.get(1, 0) / sum(totals.values()) if totals else 0.5
    if len(totals) < 2:
        return Model(prior)
    drawn = F.pmod(F.xxhash64(F.lit("toxic"), "id"), F.lit(1 << 30))
    rates = {y: min(1.0, sample / n) for y, n in totals.items()}
    picked = known.where(drawn < F.when(F.col("y") == 1, rates[1]).otherwise(rates[0]) * (1 << 30)).select(
        "id", "y", F.pmod(F.xxhash64(F.lit("part"), "id"), F.lit(5)).alias("part"))
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    rows = stage(rows.join(F.broadcast(picked), "id").dropDuplicates(["id"]), "toxic_sample")  # `sample` ids a class
    halves = [rows.where("part < 2"), rows.where("part IN (2, 3)")]
    lexicon = learn_lexicon(rows.where("part < 4"), "text")
    crossed = [(half, learn_lexicon(other, "text")) for half, other in zip(halves, halves[::-1], strict=True)]
    parts = [_collected(half, words) for half, words in [*crossed, (rows.where("part = 4"), lexicon)]]
    y, part, x = (np.concatenate(c) for c in zip(*parts, strict=True))
    if len(set(y)) < 2:
        return Model(prior)
    weight = np.where(y == 1, 1 / rates[1], 1 / rates[0])
    weight = weight / weight.mean()
    train = part < 4
    if len(set(y[train])) < 2 or len(set(y[~train])) < 2:  # too few to keep some apart
        return Model(prior, lexicon, boost(x, y, weight))
    forest = boost(x[train], y[train], weight[train])
    return Model(prior, lexicon, forest, isotonic(forest.margin(x[~train]), y[~train], weight[~train]))


def _collected(rows: DataFrame, lexicon: dict[str, float]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Labels, parts and features of the sample, in the order of the ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(lexicon)
        for batch in batches:
            x = features(batch["text"].to_pylist(), lexicon, reader)
            lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch["id"], batch["y"], batch["part"], lists], ["id", "y", "part", "x"])

    key = rows.schema["id"].dataType.simpleString()
    table = rows.select("id", "y", F.col("part").cast("int").alias("part"), "text").mapInArrow(
        run, f"id {key}, y int, part int, x array<double>").orderBy("id").toArrow()
    x = table["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
    return table["y"].to_numpy(), table["part"].to_numpy(), x


def score(docs: DataFrame, model: Model, text: str = "text") -> tuple[DataFrame, str]:
    """`docs` with the probability of label 1, and that column's name."""
    name = fresh(docs, "score")
    if model.forest is None:
        return docs.withColumn(name, F.lit(model.prior)), name

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        reader = Reader(model.lexicon)
        for batch in batches:
            yield pa.array(model.score(batch.to_pylist(), reader))

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return docs.withColumn(name, F.arrow_udf(run, "double")(F.col(text))), name


def held_out(doc_id: Column) -> Column:
    """The quarter of documents whose labels are never learned."""
    return crc_of(doc_id) % 4 == 2


def op13_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = fit(docs, labels.where(~held_out(F.col("doc_id"))))
    rows, name = score(docs.select("doc_id", "text"), model)
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col(name).alias("score"),
                       (F.col(name) >= threshold).cast("int").alias("predicted"))
