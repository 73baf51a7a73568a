"""Language identification by words first, then shorter and shorter n-grams.

Training counts words and the n-grams of words (with a mark at both ends) per
language over a bounded sample of labelled documents. A known word scores by its
log frequency in each language. An unseen word is cut into n-grams of `LONGEST`
letters; if the model knows none of them, into shorter ones, and so on; those
known at the longest length score by their mean log frequency. A document sums
its words, and its score is the posterior of the best language with the evidence
of at most `EVIDENCE` words, so that it doesn't go to 1 with length alone.

Bounds: `SAMPLE` documents per language on average, drawn by a hash of the id;
`WORDS` words and `GRAMS` n-grams of each length, the most frequent ones.

Defined cases: a null text, or one without a letter, is `und` with score 0; a text
of which the model knows nothing gets equal scores and the first language by name;
without any training row all texts with letters are `und`; ties go to the smaller
language name. Rows that repeat are judged alike, other columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkgauge.llm.common import crc_of, fresh
from talkgauge.plans.staging import stage

SAMPLE, WORDS, GRAMS, LONGEST, EVIDENCE = 2_000, 60_000, 15_000, 4, 10
#: Words scored that a worker keeps.
KEPT = 40_000
LETTERS = regex.compile(r"\p{L}+")
UNKNOWN = "und"


@dataclass
class Model:
    langs: list[str]
    words: dict[str, int]
    word_logs: np.ndarray
    grams: list[dict[str, int]]
    gram_logs: list[np.ndarray]
    worker: Scorer | None = field(default=None, compare=False)


class Scorer:
    """Scores texts, keeping the words met so far as rows of a matrix."""

    def __init__(self, model: Model):
        self.model = model
        self._reset()

    def _reset(self) -> None:
        self.rows = dict(self.model.words)
        known = self.model.word_logs
        self.logs = np.zeros((len(known) + 4096, len(self.model.langs)), np.float32)
        self.logs[: len(known)] = known
        self.used = len(known)

    def _add(self, word: str) -> int:
        if self.used == len(self.logs):
            self.logs = np.concatenate([self.logs, np.zeros_like(self.logs)])
        self.logs[self.used] = self.backoff(word)
        self.rows[word] = self.used
        self.used += 1
        return self.used - 1

    def backoff(self, word: str) -> np.ndarray:
        marked = f"<{word}>"
        for n in range(LONGEST, 0, -1):
            known = self.model.grams[n - 1]
            found = [known[g] for i in range(len(marked) - n + 1) if (g := marked[i:i + n]) in known]
            if found:
                return self.model.gram_logs[n - 1][found].mean(axis=0)
        return np.zeros(len(self.model.langs), np.float32)

    def judge(self, text: str | None) -> tuple[str, float]:
        words = LETTERS.findall(text.lower()) if text else []
        if not words or not self.model.langs:
            return UNKNOWN, 0.0
        if self.used > len(self.model.words) + KEPT:
            self._reset()
        get = self.rows.get
        at = [self._add(w) if (k := get(w)) is None else k for w in words]
        mean = self.logs[at].mean(axis=0, dtype=np.float64) * min(len(words), EVIDENCE)
        odds = np.exp(mean - mean.max())
        best = int(odds.argmax())
        return self.model.langs[best], float(odds[best] / odds.sum())


def sample_of(labelled: DataFrame, per_lang: int, doc_id: str, lang: str) -> DataFrame:
    """About `per_lang` documents of each language, drawn by a hash of the id, without moving the texts."""
    totals = {r[lang]: r["count"] for r in labelled.groupBy(lang).count().collect()}
    share = F.create_map(*[F.lit(x) for pair in totals.items() for x in pair])[F.col(lang)] if totals else F.lit(1)
    drawn = F.pmod(F.xxhash64(F.lit("langid"), F.col(doc_id)), F.lit(1 << 30)) / float(1 << 30)
    return labelled.where(drawn * share < per_lang)


def fit(labelled: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
        sample: int = SAMPLE) -> Model:
    """The model of a frame of labelled documents; rows without label or text are left out."""
    rows = labelled.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull())
    words = sample_of(rows, sample, "id", "lang").select(
        "lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))).alias("term"))
    counts = stage(words.groupBy("lang", "term").agg(F.count("*").alias("n")), "langid_words")
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    known, logs = _logs(counts, langs, WORDS)
    grams, gram_logs = [], []
    for n in range(1, LONGEST + 1):
        marked = F.concat(F.lit("<"), F.col("term"), F.lit(">"))
        cut = counts.where(F.length("term") + 2 >= n).select("lang", "n", F.explode(_cut(marked, n)).alias("term"))
        index, values = _logs(cut.groupBy("lang", "term").agg(F.sum("n").alias("n")), langs, GRAMS)
        grams.append(index)
        gram_logs.append(values)
    return Model(langs, known, logs, grams, gram_logs)


def _cut(term: Column, n: int) -> Column:
    """The n-grams of a term as an array."""
    return F.transform(F.sequence(F.lit(1), F.length(term) - n + 1), lambda i: F.substring(term, i, F.lit(n)))


def _logs(counts: DataFrame, langs: list[str], limit: int) -> tuple[dict[str, int], np.ndarray]:
    """The most frequent terms and their smoothed log frequencies per language."""
    if not langs:
        return {}, np.zeros((0, 0), np.float32)
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    top = counts.groupBy("term").agg(F.sum("n").alias("all"), *[
        F.sum(F.when(F.col("lang") == x, F.col("n")).otherwise(0)).alias(f"n{k}") for k, x in enumerate(langs)
    ]).orderBy(F.desc("all"), "term").limit(limit).toArrow()
    table = np.stack([top[f"n{k}"].to_numpy() for k in range(len(langs))], axis=1) + 0.5
    table /= np.array([totals[x] for x in langs], float) + 0.5 * max(1, len(table))
    return {t: i for i, t in enumerate(top["term"].to_pylist())}, np.log(table).astype(np.float32)


def judge(docs: DataFrame, model: Model, text: str = "text") -> tuple[DataFrame, tuple[str, str]]:
    """`docs` with lang_pred and score, under these names or fresh ones."""
    pred, score, both = (fresh(docs, c) for c in ("lang_pred", "score", "langid_both"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        scorer = model.worker = model.worker or Scorer(model)  # kept by a reused worker
        for batch in batches:
            found = [scorer.judge(t) for t in batch.to_pylist()]
            yield pa.StructArray.from_arrays(
                [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                ["lang", "score"])

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    judged = docs.withColumn(both, F.arrow_udf(run, "lang string, score double")(F.col(text)))
    return judged.withColumns({pred: F.col(both)["lang"], score: F.col(both)["score"]}).drop(both), (pred, score)


def held_out(doc_id: Column) -> Column:
    """The quarter of documents from which nothing is learned."""
    return crc_of(doc_id) % 4 == 2


def op7_langid(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    judged, _ = judge(docs.select("doc_id", "text"), model)
    return judged.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def only_known(docs: DataFrame, least: float = 0.0) -> DataFrame:
    """`docs` without those of unknown language, columns as before.

    A score below `least` counts as unknown too; by default none does, as the scores of
    short documents are low where the language is told.
    """
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    judged, (pred, score) = judge(docs, model)
    return judged.where((F.col(pred) != UNKNOWN) & (F.col(score) >= least)).select(
        *[F.col(f"`{c}`") for c in docs.columns])
