"""Toxicity: held-out accuracy, disguised words, and trees and calibration against plain versions."""

import math
import os
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR, rows_of
from helpers import documents
from talkgauge.llm import toxicity
from talkgauge.llm.common import prepare, read_table

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    prepare(spark)


@pytest.fixture(scope="module")
def larger(spark):
    folder = os.path.join(os.path.dirname(SF_DIR.rstrip("/")), "sf0.1")
    return read_table(spark, folder, "documents"), read_table(spark, folder, "labels")


@pytest.fixture(scope="module")
def model(larger):
    docs, labels = larger
    return toxicity.fit(docs, labels.where(~toxicity.held_out(F.col("doc_id"))))


def test_held_out_accuracy(larger, model):
    """Of good documents kept out of training nearly all toxic ones are found and clean ones left alone."""
    docs, labels = larger
    rows, name = toxicity.score(docs, model)
    held = rows.where(toxicity.held_out(F.col("doc_id"))).join(labels.where("quality = 1"), "doc_id").select("toxic", name).toPandas()
    toxic, clean = (held[held["toxic"] == y][name] for y in (1, 0))
    assert (toxic >= 0.3).mean() >= 0.9 and (clean >= 0.3).mean() <= 0.01
    assert np.mean([(clean < t).mean() for t in toxic]) >= 0.98


def test_disguised_insults_in_clean_text(larger, model):
    docs, labels = larger
    clean = [r["text"] for r in docs.where("lang = 'en' AND n_chars BETWEEN 300 AND 900").join(
        labels.where("toxic = 0 AND quality = 1"), "doc_id").limit(30).collect()]
    shown = ["idiot", "1d10t", "i.d.i.o.t", "s t u p i d", "STUUUPID", "m0ron!", "p@thetic"]
    scores = {w: np.median(model.score([f"{t[:len(t) // 2]} you {w} and {w} or {w} {t[len(t) // 2:]}" for t in clean])) for w in shown}
    plain = np.median(model.score(clean))
    assert plain < 0.1
    assert all(s >= 0.3 for s in scores.values()), scores


@pytest.mark.parametrize("token,word,hidden", [
    ("idiot", "idiot", False), ("1d10t!!", "idiot", True), ("$tupid", "stupid", True), ("stuuupid", "stupid", True),
    ("don't", "dont", False), ("well-known", "wellknown", False), ("###", "", False), ("2024", "", False)])
def test_spelled(token, word, hidden):
    assert toxicity.spelled(token) == (word, hidden)


def plain_margin(forest, row):
    total = forest.start
    for axis, cut, value in zip(forest.axes, forest.cuts, forest.values, strict=True):
        at = 0
        while at < len(axis):
            at = 2 * at + (2 if row[axis[at]] > cut[at] else 1)
        total += value[at - len(axis)]
    return total


def test_trees_against_a_plain_walk():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(800, 4)).round(1)
    y = ((x[:, 0] > 0.3) & (x[:, 2] < 0)).astype(int)
    forest = toxicity.boost(x, y, np.ones(len(x)))
    margin = forest.margin(x)
    assert np.allclose(margin, [plain_margin(forest, r) for r in x])
    assert ((margin > 0) == (y == 1)).mean() > 0.98


def test_first_split_is_the_best_of_all():
    rng = np.random.default_rng(7)
    x, y = rng.integers(0, 12, (300, 3)).astype(float), rng.integers(0, 2, 300)
    y[x[:, 1] > 6] = 1
    forest = toxicity.boost(x, y, np.ones(300))
    p = y.mean()

    def gain(mask):
        return sum((y[m] - p).sum() ** 2 / (m.sum() * p * (1 - p) + toxicity.RIDGE) for m in (mask, ~mask))

    best = max(((gain(x[:, j] > c), j, c) for j in range(3) for c in range(11) if 2 <= (x[:, j] > c).sum() <= 298))
    chosen = gain(x[:, forest.axes[0][0]] > forest.cuts[0][0])
    assert chosen == pytest.approx(best[0], rel=1e-6)


def test_isotonic_against_minmax():
    """The rising function nearest to y is the max over starts of the min over ends of averages."""
    rng = np.random.default_rng(1)
    margin, y, w = rng.permutation(60).astype(float), rng.integers(0, 2, 60).astype(float), rng.integers(1, 4, 60).astype(float)
    order = np.argsort(margin)
    share = np.average(y, weights=w)
    x, p = toxicity.isotonic(margin, y, w)
    ys, ws = y[order], w[order]
    want = [max(min(np.average(ys[a:b], weights=ws[a:b]) for b in range(i + 1, 61)) for a in range(i + 1)) for i in range(60)]
    got = np.interp(margin[order], x, p)
    assert (np.diff(got) >= -1e-12).all()
    assert np.abs(got - want).max() <= max(0.5 * max(share, 1 - share) / 1.5, 0.34)
    assert np.corrcoef(got, want)[0, 1] > 0.95


def test_odd_documents(spark, larger, model):
    texts = [None, "", " \n", "###", "x" * 200_000, "you idiot " * 30_000, "IDIOT!!!", "\U0001f600 é", "a b c d"]
    docs = documents(spark, texts + texts).withColumn("y", F.lit(1)).withColumn("score_", F.lit("s"))
    rows, name = toxicity.score(docs.withColumn("score", F.lit(2)), model)
    assert name not in docs.columns and rows.count() == 2 * len(texts)
    got = {r["doc_id"]: r[name] for r in rows.collect()}
    assert all(0 <= s <= 1 for s in got.values())
    assert all(got[i] == got[i + len(texts)] for i in range(1, len(texts) + 1))  # rows that repeat
    assert got[6] >= 0.3 > got[2]


def test_few_labels_and_empty_tables(spark):
    docs = documents(spark, ["you idiot", "fine words", None, ""])
    none = spark.createDataFrame([], LABELS)
    one = spark.createDataFrame([(1, 1, 1), (2, 1, None), (None, 0, 1)], LABELS)
    both = spark.createDataFrame([(i, 1, i % 2) for i in range(1, 5)] + [(1, 1, 0)], LABELS)
    for labels, prior in ((none, 0.5), (one, None), (both, None)):
        rows = toxicity.op13_toxicity(docs, labels).collect()
        assert len(rows) == 4 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
        assert prior is None or {r["score"] for r in rows} == {prior}
    assert rows_of(toxicity.op13_toxicity(docs.limit(0), both)) == []


def test_labels_of_held_out_documents_are_not_learned(larger):
    docs, labels = larger
    docs, labels = docs.where("doc_id < 1500"), labels.where("doc_id < 1500")
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert rows_of(toxicity.op13_toxicity(docs, labels)) == rows_of(toxicity.op13_toxicity(docs, flipped))


def test_a_token_is_read_once_and_features_stay_plain(monkeypatch):
    """A reader judges a token once in all its texts, and counts are those of plain patterns."""
    calls = []
    plain = toxicity.spelled
    monkeypatch.setattr(toxicity, "spelled", lambda token: calls.append(token) or plain(token))
    texts = ["Ordinary considerable words, you IDIOT!! i d i o t ?!x", "a.b-c À É $hit 1d10t\ud800", "a b", "", None, "!?! #@ x"]
    lexicon = {"idiot": 2.0, "consi*": 1.5}
    reader = toxicity.Reader(lexicon)
    first = toxicity.features(["ordinary words ordinary"] * 3, lexicon, reader)
    toxicity.features(["words ordinary"], lexicon, reader)
    assert sorted(calls) == ["ordinary", "words"] and (first == first[0]).all()
    rows = toxicity.features(texts * 2, lexicon, reader)
    assert (rows[:6] == rows[6:]).all() and (rows[:6] == toxicity.features(texts, lexicon)).all()
    for row, text in zip(rows, texts, strict=False):
        of = dict(zip(toxicity.FEATURES, row, strict=True))
        words, n = toxicity.words_of(text or ""), len(toxicity.words_of(text or "")) or 1
        runs = [len(r) for r in re.findall("[!?]+", text or "")]
        assert of["log_words"] == math.log1p(len(words)) and of["lexicon_rate"] == sum(w == "idiot" for w, _ in words) / n
        assert of["stem_rate"] == sum(w.startswith("consi") and len(w) > 5 for w, _ in words) / n
        assert of["obfuscated_rate"] == sum(hidden for _, hidden in words) / n
        assert of["shout_rate"] == sum(runs) / n and of["shout_run"] == max(runs, default=0)
        assert of["capital_words"] == sum(t.isupper() for t in (text or "").split()) / n
        for name, pattern in (("capital_rate", "[A-ZÀ-ÖØ-Þ]"), ("mark_rate", r"[^\w\s]"), ("symbol_rate", "[#$%&*@^~|]")):
            assert of[name] == len(re.findall(pattern, text or "")) / max(1, len(text or ""))
