"""Language ID and quality against plain versions of their methods, row by row."""

import math
import zlib
from collections import Counter

import pytest
import regex
import zstandard
from pyspark.sql import functions as F

from helpers import documents, table
from talkgauge.llm import langid, quality
from talkgauge.llm.common import prepare


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    prepare(spark)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, "documents")


def held(doc_id, part, rest):
    return zlib.crc32(str(doc_id).encode()) % part == rest


def plain_logs(counts, langs, limit):
    """Smoothed log frequency of the most frequent terms, a list over languages for each."""
    sums = Counter()
    for lang in langs:
        sums.update(counts[lang])
    top = sorted(sums, key=lambda t: (-sums[t], t.encode()))[:limit]
    total = {lang: sum(counts[lang].values()) + 0.5 * len(top) for lang in langs}
    return {t: [math.log((counts[lang][t] + 0.5) / total[lang]) for lang in langs] for t in top}


def plain_languages(rows):
    """doc_id to (language, score, lead over the second) of all rows, learned from those not held out."""
    taught = [r for r in rows if r["lang"] is not None and r["text"] is not None and not held(r["doc_id"], 4, 2)]
    langs = sorted({r["lang"] for r in taught})
    words = {lang: Counter() for lang in langs}
    for r in taught:
        words[r["lang"]].update(regex.findall(r"\p{L}+", r["text"].lower()))
    known = plain_logs(words, langs, langid.WORDS)
    grams = {}
    for n in range(1, langid.LONGEST + 1):
        counts = {lang: Counter() for lang in langs}
        for lang in langs:
            for word, times in words[lang].items():
                marked = f"<{word}>"
                for i in range(len(marked) - n + 1):
                    counts[lang][marked[i:i + n]] += times
        grams[n] = plain_logs(counts, langs, langid.GRAMS)

    def of_word(word):
        if word in known:
            return known[word]
        marked = f"<{word}>"
        for n in range(langid.LONGEST, 0, -1):
            found = [grams[n][g] for i in range(len(marked) - n + 1) if (g := marked[i:i + n]) in grams[n]]
            if found:
                return [sum(x) / len(found) for x in zip(*found)]
        return [0.0] * len(langs)

    out = {}
    for r in rows:
        met = regex.findall(r"\p{L}+", (r["text"] or "").lower())
        if not met:
            out[r["doc_id"]] = ("und", 0.0, 1.0)
            continue
        logs = [sum(x) / len(met) * min(len(met), langid.EVIDENCE) for x in zip(*map(of_word, met))]
        odds = [math.exp(x - max(logs)) for x in logs]
        best = odds.index(max(odds))
        out[r["doc_id"]] = (langs[best], odds[best] / sum(odds), 1 - sorted(odds)[-2])
    return out


def test_languages_equal_a_plain_version(spark, docs):
    odd = documents(spark, [None, "", "12 !?", "Zzxqy", "the der und of", "wörld " * 30_000, "the of", "the of"], 10**6, lang=None)
    some = docs.select("doc_id", "text", "lang").unionByName(odd.select("doc_id", "text", "lang"))
    plain = plain_languages(some.collect())
    got = langid.op7_langid(some).collect()
    assert len(got) == len(plain)
    for r in got:
        lang, score, lead = plain[r["doc_id"]]
        assert r["held_out"] == held(r["doc_id"], 4, 2)
        assert abs(r["score"] - score) < 1e-3 and (r["lang_pred"] == lang or lead < 1e-3)


def plain_quality(text, model):
    """The calibrated difference of the sizes that the two dictionaries give."""
    data = (text or "").encode("utf-8", "replace")
    sizes = []
    for dictionary in (model.good, model.bad):
        packer = zstandard.ZstdCompressor(
            level=quality.LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary), write_content_size=False,
            write_checksum=False, write_dict_id=False)
        sizes.append(sum(len(packer.compress(data[i:i + quality.PIECE])) for i in range(0, max(1, len(data)), quality.PIECE)))
    good, bad = sizes
    x = [1.0, 10.0 * (bad - good) / (len(data) + 1), 3.0 * (bad - good) / max(good, bad), min(4.0, good / (len(data) + 1))]
    return 1 / (1 + math.exp(-sum(a * b for a, b in zip(x, model.weights))))


def test_quality_equals_a_plain_version(spark, docs):
    labels = table(spark, "labels")
    model = quality.fit(docs, labels.where(~quality.held_out(F.col("doc_id"))))
    assert model.weights and len(model.good) >= 8 and len(model.bad) >= 8
    odd = documents(spark, [None, "", "é\U0001f600", "word " * 40_000, "same text", "same text"], 10**6)
    some = docs.select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    rows, name = quality.score(some.withColumn("score", F.lit("x")).withColumn("quality_x", F.lit(1)), model)
    assert name == "score_" and rows.columns == ["doc_id", "text", "score", "quality_x", "score_"]
    got = rows.collect()
    assert len(got) == some.count()
    assert all(abs(r[name] - plain_quality(r["text"], model)) < 1e-9 for r in got)


def test_labels_of_held_out_documents_teach_nothing(docs, spark):
    """Other labels and languages of held-out documents change no score."""
    labels = table(spark, "labels")
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({r["doc_id"]: r["score"] for r in quality.op9_quality(docs, x).collect()} for x in (labels, flipped))
    assert a == b
    other = docs.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), "xx").otherwise(F.col("lang")))
    a, b = ({tuple(r) for r in langid.op7_langid(x).collect()} for x in (docs, other))
    assert a == b and "xx" not in {r[2] for r in b}
