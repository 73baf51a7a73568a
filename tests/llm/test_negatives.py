"""Hard negatives: DuckDB and a plain search."""

import math

import numpy as np
import pytest

from conftest import rows_of
from helpers import by_sql, table
from talkgauge.llm import hard_negatives
from talkgauge.llm.common import prepare

VECS = "vec_id long, embedding array<double>, label int"


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    prepare(spark)


def plain(rows, k=5):
    """Every score of every anchor, sorted once per window."""
    kept = {}
    for ident, vec, label in rows:
        if ident is None or label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        whole = [math.floor(256 * x) for x in vec]
        label = (label + 1) % 10 if ident % 7 == 0 else label
        if ident not in kept or (label, whole) < kept[ident]:
            kept[ident] = label, whole
    out = []
    for anchor, (label, vec) in kept.items():
        if anchor % 100:
            continue
        scored = sorted((-sum(a * b for a, b in zip(vec, v, strict=True)), i, lab) for i, (lab, v) in kept.items() if i != anchor)
        for neg, positive, _ in [s for s in scored if s[2] == label][:k]:
            fit = [(s, i) for s, i, lab in scored if lab != label and -80 * neg <= -100 * s <= -100 * neg][:k]
            out += [(anchor, i, -s, positive, -neg, rank) for rank, (s, i) in enumerate(fit, 1)]
    return sorted(out, key=repr)


def test_given_vectors(spark):
    vecs = table(spark, "embeddings")
    got = rows_of(hard_negatives.op12_hard_negatives(vecs))
    assert got == by_sql(hard_negatives.ORACLE_SQL, embeddings=vecs)
    assert got == plain([(r["vec_id"], r["embedding"], r["label"]) for r in vecs.collect()])
    assert got


def test_odd_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.integers(-2, 4, 3) / 4], int(rng.integers(0, 3))) for i in range(400)]  # many ties
    rows += [(500, None, 1), (600, [1.0, None, 0.0], 1), (700, [1.0, float("nan"), 0.0], 1), (800, [0.0] * 3, 1), (900, [0.5] * 3, None),
             (None, [1.0] * 3, 1), (1000, [1.0, float("inf"), 0.0], 2), (200, [0.75] * 3, 0), (3, [0.5, 0.25, 0.5], 0)]
    rows += [(1100, [-0.5, -0.5, -0.5], 9)]  # the only one of its label
    vecs = spark.createDataFrame(rows, VECS)
    got = rows_of(hard_negatives.op12_hard_negatives(vecs))
    assert got == plain(rows)
    assert got == by_sql(hard_negatives.ORACLE_SQL, embeddings=vecs)


def test_large_numbers_are_exact(spark):
    rows = [(i, [1e6 + i / 256, 1.0, (i % 5) / 256], i % 2 + 1) for i in range(0, 300, 3)]
    assert rows_of(hard_negatives.op12_hard_negatives(spark.createDataFrame(rows, VECS))) == plain(rows)


def test_anchors_in_blocks_and_rows_in_strips(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK", 2)
    monkeypatch.setattr(hard_negatives, "CELLS", 64)
    monkeypatch.setattr(hard_negatives, "STRIP", 7)
    vecs = table(spark, "embeddings")
    assert rows_of(hard_negatives.op12_hard_negatives(vecs)) == by_sql(hard_negatives.ORACLE_SQL, embeddings=vecs)


def test_empty_repeated_and_clashing(spark):
    assert rows_of(hard_negatives.op12_hard_negatives(spark.createDataFrame([], VECS))) == []
    vecs = table(spark, "embeddings")
    want = rows_of(hard_negatives.op12_hard_negatives(vecs))
    assert rows_of(hard_negatives.op12_hard_negatives(vecs.union(vecs))) == want
    clash = vecs.selectExpr("*", "1 AS id", "2 AS vec", "true AS anchor", "3 AS grp")
    assert rows_of(hard_negatives.op12_hard_negatives(clash)) == want
    assert rows_of(hard_negatives.op12_hard_negatives(vecs.selectExpr("vec_id", "embedding", "1 AS label").where("vec_id % 7 <> 0"))) == []


def test_suffix_merges_answer_all_windows():
    positives = [(100, 1), (90, 2), (90, 3), (10, 4)]
    slots = {0: [(-99, 20), (-95, 21)], 2: [(-90, 22), (-80, 23), (-72, 24)], 3: [(-10, 25), (-9, 26), (-8, 27)]}
    got = hard_negatives.answer(positives, slots, 3, 80)
    assert sorted(got) == sorted([(1, 1, 20, 100, 99), (1, 2, 21, 100, 95), (1, 3, 22, 100, 90),
                                  (2, 1, 22, 90, 90), (2, 2, 23, 90, 80), (2, 3, 24, 90, 72),
                                  (3, 1, 22, 90, 90), (3, 2, 23, 90, 80), (3, 3, 24, 90, 72),
                                  (4, 1, 25, 10, 10), (4, 2, 26, 10, 9), (4, 3, 27, 10, 8)])
