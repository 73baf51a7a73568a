"""Embeddings, n-gram joins and components against brute force."""

import contextlib
import glob
import os
import random
import threading
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import documents, table
from talkgauge.llm import ann, embedding_dedup, jaccard
from talkgauge.llm.common import prepare
from talkgauge.llm.components import connected_components
from talkgauge.plans.staging import shuffles_removed


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    prepare(spark)


def groups(nodes, edges):
    """The smallest node that each node can reach."""
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("edges", [
    [], [(3, 3)], [(k, k + 1) for k in range(60)], [(0, k) for k in range(1, 200)] + [(500, k) for k in range(100, 300)],
    [(5, 2), (2, 5), (2, 5), (9, 7)],
])
def test_components(spark, edges):
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in got} == groups({n for e in edges for n in e}, edges)


def test_components_of_random_graphs(spark):
    rng = random.Random(7)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in got} == groups({n for e in edges for n in e}, edges)


def vectors(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")


def planted(seed=1, dim=24, n=260):
    """Random vectors, a chain of near copies, a group of near copies, equal and scaled vectors."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    for k in range(41, 60):
        x[k] = x[k - 1] + rng.normal(size=dim) * 0.3
    x[60:140] = x[60] + rng.normal(size=(80, dim)) * 0.25
    x[140:150] = x[140]
    x[150:155] = x[140] * np.arange(2, 7)[:, None]
    return x.astype(np.float32).astype(float)


def brute_links(x, threshold):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (u @ u.T) >= threshold
    np.fill_diagonal(near, False)
    return near


@pytest.mark.parametrize("kind", ["float", "double"])
def test_embedding_dedup(spark, monkeypatch, kind):
    monkeypatch.setattr(embedding_dedup, "TILE", 32)
    x = planted()
    bad = [(1000, None, 0), (1001, [0.0] * 24, 0), (1002, [float("nan")] + [1.0] * 23, 0), (1003, [None] + [1.0] * 23, 0),
           (1004, [1.0] * 5, 0), (1005, [float("inf")] + [1.0] * 23, 0), (1006, [], 0)]
    rows = [(k, v.tolist(), 1) for k, v in enumerate(x)]
    frame = vectors(spark, rows + rows[:3] + bad, kind).withColumn("n_links", F.lit("clash"))
    got, (n_links, component) = embedding_dedup.near_duplicates(frame)
    got = got.collect()
    near = brute_links(x, 0.9)
    expected = groups(range(len(x)), zip(*np.nonzero(near), strict=True))
    assert len(got) == len(rows) + 3 + len(bad) and n_links == "n_links_"
    for r in got:
        want = (0, r["vec_id"]) if r["vec_id"] >= 1000 else (near[r["vec_id"]].sum(), expected[r["vec_id"]])
        assert (r[n_links], r[component]) == want


def test_embeddings_of_the_table(spark):
    rows = table(spark, "embeddings")
    data = rows.orderBy("vec_id").collect()
    near = brute_links(np.array([r["embedding"] for r in data], float), 0.9)
    expected = groups(range(len(data)), zip(*np.nonzero(near), strict=True))
    for k, r in enumerate(embedding_dedup.op3_embedding_dedup(rows).orderBy("vec_id").collect()):
        assert (r["n_links"], r["component_id"]) == (near[k].sum(), data[expected[k]]["vec_id"])
        assert r["kept"] == (r["vec_id"] == r["component_id"])
    assert embedding_dedup.op3_embedding_dedup(rows.limit(0)).count() == 0


@contextlib.contextmanager
def shuffled(spark):
    """Sizes by name of the shuffle files that are written meanwhile, also of those that are removed again."""
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    found, ended = {}, threading.Event()

    def look():
        for name in (n for f in folders for n in glob.glob(f"{f}/*/shuffle_*.data")):
            with contextlib.suppress(OSError):
                found[name] = os.path.getsize(name)

    def watch():
        while not ended.wait(0.05):
            look()

    look()
    before = dict(found)
    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        yield found
    finally:
        ended.set()
        watcher.join()
        look()
        for name in before:
            del found[name]


def test_tiles_are_not_shuffled_for_each_pair(spark, monkeypatch):
    for name, value in (("TILE", 64), ("BLOCK_BYTES", 100_000), ("ROW_BYTES", 4096), ("STRIP_ROWS", 24), ("STRIP_COLUMNS", 40)):
        monkeypatch.setattr(embedding_dedup, name, value, raising=False)
    x = planted(seed=4, dim=64, n=3000)
    frame = vectors(spark, [(7 * k, v.tolist(), 1) for k, v in enumerate(x)]).coalesce(2)
    with shuffled(spark) as files:
        got, (n_links, component) = embedding_dedup.near_duplicates(frame)
        got = got.collect()
    assert 0 < sum(files.values()) < 4 * x.size * 4  # pairs of 47 tiles would be twice 47 times the vectors
    near = brute_links(x, 0.9)
    expected = groups(range(len(x)), zip(*np.nonzero(near), strict=True))
    assert {r["vec_id"]: (r[n_links], r[component]) for r in got} == {
        7 * k: (near[k].sum(), 7 * expected[k]) for k in range(len(x))}


def test_shuffle_files_go_with_their_query(spark, tmp_path):
    rows = spark.range(50_000).withColumn("r", F.rand(1)).repartition(5, "r")
    with shuffled(spark) as files, shuffles_removed(spark):
        rows.write.parquet(str(tmp_path / "rows"))
        time.sleep(0.2)
    until = time.time() + 20
    while any(os.path.exists(f) for f in files) and time.time() < until:
        time.sleep(0.1)
    assert sum(files.values()) > 100_000 and not any(os.path.exists(f) for f in files)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None


def test_vectors_with_equal_hashes_stay_apart(spark, monkeypatch):
    keys = embedding_dedup._keys
    monkeypatch.setattr(embedding_dedup, "_keys", lambda vec, turn: [k % 3 if turn < 2 else k for k in keys(vec, turn)])
    x = planted(n=160)
    rows = [(k, v.tolist(), 1) for k, v in enumerate(x)]
    got, (n_links, component) = embedding_dedup.near_duplicates(vectors(spark, rows + rows[135:145] * 2))
    near = brute_links(x, 0.9)
    expected = groups(range(len(x)), zip(*np.nonzero(near), strict=True))
    assert {(r["vec_id"], r[n_links], r[component]) for r in got.collect()} == {
        (k, near[k].sum(), expected[k]) for k in range(len(x))}


@pytest.mark.parametrize("kind", ["float", "double", "int"])
def test_both_zeros_are_equal(spark, kind):
    zeros = [0, -0.0] if kind != "int" else [0, 0]
    rows = [(k, [zeros[k % 2], zeros[k // 2 % 2], 1], 0) for k in range(8)] + [(8, [1, 0, 0], 0), (8, [0, 1, 0], 0), (9, None, 0)]
    rows = [(k, v and [(int if kind == "int" else float)(x) for x in v], n) for k, v, n in rows]
    got, (n_links, component) = embedding_dedup.near_duplicates(vectors(spark, rows, kind))
    assert sorted((r["vec_id"], r[n_links], r[component]) for r in got.collect()) == [
        *((k, 7, 0) for k in range(8)), (8, 0, 8), (8, 0, 8), (9, 0, 9)]


def test_early_stop_loses_no_pair():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 64)) * np.linspace(2, 0.1, 64)
    axes = embedding_dedup.principal_axes(x, 64)
    for threshold in (0.2, 0.5, 0.9):
        i, j = embedding_dedup.links(x, x, axes, threshold, True)
        assert set(zip(i.tolist(), j.tolist(), strict=True)) == {
            (a, b) for a, b in zip(*np.nonzero(brute_links(x, threshold)), strict=True) if a < b}


def best(x, ids, a, k):
    score = x @ x[a]
    order = [b for b in np.lexsort((ids, -score)) if b != a][:k]
    return [ids[b] for b in order]


def test_nearest_neighbours_of_the_table(spark):
    rows = table(spark, "embeddings")
    data = rows.orderBy("vec_id").collect()
    x, ids = np.array([r["embedding"] for r in data], float), [r["vec_id"] for r in data]
    found = defaultdict(list)
    for r in ann.op6_ann(rows).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    asked = [k for k, i in enumerate(ids) if i % 20 == 0]
    assert sorted(found) == sorted(ids[k] for k in asked)
    hits = 0
    for a in asked:
        got = found[ids[a]]
        assert [g[0] for g in got] == list(range(1, 21))
        assert [(-g[2], g[1]) for g in got] == sorted((-g[2], g[1]) for g in got)
        assert all(abs(g[2] - x[a] @ x[ids.index(g[1])]) < 1e-12 for g in got)
        hits += len({g[1] for g in got} & set(best(x, ids, a, 20)))
    assert hits >= 0.9 * 20 * len(asked)


def test_odd_neighbours(spark, monkeypatch):
    monkeypatch.setattr(ann, "PART", 64)
    x = planted()
    rows = [(k, v.tolist(), 1) for k, v in enumerate(x)]
    bad = [(1000, None, 0), (1020, [0.0] * 24, 0), (1040, [None] * 24, 0), (1060, [1.0], 0)]
    got = ann.op6_ann(vectors(spark, rows + rows[:30] + bad)).collect()
    assert len(got) == 20 * 13 and len({(r["query_id"], r["vec_id"]) for r in got}) == len(got)
    ids = list(range(len(x)))
    hits = sum(r["vec_id"] in best(x, ids, r["query_id"], 20) for r in got)
    assert hits >= 0.9 * len(got)
    few = ann.op6_ann(vectors(spark, rows[:5])).collect()
    assert [(r["query_id"], r["rank"]) for r in few] == [(0, 1), (0, 2), (0, 3), (0, 4)]
    assert ann.op6_ann(vectors(spark, rows[1:2])).count() == ann.op6_ann(vectors(spark, rows[:1])).count() == 0
    same = ann.op6_ann(vectors(spark, [(k, [1.0, 2.0], 0) for k in range(40)])).where("query_id = 20").orderBy("rank")
    assert [r["vec_id"] for r in same.collect()] == list(range(20))


def clustered(kind):
    """20,000 vectors around 200 centres, with one of 20 times the norm or uneven norms."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(200, 64))[rng.integers(0, 200, 20_000)] + 0.4 * rng.normal(size=(20_000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if kind == "giant":
        x[7] *= 20
    return x * np.exp(0.5 * rng.normal(size=(len(x), 1))) if kind == "uneven" else x


@pytest.mark.parametrize("kind", ["even", "giant", "uneven"])
def test_buckets_prune(kind):
    x = clustered(kind)
    top = np.linalg.norm(x, axis=1).max()
    sizes = dict(zip(*(a.tolist() for a in np.unique(ann.range_of(x, top), return_counts=True)), strict=True))
    index = ann.fit(x[::2], {j: n for j, n in sizes.items()}, top, 20)
    held, at = index.buckets(x), np.arange(1, len(x), 100)
    query, bucket = index.probes(x[at])
    met, recall = [], []
    for n, a in enumerate(at):
        seen = np.isin(held, bucket[query == n]).any(axis=1)
        met.append(seen.mean())
        recall.append(seen[[b for b in np.argsort(-(x @ x[a]))[:21] if b != a][:20]].mean())
    assert np.mean(met) <= 0.25 and np.mean(recall) >= 0.95 and np.quantile(recall, 0.1) >= 0.85


def test_neighbours_of_equal_vectors_and_ids_with_two(spark, monkeypatch):
    monkeypatch.setattr(ann, "PART", 64)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 8)).astype(np.float32).astype(float)
    rows = [(k, x[k % 7 if k % 3 == 0 else k].tolist(), 0) for k in range(300)] + [(40, x[41].tolist(), 0), (5, x[9].tolist(), 0)]
    of = defaultdict(list)
    for i, v, _ in rows:
        of[i].append(np.array(v))
    got = defaultdict(list)
    for r in ann.search(vectors(spark, rows), F.col("vec_id") % 20 == 0, 20).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(got) == list(range(0, 300, 20))
    right = 0
    for i, found in got.items():
        score = {j: max(float(a @ b) for a in of[i] for b in of[j]) for j in of if j != i}
        assert [f[0] for f in found] == list(range(1, 21)) and len({f[1] for f in found}) == 20
        assert [(-f[2], f[1]) for f in found] == sorted((-f[2], f[1]) for f in found)
        assert all(min(abs(f[2] - float(a @ b)) for a in of[i] for b in of[f[1]]) < 1e-12 for f in found)
        edge = sorted(score.values())[-20] - 1e-9
        right += sum(f[2] >= edge for f in found)
    assert right >= 0.9 * 20 * len(got)


def test_short_queries_visit_all_buckets(spark, monkeypatch):
    monkeypatch.setattr(ann, "MASSES", (1e-9,))
    monkeypatch.setattr(ann, "RECALL", 0.0)
    monkeypatch.setattr(ann, "LEAST", 0.0)
    monkeypatch.setattr(ann, "BUCKET", 2)
    x = planted()
    got = ann.op6_ann(vectors(spark, [(k, v.tolist(), 1) for k, v in enumerate(x)])).collect()
    assert all(sum(r["query_id"] == i for r in got) == 20 for i in range(0, len(x), 20))


def shingles(text):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text or "").replace("\x1c", "_").split() if w]
    return frozenset([tuple(words)] if 0 < len(words) < 5 else [tuple(words[k:k + 5]) for k in range(len(words) - 4)])


def brute_documents(texts):
    """(set size, component) of each document by counting all common shingles."""
    sets = {i: shingles(t) for i, t in texts.items()}
    lists = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            lists[g].append(i)
    edges = []
    for i, s in sets.items():
        shared = Counter(j for g in s for j in lists[g] if j < i)
        edges += [(i, j) for j, c in shared.items() if 100 * c >= 75 * (len(s) + len(sets[j]) - c)]
    part = groups(sets, edges)
    return {i: (len(s), part[i]) for i, s in sets.items()}


def copies(rng):
    """Texts with near copies at all distances, a large group around one text, a common passage, and odd ones."""
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    passage = [word() for _ in range(60)]
    texts = []
    for k in range(60):
        base = [word() for _ in range(rng.randint(5, 120))]
        texts.append(base)
        for _ in range(rng.randint(0, 4)):
            copy = list(base)
            for _ in range(rng.randint(0, 6)):
                copy[rng.randrange(len(copy))] = word()
            texts.append(copy[rng.randint(0, 3):])
    centre = [word() for _ in range(90)]
    for _ in range(60):
        copy = list(centre)
        for _ in range(rng.randint(1, 3)):
            copy[rng.randrange(90)] = word()
        texts.append(copy)
    texts += [[word() for _ in range(rng.randint(1, 100))] + passage for _ in range(60)]
    texts = [rng.choice([" ", "\n", "\t ", "\x0b"]).join(t) for t in texts]
    rng.shuffle(texts)
    return texts + [None, "", " \n", "a b c", "A b\tc", "a b d", "x " * 4000, "x " * 5000, texts[0].upper(), "É é a b c", "é é a b c"]


@pytest.mark.parametrize("seen, size", [(3, 1 << 16), (2, 20)])
def test_groups_of_similar_documents(spark, monkeypatch, seen, size):
    monkeypatch.setattr(jaccard, "SEEN", seen)
    monkeypatch.setattr(jaccard, "LIST", size)
    texts = dict(enumerate(copies(random.Random(size)), 1))
    docs = documents(spark, list(texts.values())).withColumns({c: F.lit(c) for c in ("n", "node", "component", "x", "grams")})
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.op4_jaccard(docs).collect()}
    expected = brute_documents(texts)
    assert got == expected
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, (_, c) in expected.items() if i == c)


def test_odd_documents_of_the_join(spark):
    text = "one two three four five six seven"
    docs = spark.createDataFrame([(None, text), (4, text), (4, text), (7, text), (9, None), (9, None)], "doc_id long, text string")
    assert Counter(tuple(r) for r in jaccard.op4_jaccard(docs).collect()) == Counter(
        {(None, 3, None): 1, (4, 3, 4): 2, (7, 3, 4): 1, (9, 0, 9): 2})
    assert jaccard.one_of_each(docs).count() == 5
    assert jaccard.op4_jaccard(docs.limit(0)).count() == 0


def test_documents_of_the_table(spark):
    docs = table(spark, "documents").select("doc_id", "text")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.op4_jaccard(docs).collect()}
    assert got == brute_documents({r["doc_id"]: r["text"] for r in docs.collect()})


def test_packed_sets_keep_their_order():
    rng = np.random.default_rng(5)
    hashes = np.unique(rng.integers(0, 2**64, 1000, dtype=np.uint64))
    assert (jaccard.unpack(jaccard.pack(hashes)) == (hashes >> np.uint64(24)).astype(np.int64)).all()
    assert jaccard.overlap(np.arange(0, 100, 2), np.arange(0, 100, 3)) == 17


def test_an_id_with_a_copy_and_another_text_keeps_both_links(spark):
    """3 has text A, 5 has A and B, 4 has B and a word more: all are one component."""
    rng = random.Random(9)
    a, b = (" ".join(f"{p}{rng.randrange(10**6)}" for _ in range(60)) for p in "ab")
    rows = [(3, a), (5, a), (5, b), (5, b), (4, b + " more"), (9, "something else of five words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard.op4_jaccard(docs).collect()}
    assert got == {3: 3, 4: 3, 5: 3, 9: 9}
