"""The pipeline's stages, each against a plain version on its own input."""

import hashlib
from collections import Counter

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from conftest import SF_DIR, rows_of
from helpers import by_sql, documents, table
from talkgauge.llm import bpe, langid, line_dedup, mixing
from talkgauge.llm.queries import QUERIES, SQL
from talkgauge.plans.staging import stage
from test_pairs import brute_documents


@pytest.fixture(scope="module")
def steps(spark):
    """What goes into each stage, and what comes out of the last."""
    docs = table(spark, "documents").unionByName(documents(spark, [None, "", "12 34", "Ein Satz\nnoch ein Satz"], 10**6))
    out = [docs]
    for name, function in corpus_pipeline.STAGES:
        out.append(stage(function(spark, out[-1], SF_DIR), name.replace(" ", "_")))
    return out


def test_stages_keep_the_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language ID", "line dedup", "n-gram Jaccard join", "mixing", "BPE"]
    assert all(frame.columns == steps[0].columns for frame in steps[1:-1])


def test_language(steps):
    judged, (pred, _) = langid.judge(steps[0], langid.fit(steps[0].where(~langid.held_out(steps[0]["doc_id"]))))
    unknown = {r["doc_id"] for r in judged.where(judged[pred] == "und").select("doc_id").collect()}
    assert unknown == {10**6, 10**6 + 1, 10**6 + 2}
    assert rows_of(steps[1]) == rows_of(steps[0].where(~steps[0]["doc_id"].isin(unknown)))


def test_lines(steps):
    digest = {r[0]: r[1] for r in by_sql(
        f"SELECT doc_id, kept_sha256 FROM ({line_dedup.ORACLE_SQL})", documents=steps[1].select("doc_id", "text"))}
    rows = steps[2].collect()
    assert {r["doc_id"]: hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in rows} == digest
    assert all(r["n_chars"] == len(r["text"]) for r in rows if r["text"] is not None)


def test_similar(steps):
    groups = brute_documents({r["doc_id"]: r["text"] for r in steps[2].select("doc_id", "text").collect()})
    kept = {i for i, (_, c) in groups.items() if i == c}
    assert rows_of(steps[3]) == sorted((r for r in rows_of(steps[2]) if r[0] in kept), key=repr)


def test_mix(steps):
    taken = {r[0]: (r[1], r[2]) for r in by_sql(
        f"SELECT doc_id, size, taken FROM ({mixing.ORACLE_SQL})", documents=steps[3].select("doc_id", "text", "source"))}
    copies = Counter(r["doc_id"] for r in steps[4].select("doc_id").collect())
    assert {i: copies.get(i, 0) * size for i, (size, _) in taken.items()} == {i: t for i, (_, t) in taken.items()}


def test_tokens(steps):
    library = Tokenizer.from_file(bpe.default_path())
    texts = {r["doc_id"]: r["text"] or "" for r in steps[4].collect()}
    rows = steps[5].collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in steps[4].select("doc_id").collect())
    for row in rows:
        ids = library.encode(texts[row["doc_id"]], add_special_tokens=False).ids
        assert row["ids"] == ids and row["n_tokens"] == len(ids)
        text = library.decode(ids, skip_special_tokens=False)
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_empty_table(spark):
    docs = documents(spark, [])
    for name, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, SF_DIR), name.replace(" ", "_"))
    assert docs.count() == 0


def test_registered():
    import __spark_entry__

    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert set(SQL) <= set(__spark_entry__.oracle_sql())
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))
