"""A corpus pipeline made of the operators in talkgauge.llm.

Each stage takes what its predecessor kept, and all but the last return the
columns of `documents`. Defined cases are those of the operators; an empty table
goes through all stages and gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkgauge.llm import bpe, jaccard, langid, line_dedup, mixing
from talkgauge.llm.common import prepare, read_table
from talkgauge.plans.staging import stage


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a language that can be told go."""
    prepare(spark)
    return langid.only_known(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: a document keeps the lines that no document of a smaller id holds."""
    prepare(spark)
    return line_dedup.with_kept_lines(docs)


def dedup_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of a group of similar documents the smallest id stays."""
    prepare(spark)
    return jaccard.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: each document as often as the mix takes it."""
    prepare(spark)
    return mixing.repeated(docs, mixing.cycled_weights(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE: doc_id, n_tokens, the ids, and the digest of what they decode to."""
    prepare(spark)
    automaton = bpe.load(bpe.default_path())
    rows, ids, decoded = bpe.round_trip(docs.select("doc_id", "text"), automaton)
    return rows.select("doc_id", F.size(ids).cast("long").alias("n_tokens"), F.col(ids).alias("ids"),
                       F.sha2(F.col(decoded).cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("language ID", known_language),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", dedup_similar),
    ("mixing", mix_sources),
    ("BPE", encode),
]

#: Neither the trained language model nor the merge table can be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
