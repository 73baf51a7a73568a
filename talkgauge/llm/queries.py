"""The registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from talkgauge.llm import ann, bpe, embedding_dedup, hard_negatives, jaccard, langid, line_dedup, mixing, prefix_trie, quality
from talkgauge.llm import secrets, toxicity, url_filter
from talkgauge.llm.common import prepare, read_table

Query = Callable[[SparkSession, str], DataFrame]


def _on(operator: Callable[..., DataFrame], *tables: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return operator(*[read_table(spark, sf_dir, t) for t in tables])

    return query


QUERIES: dict[str, Query] = {
    "op1_line_dedup": _on(line_dedup.op1_line_dedup, "documents"),
    "op2_url_filter": _on(url_filter.op2_url_filter, "pages"),
    "op3_embedding_dedup": _on(embedding_dedup.op3_embedding_dedup, "embeddings"),
    "op4_jaccard": _on(jaccard.op4_jaccard, "documents"),
    "op5_bpe": _on(bpe.op5_bpe, "documents"),
    "op6_ann": _on(ann.op6_ann, "embeddings"),
    "op7_langid": _on(langid.op7_langid, "documents"),
    "op8_mixing": _on(mixing.op8_mix, "documents"),
    "op9_quality": _on(quality.op9_quality, "documents", "labels"),
    "op10_secrets": _on(secrets.op10_secrets, "documents"),
    "op11_prefix_trie": _on(prefix_trie.op11_prefix_trie, "conversations"),
    "op12_hard_negatives": _on(hard_negatives.op12_hard_negatives, "embeddings"),
    "op13_toxicity": _on(toxicity.op13_toxicity, "documents", "labels"),
}

SQL = {
    "op1_line_dedup": line_dedup.ORACLE_SQL,
    "op2_url_filter": url_filter.ORACLE_SQL,
    "op8_mixing": mixing.ORACLE_SQL,
    "op11_prefix_trie": prefix_trie.ORACLE_SQL,
    "op12_hard_negatives": hard_negatives.ORACLE_SQL,
}
