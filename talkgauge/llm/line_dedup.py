"""Exact dedup of lines across documents.

Lines become (key hash, document, position) rows; the text stays behind. Rows
are range-partitioned by hash and salt, sorted by document and position in each
range, and streamed: all rows of a hash that don't belong to the first document
seen are dropped. Two such passes make the result exact without ever bringing
all holders of a common line together: the first one cuts a hash into `SALTS`
parts, the second looks only at what was first in its part, at most one document
for each salt. What comes back is a bitmap per document, in words of 64 lines
with those words left out that lose no line, and the documents apply it
to their own text.

Key: the line without `[\\x20\\x09-\\x0D]` at both ends, A-Z lower-cased. Keys
shorter than `MIN_CHARS` code points are never dropped. Hashes are 128 bits wide.

Defined cases: a null or empty text is one empty line; a null id counts as the
largest id; rows that repeat id and text are one document and get one bitmap;
rows that repeat an id with another text share the id and so keep their common
lines; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkgauge.llm.common import LOWER, SPACE, UPPER, fresh, lower_ascii
from talkgauge.plans.staging import stage

#: Parts into which the holders of one line are dealt in the first pass.
SALTS = 1024
MIN_CHARS = 10
_LAST = 2**63 - 1


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def key_of(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(SPACE)))


def _text_hash(text: Column) -> Column:
    """Tells apart texts under one id; never null."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def line_rows(docs: DataFrame, doc_id: str, text: str, min_chars: int) -> DataFrame:
    """(h1, h2, id, th, pos): hashes of the keys that can be dropped, without the text."""
    keys = F.transform(lines_of(F.col(text)), lambda line: key_of(line))
    hashed = F.transform(keys, lambda k: F.when(
        F.length(k) >= min_chars, F.struct(F.xxhash64(k).alias("h1"), F.xxhash64(F.lit(1), k).alias("h2"))))
    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(_LAST)).alias("id"),
                       _text_hash(F.col(text)).alias("th"), F.posexplode(hashed).alias("pos", "h"))
    return rows.where(F.col("h").isNotNull()).select("h.h1", "h.h2", "id", "th", "pos")


def _parts(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _stream(rows: DataFrame, keys: list[str]) -> DataFrame:
    """`rows` with `first`, the first document of each key in its range."""
    ranged = rows.repartitionByRange(_parts(rows), *keys)
    seen = Window.partitionBy(*keys).orderBy("id", "th", "pos").rowsBetween(Window.unboundedPreceding, 0)
    return ranged.withColumn("first", F.first("id").over(seen))


def dropped_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  min_chars: int = MIN_CHARS) -> DataFrame:
    """(id, th, pos) of all lines to drop."""
    rows = line_rows(docs, doc_id, text, min_chars).withColumn(
        "salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    first = stage(_stream(rows, ["h1", "h2", "salt"]).select(
        "h1", "h2", "id", "th", "pos", (F.col("id") != F.col("first")).alias("late")), "line_first")
    again = _stream(first.where(~F.col("late")).drop("late"), ["h1", "h2"])
    return first.where("late").select("id", "th", "pos").union(
        again.where(F.col("id") != F.col("first")).select("id", "th", "pos"))


def keep_bitmaps(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 min_chars: int = MIN_CHARS) -> DataFrame:
    """(id, th, words): a row for each document that loses lines.

    `words` maps the number of a word of 64 lines to its bits, a set bit being a
    kept line; words not listed are kept whole.
    """
    bits = dropped_lines(docs, doc_id, text, min_chars).groupBy(
        "id", "th", F.floor(F.col("pos") / 64).cast("int").alias("word")).agg(
        F.bitwise_not(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("pos") % 64))).alias("kept"))
    return bits.groupBy("id", "th").agg(F.map_from_entries(F.collect_list(F.struct("word", "kept"))).alias("words"))


def _kept(words: Column, pos: Column) -> Column:
    """Whether the bitmap keeps the line at `pos`."""
    word = F.coalesce(words[F.floor(pos / 64).cast("int")], F.lit(-1).cast("long"))
    return F.call_function("getbit", word, pos % 64) == 1


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                min_chars: int = MIN_CHARS) -> tuple[DataFrame, tuple[str, str, str]]:
    """`docs` with n_lines, n_dropped and kept_text, under these names or fresh ones.

    Documents that lose nothing are not touched; one join by document brings the
    bitmaps, which are much smaller than the text, to the others.
    """
    n_lines, n_dropped, kept_text, words, of, of_text = (
        fresh(docs, c) for c in ("n_lines", "n_dropped", "kept_text", "line_words", "line_doc", "line_text"))
    maps = keep_bitmaps(docs, doc_id, text, min_chars).toDF(of, of_text, words)
    joined = docs.join(
        maps, (F.coalesce(F.col(doc_id).cast("long"), F.lit(_LAST)) == F.col(of))
        & (_text_hash(F.col(text)) == F.col(of_text)), "left").drop(of, of_text)
    lines = lines_of(F.col(text))
    kept = F.filter(lines, lambda line, pos: _kept(F.col(words), pos))
    lost = F.aggregate(F.map_values(F.col(words)), F.lit(0).cast("long"),
                       lambda n, w: n + 64 - F.bit_count(w))
    return joined.withColumns({
        n_lines: F.size(lines).cast("long"),
        n_dropped: F.coalesce(lost, F.lit(0).cast("long")),
        kept_text: F.when(F.col(words).isNull(), F.coalesce(F.col(text), F.lit(""))).otherwise(
            F.array_join(kept, "\n")),
    }).drop(words), (n_lines, n_dropped, kept_text)


def with_kept_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """`docs` with the kept lines as text and their length in n_chars, columns as before."""
    done, (_, n_dropped, kept_text) = dedup_lines(docs, doc_id, text)
    lost = F.col(n_dropped) > 0
    new = {text: F.when(lost, F.col(kept_text)).otherwise(F.col(text))}
    if n_chars in docs.columns:
        new[n_chars] = F.when(lost, F.length(kept_text).cast("long")).otherwise(F.col(n_chars))
    return done.withColumns(new).select(*[F.col(f"`{c}`") for c in docs.columns])


def op1_line_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every document."""
    done, _ = dedup_lines(docs.select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_dropped",
                       F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


ORACLE_SQL = rf"""
WITH lines AS (
  SELECT doc_id, coalesce(text, '') AS text, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents
), keys AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      '{UPPER}', '{LOWER}') AS key FROM lines
), firsts AS (
  SELECT key, min(doc_id) AS first FROM keys WHERE length(key) >= {MIN_CHARS} GROUP BY key
), judged AS (
  SELECT k.doc_id, k.pos, k.line, f.first IS NOT NULL AND f.first <> k.doc_id AS gone
  FROM keys k LEFT JOIN firsts f ON k.key = f.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
