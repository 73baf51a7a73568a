"""Mixing sources to target weights by capped water-filling.

A source's target is its weight's part of the wanted total, but no more than
`max_epochs` times its size. What a clamped source can't give is shared among
the others by weight until no target is above its clamp. A source is then taken
in whole repetitions and one fractional repetition, for which its documents are
ordered by a seeded hash.

The fraction isn't drawn for each document alone, since a few long documents
would carry the total away. Hash cells are summed per source and the cut falls
between two cells: three passes, each looking at one byte of the hash, so that
a pass gathers at most 256 sums per source whatever the source's size.

Defined cases: a null source is a source of its own and comes last; a null text
has size 0; an empty table gives no rows; rows that repeat an id fall into the
same hash cell and are taken alike; sources of size 0 have target 0; sources
without a weight count as weight 0 and are not taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkgauge.llm.common import fresh, word_count
from talkgauge.plans.staging import stage

#: Bytes of the hash that order the documents of a source.
LEVELS = 3


def cycled_weights(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), source: str = "source") -> DataFrame:
    """(source, weight): the weights repeat over the sources by code point, null last."""
    sources = docs.select(F.col(source).alias("source")).groupBy("source").agg(F.lit(1).alias("one"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    picked = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    return sources.select("source", picked.alias("weight"))


def water_fill(sizes: DataFrame, total: float, max_epochs: float) -> DataFrame:
    """`sizes` (source, weight, source_size) with `target`.

    Each round clamps the sources whose share is above their clamp and raises the
    level for the rest; a clamped source stays clamped, as the level only rises.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    level = 0.0
    clamped = 0
    while True:
        over = (F.col("weight") * F.lit(level) >= cap) & F.lit(level > 0)
        row = sizes.agg(
            F.sum(F.when(over, cap).otherwise(0.0)).alias("held"),
            F.sum(F.when(over, 0.0).otherwise(F.col("weight"))).alias("free"),
            F.sum(over.cast("long")).alias("n"),
        ).first()
        if not row["free"] or (level > 0 and row["n"] == clamped):
            break
        clamped, level = row["n"], (total - row["held"]) / row["free"]
    return sizes.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)).cast("double"))


def _cell(doc_id: Column, seed: int) -> Column:
    """The first LEVELS bytes of a seeded hash of the id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 2 * LEVELS), 16, 10).cast("long")


def mix(docs: DataFrame, weights: DataFrame, words: Column | None = None, share: float = 1.5,
        max_epochs: float = 2.0, seed: int = 7, doc_id: str = "doc_id", text: str = "text",
        source: str = "source") -> tuple[DataFrame, tuple[str, str, str, str]]:
    """`docs` with size, source_size, target and copies, under these names or fresh ones.

    Returns (frame, names of the four columns). `words` is the size of a document,
    the number of words in its text by default. `copies` is how often the mix has
    the document: the whole epochs of its source, and one more below the cut.
    """
    size, source_size, target, copies, cell = (
        fresh(docs, c) for c in ("size", "source_size", "target", "copies", "mix_cell"))
    key, whole, cut = (fresh(docs, c) for c in ("mix_source", "mix_whole", "mix_cut"))
    rows = docs.select("*", (word_count(F.col(text)) if words is None else words).alias(size), _cell(F.col(doc_id), seed).alias(cell))
    slim = stage(rows.select(F.col(source).alias("source"), F.col(size).alias("size"), F.col(cell).alias("cell"))
                 .groupBy("source", "cell").agg(F.sum("size").alias("size")), "mix_cells")
    sizes = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    sizes = sizes.alias("s").join(weights.alias("w"), F.col("s.source").eqNullSafe(F.col("w.source")), "left").select(
        "s.source", "s.source_size", F.coalesce("w.weight", F.lit(0.0)).alias("weight"))
    sizes = stage(sizes, "mix_sizes")
    total = sizes.agg(F.sum("source_size")).first()[0] or 0
    filled = water_fill(sizes, share * total, max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    cuts = filled.select("source", "source_size", "target", F.floor(epochs).alias("whole")).withColumns({
        "left": F.col("target") - F.col("whole") * F.col("source_size"), "cut": F.lit(0).cast("long")})
    for at in range(LEVELS):
        cuts = _refine(slim, stage(cuts, f"mix_cuts_{at}"), at)
    cuts = stage(cuts.select(F.col("source").alias(key), F.col("source_size").alias(source_size),
                             F.col("target").alias(target), F.col("whole").alias(whole), F.col("cut").alias(cut)),
                 "mix_cuts")
    joined = rows.join(cuts, rows[source].eqNullSafe(cuts[key]), "left")
    return joined.select(
        *[F.col(f"`{c}`") for c in docs.columns], size, source_size, target,
        (F.col(whole) + (F.col(cell) < F.col(cut)).cast("long")).alias(copies),
    ), (size, source_size, target, copies)


def _refine(slim: DataFrame, cuts: DataFrame, at: int) -> DataFrame:
    """Move each source's cut on by one byte of the hash.

    `cut` is the first cell not taken, `left` the words still to be taken from
    there on. After the last byte the cell at the cut is taken if that comes nearer.
    """
    width = 256 ** (LEVELS - 1 - at)
    inside = slim.join(cuts, slim["source"].eqNullSafe(cuts["source"])).where(
        (F.col("cell") >= F.col("cut")) & (F.col("cell") < F.col("cut") + 256 * width))
    sums = inside.groupBy(cuts["source"].alias("source"), F.floor((F.col("cell") - F.col("cut")) / width).alias("byte")
                          ).agg(F.sum("size").alias("size"))
    upto = F.sum("size").over(Window.partitionBy("source").orderBy("byte"))
    steps = sums.select("source", "byte", "size", upto.alias("upto")).alias("b")
    crossing = steps.join(cuts.select(F.col("source").alias("of"), F.col("left").alias("need")),
                          F.col("source").eqNullSafe(F.col("of"))).where(F.col("upto") > F.col("need")).groupBy(
        "source").agg(F.min(F.struct("byte", "size", "upto")).alias("step"))
    c, x = cuts.alias("c"), crossing.alias("x")
    byte = F.coalesce(F.col("x.step.byte"), F.lit(256))
    before = F.col("x.step.upto") - F.col("x.step.size")
    left = F.when(F.col("x.step").isNull(), 0.0).otherwise(F.col("c.left") - before)
    if at == LEVELS - 1:
        byte = byte + F.when(F.col("x.step.upto") - F.col("c.left") < F.col("c.left") - before, 1).otherwise(0)
    return c.join(x, F.col("c.source").eqNullSafe(F.col("x.source")), "left").select(
        "c.source", "c.source_size", "c.target", "c.whole", left.alias("left"),
        (F.col("c.cut") + byte * width).cast("long").alias("cut"))


def op8_mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    slim = stage(docs.select("doc_id", "source", word_count(F.col("text")).alias("words")), "mix_docs")
    mixed, (size, source_size, target, copies) = mix(slim, cycled_weights(slim), F.col("words"))
    return mixed.select("doc_id", F.col(size).alias("size"), F.col(source_size).alias("source_size"),
                        F.col(target).alias("target"), (F.col(size) * F.col(copies)).alias("taken"))


def repeated(docs: DataFrame, weights: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as often as it is taken, columns as in `docs`."""
    mixed, names = mix(docs, weights, **options)
    copy = fresh(mixed, "copy")
    times = F.sequence(F.lit(1), F.col(names[3]).cast("int"))
    return mixed.where(F.col(names[3]) > 0).withColumn(copy, F.explode(times)).select(
        *[F.col(f"`{c}`") for c in docs.columns])


ORACLE_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('7:' || coalesce(doc_id::VARCHAR, '')), 1, 6))::BIGINT AS cell
  FROM documents
), per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
              WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight,
         2.0::DOUBLE * source_size AS cap, 1.5::DOUBLE * sum(source_size) OVER () AS total
  FROM per_source
), levels AS (
  SELECT *, (total - coalesce(sum(cap) OVER before, 0)) / sum(weight) OVER rest AS level
  FROM weighed
  WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         rest AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), filled AS (
  SELECT source, source_size,
         least(cap, weight * (SELECT max(level) FROM levels)) AS target
  FROM levels
), shares AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM filled
), steps AS (
  SELECT s.source, s.cell, f.target - f.whole * f.source_size AS need, s.size,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.cell) AS upto
  FROM (SELECT source, cell, sum(size) AS size FROM sized GROUP BY source, cell) s
  JOIN shares f ON s.source IS NOT DISTINCT FROM f.source
), cuts AS (
  SELECT source, min(cell + CASE WHEN upto - need < need - (upto - size) THEN 1 ELSE 0 END) AS cut
  FROM steps WHERE upto > need GROUP BY source
)
SELECT d.doc_id, d.size, f.source_size, f.target,
       (d.size * (f.whole + CASE WHEN d.cell < coalesce(c.cut, 1 << 24) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM sized d JOIN shares f ON d.source IS NOT DISTINCT FROM f.source
LEFT JOIN cuts c ON d.source IS NOT DISTINCT FROM c.source
"""
