"""Quality by compression with a good and a bad dictionary.

Two zstandard dictionaries are trained, one on pieces of documents labelled good
and one on pieces of those labelled bad. A text is compressed with each, piece by
piece so that the dictionary and not the text itself explains a piece, and the
difference of the two sizes is normalised by the length of the text and by the
larger size. A logistic calibration, fitted on labelled documents that gave no
piece to a dictionary, turns these and the size itself into the probability of
label 1.

Bounds: `SAMPLE` labelled documents of each class, drawn by a hash of the id, and
`PIECES` distinct pieces of each class for a dictionary of `DICTIONARY` bytes.

Defined cases: a null text counts as empty and is one empty piece; ids with both
labels, and null labels, are left out of training; without both classes every
text gets the share of label 1 (0.5 without labels); rows that repeat get the same
score, other columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkgauge.llm.common import crc_of, fresh

SAMPLE, PIECES, DICTIONARY, PIECE, LEVEL = 3_000, 4_000, 112_640, 1024, 3
#: Characters of a piece that is taken for a dictionary.
PIECE_CHARS = 1000


@dataclass
class Model:
    good: bytes
    bad: bytes
    weights: list[float]
    prior: float


def train_dictionary(pieces: list[bytes]) -> bytes:
    """A trained dictionary; of few pieces, the pieces themselves."""
    if len(pieces) >= 200 and sum(map(len, pieces)) >= DICTIONARY:
        return zstandard.train_dictionary(DICTIONARY, pieces).as_bytes()
    return b"".join(pieces)[-DICTIONARY:]


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    """A compressor without the header fields that would blur the sizes of short pieces."""
    data = zstandard.ZstdCompressionDict(dictionary) if len(dictionary) >= 8 else None
    if data is not None:
        data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False,
                                    write_checksum=False, write_dict_id=False)


def features(texts: list[str | None], good: bytes, bad: bytes) -> np.ndarray:
    """One row a text: 1, both normalised differences, and the size by the good dictionary."""
    by_good, by_bad = _compressor(good).compress, _compressor(bad).compress
    out = np.empty((len(texts), 4))
    for k, text in enumerate(texts):
        data = (text or "").encode("utf-8", "replace")
        pieces = [data[i:i + PIECE] for i in range(0, max(1, len(data)), PIECE)]
        g, b = sum(len(by_good(p)) for p in pieces), sum(len(by_bad(p)) for p in pieces)
        out[k] = 1.0, 10.0 * (b - g) / (len(data) + 1), 3.0 * (b - g) / max(g, b), min(4.0, g / (len(data) + 1))
    return out


def calibrate(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton's steps."""
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(w))
        w = w + np.linalg.solve(h, x.T @ (y - p) - 1e-3 * w)
    return w


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
        label: str = "quality", sample: int = SAMPLE) -> Model:
    """The model of `docs` and the 0/1 labels of some of them."""
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y")).where(
        "id IS NOT NULL AND y IN (0, 1)").groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("top")).where("y = top")
    totals = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    prior = totals.get(1, 0) / sum(totals.values()) if totals else 0.5
    if len(totals) < 2:
        return Model(b"", b"", [], prior)
    drawn = F.pmod(F.xxhash64(F.lit("quality"), "id"), F.lit(1 << 30))
    limit = F.when(F.col("y") == 1, min(1.0, sample / totals[1])).otherwise(min(1.0, sample / totals[0])) * (1 << 30)
    picked = known.where(drawn < limit).select("id", "y", (drawn % 2).alias("half"))
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.join(F.broadcast(picked), "id")  # about `sample` ids of each class
    good, bad = (train_dictionary(_pieces(rows.where((F.col("half") == 0) & (F.col("y") == y)))) for y in (1, 0))
    names = [f"x{k}" for k in range(4)]
    held = _with_features(rows.where("half = 1"), good, bad, "text", "x").select(
        "y", *[F.col("x")[k].alias(n) for k, n in enumerate(names)]).orderBy(F.xxhash64("id")).limit(4 * sample).toPandas()
    if held["y"].nunique() < 2:
        return Model(good, bad, [], prior)
    return Model(good, bad, calibrate(held[names].to_numpy(), held["y"].to_numpy()).tolist(), prior)


def _pieces(rows: DataFrame) -> list[bytes]:
    """Distinct pieces of whole texts, `PIECES` of them by hash."""
    starts = F.sequence(F.lit(1), F.greatest(F.length("text"), F.lit(1)), F.lit(PIECE_CHARS))
    cut = rows.select("text", F.explode(starts).alias("at")).select(
        F.expr(f"substring(text, at, {PIECE_CHARS})").alias("piece")).where("length(piece) > 0").distinct()
    return [r["piece"].encode("utf-8", "replace")
            for r in cut.orderBy(F.xxhash64("piece"), "piece").limit(PIECES).collect()]


def _with_features(rows: DataFrame, good: bytes, bad: bytes, text: str, name: str) -> DataFrame:
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            x = features(batch.to_pylist(), good, bad)
            yield pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * 4, pa.array(x.ravel()))

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return rows.withColumn(name, F.arrow_udf(run, "array<double>")(F.col(text)))


def score(docs: DataFrame, model: Model, text: str = "text") -> tuple[DataFrame, str]:
    """`docs` with the probability of label 1, and that column's name."""
    name, x = fresh(docs, "score"), fresh(docs, "quality_x")
    if not model.weights:
        return docs.withColumn(name, F.lit(model.prior)), name
    rows = _with_features(docs, model.good, model.bad, text, x)
    logit = sum((F.col(x)[k] * w for k, w in enumerate(model.weights)), F.lit(0.0))
    return rows.withColumn(name, 1 / (1 + F.exp(-logit))).drop(x), name


def held_out(doc_id: Column) -> Column:
    """The fifth of documents whose labels are never learned."""
    return crc_of(doc_id) % 5 == 0


def op9_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = fit(docs, labels.where(~held_out(F.col("doc_id"))))
    rows, name = score(docs.select("doc_id", "text"), model)
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col(name).alias("score"),
                       (F.col(name) >= threshold).cast("int").alias("predicted"))
