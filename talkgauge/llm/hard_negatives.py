"""Hard negatives by slot-decomposed selection.

Each anchor has its nearest rows of the same label as positives. A negative is a row
of another label whose score lies in a window below a positive's score, from `margin`
hundredths of it up to itself. The windows of one anchor overlap; their upper limits,
the positives' scores, cut the line of scores into disjoint slots, so that a row falls
into one slot only. Tasks score all rows against all anchors of a block and keep the
first `k` rows of each slot, as does the merge of their results. Then one pass over an
anchor's slots from the lowest to the highest merges each with what is below it: the
first `k` rows at or below a positive's score, of which those above the window's lower
limit are its answer. No row is looked at once per window, and no list is longer than
`k` per slot.

Anchors are a stated set of queries and meet every row. Rows stay where they are: a
block of `BLOCK` anchors, a fixed number of vectors, goes to all tasks, and there is
one pass over the staged rows per block and phase. What comes back is at most `k` rows
an anchor and slot from each task, joined by a partial top-k.

Scores are exact integers: products are added as doubles where no sum can pass 2^53,
else as Python integers; a score beyond a long is held at the end of a long.

Defined cases: rows with a null id, a null label, a null vector, null or non-finite
components, or another length than most take no part, zero vectors do; of rows that
repeat an id the one of the smallest label, then the smallest vector, is taken; ties go
to the smaller id; an anchor without positives, or a positive without negatives, gives
no rows; columns of other names are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from heapq import merge
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkgauge.llm.vectors import dimension
from talkgauge.plans.staging import stage

#: Anchors of a block, scores held at once in a task, and rows scored together.
BLOCK, CELLS, STRIP = 8_192, 1 << 20, 4_096
#: Sums of products below this are exact in doubles, a hundred times as many as well.
EXACT = 2.0 ** 46
_LONG = np.iinfo(np.int64)
RESULT = {"anchor_id": "long", "positive_id": "long", "rank": "int", "negative_id": "long", "positive_score": "long",
          "negative_score": "long"}
#: (group, score, id) as arrays; a group is an anchor's number, or that of an anchor's slot.
Found = tuple[np.ndarray, np.ndarray, np.ndarray]


@dataclass
class Anchors:
    """A block of anchors: ids, labels, vectors, and after the first phase the positives' scores, padded by -inf."""
    ids: np.ndarray
    labels: np.ndarray
    vecs: np.ndarray
    limits: np.ndarray | None = None


def scores(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """All inner products of whole-number rows, exact: doubles, or Python integers for large numbers."""
    if np.abs(x).max(initial=0) * np.abs(y).max(initial=0) * x.shape[1] < EXACT:
        return x @ y.T
    exact = [np.array([[int(v) for v in row] for row in m], dtype=object).reshape(m.shape) for m in (x, y)]
    return np.clip(exact[0] @ exact[1].T, _LONG.min, _LONG.max)


def firsts(found: Found, k: int) -> Found:
    """The `k` first rows of each group: higher scores first, then smaller ids."""
    group, score, ids = found
    if not len(group):
        return found
    order = np.lexsort((ids, -score, group))
    starts = np.flatnonzero(np.r_[True, np.diff(group[order]) != 0])
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
    kept = order[rank < k]
    return group[kept], score[kept], ids[kept]


def joined(parts: list[Found]) -> Found:
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True)) if parts else tuple(np.zeros(0, np.int64) for _ in range(3))


def padded(limits: list[list[int]], width: int) -> np.ndarray:
    """Falling limits of each anchor in a row, -inf after the last; Python integers where doubles are not exact."""
    table = np.array([row + [-np.inf] * (width - len(row)) for row in limits], dtype=object).reshape(len(limits), width)
    return table.astype(np.float64) if all(abs(v) < EXACT for row in limits for v in row) else table


def same_label(anchors: Anchors, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, k: int) -> Found:
    """The `k` nearest rows of each anchor's label, itself left out; a group is an anchor."""
    out = []
    for label in np.intersect1d(labels, anchors.labels):
        rows, wanted = np.flatnonzero(labels == label), np.flatnonzero(anchors.labels == label)
        step = max(1, CELLS // len(rows))
        for s in range(0, len(wanted), step):
            part = wanted[s:s + step]
            value = scores(anchors.vecs[part], x[rows])
            a, r = np.nonzero(anchors.ids[part][:, None] != ids[rows][None, :])
            out.append(firsts((part[a], value[a, r], ids[rows][r]), k))
    return joined(out)


def other_labels(anchors: Anchors, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, k: int, margin: int) -> Found:
    """The `k` first rows of another label in each slot; a group is anchor * number of slots + slot.

    Slot i holds the scores above limit i + 1 up to limit i, from `margin` hundredths of
    limit i on, as no window that reaches into the slot goes lower.
    """
    out, limits = [], anchors.limits
    width = limits.shape[1]
    step = max(1, CELLS // max(1, len(anchors.ids)))
    for s in range(0, len(x), step):
        part = slice(s, s + step)
        value = scores(anchors.vecs, x[part])
        a, r = np.nonzero((value <= limits[:, :1]) & (anchors.labels[:, None] != labels[part][None, :]))
        value = value[a, r]
        slot = (limits[a] >= value[:, None]).sum(axis=1) - 1
        fit = (100 * value >= margin * limits[a, slot]).astype(bool)
        out.append(firsts((a[fit] * width + slot[fit], value[fit], ids[part][r[fit]]), k))
    return joined(out)


def answer(positives: list[tuple[int, int]], slots: dict[int, list[tuple[int, int]]], k: int,
           margin: int) -> list[tuple[int, int, int, int, int]]:
    """(positive, rank, negative, positive's score, negative's score) of one anchor.

    `positives` are (score, id) in order, `slots` the sorted (-score, id) of each. From
    the lowest slot up, `below` are the `k` first rows of the slot and all under it.
    Of equal limits the last one's slot holds the rows, and the others' are empty.
    """
    out, below = [], []
    for slot in range(len(positives) - 1, -1, -1):
        below = list(islice(merge(slots.get(slot, []), below), k))
        score, ident = positives[slot]
        fit = [(-s, n) for s, n in below if -100 * s >= margin * score]
        out += [(ident, rank, n, score, s) for rank, (s, n) in enumerate(fit, 1)]
    return out


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dim)


def _pass(rows: DataFrame, dim: int, k: int, run: Callable[[np.ndarray, np.ndarray, np.ndarray], Found]) -> DataFrame:
    """(grp, score, id): what `run` finds in all rows, cut to `k` a group in each task before it is shuffled, and after."""
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, held = joined([]), []
        for batch in chain(batches, [None]):
            if batch is not None:
                held.append((batch["id"].to_numpy(), batch["label"].to_numpy(), _matrix(batch["vec"], dim)))
            if held and (batch is None or sum(len(h[0]) for h in held) >= STRIP):
                best = firsts(joined([best, run(*(np.concatenate(c) for c in zip(*held, strict=True)))]), k)
                held = []
        group, score, ids = best
        for s in range(0, len(group), STRIP):
            part = slice(s, s + STRIP)
            yield pa.RecordBatch.from_arrays([pa.array(c[part].astype(np.int64)) for c in (group, score, ids)],
                                             ["grp", "score", "id"])

    found = rows.mapInArrow(over, "grp long, score long, id long")
    order = Window.partitionBy("grp").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = 5, k: int = 5, margin: int = 80,
                   vec_id: str = "vec_id", label: str = "label", vec: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Vectors hold whole numbers; `is_anchor` is a condition on `rows`. A negative's score
    lies between `margin` hundredths of the positive's and the positive's.
    """
    dim = dimension(rows, vec)
    good = F.coalesce((F.size(vec) == dim) & F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))),
                      F.lit(False))
    slim = rows.where(good & F.col(label).isNotNull() & F.col(vec_id).isNotNull()).select(
        F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
        F.col(vec).cast("array<double>").alias("vec"), is_anchor.alias("anchor"))
    slim = slim.groupBy("id").agg(F.min(F.struct("label", "vec", "anchor")).alias("row")).select("id", "row.*")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch["vec"].flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["label"], batch["anchor"], pa.array([v.tobytes() for v in flat], pa.binary())],
                ["id", "label", "anchor", "vec"])

    packed = stage(slim.mapInArrow(pack, "id long, label long, anchor boolean, vec binary"), "negative_rows")
    anchors = packed.where("anchor")
    total = anchors.count()
    blocks = -(-total // BLOCK)
    out = rows.sparkSession.createDataFrame([], ", ".join(f"{n} {t}" for n, t in RESULT.items()))
    for b in range(blocks):
        wanted = anchors.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).orderBy("id")
        out = out.union(_block(packed, wanted, dim, positives, k, margin))
    return out


def _block(packed: DataFrame, wanted: DataFrame, dim: int, positives: int, k: int, margin: int) -> DataFrame:
    """The result of one block of anchors, whose vectors are a bounded number."""
    table = wanted.select("id", "label", "vec").toArrow()
    block = Anchors(table["id"].to_numpy(), table["label"].to_numpy(), _matrix(table["vec"], dim))
    near = _pass(packed, dim, positives, lambda *rows: same_label(block, *rows, positives))
    held: list[list[tuple[int, int]]] = [[] for _ in block.ids]  # at most `positives` for each anchor of the block
    for row in near.orderBy("grp", "rank").collect():
        held[row["grp"]].append((row["score"], row["id"]))
    block.limits = padded([[s for s, _ in found] for found in held], positives)
    slots = stage(_pass(packed, dim, k, lambda *rows: other_labels(block, *rows, k, margin)), "slots")
    ids = block.ids

    def merged(part: pa.Table) -> pa.Table:
        by_anchor: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for row in part.sort_by([("grp", "ascending"), ("rank", "ascending")]).to_pylist():
            anchor, slot = divmod(row["grp"], positives)
            by_anchor.setdefault(anchor, {}).setdefault(slot, []).append((-row["score"], row["id"]))
        out = [(int(ids[at]), *line) for at, lists in by_anchor.items() for line in answer(held[at], lists, k, margin)]
        columns = zip(*out, strict=True) if out else [[]] * len(RESULT)
        return pa.table({n: pa.array(c, pa.int32() if n == "rank" else pa.int64())
                         for n, c in zip(RESULT, columns, strict=True)})

    # an anchor has at most `positives` * `k` rows here, so those of 256 anchors are a bounded number
    return slots.withColumn("part", F.floor(F.col("grp") / (256 * positives))).groupBy("part").applyInArrow(
        merged, ", ".join(f"{n} {t}" for n, t in RESULT.items()))


def op12_hard_negatives(rows: DataFrame) -> DataFrame:
    """Hard negatives of every hundredth row over all rows, on scaled whole numbers and labels changed for a seventh."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vec = F.transform(F.col("embedding").cast("array<double>"), lambda x: F.when(
        F.abs(x) < 1e13, F.floor(x * 256).cast("double")).otherwise(x * 256))  # large doubles are whole
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    slim = rows.select("vec_id", label.alias("label"), F.when(whole, vec).alias("embedding"))
    return hard_negatives(slim, F.col("vec_id") % 100 == 0)


ORACLE_SQL = """
WITH good AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), one AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, v FROM good
    QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY label, v) = 1
), scored AS (
    SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
           CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
    FROM one a JOIN one r ON a.vec_id <> r.vec_id
    WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank,
       n.id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
 AND 80 * p.positive_score <= 100 * n.score AND n.score <= p.positive_score
QUALIFY rank <= 5
"""
