"""Nearest neighbours by multiprobe p-stable hashing.

Vectors are put into ranges by norm, each down to 1 / `RATIO` of the one above, and each
range has an index of its own, so that a few long vectors don't press the others
together. In a range the largest inner product becomes the smallest distance by
one more component: a vector gets what its norm lacks to the range's largest one, a
query is scaled to that norm and gets 0, so both lie on one sphere. A table projects on a few
Gaussian directions, drawn with the covariance of the vectors, and cuts each projection into
slots; the slots of a vector are its bucket. The directions grow with the logarithm
of the table, so that a bucket holds about `BUCKET` vectors at any size. For a query, the
chance that a neighbour at the usual distance lies in a bucket is that of its range
times those of its slots, known from where the query's own projection falls. Buckets are
visited in the order of that chance until the visited ones add up to `mass`; those
below `FLOOR` are not listed, as their number grows with the table. Candidates of all tables are merged,
and ranked by their exact inner product on the vectors as given.

Equal vectors are one vector with the smallest `k` + 1 of its ids, which is all that a query
can return of them, and are asked once. Vectors and queries meet by part: buckets that differ in
their last directions only, with about `PART` vectors. A query goes to a part once, with the
buckets it visits there, and is compared with the vectors of those alone. A part of twice that many ids, or queries, is cut by
hashes into blocks. A block keeps each query's best `k` + 1 ids, the query's own among
them. A query that has met fewer ids than it must return visits all buckets.

Bounds: directions, slots, shares of the ranges, usual distances and mass are fitted on
`SAMPLE` distinct vectors, those of the smallest hashes; the mass rises until the sample's own mean
recall is `RECALL` and its second percentile `LEAST`. Every vector is indexed.

Defined cases: vectors that are null, zero, of another length than most, or with
null or non-finite components take no part; a query gets all candidates if they
are fewer than `k`; ties go to the smaller id; an id with several vectors is one
candidate and asks with all of them, a pair of ids counting at the best of its vectors' pairs that
are met; a query's own id is never its candidate.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkgauge.llm.vectors import dimension, matrix, usable
from talkgauge.operators.lookup import lookup_join
from talkgauge.plans.staging import stage

SAMPLE, TABLES, SLOTS, RANGES, BUCKET, PART = 20_000, 2, 2, 80, 64, 16_384
RATIO, RECALL, LEAST, FLOOR = 2**0.5, 0.97, 0.7, 1e-5
#: Queries of the sample, and queries that are judged at a time.
ASKED, STEP = 256, 64
MASSES = (*(m / 20 for m in range(2, 18)), *(m / 100 for m in range(90, 100)), 0.995)


@dataclass
class Range:
    """The index of vectors up to the norm `top`: `directions` and their slots, buckets from `first` on."""

    top: float
    directions: int
    first: int
    edges: np.ndarray
    reach: float = 1.0
    share: float = 1.0

    @property
    def size(self) -> int:
        return SLOTS**self.directions

    def lifted(self, x: np.ndarray) -> np.ndarray:
        """Vectors with the component that makes inner products distances."""
        rest = np.sqrt(np.maximum(0, self.top**2 - (x**2).sum(1)))
        return np.concatenate([x, rest[:, None]], axis=1)

    def scaled(self, q: np.ndarray) -> np.ndarray:
        """Queries at the largest norm, with the added component 0."""
        q = q * (self.top / np.linalg.norm(q, axis=1, keepdims=True))
        return np.concatenate([q, np.zeros((len(q), 1))], axis=1)


@dataclass
class Index:
    directions: np.ndarray
    ranges: dict[int, Range]
    top: float
    mass: float = 2.0

    def buckets(self, x: np.ndarray) -> np.ndarray:
        """The bucket of each vector in each table."""
        out, of = np.zeros((len(x), TABLES), np.int64), range_of(x, self.top)
        for j in np.unique(of):
            r, rows = self.ranges[j], np.flatnonzero(of == j)
            p = np.einsum("nd,tdk->ntk", r.lifted(x[rows]), self.directions[:, :, :r.directions])
            slots = (p[..., None] >= r.edges).sum(-1)
            out[rows] = r.first + np.arange(TABLES) * r.size + (slots * SLOTS ** np.arange(r.directions)).sum(-1)
        return out

    def chances(self, q: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, bucket, chance of a neighbour) of all buckets of a table that are not below `FLOOR`."""
        parts = []
        for r in self.ranges.values():
            directions, asked = self.directions[t, :, :r.directions], r.scaled(q)
            p = asked @ directions
            lean = 1 - r.reach**2 / (2 * r.top**2)
            across = np.sqrt(np.maximum((directions**2).sum(0) - (p / r.top) ** 2, 1e-12) / (len(directions) - 1))
            spread = r.top * math.sqrt(max(1e-12, 1 - lean**2)) * across
            z = (r.edges[t] - lean * p[..., None]) / spread[..., None]
            upto = np.concatenate([np.zeros((*z.shape[:2], 1)), _normal(z), np.ones((*z.shape[:2], 1))], axis=2)
            slot = np.diff(upto, axis=2)
            i, code, chance = np.arange(len(q)), np.zeros(len(q), np.int64), np.full(len(q), r.share)
            for k in range(r.directions):
                chance = (chance[:, None] * slot[i, k]).ravel()
                code = (code[:, None] + SLOTS**k * np.arange(SLOTS)).ravel()
                keep = chance >= FLOOR
                i, code, chance = np.repeat(i, SLOTS)[keep], code[keep], chance[keep]
            parts.append((i, r.first + t * r.size + code, chance))
        return tuple(np.concatenate(column) for column in zip(*parts, strict=True))

    def order(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, bucket, chance of the buckets that come before it) for all tables."""
        parts = []
        for s in range(0, len(q), STEP):
            for t in range(TABLES):
                i, bucket, chance = self.chances(q[s:s + STEP], t)
                by = np.lexsort((bucket, -chance, i))
                i, bucket, chance = i[by], bucket[by], chance[by]
                before = np.cumsum(chance) - chance
                parts.append((s + i, bucket, before - before[np.searchsorted(i, i)]))
        return tuple(np.concatenate(column) for column in zip(*parts, strict=True))

    def probes(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, bucket) of all visits."""
        i, bucket, before = self.order(q)
        return i[before < self.mass], bucket[before < self.mass]


def range_of(x: np.ndarray, top: float) -> np.ndarray:
    """The norm range of each vector, from 0 for those above `top` / `RATIO`."""
    return np.clip(np.floor((np.log(top) - np.log(np.linalg.norm(x, axis=1))) / math.log(RATIO)), 0, RANGES - 1).astype(int)


def _normal(z: np.ndarray) -> np.ndarray:
    """The normal distribution function, by its logistic approximation."""
    return 1 / (1 + np.exp(-np.clip(1.5976 * z + 0.07056 * z**3, -40, 40)))


def _met(i: np.ndarray, bucket: np.ndarray, near: np.ndarray) -> np.ndarray:
    """Whether query n visits one of the buckets near[n, k] of its neighbours k."""
    wide = int(max(bucket.max(initial=0), near.max(initial=0))) + 1
    wanted = np.arange(len(near))[:, None, None] * wide + near
    return np.isin(wanted, np.unique(i * wide + bucket)).any(-1)


def fit(x: np.ndarray, sizes: dict[int, int], top: float, k: int, seed: int = 11) -> Index:
    """The index of a sample `x` of a table whose norm ranges hold `sizes` vectors."""
    dim, of = x.shape[1], range_of(x, top)
    index, first = Index(np.zeros((TABLES, dim + 1, 0)), {}, top), 0
    cov = np.zeros((dim + 1, dim + 1))
    for j, n in sorted(sizes.items()):
        drawn = (of == j).sum()
        directions = max(0, round(math.log(n / BUCKET, SLOTS))) if drawn >= 10 * SLOTS else 0
        r = index.ranges[j] = Range(top / RATIO**j, directions, first, np.zeros((TABLES, directions, SLOTS - 1)))
        first += TABLES * r.size
        if drawn:
            lifted = r.lifted(x[of == j]) / r.top
            lifted -= lifted.mean(0)
            cov += lifted.T @ lifted
    value, axes = np.linalg.eigh(cov)
    value = np.maximum(value, 1e-6 * value.max()) if value.max() > 0 else np.ones(dim + 1)
    normal = np.random.default_rng(seed).normal(size=(TABLES, dim + 1, max(r.directions for r in index.ranges.values())))
    index.directions = np.einsum("de,tek->tdk", axes * np.sqrt(value / value.max()), normal)
    for j, r in index.ranges.items():
        if r.directions:
            p = np.einsum("nd,tdk->ntk", r.lifted(x[of == j]), index.directions[:, :, :r.directions])
            r.edges = np.moveaxis(np.quantile(p, np.arange(1, SLOTS) / SLOTS, axis=0), 0, -1)
    at = np.arange(0, len(x), max(1, len(x) // ASKED))
    score = x[at] @ x.T
    score[np.arange(len(at)), at] = -np.inf
    near = np.argsort(-score, axis=1, kind="stable")[:, :min(k, len(x) - 1)]
    if near.shape[1] == 0:
        return index
    for j, r in index.ranges.items():
        i, m = np.nonzero(of[near] == j)
        r.share = (len(i) + 0.5) / (near.size + 0.5 * len(index.ranges))
        gap = np.linalg.norm(r.scaled(x[at][i]) - r.lifted(x[near[i, m]]), axis=1)
        r.reach = max(float(np.median(gap)), 1e-9 * r.top) if len(i) else r.top
    i, bucket, before = index.order(x[at])
    held = index.buckets(x)[near]
    for mass in MASSES:
        recall = _met(i[before < mass], bucket[before < mass], held).mean(1)
        if recall.mean() >= RECALL and np.quantile(recall, 0.02) >= LEAST:
            index.mass = mass
            return index
    return index


def best_of(table: pa.Table, queries: pa.Table, k: int, dim: int) -> pa.Table:
    """(h1, h2, vec_id, score): each query's best `k` ids of the buckets it visits in a block, ties to smaller ids.

    A query whose `buckets` are null visits all.
    """
    parts: list[tuple] = []
    if table.num_rows and queries.num_rows:
        lists = table["ids"].combine_chunks()
        ids, owner = lists.flatten().to_numpy(), np.repeat(np.arange(table.num_rows), lists.value_lengths().to_numpy())
        by_id = np.lexsort((owner, ids))
        ids, vec, of = ids[by_id], matrix(table["vec"], dim)[owner[by_id]], table["bucket"].to_numpy()[owner[by_id]]
        starts = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
        ends, n = np.append(starts[1:], len(ids)), min(k, len(starts))
        held, first = np.unique(np.sort(of), return_index=True)
        columns = dict(zip(held.tolist(), np.split(np.argsort(of, kind="stable"), first[1:]), strict=True))
        h1, h2 = queries["h1"].to_numpy(), queries["h2"].to_numpy()
        for s in range(0, queries.num_rows, 256):
            some = queries.slice(s, 256)
            q, visited = matrix(some["vec"], dim), some["buckets"].to_pylist()
            askers: dict[int, list[int]] = {}
            for row, buckets in enumerate(visited):
                for bucket in columns if buckets is None else buckets:
                    askers.setdefault(bucket, []).append(row)
            whole = np.full((len(q), len(ids)), -np.inf)
            for bucket in askers.keys() & columns.keys():
                whole[np.ix_(askers[bucket], columns[bucket])] = q[askers[bucket]] @ vec[columns[bucket]].T
            score = np.maximum.reduceat(whole, starts, axis=1) if len(starts) < len(ids) else whole
            at = np.argpartition(-score, n - 1, axis=1)[:, :n]
            edge = np.take_along_axis(score, at, 1).min(axis=1, keepdims=True)
            for r in np.flatnonzero((np.isfinite(edge) & (score >= edge)).sum(axis=1) > n):  # ties at the edge: smaller ids
                at[r] = np.argsort(-score[r], kind="stable")[:n]
            i, j = np.repeat(np.arange(len(q)), n), at.ravel()
            i, j = i[np.isfinite(score[i, j])], j[np.isfinite(score[i, j])]
            pick = starts[j]
            for m in np.flatnonzero(ends[j] - pick > 1):  # an id with several vectors: the best of them
                pick[m] += whole[i[m], pick[m]:ends[j[m]]].argmax()
            parts.append((h1[s + i], h2[s + i], ids[pick], np.einsum("nd,nd->n", q[i], vec[pick])))
    types = (np.int64, np.int64, np.int64, np.float64)
    columns = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.zeros(0, t) for t in types]
    return pa.table(dict(zip(("h1", "h2", "vec_id", "score"), columns, strict=True)))


def search(rows: DataFrame, queries: Column, k: int = 20, vec_id: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for the rows that `queries` picks the best `k` of all other rows."""
    dim = dimension(rows, vec)
    ident = F.col(vec_id).cast("long")
    slim = rows.where(usable(F.col(vec), dim) & ident.isNotNull()).select(
        ident.alias("id"), F.transform(F.col(vec).cast("array<double>"), lambda x: x + 0.0).alias("vec"),
        F.coalesce(queries, F.lit(False)).alias("asks"))
    slim = slim.withColumns({"h1": F.xxhash64("vec"), "h2": F.xxhash64(F.lit("ann"), "vec")})
    slim = stage(slim.dropDuplicates(["id", "h1", "h2", "asks"]), "ann_rows")
    few = F.row_number().over(Window.partitionBy("h1", "h2", "asks").orderBy("id"))
    ids = F.slice(F.array_sort(F.array_distinct(F.collect_list("id"))), 1, k + 1)
    distinct = stage(slim.withColumn("place", few).where(F.col("place") <= k + 1).groupBy("h1", "h2").agg(
        F.first("vec").alias("vec"), F.max("asks").alias("asks"), ids.alias("ids")), "ann_distinct")
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))
    facts = distinct.agg(F.count("*").alias("n"), F.max(norm).alias("top"), F.max("asks").alias("asks")).first()
    if not facts["n"] or not facts["asks"]:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sizes = {r["range"]: r["n"] for r in _sizes(distinct, facts["top"], dim).collect()}
    drawn = distinct.where(F.pmod("h1", F.lit(1 << 30)) < int(min(1.0, 2 * SAMPLE / facts["n"]) * (1 << 30)))
    x = matrix(drawn.orderBy("h2", "h1").limit(SAMPLE).select("vec").toArrow()["vec"], dim)
    index = fit(x, sizes, facts["top"], k)
    placed = stage(_placed(distinct, index, dim), "ann_placed")
    asked = distinct.where("asks").select("h1", "h2", "vec")
    best = stage(_packed(_meet(placed, _visits(asked, index, dim), k + 1, dim), k + 1), "ann_best")
    # A query that met fewer ids than it must return visits every bucket.
    must = min(k + 1, slim.agg(F.count_distinct("id")).first()[0])
    short = stage(asked.join(best.where(F.size("best") >= must).select("h1", "h2"), ["h1", "h2"], "left_anti"), "ann_short")
    if not short.isEmpty():
        last = max(r.first + TABLES * r.size - 1 for r in index.ranges.values()) // (PART // BUCKET)
        everywhere = short.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(last).cast("long"))).alias("part"),
                                  "h1", "h2", "vec", F.lit(None).cast("array<long>").alias("buckets"))
        again = _packed(_meet(placed, everywhere, k + 1, dim), k + 1)
        best = best.where(F.size("best") >= must).unionByName(again)
    return _ranked(slim.where("asks").select("id", "h1", "h2"), best, k)


def _sizes(distinct: DataFrame, top: float, dim: int) -> DataFrame:
    """How many vectors each norm range holds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, n = np.unique(range_of(matrix(batch["vec"], dim), top), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(of, pa.int32()), pa.array(n, pa.int64())], ["range", "n"])

    return distinct.select("vec").mapInArrow(run, "range int, n long").groupBy("range").agg(F.sum("n").alias("n"))


def _placed(distinct: DataFrame, index: Index, dim: int) -> DataFrame:
    """Every distinct vector once for each table: (part, bucket, ids, vec)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = index.buckets(matrix(batch["vec"], dim))
            for t in range(TABLES):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(of[:, t] // (PART // BUCKET)), pa.array(of[:, t]), batch["ids"], batch["vec"]],
                    ["part", "bucket", "ids", "vec"])

    return distinct.select("ids", "vec").mapInArrow(run, "part long, bucket long, ids array<long>, vec array<double>")


def _visits(asked: DataFrame, index: Index, dim: int) -> DataFrame:
    """Every query once for each part, with the buckets it visits there: (part, h1, h2, vec, buckets)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for s in range(0, whole.num_rows, STEP):
                batch = whole.slice(s, STEP)
                i, bucket = index.probes(matrix(batch["vec"], dim))
                by = np.lexsort((bucket, i))
                i, bucket = i[by], bucket[by]
                part = bucket // (PART // BUCKET)
                new = np.flatnonzero(np.append(True, (i[1:] != i[:-1]) | (part[1:] != part[:-1])))
                at = pa.array(i[new])
                lists = pa.ListArray.from_arrays(pa.array(np.append(new, len(i)), pa.int32()), pa.array(bucket))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[new]), batch["h1"].take(at), batch["h2"].take(at), batch["vec"].take(at), lists],
                    ["part", "h1", "h2", "vec", "buckets"])

    return asked.mapInArrow(run, "part long, h1 long, h2 long, vec array<double>, buckets array<long>")


def _meet(placed: DataFrame, visits: DataFrame, k: int, dim: int) -> DataFrame:
    """(h1, h2, vec_id, score): the best `k` ids of every block for each query that visits it."""
    held = placed.groupBy("part").agg(F.sum(F.size("ids")).alias("held"))
    seen = visits.groupBy("part").agg(F.count("*").alias("seen"))
    large = stage(held.join(seen, "part").select(
        "part", F.ceil(F.col("held") / (2 * PART)).alias("blocks"), F.ceil(F.col("seen") / (2 * PART)).alias("askers"))
        .where("blocks > 1 OR askers > 1"), "ann_large")

    def dealt(rows: DataFrame, own: str, other: str, key: Column) -> DataFrame:
        rows = lookup_join(rows, large, "part", "left").fillna(1, ["blocks", "askers"])
        return rows.select(*[c for c in rows.columns if c not in ("blocks", "askers")], F.pmod(key, own).alias(own[:-1]),
                           F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)).alias(other[:-1]))

    vectors = dealt(placed, "blocks", "askers", F.xxhash64(F.lit("block"), F.col("ids")))
    askers = dealt(visits, "askers", "blocks", F.xxhash64(F.lit("asker"), "h1", "h2"))
    keys = ["part", "block", "asker"]
    return vectors.groupBy(*keys).cogroup(askers.groupBy(*keys)).applyInArrow(
        lambda a, b: best_of(a, b, k, dim), "h1 long, h2 long, vec_id long, score double")


def _packed(found: DataFrame, k: int) -> DataFrame:
    """(h1, h2, best): the best `k` ids of each query as an array, best first."""
    rank = F.row_number().over(Window.partitionBy("h1", "h2").orderBy(F.desc("score"), "vec_id"))
    found = found.groupBy("h1", "h2", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", rank)
    return found.where(F.col("rank") <= k).groupBy("h1", "h2").agg(
        F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("best"))


def _ranked(asks: DataFrame, best: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) of all ids that ask; a vector that very many ask with is salted."""
    total = asks.count()
    limit = max(PART, total // 1000)
    hot = F.broadcast(asks.groupBy("h1", "h2").count().where(F.col("count") > limit)  # fewer than 1,000 rows
                      .select("h1", "h2", F.ceil(F.col("count") / limit).alias("salts")))
    salts = F.coalesce("salts", F.lit(1).cast("long"))
    asks = asks.join(hot, ["h1", "h2"], "left").withColumn("salt", F.pmod(F.xxhash64("id"), salts)).drop("salts")
    best = best.join(hot, ["h1", "h2"], "left").withColumn(
        "salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1))).drop("salts")
    others = F.filter("best", lambda b: b["vec_id"] != F.col("id"))
    rows = asks.join(best, ["h1", "h2", "salt"]).select("id", F.posexplode(F.slice(others, 1, k)).alias("pos", "b"))
    found = rows.select(F.col("id").alias("query_id"), (F.col("pos") + 1).alias("rank"), "b.vec_id", "b.score")
    if asks.groupBy("id").count().where("count > 1").isEmpty():
        return found
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", rank)
    return found.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_ann(rows: DataFrame) -> DataFrame:
    """query_id, rank, vec_id, score: the 20 nearest of each row whose id is divisible by 20."""
    rows = rows.select("vec_id", "embedding")
    return search(rows, F.col("vec_id") % 20 == 0)
