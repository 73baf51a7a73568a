"""N-gram Jaccard join by T-occurrence search.

A document's set holds its distinct word n-grams as hashes. Two sets of sizes x
and y that reach Jaccard j share at least T = j / (1 + j) * (x + y) n-grams, so
the search asks which documents occur in T of the inverted lists of a document's
n-grams. As in DivideSkip the T - 1 longest lists are set aside: all n-grams have
one order, frequent ones last, and of a set of n only the first n - T + k lists
are merged, in k of which the partner must occur (k = 1 + n / `MORE`). The others,
among them all long ones, are only probed, by binary search, for documents that
occur often enough in the merged lists.

The merge is a sort by n-gram: lists of one document fall away. Then
1. each list's most typical document leads it, and every document is probed
   against the leader that most of its lists name; that joins groups of copies
   with one probe a document;
2. what is left to compare are documents of one list in different components.
   The largest component of a list is compared with the others' documents, and
   the others among themselves, where the n-gram is among the first n - T + k of
   both, T and k being those of the pair; pairs that meet k times are probed.
No pair within a component is emitted, and no pair that shares a merged list and
isn't joined already is left out, so the result is exact.

Frequent n-grams are those with the highest counts seen in chunks of documents;
at most `HOT` of them are broadcast. Which they are decides speed and not results. Lists of
more than `LIST` documents are cut into parts with a leader each.

Sets keep 40 bits of each 64-bit hash; sizes are counted on 64 bits. Two n-grams
of a pair of usual documents agree by chance once in millions of pairs, and that
matters at the threshold only.

Defined cases: a null text, or one without words, has an empty set and no links; a
text shorter than n words is one n-gram; equal sets always link; a null id takes
no part and is its own component (null); rows that repeat an id are one document,
which links where one of its texts links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkgauge.llm.common import fresh
from talkgauge.llm.components import connected_components
from talkgauge.plans.staging import stage

#: Words of an n-gram, and the similarity as a fraction.
WORDS, NUMER, DENOM = 5, 75, 100
#: Broadcast frequent n-grams; n-grams counted together; times seen in such a chunk to be reported.
HOT, CHUNK, SEEN = 1 << 18, 1 << 21, 2
#: One more list is merged, and one more occurrence asked for, per so many n-grams of a pair's smaller set.
MORE = 40
#: Documents of one part of a list, and positions of the filter for documents to be probed.
LIST, FILTER = 1 << 16, 1 << 19
KEPT_WORDS = 60_000
_MIX, _LAST = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class Shingler:
    """Sets of n-gram hashes, keeping the hashes of words met so far."""

    def __init__(self, words: int = WORDS):
        self.words = words
        self.known: dict[bytes, int] = {}

    def _word(self, word: bytes) -> int:
        if len(self.known) >= KEPT_WORDS:
            self.known.clear()
        code = xxhash.xxh3_64_intdigest(word)
        if len(word) < 64:
            self.known[word] = code
        return code

    def shingles(self, text: str | None) -> np.ndarray:
        """The sorted distinct hashes of a text."""
        words = (text or "").encode("utf-8", "replace").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        known, word = self.known.get, self._word
        codes = np.array([known(w) or word(w) for w in words], np.uint64)
        n = min(self.words, len(codes))
        mixed = codes[:len(codes) - n + 1] + np.uint64(n)
        for k in range(1, n):
            mixed = mixed * _MIX + codes[k:len(codes) - n + 1 + k]
            mixed ^= mixed >> np.uint64(29)
        mixed = (mixed ^ (mixed >> np.uint64(32))) * _LAST
        return np.unique(mixed ^ (mixed >> np.uint64(32)))


def pack(hashes: np.ndarray) -> bytes:
    """The upper 40 bits of sorted hashes, still in order."""
    return (hashes >> np.uint64(24)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def unpack(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return out.view("<i8")[:, 0]


def merged(n: int) -> int:
    """How many n-grams of a set of n are in merged lists."""
    return n - -(-NUMER * n // DENOM) + 1 + n // MORE


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Common elements of two sorted sets: the smaller one probes the larger."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    at = np.searchsorted(large, small)
    return int((large[np.minimum(at, len(large) - 1)] == small).sum())


def _sets(docs: DataFrame, doc_id: str, text: str, words: int) -> DataFrame:
    """(id, n, h1, h2, grams) of each document, and rows without id and n: counted frequent n-grams."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        chunk: list[np.ndarray] = []
        held = 0

        def frequent() -> pa.RecordBatch:
            grams, counts = np.unique(np.concatenate(chunk), return_counts=True)
            grams, counts = grams[counts >= SEEN], counts[counts >= SEEN]
            return pa.RecordBatch.from_arrays(
                [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()),
                 pa.array([grams.astype("<i8").tobytes() + counts.astype("<i8").tobytes()], pa.binary())], names)

        names = ["id", "n", "h1", "h2", "grams"]
        for batch in batches:
            sets = [shingler.shingles(t.as_py()) for t in batch["text"]]
            marks = [xxhash.xxh3_128_intdigest(s.tobytes()) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array([len(s) for s in sets], pa.int32()),
                 pa.array(np.array([m >> 64 for m in marks], np.uint64).view(np.int64)),
                 pa.array(np.array([m & (2**64 - 1) for m in marks], np.uint64).view(np.int64)),
                 pa.array([pack(s) for s in sets], pa.binary())], names)
            for s in sets:
                chunk.append(s >> np.uint64(24))
                held += len(s)
                if held >= CHUNK:
                    yield frequent()
                    chunk, held = [], 0
        if held:
            yield frequent()

    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).where("id IS NOT NULL")
    return rows.mapInArrow(run, "id long, n int, h1 long, h2 long, grams binary")


def _hot(sets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent n-grams in ascending order, and their counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch["grams"]:
                both = np.frombuffer(row.as_py(), "<i8").reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], ["gram", "n"])

    counted = sets.where("id IS NULL").select("grams").mapInArrow(run, "gram long, n long")
    top = counted.groupBy("gram").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "gram").limit(HOT).toArrow()
    grams, counts = top["gram"].to_numpy(), top["n"].to_numpy()
    order = np.argsort(grams)
    return grams[order], counts[order]


def _postings(sets: DataFrame, hot: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(gram, part, id, n, pos, rare): the merged lists' rows.

    `pos` is the n-gram's place in the document's order, `rare` its share of infrequent n-grams.
    """
    shared = sets.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, counts = shared.value
        for batch in batches:
            out: list[list[np.ndarray]] = [[], [], [], [], [], []]
            for i, n, mark, data in zip(batch["id"].to_numpy(), batch["n"].to_numpy(), batch["h1"].to_numpy(),
                                        batch["grams"], strict=True):
                own = unpack(data.as_py())
                at = np.minimum(np.searchsorted(grams, own), max(0, len(grams) - 1))
                seen = np.where(grams[at] == own, counts[at], 0) if len(grams) else np.zeros(len(own), np.int64)
                first = np.argsort(seen, kind="stable")[:merged(int(n))]
                parts = seen[first] // LIST  # a list of several parts has no part 0
                for column, values in zip(out, (
                    own[first], np.where(parts > 0, int(mark) % (parts + 1) + 1, 0),
                    np.full(len(first), i), np.full(len(first), n), np.arange(len(first)),
                    np.full(len(first), 1000 * int((seen == 0).sum()) // max(1, len(own))),
                ), strict=True):
                    column.append(values)
            for s in range(0, len(out[0]), 100):
                columns = [np.concatenate(c[s:s + 100]) for c in out]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c.astype(t)) for c, t in zip(columns, ("i8", "i4", "i8", "i4", "i4", "i4"), strict=True)],
                    ["gram", "part", "id", "n", "pos", "rare"])

    return sets.where("n > 0").select("id", "n", "h1", "grams").mapInArrow(
        run, "gram long, part int, id long, n int, pos int, rare int")


def _lists(postings: DataFrame) -> DataFrame:
    """(gram, id, n, pos, leader, leader_n): rows of lists with two documents or more.

    A list's leader has the smallest share of infrequent n-grams: a text that many
    have copied and changed has fewer of its own than they have.
    """
    run = Window.partitionBy("gram", "part").orderBy("rare", "id")
    led = postings.withColumns({"lead": F.first(F.struct("id", "n")).over(run), "next": F.lead("id").over(run)})
    alone = F.col("next").isNull() & (F.col("lead.id") == F.col("id")) & (F.col("part") == 0)
    return led.where(~alone).select("gram", "id", "n", "pos", F.col("lead.id").alias("leader"), F.col("lead.n").alias("leader_n"))


def _alike(a: str, b: str) -> Column:
    """Whether sets of these sizes can be similar enough."""
    return F.least(a, b) * DENOM >= F.greatest(a, b) * NUMER


def probe(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (x, y) whose whole sets are similar enough.

    A filter of bounded size lets only sets of about the documents asked for into
    the shuffles; what it lets through beyond them finds no pair.
    """
    def place(node: str) -> Column:
        return F.pmod(F.xxhash64(node), F.lit(FILTER)).cast("int")

    pairs = stage(pairs.select("x", "y"), "jaccard_pairs")
    asked = F.broadcast(pairs.select(place("x").alias("place")).union(pairs.select(place("y"))).distinct())
    held = sets.where("n > 0").select("id", "n", "grams").withColumn("place", place("id")).join(
        asked, "place", "left_semi")
    x = held.select(F.col("id").alias("x"), F.col("n").alias("nx"), F.col("grams").alias("gx"))
    y = held.select(F.col("id").alias("y"), F.col("n").alias("ny"), F.col("grams").alias("gy"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = np.array([overlap(unpack(a.as_py()), unpack(b.as_py())) for a, b in zip(batch["gx"], batch["gy"], strict=True)],
                            np.int64)
            both = batch["nx"].to_numpy().astype(np.int64) + batch["ny"].to_numpy() - same
            keep = pa.array(same * DENOM >= both * NUMER)
            yield pa.RecordBatch.from_arrays([batch["x"].filter(keep), batch["y"].filter(keep)], ["x", "y"])

    return pairs.join(x, "x").join(y, "y").select("x", "y", "nx", "ny", "gx", "gy").mapInArrow(run, "x long, y long")


def _with_leaders(lists: DataFrame) -> DataFrame:
    """(x, y): each document and the leader that most of its lists name."""
    named = lists.where((F.col("id") != F.col("leader")) & _alike("n", "leader_n")).groupBy("id", "leader").agg(
        F.count("*").alias("c"))
    return named.groupBy("id").agg(F.max(F.struct("c", (-F.col("leader")).alias("y"))).alias("best")).select(
        F.col("id").alias("x"), (-F.col("best.y")).alias("y"))


def _across(lists: DataFrame, parts: DataFrame) -> DataFrame:
    """(x, y): pairs of different components that meet where their merged lists say they must."""
    rows = stage(lists.select("gram", "id", "n", "pos").join(
        parts.select(F.col("node").alias("id"), "component"), "id", "left").select(
        "gram", "id", "n", "pos", F.coalesce("component", "id").alias("part")), "jaccard_rows")
    sizes = rows.groupBy("gram", "part").agg(F.count("*").alias("c"))
    mixed = stage(sizes.groupBy("gram").agg(
        F.max(F.struct("c", "part"))["part"].alias("major"), F.count("*").alias("parts")).where(
        "parts > 1").select("gram", "major"), "jaccard_grams")
    rows = stage(rows.join(mixed, "gram"), "jaccard_mixed")
    others = rows.where("part <> major").select(
        "gram", *[F.col(c).alias(f"x_{c}") for c in ("id", "n", "pos", "part")])
    needed = F.ceil((F.col("x_n") + F.col("n")) * NUMER / (NUMER + DENOM))
    times = F.floor(F.least("x_n", "n") / MORE) + 1
    met = others.join(rows, "gram").where(
        "x_part <> part AND (part = major OR x_id < id)").where(_alike("x_n", "n")).where(
        (F.col("x_pos") + needed < F.col("x_n") + times) & (F.col("pos") + needed < F.col("n") + times)).select(
        F.least("x_id", "id").alias("x"), F.greatest("x_id", "id").alias("y"), times.alias("times"))
    return met.groupBy("x", "y").agg(F.count("*").alias("c"), F.max("times").alias("times")).where("c >= times").select("x", "y")


def _members(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id, rep): documents with a text whose set equals that of a smaller id, and (id) of those with no other text."""
    texts = sets.where("n > 0").select("id", "h1", "h2").distinct()
    reps = texts.groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.max("id").alias("last")).where("rep < last")
    reps = stage(reps.select("h1", "h2", "rep"), "jaccard_reps")
    copies = stage(texts.join(reps, ["h1", "h2"]).where("id <> rep").select("id", "rep"), "jaccard_members")
    held = texts.groupBy("id").agg(F.count("*").alias("texts"))
    only = copies.groupBy("id").agg(F.count("*").alias("copies")).join(held, "id").where("copies = texts").select("id")
    return copies.distinct(), only


def similar_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS) -> tuple[DataFrame, DataFrame]:
    """(id, n) of every document with an id, and (node, component) of those that link."""
    sets = stage(_sets(docs, doc_id, text, words), "jaccard_sets")
    members, copies = _members(sets)
    lists = stage(_lists(_postings(sets, _hot(sets))).join(copies, "id", "left_anti"), "jaccard_lists")
    near = probe(_with_leaders(lists), sets)
    parts = connected_components(near)
    more = probe(_across(lists, parts), sets)
    edges = members.union(parts.where("node <> component")).union(more)
    return sets.where("id IS NOT NULL").select("id", "n"), connected_components(edges)


def op4_jaccard(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    sizes, parts = similar_groups(docs.select("doc_id", "text"))
    done = sizes.join(parts, F.col("id") == F.col("node"), "left").select(
        F.col("id").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))
    shingler = docs.where("doc_id IS NULL").select("doc_id", "text")
    return done.unionByName(_without_id(shingler))


def _without_id(docs: DataFrame) -> DataFrame:
    """Documents without an id have a size, and no component."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        shingler = Shingler()
        for batch in batches:
            yield pa.array([len(shingler.shingles(t.as_py())) for t in batch], pa.int64())

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return docs.select("doc_id", F.arrow_udf(run, "long")(F.col("text")).alias("n_shingles"),
                       F.lit(None).cast("long").alias("component_id"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with the smallest id of each component, columns as before; null ids stay."""
    _, parts = similar_groups(docs, doc_id, text)
    gone = parts.where("node <> component").select(F.col("node").alias(fresh(docs, "node")))
    name = gone.columns[0]
    return docs.join(gone, F.col(doc_id).cast("long") == F.col(name), "left_anti")
