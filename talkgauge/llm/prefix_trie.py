"""The trie of conversation prefixes, rolled up by centroid decomposition.

Each distinct sequence of first turns is a node; its parent is the sequence without
its last turn. What a subtree adds up to comes from a centroid decomposition of the
parent edges: the centroid of a component splits it into parts of at most half its
size, totals of the parts are added up, and what lies at and below the centroid is
added to each node on the path from it to the component's top; the parts are split
again until none is left. A node so gets its sum in as many additions as there are
splits, at most log2 of the component's size, be the trie a chain or a star.

On Spark: a node's key is the exclusive or of hashes (128 bits) of its turns with
their places, so keys of a conversation are running values, and texts are shuffled
once, to number turns. Conversations are dealt by a hash of neighbouring ids and of
ranges of `LEVELS` depths into groups of about `GROUP_ROWS` rows; a group holds whole
paths, so each task decomposes a forest of its own in which a node that several groups
share has the part of its subtree that the group holds, and parts are added afterwards.
A node with very many members or children is thus split by conversation. A trie deeper
than `LEVELS` is cut at every `LEVELS`-th depth: the cut subtrees' totals are rolled up
as a trie of their own, with the same function, and are added to the node above each cut.

Other hot groups: turns are numbered by a sort over ranges of (conversation, turn), so
a conversation may be longer than a task can hold; running values go by cells of
`CELL` turns. Ids of the members that end at a node are sorted by range too and joined
in chunks; one task streams the chunks of a node through SHA-256, which has to be fed
in order, and holds one batch of chunks at a time. Children find their parents by a
join of staged tables, whose hot parents adaptive execution splits.

Defined cases: rows with a null conversation id are left out; null role and text count
as empty; null turns come first, and equal turns of a conversation are ordered by role,
then text; rows that repeat are turns of their own; an empty table has no nodes, not
even a root; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkgauge.llm.common import crc_of
from talkgauge.plans.staging import stage

LEVELS, GROUP_ROWS, CELL = 512, 1 << 16, 1 << 16
KEY = ["k1", "k2"]


def numbered(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(conv, part, at, x1, x2, bytes) of each turn and (conv, part, before, first, turns) of each run of turns.

    Turns are sorted over the whole table; a turn's place in its conversation is
    before + at - first + 1, where `before` counts turns in earlier parts.
    """
    slim = rows.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("row"))  # rows that repeat can be cut as well
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("row")]
    turns = stage(slim.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"),
        F.xxhash64(F.lit(1), "role", "text").alias("x1"), F.xxhash64(F.lit(2), "role", "text").alias("x2"),
        F.octet_length("text").cast("long").alias("bytes")), "turns")
    runs = turns.groupBy("conv", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("conv", "part", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
                       F.sum("n").over(Window.partitionBy("conv")).alias("turns"))
    return turns, stage(runs, "turn_runs")


def steps_of(turns: DataFrame, runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns of each conversation as they are: (conv, depth, x1, x2, bytes, length), and (conv, length)."""
    steps = turns.join(runs, ["conv", "part"]).select(
        "conv", (F.col("before") + F.col("at") - F.col("first") + 1).alias("depth"), "x1", "x2", "bytes",
        F.col("turns").alias("length"))
    return steps, runs.select("conv", F.col("turns").alias("length")).distinct()


def rebuilt_steps(turns: DataFrame, runs: DataFrame, most: int = 8, every: int = 5) -> tuple[DataFrame, DataFrame]:
    """The same for rebuilt conversations: the first h turns of the conversation of the next lower
    multiple of `every`, then the own ones after the first h; h is the id's crc32 modulo `most` + 1."""
    convs = runs.select("conv", F.col("turns").alias("own")).distinct().select(
        "conv", "own", (F.col("conv") - F.col("conv") % every).alias("base"),
        (crc_of(F.col("conv")) % (most + 1)).alias("h"))
    convs = convs.join(convs.select(F.col("conv").alias("base"), F.col("own").alias("there")), "base", "left").select(
        "conv", "base", "h", F.least("h", F.coalesce("there", F.lit(0))).alias("shared"), "own")
    convs = stage(convs.withColumn("length", F.col("shared") + F.greatest(F.col("own") - F.col("h"), F.lit(0))), "rebuilt")
    place = F.col("before") + F.col("at") - F.col("first") + 1
    placed = turns.join(runs.select("conv", "part", "first", "before").join(
        convs.select("conv", "h", "shared", "length"), "conv"), ["conv", "part"]).withColumn("place", place)
    own = placed.where("place > h").select("conv", (F.col("shared") + F.col("place") - F.col("h")).alias("depth"),
                                           "x1", "x2", "bytes", "length")
    heads = turns.where(F.col("conv") % every == 0).join(runs, ["conv", "part"]).withColumn("place", place).where(
        F.col("place") <= most).select(F.col("conv").alias("base"), "place", "x1", "x2", "bytes")
    taken = convs.where("shared > 0").join(heads, "base").where("place <= shared").select(
        "conv", F.col("place").alias("depth"), "x1", "x2", "bytes", "length")
    return own.union(taken), convs.select("conv", "length")


def members_of(steps: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per conversation and depth: (conv, depth, k1, k2, p1, p2, bytes, last), the root's included."""
    steps = stage(steps.select("conv", "depth", F.xxhash64(F.lit(1), "depth", "x1").alias("y1"),
                               F.xxhash64(F.lit(2), "depth", "x2").alias("y2"), "bytes",
                               (F.col("depth") == F.col("length")).alias("last"),
                               F.floor(F.col("depth") / CELL).alias("cell"), (F.col("length") >= CELL).alias("long")), "steps")
    earlier = Window.partitionBy("conv").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    carry = steps.where("long").groupBy("conv", "cell").agg(F.bit_xor("y1").alias("c1"), F.bit_xor("y2").alias("c2")).select(
        "conv", "cell", *[F.coalesce(F.bit_xor(c).over(earlier), F.lit(0)).alias(c) for c in ("c1", "c2")])
    inside = Window.partitionBy("conv", "cell").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    keyed = steps.join(carry, ["conv", "cell"], "left").select(
        "conv", "depth", *[F.bit_xor(f"y{i}").over(inside).bitwiseXOR(F.coalesce(f"c{i}", F.lit(0))).alias(f"k{i}") for i in (1, 2)],
        "y1", "y2", "bytes", "last")
    keyed = keyed.select("conv", "depth", "k1", "k2", *[F.col(f"k{i}").bitwiseXOR(F.col(f"y{i}")).alias(f"p{i}") for i in (1, 2)],
                         "bytes", "last")
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = convs.select("conv", zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), none.alias("p1"), none.alias("p2"),
                        zero.alias("bytes"), (F.col("length") == 0).alias("last"))
    return stage(keyed.union(root), "members")


def roots(parent: np.ndarray) -> np.ndarray:
    """The top of each node's component; tops have a parent of -1."""
    at = np.where(parent < 0, np.arange(len(parent)), parent)
    while True:
        up = at[at]
        if (up == at).all():
            return at
        at = up


def subtree_sizes(parent: np.ndarray, depth: np.ndarray) -> np.ndarray:
    size = np.ones(len(parent), np.int64)
    order = np.argsort(-depth, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
        below = rows[parent[rows] >= 0]
        np.add.at(size, parent[below], size[below])
    return size


def centroid_rollup(parent: np.ndarray, depth: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Sums of `weight` (nodes x measures) over each node's subtree, by centroid decomposition of the forest."""
    out = np.zeros_like(weight)
    if not len(parent):
        return out
    size, up = subtree_sizes(parent, depth), parent.copy()  # within components, and so kept below
    left = np.ones(len(parent), bool)
    top = roots(up)
    by_depth = np.argsort(depth, kind="stable")
    while left.any():
        # the deepest node that holds over half of its component; of such nodes there is one at each depth
        heavy = by_depth[left[by_depth]]
        heavy = heavy[2 * size[heavy] > size[top[heavy]]]
        centroid = np.full(len(parent), -1)
        centroid[top[heavy]] = heavy
        tops = np.flatnonzero(left & (up < 0))
        z = centroid[tops]
        total = np.zeros_like(weight)
        np.add.at(total, top[left], weight[left])
        # split: the centroid goes, its children become tops, and the rest above keeps its top
        is_z = np.zeros(len(parent), bool)
        is_z[z] = True
        path, cut = up.copy(), left & (up >= 0)
        cut[cut] = is_z[up[cut]]
        up[cut] = -1
        left[z] = False
        above = roots(up)
        stays = left & (above == top)
        upper = np.zeros_like(weight)
        np.add.at(upper, top[stays], weight[stays])
        below = total[tops] - upper[tops]
        at, gone = z, size[z]
        while len(at):  # all paths at once; they lie in components of their own
            out[at] += below
            size[at] -= np.where(left[at], gone, 0)
            at = path[at]
            on = at >= 0
            at, below, gone = at[on], below[on], gone[on]
        up[z] = -1
        top = roots(up)
    return out


def _roll(table: pa.Table, levels: int) -> pa.Table:
    """The subtree sums that one group's paths and weights give, one row per node."""
    depth, real = (table[c].to_numpy() for c in ("depth", "real"))
    k1, k2, p1, p2 = (table[c].to_numpy() for c in ("k1", "k2", "p1", "p2"))
    n = len(depth)
    every1, every2 = np.r_[k1, p1], np.r_[k2, p2]
    order = np.lexsort((every2, every1))
    new = np.r_[True, (np.diff(every1[order]) != 0) | (np.diff(every2[order]) != 0)]
    ident = np.empty(2 * n, np.int64)
    ident[order] = new.cumsum() - 1
    nodes, first, node = np.unique(ident[:n], return_index=True, return_inverse=True)
    place = np.full(ident.max() + 1, -1)
    place[nodes] = np.arange(len(nodes))
    parent = np.full(len(nodes), -1)
    inner = real & (depth % levels != 0)
    parent[node[inner]] = place[ident[n:][inner]]
    weight = np.zeros((len(nodes), 2), np.int64)
    np.add.at(weight, node, np.stack([table[c].to_numpy() for c in ("leaves", "saved")], axis=1))
    sums = centroid_rollup(parent, depth[first], weight)
    return pa.table({"k1": k1[first], "k2": k2[first], "leaves": sums[:, 0], "saved": sums[:, 1]})


def subtree_sums(paths: DataFrame, nodes: DataFrame, levels: int = LEVELS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(k1, k2, leaves, saved): sums over each node's subtree.

    `paths` has (conv, depth, k1, k2, p1, p2) for each conversation and depth; `nodes` each
    node once, at one of its conversations, with its own `leaves` and `saved` besides.
    """
    paths = paths.select("conv", "depth", "k1", "k2", "p1", "p2")
    nodes = nodes.select("conv", "depth", "k1", "k2", "p1", "p2", "leaves", "saved")
    size = paths.agg(F.max("depth").alias("deepest"), F.count("*").alias("rows")).first()
    zero = F.lit(0).cast("long")
    rows = paths.withColumns({"leaves": zero, "saved": zero, "real": F.lit(True)}).union(
        nodes.withColumn("real", F.lit(False)))  # parents are known from paths
    if (size["deepest"] or 0) >= levels:
        # total of each cut subtree, rolled up as a trie of the cuts, goes to the node above the cut
        cuts = stage(paths.where(F.col("depth") % levels == 0), "cuts")
        tops = cuts.select("conv", F.col("depth").alias("cut"), F.col("k1").alias("t1"), F.col("k2").alias("t2"))
        totals = nodes.withColumn("cut", F.col("depth") - F.col("depth") % levels).join(tops, ["conv", "cut"]).groupBy(
            "t1", "t2").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        higher = cuts.select("conv", "depth", "k1", "k2").join(
            tops.select("conv", (F.col("cut") + levels).alias("depth"), "t1", "t2"), ["conv", "depth"], "left").select(
            "conv", (F.col("depth") / levels).cast("long").alias("depth"), "k1", "k2", F.col("t1").alias("p1"),
            F.col("t2").alias("p2"))
        higher = stage(higher, "cut_paths")
        owners = nodes.where(F.col("depth") % levels == 0).select("conv", "depth", "k1", "k2", "p1", "p2")
        heads = owners.join(totals, (F.col("k1") == F.col("t1")) & (F.col("k2") == F.col("t2"))).select(
            "conv", (F.col("depth") / levels).cast("long").alias("depth"), "leaves", "saved").join(higher, ["conv", "depth"])
        rolled = subtree_sums(higher, stage(heads, "cut_nodes"), levels, group_rows)
        added = owners.where("depth > 0").join(rolled, KEY).select(
            "conv", (F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"),
            zero.alias("p1"), zero.alias("p2"), "leaves", "saved", F.lit(False).alias("real"))
        rows = rows.union(added)
    groups = max(1, -(-2 * size["rows"] // group_rows))
    group = F.pmod(F.xxhash64(F.floor(F.col("conv") / 8), F.floor(F.col("depth") / levels)), F.lit(groups))
    dealt = rows.select(group.alias("grp"), "depth", "k1", "k2", F.coalesce("p1", zero).alias("p1"),
                        F.coalesce("p2", zero).alias("p2"), "leaves", "saved", "real")
    parts = dealt.groupBy("grp").applyInArrow(lambda table: _roll(table, levels), "k1 long, k2 long, leaves long, saved long")
    return stage(parts.groupBy(*KEY).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")), "subtree_sums")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of sorted (k1, k2, conv) as one row each: the smallest id and the ids joined by commas."""
    for batch in batches:
        if not batch.num_rows:
            continue
        k1, k2 = batch["k1"].to_numpy(), batch["k2"].to_numpy()
        starts = np.flatnonzero(np.r_[True, (np.diff(k1) != 0) | (np.diff(k2) != 0)])
        ids, text = batch["conv"].to_numpy(), batch["conv"].cast(pa.string()).to_pylist()
        ends = np.r_[starts[1:], len(ids)]
        yield pa.RecordBatch.from_pydict({
            "k1": k1[starts], "k2": k2[starts], "first": ids[starts],
            "ids": pa.array([",".join(text[a:b]) for a, b in zip(starts, ends, strict=True)])})


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the chunks of each key, fed in order."""
    key, state = None, None
    for batch in batches:
        done = []
        for k1, k2, ids in zip(batch["k1"].to_pylist(), batch["k2"].to_pylist(), batch["ids"].to_pylist(), strict=True):
            if (k1, k2) == key:
                state.update(b"," + ids.encode())
            else:
                if key:
                    done.append((*key, state.hexdigest()))
                key, state = (k1, k2), hashlib.sha256(ids.encode())
        yield _named(done)
    if key:
        yield _named([(*key, state.hexdigest())])


def _named(rows: list[tuple]) -> pa.RecordBatch:
    k1, k2, sha = zip(*rows, strict=True) if rows else ([], [], [])
    return pa.RecordBatch.from_arrays([pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(sha, pa.string())],
                                      ["k1", "k2", "sha"])


def ends_digest(members: DataFrame) -> DataFrame:
    """(k1, k2, sha) of the nodes at which members end."""
    order = ["k1", "k2", "conv"]
    chunks = stage(members.where("last").select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _chunks, "k1 long, k2 long, first long, ids string"), "end_chunks")
    return chunks.repartition(*KEY).sortWithinPartitions(*KEY, "first").select(*KEY, "ids").mapInArrow(
        _digests, "k1 long, k2 long, sha string")


def trie(steps: DataFrame, convs: DataFrame, levels: int = LEVELS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    The last turn of a node is turn `depth` of conversation `conv_id`.
    """
    members = members_of(steps, convs)
    own = members.groupBy("depth", *KEY).agg(
        F.min("conv").alias("conv"), F.count("*").alias("n"), F.max("p1").alias("p1"), F.max("p2").alias("p2"),
        F.max("bytes").alias("bytes"), F.sum(F.col("last").cast("long")).alias("ends"))
    # a node is childless where all of its members end
    nodes = stage(own.select("conv", "depth", *KEY, "p1", "p2", "n", (F.col("ends") == F.col("n")).cast("long").alias("leaves"),
                             ((F.col("n") - 1) * F.col("bytes")).alias("saved")), "nodes")
    sums = subtree_sums(members, nodes, levels, group_rows)
    children = nodes.where("depth > 0").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
        F.count("*").alias("children"))
    facts = {"conv": "long", "depth": "long", "p1": "long", "p2": "long", "n": "long", "children": "long", "leaves": "long",
             "saved": "long", "sha": "string"}

    def facts_of(rows: DataFrame) -> DataFrame:
        return rows.select(*KEY, *[F.col(c) if c in rows.columns else F.lit(None).cast(t).alias(c) for c, t in facts.items()])

    # what is known of a node meets by its key in one shuffle
    parts = facts_of(nodes.drop("leaves", "saved")).union(facts_of(sums)).union(facts_of(children)).union(
        facts_of(ends_digest(members)))
    whole = stage(parts.groupBy(*KEY).agg(*[F.max(c).alias(c) for c in facts]), "node_facts")
    above = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv").alias("parent"))
    return whole.join(above, ["p1", "p2"], "left").select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.coalesce("children", F.lit(0)).cast("long").alias("n_children"), F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("sha", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


def prefix_trie(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text") -> DataFrame:
    """The trie of the conversations as they are."""
    return trie(*steps_of(*numbered(rows, conv_id, turn, role, text)))


def op11_prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of rebuilt conversations."""
    return trie(*rebuilt_steps(*numbered(conversations)))


ORACLE_SQL = """
WITH own AS (
    SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (  -- crc32 byte by byte and bit by bit
    SELECT c, c - c % 5 AS b,
           xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
               lambda a, ch: list_reduce(list_prepend(xor(a, ch), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                   lambda s, i: CASE WHEN s % 2 = 1 THEN xor(s // 2, 3988292384) ELSE s // 2 END)), 4294967295::BIGINT) % 9 AS h
    FROM (SELECT DISTINCT c FROM own)
), turns AS (
    SELECT v.c, 0 AS part, o.pos, o.role, o.text FROM convs v JOIN own o ON o.c = v.b AND o.pos <= v.h
    UNION ALL SELECT v.c, 1, o.pos, o.role, o.text FROM convs v JOIN own o ON o.c = v.c AND o.pos > v.h
), steps AS (
    SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, pos) AS depth, text,
           md5(role || ':' || octet_length(encode(role)) || ':' || octet_length(encode(text)) || ':' || text) AS x
    FROM turns
), members AS (
    SELECT c, depth, octet_length(encode(text)) AS bytes,
           md5(string_agg(x, ',') OVER (PARTITION BY c ORDER BY depth)) AS k FROM steps
    UNION ALL SELECT c, 0, 0, '' FROM convs
), paths AS (
    SELECT *, lag(k) OVER w AS p, lead(k) OVER w IS NULL AS ends FROM members WINDOW w AS (PARTITION BY c ORDER BY depth)
), nodes AS (
    SELECT depth, k, min(p) AS p, min(c) AS conv_id, count(*) AS n, (count(*) - 1) * max(bytes) AS saved, bool_and(ends) AS leaf,
           sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS sha
    FROM paths GROUP BY depth, k
), subtrees AS (  -- each node is below all prefixes of its smallest member
    SELECT a.k, a.depth, sum(n.leaf::BIGINT)::BIGINT AS leaves, sum(n.saved)::BIGINT AS saved
    FROM nodes n JOIN paths a ON a.c = n.conv_id AND a.depth <= n.depth GROUP BY a.k, a.depth
), children AS (
    SELECT p, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY p, depth
)
SELECT n.conv_id, n.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n AS n_convs, coalesce(c.n, 0)::BIGINT AS n_children,
       s.leaves AS n_leaves, s.saved AS saved_tokens, n.sha AS ends_sha256
FROM nodes n JOIN subtrees s ON s.k = n.k AND s.depth = n.depth
LEFT JOIN nodes u ON u.k = n.p AND u.depth = n.depth - 1
LEFT JOIN children c ON c.p = n.k AND c.depth = n.depth
"""
