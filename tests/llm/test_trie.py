"""Conversation prefix trie: DuckDB, a plain trie, and the rollup against plain sums."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from conftest import rows_of
from helpers import by_sql, table
from talkgauge.llm import prefix_trie
from talkgauge.llm.common import prepare

TURNS = "conv_id long, turn long, role string, text string"


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    prepare(spark)


def sequences(rows, rebuilt=True):
    own = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None),
                                      key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        own.setdefault(c, []).append((role or "", text or ""))
    if not rebuilt:
        return own
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        out[c] = own.get(base, [])[:h] + own[c][h:]
    return out


def plain(rows, rebuilt=True):
    """All nodes by dictionaries of prefixes."""
    paths = sequences(rows, rebuilt)
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
    saved = {p: (len(m) - 1) * len(p[-1][1].encode()) if p else 0 for p, m in members.items()}
    out = []
    for prefix, inside in members.items():
        children = [p for p in members if len(p) == len(prefix) + 1 and p[:-1] == prefix]
        below = [p for p in members if p[:len(prefix)] == prefix]
        leaves = sum(not any(q[:-1] == p and len(q) == len(p) + 1 for q in members) for p in below)
        ends = ",".join(map(str, sorted(c for c in inside if len(paths[c]) == len(prefix))))
        out.append((min(inside), len(prefix), hashlib.sha256(ends.encode()).hexdigest(), len(children), len(inside), leaves,
                    min(members[prefix[:-1]]) if prefix else None, sum(saved[p] for p in below)))
    return sorted(out, key=repr)


def odd_rows():
    rng = random.Random(11)
    rows = [(c, t, rng.choice(["user", "bot", None]), rng.choice(["a", "b", "ü€", "", None]))
            for c in range(40) for t in range(rng.randint(1, 12))]
    rows += [(-3, 0, "user", "a"), (-5, 0, "user", "a"), (-5, 1, "user", "b"), (-5, 2, None, "b")]
    rows += [(7, 1, "user", "tie"), (7, 1, "bot", "tie"), (7, None, "user", "first"), (None, 0, "user", "a")]
    rows += [(100, 1, "u", "x")] * 7 + [(105, 0, "u", "x" * 70_000)]  # rows that repeat, a long text
    return rows


def test_given_conversations(spark):
    turns = table(spark, "conversations")
    got = rows_of(prefix_trie.op11_prefix_trie(turns))
    assert got == by_sql(prefix_trie.ORACLE_SQL, conversations=turns)
    assert got == plain([tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()])


def test_odd_rows(spark):
    rows = odd_rows()
    turns = spark.createDataFrame(rows, TURNS)
    got = rows_of(prefix_trie.op11_prefix_trie(turns))
    assert got == plain(rows)
    assert got == by_sql(prefix_trie.ORACLE_SQL, conversations=turns)
    assert rows_of(prefix_trie.prefix_trie(turns)) == plain(rows, rebuilt=False)


@pytest.mark.parametrize("levels,group_rows", [(2, 16), (3, 64), (5, 1 << 16)])
def test_deep_tries_are_cut(spark, levels, group_rows):
    rng = random.Random(levels)
    rows = [(c, t, "u", rng.choice("ab") if t > 20 else "s") for c in range(12) for t in range(rng.randint(1, 40))]
    steps = prefix_trie.steps_of(*prefix_trie.numbered(spark.createDataFrame(rows, TURNS)))
    assert rows_of(prefix_trie.trie(*steps, levels=levels, group_rows=group_rows)) == plain(rows, rebuilt=False)


def test_running_keys_of_a_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CELL", 4)
    rows = [(c, t, "u", "ab"[(t * c) % 2]) for c in (0, 1, 2) for t in range(23)]
    assert rows_of(prefix_trie.prefix_trie(spark.createDataFrame(rows, TURNS))) == plain(rows, rebuilt=False)


def test_empty_and_clashing_columns(spark):
    assert rows_of(prefix_trie.op11_prefix_trie(spark.createDataFrame([], TURNS))) == []
    rows = odd_rows()[:60]
    clash = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], TURNS + ", depth int, k1 int, part int")
    assert rows_of(prefix_trie.op11_prefix_trie(clash)) == plain(rows)


def test_ends_of_many_members_are_streamed(spark):
    """All conversations are equal: one chain, at whose end every id stands in several chunks."""
    rows = [(5 * c, 0, "u", "same") for c in range(3000)]
    turns = spark.createDataFrame(rows, TURNS)
    got = rows_of(prefix_trie.prefix_trie(turns))
    ends = ",".join(str(5 * c) for c in range(3000))
    assert [r for r in got if r[1] == 1] == [(0, 1, hashlib.sha256(ends.encode()).hexdigest(), 0, 3000, 1, 0, 2999 * 4)]


@pytest.mark.parametrize("shape", ["chain", "star", "random", "forest"])
def test_centroid_rollup(shape):
    rng = np.random.default_rng(3)
    n = 600
    parent = {"chain": np.arange(n) - 1, "star": np.r_[-1, np.zeros(n - 1, int)],
              "random": np.r_[-1, [rng.integers(0, i) for i in range(1, n)]],
              "forest": np.array([-1 if i % 50 == 0 else rng.integers(i - i % 50, i) for i in range(n)])}[shape]
    depth = np.zeros(n, int)
    for i in range(n):
        depth[i] = 0 if parent[i] < 0 else depth[parent[i]] + 1
    weight = rng.integers(-5, 100, (n, 2))
    want = weight.copy()
    for i in range(n - 1, -1, -1):
        if parent[i] >= 0:
            want[parent[i]] += want[i]
    assert (prefix_trie.centroid_rollup(parent, depth, weight) == want).all()
