"""Secret scans: patterns, and a convolutional network over characters.

The base patterns find assignments, access keys and long hex strings. Candidates
are every other run of 16 key-like characters or more, shorter ones from 8 on that mix
letters with digits or cases, and the password of a connection string. A small
network judges them from their characters and those around: an embedding, one
convolution, the maximum over places, and a logistic unit. A long run is read in
windows that overlap by half, and its score is the highest. The network is trained in numpy
on labelled findings: runs that a labelled span covers against runs that none
covers. By default the base spans label
themselves, and the passwords of connection strings; then a run that no span covers may be a secret that nobody labelled, so
only runs that are plainly none count as such (words, numbers, slugs of both). Each
run is also shown without the text before it, and half of each positive after the
text before its finding, so that the run itself must be told apart from its
surroundings and at other lengths too.

All documents are learned from: every candidate is an example, and every distinct
word, in the first of its surroundings. Spark deals the examples by hash into shards,
which hold random keys and joined words of their own beside them. In each of `ROUNDS`
rounds tasks train on their shards from the same weights, which are then averaged
with their moments; candidates are met in each round, a word in one of them. A
fourth of each shard is kept out. Its scores are counted by kind in narrow bins, the
scores are calibrated on these counts, and the threshold is the highest that keeps the wanted recall there,
whatever the precision is.

Bounds: a shard holds about `SHARD` candidates or `WORDS` words, whichever are more, and
the redrawn examples; weights, moments and counts by bin are what comes to the driver.
Averages are sums of whole numbers, so reruns agree.

Defined cases: a null text counts as empty and has no span; spans are code points,
end exclusive; base spans of several kinds may overlap, the network adds none that
overlaps a base span; with fewer than `LEAST` examples of a class nothing is added;
rows that repeat are scanned each.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkgauge.llm.common import fresh
from talkgauge.plans.staging import stage

#: Candidates and words of a shard, rounds of training, and examples of a class that are needed.
SHARD, WORDS, ROUNDS, LEAST = 16_384, 131_072, 24, 20
RECALL, DRAWN = 0.99, 800
#: Weights are averaged in these units, and scores counted in bins of this width.
UNIT, BIN = 2.0**-40, 2.0**-8
#: Words that a task remembers having given.
SEEN = 500_000
#: Characters before a candidate, of it, and after it that the network reads.
BEFORE, INSIDE, AFTER = 16, 40, 8
WIDTH = BEFORE + INSIDE + AFTER
EMBED, FILTERS, SPAN = 8, 24, 5
#: Windows judged at a time.
BATCH = 256

ASSIGN = re.compile(
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
RUN = re.compile(r"[A-Za-z0-9+/_=-]{8,}")
LONG = 16
#: What makes a shorter run a candidate: letters and digits, or a capital after a small letter.
MIXED = re.compile(r"[a-z][A-Z]|[A-Za-z][^A-Za-z0-9]*[0-9]|[0-9][^A-Za-z0-9]*[A-Za-z]")
#: The password of a connection string.
LOGIN = re.compile(r"://[^\s:/@]{0,64}:([^\s/@]{4,128})@")
#: Documents with base spans or connection strings, for Spark.
FOUND = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6}|AKIA[A-Z0-9]{16}|[0-9a-f]{24}|://[^\s:/@]{0,64}:[^\s/@]{4,128}@"""
#: Where runs that are plainly none are cut, and what their parts are then.
CUT = re.compile(r"[+/_=-]+|(?<=[a-z])(?=[A-Z])")
PART = re.compile(r"[0-9]*|[A-Z]?[a-z]{2,30}|[A-Z]{1,15}|[a-z]")
#: Characters of the keys that are redrawn.
SMALL, CAPITALS, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
ALPHABETS = {
    "hex": DIGITS + "abcdef",
    "small": SMALL + DIGITS,
    "capitals": CAPITALS + DIGITS,
    "letters": SMALL + CAPITALS,
    "mixed": SMALL + CAPITALS + DIGITS,
    "base64": SMALL + CAPITALS + DIGITS + "+/_-",
    "login": SMALL + CAPITALS + DIGITS + "!#$%*",
}
#: Order of the kinds at one start.
KINDS = ("assign", "access", "hex", "model")

Span = tuple[int, int, int]


def base_spans(text: str) -> list[Span]:
    """(start, kind, end) of the base patterns by start, then kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str) -> list[tuple[int, int]]:
    logins = [m.span(1) for m in LOGIN.finditer(text)]
    found = [m.span() for m in RUN.finditer(text) if m.end() - m.start() >= LONG or MIXED.search(m[0])]
    if logins:
        found = [(s, e) for s, e in found if not any(s < end and start < e for start, end in logins)]
    return sorted(found + logins)


def pieces(start: int, end: int) -> list[tuple[int, int]]:
    """Parts of at most `INSIDE` characters that cover a run, each half over the next."""
    if end - start <= INSIDE:
        return [(start, end)]
    return [(s, s + INSIDE) for s in [*range(start, end - INSIDE, INSIDE // 2), end - INSIDE]]


def plain(run: str) -> bool:
    """Whether a run is made of words and numbers only, and not of many short ones."""
    parts = [p for p in CUT.split(run) if p]
    return all(PART.fullmatch(p) for p in parts) and len(run) >= 4 * len(parts)


def window(text: str, start: int, end: int, before: bool = True) -> np.ndarray:
    """Codes of the characters the network reads; 0 pads, 1 stands for other characters."""
    def codes(part: str) -> list[int]:
        return [c if 1 < (c := ord(x)) < 128 else 1 for x in part]

    out = np.zeros(WIDTH, np.uint8)
    if before and (part := codes(text[max(0, start - BEFORE):start])):
        out[BEFORE - len(part):BEFORE] = part
    part = codes(text[start:min(end, start + INSIDE)])
    out[BEFORE:BEFORE + len(part)] = part
    part = codes(text[end:end + AFTER])
    out[BEFORE + INSIDE:BEFORE + INSIDE + len(part)] = part
    return out


def bare(text: str, start: int, end: int, finding: int) -> np.ndarray:
    """The window of a run's second half after the text before its finding, without quotes."""
    before, run = text[max(0, finding - BEFORE):finding], text[(start + end) // 2:end]
    after = text[end:end + AFTER + 1].lstrip("\"'")
    return window(before + run + after, len(before), len(before) + len(run))


def kind_of(run: str, login: bool = False) -> str:
    """The kind of a candidate that has a threshold of its own: its alphabet, and whether it is short."""
    return "login" if login else alphabet_of(run) + ("_short" if len(run) < LONG else "")


def alphabet_of(run: str) -> str:
    """The smallest alphabet that a run's characters are of."""
    if re.search(r"[^A-Za-z0-9]", run):
        return "base64"
    if not re.search(r"[^0-9a-f]", run):
        return "hex"
    if not re.search(r"[A-Z]", run):
        return "small"
    if not re.search(r"[a-z]", run):
        return "capitals"
    return "mixed" if re.search(r"[0-9]", run) else "letters"


def inside(x: np.ndarray) -> str:
    """The run that a window shows."""
    return x[BEFORE:BEFORE + INSIDE].astype(np.uint8).tobytes().replace(b"\0", b"").decode("latin-1")


def joined(words: list[str], rng: np.random.Generator) -> str:
    """Words as they stand in paths, slugs, names and capitals, plainly none of them a key."""
    some = [words[k] for k in rng.integers(0, len(words), rng.integers(1, 5))]
    style = rng.integers(5)
    if style == 0:
        return "".join(w.capitalize() for w in some)
    if style == 1:
        return "_".join(w.upper() for w in some)
    numbers = [str(n) for n in rng.integers(0, 3000, rng.integers(0, 2))]
    return "/-_"[style - 2].join(some + numbers)


def redrawn(x: np.ndarray, y: np.ndarray, rng: np.random.Generator,
            each: int = DRAWN) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(windows, labels, kinds) in the surroundings of the windows `x`.

    1 is for random keys, `each` of every alphabet, and 0 for words of `x` that are joined, twice as many.
    """
    out, kinds = [], []
    words = [w.lower() for w in map(inside, x[y == 0]) if w.isalpha()]

    def draw(letters: str, n: int) -> str:
        return "".join(letters[k] for k in rng.integers(0, len(letters), n))

    for kind, letters in ALPHABETS.items():
        while len(kinds) < each * (1 + list(ALPHABETS).index(kind)):
            around = x[rng.integers(len(x))]
            before, after = ("".join(chr(c) for c in part if c) for part in (around[:BEFORE], around[BEFORE + INSIDE:]))
            if kind == "login":
                key = inside(around)[:24] if rng.random() < 0.3 else draw(letters, int(rng.integers(4, 25)))
                before, after = f"{before}://{draw(SMALL, int(rng.integers(2, 8)))}:", "@" + draw(SMALL, 4) + after
            else:
                top = 24 if kind == "hex" else 65  # longer hexadecimal keys are base spans
                key = draw(letters, int(rng.integers(8, LONG) if rng.random() < 0.5 else rng.integers(LONG, top)))
                path = bool(words) and kind == "base64" and rng.random() < 0.5
                if path:  # a key at the end of a path
                    key = f"/{joined(words, rng)}/{draw(ALPHABETS[rng.choice(['hex', 'small', 'mixed'])], int(rng.integers(LONG, 33)))}"
                if alphabet_of(key) != kind or (len(key) < LONG and not MIXED.search(key)):
                    continue
                of = kind_of(key)
                start = 0 if len(key) <= INSIDE else len(key) - INSIDE if path else int(rng.integers(0, len(key) - INSIDE + 1))
                before, key, after = before + key[:start], key[start:start + INSIDE], key[start + INSIDE:] + after
            out.append(window(before + key + after, len(before), len(before) + len(key)))
            kinds.append("login" if kind == "login" else of)
    keys = len(out)
    for _ in range(2 * each if words else 0):
        around, run = x[rng.integers(len(x))], joined(words, rng)
        before, after = ("".join(chr(c) for c in part if c) for part in (around[:BEFORE], around[BEFORE + INSIDE:]))
        start = max(0, int(rng.integers(0, len(run))) - INSIDE // 2) if len(run) > INSIDE else 0
        before, run, after = before + run[:start], run[start:start + INSIDE], run[start + INSIDE:] + after
        out.append(window(before + run + after, len(before), len(before) + len(run)))
        kinds.append(kind_of(run))
    return np.array(out, np.int64), (np.arange(len(out)) < keys).astype(float), kinds


@dataclass
class Network:
    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    scale: tuple[float, float] = (1.0, 0.0)
    threshold: float = 2.0
    precision: float = math.nan
    thresholds: dict[str, float] = field(default_factory=dict)

    def least(self, kind: str) -> float:
        """The threshold of a kind of candidates."""
        return self.thresholds.get(kind, self.threshold)

    def single(self) -> Network:
        """A copy in single precision, which trains faster."""
        return Network(*(w.astype(np.float32) for w in (self.embed, self.filters, self.bias, self.out)))

    def _pooled(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        e = np.take(self.embed, x, axis=0).reshape(len(x), WIDTH * EMBED)
        cols = np.lib.stride_tricks.sliding_window_view(e, SPAN * EMBED, axis=1)[:, ::EMBED]
        cols = np.ascontiguousarray(cols)
        h = (cols.reshape(-1, SPAN * EMBED) @ self.filters).reshape(len(x), -1, FILTERS) + self.bias
        at = h.argmax(axis=1)
        return cols, at, np.maximum(np.take_along_axis(h, at[:, None], 1)[:, 0], 0)

    def logits(self, x: np.ndarray) -> np.ndarray:
        pooled = self._pooled(x)[2]
        return pooled @ self.out[:-1] + self.out[-1]

    def scores(self, x: np.ndarray) -> np.ndarray:
        a, b = self.scale
        return 1 / (1 + np.exp(-np.clip(a * self.logits(x) + b, -30, 30)))

    def gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        cols, at, pooled = self._pooled(x)
        p = 1 / (1 + np.exp(-np.clip(pooled @ self.out[:-1] + self.out[-1], -30, 30)))
        d = (p - y) / len(y)
        d_out = np.append(pooled.T @ d, d.sum())
        d_h = np.outer(d, self.out[:-1]) * (pooled > 0)
        rows = np.arange(len(x))[:, None]
        best = cols[rows, at]
        d_filters = np.matmul(best.transpose(1, 2, 0), d_h.T[:, :, None])[:, :, 0].T
        # d_h summed by (character, filter, place in it), and then over filters and places
        parts = FILTERS * SPAN
        places = x[rows[:, :, None], at[:, :, None] + np.arange(SPAN)].reshape(len(x), parts).astype(np.int64)
        by_part = np.bincount((places * parts + np.arange(parts)).ravel(), np.repeat(d_h.ravel(), SPAN), 128 * parts)
        d_embed = by_part.reshape(128, parts) @ self.filters.T.reshape(parts, EMBED)
        return [d_embed, d_filters, d_h.sum(0), d_out]


def blank(seed: int = 3) -> tuple[Network, np.random.Generator]:
    """A network that has learned nothing."""
    rng = np.random.default_rng(seed)
    return Network(rng.normal(0, 0.5, (128, EMBED)), rng.normal(0, 0.3, (SPAN * EMBED, FILTERS)),
                   np.zeros(FILTERS), rng.normal(0, 0.3, FILTERS + 1)), rng


@dataclass
class Descent:
    """Adam on the logistic loss; `state` is all of it as one vector, weights and then moments."""

    net: Network
    t: int = 0

    def __post_init__(self) -> None:
        self.weights = [self.net.embed, self.net.filters, self.net.bias, self.net.out]
        self.m, self.v = [np.zeros_like(w) for w in self.weights], [np.zeros_like(w) for w in self.weights]

    def step(self, x: np.ndarray, y: np.ndarray, rate: float = 0.01) -> None:
        self.t += 1
        for w, g, a, b in zip(self.weights, self.net.gradients(x, y), self.m, self.v, strict=True):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            w -= rate * (a / (1 - 0.9**self.t)) / (np.sqrt(b / (1 - 0.99**self.t)) + 1e-8)

    @property
    def state(self) -> np.ndarray:
        return np.concatenate([w.ravel() for w in [*self.weights, *self.m, *self.v]])

    @state.setter
    def state(self, values: np.ndarray) -> None:
        at = 0
        for w in [*self.weights, *self.m, *self.v]:
            w[...] = values[at:at + w.size].reshape(w.shape)
            at += w.size


def train(x: np.ndarray, y: np.ndarray, epochs: int = 24, seed: int = 3) -> Network:
    """A network trained on examples in memory, classes weighted alike by resampling."""
    net, rng = blank(seed)
    descent = Descent(net)
    classes = [np.flatnonzero(y == k) for k in (0, 1)]
    for _ in range(max(60, epochs * len(y) // 64)):
        batch = np.concatenate([rng.choice(c, 32) for c in classes])
        descent.step(x[batch], y[batch])
    return net


def calibrate(net: Network, x: np.ndarray, y: np.ndarray, kinds: list[str] | None = None, recall: float = RECALL) -> None:
    """Platt scaling, then the highest threshold with the wanted recall, of all and of each kind."""
    of = np.array(kinds if kinds is not None else [kind_of(inside(w)) for w in x])
    settle(net, net.logits(x), y, of, np.ones(len(x)), recall)


def settle(net: Network, z: np.ndarray, y: np.ndarray, of: np.ndarray, n: np.ndarray, recall: float = RECALL) -> None:
    """The same for logits `z` that `n` examples each have, of label `y` and kind `of`."""
    def lowest(own: np.ndarray) -> float:
        order = np.flatnonzero(own)[np.argsort(s[own], kind="stable")]
        upto = np.cumsum(n[order])
        return float(s[order[np.searchsorted(upto, int((1 - recall) * upto[-1]), "right")]])

    unit = float(np.sqrt(np.average((z - np.average(z, weights=n))**2, weights=n))) or 1.0
    design, w = np.stack([z / unit, np.ones_like(z)], 1), np.array([1.0, 0.0])
    good, bad = n[y == 1].sum(), n[y == 0].sum()
    aim = np.where(y == 1, (good + 1) / (good + 2), 1 / (bad + 2))  # so that weights stay finite
    for _ in range(100):  # Newton steps of at most length 1, as full ones may run away
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        h = (design * (n * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, design.T @ (n * (aim - p)) - 1e-3 * w)
        w = w + step / max(1.0, float(np.linalg.norm(step)))
    net.scale = (float(w[0]) / unit, float(w[1]))
    s = 1 / (1 + np.exp(-np.clip(net.scale[0] * z + net.scale[1], -30, 30)))
    net.threshold = lowest(y == 1)
    for kind in np.unique(of).tolist():
        own = (y == 1) & (of == kind)
        if n[own].sum() >= LEAST:
            net.thresholds[kind] = lowest(own)
    over = s >= net.threshold
    net.precision = float(n[over & (y == 1)].sum() / n[over].sum())


def examples_of(text: str, labelled: list[tuple[int, int]], complete: bool = True) -> list[tuple[bytes, int]]:
    """(window, label) of all pieces of candidates.

    1 is for a piece that shares half of itself or of a labelled span with that span;
    one that shares less is left out. Where the labels are not complete, 0 is only for
    runs that are plainly none.
    """
    def shared(start: int, end: int) -> int:
        return max((min(e, end) - max(s, start) for s, e in labelled), default=0)

    out = []
    for run in candidates(text):
        none = shared(*run) <= 0 and (complete or plain(text[slice(*run)]))
        for start, end in pieces(*run):
            covered = any(min(e, end) - max(s, start) >= max(1, min(end - start, e - s) / 2) for s, e in labelled)
            if covered or none or (complete and shared(start, end) <= 0):
                out += [(window(text, start, end, before=b).tobytes(), int(covered)) for b in (True, False)]
            if covered:
                out.append((bare(text, start, end, min(s for s, e in labelled if s < end and start < e)).tobytes(), 1))
    return out


def words_of(text: str, labelled: list[tuple[int, int]], seen: set[str]) -> list[tuple[bytes, bytes]]:
    """(word, window) of the plain runs that are no candidates and touch no label, those not `seen`, which they join."""
    out = []
    for m in RUN.finditer(text):
        start, end = m.span()
        if end - start >= LONG or m[0] in seen or MIXED.search(m[0]) or not plain(m[0]):
            continue
        if not any(s < end and start < e for s, e in labelled):
            seen.add(m[0])
            out.append((m[0].encode(), window(text, start, end).tobytes()))
    return out


def examples(rows: DataFrame) -> DataFrame:
    """(key, x, y, word): each window of a candidate in `rows` (text, findings), and each word in its first window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        for batch in batches:
            judged, words = [], []
            for t, f in zip(batch["text"].to_pylist(), batch["findings"].to_pylist(), strict=True):
                t = t or ""
                known = ([(s, e) for s, _, e in base_spans(t)] + [m.span(1) for m in LOGIN.finditer(t)]
                         if f is None else [(x["start"], x["end"]) for x in f])
                judged += examples_of(t, known, f is not None)
                if f is None:
                    if len(seen) > SEEN:
                        seen.clear()
                    words += words_of(t, known, seen)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in judged] + [word for word, _ in words], pa.binary()),
                 pa.array([x for x, _ in judged] + [x for _, x in words], pa.binary()),
                 pa.array([y for _, y in judged] + [0] * len(words), pa.int32()),
                 pa.array([False] * len(judged) + [True] * len(words), pa.bool_())], ["key", "x", "y", "word"])

    found = rows.mapInArrow(run, "key binary, x binary, y int, word boolean")
    return found.groupBy("key", "word").agg(F.min("x").alias("x"), F.max("y").alias("y"))


def shard(number: int, x: np.ndarray, y: np.ndarray, word: np.ndarray) -> pa.Table:
    """One row with a shard's examples: its own, words every other time without surroundings, and redrawn ones.

    `turn` is the round of a word, 254 for examples of all rounds, 255 for those kept out.
    """
    x = x.copy()
    alone = np.flatnonzero(word)[1::2]
    x[alone, :BEFORE], x[alone, BEFORE + INSIDE:] = 0, 0
    drawn, labels, kinds = redrawn(x, y, np.random.default_rng([7, number]))
    of = [kind_of(inside(w)) if good else "" for w, good in zip(x, y, strict=True)] + kinds  # asked of keys only
    turn = np.full(len(of), 254, np.uint8)
    turn[np.flatnonzero(word)] = np.arange(word.sum()) % ROUNDS
    order = np.random.default_rng([8, number]).permutation(len(of))
    turn[order[::4]] = 255
    x, y = np.concatenate([x, drawn.astype(np.uint8)]), np.append(y, labels).astype(np.uint8)
    return pa.table({"x": pa.array([x.tobytes()], pa.binary()), "y": pa.array([y.tobytes()], pa.binary()),
                     "turn": pa.array([turn.tobytes()], pa.binary()), "kinds": pa.array([of], pa.list_(pa.string())),
                     "shard": pa.array([number], pa.int64())})


def shards(found: DataFrame, n: int) -> DataFrame:
    """`examples` dealt into `n` shards, a row each."""
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("key")
        x = np.frombuffer(b"".join(rows["x"].to_pylist()), np.uint8).reshape(-1, WIDTH)
        return shard(key[0].as_py(), x, rows["y"].to_numpy().astype(float), rows["word"].to_numpy())

    run.__annotations__ = {"key": tuple[pa.Scalar, ...], "rows": pa.Table, "return": pa.Table}
    dealt = found.withColumn("shard", F.pmod(F.xxhash64(F.lit("secrets"), "key"), F.lit(n)))
    return dealt.groupBy("shard").applyInArrow(
        run, "x binary, y binary, turn binary, kinds array<string>, shard bigint")


def unpack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x, y, turn = (np.frombuffer(row[c], np.uint8) for c in ("x", "y", "turn"))
    return x.reshape(-1, WIDTH), y.astype(np.float32), turn


def learn(descent: Descent, x: np.ndarray, y: np.ndarray, rng: np.random.Generator, rate: float) -> None:
    """Steps until each example was met at least once, those of the smaller class as often as the others."""
    classes = [rng.permutation(np.flatnonzero(y == k)) for k in (0, 1)]
    if not all(map(len, classes)):
        return
    for at in range(0, max(map(len, classes)), 32):
        batch = np.concatenate([np.take(c, range(at, at + 32), mode="wrap") for c in classes])
        descent.step(x[batch], y[batch], rate)


def one_round(dealt: DataFrame, net: Network, state: np.ndarray, t: int, number: int) -> tuple[np.ndarray, int]:
    """State and steps after a round: each shard goes on from `state`, and their ends are averaged."""
    rate = 0.01 * (1 - 0.9 * number / ROUNDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                x, y, turn = unpack(row)
                own = np.flatnonzero((turn == 254) | (turn == number))
                descent = Descent(net.single(), t)
                descent.state = state
                learn(descent, x[own], y[own], np.random.default_rng([9, row["shard"], number]), rate)
                values = np.rint(np.append(descent.state.astype(float) / UNIT, [descent.t, 1])).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], ["at", "value"])

    ends = dealt.select("x", "y", "turn", "shard").mapInArrow(run, "at bigint, value bigint")
    sums = ends.groupBy("at").agg(F.sum("value").alias("value")).toArrow().sort_by("at")["value"].to_numpy()
    return sums[:-2] * UNIT / sums[-1], int(sums[-2] // sums[-1])


def counted(dealt: DataFrame, net: Network) -> pa.Table:
    """(kind, y, bin, n): the kept-out examples of all shards by their logits, in bins."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                x, y, turn = unpack(row)
                own = np.flatnonzero(turn == 255)
                z = np.concatenate([net.logits(x[own[at:at + BATCH]]) for at in range(0, len(own), BATCH)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["kinds"][k] for k in own]), pa.array(y[own].astype(np.int32)),
                     pa.array(np.floor(z / BIN).astype(np.int64))], ["kind", "y", "bin"])

    rows = dealt.mapInArrow(run, "kind string, y int, bin bigint")
    return rows.groupBy("kind", "y", "bin").agg(F.count("*").alias("n")).toArrow().sort_by(
        [("kind", "ascending"), ("y", "ascending"), ("bin", "ascending")])


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", spans: str | None = None,
        sample: int | None = None) -> Network | None:
    """The network trained on all of `docs`.

    `spans` names a column of labelled findings, array<struct<start int, end int>>;
    without it the base spans are the labels. Only where `sample` is given, about so many documents,
    and so many of those with findings, are drawn by a hash of the id.
    """
    findings = F.col(spans) if spans else F.lit(None).cast("array<struct<start:int,end:int>>")
    if sample is not None:
        has = F.coalesce(F.when(findings.isNotNull(), F.size(findings) > 0).otherwise(F.col(text).rlike(FOUND)), F.lit(False))
        totals = docs.agg(F.count("*").alias("n"), F.count_if(has).alias("found")).first()
        drawn = F.pmod(F.xxhash64(F.lit("secrets"), F.col(doc_id)), F.lit(1 << 30))
        every, found = (int(min(1.0, sample / max(1, totals[k])) * (1 << 30)) for k in ("n", "found"))
        docs = docs.where(drawn < found).where((drawn < every) | has)
    found = stage(examples(docs.select(F.col(text).alias("text"), findings.alias("findings"))), "secrets_examples")
    sizes = found.agg(*[F.count_if(c).alias(n) for n, c in (
        ("good", F.col("y") == 1), ("bad", F.col("y") == 0), ("words", F.col("word")), ("judged", ~F.col("word")))]).first()
    if min(sizes["good"], sizes["bad"]) < LEAST:
        return None
    n = max(1, math.ceil(sizes["judged"] / SHARD), math.ceil(sizes["words"] / WORDS))
    dealt = stage(shards(found, n), "secrets_shards")
    net = blank()[0]
    descent = Descent(net)
    for number in range(ROUNDS):
        descent.state, descent.t = one_round(dealt, net, descent.state, descent.t, number)
    counts = counted(dealt, net)
    settle(net, counts["bin"].to_numpy() * BIN, counts["y"].to_numpy(), np.array(counts["kind"].to_pylist()),
           counts["n"].to_numpy().astype(float))
    return net


def find(text: str | None, net: Network | None) -> list[Span]:
    """All spans of a text: the base ones, and what the network adds."""
    text = text or ""
    base = base_spans(text)
    if net is None:
        return base
    free = [(s, e) for s, e in candidates(text) if not any(s < end and start < e for start, _, end in base)]
    if not free:
        return base
    parts = [(k, s, e) for k, run in enumerate(free) for s, e in pieces(*run)]
    best = np.zeros(len(free))
    for at in range(0, len(parts), BATCH):
        some = parts[at:at + BATCH]
        scores = net.scores(np.array([window(text, s, e) for _, s, e in some], np.int64))
        np.maximum.at(best, [k for k, _, _ in some], scores)
    logins = {m.span(1) for m in LOGIN.finditer(text)}
    kinds = (kind_of(text[slice(*run)], run in logins) for run in free)
    return sorted(base + [(s, 3, e) for (s, e), p, kind in zip(free, best, kinds, strict=True) if p >= net.least(kind)])


def scan(docs: DataFrame, net: Network | None, text: str = "text") -> tuple[DataFrame, str]:
    """`docs` with its spans as array<struct<kind, start, end>>, and that column's name."""
    name = fresh(docs, "findings")

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in find(t, net)]
                            for t in batch.to_pylist()],
                           pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])))

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    udf = F.arrow_udf(run, "array<struct<kind:string,start:int,end:int>>")
    return docs.withColumn(name, udf(F.col(text))), name


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op10_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every document."""
    docs = docs.select("doc_id", "text")
    rows, name = scan(docs, fit(docs))
    spans = F.col(name)

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    base = F.filter(spans, lambda s: s["kind"] != "model")
    return rows.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
                       count("hex").alias("n_hex"), F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
                       _joined(spans).alias("spans"))
