"""BPE encoding and decoding by a tokenization automaton.

The automaton reads tokens and accepts, of all ways to cut a word into tokens,
exactly the one that the merges give. It starts as one state with an arc for
each base symbol. For each merge (u, v) -> w in turn a gadget is put in: the
state reached by u is copied without its arc for v, arcs for u lead to the copy,
and each state that had a path u v gets an arc w to where that path led. So the
state after a token depends on the token alone, and is kept as what it has lost
and when; after w it starts as the state after v was then. Whether a state has an
arc follows from those losses along the tokens' parts, which takes a few lookups
instead of a row of 49,000 arcs for each of 49,000 states; the arcs that a corpus
uses are filled into a table as they are met.

A word is encoded in one pass over its symbols: a prefix has one accepted cut, so
for each end there is one token whose arc leaves the state reached where that
token starts. The time is linear in the word. Decoding emits the arcs'
labels.

Normalising and pre-splitting are those of the tokenizer's file. Texts of Latin
letters take compiled patterns that agree with the library's; all others go
through the library's own normaliser and splitter.

Defined cases: a null text counts as empty and has no tokens; special tokens in a
text become their ids; other columns stay as they are, and rows that repeat are
encoded each; an empty table gives no rows. A worker keeps the words met last, up
to `WORDS` new ones and as many from before.
"""

from __future__ import annotations

import itertools
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkgauge.llm.common import fresh

#: Encoded words that a worker keeps in each of two generations, and arcs of the filled-in table.
WORDS, ARCS = 100_000, 300_000
_NONE: dict[int, int] = {}
#: Texts of these characters alone are normalised and split by the patterns below.
LATIN = re.compile("[\t\n\r\x20-\x7e\xa0-\u012f\u0131-\u024f]*")
SPECIALS = re.compile(r"(<\|startoftext\|>|<\|endoftext\|>)")
_L = "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f"
_N = "0-9\xb2\xb3\xb9\xbc-\xbe"
PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^\t\n\r \xa0{_L}{_N}]+")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = itertools.count(256)
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


Tree = dict[str, tuple["Tree", int]]


class Automaton:
    """Deterministic tokenization automaton of a merge list whose words end in `end`."""

    def __init__(self, spec: dict):
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        vocab = model["vocab"]
        self.labels = {i: t for t, i in vocab.items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.ids = {self._symbols(t): i for t, i in vocab.items()}
        self.tree: Tree | None = None
        self.time: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.removed: dict[int, dict[int, int]] = {}
        for t, (u, v) in enumerate(model["merges"]):
            self._gadget(t, vocab[u], vocab[v], vocab[u + v])
        self.arcs: dict[int, bool] = {}
        self.worker: Encoder | None = None

    def _symbols(self, token: str) -> str:
        """One character a symbol; a word's last symbol is another one than the same byte elsewhere."""
        if not token.endswith(self.end) or token == self.end:
            return token
        stem = token[: -len(self.end)]
        return stem[:-1] + chr(ord(stem[-1]) + 0x1000)

    def _gadget(self, t: int, u: int, v: int, w: int) -> None:
        """Merge number t: the state after u loses its arc for v, and w leads to the state after v of now."""
        if self.has_arc(u, v):
            self.removed.setdefault(u, {})[v] = t
            self.time[w], self.parts[w] = t, (u, v)
        else:  # v is never read after u, so w has no arc anywhere
            self.ids.pop(self._symbols(self.labels[w]), None)

    def has_arc(self, last: int, token: int) -> bool:
        """Whether the state after the token `last` (-1: the start) has an arc for `token`.

        An arc for w = u v was added where there was one for u when w was made, so
        the token's left parts are looked up as of then. The state after w = u v is
        the state after v as of then, less what the state after w lost since.
        """
        until, y = 1 << 60, token
        while True:
            below, x = until, last
            while x >= 0:
                born = self.removed.get(x, _NONE).get(y)
                if born is not None and born < below:
                    return False
                if x not in self.parts:
                    break
                below, x = min(below, self.time[x]), self.parts[x][1]
            if y not in self.parts:
                return True
            until, y = min(until, self.time[y] + 1), self.parts[y][0]

    def _arc(self, last: int, token: int) -> bool:
        """`has_arc`, kept in the table."""
        if len(self.arcs) >= ARCS:
            self.arcs.clear()
        has = self.arcs[last + 1 << 20 | token] = self.has_arc(last, token)
        return has

    def _tree(self) -> Tree:
        """The vocabulary as a tree over symbols: by symbol, the tree below and the token that ends here, or -1."""
        tree: Tree = {}
        for label in sorted(self.ids):
            node = tree
            for symbol in label[:-1]:
                node = node.setdefault(symbol, ({}, -1))[0]
            below = node[label[-1]][0] if label[-1] in node else {}
            node[label[-1]] = (below, self.ids[label])
        return tree

    def encode_word(self, symbols: str) -> list[int]:
        """Tokens of a word given as symbols, the last one a word-ending symbol.

        Follows arcs, longest labels first, and goes back where none leads on. As
        one path leads to each place, a place that was left is never tried again.
        """
        if self.tree is None:
            self.tree = self._tree()
        n, tree, arcs = len(symbols), self.tree, self.arcs
        path: list[int] = []
        places: list[int] = []
        untried: list[list[tuple[int, int]]] = []
        dead: set[int] = set()
        at, last = 0, -1
        while at < n:
            labels, node, end = [], tree, at
            for symbol in symbols[at:]:
                found = node.get(symbol)
                if found is None:
                    break
                end += 1
                node, y = found
                if y >= 0:
                    labels.append((end, y))
            places.append(at)
            untried.append(labels)
            while True:
                while not untried[-1]:
                    dead.add(places.pop())
                    untried.pop()
                    path.pop()
                    last = path[-1] if path else -1
                end, y = untried[-1].pop()
                if end not in dead:
                    has = arcs.get(last + 1 << 20 | y)
                    if self._arc(last, y) if has is None else has:
                        break
            path.append(y)
            at, last = end, y
        return path


def load(path: str) -> Automaton:
    """The automaton of a tokenizer file."""
    with open(path, encoding="utf-8") as file:
        return Automaton(json.load(file))


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """A worker's encoder: splitter, automaton and the words met so far."""

    def __init__(self, automaton: Automaton):
        self.automaton = automaton
        self.symbols = dict(enumerate(byte_symbols()))
        self.words: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self._library = None

    def _word(self, piece: str) -> tuple[int, ...]:
        if len(self.words) >= WORDS:
            self.words, self.older = {}, self.words
        found = self.older.get(piece)
        if found is not None:
            self.words[piece] = found
            return found
        text = piece.encode("utf-8").decode("latin-1").translate(self.symbols)
        found = tuple(self.automaton.encode_word(text[:-1] + chr(ord(text[-1]) + 0x1000)))
        if len(piece) < 64:
            self.words[piece] = found
        return found

    def _pieces(self, text: str) -> list[str]:
        if LATIN.fullmatch(text):
            return PIECES.findall(text.lower())
        if self._library is None:
            from tokenizers import Regex, normalizers, pre_tokenizers

            self._library = (
                normalizers.Sequence([normalizers.NFC(), normalizers.Replace(Regex(r"\s+"), " "),
                                      normalizers.Lowercase()]),
                pre_tokenizers.Split(
                    Regex(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"), "removed", invert=True),
            )
        normal, split = self._library
        return [p for p, _ in split.pre_tokenize_str(normal.normalize_str(text))]

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        parts = SPECIALS.split(text) if text and "<|" in text else [text or ""]
        for part in parts:
            if part in self.automaton.special:
                out.append(self.automaton.special[part])
                continue
            known, word = self.words.get, self._word
            out += itertools.chain.from_iterable([known(p) or word(p) for p in self._pieces(part)])
        return out


def encode(docs: DataFrame, automaton: Automaton, text: str = "text") -> tuple[DataFrame, str]:
    """`docs` with the ids of each text as array<int>, and that column's name."""
    name = fresh(docs, "ids")
    shared = docs.sparkSession.sparkContext.broadcast(automaton)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        automaton = shared.value
        encoder = automaton.worker = automaton.worker or Encoder(automaton)  # kept by a reused worker
        for batch in batches:
            ids = [np.array(encoder.encode(t.as_py()), np.int32) for t in batch]
            offsets = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            yield pa.ListArray.from_arrays(offsets, np.concatenate([np.zeros(0, np.int32), *ids]))

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return docs.withColumn(name, F.arrow_udf(run, "array<int>")(F.col(text))), name


def decode(rows: DataFrame, automaton: Automaton, ids: str = "ids") -> tuple[DataFrame, str]:
    """`rows` with the labels of the ids joined by spaces, and that column's name."""
    name = fresh(rows, "decoded")
    shared = rows.sparkSession.sparkContext.broadcast(automaton.labels)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        labels = shared.value
        for batch in batches:
            yield pa.array([" ".join([labels[i] for i in x.as_py() or ()]) for x in batch], pa.string())

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return rows.withColumn(name, F.arrow_udf(run, "string")(F.col(ids))), name


def round_trip(docs: DataFrame, automaton: Automaton, text: str = "text") -> tuple[DataFrame, str, str]:
    """`docs` with ids and decoded text, and those columns' names; one Python worker does both."""
    ids, decoded, both = fresh(docs, "ids"), fresh(docs, "decoded"), fresh(docs, "bpe_both")
    shared = docs.sparkSession.sparkContext.broadcast(automaton)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        automaton = shared.value
        encoder = automaton.worker = automaton.worker or Encoder(automaton)  # kept by a reused worker
        label = automaton.labels.__getitem__
        for batch in batches:
            found, texts = [], []
            for t in batch:
                own = encoder.encode(t.as_py())
                found.append(np.array(own, np.int32))
                texts.append(" ".join(map(label, own)))
            offsets = np.cumsum([0, *map(len, found)], dtype=np.int32)
            lists = pa.ListArray.from_arrays(offsets, np.concatenate([np.zeros(0, np.int32), *found]))
            yield pa.StructArray.from_arrays([lists, pa.array(texts, pa.string())], ["ids", "decoded"])

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    rows = docs.withColumn(both, F.arrow_udf(run, "ids array<int>, decoded string")(F.col(text)))
    return rows.withColumns({ids: F.col(both)["ids"], decoded: F.col(both)["decoded"]}).drop(both), ids, decoded


def op5_bpe(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    automaton = load(path or default_path())
    rows, ids, decoded = round_trip(docs.select("doc_id", "text"), automaton)
    return rows.select(
        "doc_id", F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(ids, " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col(decoded).cast("binary"), 256).alias("decoded_sha256"))
