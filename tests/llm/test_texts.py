"""BPE, language ID, quality and secrets: library, held-out accuracy, plain patterns."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from helpers import documents, table
from talkgauge.llm import bpe, langid, quality, secrets
from talkgauge.plans.staging import stage
from talkgauge.llm.common import prepare

ODD = [None, "", " \n\t", "It's the THÉ wörld's 3½ <|endoftext|> x<|startoftext|>y <|end", "İΣς ﬁ 中文 \U0001f600 é\x85\x1c", "a" * 50_000 + "=" * 20_000, "Δοκιμή ǅ ʰ"]


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    prepare(spark)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_path())


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, "documents")


def test_encoding_equals_the_library(spark, docs, library):
    docs = docs.select("doc_id", "text").union(documents(spark, ODD, 10**6).select("doc_id", "text"))
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    rows = bpe.op5_bpe(docs).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row["doc_id"]], add_special_tokens=False).ids
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        text = library.decode(ids, skip_special_tokens=False)
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_automaton_on_random_words(library):
    encoder, rng = bpe.Encoder(bpe.load(bpe.default_path())), random.Random(4)
    alphabet = list("abcdefghinorstaeiount") + ["é", "ß", "'s", " ", "1", "中", "\U0001f600", "İ", "\xa0", "!?"]
    for _ in range(4000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25)))
        assert encoder.encode(text) == library.encode(text, add_special_tokens=False).ids, text


def test_automaton_of_few_merges():
    """Each gadget leaves one path per word, the one that merging in order gives."""
    merges = [("a", "a"), ("aa", "a"), ("a", "b</w>"), ("aa", "aa")]
    symbols = ["a", "b", "a</w>", "b</w>"]
    vocab = {t: i for i, t in enumerate(symbols + [x + y for x, y in merges])}
    automaton = bpe.Automaton({"model": {"end_of_word_suffix": "</w>", "vocab": vocab, "merges": merges}, "added_tokens": []})
    rng = random.Random(1)
    for _ in range(2000):
        word = "".join(rng.choice("aab") for _ in range(rng.randint(1, 12)))
        parts = [*word[:-1], word[-1] + "</w>"]
        for a, b in merges:
            k = 0
            while k + 1 < len(parts):
                if (parts[k], parts[k + 1]) == (a, b):
                    parts[k:k + 2] = [a + b]
                k += 1
        assert automaton.encode_word(word[:-1] + chr(ord(word[-1]) + 0x1000)) == [vocab[p] for p in parts]


def test_columns_of_encoding_may_clash(spark):
    docs = documents(spark, ["one two"]).withColumns({"ids": F.lit(1), "Decoded": F.lit(2)})
    rows, ids = bpe.encode(docs, bpe.load(bpe.default_path()))
    rows, decoded = bpe.decode(rows, bpe.load(bpe.default_path()), ids)
    assert (ids, decoded) == ("ids_", "decoded_") and rows.first()[decoded] == "one</w> two</w>"
    assert bpe.op5_bpe(documents(spark, [])).count() == 0


def test_language_of_held_out_documents(docs):
    rows = langid.op7_langid(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"] and r["lang"] is not None]
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_odd_languages(spark, docs):
    model = langid.fit(docs)
    odd = documents(spark, [None, "", "12 34 !?", "²", "Ω", "the and of to", "der die und ist"], lang=None)
    got, (pred, score) = langid.judge(odd.withColumn("score", F.lit("x")), model)
    rows = [(r[pred], r[score]) for r in got.orderBy("doc_id").collect()]
    assert score == "score_" and rows[:4] == [("und", 0.0)] * 4
    assert [r[0] for r in rows[5:]] == ["en", "de"] and rows[4][0] in model.langs
    untaught = langid.fit(odd)
    assert untaught.langs == [] and langid.judge(odd, untaught)[0].where("lang_pred <> 'und'").count() == 0
    assert langid.only_known(documents(spark, [])).count() == 0


def test_only_unknown_languages_are_dropped(spark, docs):
    """A short document of a low score stays."""
    some = docs.unionByName(documents(spark, [None, "12 34", "Zzxq"], 10**6))
    kept = {r["doc_id"] for r in langid.only_known(some).select("doc_id").collect()}
    assert kept == {r["doc_id"] for r in some.collect() if re.search(r"[^\W\d_]", r["text"] or "")}


def test_shorter_grams_only_for_words_unknown_at_longer_ones(docs):
    model = langid.fit(docs)
    scorer = langid.Scorer(model)
    word = next(w for w in model.words if len(w) > 5)
    known = [g for n in range(4, 0, -1) for g in model.grams[n - 1]]
    assert "<" + word[:3] in known
    assert (scorer.backoff(word) == model.gram_logs[3][[model.grams[3][g] for k in range(len(word) - 1)
            if (g := f"<{word}>"[k:k + 4]) in model.grams[3]]].mean(axis=0)).all()


def test_quality_of_held_out_documents(spark):
    import os
    from conftest import SF_DIR

    folder = os.path.join(os.path.dirname(SF_DIR.rstrip("/")), "sf0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.op9_quality(docs, labels).join(labels, "doc_id").where("held_out").collect()
    good = [r["predicted"] for r in rows if r["quality"] == 1]
    bad = [r["predicted"] for r in rows if r["quality"] == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.35 * len(bad)


def test_odd_quality(spark):
    docs = documents(spark, ["good text of words"] * 5 + [None, ""])
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (None, 1), (3, None), (99, 0)], "doc_id long, quality int")
    rows = quality.op9_quality(docs, labels).collect()
    assert len(rows) == 7 and all(0 <= r["score"] <= 1 for r in rows) and len({r["score"] for r in rows[:5]}) == 1
    assert quality.op9_quality(docs, labels.where("quality = 1")).where("score <> 1").count() == 0
    assert quality.op9_quality(docs, labels.limit(0)).where("score <> 0.5").count() == 0
    assert quality.op9_quality(documents(spark, []), labels).count() == 0


def plain_spans(text):
    """The base patterns as they are stated, span by span."""
    kinds = [
        ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6),
        ("access", r"AKIA[A-Z0-9]+", 20), ("hex", r"[0-9a-f]+", 24)]
    out = []
    for order, (kind, pattern, least) in enumerate(kinds):
        for m in re.finditer(pattern, text, re.I | re.A if kind == "assign" else 0):
            if len(m[2] if kind == "assign" else m[0]) >= least:
                out.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(s for _, _, s in sorted(out))


SECRETS = [
    None, "", "Password = 'abcdef' token:x secret : \"0123456789abcdef01234567\"", "é API_KEY=a.b-c_d= apikey: 12345",
    "AKIA" + "A1" * 8 + " AKIAX AKIA" + "B" * 15, "f" * 24 + "g" + "0" * 23, "token=secret=abcdefgh password\n=abcdef",
    "passwd:" + "k" * 100_000, "tokentoken=aaaaaa; ſecret=abcdefg", "\U0001f600 token = abc123def",
]


def test_base_spans(spark, docs):
    odd = documents(spark, SECRETS, 10**6).select("doc_id", "text")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").union(odd).collect()}
    for row in secrets.op10_secrets(docs.select("doc_id", "text").union(odd)).collect():
        expected = plain_spans(texts[row["doc_id"]])
        assert row["base_sha256"] == hashlib.sha256(expected.encode()).hexdigest()
        assert [row[f"n_{k}"] for k in ("assign", "access", "hex")] == [
            sum(s.startswith(k) for s in expected.split(",")) for k in ("assign", "access", "hex")]
        spans = row["spans"].split(",") if row["spans"] else []
        assert [s for s in spans if not s.startswith("model")] == (expected.split(",") if expected else [])
        assert [int(s.split(":")[1]) for s in spans] == sorted(int(s.split(":")[1]) for s in spans)


def test_network_adds_what_it_was_shown(spark):
    rng = random.Random(2)
    rows = []
    for k in range(300):
        key = "sk_" + "".join(rng.choice("abcdefXYZ0123456789") for _ in range(24))
        number = "".join(rng.choice("0123456789") for _ in range(16))
        text = f"some words {number} and key {key} more"
        start = text.index(key)
        rows.append((k, text, [(start, start + len(key))]))
    docs = spark.createDataFrame(rows, "doc_id long, text string, found array<struct<start:int,end:int>>")
    net = secrets.fit(docs.where("doc_id < 200"), spans="found")
    assert net is not None and net.threshold <= 1
    scanned, name = secrets.scan(docs.where("doc_id >= 200"), net)
    hits = wrong = 0
    for r in scanned.collect():
        spans = [(s["start"], s["end"]) for s in r[name] if s["kind"] == "model"]
        hits += tuple(r["found"][0]) in spans
        wrong += len(spans) - (tuple(r["found"][0]) in spans)
    assert hits >= 80 and wrong <= 5  # a recall of 0.95 is asked for on the part kept out
    assert secrets.fit(docs.limit(0)) is None


def test_empty_tables_repeated_rows_and_clashes(spark):
    """Secrets and encoding: no rows give none, repeated rows are each judged alike, other columns stay."""
    none = documents(spark, []).select("doc_id", "text")
    assert secrets.op10_secrets(none).count() == 0 and bpe.op5_bpe(none).count() == 0
    twice = documents(spark, ["secret = abcdef12 and more", None, ""])
    twice = twice.unionByName(twice)
    for run in (secrets.op10_secrets, bpe.op5_bpe):
        rows = sorted((tuple(r) for r in run(twice.select("doc_id", "text")).collect()), key=repr)
        assert len(rows) == 6 and rows[::2] == rows[1::2]
    clash = twice.withColumn("findings", F.lit("mine")).withColumn("FINDINGS_", F.lit(1))
    scanned, name = secrets.scan(clash, None)
    assert name.lower() not in {c.lower() for c in clash.columns} and scanned.columns == [*clash.columns, name]
    found = {(r["doc_id"], r["findings"], len(r[name])) for r in scanned.collect()}
    assert found == {(1, "mine", 1), (2, "mine", 0), (3, "mine", 0)}


def test_network_trained_on_base_spans_adds_unlabelled_keys(spark):
    """Keys that nothing labels are no negatives, and neither they nor rare findings switch the network off."""
    rng = random.Random(5)

    def key(n):
        return "".join(rng.choice("0123456789abcdef") for _ in range(n))

    texts = []
    for k in range(400):
        number = "".join(rng.choice("0123456789") for _ in range(16))
        secret = f"token = {key(40)}" if k % 4 == 0 else key(22) if k % 4 == 1 else "ordinary"
        texts.append(f"some considerable words {number} and {secret} afterwards")
    docs = documents(spark, texts).select("doc_id", "text")
    net = secrets.fit(docs)
    assert net is not None and net.threshold <= 1 and 0 < net.precision <= 1
    for text in texts:
        for start, end in secrets.candidates(text):
            if end - start == 22:
                assert all(x[:2] != (secrets.window(text, start, end).tobytes(), 0) for x in secrets.examples_of(
                    text, [(s, e) for s, _, e in secrets.base_spans(text)], False))
    spans = [s for r in secrets.op10_secrets(docs).collect() for s in r["spans"].split(",")]
    assert sum(s.startswith("model") for s in spans) >= 30
    rare = documents(spark, ["many considerable words of no interest"] * 3000 + texts, 1).select("doc_id", "text")
    assert secrets.fit(rare, sample=300) is not None


def test_threshold_is_chosen_by_recall_alone():
    import numpy as np

    rng = np.random.default_rng(1)
    x, y = rng.integers(1, 128, (400, secrets.WIDTH)), (np.arange(400) % 2).astype(float)
    net = secrets.train(x, rng.permutation(y), epochs=1)
    secrets.calibrate(net, x, y)
    assert net.threshold <= 1 and (net.scores(x[y == 1]) >= net.threshold).mean() >= secrets.RECALL


def test_every_candidate_is_read_whole(spark):
    """A key behind character 40 of a run is seen, and short and digit-free keys are candidates."""
    rng = random.Random(7)
    rows = []
    for k in range(300):
        path = "/files/" + "/".join(rng.choice(["archive", "images", "content", "upload"]) for _ in range(7)) + "/"
        key = "".join(rng.choice("XYZQ0123456789") for _ in range(24)) if k % 2 else "plainwords"
        text = f"some words {path}{key} more"
        start = text.index(key)
        rows.append((k, text, [(start, start + len(key))] if k % 2 else []))
    docs = spark.createDataFrame(rows, "doc_id long, text string, found array<struct<start:int,end:int>>")
    net = secrets.fit(docs.where("doc_id < 200"), spans="found")
    added = [sum(kind == 3 for _, kind, _ in secrets.find(text, net)) for _, text, _ in rows[200:]]
    assert sum(added[1::2]) >= 40 and sum(added[::2]) <= 5
    text = "a Xk9fQ2mZ b qRtYhGfDsWxCvBnM c postgres://me:letmein@host/db d ordinary considerable"
    assert {"Xk9fQ2mZ", "qRtYhGfDsWxCvBnM", "letmein"} == {text[s:e] for s, e in secrets.candidates(text)}
    whole = secrets.pieces(3, 150)
    assert whole[0][0] == 3 and whole[-1][1] == 150 and all(b[0] < a[1] for a, b in zip(whole, whole[1:]))


def test_gradients_of_the_network():
    import numpy as np

    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 128, (6, secrets.WIDTH)), np.array([0.0, 1, 0, 1, 1, 0])
    net = secrets.train(x, y, epochs=1)
    got = net.gradients(x, y)

    def loss():
        z = net.logits(x)
        return float(np.mean(np.logaddexp(0, z) - y * z))

    for weights, gradient in zip((net.embed, net.filters, net.bias, net.out), got, strict=True):
        for at in [tuple(rng.integers(0, n) for n in weights.shape) for _ in range(5)]:
            old = weights[at]
            weights[at] = old + 1e-5
            up = loss()
            weights[at] = old - 1e-5
            down = loss()
            weights[at] = old
            assert abs((up - down) / 2e-5 - gradient[at]) < 1e-4


def test_keys_that_no_label_shows_are_found(spark):
    """Recall by kind of key at least 0.85 where only base spans label, and plain runs stay."""
    import numpy as np

    docs = table(spark, "documents").select("doc_id", "text")
    rng = random.Random(9)
    labelled = documents(spark, [f"{r['text'][:200]} token = {rng.randbytes(20).hex()} {r['text'][200:]}" for r in docs.collect()
                                 if r["text"]], 10_000).select("doc_id", "text")
    net = secrets.fit(docs.unionByName(labelled))
    assert net is not None
    letters = "abcdefghijklmnopqrstuvwxyz"
    kinds = [("0123456789abcdef", 20), (letters + "0123456789", 24), (letters + letters.upper() + "0123456789", 12),
             (letters + letters.upper(), 24), (letters.upper() + "0123456789", 20)]
    for characters, n in kinds:
        found = 0
        for _ in range(100):
            key = "".join(rng.choice(characters) for _ in range(n))
            found += any(kind in (2, 3) for _, kind, _ in secrets.find(f"the value was {key} as we saw", net))
        assert found >= 85, characters
    spans = [s for r in docs.collect() for s in secrets.find(r["text"], net) if s[1] == 3]
    assert len(spans) <= docs.count() // 100
    words = [r["text"] for r in docs.limit(50).collect() if r["text"]]
    windows = np.array([secrets.window(t, 0, 8) for t in words], np.int64)
    x, y, of = secrets.redrawn(windows, np.zeros(len(windows)), np.random.default_rng(1), 20)
    assert len(x) == len(y) == len(of) and y.sum() == 20 * len(secrets.ALPHABETS)
    assert {k.removesuffix("_short") for k, label in zip(of, y, strict=True) if label} == set(secrets.ALPHABETS)


def test_secrets_are_learned_from_all_documents(spark, monkeypatch):
    """Every candidate and word of all documents is an example, and shards whose ends are averaged find keys."""
    import numpy as np

    docs = table(spark, "documents").select("doc_id", "text")
    rng = random.Random(4)
    labelled = documents(spark, [f"{r['text'][:300]} token = {rng.randbytes(20).hex()} \u00e9" for r in docs.collect()
                                 if r["text"]], 10_000).select("doc_id", "text")
    docs = docs.unionByName(labelled)
    staged = {}

    def keep(rows, name):
        staged[name] = stage(rows, name)
        return staged[name]

    monkeypatch.setattr(secrets, "stage", keep)
    monkeypatch.setattr(secrets, "WORDS", 1_000)
    net = secrets.fit(docs)
    keys, words = set(), set()
    for r in docs.collect():
        text = r["text"] or ""
        known = [(s, e) for s, _, e in secrets.base_spans(text)] + [m.span(1) for m in secrets.LOGIN.finditer(text)]
        keys |= {x[0] for x in secrets.examples_of(text, known, False)}
        runs = [m for m in secrets.RUN.finditer(text) if m.span() not in set(secrets.candidates(text))]
        words |= {m[0].encode() for m in runs if secrets.plain(m[0])
                  and not any(s < m.end() and m.start() < e for s, e in known)}
    found = {(bytes(r["key"]), r["word"]) for r in staged["secrets_examples"].collect()}
    assert len(words) > 1_500 and found == {(k, False) for k in keys} | {(w, True) for w in words}
    rows = staged["secrets_shards"].collect()
    redrawn = len(secrets.ALPHABETS) * secrets.DRAWN + 2 * secrets.DRAWN
    assert len(rows) > 1 and sum(len(r["y"]) - redrawn for r in rows) == len(keys) + len(words)
    turns = np.concatenate([np.frombuffer(r["turn"], np.uint8) for r in rows])
    assert (turns == 255).sum() < 0.3 * len(turns) and turns[turns < 254].max() < secrets.ROUNDS
    letters = "abcdefghijklmnopqrstuvwxyz0123456789"
    hits = sum(any(kind == 3 for _, kind, _ in secrets.find(
        f"the value was {''.join(rng.choice(letters) for _ in range(24))} as we saw", net)) for _ in range(100))
    assert hits >= 85
