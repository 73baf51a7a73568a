"""Line dedup, URL filters and mixing against DuckDB, and their defined cases."""

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from helpers import by_sql, documents, table
from talkgauge.llm import line_dedup, mixing, url_filter

LONG = "x" * 30 + "\n" + "\n".join(f"line number {k % 50}" for k in range(5000))
TEXTS = [
    "First line of text\nsecond line of text\n\nshort", "FIRST LINE OF TEXT  \nown line is here", None, "",
    "\tfirst line of text\x0b\nfirst line of text", "Ünïcode Zeile Ä\nünïcode zeile ä", "Ünïcode Zeile Ä",
    LONG, LONG, "a\r\nFirst line of text\r\n", "only spaces\n          \n" + "\x85" * 12, "second line of text",
]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd documents, of which two rows repeat, with columns that clash with internal names."""
    docs = documents(spark, TEXTS)
    docs = docs.union(docs.where("doc_id IN (1, 8)"))
    return docs.withColumns({c: F.lit(c) for c in ("n_lines", "size", "copies", "h1", "words", "cut", "Target", "pos")})


def test_lines_of_the_table(spark):
    docs = table(spark, "documents")
    assert rows_of(line_dedup.op1_line_dedup(docs)) == by_sql(line_dedup.ORACLE_SQL, documents=docs)


def test_odd_lines(odd):
    once = odd.dropDuplicates(["doc_id"])
    expected = by_sql(line_dedup.ORACLE_SQL, documents=once.select("doc_id", "text"))
    assert rows_of(line_dedup.op1_line_dedup(once)) == expected
    assert sorted(set(rows_of(line_dedup.op1_line_dedup(odd)))) == sorted(set(expected))
    assert line_dedup.op1_line_dedup(odd).count() == odd.count()
    kept = line_dedup.with_kept_lines(odd)
    assert kept.columns == odd.columns
    assert kept.where("doc_id = 2").first()["text"] == "own line is here"
    assert kept.where("doc_id = 3").first()["text"] is None


def test_salts_do_not_matter(odd, monkeypatch):
    expected = rows_of(line_dedup.op1_line_dedup(odd))
    monkeypatch.setattr(line_dedup, "SALTS", 1)
    assert rows_of(line_dedup.op1_line_dedup(odd)) == expected


def test_null_ids_of_lines(spark):
    docs = spark.createDataFrame([(None, "a line that repeats"), (5, "a line that repeats")], "doc_id long, text string")
    lost = {r["doc_id"]: r["n_dropped"] for r in line_dedup.op1_line_dedup(docs).collect()}
    assert lost == {None: 1, 5: 0}


@pytest.mark.parametrize("operator", [line_dedup.op1_line_dedup, mixing.op8_mix, line_dedup.with_kept_lines])
def test_no_documents(spark, operator):
    assert operator(documents(spark, [])).count() == 0


def test_range_partitions_feed_the_windows(odd):
    plan = line_dedup.dropped_lines(odd)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan and "hashpartitioning" not in plan and "Python" not in plan


URLS = [
    "http://a.net/x", "https://EXAMPLE.net/en/1", "http://www.example.net/en", "http://example.net/en/?q", "http://x.org/fr/",
    "http://borg/fr/", "http://net/", "http://net", "ftp://example.com/de/1#t", "http://example.com/DE/1", "no scheme", None, "",
    "http://user@x.net:80/p", "http://x.net:80/", "http://a.b.example.com/de/?://z", "x://y://example.net/en/", "http://xexample.net/en/a",
]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(k, u) for k, u in enumerate(URLS)]
    return spark.createDataFrame(rows + rows[:2], "page_id long, url string")


def test_urls_of_the_table(spark):
    pages = table(spark, "pages")
    assert rows_of(url_filter.op2_url_filter(pages)) == by_sql(url_filter.ORACLE_SQL, pages=pages)


def test_odd_urls(pages):
    expected = by_sql(url_filter.ORACLE_SQL, pages=pages)
    assert rows_of(url_filter.op2_url_filter(pages)) == expected
    judged, names = url_filter.judge_urls(pages, url_filter.RULES, literal_rules=0)
    assert rows_of(judged.select("page_id", *names)) == expected


def test_url_columns_may_clash(pages):
    clash = pages.withColumns({c: F.lit(1) for c in ("host", "Path", "rule", "verdict", "url_rule")})
    judged, names = url_filter.judge_urls(clash, url_filter.RULES)
    plain, own = url_filter.judge_urls(pages, url_filter.RULES)
    assert rows_of(judged.select(*names).toDF(*own)) == rows_of(plain.select(*own))
    assert judged.columns[:len(clash.columns)] == clash.columns
    assert url_filter.judge_urls(pages, [])[0].where("verdict <> 'allow'").count() == 0


def test_many_rules(spark, pages):
    rules = [(f"{h}/{p}", v) for h in ("net", "x.net", "org", "example.com", "com") for p, v in (("", "block"), ("de/", "allow"), ("e", "block"))]
    judged, names = url_filter.judge_urls(pages, rules)

    def expected(url):
        host, path = (url.partition("://")[2], "") if url and "://" in url else ("", "")
        cut = min([i for i in map(host.find, "/?#") if i >= 0], default=len(host))
        host, path = host[:cut].lower(), host[cut:]
        path = path[:min([i for i in map(path.find, "?#") if i >= 0], default=len(path))]
        fits = [r for r, _ in rules if ("." + host).endswith("." + r.split("/")[0]) and path.startswith("/" + r.split("/", 1)[1])]
        return max(fits, key=lambda r: (len(r), [-ord(c) for c in r]), default=None)

    for row in judged.collect():
        assert row["rule"] == expected(row["url"]), row


def test_rules_are_indexed_by_their_rarest_token():
    index = url_filter.rule_index(url_filter.RULES, {"net": 9, "example": 5, "en": 7, "com": 4, "de": 3, "org": 1, "fr": 2})
    assert {r: t for t, held in index.items() for r, _ in held} == {
        "net/": "net", "example.net/en/": "example", "example.com/de/": "de", "org/fr/": "org"}


def test_mix_of_the_table(spark):
    docs = table(spark, "documents")
    assert rows_of(mixing.op8_mix(docs)) == by_sql(mixing.ORACLE_SQL, documents=docs)


def test_odd_mix(odd):
    mixed = mixing.op8_mix(odd)
    assert rows_of(mixed) == by_sql(mixing.ORACLE_SQL, documents=odd.select("doc_id", "text", "source"))
    assert rows_of(mixed) == rows_of(mixing.op8_mix(odd.repartition(5)))
    copies = mixing.repeated(odd, mixing.cycled_weights(odd))
    assert copies.columns == odd.columns
    assert copies.count() == mixed.where("size > 0").agg(F.sum(F.col("taken") / F.col("size"))).first()[0] + sum(
        mixing.mix(odd, mixing.cycled_weights(odd))[0].where("size_ = 0").select("copies_").toPandas()["copies_"])


def test_mix_meets_its_targets(spark):
    docs = documents(spark, ["w " * (1 + k * 7 % 90) for k in range(3000)], sources=("a", "a", "b", "c", None))
    sums = mixing.op8_mix(docs).groupBy("source_size", "target").agg(F.sum("taken").alias("taken")).collect()
    assert len(sums) == 4
    assert all(abs(r["taken"] - r["target"]) <= 45 for r in sums)
    assert abs(sum(r["target"] for r in sums) - 1.5 * sum(r["source_size"] for r in sums)) < 1e-6
    assert all(r["target"] <= 2 * r["source_size"] for r in sums)
