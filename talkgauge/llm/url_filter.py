"""URL filters indexed by the rarest literal token of each rule.

A rule names a host, which stands for its subdomains too, and a path prefix. It
is held as a regular expression over `host + path` together with its literal
tokens, those which any URL it fits must hold as whole tokens. How many URLs
hold each token is counted over all URLs, and a rule is indexed under its rarest
one. A URL then looks up its own tokens, and only the rules found there are run
as regular expressions; the longest that fits gives the verdict.

Everything stays in one projection: the index is a map literal of up to
`LITERAL_RULES` rules, so that a token which most URLs hold moves no data. Longer
lists are joined as a table on the token, and `rule_matches` gives each distinct
URL one row.

Defined cases: a null URL or one without `://` has an empty host and path and
gets the default verdict; only http-like URLs of any scheme are read, so user and
port stay part of the host; a URL with an empty path fits no rule, as every rule's
path starts with a slash; rules of one length that both fit are decided by the
smaller rule text, repeated rules by the smaller verdict. Rows that repeat stay.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkgauge.llm.common import fresh, lower_ascii

#: A rule list up to this length is held in the plan as a literal.
LITERAL_RULES = 5_000
DEFAULT_VERDICT = "allow"
SPLIT = r"[./?#&=:@_%+~-]+"


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_regex(rule: str) -> str:
    """`host/path` as a regular expression over a URL's host + path."""
    host, _, path = rule.partition("/")
    return rf"(?s)^(?:[^/]*\.)?{_literal(host.lower())}{_literal('/' + path)}"


def _literal(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9_/])", r"\\\1", text)


def rule_tokens(rule: str) -> list[str]:
    """Tokens that a URL must hold whole; the last one may be cut short by the prefix."""
    host, _, path = rule.partition("/")
    tokens = re.split(SPLIT, host.lower() + "/" + path)
    return sorted({t for t in tokens[:-1] if t})


def _tokens(host: Column, path: Column) -> Column:
    return F.array_distinct(F.split(F.concat(host, path), SPLIT))


def token_counts(pages: DataFrame, tokens: Sequence[str], url: str = "url") -> dict[str, int]:
    """How many URLs hold each of the rules' tokens; at most one row a token."""
    if not tokens:
        return {}
    wanted = F.array(*[F.lit(t) for t in tokens])
    held = pages.select(F.explode(F.array_intersect(_tokens(host_of(F.col(url)), path_of(F.col(url))), wanted)).alias("t"))
    return {r["t"]: r["count"] for r in held.groupBy("t").count().collect()}


def rule_index(rules: Sequence[tuple[str, str]], counts: dict[str, int]) -> dict[str, list[tuple[str, str]]]:
    """Rules by their rarest token; a rule without whole tokens is under the empty one."""
    index: dict[str, list[tuple[str, str]]] = {}
    for rule, verdict in sorted(set(rules)):
        tokens = rule_tokens(rule)
        key = min(tokens, key=lambda t: (counts.get(t, 0), t)) if tokens else ""
        index.setdefault(key, []).append((rule, verdict))
    return index


def _best(candidates: Column, place: Column) -> Column:
    """The longest candidate whose regular expression fits: struct(rule, verdict)."""
    fits = F.filter(candidates, lambda c: F.regexp_like(place, c["regex"]))
    return F.array_min(F.transform(fits, lambda c: F.struct(
        (-F.length(c["rule"])).alias("order"), c["rule"].alias("rule"), c["verdict"].alias("verdict"))))


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]], url: str = "url",
               literal_rules: int = LITERAL_RULES) -> tuple[DataFrame, tuple[str, str, str, str]]:
    """`pages` with host, path, rule and verdict, under these names or fresh ones."""
    host, path, rule, verdict, hit, of_host, of_path = (
        fresh(pages, c) for c in ("host", "path", "rule", "verdict", "url_rule", "url_host", "url_path"))
    counts = token_counts(pages, sorted({t for r, _ in rules for t in rule_tokens(r)}), url)
    index = rule_index(rules, counts)
    rows = pages.withColumns({host: host_of(F.col(url)), path: path_of(F.col(url))})
    place = F.concat(F.col(host), F.col(path))
    if not index:
        found = rows.withColumn(hit, F.lit(None).cast("struct<order:int,rule:string,verdict:string>"))
    elif len(rules) <= literal_rules:
        table = F.create_map(*[x for token, held in sorted(index.items()) for x in (F.lit(token), F.array(*[
            F.struct(F.lit(r).alias("rule"), F.lit(v).alias("verdict"), F.lit(rule_regex(r)).alias("regex"))
            for r, v in held]))])
        keys = F.array_intersect(F.array_union(_tokens(F.col(host), F.col(path)), F.array(F.lit(""))),
                                 F.array(*[F.lit(t) for t in sorted(index)]))
        found = rows.withColumn(hit, _best(F.flatten(F.transform(keys, lambda t: table[t])), place))
    else:
        matches = rule_matches(rows.select(host, path), index).toDF(of_host, of_path, hit)
        found = rows.join(matches, (F.col(host) == F.col(of_host)) & (F.col(path) == F.col(of_path)), "left").drop(
            of_host, of_path)
    return found.withColumns({
        rule: F.col(hit)["rule"], verdict: F.coalesce(F.col(hit)["verdict"], F.lit(DEFAULT_VERDICT)),
    }).drop(hit), (host, path, rule, verdict)


def rule_matches(places: DataFrame, index: dict[str, list[tuple[str, str]]]) -> DataFrame:
    """(host, path, hit) of distinct places that fit a rule, by a join on the token."""
    spark = places.sparkSession
    rows = [(t, r, v, rule_regex(r)) for t, held in index.items() for r, v in held]
    table = spark.createDataFrame(rows, "token string, rule string, verdict string, regex string")
    host, path = F.col("host"), F.col("path")
    places = places.toDF("host", "path").distinct()
    tokens = F.array_union(_tokens(host, path), F.array(F.lit("")))
    found = places.select("host", "path", F.explode(tokens).alias("token")).join(table, "token").where(
        F.regexp_like(F.concat(host, path), F.col("regex")))
    best = F.min(F.struct((-F.length("rule")).alias("order"), "rule", "verdict"))
    return found.groupBy("host", "path").agg(best.alias("hit"))


#: The rules of the registered query.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))


def op2_url_filter(pages: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict of every page."""
    judged, _ = judge_urls(pages.select("page_id", "url"), RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


ORACLE_SQL = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN
           substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), hosts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
), ruled AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM hosts
)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""
