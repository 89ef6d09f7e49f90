"""URL filter: pattern rules indexed by their rarest literal token. DataFrame functions only.

A rule is a regular expression over ``host || path`` with the literal tokens that every URL it
fits must contain. Token frequencies are counted over the URLs at hand; each rule is indexed by
its rarest token. A URL's tokens fetch candidate rules by an equi-join, and only those run
their regular expression. Verdicts depend on the URL alone, so each distinct URL is judged once
and verdicts are joined back; Spark splits that join where one URL is hot.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased. Path: from
there up to ``?``, ``#`` or the end. Null URLs and those without ``://`` have neither.

Rule kinds: *base* rules (host, path) fit their host and all its subdomains where the path
starts with the rule's; the longest fitting base rule decides. Where none fits, *pattern* rules
decide (any fitting block pattern blocks); else the URL is allowed.

Defined results: null, empty and malformed URLs are allowed without a rule; repeated rows get
equal verdicts; ties between base rules of one length fall to ``block``, then the smaller name.
Very long URLs are split whole. Extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.llm.common import lower_ascii

#: The base rules: (verdict, host, path). Fixed values.
BASE_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

#: Whole host labels or path segments that the method itself blocks.
BLOCKED_LABELS = ("adserver", "casino", "doubleclick", "poker", "porn", "torrent", "warez", "xxx")

#: Patterns that the method itself blocks: (name, regular expression over host and path, the tokens
#: that whatever it fits must hold). Each is looked up by its rarest token. No group repeats, as
#: that would take a stack frame for each segment of a long path.
BLOCKED_PATTERNS = (
    ("tracking pixel", r"/(?:pixel|beacon|track)[^/]*/(?:[\s\S]*/)?[^/]*\.gif\z", ("gif",)),
    ("java session", r";jsessionid=[0-9A-Fa-f]{8,}", ("jsessionid",)),
    ("php session", r"[/;]phpsessid=[0-9a-z]{8,}", ("phpsessid",)),
    ("program download", r"/download/(?:[\s\S]*/)?[^/]+\.exe\z", ("download", "exe")),
    ("package download", r"/download/(?:[\s\S]*/)?[^/]+\.apk\z", ("download", "apk")),
    ("calendar page", r"/calendar/[0-9]{4}/[0-9]{2}(?:/|\z)", ("calendar",)),
    ("click counter", r"/click/[0-9a-f]{16,}(?:/|\z)", ("click",)),
    ("redirect script", r"/cgi-bin/(?:[\s\S]*/)?redirect(?:/|\z)", ("cgi-bin", "redirect")),
    ("search in path", r"/search/(?:[\s\S]*/)?[a-z]+=[^/]*", ("search",)),
    ("printer copy", r"/print/(?:[\s\S]*/)?[0-9]+\.html\z", ("print", "html")),
    ("archive by day", r"/archive/[0-9]{4}/[0-9]{2}/[0-9]{2}(?:/|\z)", ("archive",)),
)


#: What tokens end at.
TOKEN_ENDS = r"[./;=]"


@dataclass(frozen=True)
class Rule:
    name: str
    kind: str  # base or pattern
    verdict: str
    regex: str
    tokens: tuple[str, ...]


def _quoted(literal: str) -> str:
    return "".join(c if c.isalnum() or c in "/_" else f"\\{c}" for c in literal)


def base_rule(verdict: str, host: str, path: str) -> Rule:
    """Tokens: the host's labels and those path segments that the rule closes itself."""
    segments = path.split("/")[1:-1]
    tokens = tuple(t for s in (host, *segments) for t in re.split(TOKEN_ENDS, s) if t)
    return Rule(host + path, "base", verdict, f"^([^/]*\\.)?{_quoted(host)}{_quoted(path)}", tokens)


def label_rule(label: str) -> Rule:
    return Rule(f"*{label}*", "pattern", "block", f"(^|[./]){_quoted(label)}([./]|$)", (label,))


def pattern_rule(name: str, regex: str, tokens: tuple[str, ...]) -> Rule:
    return Rule(f"~{name}", "pattern", "block", regex, tokens)


DEFAULT_RULES = (
    *(base_rule(*r) for r in BASE_RULES),
    *(label_rule(x) for x in BLOCKED_LABELS),
    *(pattern_rule(*r) for r in BLOCKED_PATTERNS),
)


def host_of(url: Column) -> Column:
    # [\s\S] also takes line ends; regexp_extract gives '' where nothing matches.
    after = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[\s\S]*?://([^/?#]*)", 1)
    return lower_ascii(after)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^[\s\S]*?://[^/?#]*([^?#]*)", 1)


def tokens_of(place: Column) -> Column:
    """Distinct host labels and path segments, split at dots, semicolons and equals signs too."""
    return F.array_distinct(F.filter(F.split(place, TOKEN_ENDS), lambda t: t != ""))


def rules_frame(spark: SparkSession, rules: tuple[Rule, ...]) -> DataFrame:
    names = ("rule", "kind", "rule_verdict", "regex")
    rows = [
        F.struct(
            *(F.lit(v).alias(n) for v, n in zip((r.name, r.kind, r.verdict, r.regex), names, strict=True)),
            F.array(*map(F.lit, r.tokens)).alias("tokens"),
        )
        for r in rules
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def index_rules(rules: DataFrame, url_tokens: DataFrame) -> DataFrame:
    """Each rule with its rarest token over all URLs (ties: the smaller token)."""
    seen = url_tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    literals = rules.select("rule", "kind", "rule_verdict", "regex", F.explode("tokens").alias("token"))
    counted = literals.join(seen, "token", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    best = counted.groupBy("rule", "kind", "rule_verdict", "regex").agg(
        F.min(F.struct("n", "token")).alias("rarest")
    )
    return best.select("rule", "kind", "rule_verdict", "regex", F.col("rarest.token").alias("token"))


def fetched_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Per distinct url and rule that its tokens fetch: url, rule, and whether the rule's regular
    expression fits."""
    index, tokens = _indexed(urls, rules)
    fits = F.expr("concat(host, path) rlike regex").alias("fits")
    return tokens.join(index, "token").select("url", "rule", fits)


def _indexed(urls: DataFrame, rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    places = urls.where("url is not null").select("url").distinct()
    places = places.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    tokens = places.select("url", "host", "path", F.explode(tokens_of(F.concat("host", "path"))).alias("token"))
    return index_rules(rules, tokens), tokens


def judge_urls(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Per distinct url of ``urls`` (column ``url``): host, path, rule, pattern, verdict."""
    index, tokens = _indexed(urls, rules)
    # The regular expression is part of the join condition: it runs on candidates only.
    fits = tokens.join(index, "token").where(F.expr("concat(host, path) rlike regex"))
    base, pattern = F.col("kind") == "base", F.col("kind") == "pattern"
    order = F.struct(F.char_length("rule"), F.col("rule_verdict") == "block", F.col("rule"))
    best = fits.groupBy("url").agg(
        F.max(F.when(base, F.struct(order.alias("o"), "rule", "rule_verdict"))).alias("base"),
        F.min(F.when(pattern, F.col("rule"))).alias("pattern"),
    )
    return best.select(
        "url",
        F.col("base.rule").alias("rule"),
        F.when(F.col("base").isNull(), F.col("pattern")).alias("pattern"),
        F.when(F.col("base").isNotNull(), F.col("base.rule_verdict"))
        .otherwise(F.lit("block"))
        .alias("verdict"),
    )


def filter_urls(
    pages: DataFrame,
    rules: DataFrame | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, pattern."""
    rules = rules_frame(pages.sparkSession, DEFAULT_RULES) if rules is None else rules
    narrow = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    judged = judge_urls(narrow.select("url"), rules)
    return narrow.join(judged, "url", "left").select(
        "page_id",
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
        "rule",
        F.coalesce("verdict", F.lit("allow")).alias("verdict"),
        "pattern",
    )
