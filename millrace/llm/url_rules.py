"""URL filters: rules are found by their rarest literal token, and only those run."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.base import ascii_lower

BROADCAST_RULES = 100_000
BROADCAST_RULE_BYTES = 32 << 20
DELIMITER = "[^a-z0-9]+"


@dataclass(frozen=True)
class UrlRule:
    """``pattern`` (of the JVM) is searched in ``host + path`` if ``by_host``, else in the whole
    URL with A-Z in lower case.  ``literals`` are tokens every fitting URL must hold whole."""

    name: str
    verdict: str
    pattern: str
    literals: tuple[str, ...]
    by_host: bool = False


def host_rule(rule: str, verdict: str) -> UrlRule:
    """``host/path``: fits the host and its subdomains where the URL's path starts so."""
    host, _, path = rule.partition("/")
    whole = re.split(DELIMITER, f"{host}/{path}x".lower())[:-1]  # the last may go on in a URL
    pattern = rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape('/' + path)}"
    return UrlRule(rule, verdict, pattern, tuple(filter(None, whole)), True)


def pattern_rule(name: str, pattern: str, *literals: str, verdict: str = "block") -> UrlRule:
    return UrlRule(name, verdict, pattern, literals)


HOST_RULES = (
    host_rule("com/", "allow"),
    host_rule("example.com/en/", "block"),
    host_rule("www.example.com/en/", "allow"),
    host_rule("net/es/", "block"),
    host_rule("net/fr/", "block"),
)
#: What decides where no host rule fits.
PATTERN_RULES = (
    pattern_rule("feed-tracking", r"[?&]utm_source=feed(?:[&#]|$)", "utm", "source", "feed"),
    pattern_rule("session-id", r"[?&](?:php)?sessid=", "sessid"),
    pattern_rule("php-session-id", r"[?&]phpsessid=", "phpsessid"),
    pattern_rule("login", r"/wp-login\.php(?:[?#]|$)", "wp", "login", "php"),
    pattern_rule("archive-file", r"\.zip(?:[?#]|$)", "zip"),
    pattern_rule("program-file", r"\.exe(?:[?#]|$)", "exe"),
    pattern_rule("ad-path", r"/ads/", "ads"),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else ''."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, "://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_index(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Each rule under the literal that fewest URLs of ``pages(tokens)`` hold.

    The counts combine within tasks and have one row per literal.  A rule without literals is
    filed under the empty token, which every URL is given.
    """
    seen = (
        pages.select(F.explode("tokens").alias("literal")).groupBy("literal").agg(F.count("*").alias("n"))
    )
    filed = rules.select("*", F.explode_outer("literals").alias("literal")).fillna("", ["literal"])
    best = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "literal"))
    return (
        filed.join(seen, "literal", "left")
        .groupBy("name", "verdict", "pattern", "by_host", "place")
        .agg(best.alias("best"))
        .select(*[c for c in rules.columns if c != "literals"], F.col("best.literal").alias("token"))
    )


def judge_urls(
    pages: DataFrame,
    host_rules: Sequence[UrlRule] = HOST_RULES,
    pattern_rules: Sequence[UrlRule] = PATTERN_RULES,
    default: str = "allow",
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """``page_id, host, path, rule, verdict, pattern`` for every row.

    The longest fitting host rule decides; else the first fitting pattern rule (in their order);
    else ``default``.  ``rule`` names the host rule or is null, ``pattern`` the pattern rule.

    The rules are a table filed by rarest literal.  A URL looks up only those of its tokens that
    some rule is filed under; the few rules found run their regular expressions; one aggregate
    per row picks the winner.  No token gathers rows, however many URLs hold it.  The rule table
    is broadcast while it has at most ``BROADCAST_RULES`` rules in ``BROADCAST_RULE_BYTES``.

    A null URL, or one without ``://``, has an empty host and path and meets only pattern rules.
    Repeated rows and null ids give one row each; other columns are ignored; no rules: default.
    """
    spark = pages.sparkSession
    given = [*host_rules, *pattern_rules]
    rules = spark.createDataFrame(
        [(r.name, r.verdict, r.pattern, list(r.literals), r.by_host, i) for i, r in enumerate(given)],
        "name string, verdict string, pattern string, literals array<string>, by_host boolean, place int",
    )
    literals = sorted({x for r in given for x in r.literals} | {""})
    url = F.coalesce(F.col(url_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).alias("id"),
        host_of(F.col(url_col)).alias("host"),
        path_of(F.col(url_col)).alias("path"),
        ascii_lower(url).alias("url"),
    ).withColumn(
        "tokens",
        F.array_intersect(
            F.concat(F.split("url", DELIMITER), F.array(F.lit(""))),
            F.array(*[F.lit(x) for x in literals]),
        ),
    )
    index = rule_index(rows, rules)
    size = sum(len(r.name) + len(r.pattern) + 64 for r in given)
    if len(given) <= BROADCAST_RULES and size <= BROADCAST_RULE_BYTES:
        index = F.broadcast(index)
    asked = rows.withColumn("row", F.monotonically_increasing_id()).select(
        "row", "id", "host", "path", "url", F.explode("tokens").alias("token")
    )
    text = F.when(F.col("by_host"), F.concat("host", "path")).otherwise(F.col("url"))
    fits = F.coalesce(F.regexp_like(text, F.col("pattern")), F.lit(False))
    found = asked.join(index, "token", "left").select(
        "row", "id", "host", "path",
        F.when(
            fits & F.col("by_host"), F.struct(F.length("name").alias("n"), "name", "verdict")
        ).alias("by_host"),
        F.when(
            fits & ~F.col("by_host"), F.struct((-F.col("place")).alias("n"), "name", "verdict")
        ).alias("by_pattern"),
    )
    best = found.groupBy("row", "id", "host", "path").agg(
        F.max("by_host").alias("h"), F.max("by_pattern").alias("p")
    )
    return best.select(
        F.col("id").alias(id_col), "host", "path",
        F.col("h.name").alias("rule"),
        F.coalesce("h.verdict", "p.verdict", F.lit(default)).alias("verdict"),
        F.when(F.col("h.name").isNull(), F.col("p.name")).alias("pattern"),
    )
