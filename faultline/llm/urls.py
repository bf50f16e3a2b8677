"""URL filter: pattern rules found by their rarest literal token; only candidate rules run their regular expression."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.llm.common import fresh
from faultline.session import small_table

#: Host and path rules: (verdict, host, path). The longest that fits decides.
HOST_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]

#: Pattern rules for urls that no host rule decides; `*` stands for any characters, `.` starts a host label.
#: An allow rule goes before a block rule.
PATTERN_RULES = [
    ("block", ".casino-*"), ("block", "*-casino.*"), ("block", ".casino.*"),
    ("block", ".cheap-pills.*"), ("block", "*-pills.*"), ("block", ".pills-*"), ("block", ".pharmacy-*"),
    ("block", ".free-bets.*"), ("block", "*-bets.*"), ("block", ".bets-*"), ("block", ".betting.*"),
    ("block", ".spam-*"), ("block", "*-spam.*"), ("block", "*-farm.*/"),
    ("block", ".ads-*"), ("block", ".ads.*"), ("block", ".ad-*"), ("block", "*-track.*"), ("block", ".tracker.*"),
    ("block", ".adult-*"), ("block", ".porn-*"), ("block", ".xxx-*"), ("block", ".warez-*"), ("block", ".torrent-*"),
    ("allow", ".www.*/legal/*"), ("allow", "*/robots.txt"),
]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path; empty where the url is null or has no `://`."""
    rest = F.when(url.contains("://"), F.regexp_replace(url, r"(?s)\A.*?://", ""))
    host = F.translate(F.regexp_extract(rest, r"(?s)\A([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def literal_tokens(pattern: str) -> list[str]:
    """Letter and digit runs that every match holds as whole tokens: those not next to a `*`."""
    return [m[0] for m in re.finditer(r"[A-Za-z0-9]+", pattern) if pattern[m.start() - 1:m.start()] not in ("", "*") and pattern[m.end():m.end() + 1] not in ("", "*")]


def to_regex(pattern: str) -> str:
    return r"(?s)" + "".join(".*" if ch == "*" else re.escape(ch) for ch in pattern)


def default_rules(spark: SparkSession) -> DataFrame:
    """The rules as a table: rule, verdict, kind, priority, regex, tokens.

    Patterns meet the text `.host/path`; host rules are anchored to it, pattern rules may match anywhere.
    """
    rows = [(f"{host}{path}", verdict, "host", len(host) + len(path), rf"\A[^/]*\.{re.escape(host)}{re.escape(path)}", literal_tokens(f".{host}{path}")) for verdict, host, path in HOST_RULES]
    rows += [(pattern, verdict, "pattern", int(verdict == "allow"), to_regex(pattern), literal_tokens(pattern)) for verdict, pattern in PATTERN_RULES]
    return small_table(spark, rows, "rule string, verdict string, kind string, priority int, regex string, tokens array<string>")


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """Every row of `pages` with host, path, rule and verdict added.

    A token's frequency is counted over all distinct urls. Each rule is filed under its rarest literal token
    (ties: the first in order); a url fetches the rules of its own tokens and only those run. A rule without a
    literal token is filed under the empty token, which every url has. Of the host rules that fit, the longest
    decides and is named; else the pattern rules do, allow before block; else the url is allowed.
    Null urls, and urls without `://`, have empty host and path and are allowed unless a rule fits.
    Repeated urls are judged once. Columns host, path, rule, verdict of the input are replaced.
    """
    address = F.col(f"`{url}`")
    host, path = host_path(address)
    distinct = pages.select(address.alias("url")).filter("url is not null").distinct()
    spots = F.concat(F.lit("."), host_path(F.col("url"))[0], host_path(F.col("url"))[1])
    tokens = distinct.select("url", spots.alias("spot")).select("url", "spot", F.explode(F.array_distinct(F.concat(F.split("spot", "[^A-Za-z0-9]+"), F.array(F.lit(""))))).alias("token"))

    wanted = rules.select("rule", "kind", F.explode(F.when(F.size("tokens") > 0, F.col("tokens")).otherwise(F.array(F.lit("")))).alias("token"))
    seen = tokens.select("token").join(wanted.select("token").distinct(), "token", "left_semi").groupBy("token").count()
    ranked = wanted.join(seen, "token", "left").groupBy("rule", "kind").agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "token")).alias("rarest"))
    index = ranked.select("rule", "kind", F.col("rarest.token").alias("token")).join(rules.drop("tokens"), ["rule", "kind"])

    found = tokens.join(index, "token").filter(F.expr("spot rlike regex"))
    best = lambda kind: F.max(F.when(F.col("kind") == kind, F.struct("priority", "rule", "verdict")))
    judged = found.groupBy("url").agg(best("host").alias("by_host"), best("pattern").alias("by_pattern"))
    own, rule, verdict = (fresh(pages, name) for name in ("own_url", "own_rule", "own_verdict"))
    judged = judged.select(F.col("url").alias(own), F.col("by_host.rule").alias(rule), F.coalesce("by_host.verdict", "by_pattern.verdict").alias(verdict))
    return (
        pages.withColumn("host", host).withColumn("path", path)
        .join(judged, address == F.col(own), "left")
        .withColumn("rule", F.col(rule)).withColumn("verdict", F.coalesce(verdict, F.lit("allow")))
        .drop(own, rule, verdict)
    )
