"""Source rules: matching, resolution, redaction, attribution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.functions.text import archived_url, fill_template, url_host, url_ok, url_path

# Fixed value: text that replaces evidence that may not be published.
REDACTED_TEXT = "Non-public evidence text redacted from generated public export."

RULE_COLUMNS = (
    "id string, label string, hosts array<string>, original_hosts array<string>, "
    "path_prefixes array<string>, evidence_types array<string>, priority int, category string, "
    "content_rights string, own_rights string, policy string, attribution_template string, "
    "export_allowed boolean"
)


def _anchors(rules: DataFrame) -> DataFrame:
    """Each rule under one of its own criteria, the most selective kind first."""
    given = lambda c: F.col(c).isNotNull() & (F.size(c) > 0)
    prefixes = F.transform("path_prefixes", _slash)
    kind = (
        F.when(given("hosts"), "host").when(given("original_hosts"), "original")
        .when(given("path_prefixes"), "prefix").when(given("evidence_types"), "type")
    )
    values = (
        F.when(given("hosts"), F.transform("hosts", F.lower))
        .when(given("original_hosts"), F.transform("original_hosts", F.lower))
        .when(given("path_prefixes"), prefixes)
        .when(given("evidence_types"), F.col("evidence_types"))
    )
    folded = rules.select(
        "*", kind.alias("_kind"), F.array_distinct(values).alias("_values"),
        F.transform("hosts", F.lower).alias("_hosts"),
        F.transform("original_hosts", F.lower).alias("_originals"), prefixes.alias("_prefixes"),
    )
    return folded.withColumn("_value", F.explode("_values")).drop("_values")


def _slash(p: Column) -> Column:
    return F.when(p.startswith("/"), p).otherwise(F.concat(F.lit("/"), p))


def match_rules(
    evidence: DataFrame, rules: DataFrame, key: str = "evidence_id", url: str = "source_url", kind: str = "type"
) -> DataFrame:
    """(evidence key, rule) pairs where every criterion given holds.

    An equi-join: a rule is filed under its most selective criterion and evidence looks
    itself up by host, archived host, type and - only when rules are filed by path - by its
    path cut at the lengths the rules use. The other criteria filter the candidates.
    """
    parsed = evidence.select(
        F.col(key), F.col(kind).alias("_e_type"), url_host(url).alias("_e_host"),
        url_host(archived_url(url)).alias("_e_original"), url_path(url).alias("_e_path"),
    )
    filed = _anchors(rules)
    lengths = [r.n for r in filed.filter("_kind = 'prefix'").select(F.length("_value").alias("n")).distinct().collect()]
    looked = [
        F.struct(F.lit("host").alias("_kind"), F.col("_e_host").alias("_value")),
        F.struct(F.lit("original").alias("_kind"), F.col("_e_original").alias("_value")),
        F.struct(F.lit("type").alias("_kind"), F.col("_e_type").alias("_value")),
    ] + [
        F.struct(F.lit("prefix").alias("_kind"), F.when(F.length("_e_path") >= n, F.substring("_e_path", 1, n)).alias("_value"))
        for n in sorted(lengths)  # at most one per character of the longest URL
    ]
    probes = parsed.select("*", F.explode(F.array(*looked)).alias("_p")).select(
        "*", "_p._kind", "_p._value"
    ).drop("_p").filter(F.col("_value").isNotNull())

    def holds(criteria: str, test: Column) -> Column:
        return F.col(criteria).isNull() | (F.size(criteria) == 0) | F.coalesce(test, F.lit(False))

    residual = (
        holds("evidence_types", F.array_contains("evidence_types", F.col("_e_type")))
        & holds("_hosts", F.array_contains("_hosts", F.col("_e_host")))
        & holds("_originals", F.array_contains("_originals", F.col("_e_original")))
        & holds("_prefixes", F.exists("_prefixes", lambda p: F.startswith(F.col("_e_path"), p)))
    )
    return probes.join(filed, ["_kind", "_value"]).filter(residual).select(key, *rules.columns).dropDuplicates([key, "id"])


def resolve_rules(
    evidence: DataFrame, rules: DataFrame, key: str = "evidence_id", url: str = "source_url", kind: str = "type"
) -> DataFrame:
    """R2: evidence with `status` (resolved or the reason), the winning `rule` and `matches`.

    The highest priority wins, ties by id are ambiguous. Per evidence only the two best
    rules matter; the aggregation keeps the best priority and how often it occurs.
    """
    matched = match_rules(evidence, rules, key, url, kind).withColumn("_prio", F.coalesce("priority", F.lit(0)))
    by_priority = matched.groupBy(key, "_prio").agg(
        F.count(F.lit(1)).alias("_n"), F.min_by(F.struct(*rules.columns), "id").alias("_rule")
    )
    top = by_priority.groupBy(key).agg(
        F.max_by(F.struct("_n", "_rule"), "_prio").alias("_top"), F.sum("_n").alias("matches")
    ).withColumnRenamed(key, "_key")
    joined = evidence.join(top, evidence[key] == top["_key"], "left").drop("_key")
    status = (
        F.when(F.col("_top").isNull(), F.when(url_ok(url), "no-match").otherwise("invalid-source-url"))
        .when(F.col("_top._n") > 1, "ambiguous-match").otherwise("resolved")
    )
    return joined.select(
        *evidence.columns, status.alias("status"),
        F.when(status == "resolved", F.col("_top._rule")).alias("rule"),
        F.coalesce("matches", F.lit(0)).alias("matches"),
    )


def redact(
    evidence: DataFrame, rules: DataFrame, text: str = "text", render: str | None = "render", **names
) -> DataFrame:
    """Replace text and drop renderings unless the rule resolves and allows export; adds `redacted`."""
    resolved = resolve_rules(evidence, rules, **names)
    public = (F.col("status") == "resolved") & F.coalesce(F.col("rule.export_allowed"), F.lit(False))
    out = resolved.withColumn("redacted", ~public).withColumn(
        text, F.when(F.col("redacted"), REDACTED_TEXT).otherwise(F.col(text))
    )
    if render and render in evidence.columns:
        out = out.withColumn(render, F.when(~F.col("redacted"), F.col(render)))
    return out.drop("status", "rule", "matches")


def attribution_index(evidence: DataFrame, rules: DataFrame, url: str = "source_url", **names) -> DataFrame:
    """A10: one entry per resolved evidence with its filled-in attribution text."""
    resolved = resolve_rules(evidence, rules, url=url, **names).filter("status = 'resolved'")
    return resolved.select(
        *evidence.columns, F.col("rule.id").alias("source_rule_id"),
        *[F.col(f"rule.{c}").alias(c) for c in ("content_rights", "own_rights", "policy")],
        fill_template("rule.attribution_template", "sourceUrl", url).alias("attribution"),
    )


def attribution_counts(index: DataFrame, rules: DataFrame) -> DataFrame:
    """A10: evidence count per rule, rules without evidence included."""
    counts = index.groupBy(F.col("source_rule_id").alias("id")).agg(F.count(F.lit(1)).alias("evidence_count"))
    return rules.join(counts, "id", "left").withColumn("evidence_count", F.coalesce("evidence_count", F.lit(0)))


def registry_errors(rights: DataFrame, rules: DataFrame) -> DataFrame:
    """Row rules of the registry: unique ids, known rights ids, at least one criterion."""
    def dup(df, what):
        return df.groupBy("id").count().filter("count > 1").select(F.lit(f"duplicate {what} id").alias("rule"), "id")

    known = rights.select(F.col("id").alias("_r")).distinct()
    used = rules.select("id", F.explode(F.array("content_rights", "own_rights")).alias("_r"))
    unknown = used.join(known, "_r", "left_anti").select(F.lit("unknown rights id").alias("rule"), "id").distinct()
    criteria = ["hosts", "original_hosts", "path_prefixes", "evidence_types"]
    bare = rules.filter(F.coalesce(*criteria).isNull()).select(F.lit("no match criterion").alias("rule"), "id")
    return dup(rights, "rights").unionByName(dup(rules, "source rule")).unionByName(unknown).unionByName(bare)
