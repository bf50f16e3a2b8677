"""Evaluation and reporting: regression cases, usage cost, state report (Q3-Q5, A5)."""

from __future__ import annotations

import json
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from faultline.functions.temporal import SGT, to_local
from faultline.operators.quality import unique_check

# USD per million tokens (input, cached input, output).
MODEL_PRICING = [
    ("gpt-5.4", 2.5, 0.25, 15.0),
    ("gpt-5.4-mini", 0.75, 0.075, 4.5),
    ("gpt-5.4-nano", 0.2, 0.02, 1.25),
]
# End of fixed values.


def usage_cost(usage: DataFrame, pricing: DataFrame, group: Sequence[str]) -> DataFrame:
    """A5: token sums and cost per group; cost is null when some model has no price.

    usage(model, input_tokens, cached_tokens, output_tokens, total_tokens); pricing(model,
    input_usd, cached_usd, output_usd) per million. Usage is summed per (group, model)
    before it meets the prices, so the join sees a few rows however many calls there were.
    """
    cached = F.greatest(F.coalesce("cached_tokens", F.lit(0)), F.lit(0))
    per_model = usage.select(
        *group, "model", F.col("input_tokens").alias("_i"), F.coalesce("cached_tokens", F.lit(0)).alias("_c"),
        F.col("output_tokens").alias("_o"), F.col("total_tokens").alias("_t"), cached.alias("_cp"),
        F.greatest(F.col("input_tokens") - cached, F.lit(0)).alias("_up"), F.greatest("output_tokens", F.lit(0)).alias("_op"),
    ).groupBy(*group, "model").agg(*[F.sum(c).alias(c) for c in ("_i", "_c", "_o", "_t", "_cp", "_up", "_op")])
    priced = per_model.join(pricing, "model", "left")
    cost = (F.col("_up") * F.col("input_usd") + F.col("_cp") * F.col("cached_usd") + F.col("_op") * F.col("output_usd")) / 1e6
    missing = F.col("input_usd").isNull()
    return priced.groupBy(*group).agg(
        F.sum("_i").alias("input_tokens"), F.sum("_c").alias("cached_tokens"), F.sum("_o").alias("output_tokens"),
        F.sum("_t").alias("total_tokens"), F.when(F.count_if(missing) == 0, F.sum(cost)).alias("cost_usd"),
        F.sort_array(F.collect_set(F.when(missing, F.col("model")))).alias("models_without_pricing"),
    )


# --- regression cases -------------------------------------------------------------


def filter_cases(cases: DataFrame, case_id: str | None = None, label: str | None = None) -> DataFrame:
    """Q4: cases by id and label, with a one-line summary."""
    out = cases
    if case_id is not None:
        out = out.filter(F.col("id") == case_id)
    if label is not None:
        out = out.filter(F.array_contains("labels", label))
    summary = F.format_string("%s [%s] %s -> %s (%s)", "id", "role", "observed_kind", "expected_kind", F.array_join("labels", ", "))
    return out.withColumn("summary", summary)


def duplicate_cases(cases: DataFrame, location: str = "path") -> DataFrame:
    return unique_check(cases, ["id"], [location])


def partial_match(actual, expected) -> bool:
    """Objects match by the expected keys, arrays when each expected item has a match, values exactly."""
    if isinstance(expected, list):
        return isinstance(actual, list) and all(any(partial_match(a, e) for a in actual) for e in expected)
    if isinstance(expected, dict):
        return isinstance(actual, dict) and all(k in actual and partial_match(actual[k], v) for k, v in expected.items())
    return type(actual) in (int, float) and type(expected) in (int, float) and actual == expected or (
        type(actual) is type(expected) and actual == expected)


@F.pandas_udf(BooleanType())
def matches_json(actual: pd.Series, expected: pd.Series) -> pd.Series:
    """Arrow UDF: nested partial match has no builtin; expectations are parsed once per batch."""
    parsed = {e: json.loads(e) for e in expected.dropna().unique()}
    return pd.Series([
        False if a is None or e is None else partial_match(json.loads(a), parsed[e]) for a, e in zip(actual, expected)
    ])


def _outcome_mismatch(e: str, a: str) -> Column:
    kind = lambda p: F.col(f"{p}_kind")
    detail = (
        F.when(kind(e) == "create", ~F.col(f"{e}_issue_type").eqNullSafe(F.col(f"{a}_issue_type")))
        .when(kind(e) == "update", ~F.col(f"{e}_issue_id").eqNullSafe(F.col(f"{a}_issue_id")))
        .when(kind(e) == "quarantine", ~F.col(f"{e}_reason").eqNullSafe(F.col(f"{a}_reason"))).otherwise(F.lit(False))
    )
    return (
        F.when(~kind(e).eqNullSafe(kind(a)), F.concat(F.lit("Expected outcome "), kind(e), F.lit(", received "), F.coalesce(kind(a), F.lit("none"))))
        .when(detail & (kind(e) == "create"), F.concat(F.lit("Expected create issue type "), F.col(f"{e}_issue_type")))
        .when(detail & (kind(e) == "update"), F.concat(F.lit("Expected update issue "), F.col(f"{e}_issue_id")))
        .when(detail, F.lit("Quarantine reason did not match"))
    )


def evaluate(cases: DataFrame, outcomes: DataFrame, assertions: DataFrame, candidates: DataFrame) -> DataFrame:
    """Q3: one row per mismatch.

    cases(id, expected_*), outcomes(id, actual_*) with kind, issue_type, issue_id, reason;
    assertions(id, assertion, kind, presence, match); candidates(id, kind, body) hold claims
    and events as JSON. Candidates meet assertions of their own case and kind only.
    """
    joined = cases.join(outcomes, "id", "left").withColumn("message", _outcome_mismatch("expected", "actual"))
    outcome_rows = joined.filter("message is not null").select("id", F.lit(None).cast("int").alias("assertion"), "message")
    found = candidates.join(assertions, ["id", "kind"]).filter(matches_json("body", "match")).select("id", "assertion").distinct()
    judged = assertions.join(found.withColumn("_hit", F.lit(True)), ["id", "assertion"], "left")
    hit = F.coalesce("_hit", F.lit(False))
    word = F.when((F.col("presence") == "required") & ~hit, "Missing").when((F.col("presence") == "forbidden") & hit, "Found forbidden")
    rows = judged.withColumn("_w", word).filter("_w is not null").select(
        "id", F.col("assertion").cast("int").alias("assertion"), F.concat_ws(" ", "_w", "kind", F.lit("matching"), "match").alias("message"))
    return outcome_rows.unionByName(rows)


# --- state report -----------------------------------------------------------------


def format_scope(s: Column) -> Column:
    return (
        F.when(s["type"] == "service.segment", F.concat(s["type"], F.lit(" ("), s["from_station_id"], F.lit(" → "), s["to_station_id"], F.lit(")")))
        .when(s["type"] == "service.point", F.concat(s["type"], F.lit(" ("), s["station_id"], F.lit(")"))).otherwise(s["type"])
    )


def offset_text(c: Column, tz: str = SGT) -> Column:
    """Offset of `tz` from UTC at an instant, as +hh:mm, whatever the session's time zone."""
    off = F.timestamp_diff("MINUTE", to_local(c, "timestamp", "UTC"), to_local(c, "timestamp", tz)).cast("int")
    return F.format_string("%s%02d:%02d", F.when(off < 0, "-").otherwise("+"), F.floor(F.abs(off) / 60).cast("int"), F.abs(off) % 60)


def format_period(p: Column, tz: str = SGT) -> Column:
    text = lambda c: F.when(c.isNotNull(), F.concat(F.date_format(to_local(c, "timestamp", tz), "yyyy-MM-dd'T'HH:mm:ss"), offset_text(c, tz)))
    fixed = F.concat(F.lit("fixed: "), text(p["start_at"]), F.lit(" → "), F.coalesce(text(p["end_at"]), F.lit("ongoing")))
    window = F.when(p["window_start"].isNotNull(), F.concat(F.lit(" "), p["window_start"], F.lit("–"), p["window_end"]))
    recurring = F.concat(F.lit("recurring "), p["frequency"], F.lit(": "), text(p["start_at"]), F.lit("–"), F.coalesce(text(p["end_at"]), F.lit("ongoing")),
                         F.coalesce(window, F.lit("")))
    return F.when(p["kind"] == "fixed", fixed).otherwise(recurring)


def state_report(state: DataFrame, tz: str = SGT) -> DataFrame:
    """Q5: readable columns per (issue, entity) of `bundle_state`, instants with the offset of `tz`."""
    evidence = F.array_distinct(F.array_compact(F.array(*[f"{a}_evidence_id" for a in ("effect", "scopes", "periods", "causes")])))
    return state.select(
        "issue_id", "entity_key", F.col("entity.type").alias("entity_type"), F.coalesce("effect.kind", F.lit("null")).alias("effect"),
        F.array_join(F.transform("scopes", format_scope), "; ").alias("scopes"),
        F.array_join(F.transform("periods", lambda p, i: F.concat(F.lit("["), i.cast("string"), F.lit("] "), format_period(p, tz))), "; ").alias("periods"),
        F.array_join("causes", ", ").alias("causes"), F.array_join(evidence, ", ").alias("evidence_ids"),
    )
