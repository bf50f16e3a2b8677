"""Folding an append-only setter log into current state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.functions.text import entity_key
from faultline.operators import ordered
from faultline.schemas import PERIOD, SCOPE


def current_state(
    log: DataFrame, keys: Sequence[str], attr: str, seq: str, values: Sequence[str]
) -> DataFrame:
    """A1: last setter per (keys, attribute) in log order.

    An aggregation, not a window: every task keeps one row per entity it has seen
    before the shuffle, so an entity with a third of the log is no bottleneck.
    """
    return log.groupBy(*keys, attr).agg(*[F.max_by(v, seq).alias(v) for v in values])


def live_events(log: DataFrame, keys: Sequence[str], attr: str, seq: str, event_id: str) -> DataFrame:
    """A3: ids of the events that still define the state; sort by `seq` for order of last set."""
    return log.groupBy(*keys, attr).agg(
        F.max(seq).alias(seq), F.max_by(event_id, seq).alias(event_id)
    )


def attribute_of(entity_type: Column, event_type: Column) -> Column:
    """Attribute a setter writes, null when it does not apply to the entity's type."""
    service, facility = entity_type == "service", entity_type == "facility"
    return (
        F.when(event_type == "periods.set", F.lit("periods"))
        .when(event_type == "causes.set", F.lit("causes"))
        .when(service & (event_type == "service_effects.set"), F.lit("effect"))
        .when(facility & (event_type == "facility_effects.set"), F.lit("effect"))
        .when(service & (event_type == "service_scopes.set"), F.lit("scopes"))
    )


def with_attribute(impact: DataFrame) -> DataFrame:
    return impact.withColumn("entity_key", entity_key("entity")).withColumn(
        "attribute", attribute_of(F.col("entity.type"), F.col("type"))
    )


def bundle_state(impact: DataFrame) -> DataFrame:
    """A1 + A2 on the native event log: one row per (issue, entity) with state and provenance.

    A setter the entity type does not support sets nothing, yet its entity appears.
    """
    log = with_attribute(impact)
    last = {a: F.when(F.col("attribute") == a, F.col("seq")) for a in ("effect", "scopes", "periods", "causes")}
    empty = {
        "scopes": F.array().cast(f"array<{SCOPE}>"),
        "periods": F.array().cast(f"array<{PERIOD}>"),
        "causes": F.array().cast("array<string>"),
    }
    source = {"effect": "effect", "scopes": "service_scopes", "periods": "periods", "causes": "causes"}
    return log.groupBy("issue_id", "entity_key").agg(
        F.min_by("entity", "seq").alias("entity"),
        F.max_by("effect", last["effect"]).alias("effect"),
        *[F.coalesce(F.max_by(source[a], last[a]), empty[a]).alias(a) for a in ("scopes", "periods", "causes")],
        *[F.max_by("evidence_id", last[a]).alias(f"{a}_evidence_id") for a in source],
    )


def state_provenance(impact: DataFrame) -> DataFrame:
    """A2 in long form: evidence behind every live attribute."""
    log = with_attribute(impact).filter(F.col("attribute").isNotNull())
    return current_state(log, ["issue_id", "entity_key"], "attribute", "seq", ["evidence_id", "event_id"])


def bundle_live_events(impact: DataFrame) -> DataFrame:
    """A3 on the native log."""
    log = with_attribute(impact).filter(F.col("attribute").isNotNull())
    return live_events(log, ["issue_id", "entity_key"], "attribute", "seq", "event_id")


def emit_changes(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
    hot_rows: int | None = ordered.HOT_ROWS,
) -> DataFrame:
    """Rows whose value differs from the running value; null values set nothing."""
    rows = ordered.cut(df.filter(F.col(value).isNotNull()), keys, order[0], hot_rows)
    marked = ordered.previous(rows, keys, list(order), value, "_before")
    return ordered.uncut(marked.filter(~F.col(value).eqNullSafe(F.col("_before")))).drop("_before")
