"""Replaying logs: order, reconstruction, replay, repair targets."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.functions.temporal import SGT, micros, parse_instant
from faultline.functions.text import JSON_OPTIONS, entity_key
from faultline.lineage import cut_lineage
from faultline.operators import ordered
from faultline.operators.claims import COPIED, SEQ, _active, clamp_hints, normalize_for_evidence, ordered_seq
from faultline.operators.fold import ordered_fold
from faultline.operators.impact import FOLD_PERIOD, compute_impact, from_fold_period, hint_columns, reconcile, to_fold_period
from faultline.operators.state import bundle_state
from faultline.schemas import CLAIM_EFFECT, ENTITY, SCOPE

# Wording that marks service as degraded, stopped, or stopping some day.
DEGRADED_NOW = [
    r"\blonger waits?\b", r"\bwaits? of up to\b", r"\bheadways? adjusted\b", r"\badditional travel time\b",
    r"\bsingle[- ]loop operation\b", r"\breduced frequency\b", r"\btrains? .* longer intervals\b",
]
NO_SERVICE_NOW = [
    r"\bno train service\b", r"\bno trains? (?:are )?running\b",
    r"\btrain services? (?:is|are|has been|have been)\s+(?:suspended|closed)\b",
    r"\bservice (?:is|are|has been|have been)\s+(?:suspended|closed)\b",
]
VAGUE_FUTURE = [
    r"\bplanned\b", r"\bexpected\b", r"\bfirst half of \d{4}\b", r"\bsecond half of \d{4}\b",
    r"\blater this year\b", r"\bnext year\b",
]
# End of fixed values.
TEXT_PATTERNS = {"degraded": DEGRADED_NOW, "no_service": NO_SERVICE_NOW, "vague_future": VAGUE_FUTURE}


def any_pattern(text: Column | str, patterns: Sequence[str]) -> Column:
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(c.rlike("(?i)" + "|".join(f"(?:{p})" for p in patterns)), F.lit(False))


def classify_text(df: DataFrame, text: str, patterns: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """One flag per pattern class, and `degraded_future` = degraded, not stopped, vague about the future."""
    p = patterns or TEXT_PATTERNS
    out = df.select("*", *[any_pattern(text, ps).alias(name) for name, ps in p.items()])
    return out.withColumn("degraded_future", F.col("degraded") & ~F.col("no_service") & F.col("vague_future"))


def period_violation(periods: Column | str = "periods", ts: Column | str = "ts") -> Column:
    """Some period ends at or before its start, or is open and starts after the event."""
    at = F.col(ts) if isinstance(ts, str) else ts
    return F.coalesce(F.exists(periods, lambda p: F.when(
        p["end_at"].isNotNull(), p["end_at"] <= p["start_at"]).otherwise((p["kind"] == "fixed") & (p["start_at"] > at))), F.lit(False))


def period_violations(impact: DataFrame) -> DataFrame:
    return impact.filter((F.col("type") == "periods.set") & period_violation())


def future_no_service(impact: DataFrame, evidence: DataFrame) -> DataFrame:
    """Evidence with an entity both without service and with a closed fixed period after it."""
    ts = evidence.select("issue_id", "evidence_id", parse_instant("ts").alias("_at"))
    rows = impact.withColumn("entity_key", entity_key("entity")).join(ts, ["issue_id", "evidence_id"])
    ahead = F.exists("periods", lambda p: (p["kind"] == "fixed") & (p["start_at"] > F.col("_at")) & p["end_at"].isNotNull())
    stopped = (F.col("type") == "service_effects.set") & (F.col("effect.kind") == "no-service")
    per_entity = rows.groupBy("issue_id", "evidence_id", "entity_key").agg(
        F.bool_or(stopped).alias("_a"), F.bool_or((F.col("type") == "periods.set") & ahead).alias("_b"))
    return per_entity.filter("_a and _b").select("issue_id", "evidence_id").distinct()


def select_targets(
    evidence: DataFrame, impact: DataFrame, mode: str, issue_ids: Sequence[str] | None = None,
    evidence_ids: Sequence[str] | None = None,
) -> DataFrame:
    """(issue_id, evidence_id) to extract again, in one of four modes."""
    key = ["issue_id", "evidence_id"]
    if mode == "period-violations":
        targets = period_violations(impact).filter("evidence_id is not null").select(*key).distinct()
    elif mode == "degraded-future-no-service":
        flagged = classify_text(evidence, "text").filter("degraded_future").select(*key)
        targets = flagged.join(future_no_service(impact, evidence), key, "left_semi")
    elif mode == "empty-impact":
        targets = evidence.join(impact.select("issue_id"), "issue_id", "left_anti").select(*key)
    elif mode == "explicit":
        targets = evidence.filter(F.col("evidence_id").isin(list(evidence_ids or []))).select(*key)
    else:
        raise ValueError(f"unknown mode {mode}")
    if issue_ids is not None:
        targets = targets.filter(F.col("issue_id").isin(list(issue_ids)))
    if evidence_ids is not None:
        targets = targets.filter(F.col("evidence_id").isin(list(evidence_ids)))
    return targets


def replay_order(
    evidence: DataFrame, keys: Sequence[str] = ("issue_id",), ts: str = "ts", out: str = "ev_seq",
    tie: str = "line_no", hot_rows: int | None = ordered.HOT_ROWS,
) -> DataFrame:
    """Place of each evidence in its issue, by instant, then by timestamp text, then file order."""
    rows = evidence.withColumn("_at", parse_instant(ts)).withColumn("_text", F.collate(ts, "UNICODE"))
    cut_rows = ordered.cut(rows, list(keys), "_at", hot_rows)
    return ordered.uncut(ordered.rank(cut_rows, list(keys), ["_at", "_text", tie], out)).drop("_at", "_text")


def events_by_evidence(
    evidence: DataFrame, impact: DataFrame, hot_rows: int | None = ordered.HOT_ROWS
) -> DataFrame:
    """Evidence with each of its events and the event's place among them; evidence alone keeps nulls.

    One row per event: a list per evidence would be unbounded.
    """
    keys = ["issue_id", "evidence_id"]
    placed = ordered.uncut(ordered.rank(ordered.cut(impact, keys, "seq", hot_rows), keys, ["seq"], "event_pos"))
    renamed = placed.select(*keys, "event_pos", "seq", "event_id", F.col("type").alias("event_type"))
    return evidence.join(renamed, keys, "left")


def first_of_type(impact: DataFrame) -> DataFrame:
    """C9, static part: per (evidence, entity) the first event of each attribute, as claim fields plus periods."""
    rows = impact.withColumn("entity_key", entity_key("entity"))
    kind = F.col("type")
    pick = lambda value, *types: F.min_by(value, F.when(kind.isin(*types), F.col("seq")))
    eff = pick(F.struct("type", "effect"), "service_effects.set", "facility_effects.set")
    out = rows.groupBy("issue_id", "evidence_id", "entity_key").agg(
        F.min_by("entity", "seq").alias("entity"), eff.alias("_e"), pick("service_scopes", "service_scopes.set").alias("scopes"),
        pick("causes", "causes.set").alias("causes"), pick("periods", "periods.set").alias("periods"), F.min("seq").alias("seq"))
    service = F.col("_e.type") == "service_effects.set"
    effect = F.when(F.col("_e").isNotNull(), F.struct(
        F.when(service, F.col("_e.effect")).alias("service"),
        F.when(~service, F.struct(F.col("_e.effect.kind").alias("kind"))).alias("facility"))).cast(CLAIM_EFFECT)
    return out.withColumn("effect", effect).drop("_e")


def _open_start(periods: list[dict]):
    return next((p["start_at"] for p in periods if p["kind"] == "fixed" and p["end_at"] is None), None)


def _hint(kind: str, start, end) -> dict:
    return {"kind": kind, "start_at": start, "end_at": end, "frequency": None, "days_of_week": None,
            "window_start": None, "window_end": None, "time_zone": None, "excluded_dates": None}


def hint_for_period(period: dict, open_start) -> dict:
    """The hint that would have led to this period, given the open period before it."""
    if period["kind"] == "recurring":
        return period
    if open_start is not None and period["start_at"] == open_start:
        if period["end_at"] is None:
            return _hint("start-only", period["start_at"], None)
        return _hint("end-only", None, period["end_at"])
    return _hint("fixed", period["start_at"], period["end_at"])


def adapt_hint(hint: dict | None, open_start) -> dict | None:
    """A fresh fixed hint updates the open period instead of adding another."""
    if hint is None or hint["kind"] != "fixed" or open_start is None:
        return hint
    return _hint("start-only", hint["start_at"], None) if hint["end_at"] is None else _hint("end-only", None, hint["end_at"])


def _replay_step(state: dict, rows: list[dict]):
    """One evidence: hints of its claims from the periods its entities have by now, then the new periods."""
    claims = []
    for r in rows:
        opened = _open_start(state.get(r["entity_key"], []))
        base = {"entity_key": r["entity_key"], "entity": None, "body": r["body"], "seq": r["seq"]}
        if r["fresh"]:
            claims.append({**base, "hint": adapt_hint(r["hint"], opened), "row": r})
            continue
        if not r["active"]:
            continue
        hints = [hint_for_period(p, opened) for p in (r["periods"] or [])] or [None]
        claims += [{**base, "hint": h, "row": r, "seq": {**r["seq"], "place": i}} for i, h in enumerate(hints)]
    claims += _copies_for_siblings(claims)
    out, seen = [], set()
    for c in claims:
        r, hint = c["row"], c["hint"]
        if hint is None and r["anchors"] and not r["fresh"]:
            hint = _hint("start-only", r["ts_us"], None)
        same = (c["entity_key"], c["body"], _hint_key(hint))
        if same in seen and not r["fresh"]:
            continue
        seen.add(same)
        out.append({"ev_seq": r["ev_seq"], "evidence_id": r["evidence_id"], "ts_us": r["ts_us"], "seq": c["seq"],
                    "entity": r["entity"] if c["entity"] is None else json.dumps(c["entity"]), "body": c["body"], "hint": hint})
        if hint is not None:
            applied = hint
            if hint["kind"] == "fixed" and hint["end_at"] is None and hint["start_at"] > r["ts_us"]:
                applied = _hint("fixed", r["ts_us"], None)
            before = state.get(c["entity_key"], [])
            state[c["entity_key"]] = reconcile(before, applied, _clock(applied["start_at"], r), _clock(applied["end_at"], r))
    return state, out


def _hint_key(hint: dict | None):
    """A hint as a key: its values by field, lists as tuples."""
    return hint and tuple((k, tuple(v) if isinstance(v, list) else v) for k, v in sorted(hint.items()))


def _clock(us, row):
    """Wall-clock time of an instant at the fixed offset of the log."""
    if us is None:
        return None
    s = (us // 1_000_000 + row["offset_s"]) % 86_400
    return f"{s // 3600:02d}:{s % 3600 // 60:02d}:{s % 60:02d}"


def _copies_for_siblings(claims: list[dict]) -> list[dict]:
    """J4 inside a replay, where hints depend on the replayed state."""
    whole = [c for c in claims if c["row"]["whole"] and c["row"]["siblings"] is not None and not c["row"]["fresh"]]
    if not whole:
        return []
    named = [json.loads(c["row"]["entity"]) for c in whole]
    present = {e["service_id"] for e in named}
    templates = {(c["body"], _hint_key(c["hint"])) for c in whole}
    if len(present) < 2 or len(templates) != 1:
        return []
    first = whole[0]
    return [
        {**first, "entity": {**named[0], "service_id": s}, "entity_key": f"service:{s}", "seq": {**first["row"]["seq"], "origin": COPIED, "place": i}}
        for i, s in enumerate(first["row"]["siblings"]) if s not in present
    ]


def claims_from_log(
    evidence: DataFrame, impact: DataFrame, services: DataFrame | None = None, fresh: DataFrame | None = None,
    tz: str = SGT, hot_rows: int | None = ordered.HOT_ROWS,
) -> DataFrame:
    """C9-C10 along the log: normalised claims per evidence with ev_seq, ready for `compute_impact`.

    Rows are folded per (issue, line) for services with a known line and per (issue, entity)
    otherwise, the only units whose hints depend on each other. `services` as for
    `filter_inactive`; `fresh` are claims that replace the events of their evidence; a row
    without entity says that the evidence has no claims.
    """
    ev = replay_order(evidence, hot_rows=hot_rows).select(
        "issue_id", "evidence_id", "ev_seq", parse_instant("ts").alias("ts"))
    body = F.to_json(F.struct("effect", "scopes", "causes", "status_signal"), JSON_OPTIONS)
    old = first_of_type(impact).withColumns({
        "status_signal": F.lit(None).cast("string"), "causes": F.when(F.size("causes") > 0, F.col("causes")),
        "effect": F.struct(F.col("effect.service").alias("service"), F.col("effect.facility").alias("facility")),
    })
    base = lambda df: [F.col(c) for c in ("issue_id", "evidence_id", "entity_key")] + [ordered_seq(df).alias("seq"),
        F.to_json("entity", {"ignoreNullFields": "false"}).alias("entity"), F.col("entity.service_id").alias("_sid"), body.alias("body"),
        ((F.col("entity.type") == "service") & F.col("effect.service").isNotNull()).alias("anchors"),
        (F.col("scopes").isNull() | F.forall("scopes", lambda s: s["type"] == "service.whole")).alias("_whole")]
    every_day = lambda p: (p["kind"] == "recurring") & (p["frequency"] == "daily") & (F.size(F.array_distinct(p["days_of_week"])) == 7)
    tidy = lambda p: p.withField("days_of_week", F.when(F.coalesce(every_day(p), F.lit(False)), None).otherwise(p["days_of_week"]))
    no_hint = F.lit(None).cast(FOLD_PERIOD)
    rows = old.select(*base(old), F.transform("periods", lambda p: to_fold_period(tidy(p))).cast(f"array<{FOLD_PERIOD}>").alias("periods"),
                      no_hint.alias("hint"), F.lit(False).alias("fresh"))
    if fresh is not None:
        replaced = fresh.select("issue_id", "evidence_id").distinct()
        given = fresh.filter("entity is not null").withColumn("entity_key", entity_key("entity"))
        rows = rows.join(replaced, ["issue_id", "evidence_id"], "left_anti").unionByName(given.select(
            *base(given), F.lit(None).cast(f"array<{FOLD_PERIOD}>").alias("periods"),
            to_fold_period(F.col("time_hints")).cast(FOLD_PERIOD).alias("hint"), F.lit(True).alias("fresh")))
    rows = rows.join(ev, ["issue_id", "evidence_id"])
    if services is not None:
        dim = services.select(F.col("service_id").alias("_sid"), "line_id", "revisions")
        listed = dim.groupBy("line_id").agg(F.array_sort(F.collect_list(F.struct("_sid", "revisions"))).alias("_line"))
        rows = rows.join(dim, "_sid", "left").join(listed, "line_id", "left")  # lines and services are dimensions
        live = F.transform(F.filter("_line", lambda s: _active(s["revisions"], F.col("ts"))), lambda s: s["_sid"])
        active = F.col("line_id").isNull() | F.coalesce(_active(F.col("revisions"), F.col("ts")), F.lit(False))
        rows = rows.withColumns({"active": active, "siblings": F.when(F.col("line_id").isNotNull(), live)})
    else:
        rows = rows.withColumns({"active": F.lit(True), "siblings": F.lit(None).cast("array<string>"), "line_id": F.lit(None).cast("string")})
    local = F.convert_timezone(F.lit("UTC"), F.lit(tz), F.col("ts").cast("timestamp_ntz"))
    rows = rows.select(
        "issue_id", F.coalesce(F.concat(F.lit("line:"), "line_id"), "entity_key").alias("unit"), "ev_seq", "seq", "evidence_id",
        "entity_key", "entity", "body", "periods", "hint", "fresh", "active", "siblings", "anchors",
        (F.col("anchors") & F.col("_whole")).alias("whole"), micros("ts").alias("ts_us"),
        F.timestamp_diff("SECOND", F.col("ts").cast("timestamp_ntz"), local).cast("int").alias("offset_s"),
    )
    out = T._parse_datatype_string(
        f"ev_seq bigint, evidence_id string, ts_us bigint, seq {SEQ}, entity string, body string, hint {FOLD_PERIOD}")
    folded = ordered_fold(rows, ["issue_id", "unit"], ["ev_seq", "seq"], _replay_step, {}, out, None, hot_rows)
    parsed = F.from_json("body", f"effect {CLAIM_EFFECT}, scopes array<{SCOPE}>, causes array<string>, status_signal string")
    return folded.withColumn("_b", parsed).select(
        "issue_id", "evidence_id", F.timestamp_micros("ts_us").alias("evidence_ts"), "ev_seq", "seq",
        F.from_json("entity", ENTITY).alias("entity"), "_b.effect", "_b.scopes", "_b.status_signal",
        F.when(F.col("hint").isNotNull(), from_fold_period(F.col("hint"))).alias("time_hints"), "_b.causes",
    )


def replay(
    issues: DataFrame, evidence: DataFrame, impact: DataFrame, services: DataFrame | None = None,
    fresh: DataFrame | None = None, tz: str = SGT, hot_rows: int | None = ordered.HOT_ROWS,
) -> DataFrame:
    """C11 and, with `fresh` claims, C12: the event log the current rules give from scratch.

    The claims the log stands for are written out between the two folds, so the first is not
    run again by every later job. Events stay joined to evidence, so events without evidence drop out. Ids of equal old
    events can be taken over with `diff.preserve_ids`.
    """
    claims = cut_lineage(claims_from_log(evidence, impact, services, fresh, tz, hot_rows))
    return compute_impact(claims, issues, None, tz, hot_rows)


def adapt_claims(claims: DataFrame, state: DataFrame) -> DataFrame:
    """C10 for a batch of fresh claims against `bundle_state`."""
    is_open = F.exists("periods", lambda p: (p["kind"] == "fixed") & p["end_at"].isNull())
    opened = state.filter(is_open).select("issue_id", "entity_key", F.lit(True).alias("_open"))
    rows = claims.withColumn("entity_key", entity_key("entity")).join(opened, ["issue_id", "entity_key"], "left")
    h = F.col("time_hints")
    adapt = F.coalesce(F.col("_open") & (h["kind"] == "fixed"), F.lit(False))
    changed = F.when(h["end_at"].isNull(), h.withField("kind", F.lit("start-only"))).otherwise(
        h.withField("kind", F.lit("end-only")).withField("start_at", F.lit(None).cast(claims.select("time_hints.start_at").schema[0].dataType)))
    return rows.withColumn("time_hints", F.when(adapt, changed).otherwise(h)).select(*claims.columns)


def reconstruct_claims(impact: DataFrame, state: DataFrame) -> DataFrame:
    """C9 for a batch of events against a given state: one claim per period, or one without hint."""
    opened = state.select("issue_id", "entity_key", F.try_element_at(F.filter(
        "periods", lambda p: (p["kind"] == "fixed") & p["end_at"].isNull()), F.lit(1))["start_at"].alias("_open"))
    firsts = first_of_type(impact).join(opened, ["issue_id", "entity_key"], "left")
    rows = firsts.select("*", F.posexplode_outer("periods").alias("_i", "_p"))
    p = F.col("_p")
    updates = F.coalesce((p["kind"] == "fixed") & (p["start_at"] == F.col("_open")), F.lit(False))
    hint = (
        F.when(p.isNull(), None).when(updates & p["end_at"].isNull(), p.withField("kind", F.lit("start-only")))
        .when(updates, p.withField("kind", F.lit("end-only")).withField("start_at", F.lit(None).cast("timestamp"))).otherwise(p)
    )
    return rows.select(
        "issue_id", "evidence_id", "entity", "effect", "scopes", F.lit(None).cast("string").alias("status_signal"),
        hint.alias("time_hints"), "causes", ordered_seq(rows, F.coalesce("_i", F.lit(0))).alias("seq"))


__all__ = [
    "adapt_claims", "bundle_state", "claims_from_log", "classify_text", "clamp_hints", "events_by_evidence",
    "future_no_service", "normalize_for_evidence", "period_violations", "reconstruct_claims", "replay", "replay_order",
    "select_targets",
]
