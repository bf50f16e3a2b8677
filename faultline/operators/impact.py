"""From claims to change events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.functions.temporal import SGT, micros, to_local
from faultline.functions.text import entity_key
from faultline.operators import ordered
from faultline.operators.claims import clamp_hints, last_non_null
from faultline.operators.fold import Summary, ordered_fold
from faultline.schemas import EFFECT, PERIOD, SCOPE

# Inside the fold instants are microseconds and dates are text, so states survive JSON.
FOLD_PERIOD = (
    "struct<kind:string,start_at:bigint,end_at:bigint,frequency:string,days_of_week:array<string>,"
    "window_start:string,window_end:string,time_zone:string,excluded_dates:array<string>>"
)
ENTITY_KEY = ["issue_id", "entity_key"]
# Order of the events one evidence emits for an entity.
ATTRIBUTE_ORDER = {"effect": 0, "periods": 1, "scopes": 2, "causes": 3}


def to_fold_period(p: Column) -> Column:
    return F.when(p.isNotNull(), F.struct(
        p["kind"].alias("kind"), micros(p["start_at"]).alias("start_at"), micros(p["end_at"]).alias("end_at"),
        *[p[f].alias(f) for f in ("frequency", "days_of_week", "window_start", "window_end", "time_zone")],
        F.transform(p["excluded_dates"], lambda d: d.cast("string")).alias("excluded_dates"),
    ))


def from_fold_period(p: Column) -> Column:
    return F.struct(
        p["kind"].alias("kind"), F.timestamp_micros(p["start_at"]).alias("start_at"), F.timestamp_micros(p["end_at"]).alias("end_at"),
        *[p[f].alias(f) for f in ("frequency", "days_of_week", "window_start", "window_end", "time_zone")],
        F.transform(p["excluded_dates"], lambda d: d.cast("date")).alias("excluded_dates"),
    ).cast(PERIOD)


# --- one reconciliation step (C6) -----------------------------------------------


def _fixed(start, end):
    return {"kind": "fixed", "start_at": start, "end_at": end, "frequency": None, "days_of_week": None,
            "window_start": None, "window_end": None, "time_zone": None, "excluded_dates": None}


def _absorb(periods: list[dict], start, end) -> list[dict]:
    """Union of the fixed periods with one more; recurring ones stay behind."""
    spans = sorted([(p["start_at"], p["end_at"]) for p in periods if p["kind"] == "fixed"] + [(start, end)], key=lambda x: x[0])
    merged: list[list] = []
    for lo, hi in spans:
        if merged and (merged[-1][1] is None or merged[-1][1] >= lo):
            merged[-1][1] = None if None in (merged[-1][1], hi) else max(merged[-1][1], hi)
        else:
            merged.append([lo, hi])
    return [_fixed(lo, hi) for lo, hi in merged] + [p for p in periods if p["kind"] == "recurring"]


def _retime(period: dict, edge: str, instant, hms) -> dict:
    """Move an edge of a recurring period and the same edge of its daily window."""
    moved = {**period, f"{edge}_at": instant}
    if period["window_start"] is not None:
        moved[f"window_{edge}"] = hms
    return moved


def reconcile(periods: list[dict], hint: dict, start_hms: str | None, end_hms: str | None) -> list[dict]:
    """Periods after one hint.

    fixed merges, recurring replaces everything, start-only opens a period or moves fixed
    starts earlier and re-anchors recurring ones, end-only closes open fixed periods and
    re-ends recurring ones.
    """
    kind, start, end = hint["kind"], hint["start_at"], hint["end_at"]
    if kind == "fixed":
        return _absorb(periods, start, end)
    if kind == "recurring":
        return [hint]
    if kind == "start-only":
        if not periods:
            return [_fixed(start, None)]
        return [
            {**p, "start_at": min(p["start_at"], start)} if p["kind"] == "fixed"
            else p if p["start_at"] == start else _retime(p, "start", start, start_hms)
            for p in periods
        ]
    if kind == "end-only":
        return [
            p if p["kind"] == "fixed" and p["end_at"] is not None
            else {**p, "end_at": end} if p["kind"] == "fixed" else _retime(p, "end", end, end_hms)
            for p in periods
        ]
    return periods


def _period_step(state, rows):
    periods, touched = state, False
    for r in rows:
        after = reconcile(periods, r["hint"], r["start_hms"], r["end_hms"])
        touched = touched or after != periods
        periods = after
    return periods, ([{"ev_seq": rows[0]["ev_seq"], "periods": periods}] if touched else [])


# --- a range of hints as one function of the periods before it -------------------------
#
# `reset` holds the periods after a recurring hint, which replaces whatever was there, and the hints
# after it; nothing before it matters. Without one, `steps` are of two forms. A union is a run of
# fixed hints: their merged spans do what they would do one by one. A move is a run of start-only
# and end-only hints: fixed periods take the least start and, where open, the first end; recurring
# ones the last start and end; no periods become `opened`.


def _add_move(move: dict | None, hint: dict, start_hms: str | None, end_hms: str | None) -> dict:
    m = move or {"least": None, "start": None, "start_hms": None, "one_start": True, "closing": None, "end": None, "end_hms": None, "ended": False, "opened": []}
    m = {**m, "opened": reconcile(m["opened"], hint, start_hms, end_hms)}
    if hint["kind"] == "start-only":
        at = hint["start_at"]
        return {**m, "least": at if m["least"] is None else min(m["least"], at), "start": at, "start_hms": start_hms,
                "one_start": m["one_start"] and m["start"] in (None, at)}
    return {**m, "closing": hint["end_at"] if m["closing"] is None else m["closing"], "end": hint["end_at"], "end_hms": end_hms, "ended": True}


def _move(periods: list[dict], m: dict) -> list[dict]:
    if not periods:
        return m["opened"]
    out = []
    for p in periods:
        if p["kind"] == "fixed":
            start = p["start_at"] if m["least"] is None else min(p["start_at"], m["least"])
            out.append({**p, "start_at": start, "end_at": m["closing"] if p["end_at"] is None else p["end_at"]})
            continue
        if m["start"] is not None and not (m["one_start"] and p["start_at"] == m["start"]):
            p = _retime(p, "start", m["start"], m["start_hms"])
        out.append(_retime(p, "end", m["end"], m["end_hms"]) if m["ended"] else p)
    return out


def add_hints(summary: dict, rows: list[dict]) -> dict:
    """`summary` followed by the hints of `rows`."""
    reset, steps = summary["reset"], list(summary["steps"])
    for r in rows:
        hint, given = r["hint"], (r["start_hms"], r["end_hms"])
        kind, start, end = hint["kind"], hint["start_at"], hint["end_at"]
        if kind == "recurring" or reset is not None:
            reset, steps = reconcile(reset or [], hint, *given), []
        elif kind == "fixed":
            backwards = end is not None and end < start  # such a span is not merged with others beforehand
            if steps and steps[-1]["step"] == "union" and not (backwards or steps[-1]["alone"]):
                steps[-1] = {**steps[-1], "spans": _absorb(steps[-1]["spans"], start, end)}
            else:
                steps.append({"step": "union", "alone": backwards, "spans": [_fixed(start, end)]})
        elif kind in ("start-only", "end-only"):
            last = steps.pop()["move"] if steps and steps[-1]["step"] == "move" else None
            steps.append({"step": "move", "move": _add_move(last, hint, *given)})
    return {"reset": reset, "steps": steps}


def apply_hints(periods: list[dict], summary: dict) -> list[dict]:
    """Periods after the hints of `summary`."""
    if summary["reset"] is not None:
        return summary["reset"]
    for s in summary["steps"]:
        if s["step"] == "move":
            periods = _move(periods, s["move"])
        else:
            for span in s["spans"]:
                periods = _absorb(periods, span["start_at"], span["end_at"])
    return periods


HINT_RANGE = Summary({"reset": None, "steps": []}, add_hints, apply_hints)


def hint_columns(tz: str = SGT) -> list[Column]:
    hms = lambda c: F.date_format(to_local(c, "timestamp", tz), "HH:mm:ss")
    return [
        to_fold_period(F.col("time_hints")).alias("hint"),
        hms(F.col("time_hints.start_at")).alias("start_hms"), hms(F.col("time_hints.end_at")).alias("end_hms"),
    ]


def reconcile_periods(
    claims: DataFrame, state: DataFrame | None = None, tz: str = SGT, hot_rows: int | None = ordered.HOT_ROWS,
    cuts: DataFrame | None = None,
) -> DataFrame:
    """C6 over whole logs: (issue_id, entity_key, ev_seq, periods) where an evidence changed them.

    claims need ev_seq, the evidence's place in its issue; those without one have no place and are
    left out. Consecutive repeats of a hint change nothing and cost one list comparison. An entity
    that is cut into ranges takes three passes: a range's hints are summarised as one function.
    """
    hints = clamp_hints(claims).filter("time_hints is not null").select(
        "issue_id", entity_key("entity").alias("entity_key"), "ev_seq", "seq", *hint_columns(tz))
    initial = None
    if state is not None:
        initial = state.filter(F.size("periods") > 0).select(
            *ENTITY_KEY, F.to_json(F.transform("periods", to_fold_period), {"ignoreNullFields": "false"}).alias("_state"))
        initial = initial.join(hints.select(*ENTITY_KEY).distinct(), ENTITY_KEY, "left_semi")
    out = T._parse_datatype_string(f"ev_seq bigint, periods array<{FOLD_PERIOD}>")
    folded = ordered_fold(hints, ENTITY_KEY, ["ev_seq", "seq"], _period_step, [], out, initial, hot_rows, cuts, HINT_RANGE)
    return folded.withColumn("periods", F.transform("periods", from_fold_period))


def compute_impact(
    claims: DataFrame, issues: DataFrame, state: DataFrame | None = None, tz: str = SGT,
    hot_rows: int | None = ordered.HOT_ROWS,
) -> DataFrame:
    """Change events of every evidence against the state the earlier ones left.

    claims: claim columns plus ev_seq; issues(issue_id, type); state as `bundle_state`.
    Claims without ev_seq have no place in the log and emit nothing.
    A service without period or hint emits nothing, except causes on issues that are no
    disruption (C7). That gate is the place of the first hint that opens a period - an
    aggregate - because periods never become empty again; effect, scopes and causes are then
    plain change detection and only periods are folded.
    Output: event columns with (ev_seq, pos, attr_pos) as the order of emission.
    """
    claims = claims.filter("ev_seq is not null")
    keyed = claims.withColumn("entity_key", entity_key("entity"))
    cuts = ordered.find_cuts(keyed, ENTITY_KEY, "ev_seq", hot_rows)  # once, for windows and fold
    hot_rows = None
    hint = F.col("time_hints.kind")
    merged = keyed.groupBy(*ENTITY_KEY, "ev_seq").agg(
        F.min("evidence_id").alias("evidence_id"), F.min("evidence_ts").alias("ts"), F.max_by("entity", "seq").alias("entity"),
        last_non_null(F.col("effect.service"), "seq").alias("_service"),
        last_non_null(F.col("effect.facility"), "seq").alias("_facility"),
        last_non_null(F.col("scopes"), "seq").alias("_scopes"), last_non_null(F.col("causes"), "seq").alias("_causes"),
        F.bool_or(hint.isNotNull()).alias("_hinted"), F.min("seq").alias("pos"),
    )
    opened = keyed.filter(hint.isin("fixed", "recurring", "start-only")).groupBy(*ENTITY_KEY).agg(F.min("ev_seq").alias("_open"))
    rows = merged.join(opened, ENTITY_KEY, "left").join(issues.select("issue_id", F.col("type").alias("_issue_type")), "issue_id", "left")
    if state is not None:
        had = state.filter(F.size("periods") > 0).select(*ENTITY_KEY, F.lit(True).alias("_had"))
        rows = rows.join(had, ENTITY_KEY, "left")
    else:
        rows = rows.withColumn("_had", F.lit(False))
    is_service = F.col("entity.type") == "service"
    can = ~is_service | F.col("_hinted") | F.coalesce(F.col("_had"), F.lit(False)) | F.coalesce(F.col("ev_seq") > F.col("_open"), F.lit(False))
    may_note = can | (F.coalesce(F.col("_issue_type"), F.lit("")) != "disruption")
    effect = F.when(is_service, F.struct(F.col("_service.kind").alias("kind"), F.col("_service.duration").alias("duration"))).otherwise(
        F.struct(F.col("_facility.kind").alias("kind"), F.lit(None).cast("string").alias("duration"))).cast(EFFECT)
    null = lambda t: F.lit(None).cast(t)
    s_t, c_t = f"array<{SCOPE}>", "array<string>"
    changes = F.array_compact(F.array(
        F.when(can & effect["kind"].isNotNull(), F.struct(F.lit("effect").alias("attribute"), F.struct(
            effect.alias("effect"), null(s_t).alias("scopes"), null(c_t).alias("causes")).alias("value"))),
        F.when(can & is_service & F.col("_scopes").isNotNull(), F.struct(F.lit("scopes").alias("attribute"), F.struct(
            null(EFFECT).alias("effect"), F.col("_scopes").cast(s_t).alias("scopes"), null(c_t).alias("causes")).alias("value"))),
        F.when(may_note & F.col("_causes").isNotNull(), F.struct(F.lit("causes").alias("attribute"), F.struct(
            null(EFFECT).alias("effect"), null(s_t).alias("scopes"), F.col("_causes").alias("causes")).alias("value"))),
    ))
    values = rows.select(*ENTITY_KEY, "ev_seq", F.inline(changes))
    if state is not None:
        held = F.array(
            F.struct(F.lit("effect").alias("attribute"), F.struct(F.col("effect").cast(EFFECT).alias("effect"), null(s_t).alias("scopes"), null(c_t).alias("causes")).alias("value")),
            F.struct(F.lit("scopes").alias("attribute"), F.struct(null(EFFECT).alias("effect"), F.col("scopes").cast(s_t).alias("scopes"), null(c_t).alias("causes")).alias("value")),
            F.struct(F.lit("causes").alias("attribute"), F.struct(null(EFFECT).alias("effect"), null(s_t).alias("scopes"), F.col("causes").alias("causes")).alias("value")),
        )
        wanted = state.join(merged.select(*ENTITY_KEY).distinct(), ENTITY_KEY, "left_semi")
        values = values.unionByName(wanted.select(*ENTITY_KEY, F.lit(-1).cast("long").alias("ev_seq"), F.inline(held)))
    keys = [*ENTITY_KEY, "attribute"]
    rows = ordered.apply_cuts(values, ENTITY_KEY, "ev_seq", cuts)
    marked = ordered.previous(rows, keys, ["ev_seq"], "value", "_before")
    unset = F.coalesce(F.size("value.scopes"), F.lit(-1)) == 0
    unset = unset | (F.coalesce(F.size("value.causes"), F.lit(-1)) == 0)
    differs = F.when(F.col("_before").isNull(), ~unset).otherwise(~F.col("value").eqNullSafe(F.col("_before")))
    emitted = marked.filter((F.col("ev_seq") >= 0) & differs).select(
        *ENTITY_KEY, "ev_seq", "attribute", "value.effect", "value.scopes", "value.causes", null(f"array<{PERIOD}>").alias("periods"))
    moved = reconcile_periods(claims, state, tz, hot_rows, cuts).select(
        *ENTITY_KEY, "ev_seq", F.lit("periods").alias("attribute"), null(EFFECT).alias("effect"), null(s_t).alias("scopes"),
        null(c_t).alias("causes"), "periods")
    facts = merged.select(*ENTITY_KEY, "ev_seq", "evidence_id", "ts", "entity", "pos")
    events = emitted.unionByName(moved).join(facts, [*ENTITY_KEY, "ev_seq"])
    name = (
        F.when((F.col("attribute") == "effect") & is_service, "service_effects.set")
        .when(F.col("attribute") == "effect", "facility_effects.set")
        .when(F.col("attribute") == "scopes", "service_scopes.set").otherwise(F.concat("attribute", F.lit(".set")))
    )
    ranks = F.create_map(*[F.lit(x) for kv in ATTRIBUTE_ORDER.items() for x in kv])
    return events.select(
        "issue_id", "entity_key", "ev_seq", "pos", ranks[F.col("attribute")].alias("attr_pos"),
        F.concat(F.lit("ie_"), F.upper(F.substring(F.sha2(F.concat_ws("|", "issue_id", "evidence_id", "entity_key", name), 256), 1, 26))).alias("event_id"),
        name.alias("type"), "entity", "ts", "evidence_id", "periods", F.col("scopes").alias("service_scopes"), "effect", "causes",
    )


def number_events(events: DataFrame, hot_rows: int | None = ordered.HOT_ROWS, after: int = 0) -> DataFrame:
    """Log positions for emitted events: `seq` per issue in order of emission."""
    rows = ordered.cut(events, ["issue_id"], "ev_seq", hot_rows)
    ranked = ordered.uncut(ordered.rank(rows, ["issue_id"], ["ev_seq", "pos", "entity_key", "attr_pos"], "seq"))
    return ranked.withColumn("seq", F.col("seq") + after)
