import random

import pytest

from faultline import schemas as S
from faultline.operators import claims as C
from faultline.operators import fold
from faultline.operators import replay as R
from faultline.operators.diff import preserve_ids, replay_summary
from faultline.operators.impact import HINT_RANGE, add_hints, apply_hints, compute_impact, number_events, reconcile, reconcile_periods
from faultline.operators.state import bundle_state
from tests.helpers import claim, claims, end_only, event, fac, fixed, impact, local, recurring, start_only, svc, ts

WHOLE = [("service.whole", None, None, None)]


def issues(spark, kind="disruption", ids=("i1",)):
    return spark.createDataFrame([(i, kind) for i in ids], "issue_id string, type string")


def emitted(df):
    return [(r.evidence_id, r.entity_key, r.type) for r in df.orderBy("issue_id", "ev_seq", "pos", "attr_pos").collect()]


def test_order_of_emission_and_no_repeat(spark):
    rows = [
        claim("e1", "2024-01-01 08:00", svc("A"), service=("delay", None), scopes=WHOLE, hint=start_only("2024-01-01 08:00"), causes=["signal.fault"]),
        claim("e2", "2024-01-01 09:00", svc("A"), service=("delay", None), scopes=WHOLE, hint=start_only("2024-01-01 08:00"), causes=["signal.fault"]),
        claim("e3", "2024-01-01 10:00", svc("A"), service=("no-service", None), hint=end_only("2024-01-01 10:00")),
    ]
    out = compute_impact(claims(spark, rows, {"e1": 1, "e2": 2, "e3": 3}), issues(spark))
    assert emitted(out) == [
        ("e1", "service:A", "service_effects.set"), ("e1", "service:A", "periods.set"), ("e1", "service:A", "service_scopes.set"), ("e1", "service:A", "causes.set"),
        ("e3", "service:A", "service_effects.set"), ("e3", "service:A", "periods.set")]
    last = out.filter("type = 'periods.set' and evidence_id = 'e3'").first().periods
    assert [(local(p.start_at), local(p.end_at)) for p in last] == [("2024-01-01 08:00", "2024-01-01 10:00")]


def test_service_without_period_emits_nothing_but_causes_on_maintenance(spark):
    rows = [claim("e1", "2024-01-01 08:00", svc("A"), service=("delay", None), causes=["track.work"]),
            claim("e1", "2024-01-01 08:00", fac("S", "lift"), seq=1, facility="degraded")]
    df = claims(spark, rows, {"e1": 1})
    assert emitted(compute_impact(df, issues(spark))) == [("e1", "facility:S:lift", "facility_effects.set")]
    assert emitted(compute_impact(df, issues(spark, "maintenance"))) == [
        ("e1", "service:A", "causes.set"), ("e1", "facility:S:lift", "facility_effects.set")]


def test_empty_list_claims_on_fresh_entity_emit_nothing(spark):
    rows = [claim("e1", "2024-01-01 08:00", svc("A"), scopes=[], hint=fixed("2024-01-01 08:00", "2024-01-01 09:00"), causes=[])]
    assert emitted(compute_impact(claims(spark, rows, {"e1": 1}), issues(spark))) == [("e1", "service:A", "periods.set")]


def test_prior_state_is_the_baseline(spark):
    log = impact(spark, [
        event(1, "service_effects.set", svc("A"), "2024-01-01 08:00", "e0", effect=("delay", None)),
        event(2, "periods.set", svc("A"), "2024-01-01 08:00", "e0", periods=[fixed("2024-01-01 08:00")])])
    rows = [claim("e1", "2024-01-01 09:00", svc("A"), service=("delay", None), causes=["weather"]),
            claim("e2", "2024-01-01 10:00", svc("A"), hint=end_only("2024-01-01 10:00"))]
    out = compute_impact(claims(spark, rows, {"e1": 1, "e2": 2}), issues(spark), bundle_state(log))
    assert emitted(out) == [("e1", "service:A", "causes.set"), ("e2", "service:A", "periods.set")]


def test_reconcile_rules():
    f = lambda a, b=None: {"kind": "fixed", "start_at": a, "end_at": b, "frequency": None, "days_of_week": None, "window_start": None,
                           "window_end": None, "time_zone": None, "excluded_dates": None}
    rec = {**f(5, 90), "kind": "recurring", "window_start": "08:00:00", "window_end": "09:00:00"}
    hint = lambda k, a=None, b=None: {**f(a, b), "kind": k}
    assert reconcile([], hint("start-only", 3), "x", None) == [f(3)]
    assert reconcile([f(5), f(9, 10)], hint("start-only", 7), "x", None) == [f(5), f(7, 10)]
    assert reconcile([], hint("end-only", None, 3), None, "x") == []
    assert reconcile([f(1, 2), f(5)], hint("end-only", None, 8), None, "x") == [f(1, 2), f(5, 8)]
    assert reconcile([f(1, 2), f(5)], hint("fixed", 2, 4), None, None) == [f(1, 4), f(5)]
    assert reconcile([f(1), rec], hint("fixed", 7, 8), None, None) == [f(1), rec]
    assert reconcile([f(1)], rec, None, None) == [rec]
    assert reconcile([rec], hint("start-only", 6), "07:00:00", None) == [{**rec, "start_at": 6, "window_start": "07:00:00"}]
    assert reconcile([rec], hint("end-only", None, 80), None, "10:00:00") == [{**rec, "end_at": 80, "window_end": "10:00:00"}]


def as_period(kind, start, end):
    return {"kind": kind, "start_at": start, "end_at": end, "frequency": None, "days_of_week": None, "window_start": "22" if kind == "recurring" else None,
            "window_end": "23" if kind == "recurring" else None, "time_zone": None, "excluded_dates": None}


def random_hint_rows(rng, n, recurring_share):
    rows = []
    for _ in range(n):
        kind = "recurring" if rng.random() < recurring_share else rng.choice(["fixed", "fixed", "start-only", "end-only"])
        a, b = rng.randrange(12), rng.randrange(12)
        start = None if kind == "end-only" else a
        end = None if kind == "start-only" or (kind == "fixed" and rng.random() < .3) else b if rng.random() < .1 else max(a, b)
        rows.append({"hint": as_period(kind, start, end), "start_hms": None if start is None else f"s{start}", "end_hms": None if end is None else f"e{end}"})
    return rows


def test_a_summary_does_what_its_hints_do_to_any_periods():
    """Ties, spans that end before they start, open ends and every split of the hints into two ranges."""
    rng = random.Random(5)
    for trial in range(20_000):
        share = rng.choice([0, 0, .1])
        before = []
        for r in random_hint_rows(rng, rng.randrange(5), .2):
            before = reconcile(before, r["hint"], r["start_hms"], r["end_hms"])
        rows = random_hint_rows(rng, rng.randrange(9), share)
        want = before
        for r in rows:
            want = reconcile(want, r["hint"], r["start_hms"], r["end_hms"])
        at = rng.randrange(len(rows) + 1)
        half = [add_hints(HINT_RANGE.empty, part) for part in (rows[:at], rows[at:])]
        assert apply_hints(before, add_hints(HINT_RANGE.empty, rows)) == want, (before, rows)
        assert apply_hints(apply_hints(before, half[0]), half[1]) == want


def test_a_summary_of_fixed_hints_stays_small():
    rows = [{"hint": as_period("fixed", i, i + 2), "start_hms": None, "end_hms": None} for i in range(1000)]
    assert [len(s["spans"]) for s in add_hints(HINT_RANGE.empty, rows)["steps"]] == [1]


def test_a_hot_entity_takes_three_passes(spark, monkeypatch):
    """Fixed hints only: nothing resets, so states would travel through all ranges."""
    df = claims(spark, [claim(f"e{i:03d}", "2024-01-01 08:00", svc("A"), hint=fixed(f"2024-01-{1 + i % 28:02d} 08:00", f"2024-01-{1 + i % 28:02d} 1{i % 10}:00")) for i in range(200)],
                {f"e{i:03d}": i for i in range(200)})
    saved, runs = fold.cut_lineage, []
    monkeypatch.setattr(fold, "cut_lineage", lambda d: runs.append(1) or saved(d))
    hot = {str(r) for r in reconcile_periods(df, hot_rows=10).collect()}
    assert len(runs) == 1 and hot == {str(r) for r in reconcile_periods(df, hot_rows=None).collect()}


def random_claims(rng, n):
    rows, order = [], {}
    for i in range(n):
        day = f"2024-01-{1 + i // 24:02d} {i % 24:02d}:00"
        issue = rng.choice(["i1"] * 4 + ["i2"])
        ev = f"e{i:03d}"
        order[ev] = i
        for seq in range(rng.randrange(1, 4)):
            ent = rng.choice([svc("A"), svc("A"), svc("B"), fac("S", "lift")])
            hour = rng.randrange(24)
            when = f"2024-01-{rng.randrange(1, 28):02d} {hour:02d}:00"
            later = when[:8] + f"{int(when[8:10]) + 1:02d}" + when[10:]
            hint = rng.choice([None, None, start_only(when), end_only(later), fixed(when), fixed(when, later)] + ([recurring(when, "2024-03-01 00:00")] if rng.random() < .2 else []))
            rows.append(claim(ev, day, ent, seq, issue=issue, hint=hint,
                              service=rng.choice([None, ("delay", None), ("no-service", None)]) if ent[0] == "service" else None,
                              facility=rng.choice([None, "degraded", "out-of-service"]) if ent[0] == "facility" else None,
                              scopes=rng.choice([None, WHOLE, []]), causes=rng.choice([None, ["weather"], ["delay"], []])))
    return rows, order


def simulate(rows, order, kinds):
    """One evidence after another against a mutable state; the plain reading of the rules."""
    us = lambda t: None if t is None else int(t.timestamp() * 1e6)
    state, out = {}, []
    for ev in sorted(order, key=order.get):
        grouped = {}
        for r in rows:
            if r[1] == ev:
                e = r[4]
                key = (r[0], f"service:{e[1]}" if e[0] == "service" else f"facility:{e[2]}:{e[4]}")
                grouped.setdefault(key, []).append(r)
        for key, cs in grouped.items():
            st = state.setdefault(key, {"effect": None, "scopes": [], "periods": [], "causes": []})
            is_service = key[1].startswith("service")
            last = lambda f: next((v for v in (f(c) for c in reversed(cs)) if v is not None), None)
            hints = [c[8] for c in cs if c[8] is not None]
            can = not is_service or st["periods"] or hints
            if not can and not (kinds[key[0]] != "disruption" and any(c[9] is not None for c in cs)):
                continue
            effect = last(lambda c: (c[5][0] if is_service else c[5][1]))
            if can and effect is not None and effect != st["effect"]:
                st["effect"] = effect
                out.append((ev, key[1], "effect"))
            before = st["periods"]
            changed = False
            for h in hints:
                d = {"kind": h[0], "start_at": us(h[1]), "end_at": us(h[2]), "frequency": h[3], "days_of_week": h[4], "window_start": h[5],
                     "window_end": h[6], "time_zone": h[7], "excluded_dates": h[8]}
                at = us(cs[0][2])
                if d["kind"] == "fixed" and d["end_at"] is None and d["start_at"] > at:
                    d["start_at"] = at
                hms = lambda t: None if t is None else (lambda s: f"{s // 3600:02d}:{s % 3600 // 60:02d}:{s % 60:02d}")((t // 10**6 + 28800) % 86400)
                after = reconcile(before, d, hms(d["start_at"]), hms(d["end_at"]))
                changed |= after != before
                before = after
            if changed:
                st["periods"] = before
                out.append((ev, key[1], "periods:" + ";".join(f"{p['kind']}{p['start_at']}-{p['end_at']}" for p in before)))
            scopes = last(lambda c: c[6])
            if is_service and can and scopes is not None and scopes != st["scopes"]:
                st["scopes"] = scopes
                out.append((ev, key[1], "scopes"))
            causes = last(lambda c: c[9])
            if causes is not None and causes != st["causes"]:
                st["causes"] = causes
                out.append((ev, key[1], "causes"))
    return out


@pytest.mark.parametrize("hot_rows", [None, 12])
def test_compute_impact_equals_sequential_simulation(spark, hot_rows):
    rows, order = random_claims(random.Random(11), 120)
    kinds = {"i1": "disruption", "i2": "maintenance"}
    table = spark.createDataFrame(list(kinds.items()), "issue_id string, type string")
    us = lambda t: None if t is None else int(t.timestamp() * 1e6)
    names = {"service_effects.set": "effect", "facility_effects.set": "effect", "service_scopes.set": "scopes", "causes.set": "causes"}
    got = []
    for r in compute_impact(claims(spark, rows, order), table, hot_rows=hot_rows).collect():
        what = names.get(r.type) or "periods:" + ";".join(f"{p.kind}{us(p.start_at)}-{us(p.end_at)}" for p in r.periods)
        got.append((r.evidence_id, r.entity_key, what))
    assert sorted(got) == sorted(simulate(rows, order, kinds))


def test_fold_restarts_from_given_state_on_hot_keys(spark):
    rows, order = random_claims(random.Random(2), 90)
    df = claims(spark, rows, order)
    log = impact(spark, [event(1, "periods.set", svc("A"), "2024-01-01 00:00", "e", periods=[fixed("2023-12-01 00:00", "2023-12-02 00:00")])])
    state = bundle_state(log)
    plain = {str(r) for r in reconcile_periods(df, state, hot_rows=None).collect()}
    assert {str(r) for r in reconcile_periods(df, state, hot_rows=8).collect()} == plain and plain


# --- normalisation ------------------------------------------------------------------


def services(spark):
    rows = [("A", "L", [(ts("2020-01-01 00:00"), None)]), ("B", "L", [(ts("2020-01-01 00:00"), None)]), ("C", "L", [(ts("2020-01-01 00:00"), None)]),
            ("D", "L", [(ts("2020-01-01 00:00"), ts("2023-01-01 00:00"))]), ("X", "M", [(ts("2020-01-01 00:00"), None)])]
    return spark.createDataFrame(rows, "service_id string, line_id string, revisions array<struct<start_at:timestamp,end_at:timestamp>>")


def test_siblings_are_completed_only_for_equal_whole_service_claims(spark):
    at = "2024-01-01 08:00"
    same = [claim("e1", at, svc(s), i, service=("delay", None)) for i, s in enumerate("AB")]
    mixed = [claim("e2", at, svc("A"), 0, service=("delay", None)), claim("e2", at, svc("B"), 1, service=("no-service", None))]
    lone = [claim("e3", at, svc("A"), 0, service=("delay", None)), claim("e3", at, svc("D"), 1, service=("delay", None))]
    partial = [claim("e4", at, svc(s), i, service=("delay", None), scopes=[("service.point", None, None, "S")]) for i, s in enumerate("AB")]
    out = C.normalize_for_evidence(claims(spark, same + mixed + lone + partial), services(spark))
    got = {}
    for r in out.collect():
        got.setdefault(r.evidence_id, set()).add(r.entity.service_id)
        assert r.time_hints.kind == "start-only" and local(r.time_hints.start_at) == at
    assert got == {"e1": {"A", "B", "C"}, "e2": {"A", "B"}, "e3": {"A"}, "e4": {"A", "B"}}


def test_field_normalisation_and_dedup(spark):
    at = "2024-01-01 08:00"
    every = recurring(at, "2024-02-01 00:00", days=["MO", "TU", "WE", "TH", "FR", "SA", "SU"])
    rows = [claim("e", at, svc("A"), 0, hint=every, causes=[]), claim("e", at, svc("A"), 1, hint=recurring(at, "2024-02-01 00:00"), causes=None),
            claim("e", at, svc("A"), 2, service=("delay", None), signal="cleared")]
    out = sorted(C.normalize_for_evidence(claims(spark, rows)).collect(), key=lambda r: r.seq)
    assert [r.seq for r in out] == [0, 2] and out[0].time_hints.days_of_week is None and out[0].causes is None
    assert out[1].time_hints is None


def test_issue_date_takes_first_hint_only_when_it_has_a_start(spark):
    at = "2024-01-05 08:00"
    rows = [claim("e1", at, svc("A"), 1, hint=fixed("2024-01-02 08:00")), claim("e2", at, svc("A"), 0, hint=start_only("2024-01-02 08:00")),
            claim("e2", at, svc("A"), 1, hint=fixed("2024-01-01 08:00")), claim("e3", at, svc("A"))]
    df = claims(spark, rows)
    got = {r.evidence_id: local(r.issue_at) for r in C.issue_date(df.withColumn("created_at", df.evidence_ts)).collect()}
    assert got == {"e1": "2024-01-02 08:00", "e2": at, "e3": at}


# --- replay ---------------------------------------------------------------------------


def evidence(spark, rows):
    return spark.createDataFrame([(i, n, e, t, "text") for i, n, e, t in rows], "issue_id string, line_no long, evidence_id string, ts string, text string")


def test_replay_of_a_clean_log_reproduces_it(spark):
    rows = [claim("e1", "2024-01-01 08:00", svc("A"), service=("delay", None), hint=start_only("2024-01-01 08:00")),
            claim("e2", "2024-01-01 09:00", svc("A"), hint=end_only("2024-01-01 09:00"), causes=["weather"]),
            claim("e3", "2024-01-02 09:00", svc("A"), service=("no-service", None), hint=fixed("2024-01-02 08:00", "2024-01-02 10:00"))]
    log = number_events(compute_impact(claims(spark, rows, {"e1": 1, "e2": 2, "e3": 3}), issues(spark)))
    ev = evidence(spark, [("i1", 1, "e1", "2024-01-01T08:00:00+08:00"), ("i1", 2, "e2", "2024-01-01T01:00:00Z"), ("i1", 3, "e3", "2024-01-02T09:00:00+08:00")])
    again = R.replay(issues(spark), ev, log)
    total = replay_summary(log, again).filter("issue_id is null").first()
    # e3 carries both closed periods, each becomes a fixed hint; nothing else differs
    assert (total.before, total.after) == (6, 6) or total.diff == 0
    cols = ["evidence_id", "entity_key", "type", "periods", "effect", "causes"]
    assert {str(r) for r in again.select(*cols).collect()} == {str(r) for r in log.select(*cols).collect()}
    kept = preserve_ids(again.withColumn("seq", again.ev_seq * 10 + again.attr_pos), log.withColumn("event_id", log.type), "event_id", ["type", "evidence_id"], "seq")
    assert {r.event_id for r in kept.select("event_id").collect()} == {"service_effects.set", "periods.set", "causes.set"}


def test_replay_orders_by_instant_and_adapts_fresh_claims(spark):
    log = impact(spark, [
        event(1, "periods.set", svc("A"), "2024-01-01 09:00", "late", periods=[fixed("2024-01-01 08:00", "2024-01-01 09:00")]),
        event(2, "periods.set", svc("A"), "2024-01-01 08:00", "early", periods=[fixed("2024-01-01 08:00")])])
    ev = evidence(spark, [("i1", 1, "late", "2024-01-01T09:00:00+08:00"), ("i1", 2, "early", "2024-01-01T00:00:00Z")])
    out = R.replay(issues(spark), ev, log).orderBy("ev_seq").collect()
    assert [r.evidence_id for r in out] == ["early", "late"]
    assert local(out[1].periods[0].end_at) == "2024-01-01 09:00" and len(out[1].periods) == 1
    fresh = spark.createDataFrame([claim("late", "2024-01-01 09:00", svc("A"), hint=fixed("2024-01-01 08:30", "2024-01-01 08:45"))], S.claims_schema())
    out = R.replay(issues(spark), ev, log, fresh=fresh).orderBy("ev_seq").collect()
    assert [(local(p.start_at), local(p.end_at)) for p in out[1].periods] == [("2024-01-01 08:00", "2024-01-01 08:45")]


@pytest.mark.parametrize("hot_rows", [None, 6])
def test_replay_completes_siblings_and_drops_inactive(spark, hot_rows):
    def service_event(seq, name, at, ev, kind="delay"):
        return event(seq, "service_effects.set", svc(name), at, ev, effect=(kind, None))
    rows, ev = [], []
    for d in range(1, 13):
        at = f"2024-01-{d:02d} 08:00"
        kind = "delay" if d % 2 else "no-service"
        rows += [service_event(d * 10 + i, s, at, f"e{d}", kind) for i, s in enumerate("ABD")]
        ev.append(("i1", d, f"e{d}", f"2024-01-{d:02d}T08:00:00+08:00"))
    out = R.replay(issues(spark), evidence(spark, ev), impact(spark, rows), services(spark), hot_rows=hot_rows)
    got = {(r.evidence_id, r.entity.service_id, r.type) for r in out.collect()}
    want = {(f"e{d}", s, "service_effects.set") for d in range(1, 13) for s in "ABC"} | {("e1", s, "periods.set") for s in "ABC"}
    assert got == want


def test_batch_reconstruct_and_adapt(spark):
    log = impact(spark, [event(1, "periods.set", svc("A"), "2024-01-01 08:00", "e0", periods=[fixed("2024-01-01 08:00")])])
    later = impact(spark, [event(2, "periods.set", svc("A"), "2024-01-01 09:00", "e1", periods=[fixed("2024-01-01 08:00", "2024-01-01 09:00"), fixed("2024-01-03 08:00")])])
    got = sorted((r.time_hints.kind, local(r.time_hints.end_at)) for r in R.reconstruct_claims(later, bundle_state(log)).collect())
    assert got == [("end-only", "2024-01-01 09:00"), ("fixed", None)]
    fresh = claims(spark, [claim("e1", "2024-01-01 09:00", svc("A"), hint=fixed("2024-01-01 08:10", "2024-01-01 09:00")), claim("e1", "2024-01-01 09:00", svc("B"), 1, hint=fixed("2024-01-01 08:10"))])
    assert sorted(r.time_hints.kind for r in R.adapt_claims(fresh, bundle_state(log)).collect()) == ["end-only", "fixed"]


def test_targets(spark):
    log = impact(spark, [
        event(1, "periods.set", svc("A"), "2024-01-01 08:00", "e1", periods=[fixed("2024-01-02 08:00", "2024-01-01 08:00")]),
        event(2, "periods.set", svc("A"), "2024-01-01 08:00", "e2", periods=[fixed("2024-01-02 08:00")]),
        event(3, "periods.set", svc("A"), "2024-01-01 08:00", "e3", periods=[fixed("2024-01-02 08:00", "2024-01-03 08:00")]),
        event(4, "service_effects.set", svc("A"), "2024-01-01 08:00", "e3", effect=("no-service", None))])
    text = "Longer waits of up to 10 min. Expected works next year."
    ev = spark.createDataFrame([("i1", f"e{i}", "2024-01-01T08:00:00+08:00", text) for i in (1, 2, 3)] + [("i2", "e9", "2024-01-01T08:00:00+08:00", "no train service")],
                               "issue_id string, evidence_id string, ts string, text string")
    ids = lambda mode, **k: sorted(r.evidence_id for r in R.select_targets(ev, log, mode, **k).collect())
    assert ids("period-violations") == ["e1", "e2"]
    assert ids("period-violations", evidence_ids=["e2"]) == ["e2"]
    assert ids("degraded-future-no-service") == ["e3"]
    assert ids("empty-impact") == ["e9"]
    assert ids("explicit", issue_ids=["i1"], evidence_ids=["e1", "e9"]) == ["e1"]
    with pytest.raises(ValueError):
        ids("other")


def test_claims_are_brought_together_once_for_both_dedups(spark):
    rows = [claim("a", "2024-01-01 08:00", svc("s1"), i, service=("delay", None), hint=h) for i, h in enumerate([None, start_only("2024-01-01 08:00"), None])]
    out = C.normalize_for_evidence(claims(spark, rows), services(spark))
    dealt = [line for line in out._jdf.queryExecution().executedPlan().toString().splitlines() if "hashpartitioning(issue_id" in line and "_hash" in line]
    assert not dealt
    assert [local(r.time_hints.start_at) for r in out.collect()] == ["2024-01-01 08:00"]


def test_a_replayed_claim_is_not_written_as_text_again(monkeypatch):
    monkeypatch.setattr(R.json, "dumps", lambda *a, **k: pytest.fail("not needed"))
    row = {"ev_seq": 1, "evidence_id": "a", "ts_us": 5, "offset_s": 0, "seq": {"origin": 0, "seq": 1, "place": 0}, "entity_key": "service:s", "entity": '{"service_id":"s"}',
           "body": "{}", "periods": [R._hint("fixed", 1, 2), R._hint("fixed", 1, 2)], "hint": None, "fresh": False, "active": True, "siblings": None, "anchors": True, "whole": True}
    state, out = R._replay_step({}, [row])
    assert [(o["entity"], o["hint"]["end_at"]) for o in out] == [('{"service_id":"s"}', 2)] and len(state["service:s"]) == 1
