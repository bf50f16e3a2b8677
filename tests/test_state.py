import random

from faultline.operators import state as S
from tests.helpers import event, fac, fixed, impact, local, svc


def sample(spark):
    return impact(spark, [
        event(1, "service_effects.set", svc("A"), "2024-01-01 08:00", "ev1", effect=("delay", "PT10M")),
        event(2, "periods.set", svc("A"), "2024-01-01 08:00", "ev1", periods=[fixed("2024-01-01 08:00")]),
        event(3, "service_effects.set", svc("A"), "2024-01-01 09:00", "ev2", effect=("no-service", None)),
        event(4, "causes.set", svc("A"), "2024-01-01 09:00", "ev2", causes=[]),
        event(5, "facility_effects.set", fac("S1", "lift"), "2024-01-01 09:00", "ev2", effect=("degraded", None)),
        event(6, "facility_effects.set", fac("S1", "lift", "L1"), "2024-01-01 09:00", "ev2", effect=("out-of-service", None)),
        event(7, "service_scopes.set", fac("S2", "lift"), "2024-01-01 09:00", "ev3", scopes=[("service.whole", None, None, None)]),
    ])


def test_later_setter_wins_with_provenance(spark):
    rows = {r.entity_key: r for r in S.bundle_state(sample(spark)).collect()}
    a = rows["service:A"]
    assert a.effect.kind == "no-service" and a.effect_evidence_id == "ev2"
    assert local(a.periods[0].start_at) == "2024-01-01 08:00" and a.periods_evidence_id == "ev1"
    assert a.causes == [] and a.scopes == []
    assert rows["facility:S1:lift"].effect.kind == "degraded"
    assert rows["facility:S1:L1:lift"].effect.kind == "out-of-service"


def test_setter_of_other_type_sets_nothing_but_entity_appears(spark):
    rows = {r.entity_key: r for r in S.bundle_state(sample(spark)).collect()}
    assert rows["facility:S2:lift"].scopes == [] and rows["facility:S2:lift"].effect is None


def test_live_events_and_provenance(spark):
    live = {r.event_id for r in S.bundle_live_events(sample(spark)).collect()}
    assert live == {"i1-e2", "i1-e3", "i1-e4", "i1-e5", "i1-e6"}
    prov = {(r.entity_key, r.attribute): r.evidence_id for r in S.state_provenance(sample(spark)).collect()}
    assert prov[("service:A", "effect")] == "ev2" and prov[("service:A", "periods")] == "ev1"


def test_folding_the_live_events_gives_the_same_state(spark):
    log = sample(spark)
    live = S.bundle_live_events(log).select("event_id")
    again = S.bundle_state(log.join(live, "event_id", "left_semi"))
    cols = ["entity_key", "effect", "scopes", "periods", "causes"]
    first = {tuple(map(str, r)) for r in S.bundle_state(log).filter("entity_key <> 'facility:S2:lift'").select(*cols).collect()}
    assert {tuple(map(str, r)) for r in again.select(*cols).collect()} == first


def test_emit_changes_on_hot_key(spark):
    rng = random.Random(3)
    rows = [("k" if i % 3 else "j", i, rng.choice([None, "a", "b"])) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, o long, v string")
    want, last = [], {}
    for k, o, v in rows:
        if v is not None and last.get(k) != v:
            want.append((k, o, v))
            last[k] = v
    for hot in (20, None):
        assert sorted(map(tuple, S.emit_changes(df, ["k"], ["o"], "v", hot).collect())) == sorted(want)
