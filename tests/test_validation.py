import copy

import pytest
from pyspark.sql import functions as F

from faultline import schemas as S
from faultline.operators import quality as Q
from faultline.operators.rights import RULE_COLUMNS
from faultline.plans import validation as V
from faultline.session import small_table
from tests.helpers import event, fac, fixed, impact, svc

NAME = {"en-SG": "N", "zh-Hans": None, "ms": None, "ta": None}
HOURS = {d: {"start": "05:30", "end": "23:30"} for d in ("weekdays", "weekends")}
EV = "ev_01ARZ3NDEKTSV4RRFFQ69G5FA"


def code(line, text, start="2020-01-01", end=None):
    return {"lineId": line, "code": text, "startedAt": start, "endedAt": end, "structureType": "elevated"}


def station(i, codes, **more):
    return {"id": i, "name": NAME, "geo": {"latitude": 1.3, "longitude": 103.8}, "stationCodes": codes, "landmarkIds": ["m"], "townId": "t", **more}


def platform(i, label, services, day="2024-01-01", basis=None, line="L"):
    p = {"id": i, "label": label, "lastUpdated": day, "lineId": line, "serviceIds": services}
    return {**p, "inference": {"method": "same-line-platform-label", "basis": [{"stationId": s, "platformId": q} for s, q in basis]}} if basis else p


def clean():
    stops = [{"stationId": "A", "displayCode": "L1"}, {"stationId": "B", "displayCode": "L2"}]
    rev = {"id": "r", "startAt": "2020-01-01", "endAt": None, "path": {"stations": stops}, "operatingHours": HOURS}
    timing = {"services": [{"serviceId": "s", "times": {"daily": {"firstTrain": "05:30", "lastTrain": None}}}]}
    return {
        "station": [station("A", [code("L", "L1")], aliases=["Al"], firstLastTrain=timing, layout={"platforms": [platform("pA", "A", ["s"])]}),
                    station("B", [code("L", "L2")], layout={"platforms": [platform("pB", "A", ["s"], "2024-02-01", [("A", "pA")])]})],
        "line": [{"id": "L", "name": NAME, "type": "mrt.high", "color": "#fff", "startedAt": "2020-01-01", "platformDoorCount": 24, "trainCarCounts": [6], "serviceIds": ["s"],
                  "operators": [{"operatorId": "o", "startedAt": None, "endedAt": None}]}],
        "service": [{"id": "s", "name": NAME, "lineId": "L", "revisions": [rev]}],
        "operator": [{"id": "o", "name": NAME}], "town": [{"id": "t", "name": NAME}], "landmark": [{"id": "m", "name": NAME}],
    }


def tables(spark, docs, events=None, evidence=None, rules=None):
    import json

    t = {c: spark.createDataFrame([(json.dumps(d),) for d in docs[c]], "j string").select(F.from_json("j", S.ENTITY_JSON[c]).alias("d")).select("d.*") for c in docs}
    t["issue"] = spark.createDataFrame([("2024-01-01-x", "disruption")], "issue_id string, type string")
    t["evidence"] = spark.createDataFrame(evidence or [("2024-01-01-x", 1, EV + "V", "2024-01-01T08:00:00+08:00", "report.public", "t", "https://a.com/")],
                                          "issue_id string, line_no long, evidence_id string, ts string, type string, text string, source_url string")
    t["impact"] = impact(spark, events or [event(1, "periods.set", svc("s"), "2024-01-01 08:00", EV + "V", periods=[fixed("2024-01-01 08:00")], issue="2024-01-01-x")])
    t["source_rule"] = small_table(spark, rules or [("r", "r", ["a.com"], None, None, None, None, "x", "c", "o", "p", "t", True)], RULE_COLUMNS)
    return t


def rules_hit(spark, **kw):
    docs = kw.pop("docs", None) or clean()
    return {r.rule for r in V.validate(tables(spark, docs, **kw)).select("rule").distinct().collect()}


def test_clean_set_has_no_breach(spark):
    t = tables(spark, clean())
    errors = V.validate(t)
    assert errors.collect() == []
    done = {r.scope: (r.checked, r.ok) for r in V.summary({"station": t["station"]}, errors).collect()}
    assert done == {"station": (2, None), "errors": (0, True)}


def test_entity_breaches(spark):
    d = clean()
    a, b = d["station"]
    a["townId"], a["landmarkIds"], a["aliases"] = "zz", ["m", "zz"], ["Al", " al ", "  "]
    b["aliases"] = ["AL"]
    b["geo"]["latitude"] = 91.0
    a["firstLastTrain"]["services"] += [{"serviceId": "s", "times": {"daily": {"firstTrain": None, "lastTrain": None}}}, {"serviceId": "zz", "times": {"daily": {"firstTrain": "05:00", "lastTrain": None}}}]
    b["stationCodes"] = [code("L", "L2", end="2023-01-01"), code("Q", "Q1")]
    d["line"][0].update(platformDoorCount=None, trainCarCounts=[6, 6], serviceIds=["s", "zz"], operators=[{"operatorId": "zz", "startedAt": None, "endedAt": None}])
    d["service"][0]["revisions"][0]["path"]["stations"] += [{"stationId": "ZZ", "displayCode": ""}, {"stationId": "A", "displayCode": "L9"}]
    assert rules_hit(spark, docs=d) >= {
        "station town exists", "station landmark exists", "station code line exists", "alias repeats in station", "alias is not blank", "alias used by another station",
        "coordinates in range", "timing service repeats", "first or last train given", "timed service exists", "platform doors only off light rail",
        "train car counts are positive and distinct", "heavy rail has one train car count", "line service exists", "line operator exists", "stop station exists",
        "display code belongs to the station", "display code valid during revision"}


def test_platform_breaches(spark):
    d = clean()
    a, b = d["station"]
    d["line"].append({**copy.deepcopy(d["line"][0]), "id": "M", "serviceIds": []})
    d["service"].append({**copy.deepcopy(d["service"][0]), "id": "u", "lineId": "M"})
    d["service"].append({"id": "v", "name": NAME, "lineId": "L", "revisions": [{"id": "r", "startAt": "2030-01-01", "endAt": None, "path": {"stations": []}, "operatingHours": HOURS}]})
    d["service"].append({"id": "w", "name": NAME, "lineId": "L", "revisions": [{"id": "r", "startAt": "2020-01-01", "endAt": None, "path": {"stations": [{"stationId": "A", "displayCode": "L1"}]}, "operatingHours": HOURS}]})
    b["layout"]["platforms"] = [
        platform("pB", "B", ["s", "s", "u", "v", "w", "zz"], "2020-06-01", [("A", "pA"), ("A", "pA"), ("B", "pB"), ("ZZ", "x"), ("A", "nope")]),
        platform("pB", "A", ["s"], line="M"), platform("pC", "A", ["s"], line="zz"), platform("pD", "B", ["s"], "2024-03-01", [("B2", "pE")])]
    d["station"].append(station("B2", [code("L", "L3")], layout={"platforms": [platform("pE", "A", ["s"], "2024-01-01", [("A", "pA")])]}))
    assert rules_hit(spark, docs=d) >= {
        "platform id repeats", "platform service repeats", "platform line exists", "platform line assigned to station", "platform service exists", "platform service on its line",
        "platform service has an active revision", "platform service stops at the station", "inference basis repeats", "basis lies at another station", "basis station exists",
        "basis platform exists", "basis was observed directly", "basis has the same label", "basis not reviewed later", "inference supports every service"}


def test_issue_breaches(spark):
    i = "2024-01-01-x"
    events = [
        event(1, "periods.set", svc("s"), "2024-01-01 08:00", "nope", periods=[fixed("2019-01-01 08:00")], issue=i, event_id="same"),
        event(2, "periods.set", svc("s"), "2024-01-01 08:00", EV + "V", periods=[fixed("2024-01-01 08:00")], issue=i, event_id="same"),
        event(3, "causes.set", svc("zz"), "2024-01-01 08:00", EV + "V", causes=["dragons"], issue=i),
        event(4, "facility_effects.set", fac("ZZ", "lift"), "2024-01-01 08:00", EV + "V", effect=("odd", None), issue=i),
        event(5, "facility_effects.set", fac("A", "slide", "ZZ"), "2024-01-01 08:00", EV + "V", effect=("degraded", None), issue=i),
        event(6, "service_scopes.set", svc("s"), "2024-01-01 08:00", EV + "V", scopes=[("service.segment", "A", "ZZ", None), ("service.point", None, None, "B")], issue=i)]
    evidence = [(i, 1, EV + "V", "2024-01-01T08:00:00+08:00", "report.public", "t", "https://a.com/"), (i, 2, EV + "V", "bad", "rumour", "t", "https://z.com/"), (i, 3, "ev_x", "2024-01-01T08:00:00+08:00", "report.public", "t", "")]
    assert rules_hit(spark, events=events, evidence=evidence) == {
        "event evidence exists in bundle", "period starts in a service revision", "event id is unique", "one setter per entity, type and time", "event service exists", "causes are known",
        "event station exists", "effect is known", "facility kind is known", "event line exists", "scope station exists", "evidence id is unique", "evidence type is known",
        "evidence ts parses", "evidence id is generated", "evidence source rights resolve"}


def test_map_breaches(spark):
    t = tables(spark, clean())
    df = lambda rows, ddl: spark.createDataFrame(rows, ddl)
    t["segment"] = df([("m", "2024-01", "L", "B", "A", True), ("m", "2019-01", "L", "A", "B", True), ("m", "2024-01", "Z", "A", "Q", False)], "path string, effective_month string, line_id string, from_id string, to_id string, operational boolean")
    t["node"] = df([("m", "2024-01", "A", "L", True), ("m", "2019-01", "A", "L", True), ("m", "2024-01", "A", "Z", True), ("m", "2024-01", "Q", "L", True)], "path string, effective_month string, station_id string, line_id string, operational boolean")
    t["constraint"] = df([("2024-01", "c1")], "effective_month string, id string")
    t["use"] = df([("m", "2024-01", "c1"), ("m", "2024-01", "c2")], "path string, effective_month string, constraint_id string")
    t["snapshot"] = df([("2024-01", "v/2024-01/e.json", "e"), ("2024-02", "v/2024-01/e.json", "e")], "effective_month string, path string, engine_id string")
    t["manifest"] = df([("2024-01", "v/2024-01/e.json"), ("2024-03", "v/2024-03/e.json")], "effective_month string, path string")
    counts = {r.rule: r["count"] for r in V.validate(t, ["maps"]).groupBy("rule").count().collect()}
    assert counts == {"segment line exists": 1, "segment station exists": 1, "node station exists": 1, "operational segment is an active edge": 1, "node line is a code line": 1,
                      "node line code is active": 1, "constraint exists": 1, "snapshot is in the manifest": 1, "manifest entry has a snapshot": 1, "snapshot path matches month and engine": 1}


def test_raise_on_errors(spark):
    bad = spark.createDataFrame([("r", "p", "1", "m")], "rule string, path string, location string, message string")
    with pytest.raises(ValueError, match="r p 1: m"):
        Q.raise_on_errors(bad)
    Q.raise_on_errors(bad.filter("rule = 'x'"))


def test_id_audit_known_value(spark):
    df = spark.createDataFrame([("ev_01ARZ3NDEKTSV4RRFFQ69G5FAV",), ("ie_81ARZ3NDEKTSV4RRFFQ69G5FAV",), ("x",)], "id string")
    assert [(r.id_kind, r.id_millis) for r in Q.id_audit(df, "id").collect()] == [("evidence", 1469922850259), (None, None), (None, None)]
