"""Validation of a whole data set: every rule a DataFrame, all in one error table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline import schemas as S
from faultline.functions.temporal import contains_interval, date_instant, in_month, parse_hms, parse_instant, valid_at
from faultline.functions.text import entity_key, fold_alias, issue_id_valid, pair_key
from faultline.operators import quality as Q
from faultline.operators.network import adjacent_pairs, service_stops, station_codes
from faultline.operators.rights import resolve_rules

# Two-letter country codes an address may carry.
COUNTRIES = (
    "AD AE AF AG AI AL AM AO AQ AR AS AT AU AW AX AZ BA BB BD BE BF BG BH BI BJ BL BM BN BO BQ BR BS BT BV BW BY BZ "
    "CA CC CD CF CG CH CI CK CL CM CN CO CR CU CV CW CX CY CZ DE DJ DK DM DO DZ EC EE EG EH ER ES ET FI FJ FK FM FO FR "
    "GA GB GD GE GF GG GH GI GL GM GN GP GQ GR GS GT GU GW GY HK HM HN HR HT HU ID IE IL IM IN IO IQ IR IS IT JE JM JO JP "
    "KE KG KH KI KM KN KP KR KW KY KZ LA LB LC LI LK LR LS LT LU LV LY MA MC MD ME MF MG MH MK ML MM MN MO MP MQ MR MS MT MU "
    "MV MW MX MY MZ NA NC NE NF NG NI NL NO NP NR NU NZ OM PA PE PF PG PH PK PL PM PN PR PS PT PW PY QA RE RO RS RU RW "
    "SA SB SC SD SE SG SH SI SJ SK SL SM SN SO SR SS ST SV SX SY SZ TC TD TF TG TH TJ TK TL TM TN TO TR TT TV TW TZ "
    "UA UG UM US UY UZ VA VC VE VG VI VN VU WF WS YE YT ZA ZM ZW"
).split()
# End of fixed values.


def _in(c: Column, values: Sequence[str]) -> Column:
    return c.isin(list(values))


def _rows(df: DataFrame, rule: str, path: str, where: Column, what: Column | str) -> DataFrame:
    what = F.col(what) if isinstance(what, str) else what
    return Q.errors(df, rule, F.col(path), where, what)


def _at(prefix: str, *cols: str) -> Column:
    return F.concat_ws(".", F.lit(prefix), *[F.col(c).cast("string") for c in cols])


def _located(df: DataFrame, id_col: str = "id") -> DataFrame:
    return df if "path" in df.columns else df.withColumn("path", F.col(id_col))


def station_parts(stations: DataFrame) -> dict[str, DataFrame]:
    """Nested lists of station documents as tables, each with path, station and position."""
    s = _located(stations).withColumnRenamed("id", "station_id")
    base = ["path", "station_id"]

    def grow(array: str, alias: str) -> DataFrame:
        return s.select(*base, F.posexplode(array).alias("pos", alias))

    platforms = grow("layout.platforms", "p").select(
        *base, "pos", F.col("p.id").alias("platform_id"), "p.label", F.col("p.lastUpdated").alias("last_updated"), F.col("p.lineId").alias("line_id"),
        F.col("p.serviceIds").alias("service_ids"), F.col("p.boardingStatus").alias("boarding_status"), F.col("p.inference").alias("inference"))
    timings = grow("firstLastTrain.services", "t").select(*base, "pos", F.col("t.serviceId").alias("service_id"), "t.times", "t.specialTimes")
    return {
        "codes": grow("stationCodes", "c").select(*base, "pos", F.col("c.lineId").alias("line_id"), "c.code", "c.structureType"),
        "landmarks": grow("landmarkIds", "landmark_id"),
        "aliases": grow("aliases", "alias"),
        "exits": grow("layout.exits", "e").select(*base, "pos", F.col("e.sourceObjectId").alias("object_id"), F.col("e.sourceChecksum").alias("checksum"), "e.label", "e.geo"),
        "platforms": platforms,
        "platform_services": platforms.select(*base, "pos", "platform_id", "line_id", "last_updated", F.posexplode("service_ids").alias("spos", "service_id")),
        "basis": platforms.select(*base, "pos", "platform_id", "line_id", "label", "last_updated", F.posexplode("inference.basis").alias("bpos", "b")).select(
            *base, "pos", "platform_id", "line_id", "label", "last_updated", "bpos", F.col("b.stationId").alias("basis_station_id"), F.col("b.platformId").alias("basis_platform_id")),
        "timings": timings,
    }


def row_rules(t: Mapping[str, DataFrame]) -> list[DataFrame]:
    """V1 for the native tables."""
    out = []
    if "station" in t:
        p = station_parts(t["station"])
        stations = _located(t["station"])
        geo_ok = lambda g: F.col(f"{g}.latitude").between(-90, 90) & F.col(f"{g}.longitude").between(-180, 180)
        lay = F.col("layout")
        out += [
            Q.expectations(stations, {
                "coordinates in range": geo_ok("geo"),
                "address country is known": F.col("address.addressCountry").isNull() | _in(F.col("address.addressCountry"), COUNTRIES),
                "exits come with their source": lay.isNull() | (F.col("layout.exitSourceId").isNull() == F.col("layout.exits").isNull()),
                "layout has exits or platforms": lay.isNull() | F.col("layout.exits").isNotNull() | F.col("layout.platforms").isNotNull(),
            }, F.col("path")),
            Q.expectations(p["codes"], {"structure type is known": _in(F.col("structureType"), S.STRUCTURE_TYPES)}, F.col("path"), _at("stationCodes", "pos")),
            Q.expectations(p["aliases"], {"alias is not blank": F.trim("alias") != ""}, F.col("path"), _at("aliases", "pos")),
            Q.expectations(p["exits"], {
                "exit checksum has 16 hex digits": F.col("checksum").rlike("^[0-9A-F]{16}$"), "exit coordinates in range": geo_ok("geo"),
                "exit object id is positive": F.col("object_id") > 0, "exit label is not empty": F.col("label") != "",
            }, F.col("path"), _at("layout.exits", "pos")),
            Q.expectations(p["platforms"], {
                "non-boardable platform has no services": F.col("service_ids").isNull() | F.col("boarding_status").isNull(),
                "boarding status is known": F.col("boarding_status").isNull() | _in(F.col("boarding_status"), S.BOARDING_STATUSES),
            }, F.col("path"), _at("layout.platforms", "pos")),
            Q.expectations(p["timings"], {
                "times or special times given": (F.coalesce(F.size("times"), F.lit(0)) > 0) | (F.coalesce(F.size("specialTimes"), F.lit(0)) > 0),
                "first or last train given": F.forall(F.concat(F.coalesce(F.map_values("times"), F.array()), F.coalesce(F.map_values("specialTimes"), F.array())),
                                                      lambda x: x["firstTrain"].isNotNull() | x["lastTrain"].isNotNull()),
            }, F.col("path"), _at("firstLastTrain.services", "pos")),
        ]
    if "line" in t:
        lrt = F.col("type") == "lrt"
        counts = F.col("trainCarCounts")
        out.append(Q.expectations(_located(t["line"]), {
            "line type is known": _in(F.col("type"), S.LINE_TYPES),
            "platform doors only off light rail": lrt == F.col("platformDoorCount").isNull(),
            "platform door count is positive": F.col("platformDoorCount").isNull() | (F.col("platformDoorCount") > 0),
            "heavy rail has one train car count": lrt | (F.size(counts) == 1),
            "train car counts are positive and distinct": (F.size(counts) > 0) & F.forall(counts, lambda c: c > 0) & (F.size(F.array_distinct(counts)) == F.size(counts)),
        }, F.col("path")))
    if "service" in t:
        revs = _located(t["service"]).select("path", F.posexplode("revisions").alias("pos", "r")).filter("r.estimatedFrequency is not null")
        fine = lambda h: (h["minSeconds"] > 0) & (h["minSeconds"] <= h["representativeSeconds"]) & (h["representativeSeconds"] <= h["maxSeconds"])
        out.append(Q.expectations(revs, {
            "default headway is ordered": fine(F.col("r.estimatedFrequency.defaultHeadway")),
            "period headways are ordered": F.forall("r.estimatedFrequency.periods", lambda p: fine(p["headway"])),
            "frequency periods have length": F.forall("r.estimatedFrequency.periods", lambda p: parse_hms(p["start"]) != parse_hms(p["end"])),
        }, F.col("path"), _at("revisions", "pos")))
    if "issue" in t:
        out.append(Q.expectations(_located(t["issue"], "issue_id"), {
            "issue id is date and slug": issue_id_valid("issue_id"), "issue type is known": _in(F.col("type"), S.ISSUE_TYPES)}, F.col("path")))
    if "evidence" in t:
        out.append(Q.expectations(t["evidence"], {
            "evidence id is generated": F.col("evidence_id").rlike(Q.EVIDENCE_ID_PATTERN),  # V5
            "evidence type is known": _in(F.col("type"), S.EVIDENCE_TYPES), "evidence ts parses": parse_instant("ts").isNotNull(),
        }, F.col("issue_id"), F.col("line_no")))
    if "impact" in t:
        kind = F.col("entity.type")
        out.append(Q.expectations(t["impact"], {
            "event type is known": _in(F.col("type"), S.EVENT_TYPES), "event ts parses": F.col("ts").isNotNull(),
            "entity is service or facility": _in(kind, ["service", "facility"]),
            "facility kind is known": (kind != "facility") | _in(F.col("entity.kind"), S.FACILITY_KINDS),
            "causes are known": (F.col("type") != "causes.set") | F.forall("causes", lambda c: c.isin(S.CAUSES)),
            "periods are known kinds": (F.col("type") != "periods.set") | F.forall("periods", lambda p: p["kind"].isin("fixed", "recurring") & p["start_at"].isNotNull()),
            "effect is known": ~_in(F.col("type"), ["service_effects.set", "facility_effects.set"]) | _in(F.col("effect.kind"), S.SERVICE_EFFECTS + S.FACILITY_EFFECTS),
        }, F.col("issue_id"), F.col("seq")))
    return out


def reference_rules(t: Mapping[str, DataFrame]) -> list[DataFrame]:
    """V2, V3, V7-V10 for stations, lines and services."""
    stations, lines, services = t["station"], t["line"], t["service"]
    p = station_parts(stations)
    s = _located(stations)
    out = [
        _rows(Q.fk_check(s, "townId", t["town"], "id"), "station town exists", "path", F.lit("townId"), "townId"),
        _rows(Q.fk_check(p["landmarks"], "landmark_id", t["landmark"], "id"), "station landmark exists", "path", _at("landmarkIds", "pos"), "landmark_id"),
        _rows(Q.fk_check(p["codes"], "line_id", lines, "id"), "station code line exists", "path", _at("stationCodes", "pos"), "line_id"),
    ]
    ops = _located(lines).select("path", F.posexplode("operators.operatorId").alias("pos", "operator_id"))
    line_services = _located(lines).select("path", F.posexplode("serviceIds").alias("pos", "service_id"))
    out += [
        _rows(Q.fk_check(ops, "operator_id", t["operator"], "id"), "line operator exists", "path", _at("operators", "pos"), "operator_id"),
        _rows(Q.fk_check(line_services, "service_id", services, "id"), "line service exists", "path", _at("serviceIds", "pos"), "service_id"),
        _rows(Q.fk_check(_located(services), "lineId", lines, "id"), "service line exists", "path", F.lit("lineId"), "lineId"),
    ]
    aliases = p["aliases"].withColumn("folded", fold_alias("alias"))
    for rule, df, key, where in (
        ("alias repeats in station", aliases, ["path", "folded"], _at("aliases", "pos")),
        ("exit object id repeats in station", p["exits"], ["path", "object_id"], _at("layout.exits", "pos")),
        ("platform id repeats", p["platforms"], ["path", "platform_id"], _at("layout.platforms", "pos")),
        ("timing service repeats", p["timings"], ["path", "service_id"], _at("firstLastTrain.services", "pos")),
    ):
        out.append(_rows(Q.first_seen(df, key, ["pos"]), rule, "path", where, F.col(key[-1]).cast("string")))
    out += [
        _rows(Q.first_seen(p["platform_services"], ["path", "pos", "service_id"], ["spos"]), "platform service repeats", "path", _at("layout.platforms", "pos", "spos"), "service_id"),
        _rows(Q.first_seen(p["basis"], ["path", "pos", "basis_station_id", "basis_platform_id"], ["bpos"]), "inference basis repeats", "path", _at("layout.platforms", "pos", "bpos"), "basis_platform_id"),
        _rows(Q.unique_across(aliases, ["folded"], "station_id", ["path", "pos"]), "alias used by another station", "path", _at("aliases", "pos"), "folded"),
        _rows(Q.unique_across(p["exits"], ["object_id"], "station_id", ["path", "pos"]), "exit object id used by another station", "path", _at("layout.exits", "pos"), F.col("object_id").cast("string")),
    ]
    # V7: display codes of path stops
    stops = service_stops(services).withColumn("row", F.struct("service_id", "rev_pos", "pos"))
    stops = stops.join(_located(services).select(F.col("id").alias("service_id"), "path"), "service_id")
    where = _at("revisions", "rev_pos", "pos")
    unknown = Q.fk_check(stops, "station_id", stations, "id")
    out.append(_rows(unknown, "stop station exists", "path", where, "station_id"))
    codes = station_codes(stations).select(
        F.concat_ws("|", "station_id", "line_id", "code").alias("code_key"), F.col("start_at").alias("c_start"), F.col("end_at").alias("c_end"))
    coded = stops.join(stations.select(F.col("id").alias("station_id")), "station_id", "left_semi").filter("display_code <> ''").withColumn(
        "stop_key", F.concat_ws("|", "station_id", "line_id", "display_code"))
    out.append(_rows(Q.fk_check(coded, "stop_key", codes, "code_key"), "display code belongs to the station", "path", where, "display_code"))
    inside = contains_interval("c_start", "c_end", "start_at", "end_at")
    late = Q.outside_every_window(coded, ["row"], "stop_key", codes, "code_key", inside, require_match=True)
    out.append(_rows(late, "display code valid during revision", "path", where, "display_code"))
    # V8: platforms
    plats = p["platforms"]
    owned = p["codes"].select(F.concat_ws("|", "station_id", "line_id").alias("k"))
    known_line = plats.join(lines.select(F.col("id").alias("line_id")), "line_id", "left_semi").withColumn("k", F.concat_ws("|", "station_id", "line_id"))
    ps = p["platform_services"].join(services.select(F.col("id").alias("service_id"), F.col("lineId").alias("service_line")), "service_id", "left")
    on_line = ps.filter("service_line = line_id").withColumn("row", F.struct("path", "pos", "spos"))
    revs = services.select(F.col("id").alias("rev_service"), F.explode("revisions").alias("r")).select(
        "rev_service", F.col("r.startAt").alias("r_start"), F.col("r.endAt").alias("r_end"), F.col("r.path.stations.stationId").alias("r_stations"))
    live = valid_at("r_start", "r_end", F.col("last_updated"))
    active = on_line.join(revs, on_line["service_id"] == revs["rev_service"]).filter(live)
    misses = active.filter(~F.array_contains("r_stations", F.col("station_id")))
    pwhere, swhere = _at("layout.platforms", "pos"), _at("layout.platforms", "pos", "spos")
    out += [
        _rows(Q.fk_check(plats, "line_id", lines, "id"), "platform line exists", "path", pwhere, "line_id"),
        _rows(Q.fk_check(known_line, "k", owned, "k"), "platform line assigned to station", "path", pwhere, "line_id"),
        _rows(ps.filter("service_line is null"), "platform service exists", "path", swhere, "service_id"),
        _rows(ps.filter("service_line <> line_id"), "platform service on its line", "path", swhere, "service_id"),
        _rows(Q.outside_every_window(on_line, ["row"], "service_id", revs, "rev_service", live), "platform service has an active revision", "path", swhere, "service_id"),
        _rows(misses, "platform service stops at the station", "path", swhere, "service_id"),
    ]
    # V9: inference basis
    b = p["basis"]
    target = plats.select(F.col("station_id").alias("ts"), F.col("platform_id").alias("tp"), F.col("label").alias("t_label"), F.col("last_updated").alias("t_updated"),
                          F.col("line_id").alias("t_line"), F.col("inference").isNotNull().alias("t_inferred"), F.col("service_ids").alias("t_services"))
    other = b.filter("basis_station_id <> station_id")
    known = other.join(stations.select(F.col("id").alias("basis_station_id")), "basis_station_id", "left_semi")
    met = known.join(target, (F.col("basis_station_id") == F.col("ts")) & (F.col("basis_platform_id") == F.col("tp")), "left")
    found = met.filter("tp is not null")
    bwhere = _at("layout.platforms", "pos", "bpos")
    supported = found.select("path", "pos", F.explode("t_services").alias("service_id"))
    inferred = p["platform_services"].join(plats.filter("inference is not null").select("path", "pos"), ["path", "pos"], "left_semi")
    out += [
        _rows(b.filter("basis_station_id = station_id"), "basis lies at another station", "path", bwhere, "basis_station_id"),
        _rows(Q.fk_check(other, "basis_station_id", stations, "id"), "basis station exists", "path", bwhere, "basis_station_id"),
        _rows(met.filter("tp is null"), "basis platform exists", "path", bwhere, "basis_platform_id"),
        _rows(found.filter("t_inferred"), "basis was observed directly", "path", bwhere, "basis_platform_id"),
        _rows(found.filter("t_line <> line_id"), "basis is on the same line", "path", bwhere, "basis_platform_id"),
        _rows(found.filter("t_label <> label"), "basis has the same label", "path", bwhere, "basis_platform_id"),
        _rows(found.filter("last_updated < t_updated"), "basis not reviewed later", "path", bwhere, "basis_platform_id"),
        _rows(inferred.join(supported, ["path", "pos", "service_id"], "left_anti"), "inference supports every service", "path", swhere, "service_id"),
    ]
    # V10 and timing references
    timed = p["timings"].withColumn("visit", F.concat_ws("|", "service_id", "station_id"))
    visits = stops.select(F.concat_ws("|", "service_id", "station_id").alias("visit")).distinct()
    twhere = _at("firstLastTrain.services", "pos")
    real = timed.join(services.select(F.col("id").alias("service_id")), "service_id", "left_semi")
    out += [
        _rows(Q.fk_check(timed, "service_id", services, "id"), "timed service exists", "path", twhere, "service_id"),
        _rows(Q.fk_check(real, "visit", visits, "visit"), "timed service stops at the station", "path", twhere, "service_id"),
    ]
    return out


def issue_rules(t: Mapping[str, DataFrame]) -> list[DataFrame]:
    """V2-V4, V6 for bundles."""
    evidence, impact, services = t["evidence"], t["impact"], t["service"]
    stations, lines = t["station"], t["line"]
    at = F.col("seq").cast("string")
    svc = impact.filter("entity.type = 'service'").withColumn("service_id", F.col("entity.service_id"))
    fac = impact.filter("entity.type = 'facility'").withColumns({"station_id": F.col("entity.station_id"), "line_id": F.col("entity.line_id")})
    scopes = impact.filter("type = 'service_scopes.set'").select("issue_id", "seq", F.posexplode("service_scopes").alias("spos", "s"))
    scope_ids = scopes.select("issue_id", "seq", F.explode(F.array_compact(F.array(
        F.when(F.col("s.type") == "service.segment", F.col("s.from_station_id")), F.when(F.col("s.type") == "service.segment", F.col("s.to_station_id")),
        F.when(F.col("s.type") == "service.point", F.col("s.station_id"))))).alias("station_id"))
    revs = services.select(F.col("id").alias("rev_service"), F.explode("revisions").alias("r")).select(
        "rev_service", date_instant("r.startAt").alias("r_start"), date_instant("r.endAt").alias("r_end"))
    periods = svc.filter("type = 'periods.set'").select("issue_id", "seq", "service_id", F.posexplode("periods").alias("pos", "p")).withColumn(
        "row", F.struct("issue_id", "seq", "pos"))
    homeless = Q.outside_every_window(periods, ["row"], "service_id", revs, "rev_service", valid_at("r_start", "r_end", F.col("p.start_at")), require_match=True)
    keyed = impact.withColumn("entity_key", entity_key("entity"))
    return [
        _rows(Q.unique_check(evidence, ["evidence_id"], ["issue_id", "line_no"]), "evidence id is unique", "issue_id", F.col("line_no").cast("string"), "evidence_id"),
        _rows(Q.unique_check(impact, ["event_id"], ["issue_id", "seq"]), "event id is unique", "issue_id", at, "event_id"),
        _rows(Q.setter_conflicts(keyed, ["issue_id", "type", "entity_key"], "ts", ["seq"]), "one setter per entity, type and time", "issue_id", at, "entity_key"),
        _rows(Q.fk_check(impact, ["issue_id", "evidence_id"], evidence, ["issue_id", "evidence_id"]), "event evidence exists in bundle", "issue_id", at, "evidence_id"),
        _rows(Q.fk_check(svc, "service_id", services, "id"), "event service exists", "issue_id", at, "service_id"),
        _rows(Q.fk_check(fac, "station_id", stations, "id"), "event station exists", "issue_id", at, "station_id"),
        _rows(Q.fk_check(fac, "line_id", lines, "id"), "event line exists", "issue_id", at, "line_id"),
        _rows(Q.fk_check(scope_ids, "station_id", stations, "id"), "scope station exists", "issue_id", at, "station_id"),
        _rows(homeless, "period starts in a service revision", "issue_id", at, "service_id"),
    ]


def rights_rules(t: Mapping[str, DataFrame]) -> list[DataFrame]:
    """V11."""
    unresolved = resolve_rules(t["evidence"], t["source_rule"]).filter("status <> 'resolved'")
    return [_rows(unresolved, "evidence source rights resolve", "issue_id", F.col("line_no").cast("string"), F.concat_ws(" ", "status", "source_url"))]


def map_rules(t: Mapping[str, DataFrame]) -> list[DataFrame]:
    """Drawn segments and station parts against the network of their month.

    segment(path, effective_month, line_id, from_id, to_id, operational), node(path,
    effective_month, station_id, line_id, operational), constraint(effective_month, id), use(path, effective_month,
    constraint_id), snapshot(effective_month, path, engine_id), manifest(effective_month, path).
    Edges are computed once per distinct (line, month) that is drawn.
    """
    seg, node = t["segment"], t["node"]
    stops = service_stops(t["service"])
    drawn = seg.select("line_id", "effective_month").distinct()
    live = stops.join(drawn, "line_id").filter(in_month(F.col("start_at").cast("timestamp_ntz"), F.col("end_at").cast("timestamp_ntz"), F.col("effective_month")))
    pairs = adjacent_pairs(live, ["service_id", "rev_pos", "effective_month"], "pos", "station_id").select(
        F.concat_ws("|", "line_id", "effective_month", pair_key("station_id", "next_station_id")).alias("edge"))
    keyed = seg.filter("operational").withColumn("edge", F.concat_ws("|", "line_id", "effective_month", pair_key("from_id", "to_id")))
    codes = station_codes(t["station"])
    pairs_known = codes.select(F.concat_ws("|", "station_id", "line_id").alias("k"))
    nodes = node.withColumn("k", F.concat_ws("|", "station_id", "line_id")).withColumn(
        "row", F.struct("path", "effective_month", "station_id", "line_id"))
    windows = codes.select(F.concat_ws("|", "station_id", "line_id").alias("ck"), F.col("start_at").cast("timestamp_ntz").alias("c_start"), F.col("end_at").cast("timestamp_ntz").alias("c_end"))
    stale = Q.outside_every_window(nodes.filter("operational"), ["row"], "k", windows, "ck", in_month("c_start", "c_end", F.col("effective_month")), require_match=True)
    uses = t["use"].withColumn("k", F.concat_ws("|", "effective_month", "constraint_id"))
    given = t["constraint"].select(F.concat_ws("|", "effective_month", "id").alias("k"))
    snap, man = t["snapshot"], t["manifest"]
    expected = F.concat_ws("/", "effective_month", F.concat("engine_id", F.lit(".json")))
    none = F.lit("")
    return [
        _rows(Q.fk_check(seg, "line_id", t["line"], "id"), "segment line exists", "path", none, "line_id"),
        *[_rows(Q.fk_check(seg, c, t["station"], "id"), "segment station exists", "path", none, c) for c in ("from_id", "to_id")],
        _rows(Q.fk_check(node, "station_id", t["station"], "id"), "node station exists", "path", none, "station_id"),
        _rows(Q.fk_check(keyed, "edge", pairs, "edge"), "operational segment is an active edge", "path", none, "edge"),
        _rows(Q.fk_check(nodes.join(t["station"].select(F.col("id").alias("station_id")), "station_id", "left_semi"), "k", pairs_known, "k"), "node line is a code line", "path", none, "k"),
        _rows(stale, "node line code is active", "path", none, "k"),
        _rows(Q.fk_check(uses, "k", given, "k"), "constraint exists", "path", none, "constraint_id"),
        _rows(Q.fk_check(snap, ["effective_month", "path"], man, ["effective_month", "path"]), "snapshot is in the manifest", "path", none, "effective_month"),
        _rows(Q.fk_check(man, ["effective_month", "path"], snap, ["effective_month", "path"]), "manifest entry has a snapshot", "path", none, "effective_month"),
        _rows(snap.filter(~F.endswith("path", expected)), "snapshot path matches month and engine", "path", none, "effective_month"),
    ]


SCOPES = {"rows": row_rules, "references": reference_rules, "issues": issue_rules, "rights": rights_rules, "maps": map_rules}


def validate(tables: Mapping[str, DataFrame], scopes: Sequence[str] = ("rows", "references", "issues", "rights")) -> DataFrame:
    """All breaches of the chosen scopes; only their rules are built."""
    return Q.union_errors([df for s in scopes for df in SCOPES[s](tables)])


def summary(tables: Mapping[str, DataFrame], errors: DataFrame) -> DataFrame:
    return Q.validation_summary(tables, errors)
