"""Declared schemas of the native tables and the value lists their rules use."""

from __future__ import annotations

from pyspark.sql import types as T

# Enumerations of the data model.
ISSUE_TYPES = ["disruption", "maintenance", "infra"]
EVIDENCE_TYPES = ["statement.official", "report.public", "report.media"]
EVENT_TYPES = [
    "periods.set", "service_scopes.set", "service_effects.set",
    "facility_effects.set", "causes.set",
]
FACILITY_KINDS = ["lift", "escalator", "screen-door"]
SERVICE_EFFECTS = ["delay", "no-service", "reduced-service", "service-hours-adjustment"]
FACILITY_EFFECTS = ["out-of-service", "degraded"]
SCOPE_TYPES = ["service.whole", "service.segment", "service.point"]
STATUS_SIGNALS = ["open", "cleared", "planned"]
FREQUENCIES = ["daily", "weekly", "monthly", "yearly"]
WEEKDAYS = ["MO", "TU", "WE", "TH", "FR", "SA", "SU"]
TIME_ZONES = ["Asia/Singapore", "Asia/Hong_Kong"]
CAUSES = [
    "signal.fault", "track.fault", "train.fault", "power.fault", "station.fault",
    "security", "weather", "passenger.incident", "platform_door.fault", "delay",
    "track.work", "system.upgrade", "elevator.outage", "escalator.outage",
    "air_conditioning.issue", "station.renovation",
]
LINE_TYPES = ["mrt.high", "mrt.medium", "lrt"]
STRUCTURE_TYPES = ["elevated", "underground", "at_grade", "in_building"]
BOARDING_STATUSES = ["alighting_only", "not_in_service"]
CROWD_EFFECTS = ["delay", "no-service", "crowding", "skipped-stop", "unknown"]
ARTICLE_TEXT_SOURCES = ["publisher", "archive", "metadata"]
ENTITY_COLLECTIONS = ["station", "line", "service", "operator", "town", "landmark"]
# End of fixed values.


def _s(ddl: str) -> T.StructType:
    return T._parse_datatype_string(ddl)  # DDL keeps wide schemas readable


TRANSLATIONS = "struct<`en-SG`:string,`zh-Hans`:string,ms:string,ta:string>"
ENTITY = "struct<type:string,service_id:string,station_id:string,line_id:string,kind:string>"
SCOPE = "struct<type:string,from_station_id:string,to_station_id:string,station_id:string>"
EFFECT = "struct<kind:string,duration:string>"
PERIOD = (
    "struct<kind:string,start_at:timestamp,end_at:timestamp,frequency:string,"
    "days_of_week:array<string>,window_start:string,window_end:string,"
    "time_zone:string,excluded_dates:array<date>>"
)
HINT = PERIOD  # the hint adds the kinds start-only and end-only, not fields
CLAIM_EFFECT = f"struct<service:{EFFECT},facility:struct<kind:string>>"

CLAIM_COLUMNS = (
    f"issue_id string, evidence_id string, evidence_ts timestamp, seq long, entity {ENTITY}, "
    f"effect {CLAIM_EFFECT}, scopes array<{SCOPE}>, status_signal string, "
    f"time_hints {HINT}, causes array<string>"
)
IMPACT_COLUMNS = (
    f"issue_id string, seq long, event_id string, type string, entity {ENTITY}, ts timestamp, "
    f"evidence_id string, periods array<{PERIOD}>, service_scopes array<{SCOPE}>, "
    f"effect {EFFECT}, causes array<string>"
)
EVIDENCE_COLUMNS = (
    "issue_id string, line_no long, evidence_id string, ts string, type string, text string, "
    f"source_url string, render struct<text:{TRANSLATIONS},source:string>"
)

# --- shapes as they lie in the JSON files -----------------------------------

_HOURS = "struct<weekdays:struct<start:string,end:string>,weekends:struct<start:string,end:string>>"
_HEADWAY = "struct<minSeconds:int,maxSeconds:int,representativeSeconds:int>"
_PROFILE = (
    "struct<source:struct<url:string,description:string,retrievedAt:string>,"
    f"defaultHeadway:{_HEADWAY},periods:array<struct<id:string,dayType:string,start:string,"
    f"end:string,headway:{_HEADWAY}>>>"
)
_TIMES = "map<string,struct<firstTrain:string,lastTrain:string>>"
_GEO = "struct<latitude:double,longitude:double>"

ENTITY_JSON = {
    "station": (
        f"id string, name {TRANSLATIONS}, geo {_GEO}, stationCodes array<struct<lineId:string,"
        "code:string,startedAt:date,endedAt:date,structureType:string>>, landmarkIds array<string>, "
        "townId string, address struct<streetAddress:string,postalCode:string,"
        "addressLocality:string,addressCountry:string>, aliases array<string>, "
        f"firstLastTrain struct<services:array<struct<serviceId:string,times:{_TIMES},"
        f"specialTimes:{_TIMES}>>>, layout struct<exitSourceId:string,exits:array<struct<"
        "sourceObjectId:long,sourceChecksum:string,label:string,lastUpdated:date,"
        f"geo:{_GEO}>>,platforms:array<struct<id:string,label:string,lastUpdated:date,"
        "lineId:string,serviceIds:array<string>,boardingStatus:string,inference:struct<"
        "method:string,basis:array<struct<stationId:string,platformId:string>>>>>>"
    ),
    "line": (
        f"id string, name {TRANSLATIONS}, type string, color string, startedAt date, "
        "platformDoorCount int, trainCarCounts array<int>, serviceIds array<string>, "
        "operators array<struct<operatorId:string,startedAt:date,endedAt:date>>, "
        f"operatingHours {_HOURS}"
    ),
    "service": (
        f"id string, name {TRANSLATIONS}, lineId string, revisions array<struct<id:string,"
        "startAt:date,endAt:date,path:struct<stations:array<struct<stationId:string,"
        f"displayCode:string>>>,operatingHours:{_HOURS},estimatedFrequency:{_PROFILE}>>"
    ),
    "operator": f"id string, name {TRANSLATIONS}, foundedAt date, url string",
    "town": f"id string, name {TRANSLATIONS}",
    "landmark": f"id string, name {TRANSLATIONS}",
}
ISSUE_JSON = f"id string, type string, title {TRANSLATIONS}, titleMeta struct<source:string>"

_PERIOD_JSON = (
    "struct<kind:string,startAt:string,endAt:string,frequency:string,daysOfWeek:array<string>,"
    "timeWindow:struct<startAt:string,endAt:string>,timeZone:string,excludedDates:array<date>>"
)
_ENTITY_JSON = "struct<type:string,serviceId:string,stationId:string,lineId:string,kind:string>"
_SCOPE_JSON = "struct<type:string,fromStationId:string,toStationId:string,stationId:string>"
EVIDENCE_JSON = (
    "id string, ts string, type string, text string, sourceUrl string, "
    f"render struct<text:{TRANSLATIONS},source:string>"
)
IMPACT_JSON = (
    f"id string, type string, ts string, entity {_ENTITY_JSON}, "
    f"basis struct<evidenceId:string>, periods array<{_PERIOD_JSON}>, "
    f"serviceScopes array<{_SCOPE_JSON}>, effect {EFFECT}, causes array<string>"
)
INGEST_CONTENT = (
    "struct<source:string,accountName:string,text:string,url:string,createdAt:string,"
    "subreddit:string,title:string,selftext:string,thumbnailUrl:string,summary:string,"
    "articleText:string,articleTextSource:string,articleTextFetchedAt:string,reportId:string,"
    "observedAt:string,lineIds:array<string>,stationIds:array<string>,directionText:string,"
    "effect:string,delayMinutes:int,reportCount:int>"
)
CROWD_KEYS = [
    "source", "reportId", "text", "createdAt", "observedAt", "lineIds", "stationIds",
    "directionText", "effect", "delayMinutes", "reportCount", "url",
]


def claims_schema() -> T.StructType:
    return _s(CLAIM_COLUMNS)


def impact_schema() -> T.StructType:
    return _s(IMPACT_COLUMNS)


def evidence_schema() -> T.StructType:
    return _s(EVIDENCE_COLUMNS)


def entity_schema(collection: str) -> T.StructType:
    return _s(ENTITY_JSON[collection])
