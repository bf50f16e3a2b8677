"""Small fixtures in the native shapes."""

from __future__ import annotations

import datetime as dt

from faultline import schemas as S

SGT = dt.timezone(dt.timedelta(hours=8))


def ts(text):
    """'2024-01-01 08:00' as the instant of that wall time in the network's zone."""
    return None if text is None else dt.datetime.fromisoformat(text).replace(tzinfo=SGT)


def local(value):
    return None if value is None else value.replace(tzinfo=dt.timezone.utc).astimezone(SGT).strftime("%Y-%m-%d %H:%M")


def svc(name):
    return ("service", name, None, None, None)


def fac(station, kind, line=None):
    return ("facility", None, station, line, kind)


def fixed(start, end=None):
    return ("fixed", ts(start), ts(end), None, None, None, None, None, None)


def recurring(start, end, frequency="daily", days=None, window=("22:00:00", "23:00:00"), excluded=None):
    return ("recurring", ts(start), ts(end), frequency, days, *window, "Asia/Singapore", excluded)


def start_only(start):
    return ("start-only", ts(start), None, None, None, None, None, None, None)


def end_only(end):
    return ("end-only", None, ts(end), None, None, None, None, None, None)


def claim(evidence, at, entity, seq=0, service=None, facility=None, scopes=None, signal=None, hint=None, causes=None, issue="i1"):
    effect = (service, (facility,) if facility else None)
    return (issue, evidence, ts(at), seq, entity, effect, scopes, signal, hint, causes)


def event(seq, kind, entity, at, evidence, periods=None, scopes=None, effect=None, causes=None, issue="i1", event_id=None):
    return (issue, seq, event_id or f"{issue}-e{seq}", kind, entity, ts(at), evidence, periods, scopes, effect, causes)


def claims(spark, rows, order=None):
    df = spark.createDataFrame(rows, S.claims_schema())
    if order is None:
        return df
    places = spark.createDataFrame(list(order.items()), "evidence_id string, ev_seq long")
    return df.join(places, "evidence_id")


def impact(spark, rows):
    return spark.createDataFrame(rows, S.impact_schema())
