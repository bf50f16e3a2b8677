import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from faultline.operators import intervals as I
from faultline.operators.recurrence import expand_recurrence, flatten_periods
from faultline.schemas import PERIOD
from tests.helpers import fixed, local, recurring, ts


def frame(spark, rows):
    return spark.createDataFrame([(k, ts(a), ts(b)) for k, a, b in rows], "k string, s timestamp, e timestamp")


def spans(df):
    return sorted((r.k, local(r.s), local(r.e)) for r in df.collect())


def test_merge_touching_open_and_disjoint(spark):
    df = frame(spark, [("a", "2024-01-01 08:00", "2024-01-01 09:00"), ("a", "2024-01-01 09:00", "2024-01-01 10:00"),
                       ("a", "2024-01-01 12:00", None), ("a", "2024-01-02 12:00", "2024-01-02 13:00"), ("b", "2024-01-01 08:00", "2024-01-01 09:00")])
    assert spans(I.merge_intervals(df, ["k"], "s", "e")) == [
        ("a", "2024-01-01 08:00", "2024-01-01 10:00"), ("a", "2024-01-01 12:00", None), ("b", "2024-01-01 08:00", "2024-01-01 09:00")]


def brute_merge(rows):
    out = []
    for s, e in sorted(rows, key=lambda r: (r[0], 10**9 if r[1] is None else r[1])):
        if out and (out[-1][1] is None or out[-1][1] >= s):
            out[-1][1] = None if None in (out[-1][1], e) else max(out[-1][1], e)
        else:
            out.append([s, e])
    return sorted(map(tuple, out), key=str)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 500), st.one_of(st.none(), st.integers(0, 30))), min_size=30, max_size=120))
def test_merge_equals_brute_force_even_when_hot(spark, raw):
    base = dt.datetime(2024, 1, 1)
    rows = [(s, None if d is None else s + d) for s, d in raw if d is not None or s > 450]
    df = spark.createDataFrame([("k", base + dt.timedelta(minutes=s), None if e is None else base + dt.timedelta(minutes=e)) for s, e in rows] or [("k", base, base)],
                               "k string, s timestamp_ntz, e timestamp_ntz")
    want = brute_merge(rows or [(0, 0)])
    minute = lambda t: None if t is None else int((t - base).total_seconds() // 60)
    for hot in (10, None):
        got = sorted(((minute(r.s), minute(r.e)) for r in I.merge_intervals(df, ["k"], "s", "e", hot).collect()), key=str)
        assert got == want


def test_recurring_periods_pass_through(spark):
    df = spark.createDataFrame([("a", fixed("2024-01-01 08:00", "2024-01-01 09:00")), ("a", fixed("2024-01-01 08:30", None)),
                                ("a", recurring("2024-01-01 08:00", "2024-02-01 00:00"))], f"k string, period {PERIOD}")
    got = I.merge_periods(df, ["k"]).select("period.kind", "period.start_at", "period.end_at").collect()
    assert sorted((r.kind, local(r.end_at)) for r in got) == [("fixed", None), ("recurring", "2024-02-01 00:00")]


@pytest.mark.parametrize("start,end,want", [
    ("2024-01-01 06:00", "2024-01-01 07:00", [("2024-01-01 06:00", "2024-01-01 07:00")]),
    ("2024-01-01 04:00", "2024-01-01 07:00", [("2024-01-01 05:30", "2024-01-01 07:00")]),
    ("2024-01-01 23:00", "2024-01-02 06:00", [("2024-01-01 23:00", "2024-01-02 00:00"), ("2024-01-02 05:30", "2024-01-02 06:00")]),
    ("2024-01-01 01:00", "2024-01-01 05:00", []),
    ("2024-01-01 00:00", "2024-01-03 00:00", [("2024-01-01 05:30", "2024-01-02 00:00"), ("2024-01-02 05:30", "2024-01-03 00:00")]),
])
def test_service_hours(spark, start, end, want):
    df = frame(spark, [("a", start, end)])
    parts = I.split_service_hours(df, "s", "e")
    assert [(a, b) for _, a, b in spans(parts)] == want
    total = I.total_duration(parts, ["k"], "s", "e").collect()
    direct = I.service_duration(df, ["k"], "s", "e").first().duration_us
    assert (total[0].duration_us if total else 0) == direct


def test_day_starts_include_own_midnight_only(spark):
    df = frame(spark, [("a", "2024-01-01 00:00", "2024-01-03 00:00"), ("b", "2024-01-01 10:00", "2024-01-03 10:00")])
    got = sorted((r.k, local(r.day_start)) for r in I.day_starts(df, "s", "e").collect())
    assert got == [("a", "2024-01-01 00:00"), ("a", "2024-01-02 00:00"), ("b", "2024-01-02 00:00"), ("b", "2024-01-03 00:00")]


def resolve(spark, start, end, as_of, seen=None, exited=None, last=None, active=None, mode="operational", **kw):
    df = spark.createDataFrame([(ts(start), ts(end), ts(seen), ts(exited), ts(last), active)],
                               "s timestamp, e timestamp, seen timestamp, exited timestamp, last timestamp, active boolean")
    r = I.resolve_periods(df, "s", "e", F.lit(ts(as_of)), mode, "seen", "exited", "last", "active", **kw).first()
    return local(r.end_resolved), r.end_source, r.end_reason


def test_resolve_periods(spark):
    day = "2024-01-01 "
    assert resolve(spark, day + "08:00", day + "09:00", "2024-01-05 00:00") == (day + "09:00", "fact", None)
    assert resolve(spark, day + "08:00", None, "2024-01-05 00:00") == (None, "none", None)
    assert resolve(spark, day + "08:00", None, "2024-01-05 00:00", seen=day + "10:00") == ("2024-01-02 00:00", "inferred", "evidence_timeout")
    assert resolve(spark, day + "08:00", None, "2024-01-05 00:00", seen=day + "10:00", mode="canonical") == (None, "none", None)
    # crowd exit comes before evidence, decay needs inactivity, activity leaves the evidence rule
    assert resolve(spark, day + "08:00", None, "2024-01-05 00:00", seen="2024-01-03 10:00", exited=day + "11:00")[2] == "crowd_decay"
    assert resolve(spark, day + "08:00", None, "2024-01-05 00:00", seen=day + "10:00", last=day + "11:00", active=False)[2] == "crowd_decay"
    assert resolve(spark, day + "08:00", None, "2024-01-05 00:00", seen=day + "10:00", last=day + "11:00", active=True)[2] == "evidence_timeout"
    # 23:00 + 120 min falls on the next day, the cap of 18 hours comes first
    assert resolve(spark, day + "05:00", None, "2024-01-05 00:00", seen=day + "23:00") == (day + "23:00", "inferred", "evidence_timeout")
    # an end after as_of stays open; an end before the start is lifted to it
    assert resolve(spark, day + "08:00", None, day + "20:00", seen=day + "10:00") == (None, "none", None)
    assert resolve(spark, "2024-01-04 08:00", None, "2024-01-05 00:00", seen=day + "10:00")[0] == "2024-01-04 08:00"


def occurrences(spark, period, **kw):
    df = spark.createDataFrame([(period,)], f"p {PERIOD}").select("p.*")
    return [(local(r.occurrence_start), local(r.occurrence_end)) for r in expand_recurrence(df, **kw).orderBy("occurrence_start").collect()]


def test_recurrence(spark):
    night = ("22:00:00", "02:00:00")
    assert occurrences(spark, recurring("2024-01-01 00:00", "2024-01-03 22:00", window=night)) == [
        (f"2024-01-0{d} 22:00", f"2024-01-0{d + 1} 02:00") for d in (1, 2, 3)]  # until is inclusive
    assert [a[:10] for a, _ in occurrences(spark, recurring("2024-01-01 00:00", "2024-01-14 23:59", "weekly", ["SA", "SU"]))] == [
        "2024-01-06", "2024-01-07", "2024-01-13", "2024-01-14"]
    assert [a[:10] for a, _ in occurrences(spark, recurring("2024-01-03 00:00", "2024-01-20 00:00", "weekly"))] == ["2024-01-03", "2024-01-10", "2024-01-17"]
    assert [a[:10] for a, _ in occurrences(spark, recurring("2024-01-31 00:00", "2024-06-01 00:00", "monthly"))] == ["2024-01-31", "2024-03-31", "2024-05-31"]
    assert [a[:10] for a, _ in occurrences(spark, recurring("2024-02-29 00:00", "2029-01-01 00:00", "yearly"))] == ["2024-02-29", "2028-02-29"]
    skipped = recurring("2024-01-01 00:00", "2024-01-03 23:59", excluded=[dt.date(2024, 1, 2)])
    assert [a[:10] for a, _ in occurrences(spark, skipped)] == ["2024-01-01", "2024-01-03"]
    assert len(occurrences(spark, skipped, exclude_match="instant")) == 3
    assert occurrences(spark, recurring("2024-01-01 23:00", "2024-01-02 21:00")) == []  # outside on both days


def test_recurrence_equals_daily_scan(spark):
    rng = random.Random(5)
    rows = []
    for i in range(40):
        start = dt.datetime(2023, 12, 1) + dt.timedelta(days=rng.randrange(60), hours=rng.randrange(24))
        days = rng.choice([None, ["MO"], ["FR", "MO", "FR"], ["SU", "WE"]])
        rows.append((i, start, start + dt.timedelta(days=rng.randrange(500)), rng.choice(["daily", "weekly", "monthly", "yearly"]), days, "05:30", "09:00"))
    df = spark.createDataFrame(rows, "id int, start_at timestamp_ntz, end_at timestamp_ntz, frequency string, days_of_week array<string>, window_start string, window_end string")
    want = set()
    names = ["MO", "TU", "WE", "TH", "FR", "SA", "SU"]
    for i, s, e, f, days, *_ in rows:
        day = s.date()
        while day <= e.date():
            at = dt.datetime.combine(day, dt.time(5, 30))
            rule = {"daily": True, "weekly": day.weekday() == s.weekday(), "monthly": day.day == s.day, "yearly": (day.day, day.month) == (s.day, s.month)}[f]
            if (names[day.weekday()] in days if days else rule) and s <= at <= e:
                want.add((i, at))
            day += dt.timedelta(days=1)
    out = expand_recurrence(df, time_zone=None, excluded=None)
    assert {(r.id, r.occurrence_start) for r in out.collect()} == want
    clip = (F.lit(dt.datetime(2024, 3, 1)).cast("timestamp_ntz"), F.lit(dt.datetime(2024, 3, 20)).cast("timestamp_ntz"))
    clipped = {(r.id, r.occurrence_start) for r in expand_recurrence(df, time_zone=None, excluded=None, clip=clip).collect()}
    inside = {x for x in want if dt.datetime(2024, 3, 1) <= x[1] <= dt.datetime(2024, 3, 20)}
    assert inside <= clipped <= want


def test_flatten_periods(spark):
    df = spark.createDataFrame([("a", fixed("2024-01-01 08:00", None)), ("b", recurring("2024-01-01 00:00", "2024-01-02 23:59"))], f"k string, period {PERIOD}")
    got = sorted((r.k, local(r.start_at), r.recurring) for r in flatten_periods(df).collect())
    assert got == [("a", "2024-01-01 08:00", False), ("b", "2024-01-01 22:00", True), ("b", "2024-01-02 22:00", True)]
