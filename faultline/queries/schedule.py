"""Schedules: customers as stops, hours from their keys, one fixed headway profile."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.operators import schedule as S
from faultline.queries.registry import query

# id, day type, start, end, min, max, representative seconds
_PERIODS = [
    ("am", "weekdays", "06:30", "09:00", 120, 180, 150), ("pm", "weekdays", "17:00", "20:00:00", 150, 240, 180),
    ("late", "weekdays", "23:30", "00:30", 540, 720, 600), ("mid", "weekends", "10:00", "22:00", 240, 360, 300),
]
_DEFAULT = (420, 600, 480)
# timings a stop has, by key modulo 4
_GIVEN = {0: ["daily"], 1: ["weekday", "weekday_saturday"], 2: ["weekday_saturday", "sunday_public_holiday"], 3: ["weekday", "saturday", "sunday_public_holiday"]}
_ASKED = ["04:00", "08:10", "17:30:15", "23:59", "24:05:00", "12:00:30", "23:30"]


def stops(t):
    hw = lambda a, b, c: F.struct(F.lit(a).alias("min"), F.lit(b).alias("max"), F.lit(c).alias("representative"))
    periods = F.array(*[F.struct(F.lit(i).alias("id"), F.lit(d).alias("day_type"), F.lit(s).alias("start"), F.lit(e).alias("end"), hw(a, b, c).alias("headway"))
                        for i, d, s, e, a, b, c in _PERIODS])
    return t.customer.select(F.col("c_custkey").alias("station_id"), F.col("c_nationkey").alias("service_id"), hw(*_DEFAULT).alias("default_headway"), periods.alias("profile_periods"))


def timing(t):
    k = F.col("c_custkey")
    pad = lambda c: F.lpad(c.cast("string"), 2, "0")
    given = F.lit(None)
    for m, names in _GIVEN.items():
        given = F.when(k % 4 == m, F.array(*map(F.lit, names))).otherwise(given)
    last = F.concat(F.when(k % 5 == 0, "00").otherwise("23"), F.lit(":"), pad(k % 60))
    return t.customer.select(
        k.alias("station_id"), F.col("c_nationkey").alias("service_id"), F.explode(given).alias("calendar"),
        F.concat(F.lit("05:"), pad(k % 60)).alias("first_train"), F.when(k % 23 != 0, last).alias("last_train"))


def windows(t):
    return S.frequency_windows(S.resolve_timing(stops(t), timing(t)))


def _sec(text):
    return sum(int(x) * m for x, m in zip(text.split(":"), (3600, 60, 1)))


def _source_sql():
    # calendar -> first of its fallbacks that the stop has
    cases = []
    for cal, order in S.CALENDARS.items():
        for m, names in _GIVEN.items():
            found = next((o for o in order if o in names), None)
            cases.append(f"({m}, '{cal}', " + (f"'{found}'" if found else "NULL") + ")")
    return "m(k, calendar, source_calendar) AS (VALUES " + ", ".join(cases) + ")"


_PERIOD_ROWS = ", ".join(
    f"('{i}', '{d}', {_sec(s)}, {_sec(e) + (86400 if _sec(e) <= _sec(s) else 0)}, {a}, {b}, {c})" for i, d, s, e, a, b, c in _PERIODS)
_WINDOW_SQL = f"""{_source_sql()},
c AS (SELECT c_custkey AS station_id, calendar, source_calendar, 18000 + c_custkey % 60 * 60 AS s,
  CASE WHEN c_custkey % 23 = 0 OR source_calendar IS NULL THEN NULL WHEN c_custkey % 5 = 0 THEN 86400 + c_custkey % 60 * 60 ELSE 82800 + c_custkey % 60 * 60 END AS e
  FROM customer JOIN m ON m.k = c_custkey % 4),
a AS (SELECT * FROM c WHERE e IS NOT NULL),
p(id, day_type, ps, pe, mn, mx, hw) AS (VALUES {_PERIOD_ROWS}),
o(d) AS (VALUES (-86400), (0), (86400)),
k AS (SELECT station_id, calendar, id, mn, mx, hw, greatest(s, ps + d) AS s, least(e, pe + d) AS e FROM a JOIN p
  ON day_type = CASE WHEN calendar = 'weekday' THEN 'weekdays' ELSE 'weekends' END CROSS JOIN o WHERE greatest(s, ps + d) < least(e, pe + d)),
b AS (SELECT station_id, calendar, s AS x FROM a UNION SELECT station_id, calendar, e FROM a UNION SELECT station_id, calendar, s FROM k UNION SELECT station_id, calendar, e FROM k),
n AS (SELECT *, lead(x) OVER (PARTITION BY station_id, calendar ORDER BY x) AS y FROM b),
w AS (SELECT n.station_id, n.calendar, x AS start_s, y AS end_s, k.id AS source_period_id, coalesce(k.hw, {_DEFAULT[2]}) AS headway_s,
  coalesce(k.mn, {_DEFAULT[0]}) AS min_s, coalesce(k.mx, {_DEFAULT[1]}) AS max_s
  FROM n LEFT JOIN k ON k.station_id = n.station_id AND k.calendar = n.calendar AND k.s <= x AND k.e >= y WHERE y IS NOT NULL)"""


@query("resolve_timing", f"WITH {_source_sql()} SELECT c_custkey AS station_id, calendar, source_calendar FROM customer JOIN m ON m.k = c_custkey % 4")
def resolve_timing(t):
    return S.resolve_timing(stops(t), timing(t)).select("station_id", "calendar", "source_calendar")


@query("frequency_windows", f"WITH {_WINDOW_SQL} SELECT * FROM w")
def frequency_windows(t):
    return windows(t).select("station_id", "calendar", F.inline("windows"))


_OFF = "CASE WHEN ({i}) = n THEN len ELSE CAST(floor(len * ({i}) / CAST(n AS DOUBLE) / 30 + 0.5) AS BIGINT) * 30 END"
_FITS = "list_bool_and(list_transform(range(0, n), lambda i: (" + _OFF.format(i="i + 1") + ") - (" + _OFF.format(i="i") + ") BETWEEN min_s AND max_s))"
_CHOICE_SQL = f"""g AS (SELECT *, end_s - start_s AS len, max(end_s) OVER (PARTITION BY station_id, calendar) AS last_s, min(start_s) OVER (PARTITION BY station_id, calendar) AS first_s FROM w),
h AS (SELECT *, greatest(1, CAST(floor(len / CAST(headway_s AS DOUBLE) + 0.5) AS BIGINT)) AS ideal,
  list_filter(range(greatest(1, CAST(ceil(len / CAST(max_s AS DOUBLE)) AS BIGINT)), CAST(floor(len / CAST(min_s AS DOUBLE)) AS BIGINT) + 1), lambda n: {_FITS}) AS fit FROM g),
z AS (SELECT *, list_sort(list_transform(fit, lambda x: (abs(x - ideal), x)))[1][2] AS n FROM h)"""


@query("departures", f"""WITH {_WINDOW_SQL}, {_CHOICE_SQL},
i AS (SELECT *, unnest(range(0, n + CASE WHEN end_s = last_s THEN 1 ELSE 0 END)) AS i FROM z WHERE n IS NOT NULL),
d AS (SELECT *, start_s + {_OFF.format(i='i')} AS seconds FROM i)
SELECT station_id, calendar, count(*) AS departures, CAST(sum(seconds) AS BIGINT) AS seconds_sum, count(*) FILTER (seconds = last_s) AS last_trains,
  count(*) FILTER (seconds = first_s AND seconds <> last_s) AS first_trains FROM d GROUP BY 1, 2""")
def departures(t):
    """Every window that can be met has its departures; the others are the rows of `impossible_windows`."""
    out, _ = S.departures(windows(t), ["station_id", "calendar"], refuse=False)
    is_ = lambda b: F.count_if(F.col("basis") == b)
    return out.groupBy("station_id", "calendar").agg(
        F.count(F.lit(1)).alias("departures"), F.sum("seconds").alias("seconds_sum"), is_("last_train").alias("last_trains"), is_("first_train").alias("first_trains"))


@query("impossible_windows", f"WITH {_WINDOW_SQL}, {_CHOICE_SQL} SELECT station_id, calendar, start_s, end_s FROM z WHERE n IS NULL")
def impossible_windows(t):
    return S.departures(windows(t), ["station_id", "calendar"])[1]


_IN = "list_filter(ws, lambda w: w.start_s <= {t} AND {t} < w.end_s)[1].headway_s"


@query("next_arrivals", f"""WITH {_WINDOW_SQL},
l AS (SELECT station_id, calendar, list(w ORDER BY start_s) AS ws, min(start_s) AS s, max(end_s) AS e FROM w GROUP BY 1, 2),
q AS (SELECT *, (ARRAY[{', '.join(str(_sec(x)) for x in _ASKED)}])[station_id % {len(_ASKED)} + 1] AS q FROM l),
a1 AS (SELECT *, CASE WHEN q < s THEN s WHEN q = e THEN e WHEN q < e THEN least(e, q + CAST(floor({_IN.format(t='q')} / 2.0 + 0.5) AS BIGINT)) END AS t1 FROM q),
a2 AS (SELECT *, CASE WHEN t1 < e THEN least(e, t1 + {_IN.format(t='t1')}) END AS t2 FROM a1),
c3 AS (SELECT *, CASE WHEN t2 < e THEN least(e, t2 + {_IN.format(t='t2')}) END AS t3 FROM a2),
u AS (SELECT station_id, calendar, q, s, e, 1 AS position, t1 AS seconds FROM c3 UNION ALL SELECT station_id, calendar, q, s, e, 2, t2 FROM c3 UNION ALL SELECT station_id, calendar, q, s, e, 3, t3 FROM c3)
SELECT station_id, calendar, q AS queried_s, position, seconds, CASE WHEN position = 1 AND q < s THEN 'first_train' WHEN seconds = e THEN 'last_train' ELSE 'frequency_estimate' END AS basis
FROM u WHERE seconds IS NOT NULL""")
def next_arrivals(t):
    asked = F.element_at(F.array(*map(F.lit, _ASKED)), (F.col("station_id") % len(_ASKED) + 1).cast("int"))
    out = S.next_arrivals(windows(t).withColumn("asked", asked), "asked", ["station_id", "calendar"])
    return out.select("station_id", "calendar", "queried_s", "position", "seconds", "basis")
