"""Temporal filters, intervals, recurrences."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.functions import temporal as T
from faultline.operators import asof, intervals
from faultline.operators.recurrence import expand_recurrence
from faultline.queries.registry import minutes, query, sgt, sgt_text, sql_text, text

# orders as validity intervals: end o_orderkey % 90 days later, open every 7th
_ORDERS_SQL = """o AS (SELECT *, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderdate + to_days(CAST(o_orderkey % 90 AS INTEGER)) END AS o_end
  FROM orders)"""
# events as intervals of `value` minutes, open every 97th
_EVENTS_SQL = """e AS (SELECT *, CASE WHEN event_id % 97 = 0 THEN NULL ELSE ts + to_minutes(CAST(floor(value) AS BIGINT)) END AS te FROM events)"""


def order_spans(t):
    end = F.col("o_orderdate") + F.make_dt_interval(days=(F.col("o_orderkey") % 90).cast("int"))
    return t.orders.withColumn("o_end", F.when(F.col("o_orderkey") % 7 != 0, end))


def event_spans(t):
    return t.events.withColumn("te", F.when(F.col("event_id") % 97 != 0, F.col("ts") + minutes(F.floor("value"))))


@query("active_at", f"""WITH {_ORDERS_SQL}
SELECT o_orderkey, o_orderstatus FROM o
WHERE o_orderdate <= TIMESTAMP '1998-06-01' AND (o_end IS NULL OR TIMESTAMP '1998-06-01' < o_end)""")
def active_at(t):
    at = F.to_timestamp_ntz(F.lit("1998-06-01 00:00:00"))
    return asof.active_at(order_spans(t), "o_orderdate", "o_end", at).select("o_orderkey", "o_orderstatus")


@query("active_in_month", f"""WITH {_ORDERS_SQL}
SELECT o_orderkey, o_orderstatus FROM o
WHERE o_orderdate < TIMESTAMP '1998-03-01' AND (o_end IS NULL OR TIMESTAMP '1998-02-01' < o_end)""")
def active_in_month(t):
    return asof.active_in_month(order_spans(t), "o_orderdate", "o_end", "1998-02").select("o_orderkey", "o_orderstatus")


@query("as_of_version", f"""
SELECT o_custkey, {sql_text('max(o_orderdate)')} AS effective, max_by(o_orderkey, (o_orderdate, o_orderkey)) AS version
FROM orders WHERE o_orderdate <= TIMESTAMP '1999-01-01' GROUP BY o_custkey""")
def as_of_version(t):
    rows = t.orders.filter(F.col("o_orderdate") <= F.to_timestamp_ntz(F.lit("1999-01-01 00:00:00")))
    rows = rows.withColumn("eff", F.struct("o_orderdate", "o_orderkey"))
    at = F.struct(F.to_timestamp_ntz(F.lit("1999-01-01 00:00:00")), F.lit((1 << 62)))
    out = asof.as_of_version(rows, ["o_custkey"], "eff", at, ["o_orderkey"])
    return out.select("o_custkey", text("eff.o_orderdate").alias("effective"), F.col("o_orderkey").alias("version"))


@query("as_of_join", """
WITH f AS (SELECT user_id, event_id, ts FROM events WHERE event_type <> 'signup'),
v AS (SELECT user_id, ts, event_id AS version FROM events WHERE event_type = 'signup')
SELECT f.user_id, f.event_id, (SELECT max_by(v.version, v.ts) FROM v WHERE v.user_id = f.user_id AND v.ts <= f.ts) AS version FROM f""")
def as_of_join(t):
    facts = t.events.filter("event_type <> 'signup'").select("user_id", "event_id", "ts")
    versions = t.events.filter("event_type = 'signup'").select("user_id", "ts", F.col("event_id").alias("version"))
    return asof.as_of_join(facts, versions, ["user_id"], "ts", "ts", ["version"], tie=["event_id"]).select("user_id", "event_id", "version")


@query("parse_effective", """
WITH s AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d')
  WHEN 2 THEN strftime(o_orderdate, '%Y') || '-02-30' ELSE strftime(o_orderdate, '%Y/%m') END AS given FROM orders)
SELECT o_orderkey, CASE WHEN regexp_full_match(given, '\\d{4}-(0[1-9]|1[0-2])') THEN given
  WHEN regexp_full_match(given, '\\d{4}-(0[1-9]|1[0-2])-\\d{2}') AND TRY_CAST(given AS DATE) IS NOT NULL THEN substr(given, 1, 7) END AS effective FROM s""")
def parse_effective(t):
    k = F.col("o_orderkey") % 4
    fmt = lambda f: F.date_format("o_orderdate", f)
    given = F.when(k == 0, fmt("yyyy-MM")).when(k == 1, fmt("yyyy-MM-dd")).when(k == 2, F.concat(fmt("yyyy"), F.lit("-02-30"))).otherwise(fmt("yyyy/MM"))
    return t.orders.select("o_orderkey", T.parse_effective(given).alias("effective"))


@query("parse_instant_strict", f"""
WITH s AS (SELECT event_id, ts, event_id % 4 AS k FROM events)
SELECT event_id, CASE k WHEN 0 THEN {sql_text("date_trunc('month', ts)")} WHEN 1 THEN {sql_text("date_trunc('day', ts)")}
  WHEN 2 THEN {sql_text("date_trunc('second', ts)")} END AS instant FROM s""")
def parse_instant_strict(t):
    k = F.col("event_id") % 4
    fmt = lambda f: F.date_format("ts", f)
    given = (F.when(k == 0, fmt("yyyy-MM")).when(k == 1, fmt("yyyy-MM-dd"))
             .when(k == 2, F.concat(fmt("yyyy-MM-dd'T'HH:mm:ss"), F.lit("+08:00"))).otherwise(fmt("yyyy-MM-dd'T'HH:mm:ss")))
    return t.events.select("event_id", sgt_text(T.parse_instant_strict(given)).alias("instant"))


@query("legacy_date", """
SELECT event_id, CASE WHEN event_id % 2 = 0 THEN strftime(ts, '%Y-%m-%d') ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS shown FROM events""")
def legacy_date(t):
    midnight = F.date_format("ts", "yyyy-MM-dd'T00:00:00.000Z'")
    other = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return t.events.select("event_id", T.legacy_date(F.when(F.col("event_id") % 2 == 0, midnight).otherwise(other)).alias("shown"))


@query("relative_day", f"""
SELECT o_orderkey, {sql_text("date_trunc('week', o_orderdate) + to_days(CAST(7 * (o_orderkey % 3 - 1) + o_orderkey % 7 AS INTEGER))")} AS day_start,
  {sql_text("date_trunc('week', o_orderdate) + to_days(CAST(7 * (o_orderkey % 3 - 1) + o_orderkey % 7 + 1 AS INTEGER))")} AS day_end FROM orders""")
def relative_day(t):
    weekday = F.element_at(F.array(*map(F.lit, T.WEEKDAYS)), (F.col("o_orderkey") % 7 + 1).cast("int"))
    rows = t.orders.withColumn("d", T.relative_day("o_orderdate", weekday, F.col("o_orderkey") % 3 - 1, "timestamp_ntz"))
    return rows.select("o_orderkey", text("d.start_at").alias("day_start"), text("d.end_at").alias("day_end"))


@query("service_day_times", """
SELECT event_id, CAST(event_id % 30 * 3600 + event_id % 60 * 60 + event_id % 59 AS BIGINT) AS seconds,
  lpad(CAST(event_id % 30 AS VARCHAR), 2, '0') || ':' || lpad(CAST(event_id % 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(event_id % 59 AS VARCHAR), 2, '0') AS shown
FROM events""")
def service_day_times(t):
    n = lambda m: (F.col("event_id") % m).cast("string")
    seconds = T.parse_hms(F.concat_ws(":", n(30), n(60), n(59)))
    return t.events.select("event_id", seconds.cast("long").alias("seconds")).withColumn("shown", T.format_hms("seconds"))


@query("merge_intervals", f"""WITH {_EVENTS_SQL},
r AS (SELECT user_id, ts, te, coalesce(te, TIMESTAMP '9999-01-01') AS x FROM e),
f AS (SELECT *, max(x) OVER (PARTITION BY user_id ORDER BY ts, x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM r),
g AS (SELECT *, sum(CASE WHEN reach >= ts THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, x) AS island FROM f)
SELECT user_id, {sql_text('min(ts)')} AS start_at, CASE WHEN bool_or(te IS NULL) THEN NULL ELSE {sql_text('max(te)')} END AS end_at, count(*) AS merged
FROM g GROUP BY user_id, island""")
def merge_intervals(t):
    merged = intervals.merge_intervals(event_spans(t), ["user_id"], "ts", "te")
    return merged.select("user_id", text("ts").alias("start_at"), text("te").alias("end_at"), "merged")


# event intervals of `value` hours
_LONG_SQL = "h AS (SELECT event_id, user_id, ts, ts + to_hours(CAST(floor(value) AS BIGINT)) AS te FROM events)"
_SPLIT_SQL = f"""{_LONG_SQL},
d AS (SELECT *, unnest(generate_series(date_trunc('day', ts), date_trunc('day', te), INTERVAL 1 DAY)) AS d FROM h),
s AS (SELECT event_id, user_id, greatest(ts, d + INTERVAL '5 hours 30 minutes') AS lo, least(te, d + INTERVAL 1 DAY) AS hi FROM d)"""


def long_spans(t):
    end = F.col("ts") + F.make_dt_interval(hours=F.floor("value").cast("int"))
    return t.events.select("event_id", "user_id", "ts", end.alias("te"))


@query("split_service_hours", f"WITH {_SPLIT_SQL} SELECT event_id, {sql_text('lo')} AS start_at, {sql_text('hi')} AS end_at FROM s WHERE lo < hi")
def split_service_hours(t):
    parts = intervals.split_service_hours(long_spans(t), "ts", "te")
    return parts.select("event_id", text("ts").alias("start_at"), text("te").alias("end_at"))


@query("service_duration", f"""WITH {_SPLIT_SQL}
SELECT user_id, CAST(sum(greatest(epoch_us(hi) - epoch_us(lo), 0)) AS BIGINT) AS duration_us FROM s GROUP BY user_id""")
def service_duration(t):
    return intervals.service_duration(long_spans(t), ["user_id"], "ts", "te")


@query("day_starts", f"""WITH {_LONG_SQL},
d AS (SELECT *, unnest(generate_series(date_trunc('day', ts), date_trunc('day', te), INTERVAL 1 DAY)) AS d FROM h)
SELECT event_id, {sql_text('d')} AS day_start FROM d WHERE d >= ts AND d < te""")
def day_starts(t):
    return intervals.day_starts(long_spans(t), "ts", "te").select("event_id", text("day_start").alias("day_start"))


@query("total_duration", f"WITH {_LONG_SQL} SELECT user_id, CAST(sum(epoch_us(te) - epoch_us(ts)) AS BIGINT) AS duration_us FROM h GROUP BY user_id")
def total_duration(t):
    return intervals.total_duration(long_spans(t), ["user_id"], "ts", "te")


@query("expand_recurrence", f"""
WITH p AS (SELECT o_orderkey, o_orderkey % 4 AS f, o_custkey % 3 = 0 AS by_day, o_custkey % 2 = 0 AS overnight,
    o_orderdate + to_hours(CAST(o_orderkey % 24 AS BIGINT)) AS s,
    o_orderdate + to_hours(CAST(o_orderkey % 24 AS BIGINT)) + to_days(CASE WHEN o_orderkey % 4 < 2 THEN 40 ELSE 800 END) AS e FROM orders),
d AS (SELECT *, unnest(generate_series(date_trunc('day', s), date_trunc('day', e), INTERVAL 1 DAY)) AS day FROM p),
o AS (SELECT o_orderkey, day + CASE WHEN overnight THEN INTERVAL 22 HOUR ELSE INTERVAL '5 hours 30 minutes' END AS b,
    day + CASE WHEN overnight THEN INTERVAL 26 HOUR ELSE INTERVAL 9 HOUR END AS x FROM d
  WHERE (CASE WHEN by_day THEN isodow(day) IN (1, 3) WHEN f = 0 THEN true WHEN f = 1 THEN isodow(day) = isodow(s)
      WHEN f = 2 THEN day(day) = day(s) ELSE day(day) = day(s) AND month(day) = month(s) END)
    AND day <> date_trunc('day', s) + INTERVAL 7 DAY
    AND day + CASE WHEN overnight THEN INTERVAL 22 HOUR ELSE INTERVAL '5 hours 30 minutes' END BETWEEN s AND e)
SELECT o_orderkey, count(*) AS n, {sql_text('min(b)')} AS first_start, {sql_text('max(x)')} AS last_end,
  CAST(sum(epoch(b)) AS BIGINT) AS start_sum FROM o GROUP BY o_orderkey""")
def recurrence(t):
    """Orders as recurring periods of all four frequencies; counts and bounds of the occurrences."""
    f, overnight = F.col("o_orderkey") % 4, F.col("o_custkey") % 2 == 0
    start = F.col("o_orderdate") + F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int"))
    rows = t.orders.select(
        "o_orderkey", start.alias("start_at"), (start + F.make_dt_interval(days=F.when(f < 2, 40).otherwise(800))).alias("end_at"),
        F.when(f == 0, "daily").when(f == 1, "weekly").when(f == 2, "monthly").otherwise("yearly").alias("frequency"),
        F.when(F.col("o_custkey") % 3 == 0, F.array(F.lit("MO"), F.lit("WE"))).alias("days_of_week"),
        F.when(overnight, "22:00").otherwise("05:30").alias("window_start"), F.when(overnight, "02:00:00").otherwise("09:00:00").alias("window_end"),
        F.array(F.date_add(F.to_date(start), 7)).alias("excluded_dates"))
    found = expand_recurrence(rows, time_zone=None)
    return found.groupBy("o_orderkey").agg(
        F.count(F.lit(1)).alias("n"), text(F.min("occurrence_start")).alias("first_start"), text(F.max("occurrence_end")).alias("last_end"),
        F.sum(F.floor(T.micros("occurrence_start") / 1_000_000)).cast("long").alias("start_sum"))


@query("resolve_periods", f"""WITH {_EVENTS_SQL},
c AS (SELECT user_id, max(ts) FILTER (event_type = 'error') AS seen, max(ts) FILTER (event_type = 'purchase') AS crowd FROM events GROUP BY user_id),
j AS (SELECT e.event_id, e.ts, CASE WHEN e.event_id % 5 = 0 THEN NULL ELSE e.te END AS te, c.seen, c.crowd, e.user_id FROM e JOIN c USING (user_id)),
k AS (SELECT *, CASE WHEN user_id % 3 = 0 THEN crowd + INTERVAL 30 MINUTE WHEN user_id % 3 = 1 THEN seen + INTERVAL 120 MINUTE END AS cand FROM j),
i AS (SELECT *, least(greatest(date_trunc('day', cand) + INTERVAL 1 DAY, ts), ts + INTERVAL 1080 MINUTE) AS inf FROM k)
SELECT event_id, CASE WHEN te IS NOT NULL THEN {sql_text('te')} WHEN cand IS NOT NULL AND inf <= TIMESTAMP '2024-01-29' THEN {sql_text('inf')} END AS end_resolved,
  CASE WHEN te IS NOT NULL THEN 'fact' WHEN cand IS NOT NULL AND inf <= TIMESTAMP '2024-01-29' THEN 'inferred' ELSE 'none' END AS end_source,
  CASE WHEN te IS NULL AND cand IS NOT NULL AND inf <= TIMESTAMP '2024-01-29' THEN CASE WHEN user_id % 3 = 0 THEN 'crowd_decay' ELSE 'evidence_timeout' END END AS end_reason
FROM i""")
def resolve_periods(t):
    e = event_spans(t).withColumn("te", F.when(F.col("event_id") % 5 != 0, F.col("te")))
    last = lambda kind: F.max(F.when(F.col("event_type") == kind, F.col("ts")))
    seen = t.events.groupBy("user_id").agg(last("error").alias("seen"), last("purchase").alias("crowd"))
    seen = seen.withColumn("crowd", F.when(F.col("user_id") % 3 == 0, F.col("crowd"))).withColumn("seen", F.when(F.col("user_id") % 3 == 1, F.col("seen")))
    out = intervals.resolve_periods(
        e.join(seen, "user_id"), "ts", "te", F.to_timestamp_ntz(F.lit("2024-01-29 00:00:00")), last_evidence="seen", crowd_last_active="crowd")
    return out.select("event_id", text("end_resolved").alias("end_resolved"), "end_source", "end_reason")


@query("to_local_text", f"SELECT event_id, {sql_text('ts')} AS shown FROM events")
def to_local_text(t):
    """Instants rendered in the network's zone give back the wall time they came from."""
    return t.events.select("event_id", sgt_text(sgt("ts")).alias("shown"))
