"""Claims, impact and replay over the event and order tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.functions.text import entity_key
from faultline.lineage import cut_lineage
from faultline.operators import claims as C
from faultline.operators import diff
from faultline.operators import replay as R
from faultline.operators.impact import compute_impact, number_events, reconcile_periods
from faultline.operators.state import bundle_state
from faultline.queries.registry import minutes, query, sgt, sgt_text, sql_text
from faultline.schemas import CLAIM_EFFECT, ENTITY, PERIOD, SCOPE


def _null(kind):
    return F.lit(None).cast(kind)


def service(service_id):
    return F.struct(F.lit("service").alias("type"), service_id.alias("service_id"), _null("string").alias("station_id"),
                    _null("string").alias("line_id"), _null("string").alias("kind")).cast(ENTITY)


def hint(kind, start, end, **more):
    given = {"frequency": _null("string"), "days_of_week": _null("array<string>"), "window_start": _null("string"), "window_end": _null("string"),
             "time_zone": _null("string"), "excluded_dates": _null("array<date>"), **more}
    return F.struct(kind.alias("kind"), start.alias("start_at"), end.alias("end_at"), *[c.alias(n) for n, c in given.items()]).cast(PERIOD)


def scope(kind, station=None):
    return F.struct(F.lit(kind).alias("type"), _null("string").alias("from_station_id"), _null("string").alias("to_station_id"),
                    (station if station is not None else _null("string")).alias("station_id")).cast(SCOPE)


def event_claims(t):
    """One claim per event: issue = user, evidence = event, service = event type."""
    i = F.col("event_id")
    start, end = sgt("ts"), sgt(F.col("ts") + minutes(F.floor("value")))
    recurring = hint(F.lit("recurring"), start, sgt(F.col("ts") + F.expr("interval 20 days")), frequency=F.lit("daily"), window_start=F.lit("22:00:00"),
                     window_end=F.lit("23:30:00"), time_zone=F.lit("Asia/Singapore"))
    hints = (F.when(i % 50 == 49, recurring).when(i % 4 == 0, hint(F.lit("fixed"), start, F.when(i % 8 == 0, end)))
             .when(i % 4 == 1, hint(F.lit("start-only"), start, _null("timestamp"))).when(i % 4 == 2, hint(F.lit("end-only"), _null("timestamp"), end)))
    effect = F.struct(F.when(i % 5 < 2, F.struct(F.when(i % 5 == 0, "delay").otherwise("no-service").alias("kind"), F.when(i % 10 == 0, "PT10M").alias("duration"))).alias("service"),
                      _null("struct<kind:string>").alias("facility")).cast(CLAIM_EFFECT)
    scopes = F.when(i % 4 == 0, F.array(scope("service.whole"))).when(i % 4 == 1, F.array(scope("service.point", F.concat(F.lit("st"), i % 3))))
    causes = F.when(i % 6 == 0, F.array(F.lit("signal.fault"))).when(i % 6 == 1, F.array(F.lit("power.fault")))
    return t.events.select(
        F.concat(F.lit("u"), "user_id").alias("issue_id"), F.concat(F.lit("e"), i).alias("evidence_id"), start.alias("evidence_ts"), F.lit(0).cast("long").alias("seq"),
        service(F.col("event_type")).alias("entity"), effect.alias("effect"), scopes.alias("scopes"), _null("string").alias("status_signal"),
        hints.alias("time_hints"), causes.alias("causes"), i.alias("ev_seq"))


def event_issues(t):
    k = F.col("user_id") % 3
    return t.events.select("user_id").distinct().select(
        F.concat(F.lit("u"), "user_id").alias("issue_id"), F.when(k == 0, "disruption").when(k == 1, "maintenance").otherwise("infra").alias("type"))


_IMPACT_SQL = """WITH c AS (SELECT 'u' || user_id AS issue_id, 'service:' || event_type AS entity_key, event_id AS i, user_id % 3 = 0 AS disruption,
  event_id % 50 = 49 OR event_id % 4 < 3 AS hinted, event_id % 50 = 49 OR event_id % 4 < 2 AS opening FROM events),
g AS (SELECT *, hinted OR i > min(i) FILTER (opening) OVER (PARTITION BY issue_id, entity_key) AS can FROM c),
a AS (
  SELECT issue_id, entity_key, i, 'service_effects.set' AS type, CASE WHEN i % 5 = 0 THEN 'delay' ELSE 'no-service' END || coalesce(CASE WHEN i % 10 = 0 THEN 'PT10M' END, '') AS value
  FROM g WHERE coalesce(can, false) AND i % 5 < 2
  UNION ALL SELECT issue_id, entity_key, i, 'service_scopes.set', CASE WHEN i % 4 = 0 THEN 'service.whole' ELSE 'service.point' || 'st' || (i % 3) END FROM g WHERE coalesce(can, false) AND i % 4 < 2
  UNION ALL SELECT issue_id, entity_key, i, 'causes.set', CASE WHEN i % 6 = 0 THEN 'signal.fault' ELSE 'power.fault' END FROM g WHERE (coalesce(can, false) OR NOT disruption) AND i % 6 < 2),
l AS (SELECT *, lag(value) OVER (PARTITION BY issue_id, entity_key, type ORDER BY i) AS before FROM a)
SELECT issue_id, entity_key, 'e' || i AS evidence_id, type, value FROM l WHERE before IS NULL OR before <> value"""


def impact_value():
    first = F.col("service_scopes")[0]
    return (F.when(F.col("type") == "causes.set", F.col("causes")[0])
            .when(F.col("type") == "service_scopes.set", F.concat(first["type"], F.coalesce(first["station_id"], F.lit(""))))
            .otherwise(F.concat("effect.kind", F.coalesce("effect.duration", F.lit("")))))


@query("impact_attributes", _IMPACT_SQL)
def impact_attributes(t):
    """Effect, scope and cause events; periods, a fold, are in compute_impact."""
    events = compute_impact(event_claims(t), event_issues(t)).filter("type <> 'periods.set'")
    return events.select("issue_id", "entity_key", "evidence_id", "type", impact_value().alias("value"))


# One step of the recursion is one hint: `p` holds the periods of an entity after its first `n` hints.
_PERIODS_CTE = """h AS (
  SELECT user_id, event_type, event_id AS i, CASE WHEN event_id % 50 = 49 THEN 'recurring' WHEN event_id % 4 = 0 THEN 'fixed' WHEN event_id % 4 = 1 THEN 'start-only' ELSE 'end-only' END AS kind,
    ts AS s, CASE WHEN event_id % 50 = 49 THEN ts + INTERVAL 20 DAY WHEN event_id % 8 = 4 THEN NULL ELSE ts + to_minutes(CAST(floor(value) AS BIGINT)) END AS e,
    row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS n
  FROM events WHERE event_id % 50 = 49 OR event_id % 4 < 3),
f AS (
  SELECT user_id, event_type, CAST(0 AS BIGINT) AS n, CAST(NULL AS BIGINT) AS i, false AS moved,
    CAST([] AS STRUCT(kind VARCHAR, s TIMESTAMP, e TIMESTAMP, ws VARCHAR, we VARCHAR)[]) AS p FROM h WHERE n = 1
  UNION ALL
  SELECT user_id, event_type, n, i, q IS DISTINCT FROM p, q FROM (
    SELECT h.user_id, h.event_type, h.n, h.i, f.p, CASE h.kind
      WHEN 'recurring' THEN [{'kind': 'recurring', 's': h.s, 'e': h.e, 'ws': '22:00:00', 'we': '23:30:00'}]
      WHEN 'start-only' THEN CASE WHEN len(f.p) = 0 THEN [{'kind': 'fixed', 's': h.s, 'e': CAST(NULL AS TIMESTAMP), 'ws': CAST(NULL AS VARCHAR), 'we': CAST(NULL AS VARCHAR)}]
        ELSE list_transform(f.p, lambda x: {'kind': x.kind, 's': CASE WHEN x.kind = 'fixed' THEN least(x.s, h.s) ELSE h.s END, 'e': x.e,
          'ws': CASE WHEN x.kind = 'recurring' AND x.s <> h.s THEN strftime(h.s, '%H:%M:%S') ELSE x.ws END, 'we': x.we}) END
      WHEN 'end-only' THEN list_transform(f.p, lambda x: {'kind': x.kind, 's': x.s, 'e': CASE WHEN x.kind = 'fixed' THEN coalesce(x.e, h.e) ELSE h.e END, 'ws': x.ws,
          'we': CASE WHEN x.kind = 'recurring' THEN strftime(h.e, '%H:%M:%S') END})
      ELSE list_reduce(
        list_transform(list_sort(list_transform(list_append(list_filter(f.p, lambda x: x.kind = 'fixed'), {'kind': 'fixed', 's': h.s, 'e': h.e, 'ws': CAST(NULL AS VARCHAR), 'we': CAST(NULL AS VARCHAR)}),
          lambda x, k: {'s': x.s, 'k': k, 'x': x})), lambda y: [y.x]),
        lambda done, y: CASE WHEN done[-1].e IS NULL OR done[-1].e >= y[1].s THEN list_append(done[:-2], {'kind': 'fixed', 's': done[-1].s,
            'e': CASE WHEN done[-1].e IS NOT NULL AND y[1].e IS NOT NULL THEN greatest(done[-1].e, y[1].e) END, 'ws': CAST(NULL AS VARCHAR), 'we': CAST(NULL AS VARCHAR)})
          ELSE list_concat(done, y) END) || list_filter(f.p, lambda x: x.kind = 'recurring') END AS q
    FROM f JOIN h ON h.user_id = f.user_id AND h.event_type = f.event_type AND h.n = f.n + 1))"""


@query("compute_impact", f"""WITH RECURSIVE {_PERIODS_CTE},
z AS ({_IMPACT_SQL}),
v AS (SELECT issue_id, entity_key, evidence_id, type, value FROM z
  UNION ALL SELECT 'u' || user_id, 'service:' || event_type, 'e' || i, 'periods.set', list_aggregate(list_transform(p, lambda x:
    concat_ws(' ', x.kind, {sql_text('x.s')}, coalesce({sql_text('x.e')}, 'open'), x.ws, x.we)), 'string_agg', ', ') FROM f WHERE moved)
SELECT *, CASE type WHEN 'service_effects.set' THEN 0 WHEN 'periods.set' THEN 1 WHEN 'service_scopes.set' THEN 2 ELSE 3 END AS attr_pos,
  'ie_' || upper(substr(sha256(concat_ws('|', issue_id, evidence_id, entity_key, type)), 1, 26)) AS event_id FROM v""")
def impact(t):
    """All events with their values; a list of periods as one text."""
    events = compute_impact(event_claims(t), event_issues(t))
    listed = F.array_join(F.transform("periods", lambda p: F.concat_ws(
        " ", p["kind"], sgt_text(p["start_at"]), F.coalesce(sgt_text(p["end_at"]), F.lit("open")), p["window_start"], p["window_end"])), ", ")
    return events.select("issue_id", "entity_key", "evidence_id", "type", F.when(F.col("type") == "periods.set", listed).otherwise(impact_value()).alias("value"), "attr_pos", "event_id")


@query("reconcile_periods", f"""WITH RECURSIVE {_PERIODS_CTE},
x AS (SELECT user_id, event_type, i, unnest(p) AS x, generate_subscripts(p, 1) - 1 AS place FROM f WHERE moved)
SELECT 'u' || user_id AS issue_id, 'service:' || event_type AS entity_key, i AS ev_seq, place, x.kind AS kind, {sql_text('x.s')} AS start_at, {sql_text('x.e')} AS end_at,
  CASE WHEN x.kind = 'recurring' THEN 'daily' END AS frequency, x.ws AS window_start, x.we AS window_end, CASE WHEN x.kind = 'recurring' THEN 'Asia/Singapore' END AS time_zone FROM x""")
def periods(t):
    """Every period after every evidence that changed them, one row each."""
    rows = reconcile_periods(event_claims(t)).select("issue_id", "entity_key", "ev_seq", F.posexplode("periods").alias("place", "p"))
    return rows.select("issue_id", "entity_key", "ev_seq", F.col("place").cast("long").alias("place"), "p.kind", sgt_text("p.start_at").alias("start_at"),
                       sgt_text("p.end_at").alias("end_at"), "p.frequency", "p.window_start", "p.window_end", "p.time_zone")


@query("reconcile_fixed", f"""
WITH h AS (SELECT user_id, event_id, ts, CASE WHEN event_id % 97 <> 0 THEN ts + to_minutes(CAST(floor(value) AS BIGINT)) END AS te FROM events),
r AS (SELECT *, coalesce(te, TIMESTAMP '9999-01-01') AS x FROM h),
f AS (SELECT *, max(x) OVER (PARTITION BY user_id ORDER BY ts, x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM r),
g AS (SELECT *, sum(CASE WHEN reach >= ts THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, x) AS island FROM f)
SELECT user_id, {sql_text('min(ts)')} AS start_at, CASE WHEN bool_or(te IS NULL) THEN NULL ELSE {sql_text('max(te)')} END AS end_at FROM g GROUP BY user_id, island""")
def reconcile_fixed(t):
    """With fixed hints in time order the last state is the union of all hints."""
    end = F.when(F.col("event_id") % 97 != 0, sgt(F.col("ts") + minutes(F.floor("value"))))
    rows = event_claims(t).select("issue_id", "evidence_id", "seq", "entity", "ev_seq").join(
        t.events.select(F.col("event_id").alias("ev_seq"), "user_id", sgt("ts").alias("evidence_ts"), hint(F.lit("fixed"), sgt("ts"), end).alias("time_hints")), "ev_seq")
    one = rows.withColumn("entity", service(F.lit("all"))).drop("user_id")
    last = reconcile_periods(one).groupBy("issue_id").agg(F.max_by("periods", "ev_seq").alias("p"))
    return last.select(F.substring("issue_id", 2, 20).cast("long").alias("user_id"), F.inline("p")).select(
        "user_id", sgt_text("start_at").alias("start_at"), sgt_text("end_at").alias("end_at"))


def event_log(t):
    """An event log derived from the table: what compute_impact emits, numbered per issue."""
    return number_events(cut_lineage(compute_impact(event_claims(t), event_issues(t)))).drop("entity_key", "ev_seq", "pos", "attr_pos")


def event_evidence(t):
    return t.events.select(F.concat(F.lit("u"), "user_id").alias("issue_id"), F.concat(F.lit("e"), "event_id").alias("evidence_id"),
                           F.col("event_id").alias("line_no"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+08:00'").alias("ts"), F.lit("").alias("text"))


@query("replay")
def replay(t):
    """Replay the derived log from its evidence and compare per issue."""
    log = cut_lineage(event_log(t))
    again = R.replay(event_issues(t), event_evidence(t), log)
    return diff.replay_summary(log, again)


_LOG_SQL = """WITH l AS (SELECT user_id, event_id, ts, value, event_id % 4 AS k, ts + to_minutes(CAST(floor(value) - 20 AS BIGINT)) AS te,
  ts + to_minutes(CAST(event_id % 11 - 5 AS BIGINT)) AS s FROM events)"""


def violating_log(t):
    """Events as period setters whose bounds stray before and after the event."""
    start, end = F.col("ts") + minutes(F.col("event_id") % 11 - 5), F.col("ts") + minutes(F.floor("value") - 20)
    k = F.col("event_id") % 4
    period = hint(F.when(k == 3, "recurring").otherwise("fixed"), sgt(start), F.when(k != 1, sgt(end)))
    return t.events.select(
        F.concat(F.lit("u"), "user_id").alias("issue_id"), F.concat(F.lit("e"), F.floor(F.col("event_id") / 2)).alias("evidence_id"), F.col("event_id").alias("seq"),
        F.when(F.col("event_id") % 3 == 0, "service_effects.set").otherwise("periods.set").alias("type"), service(F.col("event_type")).alias("entity"), sgt("ts").alias("ts"),
        F.array(period).alias("periods"), F.struct(F.when(F.col("event_id") % 6 == 0, "no-service").otherwise("delay").alias("kind")).alias("effect"))


@query("period_violations", _LOG_SQL + """
SELECT 'u' || user_id AS issue_id, event_id AS seq FROM l WHERE event_id % 3 <> 0 AND CASE WHEN k = 1 THEN s > ts ELSE te <= s END""")
def period_violations(t):
    return R.period_violations(violating_log(t)).select("issue_id", "seq")


@query("select_targets", _LOG_SQL + """
SELECT DISTINCT 'u' || user_id AS issue_id, 'e' || (event_id // 2) AS evidence_id FROM l WHERE event_id % 3 <> 0 AND CASE WHEN k = 1 THEN s > ts ELSE te <= s END""")
def select_targets(t):
    log = violating_log(t)
    evidence = log.select("issue_id", "evidence_id", F.lit("").alias("text"), F.lit("").alias("ts")).distinct()
    return R.select_targets(evidence, log, "period-violations")


@query("future_no_service", """WITH l AS (SELECT user_id, event_id // 3 AS ev, event_id % 3 AS k, event_id, ts, value FROM events),
e AS (SELECT user_id, ev, min(ts) AS t0 FROM l GROUP BY 1, 2),
f AS (SELECT user_id, ev, bool_or(k = 0) AS a, bool_or(k = 1 AND event_id % 2 = 0 AND ts > t0) AS b FROM l JOIN e USING (user_id, ev) GROUP BY 1, 2)
SELECT 'u' || user_id AS issue_id, 'e' || ev AS evidence_id FROM f WHERE a AND b""")
def future_no_service(t):
    i = F.col("event_id")
    rows = t.events.select(
        F.concat(F.lit("u"), "user_id").alias("issue_id"), F.concat(F.lit("e"), F.floor(i / 3)).alias("evidence_id"), service(F.lit("s")).alias("entity"), "ts",
        F.when(i % 3 == 0, "service_effects.set").when(i % 3 == 1, "periods.set").otherwise("causes.set").alias("type"), F.struct(F.lit("no-service").alias("kind")).alias("effect"),
        F.array(hint(F.lit("fixed"), sgt("ts"), F.when(i % 2 == 0, sgt(F.col("ts") + F.expr("interval 1 hour"))))).alias("periods"))
    evidence = rows.groupBy("issue_id", "evidence_id").agg(F.date_format(F.min("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+08:00'").alias("ts"))
    return R.future_no_service(rows, evidence)


# --- claims over line items: one order's items are claims in line order ---------------


_PLACE = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag", "l_linestatus"]


@query("merge_claims", f"""
SELECT l_orderkey, arg_max(l_returnflag, ({', '.join(_PLACE)})) FILTER (l_quantity > 10) AS effect,
  arg_max(l_linestatus, ({', '.join(_PLACE)})) FILTER (l_discount > 0.02) AS scope FROM lineitem GROUP BY l_orderkey""")
def merge_claims(t):
    rows = t.lineitem.select("l_orderkey", F.struct(*_PLACE).alias("seq"),
                             F.when(F.col("l_quantity") > 10, F.col("l_returnflag")).alias("effect"), F.when(F.col("l_discount") > 0.02, F.col("l_linestatus")).alias("scope"))
    return C.merge_claims(rows, ["l_orderkey"], "seq", ["effect", "scope"])


_SVC_SQL = """s AS (SELECT p_partkey, p_partkey // 8 AS line, TIMESTAMP '1996-01-01' AS a, CASE WHEN p_partkey % 3 = 0 THEN TIMESTAMP '2000-01-01' END AS z FROM part),
c AS (SELECT l_suppkey, l_partkey, l_returnflag, l_shipdate, TIMESTAMP '1999-06-01' + to_days(CAST(l_suppkey % 400 AS INTEGER)) AS t0 FROM lineitem)"""


def part_services(t):
    """Parts as services, eight to a line, every third one retired in 2000."""
    at = lambda s: sgt(F.to_timestamp_ntz(F.lit(s)))
    return t.part.select(
        F.concat(F.lit("p"), "p_partkey").alias("service_id"), F.concat(F.lit("L"), F.floor(F.col("p_partkey") / 8)).alias("line_id"),
        F.array(F.struct(at("1996-01-01 00:00:00").alias("start_at"), F.when(F.col("p_partkey") % 3 == 0, at("2000-01-01 00:00:00")).alias("end_at"))).alias("revisions"))


def supplier_claims(t):
    """A supplier's items as the claims of one evidence, the return flag as the effect."""
    at = sgt(F.to_timestamp_ntz(F.lit("1999-06-01 00:00:00")) + F.make_dt_interval(days=(F.col("l_suppkey") % 400).cast("int")))
    return t.lineitem.select(
        F.lit("all").alias("issue_id"), F.concat(F.lit("s"), "l_suppkey").alias("evidence_id"), at.alias("evidence_ts"),
        F.struct(F.lit(C.GIVEN).alias("origin"), F.col("l_orderkey").alias("seq"), F.col("l_linenumber").cast("long").alias("place")).alias("seq"),
        service(F.concat(F.lit("p"), "l_partkey")).alias("entity"),
        F.struct(F.struct(F.col("l_returnflag").alias("kind"), _null("string").alias("duration")).alias("service"), _null("struct<kind:string>").alias("facility")).cast(CLAIM_EFFECT).alias("effect"),
        _null(f"array<{SCOPE}>").alias("scopes"), _null("string").alias("status_signal"), _null(PERIOD).alias("time_hints"), _null("array<string>").alias("causes"))


@query("filter_inactive", f"""WITH {_SVC_SQL}
SELECT l_suppkey AS supplier, count(*) AS kept FROM c JOIN s ON p_partkey = l_partkey WHERE a <= t0 AND (z IS NULL OR t0 < z) GROUP BY 1""")
def filter_inactive(t):
    kept = C.filter_inactive(supplier_claims(t), part_services(t))
    return kept.groupBy(F.substring("evidence_id", 2, 20).cast("long").alias("supplier")).agg(F.count(F.lit(1)).alias("kept"))


@query("complete_siblings", f"""WITH {_SVC_SQL},
x AS (SELECT l_suppkey, line, l_partkey, l_returnflag, t0 FROM c JOIN s ON p_partkey = l_partkey WHERE a <= t0 AND (z IS NULL OR t0 < z)),
g AS (SELECT l_suppkey, line, any_value(t0) AS t0, min(l_returnflag) AS flag FROM x GROUP BY 1, 2 HAVING count(DISTINCT l_partkey) >= 2 AND count(DISTINCT l_returnflag) = 1)
SELECT g.l_suppkey AS supplier, s.p_partkey AS part, flag FROM g JOIN s ON s.line = g.line AND s.a <= g.t0 AND (s.z IS NULL OR g.t0 < s.z)
WHERE NOT EXISTS (SELECT 1 FROM x WHERE x.l_suppkey = g.l_suppkey AND x.l_partkey = s.p_partkey)""")
def complete_siblings(t):
    out = C.complete_siblings(supplier_claims(t), part_services(t)).filter(F.col("seq.origin") == C.COPIED)
    return out.select(F.substring("evidence_id", 2, 20).cast("long").alias("supplier"), F.substring("entity.service_id", 2, 20).cast("long").alias("part"),
                      F.col("effect.service.kind").alias("flag"))


@query("normalize_claims", f"""WITH {_SVC_SQL},
x AS (SELECT l_suppkey, line, l_partkey, l_returnflag, t0 FROM c JOIN s ON p_partkey = l_partkey WHERE a <= t0 AND (z IS NULL OR t0 < z)),
g AS (SELECT l_suppkey, line, any_value(t0) AS t0, min(l_returnflag) AS flag FROM x GROUP BY 1, 2 HAVING count(DISTINCT l_partkey) >= 2 AND count(DISTINCT l_returnflag) = 1),
n AS (SELECT DISTINCT l_suppkey, l_partkey, l_returnflag FROM x UNION SELECT g.l_suppkey, s.p_partkey, flag FROM g JOIN s ON s.line = g.line AND s.a <= g.t0 AND (s.z IS NULL OR g.t0 < s.z))
SELECT l_suppkey AS supplier, count(*) AS claims, count(*) AS anchored FROM n GROUP BY 1""")
def normalize_claims(t):
    """The whole normalisation: inactive services out, siblings in, anchors set, repeats out."""
    out = C.normalize_for_evidence(supplier_claims(t), part_services(t))
    return out.groupBy(F.substring("evidence_id", 2, 20).cast("long").alias("supplier")).agg(
        F.count(F.lit(1)).alias("claims"), F.count_if(F.col("time_hints.kind") == "start-only").alias("anchored"))


@query("clamp_hints", f"""SELECT event_id, {sql_text("CASE WHEN event_id % 97 = 0 AND event_id % 2 = 0 THEN ts ELSE ts + INTERVAL 1 HOUR END")} AS start_at FROM events""")
def clamp_hints(t):
    end = F.when(F.col("event_id") % 97 != 0, sgt(F.col("ts") + F.expr("interval 2 hours")))
    kind = F.when((F.col("event_id") % 97 == 0) & (F.col("event_id") % 2 == 1), "start-only").otherwise("fixed")
    rows = t.events.select("event_id", sgt("ts").alias("evidence_ts"), hint(kind, sgt(F.col("ts") + F.expr("interval 1 hour")), end).alias("time_hints"))
    return C.clamp_hints(rows).select("event_id", sgt_text("time_hints.start_at").alias("start_at"))


@query("issue_date", f"""
WITH h AS (SELECT user_id, min(event_id) FILTER (event_id % 4 < 3 OR event_id % 50 = 49) AS f, min(ts) AS c FROM events GROUP BY 1)
SELECT 'u' || h.user_id AS issue_id, {sql_text("CASE WHEN f % 4 = 0 OR f % 50 = 49 THEN e.ts ELSE c END")} AS issue_at FROM h LEFT JOIN events e ON e.event_id = f""")
def issue_date(t):
    rows = event_claims(t).withColumn("seq", F.col("ev_seq")).withColumn("evidence_id", F.lit("all")).withColumn("created_at", F.col("evidence_ts"))
    return C.issue_date(rows).select("issue_id", sgt_text("issue_at").alias("issue_at"))


@query("reconstruct_claims", """
WITH l AS (SELECT user_id, event_id // 3 AS ev, event_type, event_id, event_id % 3 AS k, value FROM events)
SELECT 'u' || user_id AS issue_id, 'e' || ev AS evidence_id, 'service:' || event_type AS entity_key, count(*) FILTER (k = 0) > 0 AS has_effect,
  CASE WHEN count(*) FILTER (k = 1) = 0 THEN NULL WHEN arg_min(event_id, event_id) FILTER (k = 1) % 2 = 0 THEN 'fixed' ELSE 'recurring' END AS hint,
  arg_min('c' || event_id, event_id) FILTER (k = 2) AS cause FROM l GROUP BY user_id, ev, event_type""".replace(
    "count(*) FILTER (k = 0) > 0 AS has_effect", "CAST(count(*) FILTER (k = 0) > 0 AS INTEGER) AS has_effect"))
def reconstruct_claims(t):
    i = F.col("event_id")
    rows = t.events.select(
        F.concat(F.lit("u"), "user_id").alias("issue_id"), F.concat(F.lit("e"), F.floor(i / 3)).alias("evidence_id"), i.alias("seq"), service(F.col("event_type")).alias("entity"),
        F.when(i % 3 == 0, "service_effects.set").when(i % 3 == 1, "periods.set").otherwise("causes.set").alias("type"),
        F.struct(F.lit("delay").alias("kind"), _null("string").alias("duration")).alias("effect"), _null(f"array<{SCOPE}>").alias("service_scopes"),
        F.array(hint(F.when(i % 2 == 0, "fixed").otherwise("recurring"), sgt("ts"), _null("timestamp"))).alias("periods"), F.array(F.concat(F.lit("c"), i)).alias("causes"))
    state = bundle_state(rows.withColumn("event_id", F.lit("")).filter("type = 'none'"))
    out = R.reconstruct_claims(rows, state)
    return out.select("issue_id", "evidence_id", entity_key("entity").alias("entity_key"), F.col("effect.service.kind").isNotNull().cast("int").alias("has_effect"),
                      F.col("time_hints.kind").alias("hint"), F.col("causes")[0].alias("cause"))


# --- first sight of each user's service is the start of a period that is still open for even users ----


def _opened(t):
    return t.events.groupBy("user_id", "event_type").agg(F.min("ts").alias("t0"))


def open_state(t):
    key = F.concat(F.lit("service:"), "event_type").alias("entity_key")
    return _opened(t).filter("user_id % 2 = 0").select(F.concat(F.lit("u"), "user_id").alias("issue_id"), key, F.array(hint(F.lit("fixed"), sgt("t0"), _null("timestamp"))).alias("periods"))


@query("reconstruct_updates", f"""
WITH f AS (SELECT *, min(ts) OVER (PARTITION BY user_id, event_type) AS t0 FROM events),
p AS (SELECT user_id, event_id, t0, 0 AS place, t0 AS s, CASE WHEN event_id % 3 <> 0 THEN ts + INTERVAL 1 HOUR END AS e FROM f
  UNION ALL SELECT user_id, event_id, t0, 1, ts, ts + INTERVAL 1 HOUR FROM f WHERE event_id % 2 = 0)
SELECT 'u' || user_id AS issue_id, 'e' || event_id AS evidence_id, place, CASE WHEN user_id % 2 <> 0 OR s <> t0 THEN 'fixed' WHEN e IS NULL THEN 'start-only' ELSE 'end-only' END AS hint,
  CASE WHEN user_id % 2 = 0 AND s = t0 AND e IS NOT NULL THEN NULL ELSE {sql_text('s')} END AS start_at, {sql_text('e')} AS end_at FROM p""")
def reconstruct_updates(t):
    """Claims behind events that move, close or leave alone the period open before them."""
    i, hour = F.col("event_id"), sgt(F.col("ts") + F.expr("interval 1 hour"))
    first = hint(F.lit("fixed"), sgt("t0"), F.when(i % 3 != 0, hour))
    rows = t.events.join(_opened(t), ["user_id", "event_type"]).select(
        F.concat(F.lit("u"), "user_id").alias("issue_id"), F.concat(F.lit("e"), i).alias("evidence_id"), i.alias("seq"), service(F.col("event_type")).alias("entity"),
        F.lit("periods.set").alias("type"), F.struct(_null("string").alias("kind"), _null("string").alias("duration")).alias("effect"),
        _null(f"array<{SCOPE}>").alias("service_scopes"), _null("array<string>").alias("causes"),
        F.when(i % 2 == 0, F.array(first, hint(F.lit("fixed"), sgt("ts"), hour))).otherwise(F.array(first)).alias("periods"))
    out = R.reconstruct_claims(rows, open_state(t))
    return out.select("issue_id", "evidence_id", F.col("seq.place").alias("place"), F.col("time_hints.kind").alias("hint"),
                      sgt_text("time_hints.start_at").alias("start_at"), sgt_text("time_hints.end_at").alias("end_at"))


@query("adapt_claims", f"""
WITH h AS (SELECT event_id, user_id % 2 = 0 AS o, ts, CASE WHEN event_id % 50 = 49 THEN 'recurring' WHEN event_id % 4 = 0 THEN 'fixed' WHEN event_id % 4 = 1 THEN 'start-only' WHEN event_id % 4 = 2 THEN 'end-only' END AS kind,
  CASE WHEN event_id % 50 = 49 THEN ts + INTERVAL 20 DAY WHEN event_id % 8 = 0 OR event_id % 4 = 2 THEN ts + to_minutes(CAST(floor(value) AS BIGINT)) END AS e FROM events),
a AS (SELECT *, CASE WHEN NOT (kind = 'fixed' AND o) OR kind IS NULL THEN kind WHEN e IS NULL THEN 'start-only' ELSE 'end-only' END AS hint FROM h)
SELECT event_id AS ev_seq, hint, CASE WHEN hint <> 'end-only' THEN {sql_text('ts')} END AS start_at, {sql_text('e')} AS end_at FROM a""")
def adapt_claims(t):
    """Fresh claims against the state: a fixed hint moves or closes the period that is open."""
    return R.adapt_claims(event_claims(t), open_state(t)).select(
        "ev_seq", F.col("time_hints.kind").alias("hint"), sgt_text("time_hints.start_at").alias("start_at"), sgt_text("time_hints.end_at").alias("end_at"))


@query("select_targets_modes", """
WITH l AS (SELECT user_id, event_id % 5 AS ev, event_type, event_id, ts FROM events),
e AS (SELECT user_id, ev, min(ts) AS t0 FROM l GROUP BY 1, 2),
x AS (SELECT user_id, ev, event_type, bool_or(event_id % 6 = 0) AS a, bool_or(event_id % 3 <> 0 AND event_id % 4 <> 1 AND ts + to_minutes(event_id % 11 - 5) > t0) AS b
  FROM l JOIN e USING (user_id, ev) WHERE user_id % 7 <> 0 GROUP BY 1, 2, 3),
m AS (SELECT DISTINCT 'degraded-future-no-service' AS mode, user_id, ev FROM x WHERE a AND b AND (user_id + ev) % 3 = 0
  UNION ALL SELECT 'empty-impact', user_id, ev FROM e WHERE user_id % 7 = 0
  UNION ALL SELECT 'explicit', user_id, ev FROM e WHERE user_id IN (1, 2) AND ev IN (1, 3))
SELECT mode, 'u' || user_id AS issue_id, 'e' || ev AS evidence_id FROM m""")
def select_targets_modes(t):
    """The modes that read evidence; every seventh user has evidence but no events."""
    i, ev = F.col("event_id"), F.col("event_id") % 5
    start = F.col("ts") + minutes(i % 11 - 5)
    issue, name = F.concat(F.lit("u"), "user_id").alias("issue_id"), F.concat(F.lit("e"), ev).alias("evidence_id")
    log = t.events.filter("user_id % 7 <> 0").select(
        issue, name, i.alias("seq"), service(F.col("event_type")).alias("entity"), sgt("ts").alias("ts"),
        F.when(i % 3 == 0, "service_effects.set").otherwise("periods.set").alias("type"), F.struct(F.when(i % 2 == 0, "no-service").otherwise("delay").alias("kind")).alias("effect"),
        F.array(hint(F.lit("fixed"), sgt(start), F.when(i % 4 != 1, sgt(start + minutes(F.lit(30)))))).alias("periods"))
    said = (F.when((F.col("user_id") + ev) % 3 == 0, "Longer waits of up to 10 min. Expected works next year.")
            .when((F.col("user_id") + ev) % 3 == 1, "No train service. Expected works next year.").otherwise("Longer waits of up to 10 min."))
    evidence = t.events.groupBy(issue, name, said.alias("text")).agg(F.date_format(F.min("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+08:00'").alias("ts"))
    modes = {"degraded-future-no-service": {}, "empty-impact": {}, "explicit": {"issue_ids": ["u1", "u2"], "evidence_ids": ["e1", "e3"]}}
    parts = [R.select_targets(evidence, log, mode, **more).select(F.lit(mode).alias("mode"), "issue_id", "evidence_id") for mode, more in modes.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
