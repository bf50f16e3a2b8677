"""State folds over the event log."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import functions as F

from faultline.operators import ordered
from faultline.operators import state as S
from faultline.operators.replay import events_by_evidence, replay_order
from faultline.queries.registry import query, sql_text
from faultline.streaming.state import read_state, streaming_state, write_state

_STATE_SQL = """
SELECT user_id, event_type, arg_max(value, event_id) AS value, max(event_id) AS event_id
FROM events GROUP BY user_id, event_type"""


@query("current_state", _STATE_SQL)
def current_state(t):
    return S.current_state(t.events, ["user_id"], "event_type", "event_id", ["value", "event_id"])


@query("state_provenance", """
SELECT user_id, event_type, 'ev-' || (arg_max(event_id, event_id) // 3) AS evidence_id FROM events GROUP BY 1, 2""")
def state_provenance(t):
    log = t.events.withColumn("evidence_id", F.concat(F.lit("ev-"), F.floor(F.col("event_id") / 3).cast("string")))
    return S.current_state(log, ["user_id"], "event_type", "event_id", ["evidence_id"])


@query("live_events", """
SELECT user_id, event_type, event_id FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1""")
def live_events(t):
    log = t.events.select("user_id", "event_type", "event_id", F.col("event_id").alias("id"))
    return S.live_events(log, ["user_id"], "event_type", "event_id", "id").drop("id")


@query("bundle_state", """
WITH e AS (SELECT 'u' || user_id AS issue_id, event_id, 'svc-' || (event_id % 3) AS service,
  event_id % 4 AS k, CAST(floor(value) AS BIGINT) AS v FROM events),
a AS (SELECT issue_id, 'service:' || service AS entity_key,
  arg_max(CASE WHEN v % 2 = 0 THEN 'delay' ELSE 'no-service' END, event_id) FILTER (k = 0) AS effect,
  coalesce(arg_max('c' || v, event_id) FILTER (k = 1), '') AS causes,
  max(event_id) FILTER (k = 0) AS effect_event, max(event_id) FILTER (k = 1) AS causes_event
  FROM e GROUP BY 1, 2)
SELECT issue_id, entity_key, effect, causes, 'e' || effect_event AS effect_evidence_id,
  'e' || causes_event AS causes_evidence_id FROM a""")
def bundle_state(t):
    return S.bundle_state(impact_log(t)).select(
        "issue_id", "entity_key", F.col("effect.kind").alias("effect"), F.array_join("causes", ",").alias("causes"), "effect_evidence_id", "causes_evidence_id")


def impact_log(t):
    """Events as setters on services, one issue per user."""
    k, v = F.col("event_id") % 4, F.floor("value").cast("long")
    null = lambda c: F.lit(None).cast(c)
    # k = 2 is a facility setter on a service: it sets nothing; k = 3 sets scopes
    return t.events.select(
        F.concat(F.lit("u"), "user_id").alias("issue_id"), F.col("event_id").alias("seq"), F.concat(F.lit("i"), "event_id").alias("event_id"),
        F.when(k == 0, "service_effects.set").when(k == 1, "causes.set").when(k == 2, "facility_effects.set").otherwise("service_scopes.set").alias("type"),
        F.struct(F.lit("service").alias("type"), F.concat(F.lit("svc-"), F.col("event_id") % 3).alias("service_id"), null("string").alias("station_id"),
                 null("string").alias("line_id"), null("string").alias("kind")).alias("entity"),
        F.concat(F.lit("e"), "event_id").alias("evidence_id"), null(f"array<{S.PERIOD}>").alias("periods"), null(f"array<{S.SCOPE}>").alias("service_scopes"),
        F.struct(F.when(v % 2 == 0, "delay").otherwise("no-service").alias("kind"), null("string").alias("duration")).alias("effect"),
        F.array(F.concat(F.lit("c"), v)).alias("causes"))


_LIVE_SETTERS_SQL = """
WITH e AS (SELECT 'u' || user_id AS issue_id, 'service:svc-' || (event_id % 3) AS entity_key, event_id,
  CASE event_id % 4 WHEN 0 THEN 'effect' WHEN 1 THEN 'causes' WHEN 3 THEN 'scopes' END AS attribute FROM events)
SELECT issue_id, entity_key, attribute, {} FROM e WHERE attribute IS NOT NULL GROUP BY 1, 2, 3"""


@query("bundle_provenance", _LIVE_SETTERS_SQL.format("'e' || max(event_id) AS evidence_id, 'i' || max(event_id) AS event_id"))
def bundle_provenance(t):
    return S.state_provenance(impact_log(t))


@query("bundle_live_events", _LIVE_SETTERS_SQL.format("max(event_id) AS seq, 'i' || max(event_id) AS event_id"))
def bundle_live_events(t):
    return S.bundle_live_events(impact_log(t))


@query("emit_changes", """
WITH b AS (SELECT user_id, event_id, CAST(floor(value / 10) AS BIGINT) AS bucket FROM events),
l AS (SELECT *, lag(bucket) OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM b)
SELECT user_id, event_id, bucket FROM l WHERE before IS NULL OR before <> bucket""")
def emit_changes(t):
    rows = t.events.select("user_id", "event_id", F.floor(F.col("value") / 10).cast("long").alias("bucket"))
    return S.emit_changes(rows, ["user_id"], ["event_id"], "bucket")


@query("replay_order", """
SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS ev_seq FROM events""")
def order_of_replay(t):
    rows = t.events.select("user_id", "event_id", F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+08:00")).alias("ts"))
    return replay_order(rows, ["user_id"], tie="event_id").select("user_id", "event_id", "ev_seq")


@query("first_n_per_group", """
SELECT user_id, event_type, event_id FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY value DESC, event_id) <= 2""")
def first_n(t):
    return ordered.first_per_group(t.events, ["user_id", "event_type"], [F.desc("value"), F.asc("event_id")], 2).select("user_id", "event_type", "event_id")


@query("streaming_state", _STATE_SQL)
def state_by_stream(t):
    """The log read as a stream; its update batches land in a table whose newest rows are the state."""
    spark = t.spark
    shared = spark.conf.get("spark.checkpoint.dir", "") or (tempfile.gettempdir() if spark.sparkContext.master.startswith("local") else "")
    if not shared:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    work = f"{shared}/faultline-stream-{uuid.uuid4().hex}"
    events = t.events
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{t.folder}/events.parquet")
    one_file = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).isFile()
    reader = spark.readStream.schema(events.schema)
    log = reader.option("pathGlobFilter", "events.parquet").parquet(t.folder) if one_file else reader.parquet(f"{t.folder}/events.parquet")
    state = streaming_state(log.withColumn("id", F.col("event_id")), ["user_id"], "event_type", "event_id", ["value", "id"])
    write_state(state, f"{work}/state", f"{work}/checkpoint", ["user_id"], "event_type", "event_id").awaitTermination()
    return read_state(spark, f"{work}/state", ["user_id"], "event_type", "event_id", ["value"]).select(
        "user_id", "event_type", "value", "event_id")


@query("events_by_evidence", f"""
SELECT o.o_orderkey AS issue_id, l.l_linenumber AS seq, l.l_partkey AS part,
  CASE WHEN l.l_orderkey IS NOT NULL THEN row_number() OVER (
    PARTITION BY o.o_orderkey ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey) END AS event_pos,
  {sql_text('o.o_orderdate')} AS ts
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey""")
def evidence_with_events(t):
    """Orders as evidence, line items as its events, each with its place."""
    place = F.struct("l_linenumber", "l_partkey", "l_suppkey")
    events = t.lineitem.select(F.col("l_orderkey").alias("issue_id"), F.lit("all").alias("evidence_id"), place.alias("seq"), F.col("l_partkey").alias("event_id"), F.lit("item").alias("type"))
    evidence = t.orders.select(F.col("o_orderkey").alias("issue_id"), F.lit("all").alias("evidence_id"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"))
    joined = events_by_evidence(evidence, events, None)
    return joined.select("issue_id", F.col("seq.l_linenumber").alias("seq"), F.col("event_id").alias("part"), "event_pos", "ts")
