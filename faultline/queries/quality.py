"""Data-quality rules, differences, fingerprints, sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.functions.temporal import contains_interval
from faultline.operators import diff
from faultline.operators import quality as Q
from faultline.plans import ingest as I
from faultline.queries.registry import query, sql_text
from faultline.queries.temporal import _ORDERS_SQL, order_spans
from faultline.schemas import INGEST_CONTENT
from faultline.sources.features import import_point_features

# breaches are made by asking for parents of another kind: parts of size 1 to 45 only,
# orders that are not open
_PARTS = "p_size <= 45"


@query("fk_check", f"""
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND {_PARTS})""")
def fk_check(t):
    return Q.fk_check(t.lineitem, "l_partkey", t.part.filter(_PARTS), "p_partkey").select("l_orderkey", "l_linenumber", "l_partkey")


@query("fk_check_composite", """
SELECT l_orderkey, l_suppkey, l_linenumber FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM lineitem p WHERE p.l_returnflag = 'R' AND p.l_orderkey = l.l_orderkey AND p.l_linestatus = l.l_linestatus)""")
def fk_composite(t):
    """References on two columns, as an event's evidence must lie in its own bundle."""
    returned = t.lineitem.filter("l_returnflag = 'R'")
    return Q.fk_check(t.lineitem, ["l_orderkey", "l_linestatus"], returned, ["l_orderkey", "l_linestatus"]).select("l_orderkey", "l_suppkey", "l_linenumber")


@query("labels_fk", "SELECT doc_id, quality, toxic FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'en')")
def labels_fk(t):
    return Q.fk_check(t.labels, "doc_id", t.documents.filter("lang = 'en'"), "doc_id")


@query("unique_check", """
WITH f AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, min((l_partkey, l_suppkey)) OVER (PARTITION BY l_orderkey, l_linenumber) AS f,
  count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, struct_extract_at(f, 1) AS first_part FROM f WHERE n > 1 AND (l_partkey, l_suppkey) <> f""")
def unique_check(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return Q.unique_check(rows, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("first_location.l_partkey").alias("first_part"))


@query("unique_across", """
WITH f AS (SELECT doc_id, source, md5(trim(text)) AS h FROM documents),
a AS (SELECT h, min((doc_id, source)) AS f FROM f GROUP BY h)
SELECT doc_id, source, struct_extract_at(f, 2) AS first_source FROM f JOIN a USING (h) WHERE source <> struct_extract_at(f, 2)""")
def unique_across(t):
    """Equal texts under another source than the first."""
    rows = t.documents.select("doc_id", "source", F.md5(F.trim("text")).alias("h"))
    return Q.unique_across(rows, ["h"], "source", ["doc_id"]).select("doc_id", "source", F.col("first_location.source").alias("first_source"))


@query("setter_conflicts", """
SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, date_trunc('day', ts) ORDER BY event_id) AS n FROM events) WHERE n > 1""")
def setter_conflicts(t):
    rows = t.events.select("user_id", "event_id", "event_type", F.to_date("ts").alias("day"))
    return Q.setter_conflicts(rows, ["user_id", "event_type"], "day", ["event_id"]).select("user_id", "event_id")


@query("containment_check", f"""WITH {_ORDERS_SQL}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE EXISTS (SELECT 1 FROM o WHERE o_orderkey = l_orderkey)
  AND NOT EXISTS (SELECT 1 FROM o WHERE o_orderkey = l_orderkey AND o_orderdate <= l_shipdate AND (o_end IS NULL OR l_shipdate + INTERVAL 1 DAY <= o_end))""")
def containment(t):
    """Line items shipped outside the validity of their order."""
    items = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
                              (F.col("l_shipdate") + F.expr("interval 1 day")).alias("l_done"))
    row = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    inside = contains_interval("o_orderdate", "o_end", "l_shipdate", "l_done")
    spans = order_spans(t).select("o_orderkey", "o_orderdate", "o_end")
    return Q.outside_every_window(items, row, "l_orderkey", spans, "o_orderkey", inside, require_match=True).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


_EXPECT = {"quantity below 45": "l_quantity < 45", "discount allowed": "l_discount <= 0.08", "taxed": "l_tax > 0"}


@query("expectations", " UNION ALL ".join(
    f"SELECT '{n}' AS rule, CAST(l_orderkey AS VARCHAR) AS path, CAST(l_linenumber AS VARCHAR) AS location FROM lineitem WHERE NOT ({p})" for n, p in _EXPECT.items()))
def expectations(t):
    return Q.expectations(t.lineitem, {n: F.expr(p) for n, p in _EXPECT.items()}, F.col("l_orderkey"), F.col("l_linenumber")).select("rule", "path", "location")


@query("validation_summary", f"""
SELECT 'lineitem' AS scope, count(*) AS checked, NULL AS ok FROM lineitem UNION ALL SELECT 'part', count(*), NULL FROM part
UNION ALL SELECT 'errors', count(*), CAST(count(*) = 0 AS INTEGER) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE {_PARTS})""")
def validation_summary(t):
    bad = Q.fk_check(t.lineitem, "l_partkey", t.part.filter(_PARTS), "p_partkey")
    errs = Q.errors(bad, "part exists", F.col("l_orderkey"), F.col("l_linenumber"), F.lit("part"))
    return Q.validation_summary({"lineitem": t.lineitem, "part": t.part}, errs).withColumn("ok", F.col("ok").cast("int"))


_B32 = "0123456789ABCDEFGHJKMNPQRSTVWXYZ"


def audited_ids(t, early):
    ms = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000) - early
    digit = lambda i: F.substring(F.lit(_B32), (F.floor(ms / F.lit(32 ** (9 - i))) % 32 + 1).cast("int"), F.lit(1))
    broken = F.col("event_id") % 5 == 4
    prefix = F.when(F.col("event_id") % 5 == 0, "ie_").otherwise("ev_")
    tail = F.when(broken, "IIIIIIIIIIIIIIII").otherwise("ABCDEFGHJKMNPQRS")
    return t.events.select("event_id", "ts", F.concat(prefix, *[digit(i) for i in range(10)], tail).alias("id"))


@query("id_audit", """
SELECT event_id, CASE WHEN event_id % 5 = 4 THEN 0 ELSE 1 END AS id_valid,
  CASE event_id % 5 WHEN 4 THEN NULL WHEN 0 THEN 'impact-event' ELSE 'evidence' END AS id_kind,
  CASE WHEN event_id % 5 <> 4 THEN epoch_us(ts) // 1000 END AS id_millis, CASE WHEN event_id % 5 <> 4 THEN 0 END AS id_drift_ms FROM events""")
def id_audit(t):
    """Ids built from the event times, every fifth broken, audited back to those times."""
    rows = audited_ids(t, F.lit(0))
    out = Q.id_audit(rows, "id", F.unix_micros(F.col("ts").cast("timestamp")))
    return out.select("event_id", F.col("id_valid").cast("int").alias("id_valid"), "id_kind", "id_millis", "id_drift_ms")


@query("id_audit_summary", """
SELECT CASE event_id % 5 WHEN 4 THEN NULL WHEN 0 THEN 'impact-event' ELSE 'evidence' END AS id_kind, count(*) AS ids,
  max(CASE WHEN event_id % 5 <> 4 THEN event_id % 7 END) AS max_drift_ms FROM events GROUP BY 1""")
def id_summary(t):
    """Ids whose times are up to six milliseconds before the events'."""
    rows = audited_ids(t, F.col("event_id") % 7)
    return Q.id_audit_summary(Q.id_audit(rows, "id", F.unix_micros(F.col("ts").cast("timestamp"))))


# --- differences ------------------------------------------------------------------

# part and an altered copy: every 11th part gone, every 13th renamed, every 7th repriced, keys above all moved up
_OLD_SQL = "a AS (SELECT * FROM part)"
_NEW_SQL = """b AS (SELECT CASE WHEN p_partkey % 17 = 0 THEN p_partkey + 10000000 ELSE p_partkey END AS p_partkey,
  CASE WHEN p_partkey % 13 = 0 THEN p_name || '!' ELSE p_name END AS p_name, p_brand,
  CASE WHEN p_partkey % 5 = 0 THEN 'LARGE' ELSE p_type END AS p_type, p_size, CASE WHEN p_partkey % 7 = 0 THEN p_retailprice + 1 ELSE p_retailprice END AS p_retailprice
  FROM part WHERE p_partkey % 11 <> 0)"""


def altered(t):
    k = F.col("p_partkey")
    return t.part.filter(k % 11 != 0).select(
        F.when(k % 17 == 0, k + 10000000).otherwise(k).alias("p_partkey"), F.when(k % 13 == 0, F.concat("p_name", F.lit("!"))).otherwise(F.col("p_name")).alias("p_name"),
        "p_brand", F.when(k % 5 == 0, "LARGE").otherwise(F.col("p_type")).alias("p_type"), "p_size",
        F.when(k % 7 == 0, F.col("p_retailprice") + 1).otherwise(F.col("p_retailprice")).alias("p_retailprice"))


@query("diff_ids", f"""WITH {_OLD_SQL}, {_NEW_SQL}
SELECT coalesce(a.p_partkey, b.p_partkey) AS p_partkey, CASE WHEN a.p_partkey IS NULL THEN 'added' WHEN b.p_partkey IS NULL THEN 'removed' ELSE 'shared' END AS status
FROM a FULL JOIN b ON a.p_partkey = b.p_partkey""")
def diff_ids(t):
    return diff.diff_ids(t.part, altered(t), "p_partkey")


@query("table_diff", f"""WITH {_OLD_SQL}, {_NEW_SQL}
SELECT coalesce(a.p_partkey, b.p_partkey) AS p_partkey, CASE WHEN a.p_partkey IS NULL THEN 'added' WHEN b.p_partkey IS NULL THEN 'removed' ELSE 'shared' END AS status,
  CAST(CASE WHEN a.p_partkey = b.p_partkey THEN a.p_name <> b.p_name END AS INTEGER) AS metadata_changed,
  CAST(CASE WHEN a.p_partkey = b.p_partkey THEN a.p_retailprice <> b.p_retailprice OR a.p_size <> b.p_size END AS INTEGER) AS moved_changed
FROM a FULL JOIN b ON a.p_partkey = b.p_partkey""")
def table_diff(t):
    out = diff.table_diff(t.part, altered(t), "p_partkey", {"metadata": ["p_name"], "moved": ["p_retailprice", "p_size"]})
    return out.select("p_partkey", "status", F.col("metadata_changed").cast("int").alias("metadata_changed"), F.col("moved_changed").cast("int").alias("moved_changed"))


_TYPES = ["ECONOMY", "SMALL", "LARGE", "PROMO", "STANDARD", "MEDIUM", "NONE"]


@query("category_counts", "SELECT c.category, count(p_partkey) AS n FROM (VALUES " + ", ".join(f"('{x}')" for x in _TYPES) + ") c(category) LEFT JOIN part ON p_type = c.category GROUP BY 1")
def category_counts(t):
    return diff.category_counts(t.part, "p_type", _TYPES)


@query("category_delta", f"""WITH {_OLD_SQL}, {_NEW_SQL}, x AS (SELECT p_type, -1 AS s FROM a UNION ALL SELECT p_type, 1 FROM b)
SELECT c.category, count(*) FILTER (s = -1) AS n_from, count(*) FILTER (s = 1) AS n_to, CAST(coalesce(sum(s), 0) AS BIGINT) AS delta
FROM (VALUES """ + ", ".join(f"('{x}')" for x in _TYPES) + ") c(category) LEFT JOIN x ON p_type = c.category GROUP BY 1")
def category_delta(t):
    return diff.count_delta(t.part, altered(t), "p_type", _TYPES)


@query("coverage", f"""WITH {_OLD_SQL}, {_NEW_SQL}
SELECT p_partkey, 'not_in_inventory' AS status FROM a WHERE p_partkey NOT IN (SELECT p_partkey FROM b)
UNION ALL SELECT p_partkey, 'missing_from_derived' FROM b WHERE p_partkey NOT IN (SELECT p_partkey FROM a)""")
def coverage(t):
    return diff.coverage(t.part, altered(t), "p_partkey")


@query("only_in", "SELECT DISTINCT p_partkey AS part FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49)")
def only_in(t):
    return diff.only_in(t.part.select(F.col("p_partkey").alias("part")), t.lineitem.filter("l_quantity > 49").select(F.col("l_partkey").alias("part")), "part")


@query("fingerprint_changes", f"""WITH {_OLD_SQL}, {_NEW_SQL}
SELECT CAST(coalesce(a.p_partkey, b.p_partkey) AS VARCHAR) AS id, CASE WHEN a.p_partkey IS NULL THEN 'added' WHEN b.p_partkey IS NULL THEN 'removed' ELSE 'changed' END AS status
FROM a FULL JOIN b ON a.p_partkey = b.p_partkey WHERE a.p_partkey IS NULL OR b.p_partkey IS NULL OR (a.p_name, a.p_type, a.p_retailprice) <> (b.p_name, b.p_type, b.p_retailprice)""")
def fingerprint_changes(t):
    cols = t.part.columns
    return diff.changed(diff.fingerprint(t.part, "p_partkey", cols, "parts"), diff.fingerprint(altered(t), "p_partkey", cols, "parts")).select("id", "status")


@query("bundle_changes", """
SELECT CAST(o_orderkey AS VARCHAR) AS id, CASE WHEN o_orderkey % 7 = 0 THEN 'removed' ELSE 'changed' END AS status
FROM orders WHERE o_orderkey % 7 = 0 OR (o_orderkey % 5 = 0 AND o_orderkey IN (SELECT l_orderkey FROM lineitem))""")
def bundle_changes(t):
    """Orders as bundles: some lose a side, some hold each line twice and then another line twice."""
    issue = t.orders.select(F.col("o_orderkey").alias("issue_id"), "o_orderstatus", "o_orderdate")
    line = t.lineitem.select(F.col("l_orderkey").alias("issue_id"), F.col("l_linenumber").alias("line_no"), "l_partkey", "l_shipdate")
    event = t.orders.select(F.col("o_orderkey").alias("issue_id"), F.lit(1).alias("seq"), "o_orderpriority")
    twice = line.unionByName(line.filter("issue_id % 5 = 0"))
    other = twice.withColumn("l_partkey", F.when(F.col("issue_id") % 5 == 0, F.col("l_partkey") + 1).otherwise(F.col("l_partkey")))
    made = lambda i, l, e: diff.fingerprint_bundle(i, l, e, i.columns[1:], l.columns[1:], e.columns[1:])
    stay = lambda df: df.filter("issue_id % 7 <> 0")
    return diff.changed(made(issue, twice, event), made(stay(issue), stay(other), stay(event))).select(F.col("id").cast("string").alias("id"), "status")


@query("dedup_semantic", """
SELECT l_orderkey, l_linestatus, l_returnflag, CAST(min(l_linenumber) AS BIGINT) AS first_line FROM lineitem GROUP BY 1, 2, 3""")
def dedup_semantic(t):
    rows = t.lineitem.select("l_orderkey", "l_linestatus", "l_returnflag", "l_linenumber")
    return diff.dedup_semantic(rows, ["l_linestatus", "l_returnflag"], "l_linenumber", ["l_orderkey"]).select(
        "l_orderkey", "l_linestatus", "l_returnflag", F.col("l_linenumber").cast("long").alias("first_line"))


@query("preserve_ids", """
WITH o AS (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS n FROM events WHERE event_id % 3 <> 0),
w AS (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS n FROM events)
SELECT w.user_id, w.event_id AS seq, coalesce('old-' || o.event_id, 'new-' || w.event_id) AS id FROM w LEFT JOIN o USING (user_id, event_type, n)""")
def preserve_ids(t):
    """A log and its thinned past: the n-th event of a kind takes the id of the n-th past one."""
    rows = lambda df, tag: df.select(F.col("user_id").alias("issue_id"), F.col("event_id").alias("seq"), "event_type", F.concat(F.lit(tag), "event_id").alias("id"))
    new, old = rows(t.events, "new-"), rows(t.events.filter("event_id % 3 <> 0"), "old-")
    return diff.preserve_ids(new, old, "id", ["event_type"], "seq").select(F.col("issue_id").alias("user_id"), "seq", "id")


@query("replay_summary", """
SELECT user_id, count(*) FILTER (event_type <> 'view') AS before, count(*) FILTER (value > 10) AS after,
  count(*) FILTER (value > 10) - count(*) FILTER (event_type <> 'view') AS diff FROM events WHERE event_type <> 'view' OR value > 10 GROUP BY ROLLUP (user_id)""")
def replay_summary(t):
    return diff.replay_summary(t.events.filter("event_type <> 'view'"), t.events.filter("value > 10"), "user_id")


@query("line_order_in_force", """SELECT arg_max(p_brand || '>' || p_type, p_partkey) FILTER (p_size = 7) AS line_order FROM part""")
def line_order_in_force(t):
    rows = t.part.select(F.when(F.col("p_size") == 7, "line_order").otherwise("label_hint").alias("type"), F.col("p_partkey").alias("pos"),
                         F.array("p_brand", "p_type").alias("line_ids"))
    return diff.last_line_order(rows, F.array(F.lit("none"))).select(F.array_join("line_order", ">").alias("line_order"))


# --- sources ------------------------------------------------------------------------


@query("import_features", """
WITH f AS (SELECT c_custkey, n_nationkey, c_custkey % 9 AS k FROM customer JOIN nation ON n_nationkey = c_nationkey)
SELECT c_custkey AS object_id, n_nationkey AS station_id, (c_custkey % 30) || chr(CAST(65 + c_custkey % 2 AS INTEGER)) AS label FROM f WHERE k <> 8""")
def import_features(t):
    """Customers as exits of nations: by code, by name, and - every ninth - invalid."""
    k = F.col("c_custkey") % 9
    src = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    features = src.select(
        F.lit("Point").alias("geometry"), F.array(F.lit(103.8), F.lit(1.3)).alias("coordinates"),
        F.when(k < 4, F.concat(F.lit("ns"), "n_nationkey")).otherwise(F.concat(F.initcap("n_name"), F.lit(" MRT Station"))).alias("station_name"),
        F.concat(F.lit("Exit "), (F.col("c_custkey") % 30).cast("string"), F.char(65 + F.col("c_custkey") % 2)).alias("exit_code"),
        F.col("c_custkey").alias("object_id"), F.when(k == 8, "xyz").otherwise("0123456789ABCDEF").alias("checksum"), F.lit("20240102030405").alias("updated"))
    stations = t.nation.select(F.col("n_nationkey").alias("id"), F.struct(F.col("n_name").alias("en-SG")).alias("name"),
                               F.array(F.struct(F.concat(F.lit("NS"), "n_nationkey").alias("code"))).alias("stationCodes"))
    return import_point_features(features, stations)["matched"].select("object_id", "station_id", "label")


_ITEM_SQL = """c AS (SELECT conv_id, turn, conv_id || '-' || turn AS item_id, (conv_id + turn) % 3 AS k, role, text, trim(text, ' ') AS tt FROM conversations)"""


@query("content_text", f"""WITH {_ITEM_SQL}
SELECT item_id, CASE k WHEN 1 THEN 'report.media' ELSE 'report.public' END AS type, md5(CASE k WHEN 0 THEN text
  WHEN 1 THEN concat_ws(chr(10) || chr(10), 'Title: ' || role, 'Summary: ' || nullif(tt, '')) ELSE concat_ws(chr(10) || chr(10), 'Title: ' || role, 'Body: ' || nullif(tt, '')) END) AS text_md5,
  {sql_text("TIMESTAMP '2024-01-01 08:00:00' + to_minutes(CAST(conv_id AS BIGINT))")} AS ts FROM c""")
def content_text(t):
    """Conversation turns as posts, articles and threads, normalised to evidence rows."""
    k = (F.col("conv_id") + F.col("turn")) % 3
    null = F.lit(None).cast("string")
    at = F.date_format(F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")) + F.make_dt_interval(mins=F.col("conv_id").cast("int")), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    items = t.conversations.select(
        F.concat_ws("-", "conv_id", "turn").alias("item_id"), F.when(k == 0, "twitter").when(k == 1, "news-website").otherwise("reddit").alias("source"),
        F.col("text"), F.concat(F.lit("https://example.com/"), "conv_id").alias("url"), at.alias("createdAt"), F.col("role").alias("title"),
        F.when(k == 1, F.col("text")).alias("summary"), F.when(k == 2, F.col("text")).alias("selftext"),
        *[null.alias(c) for c in ("articleText", "articleTextSource", "observedAt", "directionText", "effect", "delayMinutes", "reportCount")],
        *[F.lit(None).cast("array<string>").alias(c) for c in ("lineIds", "stationIds")])
    out = I.evidence_rows(items)
    return out.select("item_id", "type", F.md5("text").alias("text_md5"), F.concat(F.replace(F.substring("ts", 1, 19), F.lit("T"), F.lit(" ")), F.lit(".000000")).alias("ts"))


@query("check_contract", """
WITH r AS (SELECT event_id, event_id % 11 AS k, CAST(json_extract(props, '$.k') AS INTEGER) AS n FROM events)
SELECT event_id, concat_ws(',', CASE WHEN k = 3 THEN 'report observed before created' END, CASE WHEN k = 5 THEN 'report names a line or station' END,
  CASE WHEN n < 1 THEN 'report count is positive' END, CASE WHEN k = 7 THEN 'report url is HTTP' END, CASE WHEN k = 9 THEN 'report has no unknown keys' END) AS breaches FROM r""")
def check_contract(t):
    """Events as crowd reports, some breaking one rule of the feed contract."""
    k = F.col("event_id") % 11
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'+08:00'")
    observed = F.when(k == 3, F.col("ts") + F.expr("interval 1 hour")).otherwise(F.col("ts"))
    body = F.struct(
        F.lit("crowd-report").alias("source"), F.concat(F.lit("r"), "event_id").alias("reportId"), F.col("event_type").alias("text"),
        stamp("ts").alias("createdAt"), stamp(observed).alias("observedAt"), F.when(k != 5, F.array(F.lit("L"))).alias("lineIds"),
        F.get_json_object("props", "$.k").cast("int").alias("reportCount"),
        F.when(k == 7, "ftp://example.com/x").otherwise("https://example.com/x").alias("url"), F.when(k == 9, "?").alias("extra"))
    items = t.events.select("event_id", F.to_json(body).alias("raw")).withColumn("c", F.from_json("raw", INGEST_CONTENT)).select("event_id", "raw", "c.*")
    return I.check_contract(items).select("event_id", F.array_join("breaches", ",").alias("breaches"))



@query("input_diff", f"""WITH {_OLD_SQL}, {_NEW_SQL}
SELECT coalesce(a.p_partkey, b.p_partkey) AS id, CASE WHEN a.p_partkey IS NULL THEN 'added' WHEN b.p_partkey IS NULL THEN 'removed' ELSE 'shared' END AS status,
  CASE WHEN a.p_partkey IS NULL OR b.p_partkey IS NULL THEN NULL ELSE CAST(a.p_name <> b.p_name OR a.p_type <> b.p_type AS INTEGER) END AS constraint_changed
FROM a FULL JOIN b ON a.p_partkey = b.p_partkey""")
def input_diff(t):
    """Parts as constraints; their size is only their place, so it does not count."""
    cols = [F.col("p_partkey").alias("id"), "p_name", "p_type", F.col("p_retailprice").alias("pos")]
    return diff.input_diff(t.part.select(*cols), altered(t).select(*cols)).withColumn("constraint_changed", F.col("constraint_changed").cast("int"))


@query("distinct_times", """SELECT user_id, min(event_id) AS event_id, ts FROM (
  SELECT user_id, event_id, date_trunc('minute', ts) + to_microseconds(event_id % 3) AS ts FROM events) GROUP BY user_id, ts""".replace("ts FROM (", "strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM (").replace("GROUP BY user_id, ts", "GROUP BY user_id, (ts)"))
def distinct_times(t):
    """Rows that differ by a microsecond stay apart."""
    at = F.date_trunc("minute", "ts").cast("timestamp_ntz") + F.make_dt_interval(secs=(F.col("event_id") % 3).cast("decimal(18,6)") / 1000000)
    rows = t.events.select("user_id", "event_id", at.alias("ts"))
    return diff.dedup_semantic(rows, ["user_id", "ts"], "event_id").select("user_id", "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"))
