"""Searches, source rules, text."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.functions import text as X
from faultline.operators import evaluate as V
from faultline.operators import replay as R
from faultline.operators import ordered, rights, search
from faultline.operators.ordered import first_per_group
from faultline.queries.registry import minutes, query, sgt, sgt_text
from faultline.queries.temporal import _EVENTS_SQL
from faultline.schemas import PERIOD
from faultline.session import small_table

# 20 search windows over the month of the log, 6 to 30 hours long
_WINDOWS = [(i, f"2024-01-{1 + (i * 36) // 24:02d} {(i * 36) % 24:02d}:00:00", 6 * (i % 5 + 1)) for i in range(20)]
_WINDOWS_SQL = "w AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}, TIMESTAMP '{s}', TIMESTAMP '{s}' + INTERVAL {h} HOUR)" for i, s, h in _WINDOWS) + ") v(window_id, ws, we))"
_ISSUE_SQL = "'2024-01-' || lpad(CAST(user_id % 28 + 1 AS VARCHAR), 2, '0') || '-u' || user_id"
_HITS_SQL = f"""WITH {_EVENTS_SQL}, {_WINDOWS_SQL},
i AS (SELECT *, {_ISSUE_SQL} AS issue_id FROM e),
h AS (
  SELECT DISTINCT w.window_id, i.issue_id, 0 AS t, 0 AS id FROM i JOIN w ON CAST(substr(issue_id, 1, 10) AS TIMESTAMP) < we + INTERVAL 1 MILLISECOND
    AND ws < CAST(substr(issue_id, 1, 10) AS TIMESTAMP) + INTERVAL 1 DAY
  UNION ALL SELECT w.window_id, i.issue_id, 1, event_id FROM i JOIN w ON ts >= ws AND ts < we + INTERVAL 1 MILLISECOND
  UNION ALL SELECT w.window_id, i.issue_id, 2, event_id FROM i JOIN w ON ts < we + INTERVAL 1 MILLISECOND AND (te IS NULL OR ws < te + INTERVAL 1 MILLISECOND)),
n AS (SELECT window_id, issue_id, count(*) FILTER (t = 0) AS d, count(*) FILTER (t = 1) AS e, count(*) FILTER (t = 2) AS p FROM h GROUP BY 1, 2),
s AS (SELECT window_id, issue_id, CASE WHEN d > 0 THEN 5 ELSE 0 END + 3 * least(e, 3) + least(p, 3) AS score,
  concat_ws(', ', CASE WHEN d > 0 THEN 'issue date' END, CASE WHEN e > 0 THEN 'evidence timestamp' END, CASE WHEN p > 0 THEN 'active period' END) AS reasons FROM n),
r AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY window_id ORDER BY score DESC, issue_id DESC) <= 25)
"""


def windows(t):
    df = small_table(t.spark, _WINDOWS, "window_id int, s string, h int")
    start = F.to_timestamp_ntz("s")
    return df.select("window_id", sgt(start).alias("start_at"), sgt(start + F.make_dt_interval(hours=F.col("h"))).alias("end_at"))


def incident_tables(t):
    """Users as incidents: their events as evidence and as periods."""
    ids = F.concat(F.lit("2024-01-"), F.lpad((F.col("user_id") % 28 + 1).cast("string"), 2, "0"), F.lit("-u"), F.col("user_id"))
    end = F.when(F.col("event_id") % 97 != 0, F.col("ts") + minutes(F.floor("value")))
    rows = t.events.withColumn("issue_id", ids)
    null = lambda c: F.lit(None).cast(c)
    period = F.struct(F.lit("fixed").alias("kind"), sgt("ts").alias("start_at"), sgt(end).alias("end_at"), null("string").alias("frequency"),
                      null("array<string>").alias("days_of_week"), null("string").alias("window_start"), null("string").alias("window_end"),
                      null("string").alias("time_zone"), null("array<date>").alias("excluded_dates")).cast(PERIOD)
    evidence = rows.select("issue_id", F.col("event_id").alias("line_no"), sgt("ts").alias("ts"), F.concat_ws(" ", "event_type", "props").alias("text"))
    return rows.select("issue_id").distinct(), evidence, rows.select("issue_id", period.alias("period"))


def hits(t):
    issues, evidence, periods = incident_tables(t)
    return search.issues_in_window(issues, evidence, periods, windows(t))


@query("issues_in_window", _HITS_SQL + "SELECT CAST(window_id AS BIGINT) AS window_id, issue_id, CAST(score AS BIGINT) AS score, reasons FROM r")
def issues_in_window(t):
    return hits(t).select(F.col("window_id").cast("long").alias("window_id"), "issue_id", "score", F.array_join("reasons", ", ").alias("reasons"))


@query("decorate_hits", _HITS_SQL + """, x AS (SELECT r.window_id, r.issue_id, i.event_id, i.event_type || ' ' || i.props AS text,
    row_number() OVER (PARTITION BY r.window_id, r.issue_id ORDER BY i.event_id) AS n
  FROM r JOIN w USING (window_id) JOIN i ON i.issue_id = r.issue_id AND i.ts >= ws AND i.ts < we + INTERVAL 1 MILLISECOND),
k AS (SELECT issue_id, event_type, min(event_id) AS f FROM i GROUP BY 1, 2),
m AS (SELECT issue_id, string_agg(event_type, ',' ORDER BY f) AS scope FROM (
  SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY issue_id ORDER BY f) <= 3) GROUP BY 1)
SELECT CAST(r.window_id AS BIGINT) AS window_id, r.issue_id, coalesce((SELECT string_agg(text, '|' ORDER BY n) FROM x
  WHERE x.window_id = r.window_id AND x.issue_id = r.issue_id AND n <= 2), '') AS evidence, m.scope FROM r JOIN m USING (issue_id)""")
def decorated_hits(t):
    _, evidence, _ = incident_tables(t)
    state = evidence.groupBy("issue_id", F.regexp_extract("text", r"^(\w+)", 1).alias("entity_key")).agg(F.min("line_no").alias("first_seq"))
    out = search.decorate_hits(hits(t), evidence, windows(t), state.withColumn("entity_type", F.lit("service")))
    return out.select(F.col("window_id").cast("long").alias("window_id"), "issue_id", F.array_join("matching_evidence", "|").alias("evidence"),
                      F.array_join("current_scope", ",").alias("scope"))


_FUZZY = ["blue bolt", "red wigdet", "large gear"]


@query("fuzzy_search", "WITH s AS (SELECT p_partkey, least(" + ", ".join(
    f"CASE WHEN contains(lower(p_name), '{q}') THEN 0.0 ELSE CAST(levenshtein(lower(p_name), '{q}') AS DOUBLE) / greatest(length(p_name), {len(q)}) END" for q in _FUZZY
) + ") AS score FROM part) SELECT p_partkey, CAST(round(score * 1e6) AS BIGINT) AS score_ppm FROM s WHERE score <= 0.3")
def fuzzy(t):
    found = search.fuzzy_search(t.part, ["p_name"], _FUZZY, 0.3)
    return found.select("p_partkey", F.round(F.col("score") * 1e6).cast("long").alias("score_ppm"))


_PHRASE = "thousands there"


@query("search_documents", "SELECT doc_id, CAST(round((1.0 - (" + " + ".join(
    f"CAST(contains(lower(text), '{g}') AS INTEGER)" for g in search.trigrams(_PHRASE)
) + f") / {float(len(search.trigrams(_PHRASE)))}) * 1e6) AS BIGINT) AS score_ppm FROM documents")
def search_documents(t):
    return t.documents.select("doc_id", F.round(search.text_score("text", _PHRASE) * 1e6).cast("long").alias("score_ppm"))


_NAME_SCORE = f"""CASE WHEN contains(lower(x), '{_PHRASE}') THEN 0.0 ELSE CAST(levenshtein(lower(x), '{_PHRASE}') AS DOUBLE) / greatest(length(x), {len(_PHRASE)}) END"""


@query("search_issues", "WITH n AS (SELECT source, unnest([source, 'Feed ' || source, lang]) AS x FROM documents), p AS (SELECT source, " + _NAME_SCORE + """ AS s FROM n
UNION ALL SELECT source, coalesce(1.0 - (""" + " + ".join(f"CAST(contains(lower(text), '{g}') AS INTEGER)" for g in search.trigrams(_PHRASE)) + f""") / {float(len(search.trigrams(_PHRASE)))}, 1.0) FROM documents)
SELECT source AS issue_id, CAST(round(min(s) * 1e6) AS BIGINT) AS score_ppm FROM p GROUP BY source HAVING min(s) <= 0.8""")
def search_issues(t):
    """Best score per source over its id, title and the texts of its documents."""
    null = lambda c: F.lit(None).cast(c)
    docs = t.documents.select(F.col("source").alias("issue_id"), "text")
    issues = docs.select("issue_id").distinct().withColumn("title", F.struct(F.concat(F.lit("Feed "), "issue_id").alias("en-SG")))
    impact = t.documents.select(F.col("source").alias("issue_id"), F.struct(F.col("lang").alias("service_id"), null("string").alias("station_id")).alias("entity"),
                                null("array<struct<station_id:string,from_station_id:string,to_station_id:string>>").alias("service_scopes"))
    return search.search_issues(issues, docs, impact, _PHRASE).select("issue_id", F.round(F.col("score") * 1e6).cast("long").alias("score_ppm"))


# --- rules ----------------------------------------------------------------------

_RULES = [
    # id, hosts, path prefixes, types, priority, export allowed
    ("official", ["therha.example.com", "THTHRE.example.com"], None, ["statement.official"], 10, True),
    ("blog-a", ["blog.tionsh.example.net", "blog.ththan.example.net", "blog.tiontion.example.com"], None, None, 5, True),
    ("blog-b", ["blog.tionsh.example.net"], None, ["report.public"], 5, False),
    ("english", None, ["/en/"], None, 1, True),
    ("french", None, ["fr"], ["report.media"], 2, False),
    ("media", None, None, ["report.media"], None, True),
    ("mobile", ["m.ththth.example.net"], ["/en/1", "/en/2"], None, 20, True),
]


def rules(t):
    rows = [(i, i.title(), h, None, p, e, pr, "generic-web", f"{i}-content", "own", "third-party-content-not-licensed", "Source: {sourceUrl} (" + i + ")", ok)
            for i, h, p, e, pr, ok in _RULES]
    return small_table(t.spark, rows, rights.RULE_COLUMNS)


def page_evidence(t):
    k = F.col("page_id") % 3
    kind = F.when(k == 0, "statement.official").when(k == 1, "report.public").otherwise("report.media")
    url = F.when(F.col("page_id") % 41 == 0, F.lit("not a url")).otherwise(F.col("url"))
    return t.pages.select(F.col("page_id").alias("evidence_id"), url.alias("source_url"), kind.alias("type"), F.col("html").alias("text"))


def _rules_sql():
    lines = []
    for i, h, p, e, pr, ok in _RULES:
        tests = ["true"]
        if h:
            tests.append("host IN (" + ", ".join(f"'{x.lower()}'" for x in h) + ")")
        if p:
            tests.append("(" + " OR ".join(f"starts_with(path, '{x if x.startswith('/') else '/' + x}')" for x in p) + ")")
        if e:
            tests.append("type IN (" + ", ".join(f"'{x}'" for x in e) + ")")
        lines.append(f"SELECT evidence_id, '{i}' AS rule, {pr or 0} AS prio, {str(ok).lower()} AS ok FROM v WHERE coalesce({' AND '.join(tests)}, false)")
    return """u AS (SELECT page_id AS evidence_id, CASE WHEN page_id % 41 = 0 THEN 'not a url' ELSE url END AS source_url, html AS text,
  CASE page_id % 3 WHEN 0 THEN 'statement.official' WHEN 1 THEN 'report.public' ELSE 'report.media' END AS type FROM pages),
v AS (SELECT *, CASE WHEN source_url LIKE '%://%' THEN lower(regexp_extract(source_url, '^[a-z]+://([^/:?#]+)', 1)) END AS host,
  CASE WHEN source_url LIKE '%://%' THEN '/' || regexp_extract(source_url, '^[a-z]+://[^/?#]+/([^?#]*)', 1) END AS path FROM u),
m AS (""" + " UNION ALL ".join(lines) + """),
t AS (SELECT evidence_id, prio, count(*) AS n, min(rule) AS rule, bool_or(ok) AS ok FROM m GROUP BY 1, 2),
b AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY evidence_id ORDER BY prio DESC) = 1),
z AS (SELECT v.*, CASE WHEN b.n = 1 THEN 'resolved' WHEN b.n > 1 THEN 'ambiguous-match' WHEN v.host IS NULL THEN 'invalid-source-url' ELSE 'no-match' END AS status,
  CASE WHEN b.n = 1 THEN b.rule END AS rule, b.n = 1 AND b.ok AS public FROM v LEFT JOIN b USING (evidence_id))"""


@query("match_rules", f"WITH {_rules_sql()} SELECT evidence_id, rule FROM m")
def match(t):
    return rights.match_rules(page_evidence(t), rules(t)).select("evidence_id", F.col("id").alias("rule"))


@query("resolve_rules", f"WITH {_rules_sql()} SELECT evidence_id, status, rule FROM z")
def resolve(t):
    return rights.resolve_rules(page_evidence(t), rules(t)).select("evidence_id", "status", F.col("rule.id").alias("rule"))


@query("redact", f"""WITH {_rules_sql()}
SELECT evidence_id, CASE WHEN public THEN md5(text) ELSE '{rights.REDACTED_TEXT}' END AS text, CASE WHEN public THEN 0 ELSE 1 END AS redacted
FROM (SELECT * REPLACE (coalesce(public, false) AS public) FROM z)""")
def redact(t):
    out = rights.redact(page_evidence(t), rules(t), render=None)
    return out.select("evidence_id", F.when(F.col("redacted"), F.col("text")).otherwise(F.md5("text")).alias("text"), F.col("redacted").cast("int").alias("redacted"))


@query("attribution_index", f"""WITH {_rules_sql()}
SELECT evidence_id, rule, 'Source: ' || source_url || ' (' || rule || ')' AS attribution FROM z WHERE status = 'resolved'""")
def attribution(t):
    return rights.attribution_index(page_evidence(t), rules(t)).select("evidence_id", F.col("source_rule_id").alias("rule"), "attribution")


@query("attribution_counts", f"""WITH {_rules_sql()}
SELECT r.id, CAST(count(z.evidence_id) AS BIGINT) AS evidence_count FROM (VALUES {', '.join(f"('{r[0]}')" for r in _RULES)}) r(id)
LEFT JOIN z ON z.rule = r.id AND z.status = 'resolved' GROUP BY r.id""")
def attribution_totals(t):
    return rights.attribution_counts(rights.attribution_index(page_evidence(t), rules(t)), rules(t)).select("id", "evidence_count")


# --- text -----------------------------------------------------------------------

# wordings that occur in the driver's documents, in the roles of the three pattern classes
_WORDS = {"degraded": [r"\bthere?\b", r"\bth\w+ on\b"], "no_service": [r"\bwith\s+(?:by|of)\b"], "vague_future": [r"\bent\w+ing\b", r"\bis and\b"]}


@query("text_flags", "WITH f AS (SELECT doc_id, " + ", ".join(
    "regexp_matches(text, '(?i)" + "|".join(f"(?:{p})" for p in ps) + f"') AS {n}" for n, ps in _WORDS.items()
) + """ FROM documents) SELECT doc_id, CAST(degraded AS INTEGER) AS degraded, CAST(no_service AS INTEGER) AS no_service,
  CAST(vague_future AS INTEGER) AS vague_future, CAST(degraded AND NOT no_service AND vague_future AS INTEGER) AS degraded_future FROM f""")
def text_flags(t):
    flags = ["degraded", "no_service", "vague_future", "degraded_future"]
    return R.classify_text(t.documents.select("doc_id", "text"), "text", _WORDS).select("doc_id", *[F.col(c).cast("int").alias(c) for c in flags])


@query("slug", """
SELECT p_partkey, trim(regexp_replace(lower(p_name || ' / ' || p_type || ' (' || p_brand || ')'), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM part""")
def slug(t):
    title = F.concat("p_name", F.lit(" / "), "p_type", F.lit(" ("), "p_brand", F.lit(")"))
    return t.part.select("p_partkey", X.slug(title).alias("slug"))


@query("slug_documents", """
SELECT doc_id, nullif(trim(regexp_replace(regexp_replace(nfc_normalize(strip_accents(lower(text))), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), '-'), '') AS slug
FROM documents""")
def slug_documents(t):
    """Whole texts as titles, so accents go through the decomposition."""
    return t.documents.select("doc_id", X.slug("text").alias("slug"))


@query("issue_ids", """
WITH s AS (SELECT o_orderkey, o_orderdate, trim(regexp_replace(lower(o_orderpriority || ' ' || o_orderstatus), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM orders)
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') || '-' || slug AS issue_id,
  'issue/' || strftime(o_orderdate, '%Y/%m') || '/' || strftime(o_orderdate, '%Y-%m-%d') || '-' || slug AS path FROM s""")
def issue_ids(t):
    built = X.issue_id(F.to_date("o_orderdate"), F.concat_ws(" ", "o_orderpriority", "o_orderstatus"))
    return t.orders.select("o_orderkey", built.alias("issue_id")).withColumn("path", X.issue_path("issue_id"))


@query("natural_sort", """
SELECT c_nationkey, c_custkey, 'Exit ' || (c_custkey % 120) || chr(CAST(65 + c_custkey % 3 AS INTEGER)) AS label,
  row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey % 120, c_custkey % 3, c_custkey) AS place FROM customer""")
def natural_sort(t):
    """Place of every exit of a nation by natural label order."""
    label = F.concat(F.lit("Exit "), (F.col("c_custkey") % 120).cast("string"), F.char(65 + F.col("c_custkey") % 3))
    rows = t.customer.select("c_nationkey", "c_custkey", label.alias("label")).withColumn("_key", X.natural_key("label"))
    # nations are few and may hold any number of customers, so labels are cut by their sort key
    return ordered.uncut(ordered.rank(ordered.cut(rows, ["c_nationkey"], "_key"), ["c_nationkey"], ["_key", "c_custkey"], "place")).drop("_key")


@query("usage_cost", """
WITH p AS (SELECT * FROM (VALUES ('user', 2.5, 0.25, 15.0), ('assistant', 0.75, 0.075, 4.5)) v(model, i, c, o)),
u AS (SELECT conv_id, role AS model, length(text) AS n, length(text) // 3 AS cached, length(text) // 2 - 40 AS out FROM conversations)
SELECT conv_id, CAST(sum(n) AS BIGINT) AS input_tokens, CAST(sum(n + out) AS BIGINT) AS total_tokens,
  CASE WHEN count(*) FILTER (p.model IS NULL) = 0 THEN CAST(round(sum((n - cached) * i + cached * c + greatest(out, 0) * o)) AS BIGINT) END AS cost_micro_usd,
  coalesce(string_agg(DISTINCT u.model, ',') FILTER (p.model IS NULL), '') AS unpriced
FROM u LEFT JOIN p ON p.model = u.model GROUP BY conv_id""")
def usage_cost(t):
    n = F.length("text").cast("long")
    usage = t.conversations.select("conv_id", F.col("role").alias("model"), n.alias("input_tokens"), F.floor(n / 3).alias("cached_tokens"),
                                   (F.floor(n / 2) - 40).alias("output_tokens"), (n + F.floor(n / 2) - 40).alias("total_tokens"))
    pricing = small_table(t.spark, [("user", 2.5, 0.25, 15.0), ("assistant", 0.75, 0.075, 4.5)], "model string, input_usd double, cached_usd double, output_usd double")
    return V.usage_cost(usage, pricing, ["conv_id"]).select(
        "conv_id", "input_tokens", "total_tokens", F.round(F.col("cost_usd") * 1e6).cast("long").alias("cost_micro_usd"),
        F.array_join("models_without_pricing", ",").alias("unpriced"))


@query("regression_eval", """
WITH c AS (SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events),
x AS (SELECT user_id AS id, bool_or(CAST(json_extract(props, '$.k') AS INTEGER) = 7) AS has7,
    bool_or(event_type = 'error' AND CAST(json_extract(props, '$.k') AS INTEGER) = 13) AS bad, arg_max(event_type, event_id) AS last FROM events GROUP BY 1)
SELECT id, NULL AS assertion, CASE WHEN last = 'purchase' THEN NULL ELSE 'Expected outcome purchase, received ' || last END AS message FROM x WHERE last <> 'purchase'
UNION ALL SELECT id, 1, 'Missing event matching {"props":{"k":7}}' FROM x WHERE NOT has7
UNION ALL SELECT id, 2, 'Found forbidden event matching {"type":"error","props":{"k":13}}' FROM x WHERE bad""")
def regression_eval(t):
    """Users as cases, their events as candidates, two assertions per case."""
    users = t.events.groupBy(F.col("user_id").alias("id")).agg(F.max_by("event_type", "event_id").alias("actual_kind"))
    null = F.lit(None).cast("string")
    fields = lambda p: [null.alias(f"{p}_{f}") for f in ("issue_type", "issue_id", "reason")]
    cases = users.select("id", F.lit("purchase").alias("expected_kind"), *fields("expected"))
    outcomes = users.select("id", "actual_kind", *fields("actual"))
    wanted = F.array(
        F.struct(F.lit(1).alias("assertion"), F.lit("event").alias("kind"), F.lit("required").alias("presence"), F.lit('{"props":{"k":7}}').alias("match")),
        F.struct(F.lit(2).alias("assertion"), F.lit("event").alias("kind"), F.lit("forbidden").alias("presence"), F.lit('{"type":"error","props":{"k":13}}').alias("match")))
    assertions = users.select("id", F.inline(wanted))
    body = F.concat(F.lit('{"type":"'), "event_type", F.lit('","props":'), "props", F.lit("}"))
    candidates = t.events.select(F.col("user_id").alias("id"), F.lit("event").alias("kind"), body.alias("body"))
    return V.evaluate(cases, outcomes, assertions, candidates).select("id", "assertion", "message")


_LOCAL = "strftime({}, '%Y-%m-%dT%H:%M:%S') || '+08:00'"


@query("stop_texts", f"""WITH s AS (SELECT *, o_orderdate AS a, o_orderdate + INTERVAL 3 DAY AS z FROM orders)
SELECT 'o' || o_orderkey AS issue_id, 'service:' || o_custkey AS entity_key, 'service' AS entity_type, CASE WHEN o_orderkey % 5 = 0 THEN 'null' ELSE 'delay' END AS effect,
  CASE o_orderkey % 3 WHEN 0 THEN 'service.whole' WHEN 1 THEN 'service.point (' || o_orderstatus || '); service.whole' ELSE 'service.segment (' || o_orderstatus || ' → ' || o_orderpriority || ')' END AS scopes,
  CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN '[0] fixed: ' || {_LOCAL.format('a')} || ' → ongoing'
    WHEN 2 THEN '[0] fixed: ' || {_LOCAL.format('a')} || ' → ' || {_LOCAL.format('z')} || '; [1] recurring daily: ' || {_LOCAL.format('a')} || '–' || {_LOCAL.format('z')} || ' 22:00:00–23:30:00'
    ELSE '[0] recurring daily: ' || {_LOCAL.format('a')} || '–ongoing' END AS periods,
  o_orderpriority AS causes, CASE WHEN o_orderkey % 2 = 0 THEN 'x' || o_orderkey ELSE 'x' || o_orderkey || ', y' || o_orderkey END AS evidence_ids FROM s""")
def stop_texts(t):
    """State report over the orders: every form of scope and period, open and closed, and evidence named more than once."""
    null = lambda c: F.lit(None).cast(c)
    key, end = F.col("o_orderkey"), sgt(F.col("o_orderdate") + F.expr("interval 3 days"))
    scope = lambda kind, station=null("string"), a=null("string"), z=null("string"): F.struct(
        F.lit(kind).alias("type"), a.alias("from_station_id"), z.alias("to_station_id"), station.alias("station_id"))
    period = lambda kind, end, window=False: F.struct(
        F.lit(kind).alias("kind"), sgt("o_orderdate").alias("start_at"), end.alias("end_at"), (F.lit("daily") if kind == "recurring" else null("string")).alias("frequency"),
        null("array<string>").alias("days_of_week"), *[(F.lit(w) if window else null("string")).alias(f"window_{n}") for n, w in (("start", "22:00:00"), ("end", "23:30:00"))])
    one, two = F.concat(F.lit("x"), key), F.when(key % 2 == 0, F.concat(F.lit("x"), key)).otherwise(F.concat(F.lit("y"), key))
    state = t.orders.select(
        F.concat(F.lit("o"), "o_orderkey").alias("issue_id"), F.concat(F.lit("service:"), "o_custkey").alias("entity_key"),
        F.struct(F.lit("service").alias("type")).alias("entity"),
        F.struct(F.when(key % 5 != 0, F.lit("delay")).alias("kind"), null("string").alias("duration")).alias("effect"),
        F.when(key % 3 == 0, F.array(scope("service.whole"))).when(key % 3 == 1, F.array(scope("service.point", F.col("o_orderstatus")), scope("service.whole")))
        .otherwise(F.array(scope("service.segment", a=F.col("o_orderstatus"), z=F.col("o_orderpriority")))).alias("scopes"),
        F.when(key % 4 == 1, F.array(period("fixed", null("timestamp")))).when(key % 4 == 2, F.array(period("fixed", end), period("recurring", end, True)))
        .when(key % 4 == 3, F.array(period("recurring", null("timestamp")))).otherwise(F.array().cast("array<struct<kind:string,start_at:timestamp,end_at:timestamp,frequency:string,days_of_week:array<string>,window_start:string,window_end:string>>")).alias("periods"),
        F.array(F.col("o_orderpriority")).alias("causes"),
        one.alias("effect_evidence_id"), two.alias("scopes_evidence_id"), one.alias("periods_evidence_id"), null("string").alias("causes_evidence_id"))
    return V.state_report(state)


def order_cases(t):
    """Orders as regression cases labelled by priority and, every third, by `slow`; their customer stands for the id."""
    labels = F.array_compact(F.array(F.col("o_orderpriority"), F.when(F.col("o_orderkey") % 3 == 0, "slow")))
    return t.orders.select(F.concat(F.lit("c"), "o_custkey").alias("id"), F.concat(F.lit("cases/"), "o_orderkey").alias("path"), labels.alias("labels"),
                           F.lower("o_orderstatus").alias("role"), F.lit("create").alias("observed_kind"), F.when(F.col("o_orderkey") % 2 == 0, "create").otherwise("update").alias("expected_kind"))


@query("filter_cases", """SELECT 'cases/' || o_orderkey AS path, 'c' || o_custkey || ' [' || lower(o_orderstatus) || '] create -> ' || CASE WHEN o_orderkey % 2 = 0 THEN 'create' ELSE 'update' END
  || ' (' || o_orderpriority || ', slow)' AS summary FROM orders WHERE o_orderkey % 3 = 0""")
def filter_cases(t):
    return V.filter_cases(order_cases(t), label="slow").select("path", "summary")


@query("duplicate_cases", """SELECT 'c' || o_custkey AS id, count(*) AS cases FROM orders GROUP BY 1 HAVING count(*) > 1""")
def duplicate_cases(t):
    """Ids that several cases have; a case after the first is a finding."""
    found = V.duplicate_cases(order_cases(t))
    return found.groupBy("id").agg((F.count(F.lit(1)) + 1).alias("cases"))


__all__ = ["hits", "incident_tables", "page_evidence", "rules", "sgt_text", "windows"]
