"""Networks: orders as service paths, their items as stops."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.operators import network as N
from faultline.operators import platforms as P
from faultline.queries.registry import query, sql_text

# a stop's place is its line number, then its part, in digits of fixed length, so equal places are equal stations
_STOPS_SQL = """s AS (SELECT l_orderkey AS service_id, 'L' || (l_orderkey % 40) AS line_id, 'p' || l_partkey AS station_id,
  lpad(CAST(l_linenumber AS VARCHAR), 10, '0') || lpad(CAST(l_partkey AS VARCHAR), 19, '0') AS pos, o_orderdate AS start_at,
  CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate + to_days(CAST(300 + o_orderkey % 90 AS INTEGER)) END AS end_at
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey)"""
_PAIRS_SQL = "SELECT *, lead(station_id) OVER (PARTITION BY service_id ORDER BY pos) AS nxt FROM {}"


def path_stops(t):
    end = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderdate") + F.make_dt_interval(days=(300 + F.col("o_orderkey") % 90).cast("int")))
    items = t.lineitem.join(t.orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    return items.select(
        F.col("l_orderkey").alias("service_id"), F.concat(F.lit("L"), F.col("l_orderkey") % 40).alias("line_id"), F.lit(0).alias("rev_pos"),
        F.concat(F.lit("p"), "l_partkey").alias("station_id"), F.concat(F.lpad(F.col("l_linenumber").cast("string"), 10, "0"), F.lpad(F.col("l_partkey").cast("string"), 19, "0")).alias("pos"),
        F.col("o_orderdate").alias("start_at"), end.alias("end_at"))


def _ntz(s):
    return F.to_timestamp_ntz(F.lit(s))


@query("adjacent_pairs", f"WITH {_STOPS_SQL}, n AS ({_PAIRS_SQL.format('s')}) SELECT service_id, pos, station_id, nxt AS next_station_id FROM n WHERE nxt IS NOT NULL")
def adjacent_pairs(t):
    return N.adjacent_pairs(path_stops(t), ["service_id"], "pos", "station_id").select("service_id", "pos", "station_id", "next_station_id")


@query("edges", f"""WITH {_STOPS_SQL}, n AS ({_PAIRS_SQL.format('s')})
SELECT least(station_id, nxt) || ':' || greatest(station_id, nxt) AS edge, count(*) AS sources, arg_min(station_id, (service_id, pos, station_id, nxt)) AS from_id
FROM n WHERE nxt IS NOT NULL GROUP BY 1""")
def edges(t):
    pairs = N.adjacent_pairs(path_stops(t), ["service_id"], "pos", "station_id")
    return N.edges(pairs, "station_id", "next_station_id", ["service_id", "pos", "station_id", "next_station_id"]).select("edge", "sources", "from_id")


@query("path_features", f"""WITH {_STOPS_SQL}
SELECT service_id, pos, station_id, count(*) OVER (PARTITION BY service_id, station_id) AS occurrences,
  CAST(pos = min(pos) OVER (PARTITION BY service_id) AS INTEGER) AS is_first, CAST(pos = max(pos) OVER (PARTITION BY service_id) AS INTEGER) AS is_last FROM s""")
def path_features(t):
    out = N.path_features(path_stops(t).select("service_id", "pos", "station_id"), ["service_id"], "pos", "station_id")
    return out.withColumn("is_first", F.col("is_first").cast("int")).withColumn("is_last", F.col("is_last").cast("int"))


_AT = "1998-06-01 00:00:00"


def _topology(t):
    codes = t.part.select(
        F.concat(F.lit("p"), "p_partkey").alias("station_id"), F.lit(0).alias("pos"), F.col("p_brand").alias("line_id"), F.concat(F.lit("C"), "p_partkey").alias("code"),
        _ntz("1990-01-01 00:00:00").alias("start_at"), F.when(F.col("p_partkey") % 4 == 0, _ntz("1998-01-01 00:00:00")).alias("end_at"))
    return N.topology(path_stops(t), codes, _ntz(_AT))


_LIVE_SQL = f"{_STOPS_SQL}, v AS (SELECT * FROM s WHERE start_at <= TIMESTAMP '{_AT}' AND (end_at IS NULL OR TIMESTAMP '{_AT}' < end_at))"


@query("topology_edges", f"""WITH {_LIVE_SQL}, n AS ({_PAIRS_SQL.format('v')})
SELECT least(station_id, nxt) || ':' || greatest(station_id, nxt) AS edge, count(*) AS sources FROM n WHERE nxt IS NOT NULL GROUP BY 1""")
def topology_edges(t):
    return _topology(t)["edges"].select("edge", "sources")


@query("topology_stations", f"""WITH {_LIVE_SQL}, c AS (SELECT 'p' || p_partkey AS station_id FROM part WHERE p_partkey % 4 <> 0)
SELECT station_id, 'code_only' AS side FROM c WHERE station_id NOT IN (SELECT station_id FROM v)
UNION ALL SELECT DISTINCT station_id, 'path_only' FROM v WHERE station_id NOT IN (SELECT station_id FROM c)""")
def topology_stations(t):
    topo = _topology(t)
    return topo["code_only"].withColumn("side", F.lit("code_only")).unionByName(topo["path_only"].withColumn("side", F.lit("path_only")))


# parts as services of one to three revisions, each with a short path
_REVISIONS_SQL = """rv AS (SELECT p_partkey AS k, i AS rev, TIMESTAMP '1995-01-01' + to_days(CAST(200 * i + p_partkey % 300 AS INTEGER)) AS a,
  CASE WHEN (p_partkey + i) % 3 > 0 THEN TIMESTAMP '1995-01-01' + to_days(CAST(200 * i + p_partkey % 300 + 400 AS INTEGER)) END AS z
  FROM part, range(3) r(i) WHERE i <= p_partkey % 3),
live AS (SELECT * FROM rv WHERE a <= TIMESTAMP '1996-06-01' AND (z IS NULL OR TIMESTAMP '1996-06-01' < z))"""


def part_documents(t):
    """Parts as service documents."""
    start = lambda i: _ntz("1995-01-01 00:00:00") + F.make_dt_interval(days=(i * 200 + F.col("p_partkey") % 300).cast("int"))
    hours = F.struct(F.lit("05:30").alias("start"), F.lit("23:30").alias("end"))
    revision = lambda i: F.struct(
        F.concat(F.lit("r"), i).alias("id"), start(i).alias("startAt"), F.when((F.col("p_partkey") + i) % 3 > 0, start(i) + F.expr("interval 400 days")).alias("endAt"),
        F.struct(F.transform(F.sequence(F.lit(0), i), lambda n: F.struct(F.concat(F.lit("p"), F.col("p_partkey") + n).alias("stationId"))).alias("stations")).alias("path"),
        F.struct(hours.alias("weekdays"), hours.alias("weekends")).alias("operatingHours"))
    return t.part.select(F.concat(F.lit("p"), "p_partkey").alias("id"), F.col("p_brand").alias("lineId"),
                         F.transform(F.sequence(F.lit(0), (F.col("p_partkey") % 3).cast("int")), revision).alias("revisions"))


@query("active_revision", f"WITH {_REVISIONS_SQL} SELECT 'p' || k AS service_id, max(rev) AS rev_pos, count(*) AS active FROM live GROUP BY k")
def active_revision(t):
    at = _ntz("1996-06-01 00:00:00")
    last, many = N.active_revision(part_documents(t), at)
    return last.join(many, "service_id", "left").select("service_id", F.col("rev_pos").cast("long"), F.coalesce("active", F.lit(1)).cast("long").alias("active"))


@query("services_at", f"""WITH {_REVISIONS_SQL}, l AS (SELECT k, max(rev) AS rev FROM live GROUP BY k)
SELECT 'p' || k AS service_id, p_brand AS line_id, rev + 1 AS stops, array_to_string(list_transform(range(rev + 1), lambda n: 'p' || (k + n)), '→') AS path,
  '05:30-23:30' AS weekdays, '05:30-23:30' AS weekends FROM l JOIN part ON p_partkey = k""")
def services_at(t):
    return N.services_at(part_documents(t), _ntz("1996-06-01 00:00:00")).withColumn("stops", F.col("stops").cast("long"))


@query("stations_at", """
SELECT 's' || s_suppkey AS station_id, s_name AS name, CASE WHEN s_suppkey % 4 = 0 THEN 'A' || s_suppkey ELSE 'A' || s_suppkey || ', B' || s_suppkey END AS codes,
  CASE WHEN s_suppkey % 4 = 0 OR s_nationkey = 0 THEN 'L0' ELSE 'L0, L' || s_nationkey END AS lines FROM supplier""")
def stations_at(t):
    code = lambda tag, line, end: F.struct(F.concat(F.lit(tag), "s_suppkey").alias("code"), line.alias("lineId"), _ntz("1990-01-01 00:00:00").alias("startedAt"), end.alias("endedAt"))
    codes = F.array(code("A", F.lit("L0"), F.lit(None).cast("timestamp_ntz")), code("B", F.concat(F.lit("L"), "s_nationkey"), F.when(F.col("s_suppkey") % 4 == 0, _ntz("1996-06-01 00:00:00"))))
    stations = t.supplier.select(F.concat(F.lit("s"), "s_suppkey").alias("id"), F.struct(F.col("s_name").alias("en-SG")).alias("name"), codes.alias("stationCodes"))
    return N.stations_at(stations, _ntz("1996-06-01 00:00:00"))


@query("topology_in_month", f"""WITH {_STOPS_SQL}, v AS (SELECT * FROM s WHERE start_at < TIMESTAMP '1998-03-01' AND (end_at IS NULL OR TIMESTAMP '1998-02-01' < end_at)),
n AS ({_PAIRS_SQL.format('v')})
SELECT line_id, least(station_id, nxt) || ':' || greatest(station_id, nxt) AS edge, count(*) AS sources FROM n WHERE nxt IS NOT NULL GROUP BY 1, 2""")
def topology_in_month(t):
    return N.topology_in_month(path_stops(t), "1998-02").select("line_id", "edge", "sources")


@query("active_codes", f"""WITH {_STOPS_SQL}
SELECT station_id, line_id, min_by('o' || service_id, (service_id, pos)) AS code FROM s
WHERE start_at < TIMESTAMP '1998-03-01' AND (end_at IS NULL OR TIMESTAMP '1998-02-01' < end_at) GROUP BY 1, 2""")
def active_codes(t):
    codes = path_stops(t).select("station_id", "line_id", F.concat(F.lit("o"), "service_id").alias("code"), F.struct("service_id", "pos").alias("pos"), "start_at", "end_at")
    return N.active_codes(codes, "1998-02")


@query("services_towards", f"""WITH {_STOPS_SQL}, p AS (SELECT p_partkey AS pair_id, 'p' || p_partkey AS a, 'p' || (p_partkey + 1) AS b FROM part),
x AS (SELECT pair_id, service_id, min(pos) FILTER (station_id = a) AS f, max(pos) FILTER (station_id = b) AS l FROM s JOIN p ON station_id IN (a, b) GROUP BY 1, 2)
SELECT pair_id, service_id FROM x WHERE f < l""".replace("FROM s JOIN p ON station_id IN (a, b)", "FROM (SELECT s.*, p.* FROM s JOIN p ON station_id = a UNION ALL SELECT s.*, p.* FROM s JOIN p ON station_id = b)"))
def services_towards(t):
    """For each part the orders that pass it before the next part."""
    pairs = t.part.select(F.col("p_partkey").alias("pair_id"), F.concat(F.lit("p"), "p_partkey").alias("from_id"), F.concat(F.lit("p"), F.col("p_partkey") + 1).alias("to_id"))
    return N.services_towards(path_stops(t), pairs, "service_id", "pos", "station_id")


@query("shortest_paths", f"""WITH RECURSIVE {_STOPS_SQL}, n AS ({_PAIRS_SQL.format('s')}),
d AS (SELECT DISTINCT station_id AS a, nxt AS b FROM n WHERE nxt IS NOT NULL AND station_id <> nxt
  UNION SELECT DISTINCT nxt, station_id FROM n WHERE nxt IS NOT NULL AND station_id <> nxt),
r(node, hops, path) USING KEY (node) AS (SELECT b, 0, [b] FROM d WHERE b = 'p0' GROUP BY b
  UNION SELECT d.b, min(r.hops + 1), min(list_append(r.path, d.b)) FROM r JOIN d ON d.a = r.node
    WHERE NOT EXISTS (FROM recurring.r known WHERE known.node = d.b) GROUP BY d.b)
SELECT node, CAST(hops AS BIGINT) AS hops, array_to_string(path, '→') AS path FROM r""")
def shortest_paths(t):
    """The path from the first part to every part over all orders."""
    pairs = N.adjacent_pairs(path_stops(t), ["service_id"], "pos", "station_id")
    near = N.both_ways(pairs.select("station_id", "next_station_id"), "station_id", "next_station_id")
    paths = N.shortest_paths(near, near.filter("node = 'p0'").select(F.col("node").alias("source")))
    return paths.select("node", F.col("hops").cast("long").alias("hops"), F.array_join("path", "→").alias("path"))


@query("components", f"""WITH RECURSIVE e AS (SELECT 'n' || n_nationkey AS a, 'r' || n_regionkey AS b FROM nation UNION SELECT 'r' || n_regionkey, 'n' || n_nationkey FROM nation
  UNION SELECT 'c' || c_custkey, 'n' || c_nationkey FROM customer UNION SELECT 'n' || c_nationkey, 'c' || c_custkey FROM customer),
r(node, l) AS (SELECT a, a FROM e UNION SELECT e.b, r.l FROM r JOIN e ON e.a = r.node)
SELECT node, min(l) AS component FROM r GROUP BY node""".replace("(SELECT a, a FROM e UNION", "(SELECT a, a FROM e WHERE a LIKE 'r%' OR a LIKE 'c%' UNION"))
def components(t):
    """Customers, nations and regions fall apart into one component per region."""
    text = lambda p, c: F.concat(F.lit(p), c)
    rows = t.nation.select(text("n", "n_nationkey").alias("a"), text("r", "n_regionkey").alias("b")).unionByName(
        t.customer.select(text("c", "c_custkey").alias("a"), text("n", "c_nationkey").alias("b")))
    return N.components(N.both_ways(rows, "a", "b"), []).select("node", "component")


@query("line_order")
def line_order(t):
    """Each customer's order months as a line; consecutive orders are its edges."""
    rows = t.orders.select(F.concat(F.lit("c"), "o_custkey").alias("line_id"), "o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("station_id"))
    pairs = N.adjacent_pairs(rows, ["line_id"], "o_orderkey", "station_id")
    edge = N.edges(pairs, "station_id", "next_station_id", ["o_orderkey"], ["line_id"]).filter("from_id <> to_id")
    reference = rows.select("line_id", F.lit("p").alias("path_id"), F.col("o_orderkey").alias("pos"), "station_id")
    return N.line_order(edge, reference)


@query("preferred_order", """SELECT p_partkey, p_type, CASE p_type WHEN 'PROMO' THEN 0 WHEN 'SMALL' THEN 1 WHEN 'LARGE' THEN 2 END AS rank FROM part""")
def preferred_order(t):
    return N.preferred_order(t.part.select("p_partkey", "p_type"), "p_type", ["PROMO", "SMALL", "LARGE"])


# --- platforms ----------------------------------------------------------------------

_OBS_SQL = f"{_STOPS_SQL}, q AS (SELECT DISTINCT l_orderkey AS service_id, 'p' || l_partkey AS station_id FROM lineitem WHERE l_quantity > 30)"


def observations(t):
    """Big items as sightings of an order's platform: label by order parity."""
    seen = t.lineitem.filter("l_quantity > 30").join(t.orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    return seen.select(
        F.col("l_orderkey").alias("s"), F.concat(F.lit("p"), "l_partkey").alias("station_id"), "o_orderdate").distinct().select(
        F.concat_ws("/", "s", "station_id").alias("obs_id"), "station_id", F.concat(F.lit("L"), F.col("s") % 40).alias("line_id"),
        F.when(F.col("s") % 2 == 0, "A").otherwise("B").alias("platform_label"), F.lit(None).cast("string").alias("towards_station_id"),
        F.array("s").alias("service_ids"), F.col("o_orderdate").alias("observed_at"))


def _network(t):
    stops = path_stops(t)
    since = _ntz("2010-01-01 00:00:00")
    revisions = t.orders.select(F.col("o_orderkey").alias("service_id"), F.concat(F.lit("L"), F.col("o_orderkey") % 40).alias("line_id"), F.lit(0).alias("rev_pos"),
                                F.col("o_orderdate").alias("start_at"), F.lit(None).cast("timestamp_ntz").alias("end_at"))
    codes = stops.select("station_id", "line_id").distinct().select(
        "station_id", "line_id", F.lit(0).alias("pos"), _ntz("1990-01-01 00:00:00").alias("start_at"), F.lit(None).cast("timestamp_ntz").alias("end_at"))
    net = {"revisions": revisions, "stops": stops.select("service_id", "rev_pos", "pos", "station_id"), "codes": codes,
           "stations": t.part.select(F.concat(F.lit("p"), "p_partkey").alias("station_id"))}
    return net, stops.select("line_id").distinct(), since


@query("merge_observations", f"""WITH {_OBS_SQL}
SELECT q.station_id, 'L' || (q.service_id % 40) AS line_id, CASE WHEN q.service_id % 2 = 0 THEN 'A' ELSE 'B' END AS platform_label, count(*) AS services,
  {sql_text('max(o_orderdate)')} AS last_updated FROM q JOIN orders ON o_orderkey = q.service_id GROUP BY 1, 2, 3""")
def merge_observations(t):
    resolved = observations(t).select("*", F.col("service_ids")[0].alias("service_id"))
    return P.merge_observations(resolved).select("station_id", "line_id", "platform_label", F.size("service_ids").alias("services"),
                                                 F.date_format("last_updated", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("last_updated"))


@query("infer_platforms_skipped", f"""WITH {_OBS_SQL},
b AS (SELECT *, min(pos) OVER (PARTITION BY service_id) AS lo, max(pos) OVER (PARTITION BY service_id) AS hi FROM s),
v AS (SELECT line_id, station_id, service_id, count(*) AS n, bool_or(pos IN (lo, hi)) AS e FROM b GROUP BY 1, 2, 3),
m AS (SELECT v.*, v.service_id IN (SELECT service_id FROM q) AS mapped FROM v WHERE line_id IN (SELECT 'L' || (service_id % 40) FROM q)),
f AS (SELECT station_id, line_id, CASE WHEN bool_or(n > 1) THEN 'service_repeats_station' WHEN bool_or(e) THEN 'service_endpoint' WHEN bool_or(NOT mapped) THEN 'unmapped_services'
  WHEN count(DISTINCT service_id % 2) < 2 THEN 'fewer_than_two_inferred_platforms' END AS reason FROM m GROUP BY 1, 2)
SELECT * FROM f WHERE reason IS NOT NULL""")
def infer_platforms(t):
    net, lines, as_of = _network(t)
    return P.infer_platforms(observations(t), net, lines, as_of)["skipped"]


@query("infer_platforms_summary")
def platform_summary(t):
    net, lines, as_of = _network(t)
    return P.infer_platforms(observations(t), net, lines, as_of)["summary"]
