import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from faultline.operators import network as N
from faultline.operators import platforms as P
from faultline.operators import schedule as S
from faultline.queries import QUERIES, registry


def bfs(near, start):
    prev, queue = {start: [start]}, deque([start])
    while queue:
        node = queue.popleft()
        for other in sorted(near[node]):
            if other not in prev:
                prev[other] = prev[node] + [other]
                queue.append(other)
    return prev


def graph(seed, n, m):
    rng = random.Random(seed)
    near = {}
    for _ in range(m):
        a, b = (f"n{rng.randrange(n):02d}" for _ in range(2))
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    return near


def test_shortest_paths_follow_breadth_first_order(spark):
    near = graph(1, 40, 60)
    df = N.both_ways(spark.createDataFrame([(a, b) for a in near for b in near[a]], "a string, b string"), "a", "b")
    sources = sorted(near)[:5]
    got = {(r.source, r.node): r.path for r in N.shortest_paths(df, spark.createDataFrame([(s,) for s in sources], "source string")).collect()}
    assert got == {(s, n): p for s in sources for n, p in bfs(near, s).items()}


def test_paths_of_a_long_chain_by_doubling(spark):
    n = 37
    rows = [("k", f"c{i:02d}", f"c{i + 1:02d}") for i in range(n)] + [("k", "c00", "x"), ("j", "c00", "c01")]
    near = N.both_ways(spark.createDataFrame(rows, "line string, a string, b string"), "a", "b", ["line"])
    start = spark.createDataFrame([("k", "c00"), ("k", "lost")], "line string, source string")
    tree = N.path_tree(near, start, ["line"])
    asked = spark.createDataFrame([("k", "c00", f"c{n}"), ("k", "c00", "c00"), ("k", "c00", "none"), ("j", "c00", "c01")], "line string, source string, node string")
    rows = N.unroll_paths(tree, asked, ["line"]).collect()
    assert sorted((r.node, r.pos, r.station_id) for r in rows) == [("c00", 0, "c00")] + [(f"c{n}", i, f"c{i:02d}") for i in range(n + 1)]
    assert {r.node for r in N.path_tree(near, start, ["line"], 1).filter("source = 'c00'").collect()} == {"c00", "c01", "x"}
    assert {(r.node, tuple(r.path)) for r in N.shortest_paths(near, start, ["line"], asked).collect()} == {("c00", ("c00",)), (f"c{n}", tuple(f"c{i:02d}" for i in range(n + 1)))}


def reference_order(near, paths):
    nodes = sorted(near)
    ends = [n for n in nodes if len(near[n]) <= 1]
    ends = ends if len(ends) >= 2 else nodes
    best = []
    for i, a in enumerate(ends):
        found = bfs(near, a)
        for b in ends[i + 1:]:
            p = found.get(b)
            if p and (len(p) > len(best) or (len(p) == len(best) and "\0".join(p) < "\0".join(best))):
                best = p
    best = best or ends[:1]
    for path in sorted(paths, key=len, reverse=True):
        if best[0] in path and best[-1] in path:
            best = best if path.index(best[0]) <= path.index(best[-1]) else best[::-1]
            break
    seen, order = set(best), list(best)

    def visit(node):
        for other in sorted(near[node]):
            if other not in seen:
                seen.add(other)
                order.append(other)
                visit(other)

    for node in best:
        visit(node)
    return order


def test_line_order_equals_depth_first_reference(spark):
    edges, stops, want = [], [], {}
    for seed in range(5):
        near = graph(seed, 14, 15)
        start = sorted(near)[0]
        inside = set(bfs(near, start))
        near = {a: near[a] for a in inside}
        line = f"L{seed}"
        path = sorted(inside, reverse=True)[: 9 + seed]
        edges += [(line, a, b) for a in near for b in near[a] if a < b]
        stops += [(line, "p0", i, s) for i, s in enumerate(path)]
        want[line] = reference_order(near, [path])
    out = N.line_order(spark.createDataFrame(edges, "line_id string, from_id string, to_id string"),
                       spark.createDataFrame(stops, "line_id string, path_id string, pos int, station_id string"))
    got = {}
    for r in out.orderBy("line_id", "part", "trunk_pos", "entry", "branch_pos").collect():
        got.setdefault(r.line_id, []).append(r.station_id)
    assert got == want


def test_adjacent_pairs_on_hot_path(spark):
    df = spark.createDataFrame([("s", i, f"x{i}") for i in range(200)] + [("t", 1, "a")], "k string, pos long, st string")
    for hot in (20, None):
        got = {(r.st, r.next_st) for r in N.adjacent_pairs(df, ["k"], "pos", "st", hot).collect()}
        assert got == {(f"x{i}", f"x{i + 1}") for i in range(199)}


def network(spark):
    paths = {"s1": "ABCD", "s2": "DCBA", "s3": "ABEA"}
    revisions = spark.createDataFrame([(s, "L", 0, "2020-01-01", None) for s in paths], "service_id string, line_id string, rev_pos int, a string, b string").select(
        "service_id", "line_id", "rev_pos", F.col("a").cast("date").alias("start_at"), F.col("b").cast("date").alias("end_at"))
    stops = spark.createDataFrame([(s, 0, i, st) for s, p in paths.items() for i, st in enumerate(p)], "service_id string, rev_pos int, pos int, station_id string")
    codes = spark.createDataFrame([(s, "L", f"L{i}", "2020-01-01") for i, s in enumerate("ABCDE")] + [("C", "M", "M1", "2020-01-01"), ("F", "L", "L9", "2020-01-01")],
                                  "station_id string, line_id string, code string, a string").select("station_id", "line_id", "code", F.col("a").cast("date").alias("start_at"), F.lit(None).cast("date").alias("end_at"))
    stations = spark.createDataFrame([(s,) for s in "ABCDEF"], "station_id string")
    return {"revisions": revisions, "stops": stops, "codes": codes, "stations": stations}, spark.createDataFrame([("L",)], "line_id string")


def observations(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "obs_id int, station_id string, line_id string, platform_label string, towards_station_id string, service_ids array<string>, d string").withColumn(
        "observed_at", F.to_date("d")).drop("d")


def test_platform_inference(spark):
    net, lines = network(spark)
    as_of = F.to_date(F.lit("2024-06-01"))
    obs = observations(spark, [("B", "L", "A", "D", None, "2024-01-01"), ("C", "L", "B", "A", None, "2024-02-01")])
    out = P.infer_platforms(obs, net, lines, as_of)
    assert out["errors"].count() == 0
    assert {r.station_id: r.reason for r in out["skipped"].collect()} == {
        "A": "service_repeats_station", "B": "unmapped_services", "D": "service_endpoint", "E": "unmapped_services", "F": "no_active_services"}
    assert [(r.station_id, r.interchange, r.status) for r in out["candidates"].collect()] == [("C", True, "review_only")]
    assert {(r.platform_id, tuple(r.service_ids)) for r in out["platforms"].collect()} == {("B_L_A", ("s1",)), ("C_L_B", ("s2",))}


def test_platform_observation_errors(spark):
    net, lines = network(spark)
    bad = observations(spark, [("B", "L", "A", None, ["s1"], "2024-01-01"), ("C", "L", "B", None, ["s1"], "2024-01-01"), ("B", "L", "A", "D", ["s2"], "2024-01-01"),
                               ("Z", "Q", "A", None, None, "2025-01-01"), ("E", "L", "A", None, ["s1"], "2024-01-01"), ("A", "L", "A", None, ["zz"], "2019-01-01"), ("F", "L", "C", "A", None, "2024-01-01")])
    _, errors = P.resolve_observations(bad, net, lines, F.to_date(F.lit("2024-06-01")))
    found = {r.error for r in errors.collect()}
    assert found == {"service maps to several platforms", "service does not travel towards the station", "observation after the service snapshot", "needs towards_station_id or service_ids",
                     "unknown line", "unknown station", "service does not serve the station", "unknown or inactive service", "no active service travels there"}


HW = "struct<min:int,max:int,representative:int>"


def schedule(spark, first, last, periods, default=(60, 1200, 600), calendar="weekday"):
    df = spark.createDataFrame([(first, last, calendar, default, periods)],
                               f"first_train string, last_train string, calendar string, default_headway {HW}, profile_periods array<struct<id:string,day_type:string,start:string,end:string,headway:{HW}>>")
    return S.frequency_windows(df)


def spans(df):
    return [(w.start_s // 60, w.end_s // 60, w.source_period_id) for w in df.first().windows]


def test_windows_clip_wrap_and_report(spark):
    am = ("am", "weekdays", "06:00", "09:00", (120, 180, 150))
    night = ("night", "weekdays", "23:00", "01:00", (300, 600, 400))
    assert spans(schedule(spark, "07:00", "10:00", [am])) == [(420, 540, "am"), (540, 600, None)]
    assert spans(schedule(spark, "22:00", "00:30", [night])) == [(1320, 1380, None), (1380, 1470, "night")]
    assert spans(schedule(spark, "00:15", "02:00", [night])) == [(15, 60, "night"), (60, 120, None)]
    assert spans(schedule(spark, "07:00", "10:00", [am], calendar="saturday")) == [(420, 600, None)]
    assert schedule(spark, "07:00", "10:00", [am, ("x", "weekdays", "08:00", "08:30", (1, 2, 1))]).first().error == "frequency periods overlap"
    assert schedule(spark, "07:00", "07:00", []).first().error is not None and schedule(spark, None, "07:00", []).first().windows == []


def fitting(length, hw, lo, hi):
    """Interval counts by looking at every gap."""
    ideal = max(1, int(length / hw + 0.5))
    for n in sorted(range(max(1, -(-length // hi)), length // lo + 1), key=lambda n: (abs(n - ideal), n)):
        marks = [int(length * i / n / 30 + 0.5) * 30 for i in range(n)] + [length]
        if all(lo <= b - a <= hi for a, b in zip(marks, marks[1:])):
            return marks
    return None


def test_departures_equal_gap_by_gap_search(spark):
    rng = random.Random(9)
    rows = []
    for i in range(300):
        lo = rng.choice([60, 90, 100, 120, 145, 200])
        hi = lo + rng.choice([0, 10, 30, 45, 60, 120])
        rows.append((i, "f", "l", [(0, rng.choice([300, 600, 615, 1000, 3600, 3601, 5000, 7215]), rng.randint(lo, hi), lo, hi, None)], None))
    df = spark.createDataFrame(rows, f"id int, first_train string, last_train string, windows {S.WINDOWS}, error string")
    good, bad = S.departures(df, ["id"])
    got = {}
    for r in good.orderBy("id", "seconds").collect():
        got.setdefault(r.id, []).append(r.seconds)
    want = {i: fitting(w[0][1], *w[0][2:5]) for i, _, _, w, _ in rows}
    assert got == {i: m for i, m in want.items() if m} and {r.id for r in bad.collect()} == {i for i, m in want.items() if not m}


def test_one_impossible_window_refuses_its_schedule(spark):
    fine, bad = (0, 3600, 600, 500, 700, None), (3600, 3615, 600, 500, 700, None)
    rows = [(1, "f", "l", [fine, bad], None), (2, "f", "l", [fine], None), (None, "f", "l", [fine, bad], None), (None, "f", "l", [fine], None)]
    df = spark.createDataFrame(rows, f"id int, first_train string, last_train string, windows {S.WINDOWS}, error string")
    good, failed = S.departures(df, ["id"])
    assert sorted((r.id or 0, r.seconds) for r in good.collect()) == sorted((i, s) for i in (0, 2) for s in range(0, 3601, 600))
    assert sorted((r.id or 0, r.start_s) for r in failed.collect()) == [(0, 3600), (1, 3600)]


def test_departures_of_the_windows_beside_an_impossible_one(spark):
    fine, bad = (0, 3600, 600, 500, 700, None), (3600, 3615, 600, 500, 700, None)
    df = spark.createDataFrame([(1, "f", "l", [fine, bad], None), (2, "f", "l", [fine], None)], f"id int, first_train string, last_train string, windows {S.WINDOWS}, error string")
    good, failed = S.departures(df, ["id"], refuse=False)
    assert sorted((r.id, r.seconds) for r in good.collect()) == [(1, s) for s in range(0, 3600, 600)] + [(2, s) for s in range(0, 3601, 600)]
    assert [(r.id, r.start_s) for r in failed.collect()] == [(1, 3600)]


def test_departures_query_covers_schedules_with_an_impossible_window(spark, tmp_path):
    spark.createDataFrame([(k, 1) for k in range(1, 400)], "c_custkey long, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    bad = {(r.station_id, r.calendar) for r in QUERIES["impossible_windows"](spark, str(tmp_path)).collect()}
    assert bad and bad <= {(r.station_id, r.calendar) for r in QUERIES["departures"](spark, str(tmp_path)).collect()}


def test_departures_bases(spark):
    df = schedule(spark, "06:00", "07:00", [("am", "weekdays", "06:30", "09:00", (500, 700, 600))])
    rows = S.departures(df, [])[0].orderBy("seconds").collect()
    assert [r.time for r in rows] == ["06:00:00", "06:10:00", "06:20:00", "06:30:00", "06:40:00", "06:50:00", "07:00:00"]
    assert [r.basis for r in rows] == ["first_train"] + ["frequency_estimate"] * 5 + ["last_train"]


@pytest.mark.parametrize("at,want", [
    ("05:00", [("06:00:00", "first_train"), ("06:10:00", "frequency_estimate"), ("06:20:00", "frequency_estimate")]),
    ("06:40", [("06:45:00", "frequency_estimate"), ("06:55:00", "frequency_estimate"), ("07:00:00", "last_train")]),
    ("07:00", [("07:00:00", "last_train")]), ("07:00:01", [])])
def test_next_arrivals(spark, at, want):
    df = schedule(spark, "06:00", "07:00", []).withColumn("asked", F.lit(at))
    assert [(r.time, r.basis) for r in S.next_arrivals(df, "asked", []).orderBy("position").collect()] == want


def test_timing_fallback(spark):
    stops = spark.createDataFrame([("S", "a"), ("S", "b")], "station_id string, service_id string")
    timing = spark.createDataFrame([("S", "a", "weekday_saturday", "05:00", "23:00"), ("S", "a", "daily", "06:00", "22:00")],
                                   "station_id string, service_id string, calendar string, first_train string, last_train string")
    got = {(r.service_id, r.calendar): r.first_train for r in S.resolve_timing(stops, timing).collect()}
    assert got[("a", "weekday")] == got[("a", "saturday")] == "05:00" and got[("a", "sunday_public_holiday")] == "06:00" and got[("b", "weekday")] is None


def test_shuffle_partitions_follow_the_tables_read(spark, tmp_path, monkeypatch):
    spark.range(1000).selectExpr("id AS l_orderkey", "id AS l_partkey", "id AS l_linenumber").write.parquet(f"{tmp_path}/lineitem.parquet")
    names = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"]
    number, before = names[0], [spark.conf.get(n) for n in names]
    try:
        size = registry.stored_bytes(spark, f"{tmp_path}/lineitem.parquet")
        monkeypatch.setattr(registry, "PART_BYTES", -(-size // 7))
        for _ in range(2):  # read again, the table counts once
            assert registry.Tables(spark, str(tmp_path)).lineitem.count() == 1000 and spark.conf.get(number) == "7"
        assert int(spark.conf.get(names[1])) <= registry.TASK_BYTES
        registry.fit_partitions(spark, 1)  # small tables have the session's own number again
        assert spark.conf.get(number) == before[0]
        spark.conf.set(number, "9")  # a number set meanwhile is the session's
        registry.fit_partitions(spark, size)
        assert spark.conf.get(number) == "9"
    finally:
        for n, value in zip(names, before):
            spark.conf.set(n, value)


def test_small_graphs_are_walked_without_a_round_per_hop(spark, monkeypatch):
    rows = [("k", f"c{i:02d}", f"c{i + 1:02d}") for i in range(8)] + [("j", a, b) for a, around in graph(2, 12, 20).items() for b in around]
    near = N.both_ways(spark.createDataFrame(rows, "line string, a string, b string"), "a", "b", ["line"])
    start = near.select("line", F.col("node").alias("source")).distinct()
    tables, write = [], N.written
    monkeypatch.setattr(N, "written", lambda df: tables.append(1) or write(df))
    walked = sorted(tuple(r) for r in N.path_tree(near, start, ["line"]).select("line", "source", "node", "hops", "parent").fillna("").collect())
    assert len(tables) < 6
    monkeypatch.setattr(N, "WALK_ROWS", 10)  # now both lines take rounds
    assert sorted(tuple(r) for r in N.path_tree(near, start, ["line"]).select("line", "source", "node", "hops", "parent").fillna("").collect()) == walked


def test_active_stops_stay_dealt_by_service(spark):
    net, _ = network(spark)
    stops = P._active(net, F.to_date(F.lit("2024-06-01")))[2]
    plan = stops._jdf.queryExecution().optimizedPlan().toString()
    assert "(_rev" in plan and stops.count() == 12


def test_repeated_observation_ids_meet_each_others_services_and_dates(spark):
    net, lines = network(spark)
    obs = observations(spark, [("B", "L", "A", None, ["s1"], "2024-01-01"), ("C", "L", "A", None, ["s2", "s2"], "2019-02-01")]).withColumn("obs_id", F.lit(7))
    good, errors = P.resolve_observations(obs, net, lines, F.to_date(F.lit("2024-06-01")))
    assert sorted((r.station_id, r.service_id) for r in good.collect()) == [("B", "s1"), ("B", "s2"), ("C", "s1"), ("C", "s2")]
    assert errors.filter("error like '%inactive on%'").count() == 0
