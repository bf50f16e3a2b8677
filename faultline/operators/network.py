"""Network structure from service paths."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from faultline.functions.temporal import in_month, valid_at
from faultline.functions.text import pair_key
from faultline.lineage import cut_lineage, discard, written
from faultline.operators.graph import contract
from faultline.operators import ordered


def service_stops(services: DataFrame) -> DataFrame:
    """Service documents to one row per stop: service, line, revision, validity, position, station."""
    revisions = services.select(
        F.col("id").alias("service_id"), F.col("lineId").alias("line_id"), F.posexplode("revisions").alias("rev_pos", "rev")
    )
    return revisions.select(
        "service_id", "line_id", "rev_pos", F.col("rev.id").alias("revision_id"),
        F.col("rev.startAt").alias("start_at"), F.col("rev.endAt").alias("end_at"),
        F.posexplode("rev.path.stations").alias("pos", "stop"),
    ).select("*", F.col("stop.stationId").alias("station_id"), F.col("stop.displayCode").alias("display_code")).drop("stop")


def station_codes(stations: DataFrame) -> DataFrame:
    return stations.select(F.col("id").alias("station_id"), F.posexplode("stationCodes").alias("pos", "c")).select(
        "station_id", "pos", F.col("c.lineId").alias("line_id"), F.col("c.code").alias("code"),
        F.col("c.startedAt").alias("start_at"), F.col("c.endedAt").alias("end_at"),
    )


def active_revision(services: DataFrame, at: Column, on_many: str = "last") -> tuple[DataFrame, DataFrame]:
    """P5: (active revision per service, services with several).

    The last active one in array order wins; with `on_many='error'` such services are
    left out of the first table.
    """
    revs = services.select("*", F.posexplode("revisions").alias("rev_pos", "rev")).filter(
        valid_at("rev.startAt", "rev.endAt", at)
    )
    grouped = revs.groupBy("id").agg(
        F.max_by(F.struct("lineId", "rev_pos", "rev"), "rev_pos").alias("_last"), F.count(F.lit(1)).alias("active")
    )
    many = grouped.filter("active > 1").select(F.col("id").alias("service_id"), "active")
    kept = grouped.filter("active = 1") if on_many == "error" else grouped
    return kept.select(
        F.col("id").alias("service_id"), F.col("_last.lineId").alias("line_id"), F.col("_last.rev_pos").alias("rev_pos"),
        F.col("_last.rev").alias("rev"),
    ), many


def adjacent_pairs(
    df: DataFrame, keys: Sequence[str], pos: str, val: str, hot_rows: int | None = ordered.HOT_ROWS
) -> DataFrame:
    """Each stop with the next one of its path as `next_<val>`."""
    rows = ordered.cut(df, keys, pos, hot_rows)
    paired = ordered.uncut(ordered.following(rows, keys, [pos], val, f"next_{val}"))
    return paired.filter(F.col(f"next_{val}").isNotNull())


def path_features(df: DataFrame, keys: Sequence[str], pos: str, station: str) -> DataFrame:
    """Stop sequence, repeats of the station in the path, first and last flags.

    Bounds and repeats are aggregates joined back, not windows over whole paths.
    """
    ends = df.groupBy(*keys).agg(F.min(pos).alias("_lo"), F.max(pos).alias("_hi"))
    seen = df.groupBy(*keys, station).agg(F.count(F.lit(1)).alias("occurrences"))
    rows = df.join(ends, list(keys)).join(seen, [*keys, station])
    return rows.select(
        *df.columns, "occurrences", (F.col(pos) == F.col("_lo")).alias("is_first"), (F.col(pos) == F.col("_hi")).alias("is_last")
    )


def edges(pairs: DataFrame, a: str, b: str, order: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """One row per undirected edge: contributions and the direction first seen in `order`.

    Contributing services stay in long form (`edge_sources`): a list per edge would grow
    with the data.
    """
    keyed = pairs.withColumn("edge", pair_key(a, b))
    return keyed.groupBy(*extra, "edge").agg(
        F.count(F.lit(1)).alias("sources"), F.min_by(F.struct(F.col(a).alias("a"), F.col(b).alias("b")), F.struct(*order)).alias("_f")
    ).select(*extra, "edge", "sources", F.col("_f.a").alias("from_id"), F.col("_f.b").alias("to_id"))


def edge_sources(pairs: DataFrame, a: str, b: str, cols: Sequence[str]) -> DataFrame:
    return pairs.select(pair_key(a, b).alias("edge"), *cols, F.col(a).alias("from_id"), F.col(b).alias("to_id"))


def topology(stops: DataFrame, codes: DataFrame, at: Column) -> dict[str, DataFrame]:
    """N1 on stop and code tables: lines, revisions, stations and edges in force at `at`,
    with code-only and path-only stations.

    stops as `service_stops`, codes as `station_codes`.
    """
    live = stops.filter(valid_at("start_at", "end_at", at))
    coded = codes.filter(valid_at("start_at", "end_at", at)).select("station_id").distinct()
    on_path = live.select("station_id").distinct()
    pairs = adjacent_pairs(live, ["service_id", "rev_pos"], "pos", "station_id")
    return {
        "lines": live.select("line_id").distinct(),
        "revisions": live.select("service_id", "line_id", "rev_pos", "start_at", "end_at").distinct(),
        "stations": on_path,
        "code_only": coded.join(on_path, "station_id", "left_anti"),
        "path_only": on_path.join(coded, "station_id", "left_anti"),
        "edges": edges(pairs, "station_id", "next_station_id", ["service_id", "rev_pos", "pos"]),
        "edge_sources": edge_sources(pairs, "station_id", "next_station_id", ["service_id", "line_id", "rev_pos"]),
    }


def topology_at(services: DataFrame, stations: DataFrame, at: Column) -> dict[str, DataFrame]:
    """N1 on documents."""
    return topology(service_stops(services), station_codes(stations), at)


def _month(df: DataFrame, month: str | Column) -> DataFrame:
    return df.filter(in_month(F.col("start_at").cast("timestamp_ntz"), F.col("end_at").cast("timestamp_ntz"), month))


def topology_in_month(stops: DataFrame, month: str | Column) -> DataFrame:
    """Edges per line of revisions that touch the month."""
    pairs = adjacent_pairs(_month(stops, month), ["service_id", "rev_pos"], "pos", "station_id")
    return edges(pairs, "station_id", "next_station_id", ["service_id", "rev_pos", "pos"], ["line_id"])


def active_codes(codes: DataFrame, month: str | Column) -> DataFrame:
    """First code per (station, line) that is valid in the month."""
    return _month(codes, month).groupBy("station_id", "line_id").agg(F.min_by("code", "pos").alias("code"))


def stations_at(stations: DataFrame, at: Column) -> DataFrame:
    """Stations with the codes and lines valid at an instant."""
    codes = F.filter("stationCodes", lambda c: (c["startedAt"] <= at) & (c["endedAt"].isNull() | (at < c["endedAt"])))
    return stations.select(
        F.col("id").alias("station_id"), F.col("name.`en-SG`").alias("name"),
        F.array_join(F.transform(codes, lambda c: c["code"]), ", ").alias("codes"),
        F.array_join(F.array_distinct(F.transform(codes, lambda c: c["lineId"])), ", ").alias("lines"),
    )


def services_at(services: DataFrame, at: Column, lines: Sequence[str] | None = None) -> DataFrame:
    """Services with the path and hours of their last active revision."""
    chosen = services.filter(F.col("lineId").isin(list(lines))) if lines else services
    active, _ = active_revision(chosen, at)
    path = F.transform("rev.path.stations", lambda s: s["stationId"])
    return active.select(
        "service_id", "line_id", F.size(path).alias("stops"), F.array_join(path, "→").alias("path"),
        *[F.concat_ws("-", f"rev.operatingHours.{d}.start", f"rev.operatingHours.{d}.end").alias(d) for d in ("weekdays", "weekends")],
    )


def services_towards(stops: DataFrame, pairs: DataFrame, service: str, pos: str, station: str) -> DataFrame:
    """(pair_id, service) where some stop at `from_id` precedes some stop at `to_id`.

    Aggregates first position of one end and last of the other, in place of a self-join.
    """
    ends = pairs.select("pair_id", F.inline(F.array(
        F.struct(F.col("from_id").alias("_st"), F.lit(0).alias("_side")), F.struct(F.col("to_id").alias("_st"), F.lit(1).alias("_side"))
    )))
    hits = stops.join(ends, stops[station] == ends["_st"])
    side = lambda i: F.when(F.col("_side") == i, F.col(pos))
    return hits.groupBy("pair_id", service).agg(F.min(side(0)).alias("_a"), F.max(side(1)).alias("_b")).filter(
        "_a < _b"
    ).select("pair_id", service)


def preferred_order(df: DataFrame, value: str, order: Sequence[str], out: str = "rank") -> DataFrame:
    """K3: rank in an explicit list (null when absent); sort by rank nulls last, then value."""
    ranks = F.create_map(*[F.lit(x) for i, v in enumerate(order) for x in (v, i)])
    return df.withColumn(out, F.try_element_at(ranks, F.col(value)))


# --- paths -----------------------------------------------------------------------


def both_ways(edge_df: DataFrame, a: str, b: str, keys: Sequence[str] = ()) -> DataFrame:
    """Undirected edges as directed neighbour rows, each pair once."""
    f = edge_df.select(*keys, F.col(a).alias("node"), F.col(b).alias("neighbour"))
    return f.unionByName(edge_df.select(*keys, F.col(b).alias("node"), F.col(a).alias("neighbour"))).filter(
        "node <> neighbour"
    ).distinct()


#: Graphs of at most so many neighbour rows, and so many times their sources, are walked by one task each.
WALK_ROWS, WALK_STEPS = 10_000, 1_000_000
OUT_BATCH = 4096


def _by_group(df: DataFrame, keys: Sequence[str], walk: Callable[[tuple, Iterable[tuple]], Iterator[tuple]], schema: T.StructType) -> DataFrame:
    """`walk(key, rows)` over each group, whose rows are streamed as tuples in column order, the keys first.

    A task holds one group at a time, and many small groups share a batch.
    """
    arrow = to_arrow_schema(schema)
    pack = lambda out: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    def results(batches):
        out = []
        for key, group in groupby((r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))), key=lambda r: r[:len(keys)]):
            for row in walk(key, group):
                out.append(row)
                if len(out) >= OUT_BATCH:
                    yield pack(out)
                    out = []
        if out:
            yield pack(out)

    rest = [c for c in df.columns if c not in keys]
    # dealt by a hash of the keys: by the keys themselves, Spark leaves the exchange out after a join or union by them, whose partitions may then be merged apart
    return df.select(*keys, *rest).repartition(F.xxhash64(*keys)).sortWithinPartitions(*keys).mapInArrow(results, schema)


def _breadth_first(max_hops: int | None):
    """Walk of one graph from each of its sources; nodes in the order they are met, neighbours in id order."""

    def walk(key, rows):
        near, sources = {}, []
        for *_, node, neighbour, source in rows:
            if neighbour is None:
                sources.append(source)
            else:
                near.setdefault(node, []).append(neighbour)
        for around in near.values():
            around.sort()
        for source in sources:
            seen, level, hops = {source}, [source], 0
            while level and (max_hops is None or hops < max_hops):
                hops, last, level = hops + 1, level, []
                for node in last:
                    for other in near.get(node, ()):
                        if other not in seen:
                            seen.add(other)
                            level.append(other)
                            yield *key, source, other, hops, None, node

    return walk


def _walked(neighbours: DataFrame, sources: DataFrame, keys: Sequence[str], max_hops: int | None, schema: T.StructType) -> tuple[DataFrame, DataFrame, str]:
    """(sources of large graphs, neighbours of these, table of all nodes that sources of small graphs reach)."""
    size = neighbours.groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias("_n")).join(
        sources.groupBy(*keys).agg(F.count(F.lit(1)).alias("_s")), list(keys))
    large = cut_lineage(size.filter((F.col("_n") > WALK_ROWS) | (F.col("_n") * F.col("_s") > WALK_STEPS)).select(*keys))
    kind = schema["source"].dataType
    rows = neighbours.select(*keys, "node", "neighbour", F.lit(None).cast(kind).alias("source")).unionByName(
        sources.dropna(subset=list(keys)).select(*keys, F.lit(None).cast(kind).alias("node"), F.lit(None).cast(kind).alias("neighbour"), "source"))
    small = rows.join(large, list(keys), "left_anti")
    _, path = written(_by_group(small, keys, _breadth_first(max_hops), schema))
    return sources.join(large, list(keys), "left_semi"), neighbours.join(large, list(keys), "left_semi"), path


def path_tree(neighbours: DataFrame, sources: DataFrame, keys: Sequence[str] = (), max_hops: int | None = None) -> DataFrame:
    """N4, first half: every node a source reaches, with its predecessor on the hop-shortest path.

    Columns: keys, source, node, hops, parent. A round numbers the nodes of the round before in breadth-first order (by
    their predecessor's number, then id); a node's predecessor is its neighbour of least number, so no row holds a path.
    `neighbours` has both directions of every edge (`both_ways`): a round's neighbours are then new or of the last two
    rounds, and no round reads all that is reached. Rounds are written tables; their number is the graph's diameter.
    With `keys` the small ones of many graphs are walked whole, each by one task, and only large ones take rounds.
    """
    spark, group = neighbours.sparkSession, [*keys, "source"]
    node = [*group, "node"]
    neighbours, made = written(neighbours)
    kind = sources.schema["source"].dataType
    newest, path = written(sources.select(
        *keys, "source", F.col("source").alias("node"), F.lit(0).alias("hops"), F.lit(1).cast("long").alias("_before"), F.lit(None).cast(kind).alias("parent")).distinct())
    levels, walked, schema = [path], [], newest.schema
    if keys and isinstance(kind, (T.StringType, T.IntegralType)) and neighbours.schema["node"].dataType == kind:
        newest, neighbours, path = _walked(neighbours, newest, keys, max_hops, schema)
        walked = [path]
    known, many = newest.select(*node), newest.count()  # counts come from the files' footers
    while many and (max_hops is None or len(levels) <= max_hops):
        rows = ordered.cut(newest, group, "_before", ordered.HOT_ROWS if many > ordered.HOT_ROWS else None)
        placed = ordered.rank(rows, group, ["_before", "node"], "_place")
        via = F.struct("_place", F.col("node").alias("parent"))
        met = placed.join(neighbours, [*keys, "node"]).select(*group, via.alias("_via"), F.col("neighbour").alias("node"))
        fresh = met.groupBy(*node).agg(F.min("_via").alias("_via")).join(known, node, "left_anti")
        last = newest
        newest, path = written(fresh.select(*node, F.lit(len(levels)).alias("hops"), F.col("_via._place").alias("_before"), F.col("_via.parent").alias("parent")))
        levels.append(path)
        known, many = last.select(*node).unionByName(newest.select(*node)), newest.count()
    discard(spark, [made])
    return spark.read.schema(schema).parquet(*levels, *walked).drop("_before")


def unroll_paths(tree: DataFrame, asked: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """N4, second half: the nodes of the asked (keys, source, node) paths of a `path_tree`, a row each.

    Columns: keys, source, node, hops, pos (0 at the source), station_id. Pointer doubling: round i adds to the known nodes of a path
    those 2^i steps nearer to the source, so rounds grow with the logarithm of the longest asked path. Pairs not reached have no rows.
    """
    spark, group, made, jumps = tree.sparkSession, [*keys, "source"], [], []
    node = [*group, "node"]
    rows = tree.select(*node, "hops").join(asked.select(*node).distinct(), node, "left_semi")
    rows, path = written(rows.select(*node, "hops", F.col("hops").alias("pos"), F.col("node").alias("station_id")))
    up = tree.join(asked.select(*group).distinct(), group, "left_semi").filter("parent is not null").select(*group, F.col("node").alias("station_id"), F.col("parent").alias("_up"))
    longest, reach = rows.agg(F.max("hops")).first()[0] or 0, 1
    while reach <= longest:
        more = rows.join(up, [*group, "station_id"]).select(*node, "hops", (F.col("pos") - reach).alias("pos"), F.col("_up").alias("station_id"))
        rows = rows.unionByName(more)
        reach *= 2
        if reach <= longest:
            made.append(path)
            rows, path = written(rows)
            far = up.select(*group, F.col("station_id").alias("_up"), F.col("_up").alias("_far"))
            up, farther = written(up.join(far, [*group, "_up"]).select(*group, "station_id", F.col("_far").alias("_up")))
            made, jumps = made + jumps, [farther]
    discard(spark, made)
    return rows


def shortest_paths(
    neighbours: DataFrame, sources: DataFrame, keys: Sequence[str] = (), targets: DataFrame | None = None,
    max_hops: int | None = None,
) -> DataFrame:
    """Hop-shortest path from every source to every node it reaches (or to its targets), ties by smaller neighbour id.

    Columns: keys, source, node, hops, path. Only paths that are asked for are written out (`path_tree`, `unroll_paths`).
    """
    tree = path_tree(neighbours, sources, keys, max_hops)
    return whole_paths(tree, tree if targets is None else targets, keys)


def whole_paths(tree: DataFrame, asked: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The asked paths of a `path_tree`, each as a list."""
    rows = unroll_paths(tree, asked, keys)
    inside = F.array_sort(F.collect_list(F.struct("pos", "station_id")))
    return rows.groupBy(*keys, "source", "node", "hops").agg(F.transform(inside, lambda x: x["station_id"]).alias("path"))


def line_trunks(line_edges: DataFrame, line: str = "line_id", a: str = "from_id", b: str = "to_id") -> DataFrame:
    """N5, first half: per line the longest shortest path between terminals, ties by path text.

    Terminals are stations with at most one neighbour; a line with fewer than two of them
    uses all its stations. Of all pairs only lengths are made; the paths of the longest are written out.
    """
    near = both_ways(line_edges, a, b, [line])
    degree = near.groupBy(line, "node").agg(F.count(F.lit(1)).alias("deg"))
    ends = degree.groupBy(line).agg(F.count_if(F.col("deg") <= 1).alias("_t"))
    picked = degree.join(ends, line).filter((F.col("deg") <= 1) | (F.col("_t") < 2)).select(line, F.col("node").alias("source"))
    tree = path_tree(near, picked, [line])
    forward = tree.join(picked.withColumnRenamed("source", "node"), [line, "node"], "left_semi").filter("source < node")
    longest = forward.groupBy(line).agg(F.max("hops").alias("hops"))
    text = F.array_join("path", "\x00")
    best = whole_paths(tree, forward.join(longest, [line, "hops"], "left_semi"), [line]).groupBy(line).agg(F.min_by("path", F.struct(-F.size("path"), text)).alias("trunk"))
    lone = degree.groupBy(line).agg(F.array(F.min("node")).alias("_one"))
    return lone.join(best, line, "left").select(line, F.coalesce("trunk", "_one").alias("trunk"))


def orient_trunks(trunks: DataFrame, reference_stops: DataFrame, line: str = "line_id") -> DataFrame:
    """Turn each trunk into the direction of the longest reference path that has both its ends.

    reference_stops(line, path_id, pos, station_id). Only the first position of the two end
    stations per path is gathered, so paths never stand in one row.
    """
    ends = trunks.select(line, F.element_at("trunk", 1).alias("_f"), F.element_at("trunk", -1).alias("_l"))
    rows = reference_stops.join(ends, line)
    per_path = rows.groupBy(line, "path_id").agg(
        F.count(F.lit(1)).alias("_n"),
        F.min(F.when(F.col("station_id") == F.col("_f"), F.col("pos"))).alias("_pf"),
        F.min(F.when(F.col("station_id") == F.col("_l"), F.col("pos"))).alias("_pl"),
    ).filter("_pf is not null and _pl is not null")
    best = per_path.groupBy(line).agg(F.min_by(F.col("_pf") <= F.col("_pl"), F.struct(-F.col("_n"), F.col("path_id"))).alias("_ok"))
    return trunks.join(best, line, "left").select(
        line, F.when(F.coalesce("_ok", F.lit(True)) | (F.size("trunk") <= 1), F.col("trunk")).otherwise(F.reverse("trunk")).alias("trunk")
    )


def components(near: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Connected components by smallest id, in rounds that grow with the logarithm of their size.

    near(keys, node, neighbour); a node without a neighbour is a component of its own.
    """
    near = cut_lineage(near)
    name = lambda c: F.struct(*keys, F.col(c).alias("id"))
    roots = contract(near.filter("neighbour is not null").select(name("node").alias("a"), name("neighbour").alias("b")))
    roots = roots.select(*[F.col(f"node.{k}").alias(k) for k in keys], F.col("node.id").alias("node"), F.col("root.id").alias("component"))
    nodes = near.select(*keys, "node").distinct()
    return nodes.join(roots, [*keys, "node"], "left").select(*keys, "node", F.coalesce("component", "node").alias("component"))


def _depth_first(key: tuple, rows: Iterable[tuple]) -> Iterator[tuple]:
    """Visit order of one branch; entered at its marked node, neighbours in id order."""
    near: dict[str, list[str]] = {}
    for *_, trunk_pos, entry, node, other in rows:
        if other is not None:
            near.setdefault(node, []).append(other)
    for around in near.values():
        around.sort()
    seen, visit, stack = {entry}, [entry], [iter(near.get(entry, []))]
    while stack:
        step = next((n for n in stack[-1] if n not in seen), None)
        if step is None:
            stack.pop()
        else:
            seen.add(step)
            visit.append(step)
            stack.append(iter(near.get(step, [])))
    for place, station in enumerate(visit, 1):
        yield key[0], trunk_pos, entry, place, station


def line_order(line_edges: DataFrame, reference_stops: DataFrame) -> DataFrame:
    """Stations of each line in order: the oriented trunk, then branches depth-first.

    Sort a line by (part, trunk_pos, entry, branch_pos). Stations off the trunk fall apart
    into branches once the trunk is removed; every branch is reached from the first trunk
    station next to it and walked on its own, so no task holds more than one branch.
    """
    line_edges = cut_lineage(line_edges)
    trunks = cut_lineage(orient_trunks(line_trunks(line_edges), reference_stops))
    spine = trunks.select("line_id", F.posexplode("trunk").alias("trunk_pos", "station_id"))
    near = both_ways(line_edges, "from_id", "to_id", ["line_id"])
    on_trunk = spine.select("line_id", F.col("station_id").alias("node"), "trunk_pos")
    off = near.join(on_trunk, ["line_id", "node"], "left_anti")
    away = off.join(on_trunk.select("line_id", F.col("node").alias("neighbour")), ["line_id", "neighbour"], "left_anti")
    alone = off.select("line_id", "node").distinct().withColumn("neighbour", F.col("node"))
    labels = components(away.unionByName(alone.select(*away.columns)), ["line_id"])
    touching = off.join(
        on_trunk.withColumnRenamed("node", "neighbour"), ["line_id", "neighbour"]
    ).join(labels, ["line_id", "node"])
    entries = touching.groupBy("line_id", "component").agg(F.min(F.struct("trunk_pos", F.col("node").alias("entry"))).alias("_e")).select(
        "line_id", "component", "_e.*"
    )
    walk = labels.join(entries, ["line_id", "component"]).join(away, ["line_id", "node"], "left")
    branches = _by_group(
        walk.select("line_id", "component", "trunk_pos", "entry", "node", "neighbour"), ["line_id", "component"], _depth_first,
        T.StructType.fromDDL("line_id string, trunk_pos int, entry string, branch_pos int, station_id string"))
    main = spine.select("line_id", F.lit(0).alias("part"), "trunk_pos", F.lit("").alias("entry"), F.lit(0).alias("branch_pos"), "station_id")
    return main.unionByName(branches.select("line_id", F.lit(1).alias("part"), "trunk_pos", "entry", "branch_pos", "station_id"))
