"""Platform inference from observations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from faultline.functions.temporal import valid_at
from faultline.lineage import written
from faultline.operators.network import service_stops, services_towards, station_codes


def platform_id(station: Column | str, line: Column | str, label: Column | str) -> Column:
    return F.concat_ws("_", station, line, label)


def network_tables(services: DataFrame, stations: DataFrame) -> dict[str, DataFrame]:
    """Documents as the tables platform inference reads: revisions, stops, codes, stations."""
    revisions = services.select(F.col("id").alias("service_id"), F.col("lineId").alias("line_id"), F.posexplode("revisions").alias("rev_pos", "r"))
    return {
        "revisions": revisions.select("service_id", "line_id", "rev_pos", F.col("r.startAt").alias("start_at"), F.col("r.endAt").alias("end_at")),
        "stops": service_stops(services).select("service_id", "rev_pos", "pos", "station_id"),
        "codes": station_codes(stations), "stations": stations.select(F.col("id").alias("station_id")),
    }


def _active(net: dict[str, DataFrame], as_of: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(services with exactly one active revision, services with several, stops of the former)."""
    live = net["revisions"].filter(valid_at("start_at", "end_at", as_of)).groupBy("service_id").agg(
        F.max_by("line_id", "rev_pos").alias("line_id"), F.max("rev_pos").alias("rev_pos"), F.count(F.lit(1)).alias("_n"))
    one = live.filter("_n = 1").drop("_n")
    stops = net["stops"].withColumnRenamed("rev_pos", "_rev").join(one, "service_id").filter("_rev = rev_pos").drop("_rev")  # by service, as all that follows
    return one, live.filter("_n > 1").select("service_id"), stops


def resolve_observations(
    observations: DataFrame, net: dict[str, DataFrame], lines: DataFrame, as_of: Column
) -> tuple[DataFrame, DataFrame]:
    """(observation, service) rows that stand, and one error row per broken requirement.

    observations(obs_id, station_id, line_id, platform_label, towards_station_id, service_ids,
    observed_at). Services come from the list given, else from those that travel from the
    station towards the named one.
    """
    active, many, stops = _active(net, as_of)
    stations = net["stations"]
    pairs = observations.filter("towards_station_id is not null").select(
        F.col("obs_id").alias("pair_id"), F.col("station_id").alias("from_id"), F.col("towards_station_id").alias("to_id"), F.col("line_id").alias("_line"))
    towards = services_towards(stops, pairs.drop("_line"), "service_id", "pos", "station_id").withColumnRenamed("pair_id", "obs_id")
    towards = towards.join(active.select("service_id", "line_id"), "service_id").join(
        observations.select("obs_id", "line_id"), ["obs_id", "line_id"], "left_semi").select("obs_id", "service_id")
    listed = observations.filter("service_ids is not null").select("obs_id", F.explode(F.array_distinct("service_ids")).alias("service_id"))
    implied = towards.join(listed.select("obs_id").distinct(), "obs_id", "left_anti")
    chosen = listed.unionByName(implied)
    now = active.select("service_id", F.col("line_id").alias("service_line"), F.col("rev_pos").alias("_now"))
    seen_stop = stops.select("service_id", "station_id").distinct().withColumn("_serves", F.lit(True))
    whole = W.partitionBy("obs_id")  # where an id repeats, each of its rows has all services and dates of the id
    given = observations.filter("obs_id is not null").withColumns({
        "_listed": F.flatten(F.collect_list(F.array_distinct("service_ids")).over(whole)), "_dates": F.collect_set("observed_at").over(whole)})
    rows = given.withColumn("service_id", F.explode("_listed")).unionByName(given.filter(F.size("_listed") == 0).join(towards, "obs_id"))
    dated = rows.drop("_listed").join(towards.withColumn("_towards", F.lit(True)), ["obs_id", "service_id"], "left")
    revs = net["revisions"].groupBy("service_id").agg(F.collect_list(F.struct("rev_pos", "start_at", "end_at")).alias("_revs"))  # one document's
    then = F.array_max(F.transform(F.filter("_revs", lambda r: F.exists("_dates", lambda d: valid_at(r["start_at"], r["end_at"], d))), lambda r: r["rev_pos"]))
    rows = dated.join(revs.join(now, "service_id", "left"), "service_id", "left").withColumn("_then", then).drop("_dates", "_revs").join(
        seen_stop, ["service_id", "station_id"], "left")
    fault = (
        F.when(F.col("_now").isNull(), "unknown or inactive service")
        .when(F.col("_then").isNull(), "service inactive on observation date")
        .when(F.col("_then") != F.col("_now"), "service changed revision since the observation")
        .when(F.col("service_line") != F.col("line_id"), "service belongs to another line")
        .when(F.col("_serves").isNull(), "service does not serve the station")
        .when(F.col("towards_station_id").isNotNull() & F.col("_towards").isNull(), "service does not travel towards the station")
    )
    judged = rows.withColumn("error", fault)
    problem = lambda df, text, svc: df.select(F.col("obs_id").cast("string").alias("subject"), svc.alias("service_id"), F.lit(text).alias("error"))
    none = F.lit(None).cast("string")
    checks = [
        judged.filter("error is not null").select(F.col("obs_id").cast("string").alias("subject"), "service_id", "error"),
        problem(observations.filter(F.col("observed_at") > as_of), "observation after the service snapshot", none),
        problem(observations.filter("towards_station_id is null and service_ids is null"), "needs towards_station_id or service_ids", none),
        problem(observations.join(lines.select("line_id"), "line_id", "left_anti"), "unknown line", none),
        problem(observations.join(stations, "station_id", "left_anti"), "unknown station", none),
        problem(observations.filter("towards_station_id is not null").join(
            stations.select(F.col("station_id").alias("towards_station_id")), "towards_station_id", "left_anti"), "unknown towards station", none),
        problem(observations.join(chosen, "obs_id", "left_anti").filter("towards_station_id is not null"), "no active service travels there", none),
        many.select(F.lit(None).cast("string").alias("subject"), "service_id", F.lit("several active revisions").alias("error")),
    ]
    good = judged.filter("error is null").select(*observations.columns, "service_id")
    conflicts = good.groupBy("service_id").agg(F.count_distinct("platform_label").alias("_n")).filter("_n > 1").select(
        none.alias("subject"), "service_id", F.lit("service maps to several platforms").alias("error"))
    return good, reduce(DataFrame.unionByName, [*checks, conflicts])


def merge_observations(resolved: DataFrame) -> DataFrame:
    """Per platform the latest date and its services."""
    return resolved.groupBy("station_id", "line_id", "platform_label").agg(
        F.max("observed_at").alias("last_updated"), F.sort_array(F.collect_set("service_id")).alias("service_ids")
    ).withColumn("platform_id", platform_id("station_id", "line_id", "platform_label"))


def infer_platforms(observations: DataFrame, net: dict[str, DataFrame], lines: DataFrame, as_of: Column) -> dict[str, DataFrame]:
    """Candidates, skipped stations with reason, proposed platforms, their basis, summary and errors.

    The first skip reason that holds is one ordered `when` over aggregates per (station, line).
    """
    resolved, errors = resolve_observations(observations, net, lines, as_of)
    resolved, _ = written(resolved.select("station_id", "line_id", "platform_label", "observed_at", "service_id"))  # read by half a dozen results
    mapping = resolved.groupBy("service_id").agg(F.min("platform_label").alias("label"))
    observed = merge_observations(resolved)
    _, _, stops = _active(net, as_of)
    ends = stops.groupBy("service_id").agg(F.min("pos").alias("_lo"), F.max("pos").alias("_hi"))
    met = stops.groupBy("line_id", "station_id", "service_id").agg(F.count(F.lit(1)).alias("_times"), F.min("pos").alias("_first"), F.max("pos").alias("_last"))
    serving = met.join(ends, "service_id").join(mapping, "service_id", "left").select(
        "line_id", "station_id", "service_id", "_times", ((F.col("_first") == F.col("_lo")) | (F.col("_last") == F.col("_hi"))).alias("_end"), "label")
    serving, _ = written(serving)
    codes = net["codes"].filter(valid_at("start_at", "end_at", as_of))
    per_station = codes.groupBy("station_id").agg(F.count(F.lit(1)).alias("_codes"))
    wanted = codes.select("station_id", "line_id").distinct().join(observations.select("line_id").distinct(), "line_id", "left_semi").join(per_station, "station_id")
    facts = wanted.join(serving, ["station_id", "line_id"], "left").groupBy("station_id", "line_id", "_codes").agg(
        F.count("service_id").alias("services"), F.bool_or(F.col("_times") > 1).alias("_repeats"), F.bool_or("_end").alias("_endpoint"),
        F.bool_or(F.col("service_id").isNotNull() & F.col("label").isNull()).alias("_unmapped"), F.count_distinct("label").alias("_labels"))
    reason = (
        F.when(F.col("services") == 0, "no_active_services").when(F.col("_repeats"), "service_repeats_station")
        .when(F.col("_endpoint"), "service_endpoint").when(F.col("_unmapped"), "unmapped_services")
        .when(F.col("_labels") < 2, "fewer_than_two_inferred_platforms")
    )
    judged = facts.withColumn("reason", reason)
    skipped = judged.filter("reason is not null").select("station_id", "line_id", "reason")
    kept = judged.filter("reason is null").select(
        "station_id", "line_id", (F.col("_codes") > 1).alias("interchange"), (F.col("services") > 2).alias("multiple_service_patterns"))
    proposed = kept.join(serving, ["station_id", "line_id"]).groupBy("station_id", "line_id", "label").agg(
        F.sort_array(F.collect_set("service_id")).alias("service_ids"))
    direct = observed.select("station_id", "line_id", F.col("platform_label").alias("label"), F.lit(True).alias("_seen"))
    proposed = proposed.join(direct, ["station_id", "line_id", "label"], "left").withColumn("observed", F.coalesce("_seen", F.lit(False))).drop("_seen")
    tally = proposed.groupBy("station_id", "line_id").agg(F.count(F.lit(1)).alias("_p"), F.count_if("observed").alias("_o"))
    status = (
        F.when(F.col("_o") == F.col("_p"), "direct_observation").when(F.col("interchange"), "review_only")
        .when(F.col("_o") > 0, "mixed_observation_inference").otherwise("eligible_inference")
    )
    candidates = kept.join(tally, ["station_id", "line_id"]).withColumn("status", status).drop("_p", "_o")
    open_ = proposed.filter(~F.col("observed")).join(
        candidates.filter("status <> 'review_only'").select("station_id", "line_id"), ["station_id", "line_id"], "left_semi")
    basis = open_.select("station_id", "line_id", "label", F.explode("service_ids").alias("service_id")).join(
        resolved.select("service_id", F.col("station_id").alias("basis_station_id"), F.col("line_id").alias("_bl"), F.col("platform_label").alias("label"), "observed_at"),
        ["service_id", "label"]).filter("basis_station_id <> station_id").select(
        "station_id", "line_id", "label", "basis_station_id", platform_id("basis_station_id", "_bl", "label").alias("basis_platform_id"), "observed_at")
    dated = basis.groupBy("station_id", "line_id", "label").agg(F.max("observed_at").alias("last_updated"))
    inferred = open_.join(dated, ["station_id", "line_id", "label"]).select(
        "station_id", platform_id("station_id", "line_id", "label").alias("platform_id"), "line_id", "label", "last_updated", "service_ids",
        F.lit("same-line-platform-label").alias("method"))
    canonical = observed.select("station_id", "platform_id", "line_id", F.col("platform_label").alias("label"), "last_updated", "service_ids",
                                F.lit(None).cast("string").alias("method")).unionByName(inferred)
    count = lambda df, name: df.groupBy().agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("metric"), "n")
    summary = reduce(DataFrame.unionByName, [
        count(observations, "observations"), count(mapping, "mapped_services"), count(canonical, "canonical_platforms"),
        count(canonical.select("station_id").distinct(), "canonical_stations"), count(candidates, "candidates"), count(skipped, "skipped")])
    return {"candidates": candidates, "skipped": skipped, "platforms": canonical, "proposed": proposed,
            "basis": basis.drop("observed_at").distinct(), "summary": summary, "errors": errors}
