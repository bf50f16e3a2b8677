"""Estimated schedules from headway profiles."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.functions.temporal import format_hms, half_up, parse_hms

DAY_S = 86_400
QUANTUM_S = 30  # departures are quantised to this many seconds

# Timing calendars each schedule calendar falls back through, in order.
CALENDARS = {
    "weekday": ["weekday", "weekday_saturday", "daily"],
    "saturday": ["saturday", "weekday_saturday", "daily"],
    "sunday_public_holiday": ["sunday_public_holiday", "daily"],
}
DAY_TYPES = {"weekday": "weekdays", "saturday": "weekends", "sunday_public_holiday": "weekends"}
# End of fixed values.

HEADWAY = "struct<min:int,max:int,representative:int>"
PROFILE_PERIODS = f"array<struct<id:string,day_type:string,start:string,end:string,headway:{HEADWAY}>>"


def first_last_train(stations: DataFrame) -> DataFrame:
    """Station documents to (station_id, service_id, calendar, first_train, last_train)."""
    services = stations.select(F.col("id").alias("station_id"), F.explode("firstLastTrain.services").alias("s"))
    return services.select("station_id", F.col("s.serviceId").alias("service_id"), F.explode("s.times").alias("calendar", "t")).select(
        "station_id", "service_id", "calendar", F.col("t.firstTrain").alias("first_train"), F.col("t.lastTrain").alias("last_train")
    )


def profile_columns(rev: str = "rev") -> list[Column]:
    """Profile of a revision document in the columns `frequency_windows` reads."""
    hw = lambda h: F.struct(h["minSeconds"].alias("min"), h["maxSeconds"].alias("max"), h["representativeSeconds"].alias("representative"))
    prof = F.col(f"{rev}.estimatedFrequency")
    periods = F.transform(prof["periods"], lambda p: F.struct(
        p["id"].alias("id"), p["dayType"].alias("day_type"), p["start"].alias("start"), p["end"].alias("end"), hw(p["headway"]).alias("headway")))
    return [hw(prof["defaultHeadway"]).alias("default_headway"), periods.alias("profile_periods")]


def resolve_timing(stops: DataFrame, timing: DataFrame, calendars: Sequence[str] = tuple(CALENDARS)) -> DataFrame:
    """Each stop in each calendar with the first timing its fallback order finds.

    The fallback is a map over the timings of the stop's service at the station, which are
    at most one per calendar name.
    """
    order = F.create_map(*[x for c in calendars for x in (F.lit(c), F.array(*map(F.lit, CALENDARS[c])))])
    wide = timing.groupBy("station_id", "service_id").agg(*[
        F.max(F.when(F.col("calendar") == c, F.struct(F.lit(c).alias("source_calendar"), "first_train", "last_train"))).alias(f"_{c}")
        for c in sorted({x for v in CALENDARS.values() for x in v})
    ])
    rows = stops.withColumn("calendar", F.explode(F.array(*map(F.lit, calendars)))).join(wide, ["station_id", "service_id"], "left")
    choice = F.lit(None)
    for c in calendars:
        choice = F.when(F.col("calendar") == c, F.coalesce(*[F.col(f"_{s}") for s in CALENDARS[c]])).otherwise(choice)
    return rows.withColumn("_t", choice).select(*stops.columns, "calendar", "_t.source_calendar", "_t.first_train", "_t.last_train")


def keep_computed(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are evaluated once per row.

    Stacked projections are merged by the optimizer, which would copy an array expression
    into every lambda that reads it; a one-element generator keeps them apart.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def boundary_windows(cuts: str, covers: str) -> Column:
    """Consecutive windows between the cut points in `cuts`, sorted and distinct.

    `covers` is an array of structs whose first fields are s and e. Each window carries its
    covering elements, so more than one is visible to the caller as an overlap.
    """
    pairs = F.arrays_zip(F.slice(cuts, 1, F.size(cuts) - 1).alias("s"), F.slice(cuts, 2, F.size(cuts) - 1).alias("e"))
    return F.transform(pairs, lambda w: F.struct(
        w["s"].alias("s"), w["e"].alias("e"), F.filter(covers, lambda c: (c["s"] <= w["s"]) & (c["e"] >= w["e"])).alias("cover")))


WINDOWS = "array<struct<start_s:int,end_s:int,headway_s:int,min_s:int,max_s:int,source_period_id:string>>"


def frequency_windows(timed: DataFrame) -> DataFrame:
    """`windows` and `error` per timed stop (output of `resolve_timing` with profile columns).

    Everything happens inside the row with higher-order functions: a profile has a handful
    of periods. Needs first_train, last_train, calendar, default_headway, profile_periods.
    """
    day_type = F.when(F.col("calendar") == "weekday", DAY_TYPES["weekday"]).otherwise(DAY_TYPES["saturday"])
    rows = keep_computed(
        timed, _s=parse_hms("first_train"), _last=parse_hms("last_train"), _day_type=day_type)
    rows = keep_computed(
        rows, _e=F.when(F.col("_last") < F.col("_s"), F.col("_last") + DAY_S).otherwise(F.col("_last")),
        _p=F.transform(F.filter("profile_periods", lambda p: p["day_type"] == F.col("_day_type")), lambda p: F.struct(
            parse_hms(p["start"]).alias("s"), parse_hms(p["end"]).alias("e"), p["id"].alias("id"), p["headway"].alias("headway"))))

    def clip(p: Column) -> Column:
        shifts = F.array(F.lit(-DAY_S), F.lit(0), F.lit(DAY_S))
        roll = F.when(p["e"] <= p["s"], DAY_S).otherwise(0)
        moved = F.transform(shifts, lambda o: F.struct(
            F.greatest(F.col("_s"), p["s"] + o).alias("s"), F.least(F.col("_e"), p["e"] + roll + o).alias("e"),
            p["id"].alias("id"), p["headway"].alias("headway")))
        return F.filter(moved, lambda c: c["s"] < c["e"])

    both = F.col("_s").isNotNull() & F.col("_e").isNotNull()
    rows = keep_computed(rows, _covers=F.when(both, F.flatten(F.transform("_p", clip))))
    rows = keep_computed(rows, _cuts=F.when(both & (F.col("_s") < F.col("_e")), F.array_sort(F.array_distinct(F.concat(
        F.array("_s", "_e"), F.transform("_covers", lambda c: c["s"]), F.transform("_covers", lambda c: c["e"]))))))
    rows = keep_computed(rows, _w=F.when(F.col("_cuts").isNotNull(), boundary_windows("_cuts", "_covers")))
    first = lambda w: F.try_element_at(w["cover"], F.lit(1))
    headway = lambda w, f: F.coalesce(first(w)["headway"][f], F.col("default_headway")[f])
    windows = F.transform("_w", lambda w: F.struct(
        w["s"].alias("start_s"), w["e"].alias("end_s"), headway(w, "representative").alias("headway_s"),
        headway(w, "min").alias("min_s"), headway(w, "max").alias("max_s"), first(w)["id"].alias("source_period_id")))
    error = F.when(F.col("_s") == F.col("_e"), "first and last train must differ").when(
        F.exists("_w", lambda w: F.size(w["cover"]) > 1), "frequency periods overlap")
    out = keep_computed(rows, windows=F.coalesce(windows, F.array().cast(WINDOWS)), error=error)
    return out.drop("_s", "_last", "_day_type", "_e", "_p", "_covers", "_cuts", "_w")


def _offset(i: Column, n: Column, length: Column) -> Column:
    return F.when(i == n, length).otherwise(half_up(length * i / n, QUANTUM_S)).cast("int")


def interval_counts(classes: DataFrame) -> DataFrame:
    """The classes (_len, _hw, _lo, _hi: seconds) with `_n`, the valid count closest to the ideal, or null.

    Whether a count fits needs no look at every gap: rounding an even spacing leaves only
    the two multiples of the quantum around it, how many of each follows from the last
    rounded offset, and the gap to the unrounded end is one more test.
    """
    len_, lo, hi = F.col("_len"), F.col("_lo"), F.col("_hi")
    rows = keep_computed(
        classes, _ideal=F.greatest(F.lit(1), half_up(len_ / F.col("_hw"))).cast("int"),
        _low=F.greatest(F.lit(1), F.ceil(len_ / hi)).cast("int"), _high=F.floor(len_ / lo).cast("int"))

    def fits(n: Column) -> Column:
        reach = _offset(n - 1, n, len_)  # last rounded offset
        short = F.floor(len_ / (n * QUANTUM_S)) * QUANTUM_S
        exact = len_ % (n * QUANTUM_S) == 0
        longs = F.when(exact, 0).otherwise((reach - (n - 1) * short) / QUANTUM_S)
        shorts = (n - 1) - longs
        return (
            (len_ - reach).between(lo, hi)
            & ((shorts == 0) | ((short >= lo) & (short <= hi))) & ((longs == 0) | ((short + QUANTUM_S >= lo) & (short + QUANTUM_S <= hi)))
        )

    valid = F.filter(F.when(F.col("_low") <= F.col("_high"), F.sequence("_low", "_high")), fits)
    best = F.array_min(F.transform(valid, lambda n: F.struct(F.abs(n - F.col("_ideal")).alias("d"), n.alias("n"))))
    return keep_computed(rows, _n=best["n"]).drop("_ideal", "_low", "_high")


def departures(scheduled: DataFrame, keep: Sequence[str], refuse: bool = True) -> tuple[DataFrame, DataFrame]:
    """(departures, windows no interval count satisfies).

    Per window the interval count closest to the ideal whose quantised gaps all lie within
    the headway range, smaller counts first on ties. Window ends are exclusive but for the
    last window of the day; its first and last instants are the sourced trains. A schedule with a window that no count
    satisfies is refused whole: it has rows among the windows only; without `refuse` its other windows have their departures.
    `keep`, the first and the last train name a schedule.

    Windows of equal length and headways have equal counts, so each such class is solved once and joined back; classes are few
    (lengths below two days, headways of the profiles), which Spark sees when it has made them distinct.
    """
    rows = scheduled.filter("error is null and first_train is not null and last_train is not null").select(
        *keep, F.element_at("windows", 1)["start_s"].alias("_first"), F.element_at("windows", -1)["end_s"].alias("_last"),
        F.explode("windows").alias("w"))
    shape = {"_len": F.col("w.end_s") - F.col("w.start_s"), "_hw": F.col("w.headway_s"), "_lo": F.col("w.min_s"), "_hi": F.col("w.max_s")}
    rows = rows.select("*", *[c.alias(n) for n, c in shape.items()])
    solved = interval_counts(rows.select(*shape).distinct())
    same = [F.col(n).eqNullSafe(F.col(f"{n}_k")) for n in shape]
    rows = rows.join(solved.select(*[F.col(n).alias(f"{n}_k") for n in shape], "_n"), reduce(and_, same))
    failed = rows.filter("_n is null").select(*keep, F.col("w.start_s").alias("start_s"), F.col("w.end_s").alias("end_s"))
    last_i = F.when(F.col("w.end_s") == F.col("_last"), F.col("_n")).otherwise(F.col("_n") - 1)
    good = rows.filter("_n is not null")
    if refuse:
        day = [*keep, "_first", "_last"]
        refused = rows.filter("_n is null").select(*[F.col(c).alias(f"{c}_k") for c in day]).distinct()
        good = good.join(refused, reduce(and_, [F.col(c).eqNullSafe(F.col(f"{c}_k")) for c in day]), "left_anti")
    times = good.withColumn("_i", F.explode(F.sequence(F.lit(0), last_i)))
    seconds = F.col("w.start_s") + _offset(F.col("_i"), F.col("_n"), F.col("_len"))
    out = times.withColumn("seconds", seconds).select(
        *keep, "seconds", format_hms("seconds").alias("time"),
        F.when(F.col("seconds") == F.col("_last"), "last_train").when(F.col("seconds") == F.col("_first"), "first_train")
        .otherwise("frequency_estimate").alias("basis"),
        F.col("w.headway_s").alias("headway_s"), F.col("w.min_s").alias("min_s"), F.col("w.max_s").alias("max_s"),
        F.col("w.source_period_id").alias("source_period_id"))
    return out, failed


ARRIVAL = "struct<position:int,seconds:int,headway_s:int,min_s:int,max_s:int,source_period_id:string,basis:string>"


def next_arrivals(queried: DataFrame, at: str, keep: Sequence[str], count: int = 3) -> DataFrame:
    """The next `count` estimates after `at` (service-day text) for rows with `windows`."""
    rows = keep_computed(
        queried.filter(F.size("windows") > 0), _q=parse_hms(at), _fw=F.element_at("windows", 1), _lw=F.element_at("windows", -1))
    q, first, end = F.col("_q"), F.col("_fw"), F.col("_lw.end_s")

    def arrival(i, seconds, w, basis):
        return F.struct(i.cast("int").alias("position"), seconds.cast("int").alias("seconds"), w["headway_s"].alias("headway_s"),
                        w["min_s"].alias("min_s"), w["max_s"].alias("max_s"), w["source_period_id"].alias("source_period_id"),
                        basis.alias("basis")).cast(ARRIVAL)

    def within(t):
        return F.try_element_at(F.filter("windows", lambda w: (w["start_s"] <= t) & (t < w["end_s"])), F.lit(1))

    def estimate(i, base, wait):
        w = within(base)
        t = F.least(end, base + wait(w))
        return arrival(i, t, w, F.when(t == end, "last_train").otherwise("frequency_estimate"))

    def step(acc, i):
        prev = F.try_element_at(acc, F.lit(-1))["seconds"]
        opening = (
            F.when(q < first["start_s"], arrival(i, first["start_s"], first, F.lit("first_train")))
            .when(q == end, arrival(i, end, F.col("_lw"), F.lit("last_train")))
            .when(q < end, estimate(i, q, lambda w: half_up(w["headway_s"] / 2).cast("int")))
        )
        later = F.when(prev < end, estimate(i, prev, lambda w: w["headway_s"]))
        new = F.when(i == 1, opening).otherwise(later)
        return F.concat(acc, F.array_compact(F.array(new)))

    folded = F.aggregate(F.sequence(F.lit(1), F.lit(count)), F.array().cast(f"array<{ARRIVAL}>"), step)
    return rows.select(*keep, q.alias("queried_s"), F.inline(folded)).withColumn("time", format_hms("seconds"))
