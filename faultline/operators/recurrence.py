"""Recurring periods to concrete occurrences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.functions.temporal import SGT, col, dtype, from_local, parse_hms, to_local
from faultline.schemas import FREQUENCIES, WEEKDAYS


def _index(weekday: Column) -> Column:
    """0 for Monday, as `weekday` counts."""
    return (F.array_position(F.array(*map(F.lit, WEEKDAYS)), weekday) - 1).cast("int")


def _at(day: Column, seconds: Column) -> Column:
    return day.cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def expand_recurrence(
    df: DataFrame, start: str = "start_at", end: str = "end_at", frequency: str = "frequency",
    days: str | None = "days_of_week", window_start: str = "window_start",
    window_end: str = "window_end", time_zone: str | None = "time_zone",
    excluded: str | None = "excluded_dates", clip: tuple[Column, Column] | None = None,
    exclude_match: str = "date",
) -> DataFrame:
    """One row per occurrence, `occurrence_start` and `occurrence_end` added.

    Without weekdays, weekly takes the weekday of the start, monthly its day and yearly its
    day and month (months lacking the day are skipped) and only those days are generated;
    with weekdays every such day counts. Candidate days explode first and are filtered as
    rows, which stays in generated code. `clip` = (from, to) drops days that cannot touch a
    search window before they exist.
    """
    kind = dtype(df, start)
    tz = F.coalesce(F.col(time_zone), F.lit(SGT)) if time_zone else F.lit(SGT)
    by_day = F.col(days) if days else F.lit(None).cast("array<string>")
    rows = df.select(
        "*", to_local(start, kind, tz).alias("_s"), to_local(end, kind, tz).alias("_e"), tz.alias("_tz"),
        parse_hms(window_start).alias("_opens"), parse_hms(window_end).alias("_closes"),
        F.when(F.size(by_day) > 0, by_day).alias("_days"), col(frequency).alias("_freq"),
        F.to_date(to_local(start, kind, tz)).alias("_first"),
    )
    low = F.col("_first")
    high = F.to_date("_e")
    if clip is not None:
        begin_, end_ = (to_local(c, kind, F.col("_tz")) for c in clip)
        low = F.greatest(low, F.date_sub(F.to_date(begin_), 1))
        high = F.least(high, F.to_date(end_))
    rows = rows.withColumn("_low", low).withColumn("_high", high).filter("_low <= _high")
    day_of = F.day("_first") - 1
    months = lambda since, step: F.transform(
        F.sequence(since, F.col("_high"), F.make_ym_interval(months=F.lit(step))), lambda m: F.date_add(m, day_of))
    freq, plain = F.col("_freq"), F.col("_days").isNull()
    phase = F.date_add("_first", (F.ceil(F.datediff("_low", "_first") / 7) * 7).cast("int"))
    sevens = lambda since: F.when(since <= F.col("_high"), F.sequence(since, F.col("_high"), F.make_dt_interval(days=F.lit(7))))
    first_on = lambda d: F.date_add("_low", F.pmod(_index(d) - F.weekday("_low"), F.lit(7)))
    listed = F.flatten(F.array_compact(F.transform(F.array_distinct("_days"), lambda d: sevens(first_on(d)))))
    candidates = (
        F.when(~plain, listed)
        .when(plain & (freq == "yearly"), F.when(F.trunc("_first", "month") <= F.col("_high"), months(F.trunc("_first", "month"), 12)))
        .when(plain & (freq == "monthly"), months(F.trunc("_low", "month"), 1))
        .when(plain & (freq == "weekly"), sevens(phase))
        .when(plain & (freq == "daily"), F.sequence(F.col("_low"), F.col("_high")))
    )
    day = F.col("_day")
    begin = _at(day, F.col("_opens"))
    # a month without the day rolls over into the next one, where the day differs
    right_day = F.when(plain & freq.isin("monthly", "yearly"), F.day(day) == F.day("_first")).otherwise(F.lit(True))
    keep = right_day & freq.isin(FREQUENCIES) & (begin >= F.col("_s")) & (begin <= F.col("_e"))
    if clip is not None:
        keep = keep & day.between(F.col("_low"), F.col("_high"))
    if excluded:
        out = F.coalesce(F.array_contains(F.col(excluded), day), F.lit(False))
        if exclude_match == "instant":
            out = out & (F.col("_opens") == 0)
        keep = keep & ~out
    overnight = F.col("_closes") <= F.col("_opens")
    finish = _at(F.date_add(day, F.when(overnight, 1).otherwise(0)), F.col("_closes"))
    return rows.select("*", F.explode(candidates).alias("_day")).filter(keep).select(
        *df.columns,
        from_local(begin, kind, F.col("_tz")).alias("occurrence_start"),
        from_local(finish, kind, F.col("_tz")).alias("occurrence_end"),
    )


def flatten_periods(df: DataFrame, period: str = "period", clip=None) -> DataFrame:
    """Fixed periods as they are, recurring ones expanded: adds `start_at`, `end_at`, `recurring`."""
    kind = F.col(f"{period}.kind")
    kept = [c for c in df.columns]
    fixed = df.filter(kind == "fixed").select(
        *kept, F.col(f"{period}.start_at").alias("start_at"), F.col(f"{period}.end_at").alias("end_at"),
        F.lit(False).alias("recurring"),
    )
    fields = ["start_at", "end_at", "frequency", "days_of_week", "window_start", "window_end", "time_zone", "excluded_dates"]
    flat = df.filter(kind == "recurring").select(*kept, *[F.col(f"{period}.{f}").alias(f"_r_{f}") for f in fields])
    if clip is not None:
        flat = flat.filter((F.col("_r_start_at") <= clip[1]) & (F.col("_r_end_at") >= clip[0]))
    grown = expand_recurrence(
        flat, "_r_start_at", "_r_end_at", "_r_frequency", "_r_days_of_week", "_r_window_start",
        "_r_window_end", "_r_time_zone", "_r_excluded_dates", clip=clip,
    ).select(
        *kept, F.col("occurrence_start").alias("start_at"), F.col("occurrence_end").alias("end_at"),
        F.lit(True).alias("recurring"),
    )
    return fixed.unionByName(grown)
