"""Interval algebra: merging, service hours, day boundaries, resolution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.functions.temporal import SGT, dtype, from_local, micros, to_local
from faultline.operators import ordered


def merge_intervals(
    df: DataFrame, keys: Sequence[str], start: str, end: str,
    hot_rows: int | None = ordered.HOT_ROWS,
) -> DataFrame:
    """Union of overlapping or touching intervals per key; a null end stays open."""
    far = F.lit((1 << 63) - 1)
    rows = df.select(*keys, start, end, F.coalesce(micros(end), far).alias("_e"))
    rows = ordered.cut(rows, keys, start, hot_rows)
    order = [start, "_e"]
    rows = ordered.running_max_before(rows, keys, order, "_e", "_reach")
    rows = rows.withColumn("_new", F.when(micros(start) <= F.col("_reach"), 0).otherwise(1))
    rows = ordered.running_sum(rows, keys, order, "_new", "_island")
    return rows.groupBy(*keys, "_island").agg(
        F.min(start).alias(start),
        F.when(F.max(F.col(end).isNull()), None).otherwise(F.max(end)).alias(end),
        F.count(F.lit(1)).alias("merged"),
    ).drop("_island")


def merge_periods(
    df: DataFrame, keys: Sequence[str], period: str = "period",
    hot_rows: int | None = ordered.HOT_ROWS,
) -> DataFrame:
    """W1 on native periods: fixed ones merge, recurring ones pass through behind them."""
    kind = F.col(f"{period}.kind")
    fixed = df.filter(kind == "fixed").select(
        *keys, F.col(f"{period}.start_at").alias("start_at"), F.col(f"{period}.end_at").alias("end_at")
    )
    fields = df.schema[period].dataType.fields
    given = {"kind": F.lit("fixed"), "start_at": F.col("start_at"), "end_at": F.col("end_at")}
    merged = merge_intervals(fixed, keys, "start_at", "end_at", hot_rows).select(
        *keys,
        F.struct(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]).alias(period),
    )
    return merged.unionByName(df.filter(kind == "recurring").select(*keys, period))


def day_starts(df: DataFrame, start: str, end: str, out: str = "day_start", tz: str = SGT) -> DataFrame:
    """Midnights in [start, end); start's own midnight only when start is that midnight."""
    kind = dtype(df, start)
    s, e = to_local(start, kind, tz), to_local(end, kind, tz)
    first = F.when(F.to_date(s).cast("timestamp_ntz") == s, F.to_date(s)).otherwise(F.date_add(F.to_date(s), 1))
    last = F.when(F.to_date(e).cast("timestamp_ntz") == e, F.date_sub(F.to_date(e), 1)).otherwise(F.to_date(e))
    days = F.when(first <= last, F.sequence(first, last))
    return df.select("*", F.explode(days).alias("_d")).select(
        *df.columns, from_local(F.col("_d").cast("timestamp_ntz"), kind, tz).alias(out)
    )


def split_service_hours(
    df: DataFrame, start: str, end: str, opens: str = "05:30:00", tz: str = SGT
) -> DataFrame:
    """I4: cut at midnights and keep the part of each day from opening time on."""
    kind = dtype(df, start)
    s, e = to_local(start, kind, tz), to_local(end, kind, tz)
    days = F.when(s < e, F.sequence(F.to_date(s), F.to_date(e)))
    rows = df.select("*", F.explode(days).alias("_d"), s.alias("_s"), e.alias("_e"))
    opening = F.to_timestamp_ntz(F.concat_ws(" ", F.col("_d").cast("string"), F.lit(opens)))
    lo = F.greatest("_s", opening)
    hi = F.least("_e", F.date_add("_d", 1).cast("timestamp_ntz"))
    return rows.withColumn("_lo", lo).withColumn("_hi", hi).filter("_lo < _hi").select(
        *[c for c in df.columns if c not in (start, end)],
        from_local(F.col("_lo"), kind, tz).alias(start),
        from_local(F.col("_hi"), kind, tz).alias(end),
    )


def total_duration(df: DataFrame, group: Sequence[str], start: str, end: str, out: str = "duration_us") -> DataFrame:
    """Summed length of intervals in microseconds."""
    return df.groupBy(*group).agg(F.sum(micros(end) - micros(start)).alias(out))


def service_duration(
    df: DataFrame, keys: Sequence[str], start: str, end: str, opens: str = "05:30:00", tz: str = SGT
) -> DataFrame:
    """Time within service hours per key; keys without any get zero.

    Computed from the number of days between the bounds, so a long interval costs one
    row instead of one row per day.
    """
    kind = dtype(df, start)
    s, e = to_local(start, kind, tz), to_local(end, kind, tz)
    h, m, sec = (int(x) for x in opens.split(":"))
    closed = (h * 3600 + m * 60 + sec) * 1_000_000
    day = 86_400_000_000

    def open_until(t):
        """Open time from the epoch's midnight to `t`."""
        of_day = micros(t) - micros(F.to_date(t).cast("timestamp_ntz"))
        return F.unix_date(F.to_date(t)).cast("long") * (day - closed) + F.greatest(of_day - closed, F.lit(0))

    span = F.when(s < e, open_until(e) - open_until(s)).otherwise(F.lit(0).cast("long"))
    return df.select(*keys, span.alias("_us")).groupBy(*keys).agg(F.sum("_us").alias("duration_us"))


def overlaps_window(start, end, from_, to):
    """Closed interval overlap used by searches; a null end reaches past the window."""
    return (start <= to) & (end.isNull() | (end >= from_))


def resolve_periods(
    df: DataFrame, start: str, end: str, as_of, mode: str = "operational",
    last_evidence: str | None = None, crowd_exited: str | None = None,
    crowd_last_active: str | None = None, crowd_active: str | None = None,
    stale_minutes: int = 120, grace_minutes: int = 30, max_minutes: int = 1080, tz: str = SGT,
) -> DataFrame:
    """Effective end of fixed periods; adds end_resolved, end_source and end_reason.

    Facts win. Operational mode infers the end of an open period from crowd decay, else
    from stale evidence, as the end of that local day, held between the start and the
    maximum length; an end after `as_of` leaves the period open.
    """
    kind = dtype(df, start)
    none = F.lit(None).cast(kind if kind != "date" else "timestamp_ntz")
    s, e = F.col(start), F.col(end)
    fact = e.isNotNull()
    if mode == "canonical":
        return df.select(
            "*", e.alias("end_resolved"), F.when(fact, "fact").otherwise("none").alias("end_source"),
            F.lit(None).cast("string").alias("end_reason"),
        )

    def plus(name, minutes):
        return (F.col(name) + F.make_dt_interval(mins=F.lit(minutes))) if name else none

    evidence = plus(last_evidence, stale_minutes)
    crowd = none
    if crowd_last_active:
        active = F.coalesce(F.col(crowd_active), F.lit(False)) if crowd_active else F.lit(False)
        crowd = F.when(~active, plus(crowd_last_active, grace_minutes)).otherwise(none)
    if crowd_exited:
        crowd = F.coalesce(F.col(crowd_exited), crowd)
    candidate = F.coalesce(crowd, evidence)
    midnight = from_local(F.date_add(F.to_date(to_local(candidate, kind, tz)), 1).cast("timestamp_ntz"), kind, tz)
    cap = s + F.make_dt_interval(mins=F.lit(max_minutes))
    inferred = F.least(F.greatest(midnight, s), cap)
    usable = ~fact & candidate.isNotNull() & (inferred <= as_of)
    return df.select(
        "*",
        F.when(fact, e).when(usable, inferred).alias("end_resolved"),
        F.when(fact, "fact").when(usable, "inferred").otherwise("none").alias("end_source"),
        F.when(usable & crowd.isNotNull(), "crowd_decay").when(usable, "evidence_timeout").alias("end_reason"),
    )
