"""Instants, dates, months and service-day times as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.schemas import WEEKDAYS

SGT = "Asia/Singapore"
# Fixed value: offset at the end of an ISO date-time.
OFFSET_PATTERN = r"(?i)(Z|[+-]\d{2}:\d{2})$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dtype(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def to_local(c: Column | str, kind: str, tz: str | Column = SGT) -> Column:
    """Wall-clock time (NTZ) of an instant in `tz`; NTZ and dates are wall time already."""
    c = col(c)
    if kind == "timestamp":
        return F.convert_timezone(F.current_timezone(), _lit(tz), c.cast("timestamp_ntz"))
    return c.cast("timestamp_ntz")


def from_local(c: Column, kind: str, tz: str | Column = SGT) -> Column:
    """Inverse of `to_local`: back to the kind of column the caller had."""
    if kind == "timestamp":
        return F.convert_timezone(_lit(tz), F.current_timezone(), c).cast("timestamp")
    return c.cast("timestamp_ntz")


def _lit(tz: str | Column) -> Column:
    return F.lit(tz) if isinstance(tz, str) else tz


def date_instant(c: Column | str, tz: str = SGT) -> Column:
    """A calendar date as the instant of its midnight in `tz`."""
    return from_local(col(c).cast("timestamp_ntz"), "timestamp", tz)


def micros(c: Column | str) -> Column:
    return F.unix_micros(col(c).cast("timestamp"))


def valid_at(start: Column | str, end: Column | str, at: Column) -> Column:
    """`at` lies in the half-open interval [start, end); a null end never ends."""
    return (col(start) <= at) & (col(end).isNull() | (at < col(end)))


def in_month(start: Column | str, end: Column | str, month: str | Column) -> Column:
    """The interval overlaps the calendar month `YYYY-MM`."""
    first = F.to_date(F.concat(_lit(month), F.lit("-01"))).cast("timestamp_ntz")
    following = F.add_months(first, 1).cast("timestamp_ntz")
    return (col(start) < following) & (col(end).isNull() | (first < col(end)))


def contains_interval(outer_start, outer_end, inner_start, inner_end) -> Column:
    """Inner lies inside outer; a null end is +infinity."""
    return (col(outer_start) <= col(inner_start)) & (
        col(outer_end).isNull() | (col(inner_end).isNotNull() & (col(inner_end) <= col(outer_end)))
    )


def parse_effective(c: Column | str) -> Column:
    """P10: `YYYY-MM` or a real `YYYY-MM-DD` to `YYYY-MM`; anything else is null."""
    c = col(c)
    day = F.when(c.rlike(r"^\d{4}-(0[1-9]|1[0-2])-\d{2}$"), F.try_to_timestamp(c, F.lit("yyyy-MM-dd")))
    return F.when(c.rlike(r"^\d{4}-(0[1-9]|1[0-2])$"), c).when(day.isNotNull(), F.substring(c, 1, 7))


def parse_instant_strict(c: Column | str, tz: str = SGT) -> Column:
    """P10: month, date (both midnight in `tz`) or a date-time that carries its offset."""
    c = col(c)
    text = F.when(c.rlike(r"^\d{4}-\d{2}$"), F.concat(c, F.lit("-01"))).otherwise(c)
    as_date = from_local(F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).cast("timestamp_ntz"), "timestamp", tz)
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), as_date).when(
        text.rlike(r"^\d{4}-\d{2}-\d{2}T") & text.rlike(OFFSET_PATTERN), F.try_to_timestamp(text)
    )


def parse_instant(c: Column | str) -> Column:
    """An ISO date-time with offset; null when it does not parse."""
    return F.try_to_timestamp(col(c))


def to_sgt_text(c: Column | str, kind: str = "timestamp", tz: str = SGT) -> Column:
    """I8: an instant rendered as wall time of `tz`."""
    return F.date_format(to_local(c, kind, tz), "yyyy-MM-dd'T'HH:mm:ss.SSS")


def legacy_date(c: Column | str) -> Column:
    """I8: `YYYY-MM-DDT00:00:00[.000]Z` becomes the bare date; other text stays."""
    c = col(c)
    found = F.regexp_extract(c, r"^(\d{4}-\d{2}-\d{2})T00:00:00(?:\.000)?Z$", 1)
    return F.when(found != "", found).otherwise(c)


def relative_day(c: Column | str, weekday: Column | str, offset: Column | int, kind: str, tz: str = SGT) -> Column:
    """Day interval of `weekday` in the ISO week `offset` weeks away from the reference."""
    monday = F.trunc(to_local(c, kind, tz), "week")
    index = F.array_position(F.array(*map(F.lit, WEEKDAYS)), col(weekday))
    off = F.lit(offset) if isinstance(offset, int) else offset
    day = F.date_add(monday, (off * 7 + index - 1).cast("int"))
    start = from_local(day.cast("timestamp_ntz"), kind, tz)
    end = from_local(F.date_add(day, 1).cast("timestamp_ntz"), kind, tz)
    return F.when(index > 0, F.struct(start.alias("start_at"), end.alias("end_at")))


def parse_hms(c: Column | str) -> Column:
    """`HH:mm[:ss]`, hours may pass 24, to seconds; null when it is no whole-second time."""
    c = col(c)
    parts = F.split(c, ":")
    sec = F.coalesce(F.try_element_at(parts, F.lit(3)), F.lit("0"))
    value = (
        F.element_at(parts, 1).cast("int") * 3600
        + F.element_at(parts, 2).cast("int") * 60
        + sec.cast("int")
    )
    return F.when(c.rlike(r"^\d+:\d{1,2}(:\d{1,2})?$"), value)


def format_hms(c: Column | str) -> Column:
    """Seconds of the service day to `HH:mm:ss`."""
    c = col(c)
    return F.concat_ws(
        ":",
        *[
            F.when(F.length(p.cast("string")) < 2, F.lpad(p.cast("string"), 2, "0")).otherwise(p.cast("string"))
            for p in (F.floor(c / 3600), F.floor(c % 3600 / 60), (c % 60).cast("long"))
        ],
    )


def half_up(c: Column, quantum: int = 1) -> Column:
    """Round half up to a multiple of `quantum`."""
    return F.floor(c / quantum + F.lit(0.5)) * quantum
