"""Ordered per-key computations that stay parallel when one key dominates the table.

A window over a key runs in one task per key. Keys above `hot_rows` rows are
therefore cut into ranges of their order column; windows run per (key, range) and
what a range needs from its neighbours (last value, running maximum, row count) is
taken from a summary with one row per range. Ordinary keys are never cut and see a
plain window. Results are exactly those of the window over the whole key.

Hot keys are looked for by one counting job over the key columns when the operator
is called. Usually there are none, and the plan is then the plain window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from faultline.lineage import cut_lineage

HOT_ROWS = 2_000_000  # a key with more rows than this is cut
RANGES = 1024  # cuts per hot key
BROADCAST_KEYS = 2_000  # borders of so many hot keys (16 MB) are broadcast, those of more are joined by shuffle

CHUNK, HOT = "_chunk", "_hot"


def _same(left: DataFrame, right: DataFrame, names: Sequence[str], suffix: str) -> Column:
    cond = F.lit(True)
    for n in names:
        cond = cond & left[n].eqNullSafe(right[n + suffix])
    return cond


def _number(df: DataFrame, name: str) -> Column:
    """A number that never falls where the order column rises; rows of equal number share a range.

    Text counts by its first six bytes, a struct by its first field.
    """
    kind = df.schema[name].dataType
    at = F.col(name)
    while kind.typeName() == "struct":
        at, kind = at[kind.fields[0].name], kind.fields[0].dataType
    if kind.typeName() == "string":
        return F.conv(F.rpad(F.hex(F.substring(F.encode(at, "utf-8"), 1, 6)), 12, "0"), 16, 10).cast("double")
    kind = kind.typeName()
    if kind in ("timestamp", "timestamp_ntz", "date"):
        return F.unix_micros(at.cast("timestamp"))
    return at.cast("double")


def find_cuts(df: DataFrame, keys: Sequence[str], order: str, hot_rows: int | None = HOT_ROWS) -> DataFrame | None:
    """Range borders of the hot keys (`RANGES` numbers each), or None without hot keys."""
    if hot_rows is None:
        return None
    renamed = [F.col(k).alias(k + "_h") for k in keys]
    hot = df.groupBy(*renamed).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows)
    if hot.isEmpty():
        return None
    rows = df.select(*keys, _number(df, order).alias("_o"))
    rows = rows.join(hot, _same(rows, hot, keys, "_h"))
    points = [i / RANGES for i in range(1, RANGES)]
    return cut_lineage(rows.groupBy(*renamed).agg(F.array_distinct(F.percentile_approx("_o", points)).alias("_cuts")))


def apply_cuts(df: DataFrame, keys: Sequence[str], order: str, cuts: DataFrame | None) -> DataFrame:
    """Add `_hot` and `_chunk`; rows that tie on `order` always share a chunk."""
    if cuts is None:
        return df.withColumn(HOT, F.lit(False)).withColumn(CHUNK, F.lit(0))
    few = cuts.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    out = df.join(F.broadcast(cuts) if few else cuts, _same(df, cuts, keys, "_h"), "left")
    at = _number(df, order)
    return out.select(
        *df.columns, F.col("_cuts").isNotNull().alias(HOT),
        F.when(F.col("_cuts").isNotNull(), F.size(F.filter("_cuts", lambda c: c < at))).otherwise(0).alias(CHUNK),
    )


def cut(df: DataFrame, keys: Sequence[str], order: str, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    return apply_cuts(df, keys, order, find_cuts(df, keys, order, hot_rows))


def _attach(df: DataFrame, summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join the per-range summary of hot keys back; empty, hence free, without hot keys."""
    names = [*keys, CHUNK]
    right = summary.select(*[F.col(n).alias(n + "_s") for n in names], "_carry")
    return df.join(right, _same(df, right, names, "_s"), "left").drop(*[n + "_s" for n in names])


def _window(keys: Sequence[str], order: Sequence[Column | str]):
    return W.partitionBy(*keys, CHUNK).orderBy(*order)


def _ranges(keys: Sequence[str]):
    return W.partitionBy(*keys).orderBy(CHUNK)


def previous(df: DataFrame, keys, order, value: str, out: str) -> DataFrame:
    """Value of the preceding row of the key. `df` carries the columns of `cut`."""
    tagged = df.select("*", F.struct(F.col(value).alias("v")).alias("_v"))
    last = (
        tagged.filter(HOT).groupBy(*keys, CHUNK)
        .agg(F.max_by("_v", F.struct(*order)).alias("_l"))
        .withColumn("_carry", F.lag("_l").over(_ranges(keys)))
    )
    with_lag = tagged.withColumn("_p", F.lag("_v").over(_window(keys, order)))
    return _attach(with_lag, last, keys).select(
        *df.columns, F.coalesce("_p", "_carry")["v"].alias(out)
    )


def following(df: DataFrame, keys, order, value: str, out: str) -> DataFrame:
    """Value of the next row of the key."""
    tagged = df.select("*", F.struct(F.col(value).alias("v")).alias("_v"))
    first = (
        tagged.filter(HOT).groupBy(*keys, CHUNK)
        .agg(F.min_by("_v", F.struct(*order)).alias("_l"))
        .withColumn("_carry", F.lead("_l").over(_ranges(keys)))
    )
    with_lead = tagged.withColumn("_p", F.lead("_v").over(_window(keys, order)))
    return _attach(with_lead, first, keys).select(
        *df.columns, F.coalesce("_p", "_carry")["v"].alias(out)
    )


def rank(df: DataFrame, keys, order, out: str) -> DataFrame:
    """Row number (from 1) within the key."""
    counts = (
        df.filter(HOT).groupBy(*keys, CHUNK).agg(F.count(F.lit(1)).alias("_l"))
        .withColumn("_carry", F.sum("_l").over(_ranges(keys).rowsBetween(W.unboundedPreceding, -1)))
    )
    ranked = df.withColumn(out, F.row_number().over(_window(keys, order)))
    return _attach(ranked, counts, keys).select(
        *df.columns, (F.col(out) + F.coalesce("_carry", F.lit(0))).cast("long").alias(out)
    )


def running_max_before(df: DataFrame, keys, order, value: str, out: str) -> DataFrame:
    """Maximum of `value` over the earlier rows of the key."""
    before = W.unboundedPreceding, -1
    peaks = (
        df.filter(HOT).groupBy(*keys, CHUNK).agg(F.max(value).alias("_l"))
        .withColumn("_carry", F.max("_l").over(_ranges(keys).rowsBetween(*before)))
    )
    local = df.withColumn("_p", F.max(value).over(_window(keys, order).rowsBetween(*before)))
    return _attach(local, peaks, keys).select(*df.columns, F.greatest("_p", "_carry").alias(out))


def running_sum(df: DataFrame, keys, order, value: str, out: str) -> DataFrame:
    """Sum of `value` over this and the earlier rows of the key."""
    sums = (
        df.filter(HOT).groupBy(*keys, CHUNK).agg(F.sum(value).alias("_l"))
        .withColumn("_carry", F.sum("_l").over(_ranges(keys).rowsBetween(W.unboundedPreceding, -1)))
    )
    local = df.withColumn(
        "_p", F.sum(value).over(_window(keys, order).rowsBetween(W.unboundedPreceding, W.currentRow))
    )
    return _attach(local, sums, keys).select(
        *df.columns, (F.col("_p") + F.coalesce("_carry", F.lit(0))).alias(out)
    )


def running_last(df: DataFrame, keys, order, value: str, out: str) -> DataFrame:
    """Last non-null `value` up to and including this row."""
    upto = W.unboundedPreceding, W.currentRow
    at = F.when(F.col(value).isNotNull(), F.struct(*order))
    lasts = (
        df.filter(HOT).groupBy(*keys, CHUNK).agg(F.max_by(value, at).alias("_l"))
        .withColumn("_carry", F.last("_l", True).over(_ranges(keys).rowsBetween(W.unboundedPreceding, -1)))
    )
    local = df.withColumn("_p", F.last(value, True).over(_window(keys, order).rowsBetween(*upto)))
    return _attach(local, lasts, keys).select(*df.columns, F.coalesce("_p", "_carry").alias(out))


def uncut(df: DataFrame) -> DataFrame:
    return df.drop(CHUNK, HOT)


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First `n` rows per key. Spark limits each group before the shuffle, so hot keys are cheap."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")
