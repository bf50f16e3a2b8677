"""Rows valid at an instant or in a month, versions as of an instant."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.functions.temporal import in_month, valid_at
from faultline.operators import ordered


def active_at(df: DataFrame, start: str, end: str, at: Column) -> DataFrame:
    """A plain filter, so it reaches the Parquet scan."""
    return df.filter(valid_at(start, end, at))


def active_in_month(df: DataFrame, start: str, end: str, month: str) -> DataFrame:
    """P2."""
    return df.filter(in_month(start, end, month))


def as_of_version(df: DataFrame, key: Sequence[str], effective: str, at: Column, values: Sequence[str]) -> DataFrame:
    """Per key the version with the greatest `effective` up to `at`."""
    return df.filter(F.col(effective) <= at).groupBy(*key).agg(
        F.max(effective).alias(effective), *[F.max_by(v, effective).alias(v) for v in values])


def as_of_join(
    facts: DataFrame, versions: DataFrame, key: Sequence[str], at: str, effective: str, values: Sequence[str],
    tie: Sequence[str] = (), hot_rows: int | None = ordered.HOT_ROWS,
) -> DataFrame:
    """P4 for a table of instants: each fact with the version of its key in force at `at`.

    Versions and facts are interleaved by time and the last version is carried forward,
    one shuffle and no range join. A version at the very instant applies.
    """
    packed = F.struct(*values)
    tag = lambda df, when, is_fact: df.select(
        *key, F.col(when).alias("_at"), F.lit(is_fact).alias("_fact"),
        *[(F.col(t) if is_fact else F.lit(None)).alias(f"_t_{t}") for t in tie],
        (F.lit(None) if is_fact else packed).alias("_v"), (F.struct(*facts.columns) if is_fact else F.lit(None)).alias("_row"))
    mixed = tag(versions, effective, 0).unionByName(tag(facts, at, 1))
    cut_rows = ordered.cut(mixed, key, "_at", hot_rows)
    carried = ordered.running_last(cut_rows, key, ["_at", "_fact", *[f"_t_{t}" for t in tie]], "_v", "_now")
    return ordered.uncut(carried).filter("_fact = 1").select("_row.*", *[F.col(f"_now.{v}").alias(v) for v in values])
