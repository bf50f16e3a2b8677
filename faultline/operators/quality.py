"""Data-quality rules as DataFrames of breaches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR_COLUMNS = ["rule", "path", "location", "message"]
# Alphabet and shape of generated sortable ids.
ULID_ALPHABET = "0123456789ABCDEFGHJKMNPQRSTVWXYZ"
ULID_PATTERN = "[0-7][0-9A-HJKMNP-TV-Z]{25}"
EVIDENCE_ID_PATTERN = "^ev_[0-9A-HJKMNP-TV-Z]{26}$"


def errors(df: DataFrame, rule: str, path: Column, location: Column, message: Column) -> DataFrame:
    return df.select(
        F.lit(rule).alias("rule"), path.cast("string").alias("path"),
        location.cast("string").alias("location"), message.cast("string").alias("message"),
    )


def union_errors(tables: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def expectations(df: DataFrame, rules: Mapping[str, Column], path: Column, location: Column | None = None) -> DataFrame:
    """V1: one row per record and named predicate that is not true. One pass for all rules."""
    failed = F.array_compact(F.array(*[
        F.when(~F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in rules.items()
    ]))
    rows = df.select(path.alias("_p"), (location if location is not None else F.lit("")).alias("_l"), F.explode(failed).alias("_r"))
    return rows.select(
        F.col("_r").alias("rule"), F.col("_p").cast("string").alias("path"),
        F.col("_l").cast("string").alias("location"), F.concat(F.lit("expected: "), "_r").alias("message"),
    )


def fk_check(child: DataFrame, cols: str | Sequence[str], parent: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """V2: child rows whose non-null reference has no parent.

    Parent keys are de-duplicated by the semi-join itself; a hot child key is skew on the
    streamed side, which AQE splits, or no shuffle at all when the keys broadcast.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    keys = [keys] if isinstance(keys, str) else list(keys)
    right = parent.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    rows = child.filter(present)
    cond = reduce(lambda a, b: a & b, [rows[c] == right[f"_k{i}"] for i, c in enumerate(cols)])
    return rows.join(right, cond, "left_anti")


def first_seen(df: DataFrame, key: Sequence[str], location: Sequence[str], out: str = "first_location") -> DataFrame:
    """Every repeat of a key with the location of its first occurrence.

    The first location comes from an aggregation that combines before the shuffle, and
    only repeated keys are joined back.
    """
    repeated = df.groupBy(*[F.col(k).alias(k + "_f") for k in key]).agg(
        F.min(F.struct(*location)).alias(out), F.count(F.lit(1)).alias("_n")
    ).filter("_n > 1").drop("_n")
    cond = reduce(lambda a, b: a & b, [df[k].eqNullSafe(repeated[k + "_f"]) for k in key])
    joined = df.join(repeated, cond).drop(*[k + "_f" for k in key])
    return joined.filter(F.struct(*location) != F.col(out))


def unique_check(df: DataFrame, key: Sequence[str], location: Sequence[str]) -> DataFrame:
    """V3: repeats of a key anywhere in the table."""
    return first_seen(df.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])), key, location)


def unique_across(df: DataFrame, key: Sequence[str], owner: str, location: Sequence[str]) -> DataFrame:
    """V3: occurrences of a key under another owner than the first one."""
    seen = unique_check(df, key, [*location, owner])
    return seen.filter(F.col(owner) != F.col(f"first_location.{owner}"))


def setter_conflicts(impact: DataFrame, keys: Sequence[str], ts: str, location: Sequence[str]) -> DataFrame:
    """V4: a second setter for the same bundle, type, entity and timestamp."""
    return first_seen(impact, [*keys, ts], location)


def outside_every_window(
    df: DataFrame, row_key: Sequence[str], key: str, windows: DataFrame, window_key: str, inside: Column,
    require_match: bool = False,
) -> DataFrame:
    """Rows for which no window of their key satisfies `inside`.

    `row_key` identifies a row of df. Rows whose key has no window at all are kept unless
    `require_match`. Windows join on the key only and are folded with `bool_or`.
    """
    joined = df.join(windows, df[key] == windows[window_key], "left")
    ok = joined.groupBy(*row_key).agg(
        F.bool_or(F.coalesce(inside, F.lit(False))).alias("_ok"),
        F.bool_or(F.col(window_key).isNotNull()).alias("_any"),
    )
    bad = ok.filter(~F.col("_ok") & (F.col("_any") if require_match else F.lit(True)))
    return df.join(bad.select(*row_key), list(row_key), "left_semi")


def ulid_millis(ulid: Column) -> Column:
    """Time embedded in the first ten characters of a sortable id."""
    return sum(
        ((F.instr(F.lit(ULID_ALPHABET), F.substring(ulid, i + 1, 1)) - 1).cast("long") * F.lit(32 ** (9 - i)) for i in range(10)),
        F.lit(0).cast("long"),
    )


def id_audit(df: DataFrame, id_col: str, ts_us: Column | None = None) -> DataFrame:
    """Kind, validity, embedded time and drift of generated ids."""
    c = F.col(id_col)
    valid = F.coalesce(c.rlike(f"^(ev|ie)_{ULID_PATTERN}$"), F.lit(False))
    millis = F.when(valid, ulid_millis(F.substring(c, 4, 26)))
    kind = F.when(valid & c.startswith("ev_"), "evidence").when(valid, "impact-event")
    drift = millis - F.floor(ts_us / 1000) if ts_us is not None else F.lit(None).cast("long")
    return df.select("*", valid.alias("id_valid"), kind.alias("id_kind"), millis.alias("id_millis"), drift.alias("id_drift_ms"))


def id_audit_summary(audited: DataFrame) -> DataFrame:
    return audited.groupBy("id_kind").agg(
        F.count(F.lit(1)).alias("ids"), F.max(F.abs("id_drift_ms")).alias("max_drift_ms")
    )


def validation_summary(tables: Mapping[str, DataFrame], errors_: DataFrame) -> DataFrame:
    """Records checked per collection, plus one row of error count and the ok flag."""
    counts = [
        df.groupBy().agg(F.count(F.lit(1)).alias("checked")).select(F.lit(name).alias("scope"), "checked", F.lit(None).cast("boolean").alias("ok"))
        for name, df in tables.items()
    ]
    total = errors_.groupBy().agg(F.count(F.lit(1)).alias("checked")).select(
        F.lit("errors").alias("scope"), "checked", (F.col("checked") == 0).alias("ok")
    )
    return reduce(DataFrame.unionByName, [*counts, total])


def raise_on_errors(errors_: DataFrame, shown: int = 20) -> None:
    """Exception in place of error rows, for callers that want to stop."""
    rows = errors_.limit(shown).collect()
    if rows:
        raise ValueError("; ".join(f"{r.rule} {r.path} {r.location}: {r.message}" for r in rows))
