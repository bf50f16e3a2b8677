"""Searches over incidents: interval overlap, scoring, top-k, fuzzy text."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.functions.temporal import SGT, date_instant, from_local, micros, parse_instant
from faultline.functions.text import truncate
from faultline.operators.ordered import first_per_group
from faultline.operators.recurrence import flatten_periods

DAY_US = 86_400_000_000
MAX_PROBES = 500_000  # rows of a few longs each
MILLI_US = 1_000


def search_bound(c: Column | str, edge: str, tz: str = SGT) -> Column:
    """Search boundary text: a bare date covers its whole local day, to the last millisecond."""
    c = F.col(c) if isinstance(c, str) else c
    day = F.to_date(F.substring(c, 1, 10)).cast("timestamp_ntz")
    if edge == "end":
        day = day + F.expr("interval 86399.999 seconds")
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), from_local(day, "timestamp", tz)).otherwise(parse_instant(c))


def overlap_join(
    left: DataFrame, windows: DataFrame, left_bounds: tuple[str, str], window_bounds: tuple[str, str],
    base_us: int = DAY_US,
) -> DataFrame:
    """Pairs whose closed micro-second ranges overlap; an equi-join, never a nested loop.

    Each left range goes to the level whose bucket width is at least its length, so it
    falls in one or two buckets however long it is; windows probe every level. A pair that
    meets in two buckets is kept in the first one only. Bounds are long columns; an open
    left end is clipped to the last window. The number of probes is computed beforehand:
    they are broadcast only below `MAX_PROBES`, else both sides shuffle by bucket.
    """
    ls, le = left_bounds
    ws, we = window_bounds
    length_ = F.col(we) - F.col(ws) + 1
    span = windows.agg(F.min(ws).alias("lo"), F.max(we).alias("hi"), F.sum(length_).alias("total"), F.count(F.lit(1)).alias("n")).first()
    lo, hi = (span.lo, span.hi) if span.n else (1, 0)
    levels = max(0, math.ceil(math.log2(max(hi - lo + 1, 1) / base_us))) + 1
    probes_n = 2 * (span.total or 0) / base_us + 2 * levels * span.n
    rows = left.withColumn("_s", F.greatest(F.col(ls), F.lit(lo))).withColumn(
        "_e", F.least(F.coalesce(F.col(le), F.lit(hi)), F.lit(hi))
    ).filter((F.col("_s") <= F.col("_e")) & (F.col(le).isNull() | (F.col(ls) <= F.col(le))))
    length = (F.col("_e") - F.col("_s") + 1) / F.lit(float(base_us))
    level = F.greatest(F.ceil(F.log2(length)), F.lit(0)).cast("int")
    rows = rows.withColumn("_level", level)
    width = F.lit(base_us) * F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_level"))
    rows = rows.withColumn("_b0", F.floor(F.col("_s") / width)).withColumn(
        "_bucket", F.explode(F.sequence("_b0", F.floor(F.col("_e") / width)))
    )
    probes = windows.withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(levels - 1))))
    probes = probes.withColumn("_w0", F.floor(F.col(ws) / width)).withColumn(
        "_bucket", F.explode(F.sequence("_w0", F.floor(F.col(we) / width)))
    )
    if probes_n <= MAX_PROBES:
        probes = F.broadcast(probes)
    pairs = rows.join(probes, ["_level", "_bucket"])
    exact = (F.col("_s") <= F.col(we)) & (F.col(ws) <= F.col("_e"))
    once = F.col("_bucket") == F.greatest("_b0", "_w0")
    return pairs.filter(exact & once).drop("_level", "_bucket", "_b0", "_w0", "_s", "_e")


def score_hits(hits: DataFrame) -> DataFrame:
    """5 for the issue date, 3 per evidence and 1 per period up to three each; zeros dropped."""
    n = {k: F.col(k) for k in ("date_hits", "evidence_hits", "period_hits")}
    score = F.when(n["date_hits"] > 0, 5).otherwise(0) + F.least(n["evidence_hits"], F.lit(3)) * 3 + F.least(
        n["period_hits"], F.lit(3)
    )
    reasons = F.array_compact(F.array(
        F.when(n["date_hits"] > 0, "issue date"),
        F.when(n["evidence_hits"] > 0, "evidence timestamp"),
        F.when(n["period_hits"] > 0, "active period"),
    ))
    return hits.withColumn("score", score.cast("long")).withColumn("reasons", reasons).filter("score > 0")


def issues_in_window(
    issues: DataFrame, evidence: DataFrame, periods: DataFrame, windows: DataFrame,
    k: int = 25, tz: str = SGT,
) -> DataFrame:
    """J2 + A6 + K1: the k best issues per window.

    issues(issue_id), evidence(issue_id, ts), periods(issue_id, period) and
    windows(window_id, start_at, end_at), bounds inclusive. All period rows given count;
    pass the live ones only for the other reading.
    """
    w = windows.select("window_id", micros("start_at").alias("_wfrom"), (micros("end_at") + MILLI_US - 1).alias("_wto"))
    bounds = windows.agg(F.min("start_at").alias("lo"), F.max("end_at").alias("hi")).first()
    date = F.try_to_timestamp(F.substring("issue_id", 1, 10), F.lit("yyyy-MM-dd")).cast("date")
    begin = micros(date_instant(date, tz))

    def ranges(df: DataFrame, tag: str, start: Column, end: Column) -> DataFrame:
        return df.select("issue_id", F.lit(tag).alias("tag"), start.alias("_from"), end.alias("_to"))

    clip = (F.lit(bounds.lo).cast("timestamp"), F.lit(bounds.hi).cast("timestamp")) if bounds.lo else None
    at = micros("ts")
    timed = (
        ranges(issues.filter(date.isNotNull()), "date", begin, begin + DAY_US - 1)
        .unionByName(ranges(evidence.filter(F.col("ts").isNotNull()), "evidence", at, at))
        .unionByName(ranges(flatten_periods(periods, clip=clip), "period", micros("start_at"), micros("end_at") + MILLI_US - 1))
    )
    tagged = overlap_join(timed, w, ("_from", "_to"), ("_wfrom", "_wto"))
    hits = tagged.groupBy("window_id", "issue_id").agg(
        *[F.count_if(F.col("tag") == t).alias(f"{t}_hits") for t in ("date", "evidence", "period")]
    )
    return top_hits(score_hits(hits), k)


def top_hits(scored: DataFrame, k: int = 25) -> DataFrame:
    """K1: best k per window by score, then id, both descending."""
    return first_per_group(scored, ["window_id"], [F.desc("score"), F.desc("issue_id")], k)


def decorate_hits(
    hits: DataFrame, evidence: DataFrame, windows: DataFrame, state: DataFrame,
    evidence_n: int = 2, entity_n: int = 3, width: int = 120,
) -> DataFrame:
    """J8 + K2: first matching evidence texts and first services (else facilities) of each hit.

    evidence(issue_id, line_no, ts, text); state as `bundle_state` plus `first_seq`.
    """
    inside = hits.select("window_id", "issue_id").join(
        windows.select("window_id", "start_at", "end_at"), "window_id"
    ).join(evidence, "issue_id").filter(
        (F.col("ts") >= F.col("start_at")) & (micros("ts") < micros("end_at") + MILLI_US)
    )
    texts = first_per_group(inside, ["window_id", "issue_id"], [F.asc("line_no")], evidence_n).groupBy(
        "window_id", "issue_id"
    ).agg(F.array_sort(F.collect_list(F.struct("line_no", truncate("text", width).alias("text")))).alias("_t"))
    wanted = state.join(hits.select("issue_id").distinct(), "issue_id", "left_semi")
    kind = F.col("entity.type")
    firsts = first_per_group(wanted, ["issue_id", "entity_type"], [F.asc("first_seq")], entity_n) if (
        "entity_type" in wanted.columns
    ) else first_per_group(wanted.withColumn("entity_type", kind), ["issue_id", "entity_type"], [F.asc("first_seq")], entity_n)
    listed = firsts.groupBy("issue_id").agg(*[
        F.array_sort(F.collect_list(F.when(F.col("entity_type") == t, F.struct("first_seq", "entity_key")))).alias(f"_{t}")
        for t in ("service", "facility")
    ])
    scope = F.when(F.size("_service") > 0, F.col("_service.entity_key")).otherwise(F.col("_facility.entity_key"))
    return hits.join(texts, ["window_id", "issue_id"], "left").join(listed, "issue_id", "left").withColumn(
        "matching_evidence", F.coalesce(F.col("_t.text"), F.array().cast("array<string>"))
    ).withColumn("current_scope", F.coalesce(scope, F.array().cast("array<string>"))).drop("_t", "_service", "_facility")


# --- fuzzy text ----------------------------------------------------------------


def name_score(c: Column | str, query: str) -> Column:
    """0 for text containing the query, else edit distance over the longer length (case folded)."""
    text = F.lower(F.col(c) if isinstance(c, str) else c)
    q = query.lower()
    longest = F.greatest(F.length(text), F.lit(max(len(q), 1)))
    return F.when(F.contains(text, F.lit(q)), F.lit(0.0)).otherwise(F.levenshtein(text, F.lit(q)) / longest)


def fuzzy_search(df: DataFrame, cols: Sequence[str], queries: Sequence[str], threshold: float) -> DataFrame:
    """Q1: rows whose best score over columns and queries is within `threshold`, best first by `score`.

    Queries are literals, so each row is scored where it lies: no join, no shuffle, no
    candidate cut.
    """
    scores = [F.coalesce(name_score(c, q), F.lit(1.0)) for c in cols for q in queries]
    best = F.least(*scores) if len(scores) > 1 else scores[0]
    return df.withColumn("score", best).filter(F.col("score") <= threshold)


def trigrams(query: str) -> list[str]:
    q = query.lower()
    return sorted({q[i:i + 3] for i in range(max(len(q) - 2, 1))})


def text_score(c: Column | str, query: str) -> Column:
    """Share of the query's trigrams the text lacks; linear in the text, so fit for whole documents."""
    text = F.lower(F.col(c) if isinstance(c, str) else c)
    grams = trigrams(query)
    found = sum((F.contains(text, F.lit(g)).cast("int") for g in grams), F.lit(0))
    return F.coalesce(F.lit(1.0) - found / F.lit(float(len(grams))), F.lit(1.0))


def search_issues(
    issues: DataFrame, evidence: DataFrame, impact: DataFrame, query: str, k: int | None = None,
    threshold: float = 0.8,
) -> DataFrame:
    """Q2: best score per issue over id, title, evidence text, entity and scope ids."""
    names = [issues.select("issue_id", name_score("issue_id", query).alias("s")),
             issues.select("issue_id", name_score("title.`en-SG`", query).alias("s"))]
    texts = evidence.select("issue_id", text_score("text", query).alias("s"))
    ids = impact.select("issue_id", F.explode(F.array_compact(F.concat(
        F.array("entity.service_id", "entity.station_id"),
        F.coalesce(F.flatten(F.transform("service_scopes", lambda s: F.array(
            s["station_id"], s["from_station_id"], s["to_station_id"]))), F.array().cast("array<string>")),
    ))).alias("_id")).select("issue_id", name_score("_id", query).alias("s"))
    scored = texts
    for part in (*names, ids):
        scored = scored.unionByName(part)
    best = scored.groupBy("issue_id").agg(F.min("s").alias("score")).filter(F.col("score") <= threshold)
    ordered = best.orderBy("score", "issue_id")
    return ordered.limit(k) if k else ordered
