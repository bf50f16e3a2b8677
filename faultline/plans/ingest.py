"""Ingest of feed content given triage decisions and claims (C14)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline import schemas as S
from faultline.functions.temporal import OFFSET_PATTERN, SGT, parse_instant, to_local
from faultline.functions.text import issue_id_valid, labelled, slug
from faultline.lineage import cut_lineage
from faultline.operators import ordered
from faultline.operators.claims import issue_date
from faultline.operators.impact import compute_impact, number_events
from faultline.operators.state import bundle_state
from faultline.sources.writers import append_batch, in_buckets_of

SOURCES = ["twitter", "mastodon", "reddit", "news-website", "crowd-report"]


def strict_keys() -> Column:
    """Crowd reports may hold declared fields only."""
    keys = F.map_keys(F.from_json("raw", "map<string,string>"))
    return F.size(F.array_except(keys, F.array(*map(F.lit, S.CROWD_KEYS)))) == 0


def contract_rules() -> dict[str, Column]:
    """V1 of the feed: what an item must satisfy, by source."""
    crowd = F.col("source") == "crowd-report"
    c = lambda test: ~crowd | F.coalesce(test, F.lit(False))
    given = lambda *cols: sum((F.col(x).isNull().cast("int") for x in cols), F.lit(0)) == 0
    src = F.col("source")
    filled = lambda a: F.coalesce(F.size(a), F.lit(0)) > 0
    entries_ok = lambda a: F.coalesce(F.forall(a, lambda x: x != ""), F.lit(True))
    dated = lambda x: F.col(x).rlike(r"^\d{4}-\d{2}-\d{2}T") & F.col(x).rlike(OFFSET_PATTERN) & parse_instant(x).isNotNull()
    return {
        "source is known": src.isin(SOURCES),
        "url and createdAt given": given("url", "createdAt"),
        "post has account and text": ~src.isin("twitter", "mastodon") | given("accountName", "text"),
        "thread has subreddit, title and body": (src != "reddit") | given("subreddit", "title", "selftext"),
        "article has title and summary": (src != "news-website") | given("title", "summary"),
        "article text is not empty": (src != "news-website") | F.col("articleText").isNull() | (F.col("articleText") != ""),
        "article text source is known": (src != "news-website") | F.col("articleTextSource").isNull() | F.col("articleTextSource").isin(S.ARTICLE_TEXT_SOURCES),
        "report has id and text": c((F.col("reportId") != "") & (F.col("text") != "")),
        "report times carry offsets": c(dated("createdAt") & dated("observedAt")),
        "report observed before created": c(parse_instant("observedAt") <= parse_instant("createdAt")),
        "report names a line or station": c((filled("lineIds") | filled("stationIds")) & entries_ok("lineIds") & entries_ok("stationIds")),
        "report effect is known": c(F.col("effect").isNull() | F.col("effect").isin(S.CROWD_EFFECTS)),
        "report delay is not negative": c(F.col("delayMinutes").isNull() | (F.col("delayMinutes") >= 0)),
        "report count is positive": c(F.col("reportCount") > 0),
        "report url is HTTP": c(F.col("url").rlike(r"(?i)^https?://[^\s/?#]+")),
        "report has no unknown keys": c(strict_keys()),
    }


def check_contract(items: DataFrame) -> DataFrame:
    """Adds `breaches`, the names of the rules an item fails; works on streams too."""
    rules = contract_rules()
    return items.withColumn("breaches", F.array_compact(F.array(*[
        F.when(~F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in rules.items()])))


def content_text() -> Column:
    """Text of the evidence: labelled fields of the source, blanks skipped."""
    joined = lambda *fields: F.concat_ws("\n\n", *fields)
    crowd = joined(
        labelled("Report", "text"), labelled("Observed at", "observedAt"), labelled("Accepted at", "createdAt"),
        labelled("Lines", F.array_join("lineIds", ", ")), labelled("Stations", F.array_join("stationIds", ", ")),
        labelled("Direction", "directionText"), labelled("Effect", "effect"),
        labelled("Delay minutes", F.col("delayMinutes").cast("string")), labelled("Report count", F.col("reportCount").cast("string")))
    return (
        F.when(F.col("source") == "reddit", joined(labelled("Title", "title"), labelled("Body", "selftext")))
        .when(F.col("source") == "news-website", joined(labelled("Title", "title"), labelled("Summary", "summary"),
                                                         labelled("Article text", "articleText"), labelled("Article text source", "articleTextSource")))
        .when(F.col("source") == "crowd-report", crowd).otherwise(F.col("text"))
    )


DECISIONS = ("part-of-existing-issue", "part-of-new-issue", "irrelevant-content")


def evidence_rows(items: DataFrame, tz: str = SGT) -> DataFrame:
    """Evidence columns per item: id from its content hash, local timestamp text, type, text, URL."""
    at = parse_instant("createdAt")
    local = to_local(at, "timestamp", tz)
    offset = F.timestamp_diff("MINUTE", at.cast("timestamp_ntz"), local)
    sign = F.when(offset < 0, "-").otherwise("+")
    zone = F.concat(sign, F.lpad(F.floor(F.abs(offset) / 60).cast("string"), 2, "0"), F.lit(":"), F.lpad((F.abs(offset) % 60).cast("string"), 2, "0"))
    ts = F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss.SSS"), zone)
    media = F.col("source") == "news-website"
    shown = items.withColumn("createdAt", F.coalesce(ts, F.col("createdAt")))
    eid = F.concat(F.lit("ev_"), F.upper(F.substring(F.sha2(F.concat_ws("|", "source", "url", "createdAt", content_text()), 256), 1, 26)))
    return shown.select(
        "item_id", eid.alias("evidence_id"), F.col("createdAt").alias("ts"), at.alias("created_at"),
        F.when(media, "report.media").otherwise("report.public").alias("type"), content_text().alias("text"), F.col("url").alias("source_url"))


def ingest(
    items: DataFrame, decisions: DataFrame, claims: DataFrame, impact: DataFrame | None = None, issues: DataFrame | None = None, tz: str = SGT,
) -> dict[str, DataFrame]:
    """C14: new issues, evidence and events of a batch of items.

    items: `read_ingest` plus item_id; decisions(item_id, kind, issue_id, issue_type, title) with
    kind part-of-existing-issue, part-of-new-issue or irrelevant-content; claims: claim columns keyed
    by item_id. Irrelevant items and new issues without claims are dropped. Items of one issue
    apply in order of their time, so a batch equals one delivery after another. A new issue whose id is among `issues` goes on
    with that one. Of `impact` and `issues` from `read_batches` only the folders of the batch's issues are read. Items without a known
    decision, existing issues without an id and new ones whose id would be invalid are `rejected`, with a reason.
    """
    # the batch is written out before and after its issues are known: every later table reads it
    decided = cut_lineage(evidence_rows(items, tz)).join(decisions, "item_id", "left")
    undecided = decided.filter(~F.coalesce(F.col("kind").isin(*DECISIONS), F.lit(False))).select("item_id", F.lit("no known decision").alias("reason"))
    rows = decided.filter(F.col("kind").isin("part-of-existing-issue", "part-of-new-issue"))
    claimed = claims.select("item_id").distinct().withColumn("_claimed", F.lit(True))
    rows = rows.join(claimed, "item_id", "left").filter((F.col("kind") == "part-of-existing-issue") | F.col("_claimed"))
    keyed = claims.drop("issue_id", "evidence_id", "evidence_ts").join(rows.select("item_id", "evidence_id", "created_at"), "item_id")
    dated = issue_date(keyed.withColumn("issue_id", F.lit("")), "created_at").select("evidence_id", "issue_at")
    rows = rows.join(dated, "evidence_id", "left")
    day = F.date_format(to_local(F.coalesce("issue_at", "created_at"), "timestamp", tz), "yyyy-MM-dd")
    built = F.concat_ws("-", day, slug("title"))
    new = F.col("kind") == "part-of-new-issue"
    rows = rows.withColumn("issue_id", F.when(new, F.when(issue_id_valid(built), built)).otherwise(F.col("issue_id")))
    rows = cut_lineage(rows)
    nameless = rows.filter("issue_id is null").select("item_id", F.when(new, "invalid issue id").otherwise("no issue id").alias("reason"))
    rows = rows.filter("issue_id is not null")
    created = rows.filter(new).groupBy("issue_id").agg(F.min_by("issue_type", "created_at").alias("type"), F.min_by("title", "created_at").alias("title"))
    placed = ordered.rank(ordered.cut(rows, ["issue_id"], "created_at"), ["issue_id"], ["created_at", "evidence_id"], "ev_seq")
    order = placed.select("item_id", "issue_id", "evidence_id", F.col("created_at").alias("evidence_ts"), "ev_seq")
    full = cut_lineage(claims.drop("issue_id", "evidence_id", "evidence_ts").join(order, "item_id"))
    kinds = created.select("issue_id", "type")
    if issues is not None:
        issues = in_buckets_of(issues, rows).select("issue_id", "type").dropDuplicates(["issue_id"])
        created = created.join(issues, "issue_id", "left_anti")
        kinds = created.select("issue_id", "type").unionByName(issues)
    touched = in_buckets_of(impact, rows).join(rows.select("issue_id").distinct(), "issue_id", "left_semi") if impact is not None else None
    events = cut_lineage(compute_impact(full, kinds, bundle_state(touched) if touched is not None else None, tz))
    numbered = number_events(events)
    if touched is not None:
        last = touched.groupBy("issue_id").agg(F.max("seq").alias("_last"))
        numbered = numbered.join(last, "issue_id", "left").withColumn("seq", F.col("seq") + F.coalesce("_last", F.lit(0))).drop("_last")
    evidence = rows.select("issue_id", "evidence_id", "ts", "type", "text", "source_url")
    return {"issue": created, "evidence": evidence, "impact": numbered, "rejected": undecided.unionByName(nameless)}


def write_ingest(result: dict[str, DataFrame], target: str, batch_id: str | int) -> None:
    append_batch(result["evidence"], result["impact"], target, batch_id, result["issue"])
