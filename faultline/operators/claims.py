"""Claims: merging, normalising, completing, anchoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from faultline.functions.text import digest_key
from faultline.operators.diff import dedup_semantic

CLAIM_FIELDS = ["entity", "effect", "scopes", "status_signal", "time_hints", "causes"]
TEMPLATE_FIELDS = [c for c in CLAIM_FIELDS if c != "entity"]
EVIDENCE_KEY = ["issue_id", "evidence_id"]
#: Order of claims where some are added: given ones first, then copies; by the (source) claim's number, then by place.
SEQ = "struct<origin:int,seq:bigint,place:bigint>"
GIVEN, COPIED = 0, 1


def ordered_seq(df: DataFrame, place: Column | int = 0, origin: int = GIVEN) -> Column:
    """`seq` of a table as an order of three columns; one that is so already stays."""
    if df.schema["seq"].dataType.simpleString() == SEQ:
        return F.col("seq")
    place = place if isinstance(place, Column) else F.lit(place)
    return F.struct(F.lit(origin).alias("origin"), F.col("seq").cast("long").alias("seq"), place.cast("long").alias("place"))


def last_non_null(value: Column, seq: str) -> Column:
    return F.max_by(value, F.when(value.isNotNull(), F.col(seq)))


def merge_claims(df: DataFrame, keys: Sequence[str], seq: str, values: Sequence[str]) -> DataFrame:
    """A4: one row per key; of each column the last non-null value in `seq` order."""
    return df.groupBy(*keys).agg(*[last_non_null(F.col(v), seq).alias(v) for v in values])


def normalize_claims(claims: DataFrame) -> DataFrame:
    """Empty causes to null, effect always a struct, daily on all seven days to daily."""
    hint = F.col("time_hints")
    every_day = (
        (hint["kind"] == "recurring") & (hint["frequency"] == "daily")
        & (F.size(F.array_distinct(hint["days_of_week"])) == 7)
    )
    days = F.when(F.coalesce(every_day, F.lit(False)), None).otherwise(hint["days_of_week"])
    return claims.withColumns({
        "causes": F.when(F.size("causes") > 0, F.col("causes")),
        "effect": F.struct(F.col("effect.service").alias("service"), F.col("effect.facility").alias("facility")),
        "time_hints": F.when(hint.isNotNull(), hint.withField("days_of_week", days)),
    })


def _active(revisions: Column, at: Column) -> Column:
    return F.exists(revisions, lambda r: (r["start_at"] <= at) & (r["end_at"].isNull() | (at < r["end_at"])))


def filter_inactive(claims: DataFrame, services: DataFrame) -> DataFrame:
    """Drop claims on known services without an active revision at the evidence instant.

    services(service_id, line_id, revisions array<struct<start_at, end_at>>) with instants.
    """
    dim = services.select(F.col("service_id").alias("_sid"), "revisions")
    joined = claims.join(dim, claims["entity.service_id"] == dim["_sid"], "left")
    known = (F.col("entity.type") == "service") & F.col("_sid").isNotNull()
    keep = ~known | F.coalesce(_active(F.col("revisions"), F.col("evidence_ts")), F.lit(False))
    return joined.filter(F.coalesce(keep, F.lit(True))).select(*claims.columns)


def complete_siblings(claims: DataFrame, services: DataFrame) -> DataFrame:
    """When two or more active services of a line carry one and the same whole-service
    claim, its other active services get a copy.

    Services are counted by two nested aggregations, so no evidence is gathered in one row. `seq` comes back as
    `SEQ`: copies follow all given claims, in order of the claim they copy and of the service.
    """
    claims = claims.withColumn("seq", ordered_seq(claims))
    whole = F.col("scopes").isNull() | F.forall("scopes", lambda s: s["type"] == "service.whole")
    eligible = claims.filter((F.col("entity.type") == "service") & F.col("effect.service").isNotNull() & whole)
    dim = services.select(F.col("service_id").alias("_sid"), "line_id", "revisions")
    lined = eligible.join(dim, eligible["entity.service_id"] == dim["_sid"]).filter(
        _active(F.col("revisions"), F.col("evidence_ts"))
    ).withColumn("_hash", digest_key(*TEMPLATE_FIELDS))
    others = [c for c in claims.columns if c not in (*EVIDENCE_KEY, "entity")]
    template = F.struct(*others)
    per_service = lined.groupBy(*EVIDENCE_KEY, "line_id", "_sid").agg(
        F.min("_hash").alias("_h0"), F.max("_hash").alias("_h1"), F.min("seq").alias("_seq"),
        F.min_by(template, "seq").alias("_t"),
    )
    lines = per_service.groupBy(*EVIDENCE_KEY, "line_id").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_h0").alias("_h0"), F.max("_h1").alias("_h1"),
        F.min("_seq").alias("_seq"), F.min_by("_t", "_seq").alias("_t"),
    ).filter("_n >= 2 and _h0 = _h1")
    place = W.partitionBy("line_id").orderBy("_sid")  # over the service dimension
    members = dim.withColumn("_pos", F.row_number().over(place))
    missing = lines.join(members, "line_id").filter(_active(F.col("revisions"), F.col("_t.evidence_ts"))).join(
        per_service.select(*EVIDENCE_KEY, "line_id", "_sid"), [*EVIDENCE_KEY, "line_id", "_sid"], "left_anti"
    )
    kinds = claims.schema["entity"].dataType
    entity = F.struct(*[
        {"type": F.lit("service"), "service_id": F.col("_sid")}.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
        for f in kinds.fields
    ])
    seq = F.struct(F.lit(COPIED).alias("origin"), F.col("_seq.seq").alias("seq"), F.col("_pos").cast("long").alias("place"))
    made = missing.select(*[
        F.col(c) if c in EVIDENCE_KEY else entity.alias(c) if c == "entity" else seq.alias(c) if c == "seq"
        else F.col(f"_t.{c}").alias(c) for c in claims.columns
    ])
    return claims.unionByName(made)


def anchor_claims(claims: DataFrame) -> DataFrame:
    """A service effect without a hint that is not cleared starts at the evidence."""
    fields = claims.schema["time_hints"].dataType.fields
    start_only = F.struct(*[
        {"kind": F.lit("start-only"), "start_at": F.col("evidence_ts")}.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
        for f in fields
    ])
    bare = (
        (F.col("entity.type") == "service") & F.col("effect.service").isNotNull()
        & F.col("time_hints").isNull() & ~F.col("status_signal").eqNullSafe("cleared")
    )
    return claims.withColumn("time_hints", F.when(F.coalesce(bare, F.lit(False)), start_only).otherwise(F.col("time_hints")))


def dedup_claims(claims: DataFrame, within: Sequence[str] = EVIDENCE_KEY) -> DataFrame:
    return dedup_semantic(claims, CLAIM_FIELDS, "seq", within)


def normalize_for_evidence(claims: DataFrame, services: DataFrame | None = None) -> DataFrame:
    """C4: C1, C2, J4, C3, C1 and D5 in this order; without services C2 and J4 are skipped and `seq` keeps its type.

    Both times only claims that differ in nothing but their hints can be equal, so these are brought together once.
    """
    out = normalize_claims(claims)
    if services is None:
        return dedup_claims(normalize_claims(anchor_claims(out)))
    within = [*EVIDENCE_KEY, "_alike"]
    done = complete_siblings(filter_inactive(out, services), services)
    alike = done.withColumn("_alike", digest_key(*[c for c in CLAIM_FIELDS if c != "time_hints"])).repartition(*within)
    return dedup_claims(normalize_claims(anchor_claims(dedup_claims(alike, within))), within).drop("_alike")


def clamp_hints(claims: DataFrame) -> DataFrame:
    """An open fixed hint that starts after its evidence starts at the evidence."""
    h = F.col("time_hints")
    late = (h["kind"] == "fixed") & h["end_at"].isNull() & (h["start_at"] > F.col("evidence_ts"))
    return claims.withColumn(
        "time_hints", F.when(F.coalesce(late, F.lit(False)), h.withField("start_at", F.col("evidence_ts"))).otherwise(h)
    )


def issue_date(claims: DataFrame, created: str = "created_at") -> DataFrame:
    """Per evidence the start of its first hint when fixed or recurring, else the created time."""
    first = claims.groupBy(*EVIDENCE_KEY).agg(
        F.min_by("time_hints", F.when(F.col("time_hints").isNotNull(), F.col("seq"))).alias("_h"),
        F.min(created).alias("_c"),
    )
    dated = F.col("_h.kind").isin("fixed", "recurring")
    return first.select(*EVIDENCE_KEY, F.when(dated, F.col("_h.start_at")).otherwise(F.col("_c")).alias("issue_at"))
