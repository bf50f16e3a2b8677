"""Differences, fingerprints and id-preserving matches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.functions.text import digest, digest_key, stable_json
from faultline.operators import ordered


def diff_ids(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Every id with status added, removed or shared. One aggregation over both sides."""
    sides = a.select(F.col(key), F.lit(1).alias("_s")).unionByName(b.select(F.col(key), F.lit(2).alias("_s")))
    mask = sides.groupBy(key).agg(F.bit_or("_s").alias("_m"))
    return mask.select(key, F.when(F.col("_m") == 1, "removed").when(F.col("_m") == 2, "added").otherwise("shared").alias("status"))


def table_diff(a: DataFrame, b: DataFrame, key: str, groups: Mapping[str, Sequence[str]]) -> DataFrame:
    """Status per id and, for shared ids, one flag per named group of columns."""
    used = sorted({c for cols in groups.values() for c in cols})
    left = a.select(F.col(key).alias("_ka"), *[F.col(c).alias(f"_a_{c}") for c in used])
    right = b.select(F.col(key).alias("_kb"), *[F.col(c).alias(f"_b_{c}") for c in used])
    joined = left.join(right, left["_ka"] == right["_kb"], "full_outer")
    ka, kb = F.col("_ka"), F.col("_kb")
    status = F.when(ka.isNull(), "added").when(kb.isNull(), "removed").otherwise("shared")

    def changed(cols: Sequence[str]) -> Column:
        test = F.lit(False)
        for c in cols:
            test = test | ~F.col(f"_a_{c}").eqNullSafe(F.col(f"_b_{c}"))
        return F.when(ka.isNotNull() & kb.isNotNull(), test)

    return joined.select(
        F.coalesce(ka, kb).alias(key), status.alias("status"),
        *[changed(cols).alias(f"{name}_changed") for name, cols in groups.items()],
    )


def category_counts(df: DataFrame, column: str, domain: Sequence[str]) -> DataFrame:
    """Rows per category of the domain, absent ones as zero, in one pass."""
    one = df.groupBy().agg(*[F.count_if(F.col(column) == v).alias(f"c{i}") for i, v in enumerate(domain)])
    entries = F.array(*[F.struct(F.lit(v).alias("category"), F.col(f"c{i}").alias("n")) for i, v in enumerate(domain)])
    return one.select(F.inline(entries))


def count_delta(a: DataFrame, b: DataFrame, column: str, domain: Sequence[str]) -> DataFrame:
    """Counts in both snapshots and their difference."""
    both = a.select(F.col(column).alias("v"), F.lit(0).alias("side")).unionByName(
        b.select(F.col(column).alias("v"), F.lit(1).alias("side"))
    )
    one = both.groupBy().agg(*[
        F.count_if((F.col("v") == v) & (F.col("side") == s)).alias(f"c{i}_{s}")
        for i, v in enumerate(domain) for s in (0, 1)
    ])
    entries = F.array(*[
        F.struct(F.lit(v).alias("category"), F.col(f"c{i}_0").alias("n_from"), F.col(f"c{i}_1").alias("n_to"))
        for i, v in enumerate(domain)
    ])
    return one.select(F.inline(entries)).withColumn("delta", F.col("n_to") - F.col("n_from"))


def last_line_order(constraints: DataFrame, rule_order: Column) -> DataFrame:
    """D3: line order in force - of the last line_order constraint, else of the rule set."""
    is_order = F.col("type") == "line_order"
    return constraints.groupBy().agg(
        F.coalesce(F.max_by("line_ids", F.when(is_order, F.col("pos"))), F.first(rule_order)).alias("line_order")
    )


def input_diff(a: DataFrame, b: DataFrame, key: str = "id", pos: str = "pos") -> DataFrame:
    """D3: constraints added, removed or changed (any column but the position)."""
    cols = [c for c in a.columns if c not in (key, pos)]
    return table_diff(a, b, key, {"constraint": cols})


def coverage(derived: DataFrame, inventory: DataFrame, key: str) -> DataFrame:
    """Keys missing from the derived set or absent from the inventory."""
    named = diff_ids(derived, inventory, key).filter("status <> 'shared'")
    return named.select(key, F.when(F.col("status") == "added", "missing_from_derived").otherwise("not_in_inventory").alias("status"))


def only_in(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys of a that b lacks."""
    return a.select(key).distinct().join(b.select(key), key, "left_anti")


def dedup_semantic(df: DataFrame, by: Sequence[str], seq: str, within: Sequence[str] = ()) -> DataFrame:
    """First row per equal content, whatever the order of fields; combines before the shuffle.

    Rows that already stand together by some of `within` are not shuffled.
    """
    row = F.struct(*[c for c in df.columns if c not in within])
    kept = df.withColumn("_hash", digest_key(*by)).groupBy(*within, "_hash").agg(F.min_by(row, seq).alias("_row"))
    return kept.select(*[F.col(c) if c in within else F.col(f"_row.{c}") for c in df.columns])


def preserve_ids(
    new: DataFrame, old: DataFrame, id_col: str, by: Sequence[str], seq: str, within: Sequence[str] = ("issue_id",),
    hot_rows: int | None = ordered.HOT_ROWS,
) -> DataFrame:
    """The n-th new row of some content takes the id of the n-th old row with that content."""
    def numbered(df):
        hashed = df.withColumn("_hash", digest(*by))
        keys = [*within, "_hash"]
        return ordered.uncut(ordered.rank(ordered.cut(hashed, keys, seq, hot_rows), keys, [seq], "_nth"))

    right = numbered(old).select(*within, "_hash", "_nth", F.col(id_col).alias("_old_id"))
    joined = numbered(new).join(right, [*within, "_hash", "_nth"], "left")
    return joined.withColumn(id_col, F.coalesce("_old_id", id_col)).select(*new.columns)


def replay_summary(old: DataFrame, new: DataFrame, issue: str = "issue_id") -> DataFrame:
    """Events before, after and their difference per issue; the null issue is the total."""
    sides = old.select(issue, F.lit(1).alias("b"), F.lit(0).alias("a")).unionByName(
        new.select(issue, F.lit(0).alias("b"), F.lit(1).alias("a"))
    )
    return sides.rollup(issue).agg(
        F.coalesce(F.sum("b"), F.lit(0)).alias("before"), F.coalesce(F.sum("a"), F.lit(0)).alias("after")
    ).withColumn("diff", F.col("after") - F.col("before"))


def fingerprint(df: DataFrame, key: str, cols: Sequence[str], collection: str) -> DataFrame:
    """M1: sha256 of each record's canonical JSON."""
    return df.select(F.lit(collection).alias("collection"), F.col(key).cast("string").alias("id"), digest(*cols).alias("sha256"))


#: Words of a row's hash that are summed, and what they are summed by.
LANES, LANE = 4, 2**64


def _lanes(text: Column) -> list[Column]:
    """The words of a row's hash as numbers."""
    h = F.sha2(text, 256)
    return [F.conv(F.substring(h, 16 * i + 1, 16), 16, 10).cast("decimal(20,0)").alias(f"_w{i}") for i in range(LANES)]


def multiset_digest(rows: DataFrame, by: Sequence[str], text: Column) -> DataFrame:
    """(by, n, sha256) of each group's rows in any order, repeated rows counted.

    Every word of the rows' hashes is summed modulo 2^64: a group of any number of rows combines before the shuffle in constant
    space, and unlike an exclusive-or a row that stands there twice does not vanish.
    """
    sums = rows.select(*by, *_lanes(text)).groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"_w{i}").alias(f"_w{i}") for i in range(LANES)])
    words = [F.coalesce(F.pmod(F.col(f"_w{i}"), F.lit(str(LANE)).cast("decimal(20,0)")).cast("decimal(20,0)").cast("string"), F.lit("0")) for i in range(LANES)]
    return sums.select(*by, "n", F.sha2(F.concat_ws("|", F.col("n").cast("string"), *words), 256).alias("sha256"))


def fingerprint_bundle(
    issue: DataFrame, evidence: DataFrame, impact: DataFrame,
    issue_cols: Sequence[str], evidence_cols: Sequence[str], impact_cols: Sequence[str],
) -> DataFrame:
    """M1: one digest per bundle over its issue, evidence and events, each row with its place in its file."""
    def placed(df, cols, tag, place):
        return df.select("issue_id", F.concat_ws("|", F.lit(tag), place.cast("string"), stable_json(*cols)).alias("_text"))

    rows = placed(issue, issue_cols, "issue", F.lit(0)).unionByName(
        placed(evidence, evidence_cols, "evidence", F.col("line_no"))).unionByName(placed(impact, impact_cols, "impact", F.col("seq")))
    made = multiset_digest(rows, ["issue_id"], F.col("_text"))
    return made.select(F.lit("issues").alias("collection"), F.col("issue_id").alias("id"), "sha256")


def fingerprint_table(df: DataFrame, cols: Sequence[str], collection: str, name: str) -> DataFrame:
    """M1: one digest of a whole table, its rows in any order; an empty table has one as well."""
    made = multiset_digest(df, [], stable_json(*cols))
    return made.select(F.lit(collection).alias("collection"), F.lit(name).alias("id"), "sha256")


def fingerprint_rights(registry: DataFrame, licence: str) -> DataFrame:
    """M1: digests of the data licence's text (empty where there is none) and of the source registry."""
    text = registry.sparkSession.range(1).select(F.lit("rights").alias("collection"), F.lit("licence_data").alias("id"), F.sha2(F.lit(licence), 256).alias("sha256"))
    return text.unionByName(fingerprint_table(registry, registry.columns, "rights", "source_registry"))


def changed(a: DataFrame, b: DataFrame) -> DataFrame:
    """M2: manifest rows added, removed or with another hash."""
    k = ["collection", "id"]
    joined = a.withColumnRenamed("sha256", "_ha").join(b.withColumnRenamed("sha256", "_hb"), k, "full_outer")
    status = F.when(F.col("_ha").isNull(), "added").when(F.col("_hb").isNull(), "removed").when(
        F.col("_ha") != F.col("_hb"), "changed")
    return joined.select(*k, status.alias("status")).filter("status is not null")
