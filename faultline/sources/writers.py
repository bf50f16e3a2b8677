"""Writers: entities, evidence batches, public export."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.functions.text import issue_id_valid
from faultline.lineage import cut_lineage
from faultline.operators.diff import fingerprint, fingerprint_bundle, fingerprint_rights
from faultline.operators.quality import raise_on_errors
from faultline.operators.rights import redact

SAFE_ID = r"^[A-Za-z0-9][A-Za-z0-9_-]*$"
BUCKETS = 256
BATCH_BUCKETS = 64  # folders of issues in a batch


class ExistingIds(ValueError):
    """A create-only write met ids that are already there."""


def exists(spark: SparkSession, target: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def holds_rows(spark: SparkSession, target: str) -> bool:
    """Whether a table has been written there, beside notes about it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/bucket=*")
    return bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path))


def _sample(df: DataFrame, key: str, n: int = 5) -> list:
    return [r[0] for r in df.select(key).limit(n).collect()]


def write_entities(df: DataFrame, target: str, mode: str = "create", key: str = "id", buckets: int = BUCKETS) -> None:
    """Create-only append, or upsert that rewrites only the id buckets it touches.

    The table is partitioned by a hash of the id, so an upsert of a few ids does not rewrite
    the rest, and a failed write leaves the old buckets in place. The number of buckets is kept with
    the table; `buckets` only counts for a new one.
    """
    spark = df.sparkSession
    noted = f"{target}/_buckets"
    if exists(spark, noted):
        buckets = spark.read.parquet(noted).first()[0]
    elif not exists(spark, target):
        spark.range(1).select(F.lit(buckets).alias("buckets")).write.parquet(noted)
    bad = df.filter(~F.coalesce(F.col(key).rlike(SAFE_ID), F.lit(False)))
    if not bad.isEmpty():
        raise ValueError(f"unsafe ids: {_sample(bad, key)}")
    rows = df.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    there = holds_rows(spark, target)
    old = spark.read.parquet(target) if there else None
    if mode == "create":
        repeated = df.groupBy(key).count().filter("count > 1")
        if not repeated.isEmpty():
            raise ExistingIds(f"repeated ids: {_sample(repeated, key)}")
        if there:
            clash = rows.join(old.select(key), key, "left_semi")
            if not clash.isEmpty():
                raise ExistingIds(f"existing ids: {_sample(clash, key)}")
        rows.write.partitionBy("bucket").mode("append").parquet(target)
        return
    if mode != "upsert":
        raise ValueError(f"unknown mode {mode}")
    if there:
        touched = rows.select("bucket").distinct()
        kept = old.join(F.broadcast(touched), "bucket", "left_semi").join(rows.select(key), key, "left_anti")  # <= `buckets` rows
        rows = cut_lineage(kept.select(*rows.columns).unionByName(rows))
    rows.write.partitionBy("bucket").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(target)


def create_issue(issue: DataFrame, target: str) -> None:
    """Issues with valid ids, create-only; missing title languages become null."""
    bad = issue.filter(~issue_id_valid("issue_id"))
    if not bad.isEmpty():
        raise ValueError(f"invalid issue ids: {_sample(bad, 'issue_id')}")
    write_entities(issue, target, "create", "issue_id")


def _found(spark: SparkSession, pattern: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return [f.getPath().toString() for f in path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []]


def batch_done(spark: SparkSession, target: str, batch_id: str | int) -> bool:
    """Whether the batch's marker has been written, with all its tables before."""
    return exists(spark, f"{target}/batches/id={batch_id}/_SUCCESS")


def issue_bucket() -> Column:
    """Folder of an issue within each batch."""
    return F.pmod(F.xxhash64("issue_id"), F.lit(BATCH_BUCKETS)).cast("int")


def append_batch(evidence: DataFrame, impact: DataFrame, target: str, batch_id: str | int, issue: DataFrame | None = None) -> None:
    """Evidence and the events it caused as one unit.

    Each table replaces the whole folder of its batch, split by a hash of the issue, and the marker comes last; readers
    see a batch only by its marker, so a failed or repeated delivery leaves no half batch.
    """
    spark = evidence.sparkSession
    tables = {"evidence": evidence, "impact": impact}
    if issue is not None:
        tables["issue"] = issue
    for name, df in tables.items():
        rows = df.withColumn("issue_bucket", issue_bucket()).hint("rebalance", "issue_bucket")  # a file a bucket, more for a large one
        rows.write.partitionBy("issue_bucket").option("partitionOverwriteMode", "static").mode("overwrite").parquet(f"{target}/{name}/batch_id={batch_id}")
    spark.range(1).select(F.lit(str(batch_id)).alias("batch_id")).write.mode("overwrite").parquet(f"{target}/batches/id={batch_id}")


def read_batches(spark: SparkSession, target: str, table: str) -> DataFrame | None:
    """Rows of the batches whose marker exists, with `batch_id` and `issue_bucket`; None if these hold none."""
    done = [path.split("/id=")[-1].removesuffix("/_SUCCESS") for path in _found(spark, f"{target}/batches/id=*/_SUCCESS")]
    filled = {path.split("/batch_id=")[-1].split("/")[0] for path in _found(spark, f"{target}/{table}/batch_id=*/issue_bucket=*")}
    paths = [f"{target}/{table}/batch_id={i}" for i in sorted(done) if i in filled]
    if not paths:
        return None
    return spark.read.option("basePath", f"{target}/{table}").parquet(*paths).withColumn("batch_id", F.col("batch_id").cast("string"))


def in_buckets_of(log: DataFrame, issues: DataFrame) -> DataFrame:
    """Rows of `read_batches` in the folders of the given issues, so that others are not read; other tables as they are."""
    if "issue_bucket" not in log.columns:
        return log
    buckets = [r[0] for r in issues.select(issue_bucket().alias("b")).distinct().collect()]  # BATCH_BUCKETS at most
    return log.filter(F.col("issue_bucket").isin(buckets)).drop("issue_bucket")


def export_public(
    entities: Mapping[str, DataFrame], issue: DataFrame, evidence: DataFrame, impact: DataFrame, rules: DataFrame, out: str,
    hidden_paths: Sequence[str] = (), root: str = "", check: Callable[[Mapping[str, DataFrame]], DataFrame] | None = None, licence: str = "",
) -> DataFrame:
    """Redact, validate, fingerprint and publish; returns the manifest.

    Records below a hidden path are left out where a table carries `path`: its first segments below `root` are a
    hidden path's. Evidence and events of hidden issues are left out too. `check` makes error rows of the tables;
    nothing is published if there are any. `redactions` has the number of redacted texts per issue. The manifest also
    has the digests of the rules and of the licence's text.
    """
    def hidden(df):
        below = F.regexp_replace("path", "^/+", "") if not root else F.regexp_replace(F.replace("path", F.lit(root.rstrip("/") + "/"), F.lit("")), "^/+", "")
        test = F.lit(False)
        for prefix in hidden_paths:
            test = test | F.startswith(F.concat(below, F.lit("/")), F.lit(prefix.strip("/") + "/"))
        return F.coalesce(test, F.lit(False))

    def visible(df):
        return df.filter(~hidden(df)).drop("path") if "path" in df.columns else df

    public = redact(evidence, rules)
    if "path" in issue.columns and hidden_paths:
        gone = issue.filter(hidden(issue)).select("issue_id")
        public, impact = public.join(gone, "issue_id", "left_anti"), impact.join(gone, "issue_id", "left_anti")
    tables = {**{k: visible(v) for k, v in entities.items()}, "issue": visible(issue), "impact": impact,
              "evidence": public.drop("redacted")}
    if check is not None:
        raise_on_errors(check(tables))
    public.groupBy("issue_id").agg(F.count_if("redacted").alias("redacted")).write.mode("overwrite").parquet(f"{out}/redactions")
    for name, df in tables.items():
        parts = ["year", "month"] if {"year", "month"} <= set(df.columns) else []
        df.write.partitionBy(*parts).mode("overwrite").parquet(f"{out}/{name}")
    manifest = fingerprint_bundle(
        tables["issue"], tables["evidence"], impact, *[
            [c for c in t.columns if c not in ("year", "month", "issue_id")] for t in (tables["issue"], tables["evidence"], impact)])
    for name in entities:
        df = tables[name]
        manifest = manifest.unionByName(fingerprint(df, "id", df.columns, name))
    manifest = manifest.unionByName(fingerprint_rights(rules, licence))
    manifest.write.mode("overwrite").parquet(f"{out}/manifest")
    return manifest.sparkSession.read.parquet(f"{out}/manifest")
