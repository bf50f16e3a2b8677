"""Entity, NDJSON and bundle scans; lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from faultline import schemas
from faultline.functions.temporal import parse_instant
from faultline.schemas import EFFECT, ENTITY, PERIOD, SCOPE

CORRUPT = "_corrupt_record"


def read_entities(spark: SparkSession, root: str, collection: str) -> DataFrame:
    """One JSON document per file under root/<collection>, schema declared, file path kept.

    A document that does not parse keeps its text in `_corrupt_record`; repeated ids are
    `quality.unique_check(df, ["id"], ["path"])`.
    """
    schema = schemas.entity_schema(collection).add(CORRUPT, "string")
    docs = spark.read.schema(schema).option("multiLine", True).option("pathGlobFilter", "*.json").option(
        "columnNameOfCorruptRecord", CORRUPT).json(f"{root}/{collection}")
    return docs.withColumn("path", F.col("_metadata.file_path"))


def read_ndjson(spark: SparkSession, glob: str, schema: StructType | str) -> DataFrame:
    """(path, line_no, record, bad_line) with line numbers from 1; blank lines are skipped.

    A line's number is the order of the log, which a split reader loses. It is rebuilt from
    the place of a line in its file block and the line counts of the blocks before, so large
    logs stay splittable and no file stands in one row.
    """
    ddl = schema if isinstance(schema, str) else schema.simpleString()
    lines = spark.read.text(glob).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"), F.col("value").alias("line"))
    counts = lines.groupBy("path", "_block").agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_before", F.sum("_n").over(W.partitionBy("path").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)))
    local = lines.withColumn("_i", F.row_number().over(W.partitionBy("path", "_block").orderBy("_at")))
    later = counts.filter("_before is not null").select("path", "_block", "_before")
    lines = local.join(later, ["path", "_block"], "left").filter(F.trim("line") != "").select(
        "path", (F.col("_i") + F.coalesce("_before", F.lit(0))).cast("long").alias("line_no"), "line")
    record = F.from_json("line", ddl.removeprefix("struct<").removesuffix(">") if ddl.startswith("struct<") else ddl, {"mode": "PERMISSIVE"})
    parsed = lines.withColumn("record", record).withColumn("_ok", F.expr("try_parse_json(line)").isNotNull())
    return parsed.select("path", "line_no", F.when(F.col("_ok"), F.col("record")).alias("record"), F.when(~F.col("_ok"), F.col("line")).alias("bad_line"))


def bundle_path_columns(path: str = "path"):
    part = lambda i: F.regexp_extract(path, r"/issue/(\d{4})/(\d{2})/([^/]+)/[^/]+$", i)
    return part(1).alias("year"), part(2).alias("month"), part(3).alias("folder_id")


def _instants(period):
    start, end = parse_instant(period["startAt"]), parse_instant(period["endAt"])
    return F.struct(
        period["kind"].alias("kind"), start.alias("start_at"), end.alias("end_at"), period["frequency"].alias("frequency"),
        period["daysOfWeek"].alias("days_of_week"), period["timeWindow"]["startAt"].alias("window_start"),
        period["timeWindow"]["endAt"].alias("window_end"), period["timeZone"].alias("time_zone"), period["excludedDates"].alias("excluded_dates"),
    ).cast(PERIOD)


def impact_from_records(rows: DataFrame) -> DataFrame:
    """Native event columns from parsed log lines (issue_id, line_no, record)."""
    e = "record.entity"
    return rows.select(
        "issue_id", F.col("line_no").alias("seq"), F.col("record.id").alias("event_id"), F.col("record.type").alias("type"),
        F.struct(F.col(f"{e}.type"), F.col(f"{e}.serviceId").alias("service_id"), F.col(f"{e}.stationId").alias("station_id"),
                 F.col(f"{e}.lineId").alias("line_id"), F.col(f"{e}.kind")).cast(ENTITY).alias("entity"),
        parse_instant("record.ts").alias("ts"), F.col("record.basis.evidenceId").alias("evidence_id"),
        F.transform("record.periods", _instants).alias("periods"),
        F.transform("record.serviceScopes", lambda s: F.struct(
            s["type"].alias("type"), s["fromStationId"].alias("from_station_id"), s["toStationId"].alias("to_station_id"),
            s["stationId"].alias("station_id")).cast(SCOPE)).alias("service_scopes"),
        F.col("record.effect").cast(EFFECT).alias("effect"), F.col("record.causes").alias("causes"),
    )


def read_issue_bundles(spark: SparkSession, root: str, strict: bool = False) -> dict[str, DataFrame]:
    """S3: issue, evidence and impact tables of issue/YYYY/MM/<id> folders, and the breaches found.

    Breaches: folder id differs from the issue id, repeated folder ids, lines that do not
    parse and, when strict, missing log files. A missing file is otherwise an empty log.
    """
    base = f"{root}/issue/*/*/*"
    issue = spark.read.schema(schemas._s(schemas.ISSUE_JSON)).option("multiLine", True).json(f"{base}/issue.json").withColumn(
        "path", F.col("_metadata.file_path"))
    issue = issue.select(F.col("id").alias("issue_id"), "type", "title", F.col("titleMeta.source").alias("title_source"), "path", *bundle_path_columns())

    def log(name, ddl):
        files = f"{base}/{name}"
        path = spark._jvm.org.apache.hadoop.fs.Path(files)
        found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
        if found is None or len(found) == 0:
            empty = schemas._s(f"path string, line_no bigint, record struct<{ddl_fields(ddl)}>, bad_line string")
            rows = spark.createDataFrame([], empty)
        else:
            rows = read_ndjson(spark, files, ddl)
        return rows.select("*", *bundle_path_columns()).withColumnRenamed("folder_id", "issue_id")

    ev, im = log("evidence.ndjson", schemas.EVIDENCE_JSON), log("impact.ndjson", schemas.IMPACT_JSON)
    good = lambda df: df.filter("bad_line is null")
    evidence = good(ev).select(
        "issue_id", "line_no", F.col("record.id").alias("evidence_id"), "record.ts", "record.type", "record.text",
        F.col("record.sourceUrl").alias("source_url"), "record.render", "year", "month")
    note = lambda df, rule, loc, msg: df.select(F.lit(rule).alias("rule"), "path", loc.cast("string").alias("location"), msg.alias("message"))
    blank = F.lit("")
    faults = [
        note(issue.filter(~F.col("issue_id").eqNullSafe(F.col("folder_id"))), "folder id", blank, F.col("issue_id")),
        note(issue.groupBy("folder_id").agg(F.count(F.lit(1)).alias("n"), F.min("path").alias("path")).filter("n > 1"), "duplicate folder", blank, F.col("folder_id")),
        note(ev.filter("bad_line is not null"), "bad line", F.col("line_no"), F.col("bad_line")),
        note(im.filter("bad_line is not null"), "bad line", F.col("line_no"), F.col("bad_line")),
    ]
    if strict:
        for name in ("evidence.ndjson", "impact.ndjson"):  # scans skip empty files, the file index that Spark keeps anyway has them
            files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", name).load(f"{root}/issue")
            there = spark.createDataFrame([(path.split("/")[-2],) for path in files.inputFiles()], "folder_id string")
            faults.append(note(issue.join(there, "folder_id", "left_anti"), "missing log", blank, F.lit(name)))
    errors = faults[0]
    for f in faults[1:]:
        errors = errors.unionByName(f)
    impact = impact_from_records(good(im)).join(issue.select("issue_id", "year", "month"), "issue_id", "left")
    return {"issue": issue, "evidence": evidence, "impact": impact, "errors": errors}


def ddl_fields(ddl: str) -> str:
    return schemas._s(ddl).simpleString().removeprefix("struct<").removesuffix(">")


def lookup(df: DataFrame, ids: Sequence[str] | DataFrame, key: str = "id") -> DataFrame:
    """Rows by id; a DataFrame of ids becomes a semi-join."""
    if isinstance(ids, DataFrame):
        return df.join(ids.select(key), key, "left_semi")
    return df.filter(F.col(key).isin(list(ids)))


def list_ids(df: DataFrame, key: str = "id") -> DataFrame:
    return df.select(key).distinct().orderBy(key)


def list_bundles(issue: DataFrame) -> DataFrame:
    """Bundle ids by year, month and id."""
    return issue.select("year", "month", "issue_id").orderBy("year", "month", "issue_id")


def services_of_line(services: DataFrame, line_id: str) -> DataFrame:
    return services.filter(F.col("lineId") == line_id)


def read_ingest(spark: SparkSession, path: str, streaming: bool = False, per_batch: int | None = None) -> DataFrame:
    """One row per content item of the payload files, raw text kept for the strictness check.

    Payloads are lines of JSON; the same code reads a batch or a stream, which takes `per_batch` files at a time.
    """
    reader = spark.readStream if streaming else spark.read
    if per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    lines = reader.text(path) if not streaming else reader.format("text").load(path)
    items = lines.select(F.explode(F.from_json("value", "content array<string>")["content"]).alias("raw"))
    return items.withColumn("c", F.from_json("raw", schemas.INGEST_CONTENT)).select("raw", "c.*")
