"""Point-feature import."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.functions.text import exit_label, natural_key, station_name_key
from faultline.operators.quality import first_seen

FEATURE = (
    "struct<type:string,geometry:struct<type:string,coordinates:array<double>>,properties:struct<"
    "STATION_NA:string,EXIT_CODE:string,OBJECTID:long,INC_CRC:string,FMEL_UPD_D:string>>"
)


def read_features(spark, path: str) -> DataFrame:
    doc = spark.read.schema(f"type string, features array<{FEATURE}>").option("multiLine", True).json(path)
    return doc.filter("type = 'FeatureCollection'").select(F.explode("features").alias("f")).select(
        F.col("f.geometry.type").alias("geometry"), F.col("f.geometry.coordinates").alias("coordinates"),
        F.col("f.properties.STATION_NA").alias("station_name"), F.col("f.properties.EXIT_CODE").alias("exit_code"),
        F.col("f.properties.OBJECTID").alias("object_id"), F.col("f.properties.INC_CRC").alias("checksum"),
        F.col("f.properties.FMEL_UPD_D").alias("updated"))


def import_point_features(features: DataFrame, stations: DataFrame) -> dict[str, DataFrame]:
    """Matched exits per station in natural label order, unmatched, invalid and duplicate features.

    A source name that looks like a station code resolves by code, any other by its name
    without the kind suffix. Both are equi-joins. `position` orders the exits of a station;
    it is a sort key, so exits need not be gathered per station.
    """
    day = F.try_to_timestamp(F.substring("updated", 1, 8), F.lit("yyyyMMdd")).cast("date")
    valid = (
        F.col("station_name").isNotNull() & exit_label("exit_code").isNotNull() & F.col("object_id").isNotNull()
        & F.col("checksum").rlike("^[0-9A-F]{16}$") & (F.col("geometry") == "Point") & (F.size("coordinates") == 2)
        & F.forall("coordinates", lambda c: c.isNotNull() & ~F.isnan(c)) & F.col("updated").rlike(r"^\d{14}$") & day.isNotNull()
    )
    judged = features.withColumn("_ok", F.coalesce(valid, F.lit(False)))
    good = judged.filter("_ok").drop("_ok")
    source = F.upper(F.trim("station_name"))
    is_code = source.rlike(r"^[A-Z]+\d+[A-Z]?$")
    keyed = good.withColumn("_key", F.when(is_code, F.concat(F.lit("code:"), source)).otherwise(
        F.concat(F.lit("name:"), station_name_key("station_name"))))
    codes = stations.select("id", F.explode("stationCodes.code").alias("_c")).select(
        F.concat(F.lit("code:"), F.upper("_c")).alias("_key"), F.col("id").alias("station_id"))
    names = stations.select(F.concat(F.lit("name:"), station_name_key("name.`en-SG`")).alias("_key"), F.col("id").alias("station_id"))
    keys = codes.unionByName(names).distinct()
    clash = keys.groupBy("_key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("_key").alias("key"))
    joined = keyed.join(keys, "_key", "left")
    matched = joined.filter("station_id is not null").select(
        "station_id", "object_id", "checksum", exit_label("exit_code").alias("label"), day.alias("last_updated"),
        F.element_at("coordinates", 2).alias("latitude"), F.element_at("coordinates", 1).alias("longitude"),
        F.struct(natural_key(exit_label("exit_code")).alias("label"), F.col("object_id").alias("id")).alias("position"))
    return {
        "matched": matched, "unmatched": joined.filter("station_id is null").select("station_name").distinct(),
        "invalid": judged.filter(~F.col("_ok")).drop("_ok"), "ambiguous_stations": clash,
        "duplicate": first_seen(good.select("object_id", "station_name", "exit_code"), ["object_id"], ["station_name", "exit_code"]),
        "summary": joined.groupBy().agg(
            F.count(F.lit(1)).alias("features"), F.count_if(F.col("station_id").isNotNull()).alias("imported"),
            F.count_distinct("station_id").alias("stations")),
    }
