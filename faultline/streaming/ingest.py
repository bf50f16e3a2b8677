"""Streaming ingest with contract check, duplicate drop and dead letters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.functions.temporal import SGT, parse_instant
from faultline.lineage import discard, written
from faultline.plans.ingest import check_contract, ingest, write_ingest
from faultline.sources.writers import batch_done, read_batches


def checked_items(items: DataFrame, received_at: str | None = None, delay: str = "1 day") -> tuple[DataFrame, DataFrame]:
    """(accepted items once per delivery key, dead letters).

    The key is the report id, else the URL. Repeats within the watermark delay are dropped;
    the state that remembers keys is bounded by that delay. `received_at` names the event
    time column; without one the item's own creation time is used.
    """
    judged = check_contract(items)
    at = F.col(received_at) if received_at else parse_instant("createdAt")
    key = F.when(F.col("source") == "crowd-report", F.concat(F.lit("report:"), F.col("reportId"))).otherwise(F.concat(F.lit("url:"), F.col("url")))
    good = judged.filter((F.size("breaches") == 0) & at.isNotNull()).select("*", key.alias("delivery_key"), at.alias("event_time"))
    once = good.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["delivery_key"])
    dead = judged.filter((F.size("breaches") > 0) | at.isNull()).select("raw", "breaches")
    return once.drop("breaches"), dead


def write_stream(accepted: DataFrame, dead: DataFrame, target: str, checkpoint: str, available_now: bool = True):
    """Two queries: accepted items by batch id (idempotent on retry) and dead letters."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.partitionBy("batch_id").option(
            "partitionOverwriteMode", "dynamic").mode("overwrite").parquet(f"{target}/items")

    good = accepted.writeStream.foreachBatch(sink).option("checkpointLocation", f"{checkpoint}/items")
    bad = dead.writeStream.format("json").option("path", f"{target}/dead").option("checkpointLocation", f"{checkpoint}/dead")
    if available_now:
        good, bad = good.trigger(availableNow=True), bad.trigger(availableNow=True)
    return good.start(), bad.start()


def apply_batch(items: DataFrame, batch_id: int, decide: Callable[[DataFrame], tuple[DataFrame, DataFrame]], target: str, tz: str = SGT) -> bool:
    """C14 and S6 of one micro-batch against what `target` holds of its issues; False if the batch is already there.

    `decide` gives (decisions, claims) of the items, by item_id, as `ingest` takes them. A batch counts once its marker is
    written; one that broke off before is done again from the same state, whatever it left behind.
    """
    spark = items.sparkSession
    if batch_done(spark, target, batch_id):
        items.write.format("noop").mode("overwrite").save()  # a stream's state moves on only when its batch is read
        return False
    items, path = written(items)  # read several times; the stream itself is read once
    result = ingest(items, *decide(items), read_batches(spark, target, "impact"), read_batches(spark, target, "issue"), tz)
    result["rejected"].write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{target}/rejected/batch_id={batch_id}")
    write_ingest(result, target, batch_id)
    discard(spark, [path])
    return True


def ingest_stream(
    accepted: DataFrame, decide: Callable[[DataFrame], tuple[DataFrame, DataFrame]], target: str, checkpoint: str, tz: str = SGT, available_now: bool = True,
):
    """X1 to the end: accepted items become issues, evidence and events, one micro-batch after another.

    An item is known by its delivery key. Within a batch items apply in order of their time; batches apply in order of
    arrival, so the result equals one batch of everything if items arrive in order of their time.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        apply_batch(batch.withColumn("item_id", F.col("delivery_key")), batch_id, decide, target, tz)

    writer = accepted.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
