"""Current state kept up to date over an event stream."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.lineage import discard


def streaming_state(log: DataFrame, keys: Sequence[str], attr: str, seq: str, values: Sequence[str]) -> DataFrame:
    """A1 continuously: update-mode aggregation ordered by `seq`, so late events never win.

    Keeps one row per (keys, attribute) in the state store, the size of the state itself.
    """
    return _newest(log, keys, attr, seq, values)


def _newest(rows: DataFrame, keys: Sequence[str], attr: str, seq: str, values: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys, attr).agg(F.max(seq).alias(seq), *[F.max_by(v, seq).alias(v) for v in values])


def write_state(
    state: DataFrame, target: str, checkpoint: str, keys: Sequence[str], attr: str, seq: str, available_now: bool = True, every: int = 50,
):
    """Update-mode sink: every batch's changed rows under its batch id, compacted every `every` batches; `read_state` takes the newest.

    A batch that comes again after a failure overwrites its own rows.
    """
    values = [c for c in state.columns if c not in (*keys, attr, seq)]

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id).cast("long")).write.partitionBy("batch_id").option(
            "partitionOverwriteMode", "dynamic").mode("overwrite").parquet(f"{target}/deltas")
        if batch_id % every == every - 1:
            compact_state(batch.sparkSession, target, keys, attr, seq, values, batch_id)

    writer = state.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def _numbers(spark: SparkSession, pattern: str) -> list[int]:
    """The numbers n of the folders `...=n` in the paths that fit the pattern."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return sorted(int(re.search(r"=(\d+)(/_SUCCESS)?$", f.getPath().toString())[1]) for f in found)


def _snapshots(spark: SparkSession, target: str) -> list[int]:
    """Finished snapshots, by the last batch they hold."""
    return _numbers(spark, f"{target}/snapshots/upto=*/_SUCCESS")


def _since(spark: SparkSession, target: str, upto: int | None = None) -> DataFrame:
    """The newest finished snapshot (of a batch up to `upto`) and the deltas behind it."""
    done = [n for n in _snapshots(spark, target) if upto is None or n <= upto]
    late = [n for n in _numbers(spark, f"{target}/deltas/batch_id=*") if n > (done[-1] if done else -1) and (upto is None or n <= upto)]
    paths = [f"{target}/snapshots/upto={done[-1]}"] if done else []
    return spark.read.parquet(*paths, *[f"{target}/deltas/batch_id={n}" for n in late])


def compact_state(spark: SparkSession, target: str, keys: Sequence[str], attr: str, seq: str, values: Sequence[str], upto: int, keep: int = 2) -> None:
    """Fold the deltas of batches up to `upto` into a new snapshot, then delete what older snapshots than the last `keep` needed.

    The stream's own deltas are written one batch at a time, so all up to `upto` are there when it calls this. Readers
    never see half a snapshot: one counts when its write has finished. The last `keep` snapshots, and the deltas behind the
    oldest of them, stay for readers that have already begun.
    """
    if upto not in _snapshots(spark, target):
        _newest(_since(spark, target, upto), keys, attr, seq, values).write.mode("overwrite").parquet(f"{target}/snapshots/upto={upto}")
    done = _snapshots(spark, target)
    if len(done) >= keep:
        late = [n for n in _numbers(spark, f"{target}/deltas/batch_id=*") if n <= done[-keep]]
        discard(spark, [f"{target}/snapshots/upto={n}" for n in done[:-keep]] + [f"{target}/deltas/batch_id={n}" for n in late])


def read_state(spark: SparkSession, target: str, keys: Sequence[str], attr: str, seq: str, values: Sequence[str]) -> DataFrame:
    """The state: the newest snapshot and the batches since, so that reading does not grow with the number of batches ever written."""
    return _newest(_since(spark, target), keys, attr, seq, values)
