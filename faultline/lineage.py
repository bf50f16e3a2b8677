"""Cutting lineage for iterative operators, in storage that outlives an executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point the context at the shared checkpoint folder the session names.

    A folder of our own is made only for local masters (tests), because a
    machine-local folder is useless to the other executors of a cluster.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    configured = spark.conf.get("spark.checkpoint.dir", "") or ""
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="faultline-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable, eager checkpoint: lost executors re-read files instead of recomputing rounds."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> tuple[DataFrame, str]:
    """The rows written to a table of the shared folder and read again, and the table's path, for `discard`.

    For loops whose rounds join the result of the round before: a checkpoint hands on estimated sizes, and those of joins are
    products, so that their digits double with every round until planning takes longer than the work. A table has its true size.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables of `written` that nothing reads any more."""
    sc = spark.sparkContext
    for path in paths:
        where = sc._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)
    paths.clear()
