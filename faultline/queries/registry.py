"""Registry of bound queries and the helpers they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.functions.temporal import SGT, from_local, to_local

#: Bytes of tables (as stored) for each shuffle partition, and of shuffled rows that adaptive execution may give one task.
PART_BYTES, TASK_BYTES = 4 << 20, 8 << 20

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Driver tables of one scale factor, read on first use.

    The session's shuffle partitions follow the tables that are read, so that what a task sorts does not grow with them.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self._bytes = spark, folder, {}

    def __getattr__(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        if name not in self._bytes:
            self._bytes[name] = stored_bytes(self.spark, path)
            fit_partitions(self.spark, sum(self._bytes.values()))
        return self.spark.read.parquet(path)


def stored_bytes(spark: SparkSession, path: str) -> int:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(where).getLength()


def fit_partitions(spark: SparkSession, size: int) -> None:
    """One shuffle partition for every `PART_BYTES` of `size` at least; the session's own number where that is more.

    Adaptive execution merges small ones up to `TASK_BYTES`, or the session's size where that is less.
    """
    number, size_name, kept = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "faultline.shuffle.partitions"
    now = spark.conf.get(number)
    own, ours = (spark.conf.get(kept, "") or f"{now},").split(",")
    if now != ours:  # not the number set here last, so the session's
        own = now
    spark.conf.set(number, max(int(own), -(-size // PART_BYTES)))
    spark.conf.set(kept, f"{own},{spark.conf.get(number)}")
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(size_name)) > TASK_BYTES:
        spark.conf.set(size_name, str(TASK_BYTES))


def query(name: str, sql: str | None = None):
    """Register a function of `Tables` and, where SQL can say the same, its oracle."""

    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def text(c: Column | str) -> Column:
    """Wall-clock timestamp as text, the same in every client."""
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def sgt(c: Column | str) -> Column:
    """Table timestamps are wall time of the network's zone; as instants."""
    return from_local(F.col(c) if isinstance(c, str) else c, "timestamp", SGT)


def sgt_text(c: Column | str) -> Column:
    return text(to_local(c, "timestamp", SGT))


def minutes(c: Column) -> Column:
    return F.make_dt_interval(mins=c.cast("int"))


def sql_text(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f')"
