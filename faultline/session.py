"""Local session for tests, the benchmark and the oracle check."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def local_session(cores: int | str = 8, partitions: int = 8, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName("faultline")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def small_table(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """Literal rows as a local relation: planned with its true size, read without a Python task."""
    schema = StructType.fromDDL(ddl)
    table = pa.Table.from_pylist([dict(zip(schema.names, r)) for r in rows], schema=to_arrow_schema(schema))
    return spark.createDataFrame(table, schema)
