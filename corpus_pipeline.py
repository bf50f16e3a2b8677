"""Pipeline over documents: quality rules, one of each class of near copies, no benchmark text, no personal data, piece numbers.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.lineage import ensure_checkpoint_dir
from faultline.llm import decontaminate, ngram_join, pii, quality_rules, sentencepiece
from faultline.llm.common import small_batches

#: Log-likelihood ratios and MinHash have no SQL form.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality rules reject."""
    small_batches(spark)
    return quality_rules.filter_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of copies and near copies, the one of least doc_id."""
    return ngram_join.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that overlap a benchmark item."""
    small_batches(spark)
    return decontaminate.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data masked in the text; n_chars counts the new text."""
    clean = pii.redact(docs)
    if "n_chars" not in clean.columns:
        return clean
    kind = docs.schema["n_chars"].dataType
    return clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With the piece numbers of the text, and whether they decode to it."""
    small_batches(spark)
    back = sentencepiece.encode(docs, sentencepiece.load(), back="decoded")
    return back.withColumn("n_pieces", F.size("ids").cast("long")).withColumn("round_trip", F.col("decoded") == F.coalesce("text", F.lit(""))).drop("decoded")


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", one_of_each),
    ("benchmark decontamination", without_benchmark),
    ("PII", without_personal_data),
    ("SentencePiece encoding and decoding", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what lies between them is in the folder that executors share."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            _remove(spark, f"{folder}/{k - 1}")
    return docs


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
