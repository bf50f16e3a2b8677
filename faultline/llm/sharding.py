"""Sharding by vector bin packing: bytes, tokens and rows are balanced jointly over a number of shards."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.lineage import cut_lineage
from faultline.llm.common import fresh

#: A group above this share of a shard, in any measure, is placed on its own before the rest; a bounded number are.
LARGE_SHARE = 1 / 64
#: A group above this share of a shard is cut, into pieces of about `CUT_TO` of a shard.
CUT_FROM, CUT_TO = 0.9, 0.25
#: A lighter group above this part of a shard's part of a bucket, in any measure, is placed before the small ones.
MEDIUM_PART = 1 / 4
#: Groups that one task packs.
PACK_ROWS = 20_000
#: Rows whose places in a shard one task counts.
SLOT_ROWS = 100_000


def pack(vectors: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shard of each item (row: bytes, tokens, rows), and the room left. Large items go first.

    `room` is what each shard can take of each measure, as a share of the items' sum. An item goes to the shard
    where its dot product with the room left is highest; a shard past its share has negative room. Ties go to the
    lower shard number.
    """
    scaled = vectors / np.maximum(vectors.sum(0), 1)
    room = room.copy()
    out = np.zeros(len(vectors), np.int32)
    for i in np.lexsort((np.arange(len(vectors)), -scaled.max(1))):
        best = int(np.argmax(room @ scaled[i]))
        out[i] = best
        room[best] -= scaled[i]
    return out, room


def _pack_buckets(room: np.ndarray):
    """Packs each bucket of a task's rows; a bucket's rows are together and in a fixed order.

    Each bucket sees the shards in an order of its own and with up to one mean item more room each, so that last items
    do not favour the same shards in all buckets.
    """

    def pack_one(vectors: np.ndarray, bucket: int) -> np.ndarray:
        rng = np.random.default_rng(bucket)
        order = rng.permutation(len(room)).astype(np.int32)
        return order[pack(vectors, room[order] + rng.random((len(room), 1)) / len(vectors))[0]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            rest = pa.concat_tables([rest, pa.Table.from_batches([batch])]) if rest is not None else pa.Table.from_batches([batch])
            bucket = rest.column("bucket").to_numpy()
            cut = int(np.searchsorted(bucket, bucket[-1])) if len(bucket) else 0
            if cut:
                yield from packed(rest.slice(0, cut))
                rest = rest.slice(cut)
        if rest is not None and rest.num_rows:
            yield from packed(rest)

    def packed(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        bucket = rows.column("bucket").to_numpy()
        edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(bucket) else []
        vectors = np.stack([rows.column(c).to_numpy() for c in ("bytes", "tokens", "rows")], 1).astype(np.float64)
        shard = np.concatenate([pack_one(vectors[a:b], int(bucket[a])) for a, b in zip(edges[:-1], edges[1:])])
        yield from rows.select(["key", "bytes", "tokens", "rows"]).append_column("shard", pa.array(shard)).to_batches()

    return run


def _dealt(groups: DataFrame, buckets: int, room: np.ndarray) -> DataFrame:
    """The groups and their shards, packed bucket by bucket."""
    rows = groups.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int"))
    dealt = rows.repartition(min(buckets, 20_000), "bucket").sortWithinPartitions("bucket", "key")
    return dealt.mapInArrow(_pack_buckets(room), "key binary, bytes long, tokens long, rows long, shard int")


def shard_documents(docs: DataFrame, shards: int = 16, keep_together: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, size, text_crc32, tokens, shard, slot.

    `size` is the UTF-8 length plus 1 (a null text has length 0 and the checksum of an empty one). Rows of equal
    text form a group and share a shard. Only a group above `CUT_FROM` of a shard is cut, by a hash of doc_id
    (equal ids of one text stay together). Groups above `LARGE_SHARE` of a shard, of which there can be no more
    than shards / LARGE_SHARE per measure, are placed first; the driver sees their sums. Small groups are dealt to buckets of about
    `PACK_ROWS` rows by hash. Those that would be much of a bucket (`MEDIUM_PART`) are packed before, `PACK_ROWS` groups to a
    task, into what the large ones left; then each bucket of small ones is packed on its own into what the measured sums
    of the shards leave. So no task and no driver ever holds all groups, and shards differ by the last small items of the
    buckets, or of the medium ones where small groups are too few to even them out. Slots count from 0
    without gaps in each shard, in an order of hashes. Same rows, same result, whatever the partitioning. An empty
    table gives an empty result.
    """
    text = F.coalesce(F.col(f"`{keep_together}`").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id"), F.octet_length(text).cast("long").alias("bytes"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.md5(text)).alias("key"), F.size(F.split(text, " ")).cast("long").alias("tokens"),
    )
    rows = cut_lineage(rows.withColumn("bytes", F.col("bytes") + 1))
    names = ("bytes", "tokens", "rows")
    measures = [F.sum("bytes").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")]
    whole = rows.agg(*measures).first()
    if not whole["rows"]:
        return rows.select("doc_id", F.col("bytes").alias("size"), "text_crc32", "tokens", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))

    groups = rows.groupBy("key").agg(*measures)
    of_shard = F.greatest(*[F.col(c) * F.lit(shards / whole[c]) for c in names])
    cuts = F.when(of_shard > CUT_FROM, F.ceil(of_shard / F.lit(CUT_TO))).otherwise(1).cast("int")
    large = groups.filter(of_shard > LARGE_SHARE).select("key", cuts.alias("cuts"))
    # at most 3 * shards / LARGE_SHARE groups, each row adds a few bytes
    piece = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("piece")), F.col("cuts")).cast("int")
    marked = rows.join(F.broadcast(large), "key", "left").withColumn("piece", piece).drop("cuts")

    heavy = marked.filter("piece is not null").groupBy("key", "piece").agg(*measures).orderBy("key", "piece").toArrow()
    vectors = np.stack([heavy.column(c).to_numpy() for c in names], 1).astype(np.float64)
    total = np.array([whole[c] for c in names], np.float64)
    filled = np.zeros((shards, len(names)))
    chosen = np.zeros(0, np.int32)
    if len(vectors):
        chosen, left = pack(vectors, np.full((shards, len(names)), 1.0) / shards * (total / vectors.sum(0)))
        np.add.at(filled, chosen, vectors)
    rest = np.maximum(total - vectors.sum(0), 1)
    room = (total / shards - filled) / rest
    placed = docs.sparkSession.createDataFrame(heavy.select(["key", "piece"]).append_column("shard", pa.array(chosen, pa.int32())), "key binary, piece int, shard int")

    buckets = math.ceil(whole["rows"] / PACK_ROWS)
    medium = (of_shard <= LARGE_SHARE) & (of_shard * buckets > F.lit(MEDIUM_PART))
    n_medium = groups.filter(medium).count()
    packed = None
    if n_medium:  # no more than 3 * shards / MEDIUM_PART for each bucket of rows
        packed = cut_lineage(_dealt(groups.filter(medium), math.ceil(n_medium / PACK_ROWS), room))
        for row in packed.groupBy("shard").agg(*measures).collect():
            filled[row["shard"]] += [row[c] for c in names]
        room = (total / shards - filled) / np.maximum(total - filled.sum(0), 1)
    small = _dealt(groups.filter((of_shard <= LARGE_SHARE) & ~medium), buckets, room)
    packed = (small if packed is None else small.unionByName(packed)).select("key", "shard")
    columns = ["doc_id", F.col("bytes").alias("size"), "text_crc32", "tokens", "shard", "key"]
    with_shard = marked.filter("piece is not null").join(F.broadcast(placed), ["key", "piece"]).select(*columns)
    with_shard = with_shard.unionByName(marked.filter("piece is null").join(packed, "key").select(*columns))

    parts = math.ceil(whole["rows"] / SLOT_ROWS)
    part = F.pmod(F.xxhash64("key", "doc_id", F.lit("slot")), F.lit(parts)).cast("int")
    return number_rows(cut_lineage(with_shard.withColumn(fresh(with_shard, "part"), part)), "shard", "part", ["key", "doc_id"]).drop("key", "part")


def number_rows(rows: DataFrame, group: str, part: str, order: list[str]) -> DataFrame:
    """Adds `slot`: 0, 1, ... in each group, ordered by part and then `order`.

    Only one (group, part) at a time is ordered by a task; parts are counted and their counts summed up before.
    """
    from pyspark.sql import Window

    counts = rows.groupBy(group, part).agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.withColumn("before", before).drop("n")
    inside = F.row_number().over(Window.partitionBy(group, part).orderBy(*order)) - 1
    return rows.withColumn("slot", inside).join(starts, [group, part]).withColumn("slot", F.col("slot") + F.col("before")).drop("before")
