"""Join of texts by the Jaccard similarity of their word n-grams, with Bayesian pruning of candidates.

MinHash bands propose pairs. A pair's MinHash values are compared part by part; it is dropped as soon as the posterior
probability of reaching the threshold falls below a tolerance. The rest are verified on their whole n-gram sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.lineage import cut_lineage
from faultline.llm.common import WORDS, buffers, components, fresh, odd_multipliers, pieces, small_batches, text_key, tokens, windows

#: Words of an n-gram, and the similarity from which two texts are linked.
WIDTH, THRESHOLD = 5, 0.8
#: MinHash values, and how bands are made of them: a pair at 0.8 shares no band once in 20 000 times.
HASHES, BANDS, ROWS = 128, 25, 5
#: Values compared at a time, and the posterior probability below which a pair is dropped.
STEP, TOLERANCE = 32, 1e-4
#: Texts, and n-grams, that one side of a comparison holds; larger buckets are met block by block.
BLOCK_TEXTS, BLOCK_GRAMS = 512, 500_000
#: Texts a task remembers to have met.
SEEN = 200_000

_A, _B = odd_multipliers(HASHES, 101), odd_multipliers(HASHES, 102)


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the n-grams of lower-case texts, and each text's first; a shorter text is one n-gram."""
    _, _, hashes, first = tokens(*buffers(texts), WORDS)
    return windows(hashes, first, WIDTH)


def signatures(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """MinHash values of each text (uint32); a text without n-grams has the greatest values."""
    count = np.diff(first)
    some = np.flatnonzero(count)
    out = np.full((len(count), HASHES), 0xFFFFFFFF, np.uint32)
    low = 0
    while low < len(some):  # small parts stay in the processor's cache
        high = max(low + 1, int(np.searchsorted(first[some], first[some[low]] + 16384)))
        own = hashes[first[some[low]]:first[some[high - 1] + 1]]
        at = first[some[low:high]] - first[some[low]]
        for k in range(HASHES):
            out[some[low:high], k] = np.minimum.reduceat(own * _A[k] + _B[k], at) >> np.uint64(32)
        low = high
    return out


def least_matches(n: int, threshold: float, tolerance: float) -> int:
    """Fewest matches among n values at which a pair stays: P(similarity >= threshold | matches) >= tolerance, flat prior."""
    below = 0.0
    for m in range(n + 1):
        below += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if below >= tolerance:
            return m
    return n + 1


class Group:
    """Texts of one bucket's block, or of two of its blocks, those of the first ahead."""

    def __init__(self, rows: pa.Table, least: list[int]):
        self.band, self.sigs, self.least = rows.column("band")[0].as_py(), _sigs(rows), least
        i, j = rows.column("i")[0].as_py(), rows.column("j")[0].as_py()
        self.cut = None if i == j else int(np.searchsorted(rows.column("side").to_numpy(), j))

    def pairs(self) -> Iterator[tuple[int, np.ndarray]]:
        """Each text with those after it (or of the other block) that this band is the first to pair and that survive pruning."""
        n = len(self.sigs)
        for a in range(n - 1 if self.cut is None else self.cut):
            others = np.arange(a + 1 if self.cut is None else self.cut, n)
            if self.band:
                equal = self.sigs[others, :self.band * ROWS] == self.sigs[a, :self.band * ROWS]
                others = others[~equal.reshape(len(others), self.band, ROWS).all(2).any(1)]
            same = np.zeros(len(others), np.int64)
            for k, need in enumerate(self.least):
                if not len(others):
                    break
                same += (self.sigs[others, k * STEP:(k + 1) * STEP] == self.sigs[a, k * STEP:(k + 1) * STEP]).sum(1)
                keep = same >= need
                others, same = others[keep], same[keep]
            if len(others):
                yield a, others


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of rows with equal (bucket, i, j), which stand together; a group is bounded by its blocks."""
    rest = None
    for batch in batches:
        rest = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
        keys = [rest.column(c).to_numpy() for c in ("bucket", "i", "j")]
        change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
        whole = rest.combine_chunks()
        for low, high in zip([0, *change[:-1]], change):
            yield whole.slice(low, high - low)
        if len(change):
            rest = whole.slice(change[-1])
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks()


def _sigs(rows: pa.Table) -> np.ndarray:
    column = rows.column("sig").combine_chunks() if rows.column("sig").num_chunks != 1 else rows.column("sig").chunk(0)
    at = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4)
    return np.frombuffer(column.buffers()[2], np.uint8)[at[0]:at[-1]].view(np.uint32).reshape(len(column), HASHES)


def link(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> tuple[DataFrame, DataFrame]:
    """(members, texts): members has doc_id and key of every row of `docs`, texts has key, root and links of each linked text.

    Texts are linked if the Jaccard similarity of their sets of 5-word n-grams (lower case, white space apart; a shorter text
    is one n-gram) is `threshold` or more. Equal texts are one text and have one key. `links` counts the other
    texts linked to one, `root` is the least key that a chain of links reaches. Empty and null texts have no links.
    A pair is examined in the first band that it shares, so it is counted once, and no row is made per pair: blocks of a
    bucket meet in one task, which gives each of their texts its number of links and a root.
    """
    small_batches(docs.sparkSession)
    least = [least_matches((k + 1) * STEP, threshold, tolerance) for k in range(HASHES // STEP)]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            for piece in pieces(batch, 0):
                keys = piece.column(1).to_pylist()
                new = np.zeros(len(keys), bool)
                for i, key in enumerate(keys):  # a text met before keeps its key only
                    if key not in seen:
                        if len(seen) >= SEEN:
                            seen.clear()
                        seen.add(key)
                        new[i] = True
                own = piece.filter(pa.array(new))
                hashes, first = grams(own.column(0))
                values = [None] * len(keys)
                for i, row, n in zip(np.flatnonzero(new).tolist(), signatures(hashes, first), np.diff(first).tolist()):
                    values[i] = row.tobytes() if n else None
                sizes = np.zeros(len(keys), np.int64)
                sizes[new] = np.diff(first)
                yield pa.RecordBatch.from_arrays([piece.column(2), piece.column(1), pa.array(sizes), pa.array(values, pa.binary())], ["doc_id", "key", "n", "sig"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.lower(text).alias("text"), text_key(text).alias("key"), "doc_id")
    kind = docs.schema["doc_id"].dataType.simpleString()
    lean = cut_lineage(rows.mapInArrow(sign, f"doc_id {kind}, key binary, n long, sig binary"))
    members = lean.select("doc_id", "key")
    texts = lean.filter("sig is not null").select("key", "n", "sig").dropDuplicates(["key"])

    size = ROWS * 4
    in_bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.struct(k.alias("band"), F.xxhash64(k, F.substring("sig", k * size + 1, F.lit(size))).alias("bucket")))
    banded = texts.select("key", "n", F.explode(in_bands).alias("b")).select("key", "n", "b.band", "b.bucket")
    shared = banded.groupBy("bucket").agg(F.count("*").alias("many"), F.sum("n").alias("n")).filter("many > 1")
    # written once: a join of two plain shuffles is one that Spark can split where a bucket is large
    shared = cut_lineage(shared.select("bucket", F.greatest(F.ceil(F.col("many") / BLOCK_TEXTS), F.ceil(F.col("n") / BLOCK_GRAMS)).cast("int").alias("blocks")))
    put = banded.drop("n").join(shared, "bucket").withColumn("side", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    with_sig = put.join(texts.select("key", "sig"), "key")
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(o, "side").alias("i"), F.greatest(o, "side").alias("j")))
    met = with_sig.select("bucket", "band", "side", "key", "sig", F.explode(meets).alias("m")).select("bucket", "m.i", "m.j", "band", "side", "key", "sig")
    together = lambda df: df.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "side", "key")

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in _groups(batches):
            if own.num_rows < 2:
                continue
            part = np.zeros(own.num_rows, bool)
            for a, others in Group(own, least).pairs():
                part[a] = part[others] = True
            if part.any():
                yield from own.filter(pa.array(part)).combine_chunks().to_batches()

    names = "bucket long, i int, j int, band int, side int, key binary, sig binary"
    likely = cut_lineage(together(met).mapInArrow(prune, names))
    sets = gram_sets(docs, likely.select("key").distinct())

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in _groups(batches):
            keys = own.column("key").to_pylist()
            found = [np.frombuffer(x.as_py(), np.uint64) for x in own.column("grams")]
            sizes = np.array([len(x) for x in found])
            begin = np.concatenate([[0], np.cumsum(sizes)])
            ids = np.unique(np.concatenate(found), return_inverse=True)[1]
            mark = np.zeros(int(ids.max(initial=-1)) + 1, bool)
            links, root = np.zeros(len(keys), np.int64), np.arange(len(keys))
            for a, others in Group(own, least).pairs():
                mark[ids[begin[a]:begin[a + 1]]] = True
                n = sizes[others]
                at = np.repeat(begin[others] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                both = np.add.reduceat(mark[ids[at]].astype(np.int64), np.cumsum(n) - n)
                mark[ids[begin[a]:begin[a + 1]]] = False
                good = others[both >= threshold * (sizes[a] + n - both) - 1e-9]
                links[a] += len(good)
                links[good] += 1
                for old in np.unique(root[np.append(good, a)])[1:].tolist():
                    root[root == old] = root[np.append(good, a)].min()
            some = np.flatnonzero(links)
            if len(some):
                yield pa.RecordBatch.from_arrays([pa.array([keys[x] for x in some]), pa.array([keys[x] for x in root[some]]), pa.array(links[some])], ["key", "root", "links"])

    checked = together(likely.join(sets, "key").select("bucket", "i", "j", "band", "side", "key", "sig", "grams"))
    found = cut_lineage(checked.mapInArrow(verify, "key binary, root binary, links long"))
    roots = components(found.select(F.col("key").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("key").agg(F.sum("links").alias("links"))
    return members, counts.join(roots.withColumnRenamed("node", "key"), "key")


def gram_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, grams) of the texts whose key is wanted; grams are the sorted 64-bit hashes, as bytes."""

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Without the texts this task met before, so that a text of very many rows is not sent that often."""
        seen: set[bytes] = set()
        for batch in batches:
            new = []
            for key in batch.column(0).to_pylist():
                new.append(key not in seen)
                if new[-1]:
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(key)
            yield batch.filter(pa.array(new, pa.bool_()))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, 1):
                hashes, first = grams(piece.column(1))
                sets = [np.unique(hashes[a:b]).tobytes() for a, b in zip(first[:-1], first[1:])]
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(sets, pa.binary())], ["key", "grams"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(text_key(text).alias("key"), F.lower(text).alias("text")).mapInArrow(once, "key binary, text string")
    return rows.join(wanted, "key", "left_semi").dropDuplicates(["key"]).mapInArrow(gather, "key binary, grams binary")


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of `docs`: doc_id, key, class_id, n_links, n_copies.

    `class_id` is the least doc_id among the documents that copies and links connect (null if all are null), `n_links` the number of
    other texts linked to this one, `n_copies` the number of rows of the same text, this one included.
    """
    members, texts = link(docs, threshold)
    own = members.groupBy("key").agg(F.count("*").alias("n_copies"), F.min("doc_id").alias("least"))
    own = cut_lineage(own.join(texts, "key", "left").select("key", "n_copies", "least", F.coalesce("root", "key").alias("root"), F.coalesce("links", F.lit(0)).alias("n_links")))
    ids = own.groupBy("root").agg(F.min("least").alias("class_id"))
    return members.join(own.join(ids, "root").drop("root", "least"), "key").select("doc_id", "key", "class_id", "n_links", "n_copies")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` without all but one of each class, with their own columns.

    Of a class the row of least doc_id stays (nulls last), among equals that of least text key; of rows equal in both, one.
    """
    key, same, kept_key, kept_id = (fresh(docs, name) for name in ("text_key", "same_rows", "kept_key", "kept_id"))
    members, texts = link(docs, threshold)
    order = F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "key")
    own = members.groupBy("key", "doc_id").agg(F.count("*").alias("same")).join(texts.select("key", "root"), "key", "left")
    best = own.groupBy(F.coalesce("root", "key").alias("root")).agg(F.min(F.struct(order.alias("order"), "same")).alias("best"))
    best = best.select(F.col("best.order.key").alias(kept_key), F.col("best.order.doc_id").alias(kept_id), F.col("best.same").alias(same))
    rows = docs.withColumn(key, text_key("text"))
    kept = rows.join(best, (F.col(key) == F.col(kept_key)) & F.col("doc_id").eqNullSafe(F.col(kept_id)))
    whole = kept.filter(F.col(same) == 1).unionByName(kept.filter(F.col(same) > 1).dropDuplicates([key]))
    return whole.select(*[F.col(f"`{c}`") for c in docs.columns])
