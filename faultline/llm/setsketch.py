"""Near duplicates by SetSketch registers of word shingles.

A register is the least of exponentially distributed values of a set's elements, kept as the whole exponent of a base just above one and
cut off at both ends. Registers of a union are the greater of the registers of its parts, and equal registers tell of similarity. Bands of registers
propose pairs, the likelihood of the similarity given all registers of both sets drops the hopeless ones, whole sets decide.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.lineage import cut_lineage, discard, written
from faultline.llm.common import WORDS, buffers, components, fresh, odd_multipliers, pieces, small_batches, text_key, tokens, windows

#: Words of a shingle, and the similarity from which documents are linked, in hundredths.
WIDTH, PERCENT = 5, 85
#: Registers, base of their exponents, rate of the exponential values, and the greatest exponent (16 bits hold it and one more).
REGISTERS, BASE, RATE, TOP = 128, 1.001, 20.0, 2**16 - 3
#: Bands of registers: a pair at 0.85 shares no band twice in five million times.
BANDS, ROWS = 25, 5
#: A pair goes if its best similarity is below the limit and so much likelier than the limit itself (in natural logarithms): a pair at the limit does once in a million times.
MARGIN = 12.0
#: Texts, and shingles, that one side of a comparison holds; larger buckets are met block by block. Texts compared with one leader in a task.
BLOCK_TEXTS, BLOCK_SHINGLES, FOLLOWERS = 512, 500_000, 256
#: Texts a task remembers to have met.
SEEN = 200_000

_A, _B, _C = (odd_multipliers(REGISTERS, seed) for seed in (201, 202, 203))


def lower(text: Column) -> Column:
    """A to Z in lower case, nothing else changed; null is empty."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct 64-bit shingle hashes of each text, ascending, and where each text's begin (one more at the end)."""
    _, _, hashes, first = tokens(*buffers(texts), WORDS)
    found, at = windows(hashes, first, WIDTH)
    sets = [np.unique(found[a:b]) for a, b in zip(at[:-1], at[1:])]
    return (np.concatenate(sets) if sets else found), np.concatenate([[0], np.cumsum([len(s) for s in sets], dtype=np.int64)]).astype(np.int64)


def registers(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Registers (uint16) of each set of hashes; those of an empty set are 0."""
    count = np.diff(first)
    some = np.flatnonzero(count)
    out = np.zeros((len(count), REGISTERS), np.uint16)
    low = 0
    while low < len(some):  # small parts stay in the processor's cache
        high = max(low + 1, int(np.searchsorted(first[some], first[some[low]] + 16384)))
        own = hashes[first[some[low]]:first[some[high - 1] + 1]]
        at = first[some[low:high]] - first[some[low]]
        least = np.empty((high - low, REGISTERS), np.uint64)
        for k in range(REGISTERS):
            x = own * _A[k] + _B[k]
            x ^= x >> np.uint64(32)
            x *= _C[k]
            least[:, k] = np.minimum.reduceat(x, at)
        uniform = ((least >> np.uint64(11)).astype(np.float64) + 0.5) / 2**53  # exponential values grow with it, so the least is found first
        values = -np.log1p(-uniform) / RATE
        out[some[low:high]] = np.clip(np.floor(1 - np.log(values) / math.log(BASE)), 0, TOP + 1)
        low = high
    return out


def _tail(x: np.ndarray) -> np.ndarray:
    """Probability that a register is greater by reason of a share x of the union's elements."""
    return -np.log1p(-x * ((BASE - 1) / BASE)) / math.log(BASE)


def log_likelihood(similarity: np.ndarray, greater: np.ndarray, less: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Of a Jaccard similarity, given how many registers of the first set are greater and how many less; u is its share of both sizes."""
    tiny = 1e-300
    p, q = _tail(np.maximum(u - (1 - u) * similarity, 0)), _tail(np.maximum(1 - u - u * similarity, 0))
    return greater * np.log(np.maximum(p, tiny)) + less * np.log(np.maximum(q, tiny)) + (REGISTERS - greater - less) * np.log(np.maximum(1 - p - q, tiny))


def estimate(greater: np.ndarray, less: np.ndarray, n: np.ndarray, m: np.ndarray, steps: int = 40) -> np.ndarray:
    """Likeliest similarity of sets of n and m elements: the likelihood has one peak, found by golden sections."""
    u = n / (n + m)
    low, high = np.zeros(len(u)), np.minimum(n, m) / np.maximum(n, m)
    ratio = (math.sqrt(5) - 1) / 2
    for _ in range(steps):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        rising = log_likelihood(a, greater, less, u) < log_likelihood(b, greater, less, u)
        low, high = np.where(rising, a, low), np.where(rising, high, b)
    return (low + high) / 2


@lru_cache
def least_equal(percent: int) -> int:
    """Equal registers that a pair of the similarity has but once in a thousand million times; each is equal at least as likely as the similarity says."""
    below, share = 0.0, percent / 100
    for k in range(REGISTERS + 1):
        below += math.comb(REGISTERS, k) * share**k * (1 - share) ** (REGISTERS - k)
        if below > 1e-9:
            return k
    return REGISTERS


def may_reach(own: np.ndarray, others: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Whether pairs of sets may have the similarity, by their sizes and by the joint likelihood of their registers."""
    out = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
    out &= np.count_nonzero(own == others, axis=1) >= least_equal(percent)  # spares most pairs the likelihood
    at = np.flatnonzero(out)
    own = own[at] if own.ndim == 2 else own
    greater, less = (own > others[at]).sum(1), (own < others[at]).sum(1)
    a, b = np.broadcast_to(n, out.shape)[at].astype(np.float64), np.broadcast_to(m, out.shape)[at].astype(np.float64)
    best = estimate(greater, less, a, b, 20)
    limit = np.minimum(percent / 100, np.minimum(a, b) / np.maximum(a, b))
    gain = log_likelihood(best, greater, less, a / (a + b)) - log_likelihood(limit, greater, less, a / (a + b))
    out[at] = (best >= limit) | (gain <= MARGIN)
    return out


def merge_sketches(sketches: DataFrame, keys: list[str], sketch: str = "sketch") -> DataFrame:
    """Registers of the union of each group's sets: (keys, sketch), the greatest of every register; null sketches add nothing."""
    place, value = fresh(sketches, "place"), fresh(sketches, "value")
    each = F.transform(F.sequence(F.lit(0), F.lit(REGISTERS - 1)), lambda k: F.conv(F.hex(F.substring(F.col(sketch), 2 * k + 1, F.lit(2))), 16, 10).cast("int"))
    most = sketches.select(*keys, F.posexplode(each).alias(place, value)).groupBy(*keys, place).agg(F.max(value).alias(value))
    whole = F.array_sort(F.collect_list(F.struct(place, value)))
    return most.groupBy(*keys).agg(F.unhex(F.array_join(F.transform(whole, lambda s: F.lpad(F.hex(s[value]), 4, "0")), "")).alias(sketch))


def _new(keys: list, seen: set) -> np.ndarray:
    """Which keys a task has not met yet."""
    out = np.zeros(len(keys), bool)
    for i, key in enumerate(keys):
        if key not in seen:
            if len(seen) >= SEEN:
                seen.clear()
            seen.add(key)
            out[i] = True
    return out


def sketch(docs: DataFrame) -> DataFrame:
    """(doc_id, key, n, sketch) of every row: text name, number of distinct shingles and registers.

    Copies have one key; n and sketch are null where a task has met the text before, sketch also where there is no shingle.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            for piece in pieces(batch, 0):
                keys = piece.column(1).to_pylist()
                new = _new(keys, seen)
                hashes, first = shingle_sets(piece.column(0).filter(pa.array(new)))
                sizes, values = [None] * len(keys), [None] * len(keys)
                for i, row, n in zip(np.flatnonzero(new).tolist(), registers(hashes, first), np.diff(first).tolist()):
                    sizes[i], values[i] = n, row.astype(">u2").tobytes() if n else None
                yield pa.RecordBatch.from_arrays([piece.column(2), piece.column(1), pa.array(sizes, pa.int64()), pa.array(values, pa.binary())], ["doc_id", "key", "n", "sketch"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(lower(F.col("text")).alias("text"), text_key(lower(F.col("text"))).alias("key"), "doc_id")
    return rows.mapInArrow(sign, f"doc_id {kind}, key binary, n long, sketch binary")


def _texts(docs: DataFrame, wanted: DataFrame) -> tuple[DataFrame, str]:
    """(key, text) of the texts whose key is wanted, each once, and the path of the table that holds them."""

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            yield batch.filter(pa.array(_new(batch.column(0).to_pylist(), seen)))

    text = lower(F.col("text"))
    rows = docs.select(text_key(text).alias("key"), text.alias("text")).mapInArrow(once, "key binary, text string")
    return written(rows.join(wanted, "key", "left_semi").dropDuplicates(["key"]))


def _sets(held: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, shingles) of the texts whose key is wanted, as bytes of ascending hashes."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, 1):
                hashes, first = shingle_sets(piece.column(1))
                sets = [hashes[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(sets, pa.binary())], ["key", "shingles"])

    return held.join(wanted, "key", "left_semi").mapInArrow(gather, "key binary, shingles binary")


def _groups(batches: Iterator[pa.RecordBatch], by: tuple[str, ...]) -> Iterator[pa.Table]:
    """Runs of rows with equal values, which stand together."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in by]
        names = list(zip(*columns))
        low = 0
        for k, name in enumerate(names):
            if name != last:
                if k > low:
                    held.append(batch.slice(low, k - low))
                if held:
                    yield pa.Table.from_batches(held)
                held, low, last = [], k, name
        if len(names) > low:
            held.append(batch.slice(low))
    if held:
        yield pa.Table.from_batches(held)


def _registers(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in column), ">u2").astype(np.uint16).reshape(len(column), REGISTERS)


def follow(banded: DataFrame, texts: DataFrame, held: DataFrame, percent: int) -> DataFrame:
    """(a, b) links of texts to the leader of a bucket, its text of least key: one pair a text and bucket, equal pairs once."""
    pairs = cut_lineage(banded.filter("key <> leader").select("leader", "key").distinct())
    ahead = texts.select(F.col("key").alias("leader"), F.col("n").alias("m"), F.col("sketch").alias("other"))
    sides = pairs.join(texts, "key").join(ahead, "leader")

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = pa.Table.from_batches([batch])
                n, m = rows.column("n").to_numpy(), rows.column("m").to_numpy()
                good = may_reach(_registers(rows.column("sketch")), _registers(rows.column("other")), n, m, percent)
                yield batch.select(["leader", "key"]).filter(pa.array(good))

    likely = cut_lineage(sides.select("leader", "key", "n", "m", "sketch", "other").mapInArrow(prune, "leader binary, key binary"))
    # followers of one leader are dealt to parts, each of which gets the leader's set as well
    parts = cut_lineage(likely.groupBy("leader").agg(F.ceil(F.count("*") / FOLLOWERS).cast("int").alias("parts")))
    put = likely.join(parts, "leader").select("leader", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int").alias("part"), "key")
    own = parts.select("leader", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("leader").alias("key"))
    rows = cut_lineage(put.unionByName(own))
    together = rows.join(_sets(held, rows.select("key").distinct()), "key").select("leader", "part", (F.col("key") == F.col("leader")).alias("ahead"), "key", "shingles")
    together = together.repartition("leader", "part").sortWithinPartitions("leader", "part", F.desc("ahead"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, mine = None, np.zeros(0, np.uint64)
        for batch in batches:
            found = []
            for leader, ahead, key, shingles in zip(*[batch.column(c) for c in ("leader", "ahead", "key", "shingles")]):
                leader, own = leader.as_py(), np.frombuffer(shingles.as_buffer(), np.uint64)
                if ahead.as_py():
                    name, mine = leader, own
                elif name == leader and linked(mine, own, percent):
                    found.append((key.as_py(), leader))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.binary()) for k in (0, 1)], ["a", "b"])

    return cut_lineage(together.mapInArrow(verify, "a binary, b binary"))


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two ascending sets have the similarity."""
    n = len(a) + len(b)
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = n - len(np.union1d(a, b))
    return both > 0 and 100 * both >= percent * (n - both)


def across(banded: DataFrame, texts: DataFrame, roots: DataFrame, held: DataFrame, percent: int) -> DataFrame:
    """(a, b) links between texts of a bucket that no chain of links connects yet.

    Buckets whose texts are all connected are done. Of the others, blocks meet in one task; a pair is met in the first band that it
    shares, and only if its texts are not connected.
    """
    named = banded.join(cut_lineage(roots), "key", "left").select("bucket", "band", "key", "n", F.coalesce("root", "key").alias("root"))
    named = cut_lineage(named)
    open_ = named.groupBy("bucket").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.count("*").alias("many"), F.sum("n").alias("n")).filter("least <> most")
    blocks = F.greatest(F.ceil(F.col("many") / BLOCK_TEXTS), F.ceil(F.col("n") / BLOCK_SHINGLES)).cast("int")
    open_ = cut_lineage(open_.select("bucket", blocks.alias("blocks")))
    put = named.drop("n").join(open_, "bucket").withColumn("side", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(o, "side").alias("i"), F.greatest(o, "side").alias("j")))
    met = put.join(texts, "key").select("bucket", "band", "side", "key", "root", "n", "sketch", F.explode(meets).alias("m"))
    met = met.select("bucket", "m.i", "m.j", "band", "side", "key", "root", "n", "sketch")
    deal = lambda df: df.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "side", "key")

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in _groups(batches, ("bucket", "i", "j")):
            part = np.zeros(own.num_rows, bool)
            for a, others in _pairs(own, percent):
                part[a] = part[others] = True
            if part.any():
                yield from own.filter(pa.array(part)).combine_chunks().to_batches()

    kinds = "bucket long, i int, j int, band int, side int, key binary, root binary, n long, sketch binary"
    likely = cut_lineage(deal(met).mapInArrow(prune, kinds))
    shingled = _sets(held, likely.select("key").distinct())

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in _groups(batches, ("bucket", "i", "j")):
            keys = own.column("key").to_pylist()
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in own.column("shingles")]
            top = np.unique(np.array(own.column("root").to_pylist(), object), return_inverse=True)[1]
            found = []
            for a, others in _pairs(own, percent):
                for b in others.tolist():
                    if top[a] != top[b] and linked(sets[a], sets[b], percent):
                        top[top == top[b]] = top[a]
                        found.append((keys[a], keys[b]))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.binary()) for k in (0, 1)], ["a", "b"])

    whole = likely.join(shingled, "key").select("bucket", "i", "j", "band", "side", "key", "root", "n", "sketch", "shingles")
    return cut_lineage(deal(whole).mapInArrow(verify, "a binary, b binary"))


def _pairs(own: pa.Table, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each text of a block (or of the first of two) with those it meets here first, that are not connected with it and that may be similar."""
    sigs, n = _registers(own.column("sketch")), own.column("n").to_numpy()
    roots = np.unique(np.array(own.column("root").to_pylist(), object), return_inverse=True)[1]
    band, i, j = (own.column(c)[0].as_py() for c in ("band", "i", "j"))
    cut = None if i == j else int(np.searchsorted(own.column("side").to_numpy(), j))
    for a in range(len(sigs) - 1 if cut is None else cut):
        others = np.arange(a + 1 if cut is None else cut, len(sigs))
        others = others[roots[others] != roots[a]]
        if band and len(others):
            equal = sigs[others, :band * ROWS] == sigs[a, :band * ROWS]
            others = others[~equal.reshape(len(others), band, ROWS).all(2).any(1)]
        if len(others):
            others = others[may_reach(sigs[a], sigs[others], n[a], n[others], percent)]
        if len(others):
            yield a, others


def connect(docs: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(members, roots): members has doc_id, key and n of every row of `docs`; roots has key and root of each text linked to another.

    Texts (A-Z in lower case, words apart by white space) are linked if 100 * common >= percent * all of their distinct
    5-word shingles; a text of fewer words is one shingle, one without words is linked with nothing. `root` is the least key that links reach.
    All texts of a bucket are first compared with its least one; only texts that are then still apart are compared with each other, so a
    group of n copies costs n comparisons, and no link that would join two components is left out.
    """
    small_batches(docs.sparkSession)
    lean = cut_lineage(sketch(docs))
    texts = cut_lineage(lean.filter("sketch is not null").select("key", "n", "sketch").dropDuplicates(["key"]))
    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.struct(k.alias("band"), F.xxhash64(k, F.substring("sketch", k * (2 * ROWS) + 1, F.lit(2 * ROWS))).alias("bucket")))
    banded = texts.select("key", "n", F.explode(bands).alias("b")).select("key", "n", "b.band", "b.bucket")
    shared = cut_lineage(banded.groupBy("bucket").agg(F.min("key").alias("leader"), F.count("*").alias("many")).filter("many > 1").drop("many"))
    banded = cut_lineage(banded.join(shared, "bucket"))
    held, path = _texts(docs, banded.select("key").distinct())
    links = follow(banded, texts, held, percent)
    roots = components(links).withColumnRenamed("node", "key")
    more = across(banded, texts, roots, held, percent)
    discard(docs.sparkSession, [path])
    if not more.isEmpty():
        roots = components(links.unionByName(more)).withColumnRenamed("node", "key")
    sizes = lean.filter("n is not null").groupBy("key").agg(F.max("n").alias("n"))
    return lean.select("doc_id", "key"), cut_lineage(sizes.join(roots, "key", "left").select("key", "n", F.coalesce("root", "key").alias("root")))


def classes(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of `docs`.

    `component_id` is the least doc_id that links reach, the row's own included (null where all of them are null); `kept` tells whether it is
    the row's own. Rows of equal texts are linked with each other unless the text has no word: such a row is its own component.
    Of rows that repeat the least doc_id all are kept. A null text is empty, an empty table gives no rows; columns
    other than doc_id and text, whatever their names, are not read.
    """
    members, texts = connect(docs.select("doc_id", "text"), percent)
    least = members.groupBy("key").agg(F.min("doc_id").alias("least"))
    named = cut_lineage(least.join(texts, "key"))
    ids = cut_lineage(named.groupBy("root").agg(F.min("least").alias("component")))
    of = cut_lineage(named.join(ids, "root").select("key", "n", "component"))
    rows = members.join(of, "key")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component"))
    rows = rows.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
    return rows.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
