"""Benchmark decontamination by spaced seeds: fixed masks ignore chosen word positions, so that substitutions are tolerated."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from faultline.lineage import cut_lineage
from faultline.llm.common import PLAIN, buffers, fresh, mix, odd_multipliers, pieces, tokens

#: Word positions that count. Together the masks meet any 12 words with two substitutions, 10 with one, 20 with four.
MASKS = ((0, 3, 5, 6, 8, 9), (0, 2, 3, 5, 6, 7), (0, 1, 4, 5, 6, 7), (0, 1, 2, 4, 8, 9))
SPAN = 10
#: With these, items of 10 and 11 words are met whatever two of their words are substituted.
SHORT_MASKS = ((0, 1, 2, 3, 4, 6), (0, 1, 3, 5, 7, 8))
#: Shorter items are no evidence; items below `SPAN` words must occur word for word.
LEAST_WORDS = 5
#: An overlap counts with this many equal words, or this share of a shorter item's; and with this share of equal words.
ENOUGH, SHARE = 13, 0.8
#: Cost of a substitution against a match: segments whose sum is not negative are exactly those of `SHARE`.
SUBSTITUTION = 4
#: Words of test items a task holds at once; more items are met in as many passes.
BLOCK_WORDS = 2_000_000

_FACTORS = odd_multipliers(64, 29)
_FILTER_BITS = 22


def seed_keys(hashes: np.ndarray, mask: tuple[int, ...], number: int) -> np.ndarray:
    """Key of the masked words at each start."""
    n = max(len(hashes) - mask[-1], 0)
    out = np.full(n, number, np.uint64)
    for j, offset in enumerate(mask):
        out += hashes[offset:offset + n] * _FACTORS[j]
    return mix(out)


class Items:
    """Test items and their seeds: keys in order, with the item and word each starts at."""

    def __init__(self, items: list[tuple[object, str | None]]):
        texts = pa.array([text for _, text in items], pa.string())
        _, _, hashes, first = tokens(*buffers(texts), PLAIN)
        self.names = [name for name, _ in items]
        self.words = [hashes[a:b] for a, b in zip(first[:-1], first[1:])]
        near = any(SPAN <= len(w) < SPAN + 2 for w in self.words)
        masks = list(enumerate(MASKS + SHORT_MASKS if near else MASKS))
        short = sorted({len(w) for w in self.words if LEAST_WORDS <= len(w) < SPAN})
        self.masks = masks + [(len(masks) + n, tuple(range(n))) for n in short]
        keys, item, start = [], [], []
        for i, words in enumerate(self.words):
            for number, mask in self.masks:
                whole = number >= len(masks)
                if whole != (len(words) < SPAN) or whole and len(mask) != len(words) or mask in SHORT_MASKS and len(words) >= SPAN + 2:
                    continue
                own = seed_keys(words, mask, number)
                keys.append(own)
                item.append(np.full(len(own), i))
                start.append(np.arange(len(own)))
        join = lambda x, kind: np.concatenate(x).astype(kind) if x else np.zeros(0, kind)
        order = np.argsort(join(keys, np.uint64), kind="stable")
        self.keys, self.item, self.start = join(keys, np.uint64)[order], join(item, np.int64)[order], join(start, np.int64)[order]
        self.present = np.zeros(1 << _FILTER_BITS, bool)
        self.present[self.keys >> np.uint64(64 - _FILTER_BITS)] = True

    def overlap(self, item: int, text: np.ndarray, shift: int) -> tuple[int, int, int] | None:
        """Of all overlaps of an item laid on a text with `SHARE` of equal words the one with most of them, word 0 at `shift`: (first text word, end, equal words)."""
        own = self.words[item]
        low, high = max(shift, 0), min(shift + len(own), len(text))
        equal = text[low:high] == own[low - shift:high - shift]
        hits = np.concatenate([[0], np.cumsum(equal)])
        sums = np.concatenate([[0], np.cumsum(np.where(equal, 1, -SUBSTITUTION))])
        # the first start from which the sum up to each end is not negative: the most equal words for that end
        starts = np.searchsorted(-np.minimum.accumulate(sums), -sums)
        end = int(np.argmax(hits - hits[starts]))
        begin = int(starts[end])
        begin += int(np.argmax(equal[begin:end])) if end > begin else 0
        same = int(hits[end] - hits[begin])
        need = ENOUGH if len(own) >= ENOUGH / SHARE else math.ceil(SHARE * len(own)) if len(own) >= SPAN else len(own)
        return (low + begin, low + end, same) if same >= need and same >= SHARE * (end - begin) else None

    def find(self, texts: pa.Array) -> list[tuple[int, int, int, int, int]]:
        """(row, item, first word, end, equal words): of each item in each text the overlap with most equal words."""
        _, _, hashes, first = tokens(*buffers(texts), PLAIN)
        met = []
        for number, mask in self.masks:
            keys = seed_keys(hashes, mask, number)
            at = np.flatnonzero(self.present[keys >> np.uint64(64 - _FILTER_BITS)])
            low, high = np.searchsorted(self.keys, keys[at], "left"), np.searchsorted(self.keys, keys[at], "right")
            n = high - low
            at, low = at[n > 0], low[n > 0]
            n = n[n > 0]
            seed = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
            at = np.repeat(at, n)
            row = np.searchsorted(first, at, side="right") - 1
            inside = at + mask[-1] < first[row + 1]
            met.append(np.stack([row, self.item[seed], at - first[row] - self.start[seed]], 1)[inside])
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for row, item, shift in np.unique(np.concatenate(met), axis=0).tolist() if met else ():
            found = self.overlap(item, hashes[first[row]:first[row + 1]], shift)
            if found and (known := best.get((row, item))) is None or found and (-found[2], found[0]) < (-known[2], known[0]):
                best[row, item] = found
        return [(row, item, *found) for (row, item), found in sorted(best.items())]


def blocks(benchmark: DataFrame, name: str = "item_id") -> list[list[tuple[object, str | None]]]:
    """The items in blocks of about `BLOCK_WORDS` words; a block at a time reaches the driver and the tasks."""
    rows = benchmark.select(F.col(f"`{name}`").alias("name"), F.lower(F.col("text").cast("string")).alias("text")).filter("text is not null")
    rows = cut_lineage(rows)
    words = rows.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    n = math.ceil(words / BLOCK_WORDS)
    block = F.pmod(F.xxhash64("name", "text"), F.lit(max(n, 1)))
    for i in range(n):
        yield [(r["name"], r["text"]) for r in rows.filter(block == i).orderBy("name", "text").collect()]


def _run(docs: DataFrame, items: list, schema: StructType, emit: Callable) -> DataFrame:
    """Maps every batch of (lower-case text, other columns ...) with the items' hits."""
    shared = docs.sparkSession.sparkContext.broadcast(items)  # BLOCK_WORDS words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Items(shared.value)
        for batch in batches:
            for piece in pieces(batch, 0):
                yield emit(index, piece, index.find(piece.column(0)))

    return docs.mapInArrow(run, schema)


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Contaminated documents: doc_id, item_id, first_word, end_word, equal_words, item_words; a row per document and item.

    Words are letters and digits in lower case, numbered from 0 in the whole text. Null, empty and clean texts give no
    rows; a repeated document gives its rows again; equal items are both named. Items of fewer than
    `LEAST_WORDS` words are not sought. Documents are never shuffled; each block of items is one pass over them.
    """
    rows = docs.select(F.lower(F.col("text").cast("string")).alias("text"), "doc_id")
    kind = benchmark.schema["item_id"].dataType.simpleString()
    schema = StructType.fromDDL(f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, item_id {kind}, first_word long, end_word long, equal_words long, item_words long")

    def emit(index: Items, piece: pa.RecordBatch, hits: list) -> pa.RecordBatch:
        row, item, low, high, same = ([h[k] for h in hits] for k in range(5))
        names = pa.array([index.names[i] for i in item])
        sizes = pa.array([len(index.words[i]) for i in item], pa.int64())
        ids = piece.column(1).take(pa.array(row, pa.int64()))
        return pa.RecordBatch.from_arrays([ids, names.cast(out[1].type), *(pa.array(x, pa.int64()) for x in (low, high, same)), sizes], schema.names)

    from pyspark.sql.pandas.types import to_arrow_schema

    out = to_arrow_schema(schema)
    found = [_run(rows, block, schema, emit) for block in blocks(benchmark)]
    if not found:
        return docs.sparkSession.createDataFrame([], schema)
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole


def remove(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows and columns of `docs` that overlap no item."""
    lower = fresh(docs, "lower_text")
    schema = docs.schema

    def emit(index: Items, piece: pa.RecordBatch, hits: list) -> pa.RecordBatch:
        keep = np.ones(piece.num_rows, bool)
        keep[[h[0] for h in hits]] = False
        return pa.RecordBatch.from_arrays(piece.columns[1:], schema.names).filter(pa.array(keep))

    for block in blocks(benchmark):
        docs = _run(docs.select(F.lower(F.col("text").cast("string")).alias(lower), *[F.col(f"`{c}`") for c in docs.columns]), block, schema, emit)
    return docs
