"""Substring deduplication by sliding sentence spans: every run of consecutive sentences is hashed and joined globally;
sentences that a repeated, non-first run covers are removed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.lineage import cut_lineage
from faultline.llm.common import WORDS, buffers, fresh, mix, pieces, prefix_hashes, tokens

#: A run is the fewest consecutive sentences, two at least, with this many words;
RUN_WORDS = 12
#: a sentence this long is a run by itself.
LONG_SENTENCE = 24

FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
ENDS = np.isin(np.arange(256), np.frombuffer(b".!?", np.uint8))


def sentences(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """Word starts, ends and hashes, each sentence's first word (one more at the end) and each row's first sentence.

    A sentence ends with a word whose last character is `.`, `!` or `?`, at a line feed, or with its text.
    """
    starts, ends, hashes, first = tokens(FOLD[data], at, WORDS)
    if not len(starts):
        return starts, ends, hashes, np.zeros(1, np.int64), np.zeros(len(at), np.int64)
    feeds = np.concatenate([[0], np.cumsum(data == 10)])
    final = ENDS[data[ends - 1]]
    final[:-1] |= feeds[starts[1:]] > feeds[ends[:-1]]
    opens = np.concatenate([[True], final[:-1]])
    opens[first[:-1][first[:-1] < len(starts)]] = True
    begin = np.flatnonzero(opens)
    return starts, ends, hashes, np.append(begin, len(starts)), np.searchsorted(begin, first)


def runs(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, start, end) of every run; code points, from the run's first word to its last.

    From each sentence the run goes on until it has enough; where a text ends before that, its last run is the fewest last
    sentences that have enough. Letter case of ASCII and the kind of white space do not matter.
    """
    data, at = buffers(texts)
    starts, ends, hashes, begin, own = sentences(data, at)
    many = len(begin) - 1
    row = np.repeat(np.arange(len(texts)), np.diff(own))
    low, high = begin[:-1], begin[1:]
    first = np.arange(many)
    # the sentence that holds the last word needed, at least the next one unless the first is long
    last = np.searchsorted(high, low + RUN_WORDS)
    last = np.where(high - low >= LONG_SENTENCE, first, np.maximum(last, first + 1))
    inside = last < own[row + 1]
    tail = own[1:][np.diff(own) > 0] - 1  # last sentences
    head = np.minimum(np.searchsorted(low, high[tail] - RUN_WORDS, side="right") - 1, np.where(high[tail] - low[tail] >= LONG_SENTENCE, tail, tail - 1))
    good = (head >= own[row[tail]]) & (high[tail] - low[np.maximum(head, 0)] >= RUN_WORDS)
    first, last = np.concatenate([first[inside], head[good]]), np.concatenate([last[inside], tail[good]])
    distinct = np.unique(first * np.int64(many + 1) + last)
    first, last = distinct // (many + 1), distinct % (many + 1)
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    row = row[first]
    keys = mix(prefix_hashes(hashes, begin[first], begin[last + 1]) + (begin[last + 1] - begin[first]).astype(np.uint64))
    return row, keys, points[starts[begin[first]]] - points[at[row]], points[ends[begin[last + 1] - 1]] - points[at[row]]


def _runs(docs: DataFrame) -> DataFrame:
    """(hash, doc_id, twin, start, end) of the runs of all texts; `twin` tells apart texts of equal doc_id."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, 0):
                row, keys, start, end = runs(piece.column(0))
                row = pa.array(row)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), piece.column(1).take(row), piece.column(2).take(row), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32))], ["hash", "doc_id", "twin", "start", "end"])

    return docs.select(F.col("text").cast("string").alias("text"), "doc_id", _twin().alias("twin")).mapInArrow(cut, f"hash long, doc_id {kind}, twin long, start int, end int")


def _twin() -> Column:
    return F.xxhash64(F.col("text").cast("string"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, twin, spans): for each document with removable text its spans (start, end), merged and in order.

    A run is first where its document's id is least (nulls last; then `twin`, then the place in the text); all other occurrences, in
    other documents or the same, are to be removed. Rows equal in doc_id and text are one document. Null, empty and
    short texts have no runs. Runs are equal if their 64-bit hashes are.
    """
    every = _runs(docs)
    place = F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "twin", "start")
    many = every.groupBy("hash").agg(F.count("*").alias("n"), F.min(place).alias("first")).filter("n > 1")
    # written once: a join of two plain shuffles is one that Spark can split where a run is very common
    later = every.join(cut_lineage(many.select("hash", "first")), "hash").filter(place != F.col("first"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for spans in batch.column(2):
                own = sorted((s["start"], s["end"]) for s in spans.as_py())
                joined = [list(own[0])]
                for start, end in own[1:]:
                    if start <= joined[-1][1] + 1:
                        joined[-1][1] = max(joined[-1][1], end)
                    else:
                        joined.append([start, end])
                out.append([{"start": a, "end": b} for a, b in joined])
            kinds = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, kinds)], ["doc_id", "twin", "spans"])

    gathered = later.groupBy("doc_id", "twin").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    return gathered.mapInArrow(merge, f"doc_id {kind}, twin long, spans array<struct<start:int,end:int>>")


def without(text: Column, spans: Column) -> Column:
    """The text without the spans and the white space behind each."""
    piece = lambda a, size: F.regexp_replace(F.substring(text, a["at"] + 1, size), F.when(a["at"] > 0, r"\A\s+").otherwise(r"\A(?!)"), F.lit(""))
    step = lambda a, s: F.struct(s["end"].alias("at"), F.concat(a["out"], piece(a, s["start"] - a["at"])).alias("out"))
    return F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda a: F.concat(a["out"], piece(a, F.length(text))))


def remove(docs: DataFrame) -> DataFrame:
    """The rows and columns of `docs`, their texts without repeated, non-first runs."""
    twin, spans, own_id, own_twin = (fresh(docs, name) for name in ("twin", "spans", "own_id", "own_twin"))
    found = cut_lineage(repeated_spans(docs)).select(F.col("doc_id").alias(own_id), F.col("twin").alias(own_twin), F.col("spans").alias(spans))
    joined = docs.withColumn(twin, _twin()).join(found, F.col("doc_id").eqNullSafe(F.col(own_id)) & F.col(twin).eqNullSafe(F.col(own_twin)), "left")
    text = F.when(F.col(spans).isNotNull(), without(F.col("text"), F.col(spans))).otherwise(F.col("text"))
    return joined.select(*[text.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns])
