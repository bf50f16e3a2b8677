"""Ranked lexical search of many items over all documents, by the mask of an item's terms that a document holds.

Documents lie in blocks with the postings of the items' terms. For an item, the presence bits of its terms make a mask for
each document of a block; documents of equal mask share one greatest score. Masks are worked off from the greatest on, until none
that is left can reach the item's last place.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType
from pyspark.sql.window import Window

from faultline.lineage import cut_lineage
from faultline.llm.common import PLAIN, buffers, pieces, tokens

#: Documents an item gets.
TOP = 10
#: Documents of a block, and term occurrences after which a block is closed early.
BLOCK_DOCS, BLOCK_TERMS = 4096, 2_000_000
#: Terms of the items that are searched in one pass over the documents; an item of more is a pass of its own.
PASS_TERMS = 200_000
#: Bits of a mask times documents that are laid out at once.
CELLS = 1 << 23
_UNIT, _TF, _LENGTH, _BASE_LENGTH, _LENGTH_SHARE = 1_000_000_000, 1000, 8, 10, 90

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all terms of the texts, in order, and each text's first; only A to Z are taken in lower case."""
    data, at = buffers(texts)
    _, _, hashes, first = tokens(_LOWER[data], at, PLAIN)
    return hashes, first


def item_terms(items: DataFrame, item_id: str = "item_id") -> DataFrame:
    """(item, term) of the distinct terms of each item; rows of one id (null is one as well) are one item."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, 1):
                hashes, first = terms(piece.column(1))
                rows = np.repeat(np.arange(piece.num_rows), np.diff(first))
                yield pa.RecordBatch.from_arrays([piece.column(0).take(pa.array(rows)), pa.array(hashes.view(np.int64))], ["item", "term"])

    rows = items.select(F.col(f"`{item_id}`").alias("item"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(split, f"item {rows.schema['item'].dataType.simpleString()}, term long").distinct()


class Items:
    """Items of one pass: `vocabulary` their distinct terms, ascending, and the places of each item's terms in it."""

    def __init__(self, rows: list):
        own: dict = {}
        for r in rows:
            own.setdefault(r["item"], []).append(r["term"])
        self.names = list(own)
        found = [np.unique(np.array(t, np.int64).view(np.uint64)) for t in own.values()]
        self.vocabulary = np.unique(np.concatenate(found))
        self.places = [np.searchsorted(self.vocabulary, t) for t in found]


def postings(docs: DataFrame, items: Items) -> DataFrame:
    """Blocks of documents: ids, numbers of terms, and the items' terms in them as (term, document, occurrences), by term.

    Documents without a term are left out; `held` counts the documents of a block that hold each term met.
    """
    kind, vocabulary = docs.schema["doc_id"].dataType.simpleString(), items.vocabulary

    def pack(ids: list, parts: list) -> pa.RecordBatch:
        lengths, counts = np.concatenate([p[0] for p in parts]), np.cumsum([0] + [len(p[0]) for p in parts])
        term, doc, tf = (np.concatenate([p[k] + (counts[n] if k == 2 else 0) for n, p in enumerate(parts)]) for k in (1, 2, 3))
        order = np.argsort(term, kind="stable")
        met, held = np.unique(term, return_counts=True)
        column = pa.concat_arrays(ids)
        return pa.RecordBatch.from_arrays([
            pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column), pa.array([len(column)]), pa.array([int(lengths.sum())]),
            *[pa.array([x.tobytes()]) for x in (lengths, met.astype(np.int32), held.astype(np.int32), doc[order].astype(np.int32), tf[order])],
        ], ["ids", "n_docs", "n_terms", "lengths", "met", "held", "doc", "tf"])

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts, n_docs, n_terms = [], [], 0, 0
        for batch in batches:
            for piece in pieces(batch, 1):
                hashes, first = terms(piece.column(1))
                lengths = np.diff(first)
                some = np.flatnonzero(lengths)
                if not len(some):
                    continue
                rows = np.repeat(np.arange(len(some)), lengths[some])
                at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
                own = vocabulary[at] == hashes
                pair, tf = np.unique(at[own] * len(some) + rows[own], return_counts=True)
                ids.append(piece.column(0).take(pa.array(some)))
                parts.append((lengths[some], pair // len(some), pair % len(some), tf.astype(np.int64)))
                n_docs, n_terms = n_docs + len(some), n_terms + len(pair)
                if n_docs >= BLOCK_DOCS or n_terms >= BLOCK_TERMS:
                    yield pack(ids, parts)
                    ids, parts, n_docs, n_terms = [], [], 0, 0
        if ids:
            yield pack(ids, parts)

    made = f"ids array<{kind}>, n_docs long, n_terms long, lengths binary, met binary, held binary, doc binary, tf binary"
    return cut_lineage(docs.select("doc_id", "text").mapInArrow(block, made))


def document_frequencies(blocks: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """(documents with a term, all their terms, documents that hold each of the pass's terms)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for met, held in zip(batch.column(0), batch.column(1)):
                total[np.frombuffer(met.as_buffer(), np.int32)] += np.frombuffer(held.as_buffer(), np.int32)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["term", "df"])

    sums = blocks.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n"), F.coalesce(F.sum("n_terms"), F.lit(0)).alias("l")).first()
    out = np.zeros(size, np.int64)
    for r in blocks.select("met", "held").mapInArrow(count, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r["term"]] = r["df"]
    return sums["n"], sums["l"], out


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def length_measure(lengths: np.ndarray, n: int, total: int) -> np.ndarray:
    """The m of each document; numbers beyond 64 bits are worked out one by one."""
    if int(lengths.max(initial=0)) * n * _LENGTH_SHARE < 2**63:
        return _BASE_LENGTH + (_LENGTH_SHARE * lengths * n) // total
    return np.array([_BASE_LENGTH + _LENGTH_SHARE * x * n // total for x in lengths.tolist()], np.int64)


class Leaders:
    """The best documents of one item so far: scores and ids, the last place's score once all places are taken."""

    def __init__(self, top: int):
        self.top, self.rows = top, []

    def floor(self) -> int:
        return self.rows[-1][0] if len(self.rows) == self.top else 1

    def add(self, scores: np.ndarray, ids: list) -> None:
        new = [(s, i) for s, i in zip(scores.tolist(), ids) if s >= self.floor() and s > 0]
        self.rows = sorted(self.rows + new, key=lambda r: (-r[0], r[1] is None, r[1] if r[1] is not None else 0))[:self.top]


class Block:
    """Postings of a block of documents, with the weightless share of each in a score and a presence bit for each document."""

    def __init__(self, batch: pa.RecordBatch, k: int, n: int, total: int):
        read = lambda c, kind: np.frombuffer(batch.column(c)[k].as_buffer(), kind)
        self.ids = batch.column("ids")[k].values
        self.size = len(self.ids)
        self.met, held = read("met", np.int32), read("held", np.int32)
        self.doc, tf = read("doc", np.int32), read("tf", np.int64)
        self.at = np.concatenate([[0], np.cumsum(held)])
        m = length_measure(read("lengths", np.int64), n, total)
        self.share = (_UNIT * tf) // (_TF * tf + _LENGTH * m[self.doc])
        self.most = np.maximum.reduceat(self.share, self.at[:-1]) if len(held) else self.share

    def search(self, places: np.ndarray, weights: np.ndarray, leaders: Leaders) -> None:
        """Bring the item's leaders up to date with this block's documents."""
        at = np.searchsorted(self.met, places)
        known = at < len(self.met)
        known[known] = self.met[at[known]] == places[known]
        at = at[known]
        if not len(at):
            return
        strip = max(1, CELLS // (64 * -(-len(at) // 64)))
        for low in range(0, self.size, strip):
            self._search(at, weights[self.met[at]], leaders, low, min(self.size, low + strip))

    def _search(self, at: np.ndarray, w: np.ndarray, leaders: Leaders, low: int, high: int) -> None:
        masks = np.zeros((high - low, -(-len(at) // 64)), np.uint64)
        spans = []
        for bit, t in enumerate(at.tolist()):
            first, last = self.at[t], self.at[t + 1]
            if high - low < self.size:
                first, last = first + np.searchsorted(self.doc[first:last], [low, high])
            masks[self.doc[first:last] - low, bit // 64] |= np.uint64(1 << bit % 64)
            spans.append((first, last))
        distinct, group = _distinct(masks)
        bits = np.unpackbits(distinct.view(np.uint8), axis=1, bitorder="little")[:, :len(at)]
        bound = bits @ (w * self.most[at])
        order = np.argsort(-bound, kind="stable")
        bound = bound[order]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        place = place[group]  # of each document's mask
        counts = np.cumsum(np.bincount(place, minlength=len(order)))
        done, step = 0, leaders.top
        while done < len(order):
            left = int(np.searchsorted(-bound, -leaders.floor(), side="right"))  # masks that can still reach the last place
            if left <= done:
                break
            upto = min(left, max(done + 1, int(np.searchsorted(counts, (counts[done - 1] if done else 0) + step))))
            chosen = (place >= done) & (place < upto)
            scores = np.zeros(high - low, np.int64)
            for (first, last), one in zip(spans, w.tolist()):
                doc = self.doc[first:last] - low
                mine = chosen[doc]
                scores[doc[mine]] += one * self.share[first:last][mine]
            best = np.flatnonzero(chosen & (scores >= leaders.floor()))
            leaders.add(scores[best], self.ids.take(pa.array(best + low)).to_pylist())
            done, step = upto, step * 16


def _distinct(masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows and the number of each row's."""
    if masks.shape[1] == 1:
        found, group = np.unique(masks[:, 0], return_inverse=True)
        return np.ascontiguousarray(found[:, None]), group
    names = np.ascontiguousarray(masks).view(np.dtype((np.void, 8 * masks.shape[1])))[:, 0]
    _, first, group = np.unique(names, return_index=True, return_inverse=True)
    return np.ascontiguousarray(masks[first]), group


def search(docs: DataFrame, items: DataFrame, item_id: str = "item_id", top: int = TOP) -> DataFrame:
    """(item, rank, doc_id, score): the `top` documents of greatest score above 0 of every item, equal scores by doc_id, nulls last.

    Every row of `docs` is a document of its own, also where rows repeat; null and empty texts, and items without terms, are found by
    nothing. Terms are told apart by 64-bit hashes. Items are searched in passes of about `PASS_TERMS` terms, of which the driver and a task hold one
    at a time. Each task keeps `top` documents an item; these are ranked by Spark. An empty table gives no rows; columns other than
    the ids and texts are not read.
    """
    spark, of_item, of_doc = docs.sparkSession, items.schema[item_id].dataType, docs.schema["doc_id"].dataType
    wanted = cut_lineage(item_terms(items, item_id))
    whole = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    out = None
    for part in passes(wanted):
        held = part.collect()
        if not held:
            continue
        found = _one_pass(whole, Items(held), top, of_item, of_doc)
        out = found if out is None else cut_lineage(out.unionByName(found))
    if out is None:
        out = spark.createDataFrame([], f"item {of_item.simpleString()}, rank int, doc_id {of_doc.simpleString()}, score long")
    return out.select("item", "rank", "doc_id", "score")


def passes(wanted: DataFrame) -> Iterator[DataFrame]:
    """The item terms of one pass after the other, whole items together."""
    n = -(-2 * wanted.count() // PASS_TERMS)
    for k in range(n):
        yield wanted.filter(F.pmod(F.xxhash64("item"), F.lit(n)) == k)


def _one_pass(docs: DataFrame, items: Items, top: int, of_item: DataType, of_doc: DataType) -> DataFrame:
    blocks = postings(docs, items)
    n, total, df = document_frequencies(blocks, len(items.vocabulary))
    weights = np.array([weight(n, x) for x in df.tolist()], np.int64)
    item_type, doc_type = to_arrow_type(of_item), to_arrow_type(of_doc)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaders = [Leaders(top) for _ in items.names]
        for batch in batches:
            for k in range(batch.num_rows):
                block = Block(batch, k, n, total)
                for places, own in zip(items.places, leaders):
                    block.search(places, weights, own)
        rows = [(name, i, s) for name, own in zip(items.names, leaders) for s, i in own.rows]
        columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((item_type, doc_type, pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "score"])

    scores = blocks.mapInArrow(best, f"item {of_item.simpleString()}, doc_id {of_doc.simpleString()}, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return scores.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
