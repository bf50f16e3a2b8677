"""Vector codes: parts of a vector are replaced by the number of their codebook's nearest entry.

Vectors are held in blocks. A block has a dictionary for each dimension, its distinct integers in order, and for every
vector the place of its component in it. Distances to a codebook are never computed vector by vector: the squared
differences of each distinct integer to all entries are tabulated once per block and round, and the distance of a part is the
sum of the rows that its codes point to.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.lineage import cut_lineage

#: Parts of a vector, entries of a part's codebook, rounds of assignment and replacement, integer steps of one.
PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Vectors of a block, and those whose distances are added up at a time.
BLOCK, STRIP = 4096, 512
#: Greatest integer a component becomes (|x| of 131 072): distances of 64 dimensions then fit 64 bits.
LIMIT = 1 << 27


def integers(values: np.ndarray) -> np.ndarray:
    """floor(1024 * x), held within `LIMIT` on either side."""
    return np.clip(np.floor(values.astype(np.float64) * SCALE), -LIMIT, LIMIT).astype(np.int64)


def is_whole(vector: Column) -> Column:
    """Neither null nor with a null, infinite or undefined component."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & F.coalesce(F.forall(vector, fine), F.lit(False))


class Block:
    """Dictionary codes of some vectors: `values[j]` the distinct integers of dimension j, `codes[j]` each vector's place in them."""

    def __init__(self, row: dict):
        ends = np.cumsum(row["counts"])
        self.ids, self.labels, self.n = row["ids"], row["labels"], row["n"]
        flat = np.frombuffer(row["dictionary"], np.int64)
        self.values = [flat[end - n:end] for end, n in zip(ends, row["counts"])]
        self.codes = np.frombuffer(row["codes"], np.uint16).reshape(len(self.values), self.n)

    def nearest(self, book: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry of each vector's part that starts at dimension `first`, the lowest of equals, and its squared distance."""
        width = book.shape[1]
        gaps = [v[:, None] - book[None, :, j] for j, v in enumerate(self.values[first:first + width])]
        far = sum(int(np.abs(g).max(initial=0)) ** 2 for g in gaps)
        kind = np.int32 if far < 2**31 else np.int64
        tables = [np.square(g).astype(kind) for g in gaps]
        best, least = np.zeros(self.n, np.int64), np.zeros(self.n, np.int64)
        for low in range(0, self.n, STRIP):
            own = self.codes[first:first + width, low:low + STRIP]
            total = np.zeros((own.shape[1], len(book)), kind)
            rows = np.empty_like(total)
            for table, code in zip(tables, own):
                total += np.take(table, code, axis=0, out=rows, mode="clip")
            at = total.argmin(1)
            best[low:low + STRIP], least[low:low + STRIP] = at, total[np.arange(len(at)), at]
        return best, least

    def sums(self, best: np.ndarray, first: int, width: int, entries: int) -> np.ndarray:
        """Sum of the parts assigned to each entry, dimension by dimension; a block's sums are exact in doubles."""
        own = [np.bincount(best, self.values[j][self.codes[j]], entries) for j in range(first, first + width)]
        return np.stack(own, 1).astype(np.int64) if own else np.zeros((entries, 0), np.int64)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = {c: batch.column(c)[k].as_py() for c in ("n", "counts", "dictionary", "codes")}
            yield Block(row | {c: batch.column(c)[k].values for c in ("ids", "labels")})


def blocks(kept: DataFrame, size: int) -> DataFrame:
    """Dictionary-coded blocks of (id, label, vector) rows whose vectors have `size` components; written once, read in every round."""
    ids, labels = (kept.schema[c].dataType.simpleString() for c in ("id", "label"))
    padded = -(-size // PARTS) * PARTS

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, BLOCK):
                own = batch.slice(low, BLOCK)
                n = own.num_rows
                whole = np.zeros((n, padded), np.int64)
                whole[:, :size] = integers(own.column(2).flatten().to_numpy(zero_copy_only=False)).reshape(n, size)
                found = [np.unique(whole[:, j], return_inverse=True) for j in range(padded)]
                values = [v for v, _ in found] or [np.zeros(0, np.int64)]
                codes = [c.astype(np.uint16) for _, c in found] or [np.zeros(0, np.uint16)]
                one = lambda column: pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), column)  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([
                    one(own.column(0)), one(own.column(1)), pa.array([n]), pa.array([[len(v) for v, _ in found]], pa.list_(pa.int32())),
                    pa.array([np.concatenate(values).tobytes()]), pa.array([np.concatenate(codes).tobytes()]),
                ], ["ids", "labels", "n", "counts", "dictionary", "codes"])

    made = f"ids array<{ids}>, labels array<{labels}>, n long, counts array<int>, dictionary binary, codes binary"
    return cut_lineage(kept.select("id", "label", "vector").mapInArrow(code, made))


def improve(coded: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks after one round: each entry the floor of the mean of its parts, unused entries as they were.

    A task adds up its own blocks; what reaches the driver is one row for each entry.
    """
    parts, entries, width = books.shape

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64)
        for block in _read(batches):
            for p in range(parts):
                best, _ = block.nearest(books[p], p * width)
                sums[p] += block.sums(best, p * width, width, entries)
                counts[p] += np.bincount(best, minlength=entries)
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([
            pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(counts[part, entry]), pa.array(list(sums[part, entry]), pa.list_(pa.int64())),
        ], ["part", "entry", "n", "sums"])

    found = coded.mapInArrow(assign, "part int, entry int, n long, sums array<long>").groupBy("part", "entry")
    rows = found.agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[j]) for j in range(width)]).cast("array<long>").alias("sums")).collect()
    out = books.copy()
    for r in rows:
        out[r["part"], r["entry"]] = [s // r["n"] for s in r["sums"]]
    return out


def encode(coded: DataFrame, books: np.ndarray) -> DataFrame:
    """(id, label, code, error) of every vector: code holds a byte for each part, error the squared distances to the coded vector."""
    parts, _, width = books.shape
    kinds = [coded.schema[c].dataType.elementType.simpleString() for c in ("ids", "labels")]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _read(batches):
            found = [block.nearest(books[p], p * width) for p in range(parts)]
            code = np.stack([best for best, _ in found], 1).astype(np.uint8)
            error = sum(least for _, least in found)
            yield pa.RecordBatch.from_arrays([block.ids, block.labels, pa.array([c.tobytes() for c in code], pa.binary()), pa.array(error)], ["id", "label", "code", "error"])

    return coded.mapInArrow(assign, f"id {kinds[0]}, label {kinds[1]}, code binary, error long")


def decode(books: np.ndarray, code: bytes) -> np.ndarray:
    """The integers that a code stands for."""
    return np.concatenate([books[p][c] for p, c in enumerate(code)])


def digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' integers by part, entry and place, in decimal, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(rows, codebooks): rows has id, label, code and error of each vector, codebooks is parts x entries x width.

    Rows go whose vector is null or has a null or non-finite component, also those of another length than most vectors
    (of equally frequent lengths the greatest). A length that four does not divide is filled with zeros. Codebooks start as the parts of the
    256 vectors of least id (all, if fewer), null ids last, equal ids by vector; equal rows count each by itself. An empty table
    gives no rows and codebooks without entries. Other columns of the table, whatever their names, are not read.
    """
    rows = vectors.select(F.col(f"`{vec_id}`").alias("id"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    kept = rows.filter(is_whole(F.col("vector")))
    common = kept.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    size = common["size"] if common else 0
    kept = kept.filter(F.size("vector") == size)
    first = [r["vector"] for r in kept.orderBy(F.col("id").asc_nulls_last(), "vector").select("vector", "id").limit(ENTRIES).collect()]
    width = -(-size // PARTS)
    start = np.zeros((len(first), PARTS * width), np.int64)
    start[:, :size] = integers(np.array(first, np.float64).reshape(len(first), size))
    books = np.ascontiguousarray(start.reshape(len(first), PARTS, width).transpose(1, 0, 2))
    coded = blocks(kept, size)
    if len(first) and width:
        for _ in range(rounds):
            books = improve(coded, books)
    return encode(coded, books), books


def with_label_error(rows: DataFrame) -> DataFrame:
    """With `label_error`, the errors summed over the rows of equal label, nulls together.

    The sums are written before they meet the rows, so that Spark can split a label that holds much of the table.
    """
    rows = cut_lineage(rows)
    totals = cut_lineage(rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")))
    return rows.join(totals, F.col("label").eqNullSafe(F.col("of"))).drop("of")
