"""Helpers the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.operators.graph import contract as components  # noqa: F401

#: Bytes of text that are hashed at once.
CHUNK = 2 << 20


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def odd_multipliers(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that their high bits depend on all bits."""
    out = values ^ (values >> np.uint64(31))
    out *= np.uint64(0x9E3779B97F4A7C15)
    out ^= out >> np.uint64(29)
    return out


def table(spans: dict[int, list[tuple[int, int]]]) -> np.ndarray:
    """Class of each byte, from inclusive ranges; 0 elsewhere."""
    out = np.zeros(256, np.uint8)
    for kind, ranges in spans.items():
        for low, high in ranges:
            out[low:high + 1] = kind
    return out


#: Words: everything but the six ASCII white-space characters.
WORDS = table({1: [(0, 8), (14, 31), (33, 255)]})
#: Letters (and all bytes beyond ASCII), digits, and other visible marks.
TOKENS = table({3: [(0, 8), (14, 31), (33, 127)], 1: [(65, 90), (97, 122), (128, 255)], 2: [(48, 57)]})
#: Letters and digits only; marks separate as white space does.
PLAIN = table({1: [(48, 57), (65, 90), (97, 122), (128, 255)]})

_BASE = 0x9FB21C651E98DF25
_BYTES = np.random.default_rng(7).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS = {1: np.ones(1, np.uint64), -1: np.ones(1, np.uint64)}


def _powers(n: int, sign: int) -> np.ndarray:
    if len(_POWERS[sign]) < n:
        steps = np.full(n, pow(_BASE, sign, 2**64), np.uint64)
        steps[0] = 1
        _POWERS[sign] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS[sign][:n]


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (from 0) of a string array; nulls are empty."""
    if pa.types.is_large_string(texts.type) or texts.type != pa.string():
        texts = texts.cast(pa.string())
    if texts.null_count:
        texts = texts.fill_null("")
    at = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    raw = texts.buffers()[2] if len(texts) else None
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[at[0]:at[-1]], at - at[0]


def prefix_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A polynomial over the 64-bit values of each span, wherever the span lies."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(len(values), 1), out=sums[1:])
    return (sums[ends] - sums[starts]) * _powers(len(values) + 1, -1)[starts]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span, made of a random number per byte value."""
    return mix(prefix_hashes(_BYTES[data], starts, ends) + (ends - starts).astype(np.uint64))


def tokens(data: np.ndarray, at: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of all tokens, and each row's first token (one more at the end).

    A token is a run of bytes of one non-zero class within one row. Works through `CHUNK` bytes at a time,
    cut where a row ends or at a byte of class 0.
    """
    parts, low, n = [], 0, len(data)
    while low < n:
        high = min(n, low + CHUNK)
        while high < n:
            row = int(at[np.searchsorted(at, high, side="right") - 1])
            gap = np.flatnonzero(classes[data[low:high]] == 0)
            high = row if row > low else low + int(gap[-1]) + 1 if len(gap) else min(n, high + CHUNK)
            if row > low or len(gap):
                break
        own = data[low:high]
        kind = classes[own]
        change = np.ones(len(own) + 1, bool)
        np.not_equal(kind[1:], kind[:-1], out=change[1:-1])
        inner = at[np.searchsorted(at, low):np.searchsorted(at, high, side="right")]
        change[inner - low] = True
        edges = np.flatnonzero(change)
        starts, ends = edges[:-1], edges[1:]
        keep = kind[starts] != 0
        starts, ends = starts[keep], ends[keep]
        parts.append((starts + low, ends + low, span_hashes(own, starts, ends)))
        low = high
    if not parts:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(0, np.uint64), np.zeros(len(at), np.int64)
    starts, ends, hashes = (np.concatenate(x) for x in zip(*parts))
    return starts, ends, hashes, np.searchsorted(starts, at)


#: Odd factors of the words of a window.
WINDOW_FACTORS = odd_multipliers(64, 11)


def windows(hashes: np.ndarray, first: np.ndarray, size: int, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each window of `size` tokens of the rows, and each row's first window (one more at the end).

    A row of fewer tokens is one window if `short`, else none; a row without tokens has none.
    """
    count = np.diff(first)
    n = np.where(count >= size, count - size + 1, np.minimum(count, 1) if short else 0)
    begin = np.concatenate([[0], np.cumsum(n)])
    rows = np.repeat(np.arange(len(count)), n)
    place = np.arange(begin[-1]) - begin[rows] + first[rows]
    width = np.minimum(count, size)[rows]
    out = width.astype(np.uint64)
    for j in range(size):
        far = place + j
        if width.min(initial=size) >= size:
            out += hashes[far] * WINDOW_FACTORS[j]
        else:
            out += np.where(j < width, hashes[np.minimum(far, max(len(hashes) - 1, 0))] * WINDOW_FACTORS[j], np.uint64(0))
    return mix(out), begin


def in_row(keys: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Keys made to differ between rows."""
    return mix(keys + rows.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def row_sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sum of the values of each row, `at` its bounds."""
    sums = np.zeros(len(values) + 1, np.int64 if values.dtype.kind in "biu" else np.float64)
    np.cumsum(values, out=sums[1:])
    return sums[at[1:]] - sums[at[:-1]]


def text_key(c: Column | str) -> Column:
    """128-bit name of a text; null and empty texts share one."""
    c = F.col(c) if isinstance(c, str) else c
    return F.unhex(F.md5(F.coalesce(c, F.lit(""))))


def fresh(df: DataFrame, name: str) -> str:
    """A column name `df` does not have yet, whatever the letter case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def need(df: DataFrame, **kinds: str) -> DataFrame:
    """Only the named columns, as the named types."""
    return df.select(*[F.col(f"`{c}`").cast(kind).alias(c) for c, kind in kinds.items()])


def pieces(batch: pa.RecordBatch, column: int, limit: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Slices of a batch holding about `limit` bytes of the column each, one row at least."""
    ends = buffers(batch.column(column))[1][1:]
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def small_batches(spark: SparkSession, most: int = 4 << 20) -> None:
    """Let Spark hand tasks Arrow batches of at most `most` bytes, unless the session names a limit other than the usual one.

    The usual limit, 64 MB, is held several times over by each task, in the executor and in its Python process.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) in ("67108864", "67108864b", "64m", "64MB"):
        spark.conf.set(name, str(most))
