"""Quality rules: base counts of a text, and a hashed n-gram log-likelihood ratio of trusted target against raw corpus."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.lineage import cut_lineage
from faultline.llm.common import TOKENS, WORDS, buffers, fresh, in_row, mix, need, pieces, row_sums, table, tokens, windows
from faultline.operators import ordered

#: Buckets of n-gram counts; what the driver gathers is a few numbers for each, whatever the corpus.
BUCKETS = 1 << 16
#: A text whose mean log ratio per n-gram is below this is rejected, where the threshold is not fitted.
THRESHOLD = -0.25
#: Added to each bucket, as a share of a bucket's mean count.
SMOOTHING = 0.01
#: Buckets of the counts that are fitted, folds of texts, and what their smoothing is chosen from.
WIDE, FOLDS, SMOOTHINGS = 1 << 20, 4, (0.001, 0.01, 0.1, 1.0, 10.0)
#: Buckets whose counts are one row.
BLOCK = 1 << 14
#: Share of the held-out good texts that the threshold may lose, and quartile ranges that none is lost within.
LOST, FENCE = 0.01, 3.0
#: Scores that are ranked in one task; more are ranked in ranges.
RANKED = 100_000
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
#: Lines: everything but the line feed.
LINES = table({1: [(0, 9), (11, 255)]})
WINDOW = 5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated(keys: np.ndarray) -> np.ndarray:
    """Whether each key occurs more than once."""
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def base_counts(texts: pa.Array) -> np.ndarray:
    """One row of `COUNTS` per text; null and empty texts have zeros.

    Words, lines and windows are compared by 64-bit hashes.
    """
    data, at = buffers(texts)
    starts, ends, hashes, first = tokens(data, at, WORDS)
    n_words = np.diff(first)
    in_word = WORDS[data] != 0
    chars = row_sums(in_word & ((data & 0xC0) != 0x80), at)
    symbols = row_sums(SYMBOLS[data], at)

    line_starts, line_ends, line_hashes, line_first = tokens(data, at, LINES)
    upto = np.concatenate([[0], np.cumsum(in_word)])
    some = upto[line_ends] > upto[line_starts]
    rows = np.repeat(np.arange(len(texts)), np.diff(line_first))[some]
    _, once = np.unique(in_row(line_hashes[some], rows), return_index=True)
    dup_lines = np.bincount(rows, minlength=len(texts)) - np.bincount(rows[once], minlength=len(texts))

    keys, begin = windows(hashes, first, WINDOW, short=False)
    rows = np.repeat(np.arange(len(texts)), np.diff(begin))
    place = np.arange(begin[-1]) - begin[rows] + first[rows]
    twice = place[repeated(in_row(keys, rows))]
    change = np.bincount(twice, minlength=len(hashes) + 1)[: len(hashes) + 1] - np.bincount(twice + WINDOW, minlength=len(hashes) + 1)[: len(hashes) + 1]
    repeat_words = row_sums(np.cumsum(change)[:-1] > 0, first)
    return np.stack([n_words, chars, symbols, dup_lines, repeat_words], 1)


def _grams(texts: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the token unigrams and bigrams of the texts, the row of each, and the fold of each row.

    Texts of equal tokens are in one fold, so that no copy of a text takes part in what scores it.
    """
    data, at = buffers(texts)
    _, _, own, first = tokens(data, at, TOKENS)
    rows = np.repeat(np.arange(len(texts)), np.diff(first))
    inner = rows[1:] == rows[:-1]
    pairs = mix(own[:-1] * np.uint64(0xD6E8FEB86659FD93) + own[1:])[inner]
    sums = np.zeros(len(own) + 1, np.uint64)
    np.cumsum(mix(own), out=sums[1:])
    folds = (mix(sums[first[1:]] - sums[first[:-1]]) >> np.uint64(33)) % np.uint64(FOLDS)
    found = np.concatenate([own, pairs]) >> np.uint64(65 - buckets.bit_length())
    return found.astype(np.int64), np.concatenate([rows, rows[1:][inner]]), folds.astype(np.int64)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """`BUCKETS` buckets of the token unigrams and bigrams of the texts, and the row of each."""
    return _grams(texts, BUCKETS)[:2]


_COUNTED = "block int, counts binary"


def _packed(block: int, counts: np.ndarray) -> pa.RecordBatch:
    """One row: the counts of a block of buckets (raw, target of each fold), their bytes by significance, compressed."""
    planes = np.ascontiguousarray(counts.astype("<i8").reshape(-1).view(np.uint8).reshape(-1, 8).T)
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([pa.compress(planes.tobytes(), "zstd", asbytes=True)], pa.binary())], ["block", "counts"])


def _unpacked(counts: bytes) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(counts, (1 + FOLDS) * BLOCK * 8, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<i8").reshape(1 + FOLDS, BLOCK)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, counts) of the task's texts."""
    counts = np.zeros((1 + FOLDS) * WIDE, np.int64)
    for batch in batches:
        for piece in pieces(batch, 0):
            found, rows, folds = _grams(piece.column(0), WIDE)
            some = piece.column(1).to_numpy(zero_copy_only=False)[rows]
            np.add.at(counts, found, 1)
            np.add.at(counts, (1 + folds[rows[some]]) * WIDE + found[some], 1)
    for block in range(WIDE // BLOCK):
        own = counts.reshape(1 + FOLDS, WIDE)[:, block * BLOCK:(block + 1) * BLOCK]
        if own.any():
            yield _packed(block, own)


def _sum_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each block of the task."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            sums[block] = sums.get(block, 0) + _unpacked(counts)
    for block, counts in sums.items():
        yield _packed(block, counts)


def _known(trusted: DataFrame) -> DataFrame:
    return trusted.select(F.col("doc_id").cast("long").alias("__id")).filter("__id is not null").distinct().hint("merge")  # neither side of its joins has a proven bound


def _counts(docs: DataFrame, trusted: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Raw counts of the buckets and target counts of each fold, from all texts.

    Tasks count their own texts, blocks of buckets are summed after a shuffle. A row for each of WIDE / BLOCK blocks
    reaches the driver; texts stay in Spark.
    """
    rows = need(docs, doc_id="long", text="string").join(_known(trusted), F.col("doc_id") == F.col("__id"), "left")
    counts = rows.select("text", F.col("__id").isNotNull().alias("trusted")).mapInArrow(_count, _COUNTED)
    whole = np.zeros((1 + FOLDS, WIDE))
    for row in counts.repartition("block").mapInArrow(_sum_blocks, _COUNTED).collect():
        whole[:, row["block"] * BLOCK:(row["block"] + 1) * BLOCK] = _unpacked(bytes(row["counts"]))
    return whole[0], whole[1:]


def good_scores(docs: DataFrame, trusted: DataFrame, ratios: np.ndarray) -> DataFrame:
    """`log_ratio` of every distinct trusted text (by a 64-bit hash) that passes the base rule.

    All documents are scored where they are read; ids, text keys and scores are shuffled, texts are not.
    """
    rows = need(docs, doc_id="long", text="string").filter("text is not null").withColumn("key", F.xxhash64("text"))
    scored = judge(rows, ratios, 0.0, ["doc_id", "key"]).filter("not base_failed").select("doc_id", "key", "log_ratio")
    return scored.join(_known(trusted), F.col("doc_id") == F.col("__id"), "left_semi").groupBy("key").agg(F.min("log_ratio").alias("log_ratio"))


def order_statistics(scores: DataFrame, name: str, shares: tuple[float, ...], ranked: int = RANKED) -> list[float]:
    """The scores that these shares of all others precede (the lower of two); none without scores. Exact: all scores are ranked."""
    rows = cut_lineage(scores.select(F.lit(0).alias("all"), F.col(name).alias("score")))
    n = rows.count()
    if not n:
        return []
    places = [math.floor(share * (n - 1)) + 1 for share in shares]
    placed = ordered.rank(ordered.cut(rows, ["all"], "score", ranked), ["all"], ["score"], "place")
    found = {r["place"]: r["score"] for r in placed.filter(F.col("place").isin(places)).select("place", "score").collect()}
    return [found[p] for p in places]


def _share(counts: np.ndarray, smoothing: float) -> np.ndarray:
    return (counts + smoothing * counts.mean()) / (counts.sum() * (1 + smoothing))


def best_smoothing(target: np.ndarray) -> float:
    """The smoothing under which each fold is likeliest by the counts of the others; `SMOOTHING` if none has both."""
    whole, gain = target.sum(0), np.zeros(len(SMOOTHINGS))
    for own in target:
        if own.sum() and (whole - own).sum():
            some = np.flatnonzero(own)
            gain += [own[some] @ np.log(_share(whole - own, s)[some]) for s in SMOOTHINGS]
    return SMOOTHINGS[int(np.argmax(gain))] if gain.any() else SMOOTHING


def lowest(scores: DataFrame) -> float:
    """Threshold by the scores of held-out good texts: `LOST` of them are below it at most, and none within `FENCE` quartile ranges.

    A text that is likelier in the target than in the raw corpus is never below.
    """
    found = order_statistics(scores, "log_ratio", (LOST, 0.25, 0.75))
    if not found:
        return 0.0
    lost, low, high = found
    return float(min(0.0, lost, low - FENCE * (high - low)))


class Ratios(np.ndarray):
    """Log ratios of the whole target; `folds` and `threshold` are what verdicts use: a row for each fold, made without it."""

    folds: np.ndarray
    threshold: float


def log_ratios(docs: DataFrame, trusted: DataFrame) -> Ratios:
    """Log of target over raw probability for each of `BUCKETS` buckets, from all documents; zeros if nothing is trusted.

    Its `folds` have `WIDE` buckets each. A text is scored by the row of its fold, so a labelled text and one like it
    without a label score alike, whatever the size. Smoothing is the likeliest for held-out folds, the threshold comes
    from the held-out scores of all trusted texts that pass the base rule. A fold whose other
    folds have no trusted text has zeros.
    """
    raw, target = _counts(docs, trusted)
    ratios = np.zeros((FOLDS, WIDE), np.float32)
    whole, smoothing = target.sum(0), best_smoothing(target)
    for k in range(FOLDS):
        if (whole - target[k]).sum():
            ratios[k] = np.log(_share(whole - target[k], smoothing)) - np.log(_share(raw, smoothing))
    narrow = lambda c: c.reshape(BUCKETS, -1).sum(1)
    plain = np.log(_share(narrow(whole), SMOOTHING)) - np.log(_share(narrow(raw), SMOOTHING)) if whole.any() else np.zeros(BUCKETS)
    out = plain.view(Ratios)
    out.folds, out.threshold = ratios, lowest(good_scores(docs, trusted, ratios))
    return out


def _used(ratios: np.ndarray, threshold: float | None) -> tuple[np.ndarray, float]:
    """What verdicts are made with: of `Ratios` the folds and their threshold unless one is given."""
    if isinstance(ratios, Ratios):
        return ratios.folds, ratios.threshold if threshold is None else threshold
    return ratios, THRESHOLD if threshold is None else threshold


def base_failed(counts: np.ndarray) -> np.ndarray:
    return (counts[:, 0] < 10) | (100 * counts[:, 4] > 20 * counts[:, 0])


def verdicts(texts: pa.Array, ratios: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Base counts, mean log ratio and whether kept, of each text; `ratios` is one row, or one for each fold."""
    counts = base_counts(texts)
    found, rows, folds = _grams(texts, ratios.shape[-1])
    scores = np.bincount(rows, ratios[found] if ratios.ndim == 1 else ratios[folds[rows], found], len(texts)) / np.maximum(np.bincount(rows, minlength=len(texts)), 1)
    return counts, scores, ~base_failed(counts) & (scores >= threshold)


def judge(docs: DataFrame, ratios: np.ndarray, threshold: float | None = None, carry: list[str] | None = None) -> DataFrame:
    """Every row of `docs` with the base counts, base_failed, log_ratio (mean over the n-grams) and kept added.

    Of the input's columns those in `carry` are returned, else all.

    A null or empty text has no words: it fails the base rule. A text without n-grams has ratio 0. Equal texts
    get equal verdicts. Input columns of the added names are replaced.
    """
    ratios, threshold = _used(ratios, threshold)
    added = [*COUNTS, "base_failed", "log_ratio", "kept"]
    names = [c for c in (docs.columns if carry is None else carry) if c.lower() not in added]
    schema = docs.select(*[F.col(f"`{c}`") for c in names]).schema
    docs = docs.select(F.col("text").cast("string").alias(fresh(docs, "input_text")), *[F.col(f"`{c}`") for c in names])
    shared = docs.sparkSession.sparkContext.broadcast(ratios)  # BUCKETS numbers, or FOLDS * WIDE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in batches:
            for piece in pieces(batch, 0):
                counts, scores, kept = verdicts(piece.column(0), weights, threshold)
                more = [pa.array(counts[:, j]) for j in range(len(COUNTS))] + [pa.array(base_failed(counts)), pa.array(scores), pa.array(kept)]
                yield pa.RecordBatch.from_arrays([*piece.columns[1:], *more], [*names, *added])

    kinds = reduce(lambda s, c: s.add(c, "long"), COUNTS, type(schema)(list(schema.fields)))
    return docs.mapInArrow(run, kinds.add("base_failed", "boolean").add("log_ratio", "double").add("kept", "boolean"))


def trusted_documents(labels: DataFrame) -> DataFrame:
    """Ids of the trusted target: documents labelled as of good quality."""
    return labels.filter("quality = 1").select("doc_id")


def filter_quality(docs: DataFrame, labels: DataFrame, threshold: float | None = None) -> DataFrame:
    """The rows of `docs` that the rules keep, with their own columns; the threshold is fitted unless given."""
    ratios, threshold = _used(log_ratios(docs, trusted_documents(labels)), threshold)
    place, names = docs.columns.index("text"), docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, place):
                yield piece.filter(pa.array(verdicts(piece.column(place), shared.value, threshold)[2]))

    rows = docs.select(*[F.col(f"`{c}`").cast("string").alias(c) if c == "text" else F.col(f"`{c}`") for c in names])
    return rows.mapInArrow(keep, rows.schema)
