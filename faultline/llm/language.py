"""Language identification by compression: the language whose dictionary shortens a text most."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.llm.common import fresh, need, utf8

#: Documents of a language that its dictionary is made of, at most, and characters taken from each.
SAMPLE_DOCS, SAMPLE_CHARS = 40, 400
#: A text is encoded in blocks of this many bytes, so that each block leans on the dictionary, not on the text itself.
BLOCK = 1024
LEVEL = 5
#: The runner-up must need this share more bytes than the winner, else the language is not sure.
MARGIN = 0.03
UNDETERMINED = "und"


def letters(c: Column) -> Column:
    """What is encoded: letters in lower case, anything else as single spaces; null without a letter."""
    return F.when(c.rlike(r"\p{L}"), F.regexp_replace(F.lower(c), r"[^\p{L}\p{M}]+", " "))


def dictionaries(docs: DataFrame, usable: Column) -> list[tuple[str, bytes]]:
    """(language, raw dictionary content), learnt from rows where `usable`; the most common language first.

    A bounded sample: of each language the `SAMPLE_DOCS` distinct texts of least hash that hold a letter, of each the first
    `SAMPLE_CHARS` characters of what `letters` makes of the whole text, so the driver gets that much per language. Copies count once.
    How common a language is, is counted over all usable rows.
    """
    rows = docs.filter(usable).select(F.col("lang").cast("string"), F.col("text").cast("string").alias("text")).filter("lang is not null and text is not null")
    hashed = rows.filter(F.col("text").rlike(r"\p{L}")).withColumn("h", F.xxhash64("text"))
    least = hashed.select("lang", "h").distinct().withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).filter(f"n <= {SAMPLE_DOCS}")
    some = hashed.join(F.broadcast(least), ["lang", "h"])  # SAMPLE_DOCS rows a language
    some = some.groupBy("lang", "n").agg(F.min(F.substring(letters(F.col("text")), 1, SAMPLE_CHARS)).alias("part"))
    learnt: dict[str, list] = {}
    for row in some.select("lang", "n", "part").toLocalIterator():
        learnt.setdefault(row["lang"], []).append((row["n"], row["part"]))
    common = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).toLocalIterator()}
    return [(lang, b"\n".join(utf8(part) for _, part in sorted(learnt[lang]))) for lang in sorted(learnt, key=lambda x: (-common[x], x))]


def blocks(data: bytes) -> list[bytes]:
    return [data[i:i + BLOCK] for i in range(0, len(data), BLOCK)]


def encoders(learnt: list[tuple[str, bytes]]) -> list[zstandard.ZstdCompressor]:
    out = []
    for _, content in learnt:
        made = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        how = zstandard.ZstdCompressionParameters.from_level(LEVEL, source_size=BLOCK, dict_size=len(content), write_content_size=0, write_dict_id=0)
        made.precompute_compress(compression_params=how)
        out.append(zstandard.ZstdCompressor(dict_data=made, compression_params=how))
    return out


def sizes(data: bytes, made: list[zstandard.ZstdCompressor]) -> np.ndarray:
    """Bytes of the text under each language's dictionary."""
    parts = blocks(data)
    return np.array([sum(len(c.compress(x)) for x in parts) for c in made], np.int64)


def verdict(encoded: np.ndarray) -> tuple[int, float, bool]:
    """Place of the least size (ties: the first, so the most common), a score in 0 to 1, and whether the margin is wide enough.

    The score is 0.5 at equal sizes and grows with the runner-up's excess; 1 if there is one language only.
    """
    best = int(np.argmin(encoded))
    if len(encoded) == 1:
        return best, 1.0, True
    second = np.delete(encoded, best).min()
    margin = float(second - encoded[best]) / max(float(encoded[best]), 1.0)
    return best, 1 / (1 + float(np.exp(-20 * margin))), margin >= MARGIN


def identify(docs: DataFrame, learnt: list[tuple[str, bytes]], carry: list[str]) -> DataFrame:
    """The columns in `carry` with lang_pred, score and sure added, for every row of `docs`.

    All letters of the text are encoded. A null text, one without a letter, or any text when no language was learnt is
    `und` with score 0 and not sure. Equal texts get equal results. Columns of the added names are replaced.
    """
    names = [c for c in carry if c.lower() not in ("lang_pred", "score", "sure")]
    schema = docs.select(*[F.col(f"`{c}`") for c in names]).schema
    rows = docs.select(letters(F.col("text").cast("string")).alias(fresh(docs, "input_text")), *[F.col(f"`{c}`") for c in names])
    shared = docs.sparkSession.sparkContext.broadcast(learnt)  # SAMPLE_DOCS * SAMPLE_CHARS characters per language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        made = encoders(known)
        for batch in batches:
            out = []
            for value in batch.column(0):
                value = value.as_py()
                if value is None or not made:
                    out.append((UNDETERMINED, 0.0, False))
                    continue
                best, score, sure = verdict(sizes(utf8(value), made))
                out.append((known[best][0], score, sure))
            cols = list(zip(*out)) or [(), (), ()]
            more = [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.float64()), pa.array(cols[2], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *more], [*names, "lang_pred", "score", "sure"])

    return rows.mapInArrow(run, schema.add("lang_pred", "string").add("score", "double").add("sure", "boolean"))


def accuracy(predicted: DataFrame, truth: DataFrame) -> float:
    """Share of rows whose language was found; both with doc_id."""
    both = predicted.join(need(truth, doc_id="long", lang="string"), "doc_id").filter("lang is not null")
    return both.agg(F.avg(F.expr("int(lang = lang_pred)"))).first()[0]
