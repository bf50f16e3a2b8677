"""Small documents with awkward rows, and what the operators' brute-force counterparts share."""

from __future__ import annotations

import os
import re

SMALL = "/root/testdata/sf0.001"
PROSE = "the of and cat sat mat dog ran far home blue sky rain wind tree hill road town ship sea".split()


def prose(rng, n):
    return " ".join(rng.choice(PROSE) + str(rng.randrange(40)) for _ in range(n))


def documents(spark, rows):
    """doc_id and text, beside columns whose names operators use themselves."""
    extra = [(i, t, None if n % 3 else "en", f"s{n}", n, "x", 1, True) for n, (i, t) in enumerate(rows)]
    return spark.createDataFrame(extra, "doc_id long, text string, lang string, source string, n_chars long, key string, Kept int, seen boolean")


def empty(spark):
    return documents(spark, [(1, "x")]).filter("false")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def have_small():
    return os.path.isdir(SMALL)
