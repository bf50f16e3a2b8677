import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from faultline.llm import ranked_search, setsketch, vector_codes
from faultline.llm.common import components
from tests.llm.helpers import documents, empty, prose, words

ASCII_LOWER = {k: k + 32 for k in range(65, 91)}


# vector codes


def vectors(spark, rows):
    extra = [(i, v, label, 1, "x", 0) for i, v, label in rows]
    return spark.createDataFrame(extra, "vec_id long, embedding array<float>, label int, id int, code string, error int")


def brute_codes(rows, entries=256, rounds=4):
    """{(id, label, code, error)} and codebooks, part by part and entry by entry."""
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // 4
    cut = lambda v, p: v[p * width:(p + 1) * width]
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(4)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def near(v, p):
        gaps = [far(cut(v, p), c) for c in books[p]]
        return gaps.index(min(gaps)), min(gaps)

    for _ in range(rounds):
        new = []
        for p in range(4):
            own = {}
            for _, v, _ in kept:
                own.setdefault(near(v, p)[0], []).append(cut(v, p))
            new.append([[sum(x) // len(own[e]) for x in zip(*own[e])] if e in own else c for e, c in enumerate(books[p])])
        books = new
    out = []
    for i, v, label in kept:
        found = [near(v, p) for p in range(4)]
        out.append((i, label, bytes(e for e, _ in found), sum(d for _, d in found)))
    return out, books


def sample(rng, n):
    centres = [[rng.uniform(-0.5, 0.5) for _ in range(8)] for _ in range(5)]
    return [(k * 3, [c + rng.gauss(0, 0.05) for c in rng.choice(centres)], rng.choice([0, 1, None])) for k in range(n)]


@pytest.mark.parametrize("block", [4096, 7])
def test_codes_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(vector_codes, "BLOCK", block)
    monkeypatch.setattr(vector_codes, "ENTRIES", 16)
    monkeypatch.setattr(vector_codes, "STRIP", 5)
    rng = random.Random(3)
    rows = sample(rng, 60)
    rows += [(5, None, 1), (7, [0.1] * 7 + [None], 1), (8, [0.1] * 7 + [math.nan], 1), (9, [math.inf] + [0.0] * 7, 1), (10, [0.0] * 3, 1), (11, [], 1)]
    rows += [(0, rows[0][1], 2), (None, [-0.25] * 8, 2), (12, rows[4][1], 2), (12, rows[4][1], 2)]
    kept = [r for r in rows if r[1] is None or len(r[1]) == 8]
    want, books = brute_codes(kept, 16)
    table, got_books = vector_codes.compress(vectors(spark, rows))
    got = vector_codes.with_label_error(table).collect()
    assert got_books.tolist() == books
    assert Counter((r["id"], r["label"], bytes(r["code"]), r["error"]) for r in got) == Counter(want)
    totals = Counter()
    for _, label, _, error in want:
        totals[label] += error
    assert all(r["label_error"] == totals[r["label"]] for r in got)
    some = got[0]
    whole = vector_codes.decode(got_books, bytes(some["code"]))
    mine = next(v for i, v, _ in kept if i == some["id"] and v is not None)
    assert some["id"] in (0, 12) or int(((vector_codes.integers(np.array(mine, np.float32)) - whole) ** 2).sum()) == some["error"]


def test_codes_of_awkward_tables(spark):
    none, books = vector_codes.compress(vectors(spark, [(1, None, 1)]))
    assert none.collect() == [] and books.size == 0
    assert vector_codes.with_label_error(vector_codes.compress(vectors(spark, [(1, None, 1)]).filter("false"))[0]).collect() == []
    odd, books = vector_codes.compress(vectors(spark, [(k, [0.5 * k, 3e38, -1.0, 0.0, -3e38], 1) for k in range(3)]))
    assert books.shape == (4, 3, 2) and [r["error"] for r in odd.collect()] == [0, 0, 0]
    long = spark.createDataFrame([(str(k), [float(k)] * 4, "a") for k in range(3)], "vec_id string, embedding array<double>, label string")
    assert {r["id"] for r in vector_codes.compress(long)[0].collect()} == {"0", "1", "2"}


# near duplicates


def shingles(text):
    w = words((text or "").translate(ASCII_LOWER))
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                root[top(a)] = top(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[top(k)] = min(i, least.get(top(k), i))
    return Counter((i, len(sets[k]), least.get(top(k)) if sets[k] else i) for k, (i, _) in enumerate(rows))


def chained(rng, n, length, step):
    """Texts of which each differs a little more from the first."""
    w = prose(rng, length).split()
    out = []
    for _ in range(n):
        out.append(" ".join(w))
        for k in rng.sample(range(length), step):
            w[k] = "other" + str(rng.randrange(10**6))
    return out


@pytest.mark.parametrize("block", [512, 3])
def test_components_equal_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(setsketch, "BLOCK_TEXTS", block)
    monkeypatch.setattr(setsketch, "FOLLOWERS", block)
    rng = random.Random(5)
    texts = [t for _ in range(6) for t in chained(rng, 8, 120, 2)] + chained(rng, 30, 200, 1) + [prose(rng, 60) for _ in range(20)]
    texts += [None, "", " \t", "a b", "A  b", "Ä b c d e", "ä b c d e", "word " * 4000, "word " * 4001, prose(rng, 20000)]
    rows = list(enumerate(texts, 1))
    rng.shuffle(rows)
    rows += [(3, texts[3]), (900, texts[0].upper()), (901, texts[0]), (None, texts[9]), (None, None), (None, "a b")]
    got = setsketch.classes(documents(spark, rows)).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute_components(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_components_of_awkward_tables(spark):
    assert setsketch.classes(empty(spark)).collect() == []
    got = setsketch.classes(documents(spark, [(2, None), (1, ""), (None, "x")])).collect()
    assert {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got} == {(2, 0, 2, True), (1, 0, 1, True), (None, 1, None, True)}


def test_one_large_group_needs_few_comparisons(spark):
    rng = random.Random(8)
    base = prose(rng, 150).split()
    rows = []
    for k in range(400):
        w = base[:]
        w[rng.randrange(150)] = f"new{k}"
        rows.append((k, " ".join(w)))
    assert {r["component_id"] for r in setsketch.classes(documents(spark, rows)).collect()} == {0}


def test_estimates_and_merging(spark):
    rng = np.random.default_rng(2)
    for share in (0.3, 0.6, 0.85, 0.95):
        errors = []
        for _ in range(30):
            n = 1000
            both = round(2 * n * share / (1 + share))
            own = rng.integers(0, 2**64, 2 * n - both, dtype=np.uint64)
            a, b = own[:n], own[n - both:]
            regs = setsketch.registers(np.concatenate([a, b]), np.array([0, n, 2 * n]))
            u = setsketch.registers(own, np.array([0, len(own)]))
            assert (np.maximum(regs[0], regs[1]) == u[0]).all()
            args = [np.array([x]) for x in ((regs[0] > regs[1]).sum(), (regs[0] < regs[1]).sum(), float(n), float(n))]
            errors.append(setsketch.estimate(*args)[0] - share)
        assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06
    docs = documents(spark, [(1, "a b c d e f"), (2, "b c d e f g h"), (3, "a b c d e f g h"), (4, None)])
    sketches = setsketch.sketch(docs).withColumn("group", F.when(F.col("doc_id") < 3, 1).otherwise(2))
    merged = {r["group"]: bytes(r["sketch"]) for r in setsketch.merge_sketches(sketches, ["group"]).collect()}
    assert merged[1] == merged[2]


def test_pruning_keeps_pairs_at_the_limit():
    rng = np.random.default_rng(4)
    kept, n = 0, 400
    both = math.ceil(2 * n * 0.85 / 1.85)
    for _ in range(300):
        own = rng.integers(0, 2**64, 2 * n - both, dtype=np.uint64)
        regs = setsketch.registers(np.concatenate([own[:n], own[n - both:]]), np.array([0, n, 2 * n]))
        kept += int(setsketch.may_reach(regs[0], regs[1:], np.int64(n), np.array([n]), 85)[0])
    assert kept == 300
    own = rng.integers(0, 2**64, 2 * n, dtype=np.uint64)
    regs = setsketch.registers(own, np.array([0, n, 2 * n]))
    assert not setsketch.may_reach(regs[0], regs[1:], np.int64(n), np.array([n]), 85)[0]


def test_hub_and_chain_components(spark):
    edges = [(0, k) for k in range(1, 300)] + [(k, k + 1) for k in range(1000, 1400)] + [(7, 7)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {(r["node"], r["root"]) for r in got} == {(k, 0) for k in range(300)} | {(k, 1000) for k in range(1000, 1401)}


# ranked search


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(ASCII_LOWER))


def brute_search(docs, items):
    found = [(i, Counter(split(t))) for i, t in docs]
    found = [(i, c) for i, c in found if c]
    n, total = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    own = {}
    for i, t in items:
        own.setdefault(i, set()).update(split(t))
    out = []
    for item, wanted in own.items():
        scored = []
        for i, c in found:
            m = 10 + 90 * sum(c.values()) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in wanted if c[t])
            if s > 0:
                scored.append((-s, i is None, i if i is not None else 0))
        out += [(item, k, None if no else i, -s) for k, (s, no, i) in enumerate(sorted(scored)[:10], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("small", [False, True])
def test_search_equals_scoring_all(spark, monkeypatch, small):
    if small:
        for name, value in (("BLOCK_DOCS", 3), ("PASS_TERMS", 40), ("CELLS", 640)):
            monkeypatch.setattr(ranked_search, name, value)
    rng = random.Random(6)
    texts = [prose(rng, rng.randrange(1, 60)) for _ in range(120)] + [None, "", " .-", "Ärger ärger ÄRGER", "x_y x-y X Y", prose(rng, 30000), "same text", "same text"]
    rows = [*enumerate(texts), (500, texts[3]), (501, texts[3]), (3, texts[3]), (None, texts[3]), (None, "ärger")]
    items = [(k, texts[k] + " " + prose(rng, 3)) for k in range(8)] + [(20, None), (21, "..."), (22, "nowhere"), (23, "SAME, same Ärger"), (None, "x y"), (5, "more"), (24, prose(rng, 400)), (24, "same text")]
    table = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, doc_id int, score int")
    got = [tuple(r) for r in ranked_search.search(documents(spark, rows), table).collect()]
    assert sorted(got, key=repr) == brute_search(rows, items)


def test_search_of_empty_tables(spark):
    table = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    for docs, items in ((empty(spark), table), (documents(spark, [(1, "a")]), table.filter("false")), (documents(spark, [(1, None)]), table)):
        got = ranked_search.search(docs, items)
        assert got.collect() == [] and got.columns == ["item", "rank", "doc_id", "score"]


def test_numbers_beyond_64_bits():
    lengths = np.array([1, 10**7])
    n, total = 10**12, 4 * 10**14
    assert ranked_search.length_measure(lengths, n, total).tolist() == [10 + 90 * x * n // total for x in lengths.tolist()]
