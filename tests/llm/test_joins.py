import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from faultline.llm import decontaminate, ngram_join, span_dedup
from faultline.llm.common import components
from tests.llm.helpers import documents, empty, prose, words


def grams(text):
    w = (text or "").lower().replace("\x1c", " ").split()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_classes(rows):
    """{row number: (class id, links)} by comparing every pair of texts."""
    texts = {}
    for n, (i, t) in enumerate(rows):
        texts.setdefault(t or "", []).append((n, i))
    names = list(texts)
    sets = [grams(t) for t in names]
    root, links = list(range(len(names))), [0] * len(names)

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(names)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
                links[a] += 1
                links[b] += 1
                root[top(a)] = top(b)
    ids = {}
    for k, t in enumerate(names):
        ids.setdefault(top(k), []).extend(i for _, i in texts[t] if i is not None)
    return {n: (min(ids[top(k)], default=None), links[k]) for k, t in enumerate(names) for n, _ in texts[t]}


def near_copies(rng, n_groups=12, size=5, length=80):
    rows = []
    for _ in range(n_groups):
        base = prose(rng, length).split()
        for _ in range(size):
            w = base[:]
            for k in rng.sample(range(length), rng.randrange(4)):
                w[k] = "new" + str(rng.randrange(1000))
            rows.append(" ".join(w))
    return rows


@pytest.mark.parametrize("block", [512, 4])
def test_classes_equal_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK_TEXTS", block)
    rng = random.Random(11)
    texts = near_copies(rng) + near_copies(rng, 1, 40) + [None, "", " ", "a b", "A  b", "a b c d e", "word " * 3000, "word " * 3001]
    rows = [*enumerate(texts), (3, texts[3]), (500, texts[0]), (None, texts[7]), (None, None), (501, "only once " + prose(rng, 30))]
    want = brute_classes(rows)
    docs = documents(spark, rows)
    got = Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in ngram_join.classes(docs).collect())
    assert got == Counter((rows[n][0], *want[n]) for n in range(len(rows)))
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for c, _ in want.values()})


def test_no_pair_is_emitted_and_empty_is_empty(spark):
    rng = random.Random(12)
    docs = documents(spark, list(enumerate(near_copies(rng, 1, 90, 300))))
    members, texts = ngram_join.link(docs)
    rows = texts.collect()
    assert len({r["root"] for r in rows}) == 1 and max(r["links"] for r in rows) == len(rows) - 1
    assert ngram_join.classes(empty(spark)).count() == 0 and ngram_join.keep_one(empty(spark)).count() == 0


def test_blocks_that_hold_nothing_count_no_link_twice(spark, monkeypatch):
    """Long texts make blocks of few rows each, so that most blocks of a bucket are empty."""
    monkeypatch.setattr(ngram_join, "BLOCK_GRAMS", 20)
    rng = random.Random(21)
    rows = list(enumerate(near_copies(rng, 10, 3, 60)))
    want = brute_classes(rows)
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in ngram_join.classes(documents(spark, rows)).collect()}
    assert got == {rows[n][0]: want[n] for n in range(len(rows))}


def test_pruning_follows_the_posterior():
    rng = np.random.default_rng(1)
    for n in (32, 128):
        least = ngram_join.least_matches(n, 0.8, 1e-4)
        for m in (least - 1, least):
            draws = rng.beta(m + 1, n - m + 1, 400_000)
            assert (np.mean(draws >= 0.8) >= 1e-4) == (m >= least) or abs(np.mean(draws >= 0.8) - 1e-4) < 6e-5


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(50)] + [(7, 7), (2000, 1999)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    want = {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(50)}, 1999: 1999, 2000: 1999}
    assert got == want


def test_leaks_are_found_with_substitutions(spark):
    rng = random.Random(13)
    items = [(i, prose(rng, n)) for i, n in enumerate([50, 30, 20, 13, 10, 7, 3])] + [(7, None), (8, ""), (9, "same " * 40)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows, want = [], set()
    for n in range(60):
        item = n % 4
        w = items[item][1].split()
        for k in rng.sample(range(len(w)), len(w) // 10):
            w[k] = "changed"
        before, after = prose(rng, rng.randrange(40)), prose(rng, rng.randrange(40))
        rows.append((n, f"{before} {' '.join(w).upper() if n % 2 else ', '.join(w)} {after}"))
        want.add((n, item))
    rows += [(100 + n, prose(rng, 60)) for n in range(40)]
    rows += [(200, items[4][1]), (201, "x " + items[5][1] + " y"), (202, " ".join(items[5][1].split()[:-1])), (203, items[6][1]), (204, None), (205, ""), (206, "same " * 9), (200, items[4][1])]
    want |= {(200, 4), (201, 5)}
    docs = documents(spark, rows)
    hits = decontaminate.overlaps(docs, benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in hits} == want and sum(r["doc_id"] == 200 for r in hits) == 2
    for r in hits:
        assert r["equal_words"] >= 0.8 * (r["end_word"] - r["first_word"]) and r["end_word"] <= 140
    kept = decontaminate.remove(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, _ in rows if i not in {d for d, _ in want})


def test_more_leaked_text_never_hides_a_hit():
    item = [f"word{i}" for i in range(76)]
    for runs in ((20, 8, 20, 8, 20), (13, 6, 13, 6, 13), (13,), (20, 9, 20)):
        text, at = [], 0
        for k, n in enumerate(runs):
            text += item[at:at + n] if k % 2 == 0 else ["changed"] * n
            at += n
        index = decontaminate.Items([(0, " ".join(item))])
        (_, _, low, high, same), = index.find(pa.array([" ".join(text)]))
        brute = max(sum(a == b for a, b in zip(text[i:j], item[i:j])) for i in range(len(text)) for j in range(i + 1, len(text) + 1) if sum(a == b for a, b in zip(text[i:j], item[i:j])) >= 0.8 * (j - i))
        assert same == brute and same >= 0.8 * (high - low)


@pytest.mark.parametrize("n", [10, 11, 12])
def test_any_two_substitutions_are_met(n):
    item = [f"word{i}" for i in range(n)]
    index = decontaminate.Items([(0, " ".join(item))])
    texts = [" ".join("x" if k in (i, j) else w for k, w in enumerate(item)) for i in range(n) for j in range(i)]
    assert len({h[0] for h in index.find(pa.array(texts))}) == len(texts)


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    rng = random.Random(14)
    items = [(i, prose(rng, 20)) for i in range(12)]
    docs = documents(spark, [(i, prose(rng, 10) + " " + items[i % 12][1]) for i in range(30)] + [(99, prose(rng, 30))])
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(tuple, decontaminate.overlaps(docs, benchmark).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 50)
    assert sorted(map(tuple, decontaminate.overlaps(docs, benchmark).collect())) == whole and len(whole) == 30
    assert decontaminate.remove(docs, benchmark).count() == 1
    assert decontaminate.overlaps(docs, benchmark.filter("false")).count() == 0
    assert decontaminate.remove(docs, benchmark.filter("false")).count() == 31 and decontaminate.remove(empty(spark), benchmark).count() == 0


def sentence_runs(text):
    w = [(x, i) for i, x in enumerate(words(text))]
    places, at = [], 0
    for x, _ in w:
        at = text.index(x, at)
        places.append((at, at + len(x)))
        at += len(x)
    sentences, own = [], []
    for k, (x, _) in enumerate(w):
        own.append(k)
        if x[-1] in ".!?" or k + 1 < len(w) and "\n" in text[places[k][1]:places[k + 1][0]]:
            sentences.append(own)
            own = []
    if own:
        sentences.append(own)
    size = lambda i, j: sum(map(len, sentences[i:j + 1]))
    out, end = set(), len(sentences) - 1
    for i in range(len(sentences)):
        j = i if len(sentences[i]) >= span_dedup.LONG_SENTENCE else i + 1
        while j <= end and j > i and size(i, j) < span_dedup.RUN_WORDS:
            j += 1
        if j <= end:
            out.add((i, j))
    if sentences:
        i = end if len(sentences[end]) >= span_dedup.LONG_SENTENCE else end - 1
        while 0 <= i < end and size(i, end) < span_dedup.RUN_WORDS:
            i -= 1
        if i >= 0:
            out.add((i, end))
    fold = lambda x: "".join(c.lower() if c.isascii() else c for c in x)
    return [(places[sentences[i][0]][0], places[sentences[j][-1]][1], " ".join(fold(w[k][0]) for s in sentences[i:j + 1] for k in s)) for i, j in out]


def test_repeated_runs_equal_a_loop(spark):
    rng = random.Random(15)
    speech = lambda n: " ".join(f"{prose(rng, rng.randrange(1, 12)).capitalize()}{rng.choice(['.', '!', '?', '.' + chr(10)])}" for _ in range(n))
    passage = [speech(9) for _ in range(4)]
    rows = [(i, f"{speech(3)} {passage[i % 4].upper() if i == 9 else passage[i % 4]} {speech(2)}" if i % 3 else speech(8)) for i in range(40)]
    rows += [(40, None), (41, ""), (42, "One. Two."), (43, "One. Two."), (44, passage[0] + " " + passage[0]), (45, "é " + passage[1]), (None, passage[2]), (46, prose(rng, 30)), (47, rows[1][1]), (46, None)]
    occurrences = {}
    for i, text in rows:
        for start, end, run in sentence_runs(text or ""):
            occurrences.setdefault(run, []).append(((i is None, i or 0, start), i, (start, end)))
    lost = {}
    for found in occurrences.values():
        for _, i, span in sorted(found)[1:]:
            lost.setdefault(i, set()).add(span)
    want = {}
    for i, spans in lost.items():
        joined = []
        for start, end in sorted(spans):
            if joined and start <= joined[-1][1] + 1:
                joined[-1][1] = max(joined[-1][1], end)
            else:
                joined.append([start, end])
        want[i] = joined
    docs = documents(spark, rows)
    got = {r["doc_id"]: [[s["start"], s["end"]] for s in r["spans"]] for r in span_dedup.repeated_spans(docs).collect()}
    assert got == want and {44, 45, 47, None} <= set(got) and not {42, 43, 46} & set(got)
    clean = span_dedup.remove(docs)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    text = {r["doc_id"]: r["text"] for r in clean.filter("doc_id <> 46").collect()}
    assert text[47] == "" and text[45].startswith("é") and len(text[45]) < len(passage[1])
    assert span_dedup.repeated_spans(empty(spark)).count() == 0 and span_dedup.remove(empty(spark)).count() == 0
    assert clean.filter(F.col("text").isNull()).count() == 2
