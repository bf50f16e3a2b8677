import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from faultline.llm import language, quality_model, quality_rules
from tests.llm.helpers import documents, empty, prose, words

LANGUAGES = {
    "en": "the house of the king was on the hill and they went with their friends to see that it was good",
    "de": "das haus des koenigs stand auf dem berg und sie gingen mit ihren freunden um zu sehen dass es gut war",
    "es": "la casa del rey estaba en la colina y ellos fueron con sus amigos para ver que todo era muy bueno",
}


def sample(lang, rng, n=40):
    return " ".join(rng.choice(LANGUAGES[lang].split()) for _ in range(n))


@pytest.fixture(scope="module")
def spoken(spark):
    rng = random.Random(4)
    rows = [(i, sample(lang, rng), lang) for i, lang in enumerate(sorted(LANGUAGES) * 40)]
    rows += [(900, None, "en"), (901, "", "de"), (902, "12 34 !!", "es"), (903, "the " * 4000, None), (904, sample("de", rng), None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_copies_and_late_letters_in_the_sample(spark):
    rng = random.Random(9)
    texts = [sample("en", rng) for _ in range(5)] + ["1 " * 3000 + sample("en", rng)]
    rows = [(i, t) for i, t in enumerate([*texts, *[texts[0]] * 200])]
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows] + [(999, "7 " * 900 + "la casa del rey", "es")], "doc_id long, text string, lang string")
    learnt = dict(language.dictionaries(docs, F.lit(True)))
    assert sorted(x.strip() for x in learnt["en"].decode().split("\n")) == sorted(t.lstrip("1 ")[:400].strip() for t in texts)
    assert learnt["es"].decode().strip() == "la casa del rey"


def test_language_by_compression(spark, spoken):
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    learnt = language.dictionaries(spoken, ~held)
    assert {lang for lang, _ in learnt} == set(LANGUAGES)
    got = {r["doc_id"]: r for r in language.identify(spoken, learnt, ["doc_id", "lang"]).collect()}
    assert len(got) == spoken.count()
    for i in (900, 901, 902):
        assert (got[i]["lang_pred"], got[i]["score"], got[i]["sure"]) == ("und", 0.0, False)
    right = [r["lang"] == r["lang_pred"] for i, r in got.items() if i < 900]
    assert np.mean(right) > 0.97 and got[904]["lang_pred"] == "de" and got[903]["lang_pred"] == "en"
    assert all(0 <= r["score"] <= 1 for r in got.values())
    made = language.encoders(learnt)
    for r in spoken.filter("doc_id < 6").collect():  # the same by hand
        size = [sum(len(c.compress(x)) for x in language.blocks(r["text"].encode())) for c in made]
        assert learnt[int(np.argmin(size))][0] == got[r["doc_id"]]["lang_pred"]


def test_nothing_learnt_is_undetermined(spark, spoken):
    assert language.dictionaries(spoken.filter("false"), F.lit(True)) == []
    assert {r["lang_pred"] for r in language.identify(spoken, [], ["doc_id"]).collect()} == {"und"}


def base(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {i + j for i in range(len(w) - 4) if grams[tuple(w[i:i + 5])] > 1 for j in range(5)}
    return [len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)]


def test_base_counts_equal_a_loop():
    rng = random.Random(5)
    texts = ["a b c", "", None, "a\n a\na", "é é é é é é é\n\n \n", "\x1c \x85   q", "x " * 7, "😀 # \t|\v", "w " * 3000]
    texts += ["".join(rng.choice(["a ", "b ", "é ", "#x ", "\n", "c\n", " "]) for _ in range(rng.randrange(80))) for _ in range(300)]
    got = quality_rules.base_counts(pa.array(texts, pa.string()))
    for text, row in zip(texts, got):
        assert row.tolist() == base(text), text


def test_ratio_equals_a_loop_and_rejects_junk(spark):
    rng = random.Random(6)
    good = [(i, prose(rng, 60)) for i in range(60)]
    bad = [(i, " ".join(x.upper() + "!!" for x in prose(rng, 60).split())) for i in range(60, 80)]
    odd = [(80, None), (81, ""), (82, prose(rng, 9)), (83, "same words here now ok " * 30), (None, good[0][1]), (0, good[0][1])]
    docs = documents(spark, good + bad + odd)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 40)] + [(i, 0, 0) for i in range(60, 70)] + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    ratios = quality_rules.log_ratios(docs, quality_rules.trusted_documents(labels))
    raw, target = np.zeros(quality_rules.BUCKETS), np.zeros(quality_rules.BUCKETS)
    for i, text in good + bad + odd:
        found, _ = quality_rules.features(pa.array([text], pa.string()))
        np.add.at(raw, found, 1)
        if i is not None and i < 40:
            np.add.at(target, found, 1)
    share = lambda c: (c + quality_rules.SMOOTHING * c.mean()) / (c.sum() * (1 + quality_rules.SMOOTHING))
    assert np.allclose(ratios, np.log(share(target) / share(raw)))
    got = quality_rules.judge(docs, ratios)
    assert got.count() == docs.count()
    kept = {r["source"]: r["kept"] for r in got.select("source", "kept").collect()}
    assert all(kept[f"s{i}"] for i in range(60)) and not any(kept[f"s{i}"] for i in range(60, 84))
    left = quality_rules.filter_quality(docs, labels)
    assert left.columns == docs.columns and left.count() == sum(kept.values())
    assert quality_rules.filter_quality(empty(spark), labels).count() == 0
    assert (quality_rules.log_ratios(docs, quality_rules.trusted_documents(labels.filter("false"))) == 0).all()


def test_order_statistics_rank_all_scores(spark):
    rng = random.Random(12)
    values = [rng.choice([0.0, rng.gauss(0, 1)]) for _ in range(997)]
    df = spark.createDataFrame([(v,) for v in values], "log_ratio double").repartition(3)
    want = [float(x) for x in np.quantile(values, [0.01, 0.25, 0.75, 1.0], method="lower")]
    for ranked in (10_000, 100):  # in one task; in ranges
        assert quality_rules.order_statistics(df, "log_ratio", (0.01, 0.25, 0.75, 1.0), ranked) == want
    assert quality_rules.order_statistics(df.limit(0), "log_ratio", (0.5,)) == []


def test_threshold_comes_from_every_good_text(spark):
    rng = random.Random(13)
    made = lambda: " ".join(f"w{min(int(rng.expovariate(0.02)), 400)}" for _ in range(rng.randrange(10, 16)))
    rows = [(i, made()) for i in range(7000)]
    rows += [(7000 + i, rows[i][1]) for i in range(50)]  # copies count once
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(6000)] + [(7000 + i, 1, 0) for i in range(50)], "doc_id long, quality int, toxic int")
    trusted = quality_rules.trusted_documents(labels)
    ratios = quality_rules.log_ratios(docs, trusted)
    good = {rows[i][1]: None for i in range(6000)}
    scores = [r["log_ratio"] for r in quality_rules.judge(docs, ratios, carry=["text"]).filter("not base_failed").dropDuplicates(["text"]).collect() if r["text"] in good]
    lost, low, high = np.quantile(scores, [quality_rules.LOST, 0.25, 0.75], method="lower")
    assert len(scores) > 5000 and ratios.threshold == min(0.0, lost, low - quality_rules.FENCE * (high - low)) < 0


@pytest.mark.parametrize("n", [40, 300])
def test_good_text_without_a_label_stays_at_any_size(spark, n):
    rng = random.Random(9)
    spoken = lambda: sample(rng.choice(sorted(LANGUAGES)), rng, 50) + " " + " ".join(f"{rng.choice('bdfgklm')}{rng.choice('aeiou')}{rng.randrange(10**5)}" for _ in range(10))
    rows = [(i, spoken()) for i in range(2 * n)] + [(2 * n + i, " ".join(rng.choice(["#", "buy", "click", "%%", "now"]) + str(rng.randrange(10**4)) for _ in range(60))) for i in range(n // 4)]
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(n)], "doc_id long, quality int, toxic int")
    ratios = quality_rules.log_ratios(docs, quality_rules.trusted_documents(labels))
    got = {r["doc_id"]: (r["log_ratio"], r["kept"]) for r in quality_rules.judge(docs, ratios, carry=["doc_id"]).collect()}
    share = lambda ids: np.mean([got[i][1] for i in ids])
    assert share(range(n)) >= 0.98 and share(range(n, 2 * n)) >= 0.98 and share(range(2 * n, len(rows))) == 0
    # labelled and unlabelled texts score alike
    assert abs(np.mean([got[i][0] for i in range(n)]) - np.mean([got[i][0] for i in range(n, 2 * n)])) < 0.2 * abs(ratios.threshold)
    assert {r["doc_id"] for r in quality_rules.filter_quality(docs, labels).collect()} == {i for i, v in got.items() if v[1]}


def test_classifier_learns_and_is_calibrated(spark):
    rng = random.Random(7)
    rows = [(i, prose(rng, 40) if i % 3 else " ".join(x + "***" for x in prose(rng, 40).split())) for i in range(300)]
    docs = documents(spark, rows + [(300, None), (301, ""), (None, "q"), (5, rows[5][1])])
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(0, 300, 2)], "doc_id long, quality int, toxic int")
    usable = F.col("doc_id") % 5 != 0
    first = {r["source"]: r["score"] for r in quality_model.score(docs, labels, usable, ["doc_id", "source"]).collect()}
    assert len(first) == docs.count() and all(0 <= x <= 1 for x in first.values())
    held = [i for i in range(300) if i % 2 or i % 5 == 0]
    assert np.mean([(first[f"s{i}"] >= 0.5) == (i % 3 > 0) for i in held]) > 0.97
    assert first["s303"] == first["s5"]
    again = {r["source"]: r["score"] for r in quality_model.score(docs.repartition(5), labels, usable, ["doc_id", "source"]).collect()}
    assert again == pytest.approx(first)
    flat = quality_model.score(docs, labels.filter("quality = 1"), usable, ["doc_id"]).select("score").distinct().collect()
    assert len(flat) == 1 and quality_model.score(empty(spark), labels, usable, ["doc_id"]).count() == 0


def test_scores_equal_a_loop_under_clashing_names(spark):
    rng = random.Random(9)
    rows = [(i, prose(rng, 12 + i % 9) if i % 3 else "* ".join(prose(rng, 12).split())) for i in range(120)] + [(120, None), (121, "")]
    rows.append((122, prose(rng, 40_000)))
    docs = documents(spark, rows).selectExpr("*", "doc_id AS Score", "source AS features", "n_chars AS word", "key AS target")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(120)], "doc_id long, quality int, toxic int")
    carry = ["Score", "features", "word", "target", "text"]
    out = quality_model.score(docs, labels, F.col("doc_id") >= 0, carry)
    assert out.columns == [*carry, "score_"]
    got = {r["Score"]: (r["score_"], r["features"]) for r in out.collect()}
    assert {i: v[1] for i, v in got.items()} == {i: f"s{n}" for n, (i, _) in enumerate(rows)}
    vectors = quality_model.word_vectors(docs)
    pools = {}
    for i, text in rows:
        own = quality_model.word_numbers(pa.array([text], pa.string()))[0]
        pools[i] = np.mean([vectors[w].astype(np.float64) for w in own], 0) if len(own) else np.zeros(2 * quality_model.SIZE)
    plain = quality_model.pooled(docs, vectors, ["doc_id"])
    net = quality_model.fit(plain, labels, F.col("doc_id") >= 0)
    for i, x in pools.items():
        hidden = [np.tanh(sum((x[j] - net.mean[j]) / net.scale[j] * net.w1[j, k] for j in range(len(x))) + net.b1[k]) for k in range(len(net.b1))]
        logit = sum(h * w for h, w in zip(hidden, net.w2)) + net.b2
        assert got[i][0] == pytest.approx(1 / (1 + np.exp(-logit / net.heat)), abs=1e-3)


def test_context_sums_equal_a_loop():
    texts = ["a b c d a", "", None, "x", "b a"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    out = next(quality_model.context_sums(iter([batch])))
    index = quality_model.dense_index()
    want = {}
    for text in texts:
        own = quality_model.word_numbers(pa.array([text], pa.string()))[0].tolist()
        for i, w in enumerate(own):
            for j in (i - 2, i - 1, i + 1, i + 2):
                if 0 <= j < len(own):
                    want[w] = want.get(w, 0) + index[own[j]]
    got = {w: np.array([out.column(f"v{j}")[k].as_py() for j in range(quality_model.SIZE)]) for k, w in enumerate(out.column("word").to_pylist())}
    assert {w for w, v in want.items() if v.any()} == set(got) and all((got[w] == want[w]).all() for w in got)


def test_temperature_lowers_the_loss():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(600, 6))
    y = (x[:, 0] + rng.normal(0, 1.5, 600) > 0).astype(float)
    net = quality_model.train(x, y)
    test = np.arange(600) % 5 == 4
    loss = lambda t: np.logaddexp(0, -(2 * y[test] - 1) * net.logits(x[test]) / t).mean()
    assert loss(net.heat) <= loss(1.0) + 1e-12 and re.match(r"\d", str(net.heat))
