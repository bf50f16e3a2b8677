import os
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from faultline.llm import quality_rules, sharding, urls
from faultline.llm.queries import ORACLES
from tests.llm.helpers import SMALL, documents, empty, have_small, prose


def test_packing_balances_all_measures():
    rng = np.random.default_rng(3)
    items = np.stack([rng.pareto(1.5, 900) * 100 + 1, rng.pareto(1.5, 900) * 20 + 1, np.ones(900)], 1)
    shard, room = sharding.pack(items, np.full((16, 3), 1 / 16))
    sums = np.stack([np.bincount(shard, items[:, k], 16) for k in range(3)], 1)
    assert np.allclose(1 / 16 - sums / items.sum(0), room)
    assert (sums[:, 2].max() - sums[:, 2].min()) <= 12
    left = np.full((16, 3), 1 / 16)  # every choice has the highest dot product at its turn
    scaled = items / items.sum(0)
    for i in np.lexsort((np.arange(900), -scaled.max(1))):
        assert shard[i] == np.argmax(left @ scaled[i])
        left[shard[i]] -= scaled[i]


@pytest.mark.parametrize("pack_rows", [20_000, 60])
def test_shards(spark, monkeypatch, pack_rows):
    monkeypatch.setattr(sharding, "PACK_ROWS", pack_rows)
    monkeypatch.setattr(sharding, "SLOT_ROWS", 50)
    rng = random.Random(9)
    rows = [(i, prose(rng, rng.randrange(1, 60))) for i in range(700)]
    rows += [(i, "one text of a third") for i in range(700, 1050)] + [(2000, None), (2001, ""), (5, rows[5][1]), (None, "no id"), (None, "no id")]
    docs = documents(spark, rows)
    got = sharding.shard_documents(docs, 16).toPandas()
    assert len(got) == len(rows) and set(got["shard"]) <= set(range(16))
    for _, own in got.groupby("shard"):
        assert sorted(own["slot"]) == list(range(len(own)))
    sizes = got.groupby("shard")["size"].sum()
    assert (sizes.max() - sizes.min()) / sizes.mean() < (0.1 if pack_rows > 1000 else 0.3)  # two groups per bucket and shard there
    split = got.groupby("text_crc32")["shard"].nunique()
    assert (split > 1).sum() == 1  # only the group that no shard can hold
    assert got[got.doc_id == 2000]["size"].item() == 1 and got[got.doc_id == 2000].text_crc32.item() == 0
    again = sharding.shard_documents(docs.repartition(7), 16).toPandas()
    order = ["doc_id", "size", "slot", "shard"]
    assert got.sort_values(order)[order].reset_index(drop=True).equals(again.sort_values(order)[order].reset_index(drop=True))
    assert sharding.shard_documents(empty(spark), 16).count() == 0


@pytest.mark.parametrize("singles", [38, 2])
def test_shards_are_even_where_groups_are_much_of_a_bucket(spark, monkeypatch, singles):
    monkeypatch.setattr(sharding, "PACK_ROWS", 50)
    rng = random.Random(21)
    copies = [t for g in range(400) for t in [f"group {g:05} of copies"] * rng.randrange(4, 15)]
    texts = copies + [f"single {i:05} no copy" for i in range(400 * singles)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sharding.shard_documents(rows, 8).select("shard", "size", "text_crc32").collect()
    sums = np.bincount([r["shard"] for r in got], [r["size"] for r in got], 8)
    assert len(got) == len(texts) and sums.max() <= 1.03 * sums.mean() and sums.min() >= 0.97 * sums.mean()
    assert len({(r["shard"], r["text_crc32"]) for r in got}) == len(set(texts))


def judged(url):
    """What a page gets, by trying every rule."""
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):], re.S)[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h) + len(p), h + p, v) for v, h, p in urls.HOST_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        _, rule, verdict = max(fits)
        return host, path, rule, verdict
    met = {v for v, p in urls.PATTERN_RULES if re.search(urls.to_regex(p), f".{host}{path}")}
    return host, path, None, "allow" if "allow" in met or not met else "block"


def test_urls(spark):
    rng = random.Random(10)
    hosts = ["Example.NET", "a.example.com", "x.org", "org", "net", "www.cheap-pills.test", "ads.track.io", "my-casino.fun", "casino.legal", "pills-now.example.org", "notnet", "xn--a.net:80", "www.spam-a.test"]
    paths = ["", "/", "/en/", "/en", "/de/x", "/fr/y?z=/en/", "#/fr/", "/legal/spam-x", "?q=://net/", "/robots.txt", "/FR/", "/a\n/b"]
    rows = [f"{rng.choice(['http', 'https', '', 'a://b'])}://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(300)]
    rows += [None, "", "://", "no scheme", "http:/x", "http://", "http://ads.example.test"] + ["http://net/"] * 20
    pages = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string").withColumns({"HOST": F.lit(1), "spot": F.lit(2), "token": F.lit(3), "rule": F.lit("?")})
    got = urls.filter_urls(pages, urls.default_rules(spark)).select("page_id", "host", "path", "rule", "verdict").collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[1:] == judged(rows[r["page_id"]]), rows[r["page_id"]]
    assert urls.filter_urls(pages.filter("false"), urls.default_rules(spark)).count() == 0
    assert {r["verdict"] for r in urls.filter_urls(pages, urls.default_rules(spark).filter("false")).collect()} == {"allow"}


def test_only_rules_of_a_url_s_tokens_can_fit():
    for _, pattern in urls.PATTERN_RULES:
        for token in urls.literal_tokens(pattern):
            assert re.search(rf"(?<![A-Za-z0-9]){token}(?![A-Za-z0-9])", pattern)
    assert urls.literal_tokens("*/robots.txt") == ["robots"] and urls.literal_tokens("*-pills.*") == ["pills"]


@pytest.mark.skipif(not have_small(), reason="driver tables absent")
def test_url_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SMALL}/pages.parquet'")
    want = con.execute(ORACLES["op8_url_filter"])
    names = [d[0] for d in want.description]
    got = entry.queries()["op8_url_filter"](spark, SMALL).select(*names).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want.fetchall(), key=repr)


@pytest.mark.skipif(not have_small(), reason="driver tables absent")
def test_pipeline_stages_one_by_one(spark, tmp_path):
    import corpus_pipeline
    from tests.llm.test_joins import brute_classes
    from tests.llm.test_pii import brute

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = docs.collect()
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    judged = quality_rules.judge(docs, quality_rules.log_ratios(docs, quality_rules.trusted_documents(labels)), carry=["doc_id"])
    kept = {r["doc_id"] for r in judged.filter("kept").collect()}
    rows = [r for r in rows if r["doc_id"] in kept]
    classes = brute_classes([(r["doc_id"], r["text"]) for r in rows])
    rows = [r for n, r in enumerate(rows) if classes[n][0] == r["doc_id"]]
    items = [x["text"] for x in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    clean = [r for r in rows if not any(x in r["text"] for x in items)]
    out = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert set(out) == {r["doc_id"] for r in clean}
    masked = 0
    for r in clean:
        text = r["text"]
        spans = sorted((tuple(map(int, s.split(":")[1:])), s.split(":")[0]) for s in brute(text))
        for (start, end), kind in reversed(spans):
            text = text[:start] + f"[{kind.upper()}]" + text[end:]
        masked += bool(spans)
        assert out[r["doc_id"]]["text"] == text and out[r["doc_id"]]["round_trip"] and out[r["doc_id"]]["n_chars"] == len(text)
    assert masked and set(docs.columns) < set(out[clean[0]["doc_id"]].asDict())


def test_stages_take_empty_tables(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty(spark), str(tmp_path))
        assert out.count() == 0 and set(empty(spark).columns) <= set(out.columns), name


def test_rest_lives_without_the_subpackage(tmp_path):
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(entry.__file__))
    copy = tmp_path / "copy"
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; q = e.queries(); print(len(q), 'pipeline' in q, any(k.startswith('op') and k[2].isdigit() for k in q))"], cwd=copy, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": str(copy)})
    assert said.returncode == 0 and said.stdout.split()[1:] == ["False", "False"], said.stderr
