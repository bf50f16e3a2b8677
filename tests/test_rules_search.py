import random

import pytest
from pyspark.sql import functions as F

from faultline.functions import text as X
from faultline.operators import evaluate as V
from faultline.operators import rights as R
from faultline.operators import search as S
from faultline.schemas import PERIOD
from faultline.session import small_table
from tests.helpers import fixed, recurring, ts


def rule(i, hosts=None, originals=None, prefixes=None, types=None, priority=None, ok=True):
    return (i, i, hosts, originals, prefixes, types, priority, "generic-web", "c", "o", "p", "From {sourceUrl}", ok)


def statuses(spark, rules, urls, kind="report.public"):
    ev = spark.createDataFrame([(str(i), u, kind, "secret", "r") for i, u in enumerate(urls)], "evidence_id string, source_url string, type string, text string, render string")
    out = R.resolve_rules(ev, small_table(spark, rules, R.RULE_COLUMNS)).orderBy("evidence_id").collect()
    return [(r.status, r.rule.id if r.rule else None) for r in out]


def test_matching(spark):
    rules = [rule("host", ["X.com"], types=["report.public"]), rule("path", prefixes=["news"], priority=3), rule("arch", ["web.archive.org"], ["orig.org"], priority=5)]
    urls = ["https://x.com:8443/a", "https://X.COM/news/1", "https://y.com/newsy", "https://y.com/", "not a url",
            "https://web.archive.org/web/2024/https://orig.org/p", "https://web.archive.org/web/2024/https%3A%2F%2Forig.org%2Fp", "https://web.archive.org/web/2024/zzz"]
    assert statuses(spark, rules, urls) == [
        ("resolved", "host"), ("resolved", "path"), ("resolved", "path"), ("no-match", None), ("invalid-source-url", None),
        ("resolved", "arch"), ("resolved", "arch"), ("no-match", None)]


def test_type_only_rule_and_ambiguity(spark):
    assert statuses(spark, [rule("t", types=["report.public"])], ["not a url"]) == [("resolved", "t")]
    assert statuses(spark, [rule("a", ["x.com"]), rule("b", ["x.com"], priority=0)], ["https://x.com/"]) == [("ambiguous-match", None)]
    assert statuses(spark, [rule("a", ["x.com"]), rule("b", ["x.com"], priority=1)], ["https://x.com/"]) == [("resolved", "b")]


def test_redaction_and_registry(spark):
    rules = small_table(spark, [rule("open", ["a.com"]), rule("shut", ["b.com"], ok=False), rule("bare")], R.RULE_COLUMNS)
    ev = spark.createDataFrame([(h, f"https://{h}/", "report.media", "secret", "r") for h in ("a.com", "b.com", "c.com")],
                               "evidence_id string, source_url string, type string, text string, render string")
    got = {r.evidence_id: (r.text, r.render) for r in R.redact(ev, rules).collect()}
    assert got["a.com"] == ("secret", "r") and got["b.com"] == got["c.com"] == (R.REDACTED_TEXT, None)
    idx = R.attribution_index(ev, rules)
    assert {r.attribution for r in idx.collect()} == {"From https://a.com/", "From https://b.com/"}
    assert {r.id: r.evidence_count for r in R.attribution_counts(idx, rules).collect()} == {"open": 1, "shut": 1, "bare": 0}
    rights = spark.createDataFrame([("c",), ("c",)], "id string")
    assert {(r.rule, r.id) for r in R.registry_errors(rights, rules).collect()} == {
        ("duplicate rights id", "c"), ("unknown rights id", "open"), ("unknown rights id", "shut"), ("unknown rights id", "bare"), ("no match criterion", "bare")}


def test_overlap_join_equals_brute_force(spark):
    rng = random.Random(4)
    left = [(i, s := rng.randrange(10_000), rng.choice([None, s + rng.choice([0, 1, 50, 3000]), s - 5])) for i in range(150)]
    wins = [(j, a := rng.randrange(10_000), a + rng.choice([0, 10, 700, 6000])) for j in range(30)]
    want = {(i, j) for i, s, e in left for j, a, b in wins if (e is None or e >= s) and s <= b and (e is None or e >= a)}
    l, w = spark.createDataFrame(left, "i long, s long, e long"), spark.createDataFrame(wins, "j long, a long, b long")
    pairs = S.overlap_join(l, w, ("s", "e"), ("a", "b"), base_us=64).select("i", "j").collect()
    assert len(pairs) == len(set(pairs)) and {tuple(p) for p in pairs} == want
    assert S.overlap_join(l, w.filter("j < 0"), ("s", "e"), ("a", "b")).count() == 0
    plan = S.overlap_join(l, w, ("s", "e"), ("a", "b"))._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_issue_search(spark):
    issues = spark.createDataFrame([("2024-01-10-a",), ("2024-02-01-b",), ("2024-03-01-c",), ("2024-04-01-d",)], "issue_id string")
    evidence = spark.createDataFrame([("2024-02-01-b", ts("2024-01-10 12:00"))] * 4, "issue_id string, ts timestamp")
    periods = spark.createDataFrame([
        ("2024-03-01-c", recurring("2024-01-01 00:00", "2024-01-31 00:00", "weekly", ["WE"])),  # 10 January 2024 is a Wednesday
        ("2024-04-01-d", recurring("2024-01-01 00:00", "2024-01-31 00:00", "weekly", ["TH"])), ("2024-04-01-d", fixed("2024-01-11 00:00", None))], f"issue_id string, period {PERIOD}")
    win = spark.createDataFrame([(1, "2024-01-10", "2024-01-10")], "window_id int, a string, b string").select(
        "window_id", S.search_bound("a", "start").alias("start_at"), S.search_bound("b", "end").alias("end_at"))
    got = {r.issue_id: (r.score, r.reasons) for r in S.issues_in_window(issues, evidence, periods, win).collect()}
    assert got == {"2024-01-10-a": (5, ["issue date"]), "2024-02-01-b": (9, ["evidence timestamp"]), "2024-03-01-c": (1, ["active period"])}
    assert S.issues_in_window(issues, evidence, periods, win, k=1).first().issue_id == "2024-02-01-b"


def test_fuzzy(spark):
    df = spark.createDataFrame([("NSL", "North South Line"), ("EWL", "East West Line"), ("X", None)], "id string, name string")
    assert [r.id for r in S.fuzzy_search(df, ["id", "name"], ["nrth south line"], 0.3).collect()] == ["NSL"]
    assert {r.id for r in S.fuzzy_search(df, ["id", "name"], ["line", "ewl"], 0.2).collect()} == {"NSL", "EWL"}


def test_text_functions(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(X.slug(F.lit("  Café -- Ünï  Line! "))) == "cafe-uni-line"
    assert one(X.slug(F.lit("漢字"))) is None
    assert one(X.truncate(F.lit("abcdefgh"), 6)) == "abc..." and one(X.truncate(F.lit("abc"), 6)) == "abc"
    assert one(X.issue_id_valid(F.lit("2024-02-30-x"))) is False and one(X.issue_path(F.lit("2024-02-03-x"))) == "issue/2024/02/2024-02-03-x"
    labels = spark.createDataFrame([("Exit 10",), ("exit 2",), ("Exit 2A",), ("Exit B",)], "l string")
    long = spark.createDataFrame([(f"Exit {n}",) for n in (10**24 + 1, 2, 10**24, 10**18, 9)], "l string")
    assert [r.l for r in long.orderBy(X.natural_key("l")).collect()] == [f"Exit {n}" for n in (2, 9, 10**18, 10**24, 10**24 + 1)]
    assert [r.l for r in labels.orderBy(X.natural_key("l")).collect()] == ["exit 2", "Exit 2A", "Exit 10", "Exit B"]


@pytest.mark.parametrize("actual,expected,ok", [
    ({"a": 1, "b": [1, {"c": 2}]}, {"b": [{"c": 2}]}, True), ({"a": 1}, {"a": 2}, False), ({"a": None}, {"a": None}, True),
    ({}, {"a": None}, False), ({"a": True}, {"a": 1}, False), ({"a": 1.0}, {"a": 1}, True), ([1, 2], [2, 2], True), ({"a": [1]}, {"a": 1}, False)])
def test_partial_match(actual, expected, ok):
    assert V.partial_match(actual, expected) is ok


def test_usage_cost(spark):
    usage = spark.createDataFrame([("g", "m", 1_000_000, 400_000, 100_000, 1_100_000), ("g", "m", -5, None, -1, 0), ("h", "m", 1, 0, 0, 1), ("h", "q", 1, 0, 0, 1)],
                                  "g string, model string, input_tokens long, cached_tokens long, output_tokens long, total_tokens long")
    pricing = small_table(spark, [("m", 2.5, 0.25, 15.0)], "model string, input_usd double, cached_usd double, output_usd double")
    got = {r.g: r for r in V.usage_cost(usage, pricing, ["g"]).collect()}
    assert got["g"].cost_usd == pytest.approx(0.6 * 2.5 + 0.4 * 0.25 + 0.1 * 15) and got["g"].models_without_pricing == []
    assert got["h"].cost_usd is None and got["h"].models_without_pricing == ["q"]


def test_digests_are_exact_and_zone_independent(spark, tmp_path):
    rows = [f"select {n} as n, timestamp'2024-01-01 08:00:00.00000{n}' as t, named_struct('x', timestamp'2024-01-01 08:00:00', 'd', date'2024-01-01') as r" for n in (1, 2)]
    path = str(tmp_path / "t")
    spark.sql(" union all ".join(rows)).write.parquet(path)
    digests = lambda: [r[0] for r in spark.read.parquet(path).orderBy("n").select(X.digest("t", "r")).collect()]
    first, zone = digests(), spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Singapore")
        assert digests() == first and len(set(first)) == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    from faultline.operators.diff import dedup_semantic
    assert dedup_semantic(spark.read.parquet(path), ["t", "r"], "n").count() == 2
