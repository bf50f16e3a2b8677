import time

from pyspark.sql import functions as F

from faultline.operators import diff
from faultline.operators import network as N
from faultline.operators.graph import contract


def test_long_chains_and_hubs_need_few_rounds(spark):
    edges = [(0, k) for k in range(1, 200)] + [(k, k + 1) for k in range(1000, 11000)] + [(7, 7)]
    start = time.time()
    got = contract(spark.createDataFrame(edges, "a long, b long"), rounds=20)
    assert {(r["root"], r["count"]) for r in got.groupBy("root").count().collect()} == {(0, 200), (1000, 10001)}
    assert time.time() - start < 240


def test_components_of_several_lines(spark):
    rows = [("x", "c", "b"), ("x", "b", "c"), ("x", "d", None), ("y", "c", "a"), ("y", "a", "c"), (None, "p", "q"), (None, "q", "p")]
    near = spark.createDataFrame(rows, "line string, node string, neighbour string")
    got = {tuple(r) for r in N.components(near.filter("line is not null"), ["line"]).collect()}
    assert got == {("x", "b", "b"), ("x", "c", "b"), ("x", "d", "d"), ("y", "a", "a"), ("y", "c", "a")}
    assert N.components(near.filter("false"), ["line"]).collect() == []


def test_repeated_lines_change_a_bundle(spark):
    issue = spark.createDataFrame([("i", "t")], "issue_id string, title string")
    event = spark.createDataFrame([("i", 1, "e")], "issue_id string, seq long, type string")

    def made(texts):
        lines = spark.createDataFrame([("i", 1, x) for x in texts], "issue_id string, line_no long, text string")
        return diff.fingerprint_bundle(issue, lines, event, ["title"], ["text"], ["type"]).first()["sha256"]

    kinds = [("a", "a"), ("b", "b"), ("a",), ("a", "b"), ("a", "a", "a")]
    assert len({made(k) for k in kinds}) == len(kinds)
    assert made(("a", "b")) == made(("b", "a"))


def test_rights_have_digests(spark):
    rules = spark.createDataFrame([("r1", 1), ("r2", 2)], "rule_id string, priority int")
    got = {r["id"]: r["sha256"] for r in diff.fingerprint_rights(rules, "text").collect()}
    assert set(got) == {"licence_data", "source_registry"}
    assert got["source_registry"] == {r["id"]: r["sha256"] for r in diff.fingerprint_rights(rules.orderBy(F.desc("rule_id")), "").collect()}["source_registry"]
    assert diff.fingerprint_rights(rules.filter("false"), "").count() == 2
