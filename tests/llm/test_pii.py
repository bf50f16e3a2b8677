import re

import pytest
from pyspark.sql import functions as F

from faultline.llm import pii
from tests.llm.helpers import documents, empty

# The kinds' expressions as given.
GIVEN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "card":
        total = sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(digits)))
        return 16 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def brute(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in GIVEN.items() for m in re.finditer(p, text or "") if valid(k, m[0])]


HARD = [
    "a@b.c_d@e.f @x.y 1.2.3.4.5.6.7.8 ", None, "", "x" * 20 + "@", "+1 (2((((", "4111 1111 1111 1111-x 4111-1111-1111-1111 0001.002.255.0256 00000255.1.1.1",
    "é🙂 a.b@c.d.e- +44 20 7946 0958. +1.2.3.4.5678.90", "1" * 5000 + "." + "2" * 10, "a" * 50000 + "@b", "1-" * 9000, "mail@x.com,mail@y.org;z@@q.r",
    "4111111111111111 " * 700, "user@host.org " * 700,
]


def test_base_spans_are_those_of_the_expressions(spark):
    got = pii.find(documents(spark, list(enumerate(HARD)))).select("doc_id", pii.listed(F.col("base")).alias("base"), "n_card").collect()
    assert len(got) == len(HARD)
    for row in got:
        assert row["base"] == ",".join(brute(HARD[row["doc_id"]]))


def test_contexts_find_identifiers_no_kind_covers(spark):
    known = [f"please write to my address user{i}@mail{i}.example.org if lost" for i in range(12)]
    new = ["please write to my address agent-00412 if lost", "the bridge has 1200345 bolts", "model 2024-abc of the line"]
    rows = list(enumerate(known + new + [new[0]]))
    got = {r["doc_id"]: r["added"] for r in pii.find(documents(spark, rows)).select("doc_id", "added").collect()}
    text = new[0]
    span = ("id", text.index("agent"), text.index("agent") + len("agent-00412"))
    assert [tuple(s) for s in got[12]] == [span] and got[12] == got[15]
    assert all(not got[i] for i in [*range(12), 13, 14])


def test_contexts_grow_and_have_no_limits_of_length(spark):
    first = [f"please write to my address {x} if lost" for x in [f"user{i}@mail{i}.example.org" for i in range(30)] + [f"agent-{i}41" for i in range(6)]]
    second = [f"hand this over to {x} before noon" for x in [f"agent-{i}41" for i in range(6)] + ["porter-777"]]
    far = ["please write to my address" + " " * 70 + "agent-00412 if lost", "please write to my address " + "a" * 30 + "-00412 if lost", "please write to my address x7 if lost"]
    got = {r["doc_id"]: r["added"] for r in pii.find(documents(spark, list(enumerate(first + second + far)))).select("doc_id", "added").collect()}
    assert all(len(got[i]) == 1 for i in range(30, 36 + len(second) + len(far)))


def test_scores_follow_the_rule(spark):
    edges = [("p", f"s{i}", True) for i in range(4)] + [("p", "x", False), ("q", "x", False), ("q", "y", False)]
    got = {r[0]: r[1] for r in pii.score_instances(spark.createDataFrame(edges, "pattern string, instance string, seed boolean"), 4).collect()}

    sure = {}
    for _ in range(4):
        p = (4 + sure.get("x", 0.0)) / 5 * 4 / 5
        sure = {"x": p if p >= pii.PATTERN_SURE else 0.0}
    assert got == ({"x": pytest.approx(sure["x"])} if sure["x"] >= pii.INSTANCE_SURE else {})


def test_redaction_keeps_rows_and_columns(spark):
    docs = documents(spark, [*enumerate(HARD), (0, HARD[0]), (None, "call +44 20 7946 0958 now"), (77, "plain")])
    out = pii.redact(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    text = {r["doc_id"]: r["text"] for r in out.filter("source <> 's13'").collect()}
    assert text[77] == "plain" and text[1] is None and text[None] == "call [PHONE] now"
    assert text[5].startswith("[CARD]-x ") and text[10] == "[EMAIL],[EMAIL];z@@q.r"
    assert pii.redact(empty(spark)).count() == 0 and pii.find(empty(spark)).count() == 0
