import json
import os
import random

import pytest
from pyspark.sql import functions as F

from faultline import schemas as S
from faultline.operators.diff import changed
from faultline.operators.rights import RULE_COLUMNS
from faultline.plans import ingest as I
from faultline.session import small_table
from faultline.sources import features, readers, writers
from faultline.streaming.ingest import checked_items, ingest_stream, write_stream
from faultline.streaming.state import compact_state, read_state, streaming_state, write_state
from tests.helpers import claim, fixed, local, start_only, svc


def put(path, value):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(value if isinstance(value, str) else json.dumps(value, indent=1))


@pytest.fixture
def root(tmp_path):
    r = str(tmp_path)
    name = {"en-SG": "Alpha", "zh-Hans": None, "ms": None, "ta": None}
    put(f"{r}/town/t1.json", {"id": "t1", "name": name})
    put(f"{r}/town/t2.json", "{broken")
    base = f"{r}/issue/2024/01/2024-01-05-x"
    put(f"{base}/issue.json", {"id": "2024-01-05-x", "type": "disruption", "title": name, "titleMeta": {"source": "m"}})
    ev = {"id": "ev_1", "ts": "2024-01-05T08:00:00+08:00", "type": "report.public", "text": "t", "sourceUrl": "https://a.com/", "render": None}
    put(f"{base}/evidence.ndjson", json.dumps(ev) + "\n\n" + json.dumps({**ev, "id": "ev_2"}) + "\nnot json\n")
    event = {"id": "ie_1", "type": "periods.set", "ts": "2024-01-05T08:00:00+08:00", "entity": {"type": "service", "serviceId": "A"}, "basis": {"evidenceId": "ev_1"},
             "periods": [{"kind": "fixed", "startAt": "2024-01-05T08:00:00+08:00", "endAt": None}]}
    put(f"{base}/impact.ndjson", json.dumps(event) + "\n")
    put(f"{r}/issue/2024/02/2024-02-01-y/issue.json", {"id": "2024-02-01-z", "type": "infra", "title": name, "titleMeta": {"source": "m"}})
    return r


def test_entities_and_bundles(spark, root):
    towns = readers.read_entities(spark, root, "town")
    assert {r.id for r in towns.filter("_corrupt_record is null").collect()} == {"t1"} and towns.count() == 2
    b = readers.read_issue_bundles(spark, root, strict=True)
    assert [(r.evidence_id, r.line_no) for r in b["evidence"].orderBy("line_no").collect()] == [("ev_1", 1), ("ev_2", 3)]
    e = b["impact"].first()
    assert (e.issue_id, e.seq, e.entity.service_id, local(e.periods[0].start_at), e.year) == ("2024-01-05-x", 1, "A", "2024-01-05 08:00", "2024")
    faults = {(r.rule, r.location) for r in b["errors"].collect()}
    assert faults == {("folder id", ""), ("bad line", "4"), ("missing log", "")}
    assert [r.issue_id for r in readers.list_bundles(b["issue"]).collect()] == ["2024-01-05-x", "2024-02-01-z"]
    assert readers.lookup(towns, ["t1"]).count() == 1 and readers.lookup(towns, towns.select("id").filter("id = 't1'")).count() == 1


def test_line_numbers_survive_splitting(spark, tmp_path):
    path = str(tmp_path / "big.ndjson")
    with open(path, "w") as f:
        f.writelines(json.dumps({"n": i}) + "\n" for i in range(1, 5001))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = readers.read_ndjson(spark, path, "n long")
        assert spark.read.text(path).rdd.getNumPartitions() > 2
        assert rows.filter("record.n <> line_no").isEmpty() and rows.count() == 5000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_entity_writes(spark, tmp_path):
    target = str(tmp_path / "town")
    df = lambda *rows: spark.createDataFrame(list(rows), "id string, v int")
    writers.write_entities(df(("a", 1), ("b", 1)), target)
    with pytest.raises(writers.ExistingIds):
        writers.write_entities(df(("c", 1), ("b", 2)), target)
    with pytest.raises(ValueError):
        writers.write_entities(df(("../x", 1)), target)
    writers.write_entities(df(("b", 5), ("d", 5)), target, "upsert")
    assert {(r.id, r.v) for r in spark.read.parquet(target).collect()} == {("a", 1), ("b", 5), ("d", 5)}


def test_batches_are_visible_by_marker_and_idempotent(spark, tmp_path):
    target = str(tmp_path / "log")
    ev = spark.createDataFrame([("i", "e1")], "issue_id string, evidence_id string")
    im = spark.createDataFrame([("i", 1)], "issue_id string, seq long")
    for _ in range(2):
        writers.append_batch(ev, im, target, 1)
    ev.withColumn("batch_id", F.lit("2")).write.partitionBy("batch_id").mode("append").parquet(f"{target}/evidence")  # no marker
    assert writers.read_batches(spark, target, "evidence").count() == 1
    writers.append_batch(ev, im, target, 2)
    assert writers.read_batches(spark, target, "evidence").count() == 2


def test_bucket_count_stays_with_the_table(spark, tmp_path):
    target = str(tmp_path / "town")
    df = lambda *rows: spark.createDataFrame(list(rows), "id string, v int")
    writers.write_entities(df(*[(f"a{i}", 1) for i in range(20)]), target, buckets=4)
    writers.write_entities(df(("a3", 2), ("b", 2)), target, "upsert", buckets=7)
    rows = {r.id: (r.v, r.bucket) for r in spark.read.parquet(target).collect()}
    assert len(rows) == 21 and rows["a3"][0] == 2 and {b for _, b in rows.values()} <= set(range(4))


def test_public_export(spark, root, tmp_path):
    b = readers.read_issue_bundles(spark, root)
    towns = readers.read_entities(spark, root, "town").filter("_corrupt_record is null").drop("_corrupt_record")
    rules = small_table(spark, [("r", "r", ["b.com"], None, None, None, None, "x", "c", "o", "p", "t", True)], RULE_COLUMNS)
    out = str(tmp_path / "pub")
    first = writers.export_public({"town": towns}, b["issue"], b["evidence"], b["impact"], rules, out)
    assert {r.collection for r in first.collect()} == {"town", "issues", "rights"}
    assert {r.text for r in spark.read.parquet(f"{out}/evidence").collect()} == {"Non-public evidence text redacted from generated public export."}
    rules_open = rules.withColumn("hosts", F.array(F.lit("a.com")))
    second = writers.export_public({"town": towns}, b["issue"], b["evidence"], b["impact"], rules_open, out + "2")
    assert sorted((r.id, r.status) for r in changed(first, second).collect()) == [("2024-01-05-x", "changed"), ("source_registry", "changed")]


def test_hidden_issues_leave_every_table(spark, tmp_path):
    rules = small_table(spark, [("r", "r", ["a.com"], None, None, None, None, "x", "c", "o", "p", "t", True)], RULE_COLUMNS)
    issue = spark.createDataFrame([("i1", "source/i1"), ("i2", "resource/i2"), ("i3", "open/source/i3")], "issue_id string, path string")
    logs = [(i, n, "report.public", "t", "https://a.com/") for i in ("i1", "i2", "i3") for n in (1, 2)]
    evidence = spark.createDataFrame(logs, "issue_id string, line_no long, type string, text string, source_url string").withColumn("evidence_id", F.concat("issue_id", "line_no"))
    impact = evidence.select("issue_id", F.col("line_no").alias("seq"))
    out = str(tmp_path / "pub")
    none = lambda tables: spark.createDataFrame([], "rule string, path string, location string, message string")
    writers.export_public({}, issue, evidence, impact, rules, out, ["source"], check=none)
    for name in ("issue", "evidence", "impact"):
        assert {r.issue_id for r in spark.read.parquet(f"{out}/{name}").collect()} == {"i2", "i3"}
    assert {(r.issue_id, r.redacted) for r in spark.read.parquet(f"{out}/redactions").collect()} == {("i2", 0), ("i3", 0)}
    bad = lambda tables: spark.createDataFrame([("r", "p", "", "wrong")], "rule string, path string, location string, message string")
    with pytest.raises(ValueError, match="wrong"):
        writers.export_public({}, issue, evidence, impact, rules, out + "2", check=bad)
    assert not writers.exists(spark, out + "2")


def test_empty_logs_are_present(spark, tmp_path):
    base = f"{tmp_path}/issue/2024/01/2024-01-05-x"
    put(f"{base}/issue.json", {"id": "2024-01-05-x", "type": "infra", "title": {"en-SG": "A"}, "titleMeta": {"source": "m"}})
    put(f"{base}/evidence.ndjson", "")
    put(f"{base}/impact.ndjson", "\n")
    assert readers.read_issue_bundles(spark, str(tmp_path), strict=True)["errors"].count() == 0


def test_feature_import(spark):
    rows = [("Point", [103.8, 1.3], n, e, i, c, "20240102030405") for n, e, i, c in [
        ("ns1", "Exit 10", 1, "0" * 16), ("Beta MRT Station", "exit 2", 2, "0" * 16), ("Nowhere", "Exit A", 3, "0" * 16), ("Beta LRT STATION", "Exit ", 4, "0" * 16), ("NS1", "A", 1, "0" * 16)]]
    df = spark.createDataFrame(rows, "geometry string, coordinates array<double>, station_name string, exit_code string, object_id long, checksum string, updated string")
    stations = spark.createDataFrame([("a", ("Alpha",), [("NS1",)]), ("b", ("Beta",), [("NS2",)])], "id string, name struct<`en-SG`:string>, stationCodes array<struct<code:string>>")
    out = features.import_point_features(df, stations)
    assert [(r.station_id, r.label) for r in out["matched"].orderBy("station_id", "position").collect()] == [("a", "10"), ("a", "A"), ("b", "2")]
    assert [r.station_name for r in out["unmatched"].collect()] == ["Nowhere"] and out["invalid"].count() == 1 and out["duplicate"].count() == 1


def crowd(**over):
    base = {"source": "crowd-report", "reportId": "r1", "text": "stuck", "createdAt": "2024-01-01T08:00:00+08:00", "observedAt": "2024-01-01T07:50:00+08:00",
            "lineIds": ["L"], "reportCount": 2, "url": "https://a.com/r1"}
    return {**base, **over}


TWEET = {"source": "twitter", "accountName": "a", "text": "delay", "url": "https://t.com/1", "createdAt": "2024-01-01T00:00:00Z"}


def test_contract_and_streaming_ingest(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    put(f"{src}/a.json", json.dumps({"content": [TWEET, crowd(), crowd(text="again"), crowd(reportId="r2", extra=1)]}) + "\n")
    put(f"{src}/b.json", json.dumps({"content": [TWEET, crowd(reportId="r3", lineIds=[], stationIds=None), crowd(reportId="r4", observedAt="2024-01-01T09:00:00+08:00")]}) + "\n")
    batch = I.check_contract(readers.read_ingest(spark, src))
    assert sorted(len(r.breaches) for r in batch.collect()) == [0, 0, 0, 0, 1, 1, 1]
    good, dead = checked_items(readers.read_ingest(spark, src, streaming=True))
    for q in write_stream(good, dead, out, str(tmp_path / "cp")):
        q.awaitTermination()
    assert sorted(r.delivery_key for r in spark.read.parquet(f"{out}/items").collect()) == ["report:r1", "url:https://t.com/1"]
    assert spark.read.json(f"{out}/dead").count() == 3


def test_stream_state_equals_batch_whatever_the_arrival(spark, tmp_path):
    src = str(tmp_path / "log")
    rows = [("u", "a", 3, "late"), ("u", "a", 1, "old"), ("u", "b", 2, "x"), ("v", "a", 5, "y")]
    for i, part in enumerate((rows[:1], rows[1:])):
        spark.createDataFrame(part, "k string, attr string, seq long, v string").coalesce(1).write.mode("append").parquet(f"{src}/{i}")
    schema = "k string, attr string, seq long, v string"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{src}/*")
    write_state(streaming_state(stream, ["k"], "attr", "seq", ["v"]), f"{tmp_path}/st", f"{tmp_path}/cp", ["k"], "attr", "seq").awaitTermination()
    got = {tuple(r) for r in read_state(spark, f"{tmp_path}/st", ["k"], "attr", "seq", ["v"]).collect()}
    assert got == {("u", "a", 3, "late"), ("u", "b", 2, "x"), ("v", "a", 5, "y")}


def test_compacted_state_equals_batch_and_drops_old_batches(spark, tmp_path):
    src, st, how = str(tmp_path / "log"), str(tmp_path / "st"), (["k"], "attr", "seq", ["v"])
    schema = "k string, attr string, seq long, v string"
    rng = random.Random(4)
    rows = [(rng.choice("uvw"), rng.choice("ab"), i, rng.choice([None, "x", "y"])) for i in rng.sample(range(90), 90)]
    want = {}
    for k, a, i, v in rows:
        if i >= want.get((k, a), (-1,))[0]:
            want[k, a] = (i, v)
    for n in range(9):
        spark.createDataFrame(rows[n * 10:n * 10 + 10], schema).coalesce(1).write.parquet(f"{src}/{n}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{src}/*")
    write_state(streaming_state(stream, *how), st, f"{tmp_path}/cp", *how[:3], every=2).awaitTermination()
    state = lambda: {(r.k, r.attr): (r.seq, r.v) for r in read_state(spark, st, *how).collect()}
    assert state() == want
    assert sorted(os.listdir(f"{st}/snapshots")) == ["upto=5", "upto=7"]
    assert sorted(f for f in os.listdir(f"{st}/deltas") if f.startswith("batch")) == ["batch_id=6", "batch_id=7", "batch_id=8"]
    os.remove(f"{st}/snapshots/upto=7/_SUCCESS")  # a compaction that did not finish is not read, and is done again
    assert state() == want
    compact_state(spark, st, *how, 7)
    compact_state(spark, st, *how, 7)
    assert state() == want and sorted(os.listdir(f"{st}/snapshots")) == ["upto=5", "upto=7"]


def test_ingest_batch(spark):
    raw = [("1", TWEET), ("2", {**TWEET, "url": "https://t.com/2", "createdAt": "2024-01-01T01:00:00Z"}), ("3", {**TWEET, "url": "https://t.com/3"}), ("4", {**TWEET, "url": "https://t.com/4"})]
    items = spark.createDataFrame([(i, json.dumps(c)) for i, c in raw], "item_id string, raw string").withColumn("c", F.from_json("raw", S.INGEST_CONTENT)).select("item_id", "raw", "c.*")
    decisions = spark.createDataFrame([("1", "part-of-new-issue", None, "disruption", "Line A: Delay"), ("2", "part-of-existing-issue", "2024-01-01-line-a-delay", None, None),
                                       ("3", "irrelevant-content", None, None, None), ("4", "part-of-new-issue", None, "infra", "No claims")],
                                      "item_id string, kind string, issue_id string, issue_type string, title string")
    rows = [("1", *claim("", "2024-01-01 08:00", svc("A"), service=("delay", None), hint=start_only("2024-01-01 08:00"))),
            ("2", *claim("", "2024-01-01 09:00", svc("A"), service=("no-service", None), hint=fixed("2024-01-01 09:00")))]
    claims = spark.createDataFrame(rows, "item_id string, " + S.CLAIM_COLUMNS)
    out = I.ingest(items, decisions, claims)
    assert [(r.issue_id, r.type) for r in out["issue"].collect()] == [("2024-01-01-line-a-delay", "disruption")]
    ev = out["evidence"].orderBy("ts").collect()
    assert [r.ts for r in ev] == ["2024-01-01T08:00:00.000+08:00", "2024-01-01T09:00:00.000+08:00"]
    assert [(r.seq, r.type) for r in out["impact"].orderBy("seq").collect()] == [(1, "service_effects.set"), (2, "periods.set"), (3, "service_effects.set")]
    assert out["rejected"].count() == 0


def test_ingest_stream_killed_and_started_again_equals_one_batch(spark, tmp_path):
    src, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    hours = [{**TWEET, "url": f"https://t.com/{h}", "createdAt": f"2024-01-01T0{h}:00:00Z"} for h in range(4)]
    for n, item in enumerate(hours):
        put(f"{src}/{n}.json", json.dumps({"content": [item]}) + "\n")
        os.utime(f"{src}/{n}.json", (1000 + n, 1000 + n))  # arrival in order of time
    key = lambda h: f"url:https://t.com/{h}"
    issue = "2024-01-01-line-a-delay"
    decisions = spark.createDataFrame(
        [(key(0), "part-of-new-issue", None, "disruption", "Line A: Delay"), (key(1), "part-of-existing-issue", issue, None, None),
         (key(2), "part-of-new-issue", None, "infra", "Line A: Delay"), (key(3), "part-of-existing-issue", issue, None, None)],
        "item_id string, kind string, issue_id string, issue_type string, title string")
    claims = spark.createDataFrame(
        [(key(0), *claim("", "2024-01-01 08:00", svc("A"), service=("delay", None), hint=start_only("2024-01-01 08:00"))),
         (key(1), *claim("", "2024-01-01 09:00", svc("A"), service=("no-service", None))),
         (key(2), *claim("", "2024-01-01 10:00", svc("A"), service=("no-service", None), hint=fixed("2024-01-01 10:00", "2024-01-01 11:00"))),
         (key(3), *claim("", "2024-01-01 11:00", svc("B"), service=("delay", None)))], "item_id string, " + S.CLAIM_COLUMNS)
    items = readers.read_ingest(spark, src).withColumn("item_id", F.concat(F.lit("url:"), "url"))
    whole = I.ingest(items, decisions, claims)
    rows = lambda df, *cols: sorted(df.select(*[F.to_json(F.struct(*cols))]).collect())
    seen = []

    def decide(batch, fail=False):
        ids = {r.item_id for r in batch.select("item_id").collect()}
        seen.append(ids)
        if fail and key(2) in ids:
            raise RuntimeError("killed")
        return tuple(df.join(batch.select("item_id"), "item_id", "left_semi") for df in (decisions, claims))

    def run(fail=False):
        stream = readers.read_ingest(spark, src, streaming=True, per_batch=1)
        return ingest_stream(checked_items(stream)[0], lambda batch: decide(batch, fail), out, cp).awaitTermination()

    with pytest.raises(Exception, match="killed"):
        run(fail=True)
    assert writers.read_batches(spark, out, "evidence").count() == 2
    # what a batch broken off leaves: tables without a marker
    whole["evidence"].withColumn("issue_bucket", F.lit(1)).write.partitionBy("issue_bucket").parquet(f"{out}/evidence/batch_id=2")
    run()
    times = len(seen)
    last = max(int(f) for f in os.listdir(f"{cp}/commits") if f.isdigit())
    for name in (f"{last}", f".{last}.crc"):  # killed between marker and commit: the batch comes again
        os.remove(f"{cp}/commits/{name}")
    run()
    assert len(seen) == times and sorted(map(len, seen[:4])) == [1, 1, 1, 1]
    got = {name: writers.read_batches(spark, out, name) for name in ("issue", "evidence", "impact")}
    assert rows(got["issue"], "issue_id", "type", "title") == rows(whole["issue"], "issue_id", "type", "title") and got["issue"].count() == 1
    assert rows(got["evidence"], *whole["evidence"].columns) == rows(whole["evidence"], *whole["evidence"].columns)
    own = [c for c in whole["impact"].columns if c != "ev_seq"]  # ev_seq counts the evidence of a batch
    assert rows(got["impact"], *own) == rows(whole["impact"], *own) and got["impact"].count() == 3


def test_ingest_rejects_what_it_cannot_place(spark):
    raw = [(str(i), {**TWEET, "url": f"https://t.com/{i}"}) for i in range(1, 5)]
    items = spark.createDataFrame([(i, json.dumps(c)) for i, c in raw], "item_id string, raw string").withColumn("c", F.from_json("raw", S.INGEST_CONTENT)).select("item_id", "raw", "c.*")
    decisions = spark.createDataFrame([("1", "part-of-new-issue", None, "disruption", "!!"), ("2", "part-of-existing-issue", None, None, None), ("3", "unsure", None, None, None)],
                                      "item_id string, kind string, issue_id string, issue_type string, title string")
    claims = spark.createDataFrame([("1", *claim("", "2024-01-01 08:00", svc("A"), service=("delay", None)))], "item_id string, " + S.CLAIM_COLUMNS)
    got = {r.item_id: r.reason for r in I.ingest(items, decisions, claims)["rejected"].collect()}
    assert got == {"1": "invalid issue id", "2": "no issue id", "3": "no known decision", "4": "no known decision"}


def test_evidence_text(spark):
    rows = [{"source": "reddit", "title": " T ", "selftext": "", "url": "u", "createdAt": "2024-01-01T00:00:00Z"}, crowd(delayMinutes=5, stationIds=["S1", "S2"])]
    items = spark.createDataFrame([(json.dumps(r),) for r in rows], "raw string").withColumn("c", F.from_json("raw", S.INGEST_CONTENT)).select("raw", "c.*")
    got = [r.x for r in items.select(I.content_text().alias("x")).collect()]
    assert got == ["Title: T", "Report: stuck\n\nObserved at: 2024-01-01T07:50:00+08:00\n\nAccepted at: 2024-01-01T08:00:00+08:00\n\nLines: L\n\nStations: S1, S2\n\nDelay minutes: 5\n\nReport count: 2"]
