import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from faultline.operators import ordered as O


@pytest.fixture(scope="module")
def log(spark):
    rng = random.Random(7)
    rows = [(rng.choice(["hot"] * 8 + ["a", "b", None]), i, rng.choice([None, *range(20)])) for i in range(400)]
    return spark.createDataFrame(rows, "k string, o long, v long").cache()


def plain(log, expr):
    return sorted(map(tuple, log.withColumn("x", expr).select("o", "x").collect()))


def result(df):
    return sorted(map(tuple, df.select("o", "x").collect()))


@pytest.mark.parametrize("hot_rows", [30, None, 10_000])
def test_ordered_functions_equal_plain_windows(log, hot_rows):
    w = W.partitionBy("k").orderBy("o")
    rows = O.cut(log, ["k"], "o", hot_rows).cache()
    if hot_rows == 30:
        assert rows.filter(O.HOT).select("k").distinct().count() >= 1
        assert rows.filter("k = 'hot'").select(O.CHUNK).distinct().count() > 10
    before = w.rowsBetween(W.unboundedPreceding, -1)
    upto = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    assert result(O.previous(rows, ["k"], ["o"], "v", "x")) == plain(log, F.lag("v").over(w))
    assert result(O.following(rows, ["k"], ["o"], "v", "x")) == plain(log, F.lead("v").over(w))
    assert result(O.rank(rows, ["k"], ["o"], "x")) == plain(log, F.row_number().over(w))
    assert result(O.running_max_before(rows, ["k"], ["o"], "v", "x")) == plain(log, F.max("v").over(before))
    filled = rows.fillna({"v": 1})
    assert result(O.running_sum(filled, ["k"], ["o"], "v", "x")) == plain(log.fillna({"v": 1}), F.sum("v").over(upto))
    assert result(O.running_last(rows, ["k"], ["o"], "v", "x")) == plain(log, F.last("v", True).over(upto))


def test_rows_tied_on_order_share_a_chunk(spark):
    rows = spark.createDataFrame([("h", i // 10) for i in range(200)], "k string, o long")
    cut = O.cut(rows, ["k"], "o", 20)
    assert cut.groupBy("o").agg(F.count_distinct(O.CHUNK).alias("n")).filter("n > 1").isEmpty()


def test_hot_detection_reads_no_result_rows(log):
    assert O.find_cuts(log, ["k"], "o", 10_000) is None


def test_text_and_struct_orders(spark):
    rng = random.Random(3)
    names = ["", "a", "b\u00e9", "abcdefg", "abcdefh", "Z", None]
    rows = [("h", rng.choice(names), rng.randrange(1000), i) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, t string, n long, i long").withColumn("s", F.struct("n", "i"))
    for order in (["t", "i"], ["s"]):
        cut = O.cut(df, ["k"], order[0], 20)
        got = sorted((r["i"], r["x"]) for r in O.rank(cut, ["k"], order, "x").collect())
        want = df.withColumn("x", F.row_number().over(W.partitionBy("k").orderBy(*order)))
        assert got == sorted((r["i"], r["x"]) for r in want.collect())
        assert cut.select(O.CHUNK).distinct().count() > 2
