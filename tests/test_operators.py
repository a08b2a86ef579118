"""Joins and roll-ups."""

from helpers import by, rows
from pyspark.sql import functions as F

from fieldtally.operators import joins as J
from fieldtally.operators import rollup as R


def test_case_roster_join_keeps_unmatched_cases(spark):
    cases = spark.createDataFrame(
        [("i1", "A"), ("i2", None), ("i3", "B")], "interview__id string, team string"
    )
    roster = spark.createDataFrame(
        [("i1", 1), ("i1", 2), ("i3", None), ("x", 9), (None, 8)],
        "interview__id string, v int",
    )
    got = J.case_roster_join(cases, roster)
    assert got.columns == ["interview__id", "team", "v"]
    expected = cases.join(roster, "interview__id", "left")
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
    assert got.filter("interview__id = 'i2'").count() == 1


def test_null_safe_left_join(spark):
    left = spark.createDataFrame([("A", 1), (None, 2), ("B", 3)], "g string, x int")
    right = spark.createDataFrame([("A", 10), (None, 20)], "g string, y int")
    got = by(J.null_safe_left_join(left, right, "g"), "g")
    assert {k: v["y"] for k, v in got.items()} == {"A": 10, None: 20, "B": None}
    two = J.null_safe_left_join(
        left.withColumn("k", F.lit(1)), right.withColumn("k", F.lit(1)), ["k", "g"]
    )
    assert two.columns == ["g", "x", "k", "y"] and two.count() == 3


def test_multiway_case_join(spark):
    cases = spark.createDataFrame([("i1",), ("i2",)], "interview__id string")
    a = spark.createDataFrame([("i1", 1)], "interview__id string, a int")
    b = spark.createDataFrame([("i2", 2)], "interview__id string, b int")
    got = by(J.multiway_case_join(cases, a, b), "interview__id")
    assert (got["i1"]["a"], got["i1"]["b"]) == (1, None)
    assert (got["i2"]["a"], got["i2"]["b"]) == (None, 2)


def test_restrict_to_cases(spark):
    cases = spark.createDataFrame([("i1", "A")], "interview__id string, team string")
    roster = spark.createDataFrame(
        [("i1", 1), ("i1", 1), ("x", 2)], "interview__id string, v int"
    )
    got = J.restrict_to_cases(roster, cases)
    assert rows(got) == [{"interview__id": "i1", "v": 1}] * 2


def test_stack_and_roll_up(spark):
    a = spark.createDataFrame([("i1", 1), ("i1", None)], "interview__id string, x int")
    b = spark.createDataFrame([("i2", 2), ("i1", 1)], "interview__id string, y int")
    stacked = R.stack((a, {"a": F.col("x") == 1}), (b, {"b": F.col("y") == 1}))
    assert stacked.columns == ["interview__id", "a", "b"] and stacked.count() == 4
    got = by(
        R.roll_up(stacked, {"a": F.count_if(F.col("a")), "b": F.count_if(F.col("b"))}),
        "interview__id",
    )
    assert (got["i1"]["a"], got["i1"]["b"]) == (1, 1)
    assert (got["i2"]["a"], got["i2"]["b"]) == (0, 0)


def test_attach_fills_unmatched_cases(spark):
    cases = spark.createDataFrame(
        [("i1", "A"), ("i2", None)], "interview__id string, team string"
    )
    rolled = spark.createDataFrame([("i1", 5, 2)], "interview__id string, n int, k int")
    kept = by(R.attach(cases, rolled, "team", {"n": 1}), "interview__id")
    assert (kept["i2"]["n"], kept["i2"]["k"]) == (1, 0)
    dropped = R.attach(cases, rolled, "team", keep_unmatched=False)
    assert [r["interview__id"] for r in dropped.collect()] == ["i1"]


def test_padded(spark):
    df = spark.createDataFrame([(0,), (3,), (None,)], "n int")
    assert [r[0] for r in df.select(R.padded(F.col("n"))).collect()] == [1, 3, 1]
