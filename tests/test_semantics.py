"""Missing-value and zero-denominator rules."""

import math

import pytest
from helpers import by, rows
from pyspark.sql import functions as F

from fieldtally.functions import semantics as S


def test_safe_ratio(spark):
    data = [
        ("plain", 3, 4),
        ("zero over zero", 0, 0),
        ("positive over zero", 2, 0),
        ("negative over zero", -2, 0),
        ("no numerator", None, 4),
        ("no numerator over zero", None, 0),
        ("no denominator", 3, None),
    ]
    df = spark.createDataFrame(data, "what string, n int, d int")
    got = by(df.select("what", S.safe_ratio(F.col("n"), F.col("d")).alias("r")), "what")
    assert {k: v["r"] for k, v in got.items()} == {
        "plain": 0.75,
        "zero over zero": None,
        "positive over zero": math.inf,
        "negative over zero": -math.inf,
        "no numerator": None,
        "no numerator over zero": None,
        "no denominator": None,
    }


def test_totals_over_nothing_are_zero(spark):
    df = spark.createDataFrame([("a", None), ("b", 2), ("b", None)], "g string, x int")
    got = by(df.groupBy("g").agg(S.total(F.col("x")).alias("t")), "g")
    assert got["a"]["t"] == 0 and got["b"]["t"] == 2


def test_any_rules(spark):
    data = [
        ("yes", True), ("yes", None), ("yes", False),
        ("unknown", None), ("unknown", False),
        ("no", False),
        ("only unknown", None),
    ]
    df = spark.createDataFrame(data, "g string, x boolean")
    got = by(
        df.groupBy("g").agg(
            S.any_true(F.col("x")).alias("skipping"),
            S.any_true_or_unknown(F.col("x")).alias("strict"),
        ),
        "g",
    )
    assert {k: (v["skipping"], v["strict"]) for k, v in got.items()} == {
        "yes": (True, True),
        "unknown": (False, None),
        "no": (False, False),
        "only unknown": (False, None),
    }
    nothing = df.filter("g = 'absent'").agg(
        S.any_true(F.col("x")).alias("skipping"),
        S.any_true_or_unknown(F.col("x")).alias("strict"),
    )
    assert rows(nothing) == [{"skipping": False, "strict": False}]


def test_is_in_is_never_null(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "x int")
    got = [r[0] for r in df.select(S.is_in(F.col("x"), [1, 2])).collect()]
    assert got == [True, False, False]


def test_coded_turns_booleans_into_numbers(spark):
    df = spark.createDataFrame([(True, 2), (None, None), (False, 1)], "Yes boolean, n int")
    got = df.select(S.coded(df, "yes") == 1, S.coded(df, "n") == 1).collect()
    assert [tuple(r) for r in got] == [(True, False), (None, None), (False, True)]


def test_flag_counts_unknown_as_no(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    assert [r[0] for r in df.select(S.flag(F.col("x") == 1)).collect()] == [1, 0, 0]


def test_row_total(spark):
    df = spark.createDataFrame([(1, 3), (None, 2), (None, None)], "a int, b int")
    cols = [F.col("a"), F.col("b")]
    got = df.select(
        S.row_total(cols).alias("skip"),
        S.row_total(cols, skip_missing=False).alias("strict"),
        S.row_total([]).alias("none"),
    ).collect()
    assert [tuple(r) for r in got] == [(4, 4, 0), (2, None, 0), (0, None, 0)]


def test_any_of_is_three_valued(spark):
    df = spark.createDataFrame([(1, 0), (None, 1), (None, 0), (0, 0)], "a int, b int")
    got = df.select(S.any_of([F.col("a") == 1, F.col("b") == 1])).collect()
    assert [r[0] for r in got] == [True, True, None, False]
    with pytest.raises(ValueError):
        S.any_of([])


def test_tagged_is_not_plain_missing(spark):
    df = spark.createDataFrame(
        [(1.0, None), (None, None), (None, "a")], "x double, natag__x string"
    )
    assert [r[0] for r in df.select(S.is_tagged(df, "x")).collect()] == [False, False, True]
    bare = df.drop("natag__x")
    assert [r[0] for r in bare.select(S.is_tagged(bare, "x")).collect()] == [False] * 3


def test_null_for_nan(spark):
    df = spark.createDataFrame(
        [("a", 1, math.nan), ("b", 2, math.inf), ("c", 3, None), ("d", None, 0.5)],
        "k string, n int, x double",
    )
    got = by(S.null_for_nan(df), "k")
    assert [got[k]["x"] for k in "abcd"] == [None, math.inf, None, 0.5]
    assert [got[k]["n"] for k in "abcd"] == [1, 2, 3, None]
