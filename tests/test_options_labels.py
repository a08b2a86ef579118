"""Option columns and value labels."""

import pytest
from helpers import by, rows
from pyspark.sql import functions as F

from fieldtally.functions import labels as L
from fieldtally.functions import options as O


def test_option_column_names():
    assert O.option_column("q", 1) == "q__1"
    assert O.option_column("q", 0) == "q__0"
    assert O.option_column("q", -98) == "q__n98"
    assert O.option_column("q", 7.0) == "q__7"
    with pytest.raises(ValueError):
        O.option_column("q", 1.5)


def test_any_option(spark):
    df = spark.createDataFrame(
        [(1, 0), (0, 1), (None, 0), (2, 0)], "q__1 int, q__n98 int"
    )
    got = [r[0] for r in df.select(O.any_option(df, "q", [1, -98])).collect()]
    assert got == [True, True, None, False]


def test_option_columns_ignore_case_and_text(spark):
    df = spark.createDataFrame(
        [(1, 2, 3.0, "other", "a", 9)],
        "why__1 int, WHY__3 int, why__n98 double, why__text string, "
        "natag__why__1 string, why_2 int",
    )
    assert O.option_columns(df, "why") == ["why__1", "WHY__3", "why__n98"]


def test_option_dummies_cover_every_label(spark):
    df = spark.createDataFrame([(1,), (-98,), (None,), (5,)], "use int")
    df = L.with_value_labels(df, "use", [(1, "Crops"), (2, "Never"), (-98, "DK")])
    got = O.option_dummies(df, "use")
    assert got.columns == ["use", "use__1", "use__2", "use__n98"]
    assert [tuple(r)[1:] for r in got.collect()] == [
        (1, 0, 0), (0, 0, 1), (None, None, None), (0, 0, 0),
    ]


def test_option_counts_equal_pivot(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", 1), ("a", None), ("b", -98), ("b", 7)], "g string, use int"
    )
    df = L.with_value_labels(df, "use", [(1, "Crops"), (2, "Never"), (-98, "DK")])
    counts = O.option_counts(df, "use")
    got = df.groupBy("g").agg(*(e.alias(n) for n, e in counts.items()))
    pivot = df.groupBy("g").pivot("use", [1, 2, -98]).count().fillna(0)
    assert got.columns == ["g", "use__1", "use__2", "use__n98"]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, pivot.collect()))


def test_amount_predicates(spark):
    df = spark.createDataFrame(
        [
            (None, "a", 5.0, None),
            (-98.0, None, None, None),
            (3.0, None, -98.0, None),
            (3.0, None, 4.0, "b"),
            (3.0, None, None, None),
        ],
        "x double, natag__x string, y double, natag__y string",
    )
    got = df.select(
        O.amount_missing(df, ["x", "y"]).alias("miss"),
        O.amount_unknown(["x", "y"], -98).alias("dk"),
        O.amount_missing(df, "x").alias("miss1"),
        O.amount_unknown("x", -98).alias("dk1"),
    )
    assert [tuple(r) for r in got.collect()] == [
        (True, None, True, None),
        (False, True, False, True),
        (False, True, False, False),
        (True, False, False, False),
        (False, None, False, False),
    ]
    for names in ([], ["x", "y", "z"]):
        with pytest.raises(ValueError):
            O.amount_missing(df, names)


def test_labels_survive_transformations_and_parquet(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "use int, id string")
    df = L.with_value_labels(df, "use", [(1, "Crops"), (-98, "DK")])
    kept = df.filter("use > 0").select("id", "use")
    assert L.value_labels(kept, "use") == [(1, "Crops"), (-98, "DK")]
    joined = kept.join(spark.createDataFrame([("x",)], "id string"), "id", "left")
    assert L.label_values(joined, "use") == [1, -98]
    df.write.parquet(str(tmp_path / "p"))
    stored = spark.read.parquet(str(tmp_path / "p"))
    assert L.label_texts(stored, "use") == ["Crops", "DK"]


def test_unlabelled_column_is_an_error(spark):
    df = spark.createDataFrame([(1,)], "use int")
    with pytest.raises(ValueError, match="no value labels"):
        L.value_labels(df, "use")


def test_decode(spark):
    df = spark.createDataFrame([(1,), (2,), (None,), (9,)], "use int")
    df = L.with_value_labels(df, "use", [(1, "Crops"), (2, "Pasture")])
    book = L.value_label_frame(spark, df, ["use"])
    assert sorted(map(tuple, book.collect())) == [
        ("use", 1, "Crops"), ("use", 2, "Pasture"),
    ]
    got = L.decode(df, "use", book, "text")
    assert got.columns == ["use", "text"]
    assert {r["use"]: r["text"] for r in got.collect()} == {
        1: "Crops", 2: "Pasture", None: None, 9: None,
    }


def test_heading():
    assert L.heading("Don't know", -98) == "Don't know (-98)"
