"""Readers, the cases check, missing codes and questionnaire labels."""

import json

import pytest
from helpers import rows

from fieldtally.sources import frames as S
from fieldtally.sources import questionnaire as Q

SCHEMA = "interview__id string, area double, team string"


def test_load_parquet_and_columns(spark, tmp_path):
    df = spark.createDataFrame([("i1", 2.5, "A")], SCHEMA)
    df.write.parquet(str(tmp_path / "p"))
    got = S.load_frame(spark, str(tmp_path / "p"), columns=["interview__id", "team"])
    assert rows(got) == [{"interview__id": "i1", "team": "A"}]


def test_load_tab_separated_export(spark, tmp_path):
    path = tmp_path / "export.tab"
    path.write_text("interview__id\tarea\tteam\ni1\t-999999999\tA\ni2\t\tB\n")
    got = S.load_frame(spark, str(path), "tsv", schema=SCHEMA)
    assert [tuple(r) for r in got.collect()] == [("i1", -999999999.0, "A"), ("i2", None, "B")]


def test_text_exports_need_a_schema(spark, tmp_path):
    with pytest.raises(ValueError, match="schema"):
        S.load_frame(spark, str(tmp_path), "tsv")
    with pytest.raises(ValueError, match="unsupported"):
        S.load_frame(spark, str(tmp_path), "xml")


def test_check_cases(spark):
    cases = spark.createDataFrame(
        [("i1", "A"), ("i1", "A"), ("i1", "B"), ("i2", None), (None, "A"), (None, "B")],
        "interview__id string, team string",
    )
    assert rows(S.check_cases(cases, "team")) == [
        {"n_cases": 6, "n_null_ids": 2, "n_repeated_ids": 1}
    ]
    assert rows(S.check_cases(cases.limit(0), "team")) == [
        {"n_cases": 0, "n_null_ids": 0, "n_repeated_ids": 0}
    ]
    with pytest.raises(ValueError, match="region"):
        S.check_cases(cases, "region")


def test_normalize_missing(spark):
    df = spark.createDataFrame(
        [(-999999999.0, 1), (2.0, -999999999), (None, None)], "x double, n int"
    )
    got = S.normalize_missing(df, ["x", "n"])
    assert [tuple(r) for r in got.select("x", "natag__x", "n", "natag__n").collect()] == [
        (None, "a", 1, None),
        (2.0, None, None, "a"),
        (None, None, None, None),
    ]


def test_normalize_missing_keeps_tags(spark):
    df = spark.createDataFrame(
        [(None, "z"), (-999999999.0, None)], "x double, natag__x string"
    )
    got = S.normalize_missing(df, ["x"])
    assert [tuple(r) for r in got.collect()] == [(None, "z"), (None, "a")]


def test_questionnaire_labels(spark, tmp_path):
    questions = [
        {"variable": "why", "type": "multi", "answers": [
            {"value": 1, "label": 'The "dry" season'}, {"value": -98, "label": "Don't know"}]},
        {"variable": "name", "type": "text", "answers": []},
        {"variable": "use", "type": "single", "answers": [{"value": 1, "label": "Crops"}]},
    ]
    path = tmp_path / "q.jsonl"
    path.write_text("\n".join(json.dumps(q) for q in questions))
    expected = [("use", 1, "Crops"), ("why", -98, "Don't know"), ("why", 1, 'The "dry" season')]
    assert sorted(map(tuple, Q.questionnaire_labels(spark, str(path)).collect())) == expected
    lines = spark.read.text(str(path))
    assert sorted(map(tuple, Q.labels_from_lines(lines).collect())) == expected
    assert Q.option_labels(spark, str(path), "use") == [(1, "Crops")]
