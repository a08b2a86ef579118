"""Nested questionnaires, text exports with missing codes, reports written whole."""

import json

import pytest
from helpers import rows, spark_result
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import fieldtally as ft
from fieldtally.catalog.frames import survey_frame
from fieldtally.catalog.reports import report_table, temp_crop_harvest_report
from fieldtally.sources import exports as E
from fieldtally.sources import questionnaire as Q

SF_DIR = "/root/testdata/sf0.001"


# Questionnaires


def question(name, answers=None, **more):
    node = {"$type": "MultyOptionsQuestion", "VariableName": name, "QuestionText": f"{name}?"}
    if answers is not None:
        node["Answers"] = [{"AnswerText": t, "AnswerValue": str(v)} for v, t in answers]
    return {**node, **more}


DOCUMENT = {
    "Title": "Survey",
    "Children": [
        {
            "$type": "Group",
            "Title": "Crops",
            "IsRoster": False,
            "Children": [
                {
                    "$type": "Group",
                    "Title": "Plots",
                    "VariableName": "plots",
                    "IsRoster": True,
                    "Children": [
                        question("why_not", [(1, "Drought"), (2, 'Pests, "other"'), (-98, "Don't know")]),
                        {"$type": "StaticText", "Text": "Read aloud"},
                    ],
                },
                question("n_plots"),
            ],
        },
        {"$type": "Group", "Title": "Empty", "Children": []},
        question("", [(1, "x")], StataExportCaption="former_name"),
    ],
}


@pytest.fixture
def document(tmp_path):
    path = tmp_path / "document.json"
    path.write_text("﻿" + json.dumps(DOCUMENT, indent=2), encoding="utf-8")
    return str(path)


def test_questions_of_a_nested_document(spark, document):
    found = {r["variable"]: r.asDict(True) for r in Q.questions(spark, document).collect()}
    assert set(found) == {"why_not", "n_plots", "former_name"}
    why = found["why_not"]
    assert (why["document"], why["sections"], why["rosters"]) == ("Survey", ["Crops", "Plots"], ["plots"])
    assert why["type"] == "MultyOptionsQuestion" and why["text"] == "why_not?"
    assert [(a["value"], a["label"]) for a in why["answers"]] == [
        (1, "Drought"), (2, 'Pests, "other"'), (-98, "Don't know"),
    ]
    assert found["n_plots"]["rosters"] == [] and found["n_plots"]["answers"] == []
    assert found["former_name"]["sections"] == []


def test_labels_of_a_nested_document(spark, document):
    assert ft.option_labels(spark, document, "why_not")[2] == (-98, "Don't know")
    assert Q.questionnaire_labels(spark, document).count() == 4


def test_headings_come_from_the_nested_document(spark, document):
    table = temp_crop_harvest_report(
        lambda name: survey_frame(spark, SF_DIR, name), "team", json_qnr_path=document
    )
    labels = {r["statistic"]: r["label"] for r in table.dictionary().collect()}
    assert labels["why_not__n98"] == "Don't know" and labels["why_not__1"] == "Drought"


@pytest.mark.parametrize("depth", [0, 1, 7, 8, 9, 20])
def test_any_depth(spark, depth):
    node = question("deep", [(1, "a")])
    for k in range(depth):
        node = {"Title": f"t{k}", "IsRoster": k % 2 == 0, "Children": [node]}
    texts = spark.createDataFrame([(json.dumps({"Title": "d", "Children": [node]}),)], "value string")
    (row,) = Q.questions_from_documents(texts).collect()
    assert row["sections"] == [f"t{k}" for k in range(depth)][::-1]
    assert row["rosters"] == [f"t{k}" for k in range(0, depth, 2)][::-1]


def test_documents_per_line_and_texts_that_are_none(spark, tmp_path):
    lines = [json.dumps(DOCUMENT), json.dumps({**DOCUMENT, "Title": "Second"}), "no json {", '{"a": 1}']
    (tmp_path / "many.txt").write_text("\n".join(lines))
    found = Q.questions(spark, str(tmp_path / "many.txt"), "documents")
    assert sorted(r["document"] for r in found.collect()) == ["Second"] * 3 + ["Survey"] * 3
    with pytest.raises(ValueError, match="layout"):
        Q.questions(spark, str(tmp_path / "many.txt"), "xml")


# Exports

SCHEMA = "interview__id string, area double, n int, day date, name string"
HEADER = "interview__id\tarea\tn\tday\tname\tnotes"
LINES = [
    "i1\t1.5\t3\t2024-05-01\tAda\tx",
    "i2\t.a\t.z\t\tBo\t",
    "i3\t.\t\t2024-05-02\t.a\ty",
    "i4\t 7 \t .b \t2024-05-03\t\t",
    "i5\t-999999999\t0\t2024-05-04\tCy\tz",
    "i6\tseven\t1\t2024-05-04\tD\tz",
    "i7\t1\t1.5\t2024-05-04\tD\tz",
    "i8\t1\t1\tMay\tD\tz",
    "i9\t1",
    "i10\t1\t1\t2024-05-04\tD\tz\tmore",
    "i11\t.aa\t1\t2024-05-04\tD\tz",
    "i12\t1\t9999999999\t2024-05-04\tD\tz",
]


@pytest.fixture
def export(spark, tmp_path):
    for name, lines in (("a.tab", LINES[:5]), ("b.tab", LINES[5:]), ("c.tab", [])):
        (tmp_path / name).write_text("\r\n".join([HEADER, *lines]) + "\r\n")
    return E.read_export(spark, str(tmp_path), SCHEMA)


def test_typed_rows_of_an_export(export):
    got = {r["interview__id"]: tuple(r)[1:] for r in export.rows.withColumn("day", F.col("day").cast("string")).collect()}
    assert export.rows.columns == ["interview__id", "area", "natag__area", "n", "natag__n", "day", "name"]
    assert got == {
        "i1": (1.5, None, 3, None, "2024-05-01", "Ada"),
        "i2": (None, "a", None, "z", None, "Bo"),
        "i3": (None, None, None, None, "2024-05-02", ".a"),
        "i4": (7.0, None, None, "b", "2024-05-03", None),
        "i5": (-999999999.0, None, 0, None, "2024-05-04", "Cy"),
    }


def test_rejected_lines_of_an_export(export):
    got = {r["line"].split("\t")[0]: (r["line"], r["reason"]) for r in export.rejected.collect()}
    assert {line for line, _ in got.values()} == set(LINES[5:])
    assert got["i6"][1] == "area is no double: seven"
    assert got["i7"][1] == "n is no int: 1.5" and got["i8"][1].startswith("day is no date")
    assert got["i9"][1] == got["i10"][1] == "the line does not have 6 cells"
    assert got["i11"][1] == "area is no double: .aa" and got["i12"][1].startswith("n is no int")


def test_export_feeds_a_report(spark, tmp_path):
    """Tags read from the text count as not measured."""
    (tmp_path / "p.tab").write_text("interview__id\tarea\ni1\t.a\ni1\t5\ni2\t.\n")
    parcels = E.read_export(spark, str(tmp_path / "p.tab"), "interview__id string, area double").rows
    cases = spark.createDataFrame([("i1", "A"), ("i2", "A")], "interview__id string, team string")
    stats = ft.parcel_gps(parcels, cases, "area", group_var="team").stats
    assert rows(stats) == [{"team": "A", "parcels": 3, "not_measured": 1}]


def test_empty_export_and_absent_columns(spark, tmp_path):
    (tmp_path / "none.tab").write_text("")
    assert E.read_export(spark, str(tmp_path / "none.tab"), SCHEMA).rows.count() == 0
    (tmp_path / "some.tab").write_text("interview__id\tx\n")
    with pytest.raises(ValueError, match="area"):
        E.read_export(spark, str(tmp_path / "some.tab"), SCHEMA)


# Written reports


def test_a_failed_write_leaves_the_former_report(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "report")
    first = report_table(spark, SF_DIR, "crop_types")
    first.write(path)
    former = spark_result(ft.read_report(spark, path)[0])

    writer = type(first.stats.write)
    plain, calls = writer.parquet, []

    def failing(self, target, *args, **kwargs):
        calls.append(target)
        if len(calls) == 2:
            raise OSError("no space left")
        return plain(self, target, *args, **kwargs)

    monkeypatch.setattr(writer, "parquet", failing)
    with pytest.raises(OSError, match="space"):
        report_table(spark, SF_DIR, "crop_types", "enumerator").write(path, "overwrite")
    monkeypatch.undo()
    assert len(calls) == 2
    stats, dictionary = ft.read_report(spark, path)
    assert spark_result(stats) == former == spark_result(first.stats)
    assert dictionary.count() == len(first.columns)


def test_overwriting_a_report(spark, tmp_path):
    path = str(tmp_path / "report")
    with pytest.raises(FileNotFoundError):
        ft.read_report(spark, path)
    report_table(spark, SF_DIR, "crop_types").write(path)
    with pytest.raises(FileExistsError):
        report_table(spark, SF_DIR, "crop_types").write(path)
    with pytest.raises(ValueError, match="mode"):
        report_table(spark, SF_DIR, "crop_types").write(path, "append")
    for key, group in (("plot_use", "team"), ("crop_types", "enumerator")):
        table = report_table(spark, SF_DIR, key, group)
        table.write(path, "overwrite")
        stats, dictionary = ft.read_report(spark, path)
        assert isinstance(stats, DataFrame) and stats.columns == table.stats.columns
        assert stats.count() == table.stats.count()
        assert {r["report"] for r in dictionary.collect()} == {key}


def test_a_failed_first_write_can_be_repeated(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "report")
    table = report_table(spark, SF_DIR, "crop_types")
    writer = type(table.stats.write)
    plain = writer.parquet

    def failing(self, target, *args, **kwargs):
        if target.endswith("/stats"):
            raise OSError("no space left")
        return plain(self, target, *args, **kwargs)

    monkeypatch.setattr(writer, "parquet", failing)
    with pytest.raises(OSError, match="space"):
        table.write(path)
    monkeypatch.undo()
    with pytest.raises(FileNotFoundError):
        ft.read_report(spark, path)
    table.write(path)
    assert spark_result(ft.read_report(spark, path)[0]) == spark_result(table.stats)
