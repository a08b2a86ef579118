"""The cases contract, titles by group, and merged parts of a stack."""

import pytest
from pyspark.sql import functions as F

import fieldtally as ft
from fieldtally.catalog.reports import report_table
from fieldtally.operators.rollup import stack

SF_DIR = "/root/testdata/sf0.001"


def test_assert_cases_passes_valid_cases_through(spark):
    cases = spark.createDataFrame([("a", "t"), ("b", None)], "interview__id string, team string")
    assert sorted(ft.assert_cases(cases, "team").collect()) == sorted(cases.collect())


@pytest.mark.parametrize("ids", [["a", "a"], ["a", None]])
def test_assert_cases_fails_the_job_only(spark, ids):
    cases = spark.createDataFrame([(i, "t") for i in ids], "interview__id string, team string")
    checked = ft.assert_cases(cases, "team")  # nothing runs yet
    with pytest.raises(Exception, match="interview id"):
        checked.collect()


def test_assert_cases_needs_its_columns(spark):
    with pytest.raises(ValueError, match="lacks"):
        ft.assert_cases(spark.createDataFrame([("a",)], "interview__id string"), "team")


def test_option_labels_refuse_repeated_codes(spark, tmp_path):
    path = tmp_path / "qnr.json"
    path.write_text(
        '{"variable": "q", "type": "multi", "answers": [{"value": 1, "label": "a"}, '
        '{"value": 1, "label": "b"}]}\n'
    )
    with pytest.raises(ValueError, match="repeats"):
        ft.option_labels(spark, str(path), "q")


@pytest.mark.parametrize("group", ["team", "enumerator"])
def test_title_names_the_group(spark, group):
    table = report_table(spark, SF_DIR, "plot_use", group)
    assert table.title == f"Plot use, by {group}"
    assert {r["title"] for r in table.dictionary().collect()} == {table.title}


def test_stack_reads_a_frame_once(spark):
    frame = spark.createDataFrame([("a", 1, None), ("b", None, 2)], "interview__id string, x int, y int")
    once = stack((frame, {"x": F.col("x")}), (frame, {"y": F.col("y")}))
    assert sorted(once.collect()) == sorted(frame.collect())


def test_income_sources_reads_line_items_twice(spark):
    """Crop sales and products each come from one scan and one join."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stats = report_table(spark, SF_DIR, "income_sources").stats
        plan = stats._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("lineitem.parquet") == 2


def test_first_value_sorts_no_roster(spark):
    """Only a row or two per interview reach the aggregate that sorts."""
    from fieldtally.catalog.registry import all_queries

    plan = all_queries()["first_value"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    if "SortAggregate" in plan:
        assert plan.index("SortAggregate") < plan.index("HashAggregate") < plan.index("parcel_id")
