"""Declared unique rosters, counts in long form, tuples with missing parts, id checks."""

import random

import pytest
from helpers import TESTDATA, physical_plan, rows, spark_result
from pyspark.sql import functions as F

import fieldtally as ft
from fieldtally.catalog.frames import survey_frame
from fieldtally.catalog.reports import REPORTS
from fieldtally.functions.labels import with_value_labels
from fieldtally.functions.options import option_counts
from fieldtally.operators.rollup import declared_unique, tally, tally_codes

SF_DIR = f"{TESTDATA}/sf0.001"
HOUSEHOLD = ("livestock_ownership", "cow_displacement", "hen_displacement", "sector_labor")


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def undeclared(frame):
    return frame.withMetadata("interview__id", {})


@pytest.mark.parametrize("key", HOUSEHOLD)
def test_a_unique_roster_is_not_aggregated(spark, no_broadcast, key):
    """The only aggregate is the one per group, above the join."""

    def plan(change):
        frames = lambda name: change(survey_frame(spark, SF_DIR, name)) if name == "hhold" else survey_frame(spark, SF_DIR, name)
        return physical_plan(REPORTS[key](frames, "team").stats)

    declared, plain = plan(lambda f: f), plan(undeclared)
    assert "HashAggregate" not in declared[declared.index("SortMergeJoin"):]
    assert "HashAggregate" in plain[plain.index("SortMergeJoin"):]
    assert declared.count("HashAggregate") == 2 < plain.count("HashAggregate")


@pytest.mark.parametrize("key", HOUSEHOLD)
@pytest.mark.parametrize("repeat", [False, True])
def test_declaring_never_changes_a_report(spark, key, repeat):
    """Not even a roster that is wrongly declared unique."""
    hhold = survey_frame(spark, SF_DIR, "hhold")
    if repeat:
        hhold = hhold.unionByName(hhold.where("animal__12 = 1"))
    frames = {"hhold": hhold, "cases": survey_frame(spark, SF_DIR, "cases")}
    declared = {**frames, "hhold": ft.declare_unique(hhold)}
    plain = {**frames, "hhold": undeclared(hhold)}
    got = [spark_result(REPORTS[key](lambda n, f=f: f[n], "team").stats) for f in (declared, plain)]
    assert got[0] == got[1]


def test_the_declaration_is_part_of_the_schema(spark, tmp_path):
    frame = spark.createDataFrame([("a", 1)], "interview__id string, x int")
    assert not declared_unique(frame)
    marked = ft.declare_unique(frame)
    assert declared_unique(marked.where("x > 0").select("interview__id"))
    marked.write.parquet(str(tmp_path / "f"))
    assert declared_unique(spark.read.parquet(str(tmp_path / "f")))
    assert not declared_unique(marked.groupBy("x").agg(F.max("interview__id").alias("interview__id")))


@pytest.mark.parametrize("ids", [["a", "a"], ["a", None]])
def test_assert_unique_fails_the_job_only(spark, ids):
    frame = spark.createDataFrame([(i, 1) for i in ids], "interview__id string, x int")
    checked = ft.assert_unique(frame)
    assert declared_unique(checked)
    with pytest.raises(Exception, match="interview id"):
        checked.collect()


def test_assert_cases_sorts_nothing(spark):
    cases = survey_frame(spark, SF_DIR, "cases")
    checked = ft.assert_cases(cases, "team")
    plan = checked._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort [" not in plan
    assert checked.count() == cases.count()
    table = ft.crop_types(survey_frame(spark, SF_DIR, "crops"), checked, "crop_type", group_var="team")
    plain = ft.crop_types(survey_frame(spark, SF_DIR, "crops"), cases, "crop_type", group_var="team")
    assert spark_result(table.stats) == spark_result(plain.stats)


def test_repeated_cases_fail_the_report(spark):
    cases = survey_frame(spark, SF_DIR, "cases")
    twice = ft.assert_cases(cases.unionByName(cases.where("interview__id = 'C5'")), "team")
    stats = ft.crop_types(survey_frame(spark, SF_DIR, "crops"), twice, "crop_type", group_var="team").stats
    with pytest.raises(Exception, match="repeated interview id: C5"):
        stats.collect()


def test_counts_in_long_form(spark):
    cases = spark.createDataFrame(
        [("i1", "A"), ("i2", "A"), ("i3", None), ("i4", "B")], "interview__id string, team string"
    )
    roster = spark.createDataFrame(
        [("i1", 1.0), ("i1", 1.0), ("i1", None), ("i2", 2.5), ("i3", -98.0), ("x", 1.0), (None, 1.0)],
        "interview__id string, q double",
    )
    names = {1: "q__1", 2: "q__2", -98: "q__n98"}
    got = {r["team"]: tuple(r)[1:] for r in tally_codes(cases, roster, "team", F.col("q"), names, "n").collect()}
    assert got == {"A": (4, 2, 0, 0), None: (1, 0, 0, 1), "B": (1, 0, 0, 0)}
    by_case = tally_codes(cases, roster, "interview__id", F.col("q"), names)
    assert by_case.columns == ["interview__id", *names.values()] and by_case.count() == 4


def test_both_forms_of_counts_agree(spark):
    r = random.Random(3)
    labels = [(code, f"label {code}") for code in range(-5, 150)]
    data = [(f"i{r.randrange(60)}", r.choice([None, *range(-8, 160)])) for _ in range(3000)]
    roster = with_value_labels(spark.createDataFrame(data, "interview__id string, q int"), "q", labels)
    cases = spark.createDataFrame([(f"i{k}", f"t{k % 7}") for k in range(70)], "interview__id string, team string")
    counts = option_counts(roster, "q")
    wide = tally(cases, roster, "team", {"n": F.count(F.lit(1)), **counts}, {"n": 1})
    long = tally_codes(cases, roster, "team", F.col("q"), dict(zip((c for c, _ in labels), counts, strict=True)), "n")
    assert spark_result(wide) == spark_result(long)


def test_plot_use_with_many_options(spark):
    """Above the limit the report changes its plan and nothing else."""
    labels = [(code, f"Use {code}") for code in range(300)]
    data = [(f"i{k % 40}", k % 311) for k in range(2000)]
    plots = with_value_labels(spark.createDataFrame(data, "interview__id string, use int"), "use", labels)
    cases = spark.createDataFrame([(f"i{k}", f"t{k % 3}") for k in range(45)], "interview__id string, team string")
    table = ft.plot_use(plots, cases, "use", "team")
    assert "pivotfirst" in physical_plan(table.stats).lower()
    few = with_value_labels(plots, "use", labels[:4])
    small = ft.plot_use(few, cases, "use", "team")
    assert "pivotfirst" not in physical_plan(small.stats).lower()
    columns = ["team", "plots", *(f"use__{k}" for k in range(4))]
    assert sorted(map(str, table.stats.select(columns).collect())) == sorted(map(str, small.stats.select(columns).collect()))
    assert len(table.columns) == len(labels) + 1


def test_tuples_keep_missing_parts(spark):
    crops = spark.createDataFrame(
        [("i1", 1, 1), ("i1", 1, 1), ("i1", None, 1), ("i1", None, 1), ("i1", 1, None), ("i1", None, None), ("i2", 1, 1)],
        "interview__id string, parcel int, plot int",
    )
    cases = spark.createDataFrame([("i1", "A"), ("i2", "A"), ("i3", "B")], "interview__id string, team string")
    stats = ft.crops_per_plot(crops, cases, "parcel", "plot", "team").stats
    got = {r["team"]: (r["n_plots"], r["n_crops"]) for r in rows(stats)}
    assert got == {"A": (5, 7), "B": (1, 1)}
