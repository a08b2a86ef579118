"""Shapes of the physical plans: what is shuffled, joined and read."""

import re

import pytest
from helpers import TESTDATA, physical_plan
from pyspark.sql import functions as F

import fieldtally as ft
from fieldtally.catalog.frames import LABELS
from fieldtally.catalog.registry import all_queries
from fieldtally.catalog.reports import REPORTS
from fieldtally.functions.labels import with_value_labels
from fieldtally.operators.joins import case_roster_join, restrict_to_cases
from test_random_frames import HHOLD, ROSTERS

SF_DIR = f"{TESTDATA}/sf0.001"
QUERIES = all_queries()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture(scope="module")
def stored_frames(spark, tmp_path_factory):
    """All survey frames as plain parquet tables."""
    root = tmp_path_factory.mktemp("frames")
    columns = {name: {c: t for c, (t, _) in cols.items()} for name, cols in ROSTERS.items()}
    columns["hhold"] = {c: t for c, (t, _) in HHOLD.items()}
    columns["cases"] = {"team": "string", "enumerator": "string"}
    frames = {}
    for name, types in columns.items():
        fields = [F.concat(F.lit("i"), F.col("id").cast("string")).alias("interview__id")]
        fields += [F.lit(None).cast(t).alias(c) for c, t in types.items()]
        spark.range(50).select(*fields).write.parquet(f"{root}/{name}")
        df = spark.read.parquet(f"{root}/{name}")
        for (frame, variable), labels in LABELS.items():
            if frame == name:
                df = with_value_labels(df, variable, labels)
        frames[name] = df
    return frames


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_cross_join_and_no_python(spark, no_broadcast, key):
    plan = physical_plan(QUERIES[key](spark, SF_DIR))
    for bad in ("CartesianProduct", "NestedLoop", "ArrowEval", "BatchEval", "MapInPandas", "FlatMap"):
        assert bad not in plan, bad


# Reports that count distinct tuples need one exchange more.
DISTINCT = {"plots_per_parcel", "crops_per_plot"}


@pytest.mark.parametrize("key", list(REPORTS))
def test_one_join_and_few_shuffles(no_broadcast, stored_frames, key):
    plan = physical_plan(REPORTS[key](lambda name: stored_frames[name], "team").stats)
    assert len(re.findall(r"SortMergeJoin", plan)) == 1
    # The roster or the stack of rosters, the cases, and the groups.
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 3 + (key in DISTINCT)
    # Nothing reaches a shuffle on the interview without a map-side combine.
    for branch in plan.split("SortMergeJoin")[1].split("Exchange hashpartitioning")[2:]:
        assert "HashAggregate" in branch.splitlines()[1]


def read_columns(plan):
    return [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<(.*?)>", plan)]


def test_scans_read_only_what_the_report_needs(no_broadcast, stored_frames):
    stats = ft.perm_crop_harvest(
        stored_frames["crops"], stored_frames["cases"], "crop_id", [12, 13],
        "n_produce", "harvested", group_var="team",
    ).stats
    plan = physical_plan(stats)
    assert {"interview__id", "crop_id", "n_produce", "harvested"} in read_columns(plan)
    assert {"interview__id", "team"} in read_columns(plan)
    assert re.search(r"PushedFilters: \[[^\]]*In\(crop_id", plan)


def test_multi_frame_report_prunes_every_frame(no_broadcast, stored_frames):
    plan = physical_plan(REPORTS["crop_labor"](lambda n: stored_frames[n], "team").stats)
    assert {"interview__id", "worked"} in read_columns(plan)
    assert {"interview__id", "grew_crops", "paid__1", "paid__2", "free__1"} in read_columns(plan)


def test_restrict_to_cases_broadcasts_only_below_the_threshold(spark, stored_frames, no_broadcast):
    def plan():
        return physical_plan(restrict_to_cases(stored_frames["plots"], stored_frames["cases"]))

    assert "BroadcastHashJoin" not in plan() and "LeftSemi" in plan()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    assert "BroadcastHashJoin" in plan()


def test_selected_cases_prune_the_roster_before_the_shuffle(spark, stored_frames, no_broadcast):
    """Spark's runtime filter passes through the roll-up down to the scan."""
    setting = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "0")
    try:
        cases = stored_frames["cases"].filter("team = 'A'")
        plan = physical_plan(
            ft.crop_types(stored_frames["crops"], cases, "crop_type", group_var="team").stats
        )
    finally:
        spark.conf.set(setting, before)
    partial = plan[plan.index("partial_count"):]
    assert "might_contain" in partial and "Exchange hashpartitioning" not in partial


def test_hot_interview_is_split_in_the_row_level_join(spark, no_broadcast, tmp_path):
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name) for name in settings}
    number = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 4000)
    spark.range(0, 600000, 1, 8).select(
        F.concat(F.lit("i"), number.cast("string")).alias("interview__id"),
        F.xxhash64("id").alias("v"),
    ).write.parquet(f"{tmp_path}/roster")
    spark.range(5000).select(
        F.concat(F.lit("i"), F.col("id").cast("string")).alias("interview__id")
    ).write.parquet(f"{tmp_path}/cases")
    roster = spark.read.parquet(f"{tmp_path}/roster")
    cases = spark.read.parquet(f"{tmp_path}/cases")
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        joined = case_roster_join(cases, roster)
        joined.collect()
        plan = physical_plan(joined)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert "skew=true" in plan
    plain = cases.join(roster, "interview__id", "left")
    assert joined.count() == plain.count()


def test_library_gives_no_broadcast_hints():
    import pathlib

    package = pathlib.Path(ft.__file__).parent
    for path in package.rglob("*.py"):
        if "llm" in path.parts:
            continue
        text = path.read_text()
        assert "broadcast(" not in text and "localCheckpoint" not in text, path
