"""Properties that hold whatever the data."""

import math

import pytest
from helpers import TESTDATA, by, spark_result
from pyspark.sql import functions as F

import fieldtally as ft
from fieldtally.catalog.frames import survey_frame
from fieldtally.catalog.reports import REPORTS
from fieldtally.operators.joins import restrict_to_cases

SF_DIR = f"{TESTDATA}/sf0.001"
FILTERED = {"temp_crop_harvest", "temp_crop_sales", "perm_crop_harvest", "perm_crop_sales"}


@pytest.fixture(scope="module")
def frames(spark):
    def frame(name):
        return survey_frame(spark, SF_DIR, name)

    return frame


@pytest.mark.parametrize("key", ["plots_per_parcel", "crops_per_plot", "crop_labor", "income_sources"])
def test_row_order_and_partitions_do_not_matter(frames, key):
    def shuffled(name):
        return frames(name).orderBy(F.rand(seed=7)).repartition(5)

    assert spark_result(REPORTS[key](frames, "team").stats) == spark_result(
        REPORTS[key](shuffled, "team").stats
    )


@pytest.mark.parametrize("key", ["parcel_gps", "plots_per_parcel", "temp_crop_sales", "crop_labor"])
def test_restricting_the_rosters_changes_nothing(frames, key):
    def few(name):
        df = frames(name)
        return df.filter("enumerator < '120'") if name == "cases" else df

    def restricted(name):
        return few(name) if name == "cases" else restrict_to_cases(few(name), few("cases"))

    assert spark_result(REPORTS[key](few, "team").stats) == spark_result(
        REPORTS[key](restricted, "team").stats
    )


@pytest.mark.parametrize("key", list(REPORTS))
def test_one_more_unmatched_case(spark, frames, key):
    """A case of a new team shows as one empty row, or not at all behind a filter."""

    def extended(name):
        df = frames(name)
        if name != "cases":
            return df
        extra = spark.createDataFrame([("lonely", "NEW", "0")], df.schema)
        return df.unionByName(extra)

    before = by(REPORTS[key](frames, "team").stats, "team")
    after = by(REPORTS[key](extended, "team").stats, "team")
    new = after.pop("NEW", None)
    assert after == before
    if key in FILTERED:
        assert new is None
        return
    ones = {"interviews", "parcels", "plots", "n_plots", "n_crops", "n_hholds"}
    for name, value in new.items():
        if name in ones:
            assert value == 1, name
        elif name == "not_measured":
            assert value == (key == "plot_gps")
        elif name == "non_ag":
            assert value == 1.0
        elif name == "mean_plots":
            assert value == math.inf
        elif name == "mean_crops":
            assert value == 1.0
        elif name != "team":
            assert not value, name


def test_shares_add_up(frames):
    for group in ("team", "enumerator"):
        for row in REPORTS["parcels_per_hhold"](frames, group).stats.collect():
            assert row["ag"] + row["non_ag"] == pytest.approx(1)
        for key, names in (
            ("cow_displacement", ("bull", "cow", "steer_heifer", "calf")),
            ("hen_displacement", ("cock", "hen", "pullet")),
        ):
            for row in REPORTS[key](frames, group).stats.collect():
                if row["n_types"]:
                    assert sum(row[n] for n in names) == pytest.approx(1)


def test_plain_missing_only_adds_to_not_measured(frames):
    parcels, cases = frames("parcels"), frames("cases")
    strict = by(ft.parcel_gps(parcels, cases, "gps_area", group_var="team").stats, "team")
    wide = by(
        ft.plot_gps(
            parcels, cases, "gps_area", why_no_gps_var="why_no_gps", group_var="team"
        ).stats,
        "team",
    )
    assert all(strict[t]["not_measured"] <= wide[t]["not_measured"] for t in strict)
    assert sum(r["not_measured"] for r in strict.values()) > 0


def test_group_of_another_type(frames):
    def numbered(name):
        df = frames(name)
        return df.withColumn("team", F.length("team")) if name == "cases" else df

    table = REPORTS["crop_types"](numbered, "team")
    assert dict(table.stats.dtypes)["team"] == "int"
    shown = [r["team"] for r in table.display().collect()]
    assert shown[-1] == "---" and shown[:-1] == sorted(shown[:-1], key=int)
