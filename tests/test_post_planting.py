"""Post-planting reports on hand-made frames with hand-computed results."""

import math

import pytest
from helpers import by

import fieldtally as ft
from fieldtally.functions.labels import with_value_labels

CASES = [
    ("i1", "A"), ("i2", "A"), ("i3", "B"), ("i4", None), ("i5", "C"),
]


@pytest.fixture(scope="module")
def cases(spark):
    return spark.createDataFrame(CASES, "interview__id string, team string")


@pytest.fixture(scope="module")
def parcels(spark):
    data = [
        # id, parcel, use__1, use__n98, area, tag, why
        ("i1", 1, 1, 0, 12.5, None, None),
        ("i1", 2, 0, 0, -9999.0, None, 1),
        ("i1", 3, None, 1, -999999999.0, None, -98),
        ("i2", 1, None, 0, None, "a", 1),
        ("i2", 2, 2, 0, None, None, 2),
        ("i3", 1, None, None, 3.0, None, 1),
        ("i4", 1, 1, 1, -9999.0, None, None),
        ("elsewhere", 1, 1, 1, -9999.0, None, 1),
    ]
    df = spark.createDataFrame(
        data,
        "interview__id string, parcel_id int, use__1 int, use__n98 int, "
        "gps_area double, natag__gps_area string, why int",
    )
    return with_value_labels(df, "why", [(1, "Far"), (2, "Ill"), (3, "Rain"), (-98, "DK")])


def test_parcels_per_hhold(cases, parcels):
    table = ft.parcels_per_hhold(parcels, cases, "use", [1, -98], group_var="team")
    assert table.stats.columns == ["team", "interviews", "parcels", "ag", "non_ag"]
    got = by(table.stats, "team")
    # i1: yes, no, yes; i2: unknown and a stored 2 that is not "selected".
    assert got["A"] == dict(team="A", interviews=2, parcels=5, ag=2 / 5, non_ag=3 / 5)
    assert got["B"] == dict(team="B", interviews=1, parcels=1, ag=0.0, non_ag=1.0)
    assert got[None] == dict(team=None, interviews=1, parcels=1, ag=1.0, non_ag=0.0)
    # The unmatched case shows as one parcel that is not agricultural.
    assert got["C"] == dict(team="C", interviews=1, parcels=1, ag=0.0, non_ag=1.0)


def test_parcels_per_hhold_without_use(cases, parcels):
    table = ft.parcels_per_hhold(parcels, cases, group_var="team")
    assert table.stats.columns == ["team", "interviews", "parcels"]
    assert by(table.stats, "team")["A"]["parcels"] == 5
    assert [c.name for c in table.columns] == ["interviews", "parcels"]


def test_use_question_needs_its_codes(cases, parcels):
    with pytest.raises(ValueError):
        ft.parcels_per_hhold(parcels, cases, use_var="use", group_var="team")


def test_parcel_gps(cases, parcels):
    table = ft.parcel_gps(
        parcels, cases, "gps_area", why_no_gps_var="why", group_var="team"
    )
    assert table.stats.columns == [
        "team", "parcels", "not_measured", "why__1", "why__2", "why__3", "why__n98",
    ]
    got = by(table.stats, "team")
    assert got["A"] == {
        "team": "A", "parcels": 5, "not_measured": 3,
        "why__1": 2 / 3, "why__2": 1 / 3, "why__3": 0.0, "why__n98": 1 / 3,
    }
    # A reason is counted although the parcel was measured: 1 / 0.
    assert got["B"]["not_measured"] == 0
    assert got["B"]["why__1"] == math.inf and got["B"]["why__2"] is None
    assert got["C"]["parcels"] == 1 and got["C"]["not_measured"] == 0
    assert got["C"]["why__1"] is None
    assert got[None]["not_measured"] == 1 and got[None]["why__1"] == 0.0


def test_parcel_gps_uses_the_given_code(cases, parcels):
    table = ft.parcel_gps(parcels, cases, "gps_area", 12.5, group_var="team")
    assert table.stats.columns == ["team", "parcels", "not_measured"]
    got = by(table.stats, "team")
    # 12.5 is the code now; the export's missing code and tags count regardless.
    assert got["A"]["not_measured"] == 3 and got[None]["not_measured"] == 0


def test_plot_gps_counts_plain_missing(cases, parcels):
    table = ft.plot_gps(
        parcels, cases, "gps_area", why_no_gps_var="why", group_var="team"
    )
    got = by(table.stats, "team")
    assert got["A"]["not_measured"] == 4 and got["A"]["why__1"] == 2 / 4
    assert got["C"]["plots"] == 1 and got["C"]["not_measured"] == 1
    assert got["C"]["why__1"] == 0.0


@pytest.fixture(scope="module")
def plots(spark):
    data = [
        ("i1", 1, 1, 1, 1), ("i1", 1, 2, 2, 1), ("i1", 1, 2, 1, 2), ("i1", 2, 1, None, 2),
        ("i1", None, 1, 1, None), ("i2", 1, 1, 3, 1), ("i2", None, None, 3, 9),
        ("i3", None, 1, 1, 1), ("i4", 5, 1, 2, 2),
    ]
    df = spark.createDataFrame(
        data,
        "interview__id string, parcel_id int, plot_id int, use int, crop_type int",
    )
    return with_value_labels(df, "use", [(1, "Crops"), (2, "Pasture"), (3, "Fallow"), (4, "Forest")])


def test_plots_per_parcel(cases, plots):
    table = ft.plots_per_parcel(plots, cases, "parcel_id", "team")
    got = by(table.stats, "team")
    # Parcels without an id are not counted, their plots are.
    assert got["A"] == dict(team="A", n_parcels=3, n_plots=7, mean_plots=7 / 3)
    assert got["B"] == dict(team="B", n_parcels=0, n_plots=1, mean_plots=math.inf)
    assert got["C"] == dict(team="C", n_parcels=0, n_plots=1, mean_plots=math.inf)
    assert got[None] == dict(team=None, n_parcels=1, n_plots=1, mean_plots=1.0)


def test_crops_per_plot(cases, plots):
    table = ft.crops_per_plot(plots, cases, "parcel_id", "plot_id", "team")
    got = by(table.stats, "team")
    # Unknown ids are values: i1 has 4 plots over 5 rows, i2 has 2 over 2.
    assert got["A"] == dict(team="A", n_plots=6, n_crops=7, mean_crops=7 / 6)
    assert got["C"] == dict(team="C", n_plots=1, n_crops=1, mean_crops=1.0)


def test_plot_use(cases, plots):
    table = ft.plot_use(plots, cases, "use", "team")
    assert table.stats.columns == ["team", "plots", "use__1", "use__2", "use__3", "use__4"]
    got = by(table.stats, "team")
    assert got["A"] == {
        "team": "A", "plots": 7,
        "use__1": 3 / 7, "use__2": 1 / 7, "use__3": 2 / 7, "use__4": 0.0,
    }
    assert got["C"]["plots"] == 1 and got["C"]["use__1"] == 0.0


def test_crop_types(cases, plots):
    got = by(ft.crop_types(plots, cases, "crop_type", group_var="team").stats, "team")
    assert got["A"] == dict(team="A", n_crops=7, crop_temp=3 / 7, crop_perm=2 / 7)
    assert got["C"] == dict(team="C", n_crops=1, crop_temp=0.0, crop_perm=0.0)


def test_group_column_may_not_collide_with_a_measure(spark, plots):
    cases = spark.createDataFrame([("i1", "A")], "interview__id string, n_plots string")
    with pytest.raises(ValueError, match="collides"):
        ft.plots_per_parcel(plots, cases, "parcel_id", "n_plots")


def test_roster_may_repeat_the_group_column(spark, cases, plots):
    from pyspark.sql import functions as F

    doubled = plots.withColumn("team", F.lit("wrong"))
    plain = ft.plots_per_parcel(plots, cases, "parcel_id", "team").stats
    assert by(ft.plots_per_parcel(doubled, cases, "parcel_id", "team").stats, "team") == by(
        plain, "team"
    )
