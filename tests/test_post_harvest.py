"""Post-harvest reports on hand-made frames with hand-computed results."""

import json
import math

import pytest
from helpers import by

import fieldtally as ft

CASES = [("i1", "A"), ("i2", "A"), ("i3", "B"), ("i4", None), ("i5", "C")]


@pytest.fixture(scope="module")
def cases(spark):
    return spark.createDataFrame(CASES, "interview__id string, team string")


@pytest.fixture(scope="module")
def crops(spark):
    return spark.createDataFrame(
        [
            # id, crop, harvested, why__1, WHY__2, why__n98, produce
            ("i1", 1, 1, None, None, None, 5.0),
            ("i1", 2, 2, 1, 2, 0, 0.0),
            ("i1", None, 1, 1, 1, 1, 9.0),
            ("i2", 1, None, 0, 1, None, None),
            ("i2", 50, 1, 1, 1, 1, 2.0),
            ("i3", 50, 2, 1, 1, 1, 0.0),
            ("i4", 2, 1, 0, 0, 0, 1.0),
        ],
        "interview__id string, crop_id int, harvested int, "
        "why__1 int, WHY__2 int, why__n98 int, produce double",
    )


def test_temp_crop_harvest(cases, crops):
    table = ft.temp_crop_harvest(
        crops, cases, "crop_id", [1, 2], "harvested",
        why_not_harvest_var="why", group_var="team",
    )
    assert table.stats.columns == [
        "team", "planted", "harvested", "why__1", "WHY__2", "why__n98",
    ]
    got = by(table.stats, "team")
    # B has other crops only and C no roster rows: both groups vanish.
    assert set(got) == {"A", None}
    # Reasons add stored values: 1 + 2 + 1, of which 1, 3 and 0.
    assert got["A"] == {
        "team": "A", "planted": 3, "harvested": 1 / 3,
        "why__1": 1 / 4, "WHY__2": 3 / 4, "why__n98": 0.0,
    }
    assert got[None]["planted"] == 1 and got[None]["why__1"] is None


def test_temp_crop_harvest_labels_from_questionnaire(cases, crops, tmp_path):
    lines = [
        {"variable": "other", "type": "single", "answers": [{"value": 1, "label": "x"}]},
        {"variable": "why", "type": "multi", "answers": [
            {"value": 1, "label": "Drought"}, {"value": 2, "label": "Pests"},
        ]},
    ]
    path = tmp_path / "questions.jsonl"
    path.write_text("\n".join(json.dumps(q) for q in lines))
    table = ft.temp_crop_harvest(
        crops, cases, "crop_id", [1, 2], "harvested",
        why_not_harvest_var="why", group_var="team", json_qnr_path=str(path),
    )
    labels = {c.name: c.label for c in table.columns}
    assert labels["why__1"] == "Drought" and labels["WHY__2"] == "Pests"
    # An option the questionnaire does not list keeps its column name.
    assert labels["why__n98"] == "why__n98"
    assert table.columns[-1].spanner == "Why not harvested (%)"


def test_perm_crop_harvest(cases, crops):
    table = ft.perm_crop_harvest(
        crops, cases, "crop_id", [1, 50], "produce", "harvested", group_var="team"
    )
    got = by(table.stats, "team")
    assert got["A"] == dict(team="A", planted=3, produced=2 / 3, harvested=2 / 3)
    assert got["B"] == dict(team="B", planted=1, produced=0.0, harvested=0.0)
    assert set(got) == {"A", "B"}


@pytest.fixture(scope="module")
def sales(spark):
    return spark.createDataFrame(
        [
            ("i1", 1, 1, None, "a", 3.0, None),
            ("i1", 2, 1, -98.0, None, None, None),
            ("i1", 3, 2, None, None, None, None),
            ("i1", None, 1, None, "a", None, "a"),
            ("i2", 1, None, 7.0, None, -98.0, None),
            ("i3", 1, 2, None, "b", None, None),
            ("i4", 2, 2, 4.0, None, 4.0, None),
        ],
        "interview__id string, crop_id int, sold int, total double, "
        "natag__total string, unit double, natag__unit string",
    )


def test_temp_crop_sales(cases, sales):
    table = ft.temp_crop_sales(
        sales, cases, "crop_id", "sold",
        amt_sold_vars=["total", "unit"], amt_sold_dk_val=-98, group_var="team",
    )
    got = by(table.stats, "team")
    assert got["A"] == dict(
        team="A", harvested=4, sold=2 / 4, sales_miss=1 / 2, sales_dk=2 / 2
    )
    # Nothing sold, one tagged value: 1 / 0 and 0 / 0.
    assert got["B"] == dict(
        team="B", harvested=1, sold=0.0, sales_miss=math.inf, sales_dk=None
    )
    assert "C" not in got


def test_perm_crop_sales_keeps_all_crops_unless_asked(cases, sales):
    def run(**options):
        table = ft.perm_crop_sales(
            sales, cases, "crop_id", [2], "sold",
            amt_sold_vars="total", amt_sold_dk_val=-98, group_var="team", **options,
        )
        return by(table.stats, "team")

    assert run()["A"]["harvested"] == 4 and run()["A"]["sales_dk"] == 1 / 2
    filtered = run(filter_crops=True)
    assert set(filtered) == {"A", None} and filtered["A"]["harvested"] == 1


@pytest.fixture(scope="module")
def animals(spark):
    return spark.createDataFrame(
        [
            # id, 10, 12, 13, 14, 51, 52, 53
            ("i1", 1, 0, 2, None, 1, 1, 0),
            ("i2", None, None, None, None, 0, None, 0),
            ("i3", 0, 0, 0, 0, 0, 0, 0),
            ("i4", 0, 1, 0, 0, 0, 1, 1),
        ],
        "interview__id string, animal__10 int, animal__12 int, animal__13 int, "
        "animal__14 int, animal__51 int, animal__52 int, animal__53 int",
    )


def test_livestock_ownership(cases, animals):
    got = by(ft.livestock_ownership(animals, "animal", cases, "team").stats, "team")
    # A ranked option adds its rank: 1 + 2 + 1 + 1.
    assert got["A"] == dict(team="A", n_hholds=2, owns_animals=1, avg_animals=5.0)
    assert got["B"] == dict(team="B", n_hholds=1, owns_animals=0, avg_animals=None)
    assert got["C"] == dict(team="C", n_hholds=1, owns_animals=0, avg_animals=None)


def test_livestock_ownership_without_option_columns(cases, animals):
    got = by(ft.livestock_ownership(animals, "absent", cases, "team").stats, "team")
    assert got["A"] == dict(team="A", n_hholds=2, owns_animals=0, avg_animals=None)


def test_cow_displacement(cases, animals):
    got = by(ft.cow_displacement(animals, cases, "animal", group_var="team").stats, "team")
    assert got["A"] == dict(
        team="A", n_own_cattle=1, n_types=3, bull=1 / 3, cow=0.0, steer_heifer=0.0, calf=0.0
    )
    assert got[None]["cow"] == 1.0
    assert got["C"] == dict(
        team="C", n_own_cattle=0, n_types=0, bull=None, cow=None, steer_heifer=None, calf=None
    )


def test_hen_displacement(cases, animals):
    got = by(ft.hen_displacement(animals, cases, "animal", group_var="team").stats, "team")
    assert got["A"] == dict(
        team="A", n_own_chicken=1, n_types=2, cock=1 / 2, hen=1 / 2, pullet=0.0
    )
    assert got[None] == dict(
        team=None, n_own_chicken=1, n_types=2, cock=0.0, hen=1 / 2, pullet=1 / 2
    )


def test_anim_prod_sales(spark, cases):
    livestock = spark.createDataFrame(
        [
            ("i1", 1, 1, 1, None, "a"),
            ("i1", 9, 1, 2, None, None),
            ("i1", None, 1, 1, -98.0, None),
            ("i2", 2, None, None, 5.0, None),
            ("i3", 9, 1, 1, 1.0, None),
        ],
        "interview__id string, anim_id int, produced int, sold int, "
        "amount double, natag__amount string",
    )
    table = ft.anim_prod_sales(
        livestock, cases, "anim_id", [1, 2], "produced", sold_var="sold",
        amt_sold_vars="amount", amt_sold_dk_val=-98, group_var="team",
        table_title="Milk", anim_type_label="Cows",
    )
    got = by(table.stats, "team")
    # Production and sales count over all animals: 3 produced, 2 listed animals.
    assert got["A"] == dict(
        team="A", n_anim=2, produced=3 / 2, sold=2 / 3, sales_miss=1 / 2, sales_dk=1 / 2
    )
    assert got["B"]["n_anim"] == 0 and got["B"]["produced"] == math.inf
    assert got["C"] == dict(
        team="C", n_anim=0, produced=None, sold=None, sales_miss=None, sales_dk=None
    )
    assert table.title == "Milk" and table.columns[0].label == "Cows (N)"


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame(
        [
            ("i1", 1, None, "a"),
            ("i1", 1, 3.0, None),
            ("i1", None, -98.0, None),
            ("i2", 2, None, None),
            ("i3", 2, None, "a"),
            ("i4", 1, 2.0, None),
        ],
        "interview__id string, sold int, amount double, natag__amount string",
    )


@pytest.fixture(scope="module")
def households(spark):
    return spark.createDataFrame(
        [
            # id, practice, item__1, item__2, temp, perm, processed, grew, paid__1, paid__2, free__1
            ("i1", 1, 1, 1, 1, None, 1, 1, 0, 0, 0),
            ("i2", 1, None, 1, None, 0, 2, 1, 1, None, 1),
            ("i3", None, 0, 0, 0, 0, None, 2, 0, 1, 0),
            ("i4", 2, 1, 0, 0, 1, 1, None, 0, 0, 1),
        ],
        "interview__id string, practice int, item__1 int, item__2 int, temp int, perm int, "
        "processed int, grew int, paid__1 int, paid__2 int, free__1 int",
    )


def test_other_prod_sales(cases, households, products):
    table = ft.other_prod_sales(
        households, products, cases, "practice", products_var="item", sold_var="sold",
        amt_sold_vars="amount", amt_sold_dk_val=-98, group_var="team", table_title="Fish",
    )
    got = by(table.stats, "team")
    # "Any sold" is one flag per group: 1 over 2 practicing households.
    assert got["A"] == dict(
        team="A", n_hholds=2, practice=1.0, n_products=3,
        sold=1 / 2, sales_miss=1.0, sales_dk=1.0,
    )
    assert got["B"] == dict(
        team="B", n_hholds=1, practice=0.0, n_products=0,
        sold=None, sales_miss=math.inf, sales_dk=None,
    )
    # The NULL team finds its product statistics.
    assert got[None]["sold"] == math.inf and got[None]["sales_miss"] == 0.0
    assert got["C"] == dict(
        team="C", n_hholds=1, practice=0.0, n_products=0,
        sold=None, sales_miss=None, sales_dk=None,
    )


def test_process_crop_prod(cases, households, products):
    table = ft.process_crop_prod(
        households, "temp", "perm", "processed", products_var="item", cases=cases,
        product_df=products, sold_var="sold", amt_sold_vars="amount",
        amt_sold_dk_val=-98, group_var="team",
    )
    got = by(table.stats, "team")
    # i1 produces although the permanent answer is missing; i2 is unknown.
    assert got["A"] == dict(
        team="A", produced=1, processed=1.0, n_products=3.0,
        any_sales=1.0, sales_miss=1 / 2, sales_dk=1 / 2,
    )
    assert got["B"] == dict(
        team="B", produced=0, processed=None, n_products=None,
        any_sales=None, sales_miss=math.inf, sales_dk=None,
    )


def test_crop_labor(spark, cases, households):
    members = spark.createDataFrame(
        [("i1", 1), ("i1", None), ("i2", 2), ("i2", 2), ("i3", 2), ("i4", None), ("i4", 2)],
        "interview__id string, worked int",
    )
    table = ft.crop_labor(
        households, cases, "grew", paid_var="paid", free_var="free",
        members_df=members, member_worked_var="worked", group_var="team",
    )
    got = by(table.stats, "team")
    # i1: household only. i2: paid block partly missing counts as no, free yes.
    assert got["A"] == dict(
        team="A", grew_crops=2, hhold_only=1 / 2, external_only=1 / 2,
        hhold_labor=1 / 2, paid_labor=0.0, free_labor=1 / 2,
    )
    assert got["B"]["grew_crops"] == 0
    assert got["B"]["external_only"] == math.inf and got["B"]["hhold_labor"] is None
    # i4: whether a member worked is unknown, so it is in neither "only" group.
    assert got[None]["external_only"] is None and got[None]["free_labor"] == math.inf
    assert all(v is None for k, v in got["C"].items() if k not in ("team", "grew_crops"))


def test_livestock_labor(spark, cases):
    hhold = spark.createDataFrame(
        [("i1", 1), ("i2", 1), ("i3", 2), ("i4", None)], "interview__id string, have int"
    )
    labor = spark.createDataFrame(
        [
            ("i1", 1, 2), ("i1", 2, 1), ("i1", 4, 0), ("i1", None, 3),
            ("i2", 5, 1), ("i2", 5, 2), ("i2", 1, None),
            ("i3", 4, 1), ("i4", 3, 1), ("i4", 9, 1),
        ],
        "interview__id string, labor_id int, workers int",
    )
    table = ft.livestock_labor_tbl(
        hhold, cases, "have", anim_labor_df=labor, anim_labor_id_var="labor_id",
        anim_labor_var="workers", group_var="team",
    )
    got = by(table.stats, "team")
    # i2 lists paid labor twice, so it is not "external only".
    assert got["A"] == dict(
        team="A", have_anim=2, hhold_only=1 / 2, external_only=0.0,
        hhold_labor=1 / 4, paid_labor=2 / 4, free_labor=0.0,
    )
    assert got["B"]["external_only"] == math.inf and got["B"]["free_labor"] == 1.0
    assert got[None]["hhold_only"] == math.inf and got[None]["hhold_labor"] == 1.0
    assert got["C"]["have_anim"] == 0 and got["C"]["hhold_labor"] is None


def test_sector_labor(spark, cases):
    hhold = spark.createDataFrame(
        [
            ("i1", 1, 1, 0, 0, 0, 0), ("i2", 1, 0, 0, 0, 1, None),
            ("i3", 1, None, 0, 0, 1, 0), ("i4", 2, 0, None, 1, 0, None),
        ],
        "interview__id string, fish int, labor__1 int, labor__2 int, labor__3 int, "
        "labor__4 int, labor__5 int",
    )
    table = ft.sector_labor(
        hhold, "fish", cases=cases, labor_var="labor", group_var="team",
        table_title="Fishery labor", sector_label="Fish",
    )
    got = by(table.stats, "team")
    assert got["A"] == dict(
        team="A", produce=2, hhold_only=1 / 2, external_only=1 / 2,
        hhold_labor=1 / 2, paid_labor=0.0, free_labor=1 / 2,
    )
    # Household labor unknown: neither household nor external only.
    assert got["B"] == dict(
        team="B", produce=1, hhold_only=0.0, external_only=0.0,
        hhold_labor=0.0, paid_labor=0.0, free_labor=1.0,
    )
    assert got[None]["hhold_labor"] == math.inf and got[None]["hhold_only"] is None
    assert got["C"]["produce"] == 0 and got["C"]["hhold_only"] is None


def test_income_sources(spark, cases):
    hhold = spark.createDataFrame(
        [("i1", 1, None), ("i2", None, 2), ("i3", 2, 2), ("i4", 2, 1)],
        "interview__id string, crops int, livestock int",
    )
    temp = spark.createDataFrame(
        [("i1", 1), ("i1", 1), ("i1", 2), ("i2", None), ("i3", 1)],
        "interview__id string, sold int",
    )
    perm = spark.createDataFrame([("i2", 1)], "interview__id string, sold int")
    processed = spark.createDataFrame([("i4", 1), ("i4", 1)], "interview__id string, sold int")
    animals = spark.createDataFrame(
        [
            ("i1", 0, 2, None, None, 1, None),
            ("i1", 3, 1, None, 1, 1, None),
            ("i2", None, None, 2, None, 2, 1),
            ("i4", 0, 2, 0, 2, 2, 2),
        ],
        "interview__id string, live int, killed int, poultry int, pkilled int, milk int, eggs int",
    )
    other = spark.createDataFrame([("i4", 1), ("i4", 1)], "interview__id string, sold int")
    table = ft.income_sources(
        hhold, "crops", "livestock", temp, "sold",
        perm_crop_df=perm, perm_crop_var="sold",
        processed_df=processed, processed_var="sold",
        anim_df=animals, sold_live_anim_var="live", slaughter_anim_var="killed",
        sold_live_poultry_var="poultry", slaughter_poultry_var="pkilled",
        milk_var="milk", eggs_var="eggs",
        oth_anim_prod_df=other, oth_anim_var="sold", cases=cases, group_var="team",
    )
    got = by(table.stats, "team")
    # Crops count sales, animals count households: i1 and i2 sold live animals.
    assert got["A"] == dict(
        team="A", n_hholds=2, n_any_ag=1, temp_crop=2.0, perm_crop=1.0, processed=0.0,
        anim_sold=2.0, anim_killed=1.0, milk_sold=1.0, eggs_sold=1.0, anim_prod_sold=0.0,
    )
    assert got["B"]["n_any_ag"] == 0 and got["B"]["temp_crop"] == math.inf
    assert got[None]["processed"] == 2.0 and got[None]["anim_prod_sold"] == 1.0
    assert got["C"]["n_hholds"] == 1 and got["C"]["temp_crop"] is None


def test_true_false_answers_count_like_codes(spark, cases, animals, crops):
    from pyspark.sql import functions as F

    yes_no = animals.select(
        "interview__id", *((F.col(c) == 1).alias(c) for c in animals.columns[1:])
    )
    coded = animals.select(
        "interview__id", *((F.col(c) == 1).cast("int").alias(c) for c in animals.columns[1:])
    )
    for report in (ft.cow_displacement, ft.hen_displacement):
        assert by(report(yes_no, cases, "animal", group_var="team").stats, "team") == by(
            report(coded, cases, "animal", group_var="team").stats, "team"
        )
    assert by(ft.livestock_ownership(yes_no, "animal", cases, "team").stats, "team") == by(
        ft.livestock_ownership(coded, "animal", cases, "team").stats, "team"
    )
    harvested = crops.withColumn("harvested", F.col("harvested") == 1)

    def run(frame):
        return by(
            ft.perm_crop_harvest(
                frame, cases, "crop_id", [1, 50], "produce", "harvested", group_var="team"
            ).stats,
            "team",
        )

    assert run(harvested) == run(crops)


def test_interview_as_group(cases, animals):
    got = by(
        ft.livestock_ownership(animals, "animal", cases, "interview__id").stats, "interview__id"
    )
    assert got["i1"]["avg_animals"] == 5.0 and got["i5"]["n_hholds"] == 1


def test_three_amount_variables_are_an_error(cases, sales):
    with pytest.raises(ValueError, match="one or two"):
        ft.temp_crop_sales(
            sales, cases, "crop_id", "sold", amt_sold_vars=["total", "unit", "sold"],
            amt_sold_dk_val=-98, group_var="team",
        )
