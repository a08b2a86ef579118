"""Display projection, dictionary and stored reports."""

import math

import pytest
from helpers import TESTDATA, rows
from pyspark.sql import functions as F

from fieldtally.catalog.reports import REPORTS, VARIANTS, report_table
from fieldtally.plans.layouts import LAYOUTS
from fieldtally.plans.table import format_cell

SF_DIR = f"{TESTDATA}/sf0.001"


def test_format_cell(spark):
    df = spark.createDataFrame(
        [(0.12345,), (12.5,), (None,), (math.inf,), (-math.inf,), (0.0,)], "x double"
    )
    shares = [r[0] for r in df.select(format_cell(F.col("x"), "%")).collect()]
    assert shares == ["12.3", "1,250.0", "---", "Inf", "-Inf", "0.0"]
    averages = [r[0] for r in df.select(format_cell(F.col("x"), "AVG")).collect()]
    assert averages == ["0.1", "12.5", "---", "Inf", "-Inf", "0.0"]
    counts = spark.createDataFrame([(1234567,), (None,)], "n long")
    assert [r[0] for r in counts.select(format_cell(F.col("n"), "N")).collect()] == [
        "1234567", "---",
    ]
    doubles = spark.createDataFrame([(12345678.0,)], "n double")
    assert doubles.select(format_cell(F.col("n"), "N")).first()[0] == "12345678"
    with pytest.raises(ValueError):
        format_cell(F.col("x"), "money")


@pytest.mark.parametrize("key", [*REPORTS, *VARIANTS])
def test_every_statistic_is_described(spark, key):
    table = report_table(spark, SF_DIR, key)
    described = [c.name for c in table.columns]
    assert sorted([table.group_var, *described]) == sorted(table.stats.columns)
    assert table.title
    layout = LAYOUTS[table.report]
    assert set(layout.footnotes) <= set(layout.columns) | set(layout.spanners)
    assert all("{" not in c.label for c in table.columns)


def test_display_order_and_text(spark):
    shown = report_table(spark, SF_DIR, "plots_per_parcel").display()
    teams = [r["team"] for r in shown.collect()]
    assert teams[-1] == "---" and teams[:-1] == sorted(teams[:-1])
    assert all(t == "string" for _, t in shown.dtypes)


def test_dictionary(spark):
    table = report_table(spark, SF_DIR, "plot_gps")
    entries = {r["statistic"]: r for r in rows(table.dictionary())}
    assert entries["why_no_gps__n98"]["label"] == "Don't know (-98)"
    assert entries["why_no_gps__n98"]["spanner"] == "Why not measured (%)"
    assert entries["plots"]["kind"] == "N" and entries["plots"]["spanner"] is None
    assert [r["position"] for r in rows(table.dictionary())] == list(range(1, 10))
    notes = {r["statistic"]: r["footnote"] for r in rows(
        report_table(spark, SF_DIR, "income_sources").dictionary())}
    assert notes["n_hholds"] is None and "number with sales" in notes["milk_sold"]


def test_labelled_cells(spark):
    table = report_table(spark, SF_DIR, "crop_types")
    cells = rows(table.labelled_cells())
    assert len(cells) == 3 * table.stats.count()
    share = next(c for c in cells if c["statistic"] == "crop_temp" and c["value"])
    assert share["text"] == f"{share['value'] * 100:.1f}" and share["label"] == "Temporary"


def test_write(spark, tmp_path):
    table = report_table(spark, SF_DIR, "plots_per_parcel")
    path = str(tmp_path / "report")
    table.write(path)
    stored = spark.read.parquet(f"{path}/stats")
    assert sorted(map(str, stored.collect())) == sorted(map(str, table.stats.collect()))
    assert spark.read.parquet(f"{path}/dictionary").count() == 3
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        table.write(path)
    table.write(path, mode="overwrite")
