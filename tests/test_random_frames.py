"""Reports on random small frames against the direct SQL on DuckDB.

The frames hold NULL and repeated keys, NULL teams, unmatched cases and
rosters, all kinds of missing amounts, and one interview with most of the rows.
"""

import random

import duckdb
import pyarrow as pa
import pytest
from helpers import duckdb_result, spark_result
from pyspark.sql import types as T

from fieldtally.catalog.frames import LABELS
from fieldtally.catalog.report_sql import REPORT_SQL
from fieldtally.catalog.reports import REPORTS, VARIANTS
from fieldtally.functions.labels import with_value_labels

YES_NO = [1, 2, None]
DUMMY = [0, 1, None]
AREA = [-9999.0, -999999999.0, None, 1.5, 20.0]
AMOUNT = [-98.0, None, 0.0, 7.5]
TAG = [None, None, "a", "z"]

# Column name -> (SQL type, values to draw from), interview id left out.
ROSTERS = {
    "parcels": {
        "parcel_id": ("bigint", [1, 2, 3]),
        "use__1": ("int", DUMMY), "use__2": ("int", DUMMY), "use__n98": ("int", DUMMY),
        "gps_area": ("double", AREA), "natag__gps_area": ("string", TAG),
        "why_no_gps": ("int", [1, 2, 6, -98, None]),
    },
    "plots": {
        "parcel_id": ("bigint", [1, 2, None]), "plot_id": ("int", [1, 2, None]),
        "plot_use": ("int", [1, 2, 3, None]),
        "gps_area": ("double", AREA), "natag__gps_area": ("string", TAG),
        "why_no_gps": ("int", [1, 2, 6, -98, None]),
    },
    "crops": {
        "parcel_id": ("bigint", [1, 2, None]), "plot_id": ("int", [1, 2, None]),
        "crop_id": ("int", [0, 11, 12, 19, 40, None]), "crop_type": ("int", YES_NO),
        "harvested": ("int", YES_NO), "why_not__1": ("int", DUMMY),
        "why_not__2": ("int", [0, 1, 2, 3, None]), "why_not__n98": ("int", DUMMY),
        "n_produce": ("double", [0.0, 3.0, None]),
    },
    "crop_sales": {
        "crop_id": ("int", [0, 11, 12, 19, None]), "sold": ("int", YES_NO),
        "amt_total": ("double", AMOUNT), "natag__amt_total": ("string", TAG),
        "amt_unit": ("double", AMOUNT), "natag__amt_unit": ("string", TAG),
    },
    "members": {"worked": ("int", YES_NO)},
    "livestock": {
        "anim_id": ("int", [1, 2, 9, None]), "produced": ("int", YES_NO),
        "sold": ("int", YES_NO), "amt_total": ("double", AMOUNT),
        "natag__amt_total": ("string", TAG), "n_sold_live": ("int", [0, 2, None]),
        "slaughtered": ("int", YES_NO), "n_poultry_live": ("int", [0, 4, None]),
        "poultry_killed": ("int", YES_NO), "milk": ("int", YES_NO), "eggs": ("int", YES_NO),
    },
    "products": {
        "product_id": ("int", [0, 2, 3, 5]), "sold": ("int", YES_NO),
        "amt_total": ("double", AMOUNT), "natag__amt_total": ("string", TAG),
        "amt_unit": ("double", AMOUNT), "natag__amt_unit": ("string", TAG),
    },
    "anim_labor": {
        "labor_id": ("int", [1, 3, 4, 5, 9, None]), "n_workers": ("int", [0, 1, 3, None]),
    },
}
HHOLD = {
    **{f"animal__{c}": ("int", [0, 1, 2, None]) for c in (10, 12, 13, 14, 51, 52, 53)},
    **{c: ("int", YES_NO) for c in (
        "practice", "temp_any", "perm_any", "processed_any", "grew_crops", "have_anim",
        "raise_anim")},
    **{c: ("int", DUMMY) for c in (
        "products__1", "products__2", "proc__1", "proc__2", "paid__1", "paid__2", "free__1",
        "labor__1", "labor__2", "labor__3", "labor__4", "labor__5")},
}
ARROW = {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "string": pa.string()}


def draw(rng, columns, ids):
    return [(i, *(rng.choice(values) for _, values in columns.values())) for i in ids]


def random_frames(seed):
    """Frame name -> (column types, rows)."""
    rng = random.Random(seed)
    ids = [f"i{n}" for n in range(rng.randint(1, 12))]
    cases = [(i, rng.choice(["A", "B", "C", None]), rng.choice(["1", "2"])) for i in ids]
    frames = {
        "cases": ({"interview__id": "string", "team": "string", "enumerator": "string"}, cases)
    }
    pool = [*ids, "elsewhere", None]
    for name, columns in ROSTERS.items():
        n = rng.choice([0, 3, 30])
        # One interview holds about half of the rows.
        picked = [ids[0] if rng.random() < 0.5 else rng.choice(pool) for _ in range(n)]
        types = {"interview__id": "string", **{c: t for c, (t, _) in columns.items()}}
        frames[name] = (types, draw(rng, columns, picked))
    with_hhold = [i for i in [*ids, "elsewhere"] if rng.random() < 0.8]
    types = {"interview__id": "string", **{c: t for c, (t, _) in HHOLD.items()}}
    frames["hhold"] = (types, draw(rng, HHOLD, with_hhold))
    return frames


@pytest.fixture
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("seed", range(4))
def test_reports_equal_direct_sql(spark, few_partitions, seed):
    frames = random_frames(seed)
    connection = duckdb.connect()
    spark_frames = {}
    for name, (types, data) in frames.items():
        columns = [
            pa.array([row[i] for row in data], ARROW[t]) for i, t in enumerate(types.values())
        ]
        connection.register(name, pa.table(columns, names=list(types)))
        schema = ", ".join(f"{c} {t}" for c, t in types.items())
        df = spark.createDataFrame(data, schema).repartition(3)
        for (frame, variable), labels in LABELS.items():
            if frame == name:
                df = with_value_labels(df, variable, labels)
        spark_frames[name] = df
    for group_var in ("team", "enumerator"):
        for key, report in {**REPORTS, **VARIANTS}.items():
            stats = report(lambda name: spark_frames[name], group_var).stats
            # Texts start with a further CTE or with SELECT; one CTE goes before.
            sql = "WITH nothing AS (SELECT 1)\n" + REPORT_SQL[key].text(group_var)
            expected = duckdb_result(connection, sql)
            assert spark_result(stats) == expected, (key, group_var)
