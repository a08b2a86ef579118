"""Survey-shaped frames derived from the star-schema tables.

Each frame is one SQL text that Spark and DuckDB both run, over whole tables:
customers are interviewed households, suppliers are interviews without any
roster, orders are parcels and animals, line items are plots, crops and
products, and events are members' work reports.  Codes, tags and missing
answers are spread over the rows by arithmetic on the keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldtally.functions.labels import with_value_labels
from fieldtally.operators.rollup import declare_unique

TABLES = ("customer", "supplier", "orders", "lineitem", "events", "part")

CASES = """
SELECT concat('C', CAST(c_custkey AS STRING)) AS interview__id,
  CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE c_mktsegment END AS team,
  CAST(c_custkey % 200 AS STRING) AS enumerator
FROM {customer}
UNION ALL
SELECT concat('S', CAST(s_suppkey AS STRING)) AS interview__id,
  CASE WHEN s_nationkey < 5 THEN 'SUPPLY' WHEN s_nationkey < 20 THEN 'MACHINERY' END AS team,
  CAST(s_suppkey % 200 AS STRING) AS enumerator
FROM {supplier}
"""

PARCELS = """
SELECT concat('C', CAST(o_custkey AS STRING)) AS interview__id, o_orderkey AS parcel_id,
  CASE WHEN o_orderstatus = 'P' THEN NULL WHEN substr(o_orderpriority, 1, 1) = '1' THEN 1 ELSE 0 END AS use__1,
  CASE WHEN o_orderstatus = 'P' THEN NULL WHEN substr(o_orderpriority, 1, 1) = '2' THEN 1 ELSE 0 END AS use__2,
  CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderkey % 19 = 0 THEN 1 ELSE 0 END AS use__n98,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN -999999999.0
       WHEN o_orderkey % 7 = 0 THEN -9999.0 WHEN o_orderkey % 5 = 0 THEN NULL
       ELSE CAST(o_totalprice AS DOUBLE) END AS gps_area,
  CASE WHEN o_orderkey % 13 = 0 THEN 'a' END AS natag__gps_area,
  CASE WHEN o_orderkey % 13 = 0 OR o_orderkey % 11 = 0 OR o_orderkey % 7 = 0
       THEN CASE WHEN o_orderkey % 17 = 0 THEN -98
                 ELSE CAST(substr(o_orderpriority, 1, 1) AS INT) END END AS why_no_gps
FROM {orders}
"""

PLOTS = """
SELECT concat('C', CAST(o_custkey AS STRING)) AS interview__id,
  CASE WHEN l_orderkey % 29 = 0 THEN NULL ELSE l_orderkey END AS parcel_id,
  l_linenumber AS plot_id,
  CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 2
       WHEN 'N' THEN CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE 3 END END AS plot_use,
  CASE WHEN l_partkey % 13 = 0 THEN NULL WHEN l_partkey % 11 = 0 THEN -999999999.0
       WHEN l_partkey % 7 = 0 THEN -9999.0 WHEN l_partkey % 5 = 0 THEN NULL
       ELSE CAST(l_quantity AS DOUBLE) END AS gps_area,
  CASE WHEN l_partkey % 13 = 0 THEN 'a' END AS natag__gps_area,
  CASE WHEN l_partkey % 13 = 0 OR l_partkey % 7 = 0
       THEN CAST(l_suppkey % 4 + 1 AS INT) END AS why_no_gps
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
"""

CROPS = """
SELECT concat('C', CAST(o_custkey AS STRING)) AS interview__id,
  CASE WHEN l_orderkey % 29 = 0 THEN NULL ELSE l_orderkey END AS parcel_id,
  l_linenumber AS plot_id,
  CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE CAST(l_partkey % 20 AS INT) END AS crop_id,
  CASE WHEN l_partkey % 31 = 0 THEN NULL WHEN l_linestatus = 'F' THEN 1 ELSE 2 END AS crop_type,
  CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 2 END AS harvested,
  CASE WHEN l_returnflag = 'R' THEN CAST(l_suppkey % 2 AS INT) END AS why_not__1,
  CASE WHEN l_returnflag = 'R' THEN CAST(l_partkey % 3 AS INT) END AS why_not__2,
  CASE WHEN l_returnflag = 'R' THEN 0 END AS why_not__n98,
  CASE WHEN l_quantity > 40 THEN 0.0 ELSE CAST(l_quantity AS DOUBLE) END AS n_produce
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
"""

CROP_SALES = """
SELECT concat('C', CAST(o_custkey AS STRING)) AS interview__id,
  CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE CAST(l_partkey % 20 AS INT) END AS crop_id,
  CASE WHEN l_partkey % 23 = 0 THEN NULL WHEN l_linestatus = 'F' THEN 1 ELSE 2 END AS sold,
  CASE WHEN l_linestatus <> 'F' OR l_partkey % 13 = 0 THEN NULL WHEN l_partkey % 8 = 0 THEN -98.0
       ELSE CAST(l_extendedprice AS DOUBLE) END AS amt_total,
  CASE WHEN l_linestatus = 'F' AND l_partkey % 13 = 0 THEN 'a' END AS natag__amt_total,
  CASE WHEN l_linestatus <> 'F' OR l_suppkey % 6 = 0 THEN NULL WHEN l_suppkey % 9 = 0 THEN -98.0
       ELSE CAST(l_tax AS DOUBLE) END AS amt_unit,
  CASE WHEN l_linestatus = 'F' AND l_suppkey % 6 = 0 THEN 'a' END AS natag__amt_unit
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
"""

HHOLD = """
SELECT concat('C', CAST(c_custkey AS STRING)) AS interview__id,
  CASE WHEN c_custkey % 12 = 0 THEN NULL ELSE CAST(c_custkey % 2 AS INT) END AS animal__10,
  CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS animal__12,
  CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END AS animal__13,
  CASE WHEN c_custkey % 12 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN 1 ELSE 0 END AS animal__14,
  CASE WHEN c_custkey % 4 = 0 THEN 1 ELSE 0 END AS animal__51,
  CASE WHEN c_custkey % 6 = 0 THEN 1 ELSE 0 END AS animal__52,
  CASE WHEN c_custkey % 14 = 0 THEN NULL ELSE 0 END AS animal__53,
  CASE WHEN c_custkey % 25 = 0 THEN NULL WHEN c_acctbal > 3000 THEN 1 ELSE 2 END AS practice,
  CASE WHEN c_custkey % 3 = 1 THEN 1 ELSE 0 END AS products__1,
  CASE WHEN c_custkey % 8 = 1 THEN NULL ELSE CAST(c_custkey % 2 AS INT) END AS products__2,
  CASE WHEN c_custkey % 15 = 0 THEN NULL WHEN c_nationkey < 15 THEN 1 ELSE 0 END AS temp_any,
  CASE WHEN c_nationkey % 3 = 0 THEN 1 WHEN c_custkey % 6 = 0 THEN NULL ELSE 0 END AS perm_any,
  CASE WHEN c_acctbal < 0 THEN NULL WHEN c_custkey % 4 = 1 THEN 1 ELSE 2 END AS processed_any,
  CASE WHEN c_custkey % 4 = 1 THEN 1 END AS proc__1,
  CASE WHEN c_custkey % 4 = 1 THEN CAST(c_nationkey % 2 AS INT) END AS proc__2,
  CASE WHEN c_custkey % 18 = 0 THEN NULL WHEN c_custkey % 5 = 2 THEN 2 ELSE 1 END AS grew_crops,
  CAST(c_custkey % 2 AS INT) AS paid__1,
  CASE WHEN c_custkey % 10 = 1 THEN NULL ELSE 0 END AS paid__2,
  CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS free__1,
  CASE WHEN c_custkey % 16 = 0 THEN NULL WHEN c_mktsegment = 'BUILDING' THEN 2 ELSE 1 END AS have_anim,
  CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE CAST(c_custkey % 2 AS INT) END AS labor__1,
  CASE WHEN c_custkey % 4 = 0 THEN 1 ELSE 0 END AS labor__2,
  0 AS labor__3,
  CASE WHEN c_custkey % 6 = 0 THEN 1 ELSE 0 END AS labor__4,
  CASE WHEN c_custkey % 9 = 0 THEN NULL WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END AS labor__5,
  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(c_custkey % 2 AS INT) END AS raise_anim
FROM {customer}
"""

MEMBERS = """
SELECT concat('C', CAST(user_id AS STRING)) AS interview__id,
  CASE event_type WHEN 'purchase' THEN CASE WHEN user_id % 3 = 0 THEN 1 ELSE 2 END
       WHEN 'error' THEN CASE WHEN user_id % 4 = 0 THEN NULL ELSE 2 END
       ELSE 2 END AS worked
FROM {events}
"""

LIVESTOCK = """
SELECT concat('C', CAST(o_custkey AS STRING)) AS interview__id,
  CASE WHEN o_orderkey % 21 = 0 THEN NULL ELSE CAST(o_orderkey % 10 AS INT) END AS anim_id,
  CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 END AS produced,
  CASE WHEN o_orderstatus = 'F' AND o_orderkey % 2 = 0 THEN 1 WHEN o_orderstatus = 'F' THEN 2 END AS sold,
  CASE WHEN o_orderstatus <> 'F' OR o_orderkey % 6 = 0 THEN NULL WHEN o_orderkey % 8 = 0 THEN -98.0
       ELSE CAST(o_totalprice AS DOUBLE) END AS amt_total,
  CASE WHEN o_orderstatus = 'F' AND o_orderkey % 6 = 0 THEN 'a' END AS natag__amt_total,
  CASE WHEN o_orderkey % 15 = 0 THEN NULL WHEN o_orderkey % 9 = 0 THEN 2 ELSE 0 END AS n_sold_live,
  CASE WHEN o_orderkey % 20 = 3 THEN 1 ELSE 2 END AS slaughtered,
  CASE WHEN o_orderkey % 25 = 0 THEN 4 END AS n_poultry_live,
  CASE WHEN o_orderkey % 30 = 1 THEN 1 END AS poultry_killed,
  CASE WHEN o_orderkey % 12 = 5 THEN 1 ELSE 2 END AS milk,
  CASE WHEN o_orderkey % 18 = 5 THEN 1 END AS eggs
FROM {orders}
"""

PRODUCTS = """
SELECT concat('C', CAST(o_custkey AS STRING)) AS interview__id,
  CAST(l_partkey % 6 AS INT) AS product_id,
  CASE WHEN l_partkey % 23 = 0 THEN NULL WHEN l_returnflag = 'A' THEN 1 ELSE 2 END AS sold,
  CASE WHEN l_returnflag <> 'A' OR l_partkey % 13 = 0 THEN NULL WHEN l_partkey % 8 = 0 THEN -98.0
       ELSE CAST(l_extendedprice AS DOUBLE) END AS amt_total,
  CASE WHEN l_returnflag = 'A' AND l_partkey % 13 = 0 THEN 'a' END AS natag__amt_total,
  CASE WHEN l_returnflag <> 'A' THEN NULL WHEN l_suppkey % 9 = 0 THEN -98.0
       ELSE CAST(l_tax AS DOUBLE) END AS amt_unit,
  CAST(NULL AS STRING) AS natag__amt_unit
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
"""

ANIM_LABOR = """
SELECT concat('C', CAST(o_custkey AS STRING)) AS interview__id,
  CAST(o_orderkey % 5 + 1 AS INT) AS labor_id,
  CASE WHEN o_orderkey % 14 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN 0
       ELSE CAST(o_orderkey % 4 AS INT) END AS n_workers
FROM {orders}
"""

FRAMES: dict[str, str] = {
    "cases": CASES,
    "parcels": PARCELS,
    "plots": PLOTS,
    "crops": CROPS,
    "crop_sales": CROP_SALES,
    "hhold": HHOLD,
    "members": MEMBERS,
    "livestock": LIVESTOCK,
    "products": PRODUCTS,
    "anim_labor": ANIM_LABOR,
}

#: One row per customer, so one per interview.
ONE_ROW_PER_INTERVIEW = {"hhold"}

_REASONS = [(code, f"Reason {code}") for code in range(1, 6)]
_WHY_NO_GPS = [*_REASONS, (6, "Never used"), (-98, "Don't know")]
_PLOT_USE = [(1, "Crops"), (2, "Pasture"), (3, "Fallow"), (4, "Forest")]

LABELS: dict[tuple[str, str], list[tuple[int, str]]] = {
    ("parcels", "why_no_gps"): _WHY_NO_GPS,
    ("plots", "why_no_gps"): _WHY_NO_GPS,
    ("plots", "plot_use"): _PLOT_USE,
}


def survey_frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One survey frame over the tables in ``sf_dir``, with its value labels."""
    text = FRAMES[name]
    tables = {
        t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
        for t in TABLES
        if "{" + t + "}" in text
    }
    df = spark.sql(text, **tables)
    for (frame, variable), labels in LABELS.items():
        if frame == name:
            df = with_value_labels(df, variable, labels)
    return declare_unique(df) if name in ONE_ROW_PER_INTERVIEW else df


def survey_cte(*names: str) -> str:
    """WITH clause that defines the named frames over views of the tables."""
    views = {t: t for t in TABLES}
    parts = [f"{name} AS ({FRAMES[name].strip().format(**views)})" for name in names]
    return "WITH " + ",\n".join(parts) + "\n"
