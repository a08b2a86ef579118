"""The reports as plain SQL, in their direct form.

Rosters are joined row by row to the cases and aggregated afterwards, unlike
the library, which rolls rosters up first.  The frames come as CTEs named like
the frames; ``{g}`` stands for the group column.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class ReportSql:
    frames: tuple[str, ...]
    body: str

    def text(self, group_var: str) -> str:
        return self.body.replace("{g}", group_var)


def share(numerator: str, denominator: str) -> str:
    """0/0 is NULL, more than 0 over 0 is infinity."""
    return (
        f"CASE WHEN ({denominator}) = 0 THEN "
        f"CASE WHEN ({numerator}) > 0 THEN CAST('infinity' AS DOUBLE) END "
        f"ELSE CAST(({numerator}) AS DOUBLE) / CAST(({denominator}) AS DOUBLE) END"
    )


def yes(condition: str) -> str:
    """How many rows satisfy the condition."""
    return f"CAST(COALESCE(SUM(CASE WHEN {condition} THEN 1 ELSE 0 END), 0) AS BIGINT)"


def added(value: str) -> str:
    return f"CAST(COALESCE(SUM({value}), 0) AS BIGINT)"


def some(condition: str) -> str:
    """1 if the condition holds for any row, else 0."""
    return f"COALESCE(MAX(CASE WHEN {condition} THEN 1 ELSE 0 END), 0)"


N = "COUNT(*)"
_GPS = "gps_area = -9999 OR gps_area = -999999999 OR natag__gps_area IS NOT NULL"
_REASONS = (("why_no_gps__1", 1), ("why_no_gps__2", 2), ("why_no_gps__3", 3),
            ("why_no_gps__4", 4), ("why_no_gps__5", 5), ("why_no_gps__6", 6),
            ("why_no_gps__n98", -98))
_MISS2 = "natag__amt_total IS NOT NULL OR natag__amt_unit IS NOT NULL"
_DK2 = "amt_total = -98 OR amt_unit = -98"
_ANIMALS = ("animal__10", "animal__12", "animal__13", "animal__14",
            "animal__51", "animal__52", "animal__53")


def _plus(columns: tuple[str, ...]) -> str:
    return " + ".join(f"COALESCE({c}, 0)" for c in columns)


def _select(roster: str, columns: dict[str, str], where: str = "") -> str:
    items = ",\n  ".join(f"{expr} AS {name}" for name, expr in columns.items())
    return (
        f"SELECT cases.{{g}} AS {{g}},\n  {items}\n"
        f"FROM cases LEFT JOIN {roster} ON cases.interview__id = {roster}.interview__id\n"
        f"{where}\nGROUP BY cases.{{g}}"
    )


def _one(roster: str, columns: dict[str, str], where: str = "") -> ReportSql:
    return ReportSql(("cases", roster), _select(roster, columns, where))


def _gps(roster: str, unit: str, condition: str, reasons: bool = True) -> ReportSql:
    columns = {unit: N, "not_measured": yes(condition)}
    if reasons:
        columns |= {
            name: share(yes(f"why_no_gps = {code}"), yes(condition))
            for name, code in _REASONS
        }
    return _one(roster, columns)


def _sales(miss: str, dk: str, where: str) -> ReportSql:
    return _one(
        "crop_sales",
        {
            "harvested": N,
            "sold": share(yes("sold = 1"), N),
            "sales_miss": share(yes(miss), yes("sold = 1")),
            "sales_dk": share(yes(dk), yes("sold = 1")),
        },
        where,
    )


def _mix(owners: str, options: dict[str, str]) -> ReportSql:
    n_types = added(_plus(tuple(options.values())))
    return _one(
        "hhold",
        {
            owners: yes(" OR ".join(f"{c} = 1" for c in options.values())),
            "n_types": n_types,
            **{name: share(yes(f"{c} = 1"), n_types) for name, c in options.items()},
        },
    )


_WHY_NOT = ("why_not__1", "why_not__2", "why_not__n98")

_OTHER_PROD = f"""
, a AS ({_select("hhold", {
    "n_hholds": N, "practice": yes("practice = 1"),
    "n_products": added(_plus(("products__1", "products__2")))})}),
b AS ({_select("products", {
    "sold": some("sold = 1"), "miss": some(_MISS2), "dk": some(_DK2)})})
SELECT a.{{g}} AS {{g}}, n_hholds, {share("practice", "n_hholds")} AS practice, n_products,
  {share("sold", "practice")} AS sold, {share("miss", "sold")} AS sales_miss,
  {share("dk", "sold")} AS sales_dk
FROM a LEFT JOIN b ON a.{{g}} IS NOT DISTINCT FROM b.{{g}}
"""

_PROCESS = f"""
, a AS ({_select("hhold", {
    "produced": yes("temp_any = 1 OR perm_any = 1"), "processed": yes("processed_any = 1"),
    "n_products": added(_plus(("proc__1", "proc__2")))})}),
b AS ({_select("products", {
    "any_sales": some("sold = 1"), "n_sold": yes("sold = 1"),
    "miss": yes(_MISS2), "dk": yes(_DK2)})})
SELECT a.{{g}} AS {{g}}, produced, {share("processed", "produced")} AS processed,
  {share("n_products", "produced")} AS n_products,
  {share("any_sales", "produced")} AS any_sales,
  {share("miss", "n_sold")} AS sales_miss, {share("dk", "n_sold")} AS sales_dk
FROM a LEFT JOIN b ON a.{{g}} IS NOT DISTINCT FROM b.{{g}}
"""

_CROP_LABOR = f"""
, h AS (
  SELECT cases.interview__id, MIN(cases.{{g}}) AS {{g}}, {yes("grew_crops = 1")} AS grew,
    {yes("paid__1 + paid__2 >= 1")} AS paid, {yes("free__1 >= 1")} AS free
  FROM cases LEFT JOIN hhold ON cases.interview__id = hhold.interview__id
  GROUP BY cases.interview__id
), m AS (
  SELECT cases.interview__id,
    CASE WHEN MAX(CASE WHEN worked = 1 THEN 1 ELSE 0 END) = 1 THEN 1
         WHEN COUNT(*) > COUNT(worked) THEN NULL ELSE 0 END AS hh
  FROM cases LEFT JOIN members ON cases.interview__id = members.interview__id
  GROUP BY cases.interview__id
)
SELECT {{g}}, {added("grew")} AS grew_crops,
  {share(yes("hh = 1 AND paid = 0 AND free = 0"), added("grew"))} AS hhold_only,
  {share(yes("hh = 0 AND (paid = 1 OR free = 1)"), added("grew"))} AS external_only,
  {share(yes("hh = 1"), added("grew"))} AS hhold_labor,
  {share(added("paid"), added("grew"))} AS paid_labor,
  {share(added("free"), added("grew"))} AS free_labor
FROM h JOIN m ON h.interview__id = m.interview__id GROUP BY {{g}}
"""

_LIVESTOCK_LABOR = f"""
, l AS (
  SELECT cases.interview__id, {some("labor_id IN (1, 2, 3) AND n_workers > 0")} AS hh,
    {yes("labor_id = 4 AND n_workers > 0")} AS free,
    {yes("labor_id = 5 AND n_workers > 0")} AS paid,
    {yes("labor_id IN (1, 2, 3, 4, 5) AND n_workers > 0")} AS nl
  FROM cases LEFT JOIN anim_labor ON cases.interview__id = anim_labor.interview__id
  GROUP BY cases.interview__id
)
SELECT cases.{{g}} AS {{g}}, {yes("have_anim = 1")} AS have_anim,
  {share(yes("hh = 1 AND free = 0 AND paid = 0"), yes("have_anim = 1"))} AS hhold_only,
  {share(yes("hh = 0 AND (free = 1 OR paid = 1)"), yes("have_anim = 1"))} AS external_only,
  {share(added("hh"), added("nl"))} AS hhold_labor,
  {share(added("free"), added("nl"))} AS free_labor,
  {share(added("paid"), added("nl"))} AS paid_labor
FROM cases LEFT JOIN hhold ON cases.interview__id = hhold.interview__id
  LEFT JOIN l ON cases.interview__id = l.interview__id
GROUP BY cases.{{g}}
"""

_HH = "(labor__1 = 1 OR labor__2 = 1 OR labor__3 = 1)"
_SECTOR_DEN = yes("raise_anim = 1")


def _per_case(alias: str, roster: str, columns: dict[str, str], where: str = "") -> str:
    items = ", ".join(f"{expr} AS {name}" for name, expr in columns.items())
    source = f"(SELECT * FROM {roster} {where}) r"
    return (
        f"{alias} AS (SELECT cases.interview__id, {items} FROM cases LEFT JOIN {source} "
        "ON cases.interview__id = r.interview__id GROUP BY cases.interview__id)"
    )


_SOLD = {"n": yes("sold = 1")}
_SALE_SHARES = {
    "temp_crop": added("tc.n"),
    "perm_crop": added("pc.n"),
    "processed": added("pr.n"),
    "anim_sold": yes("alive = 1 OR poultry_alive = 1"),
    "anim_killed": yes("killed = 1 OR poultry_dead = 1"),
    "milk_sold": added("milked"),
    "eggs_sold": added("egged"),
    "anim_prod_sold": yes("ot.n > 0"),
}
_ANY_AG = yes("grew_crops = 1 OR raise_anim = 1")
_INCOME = f"""
, {_per_case("tc", "crop_sales", _SOLD, "WHERE crop_id < 12")},
{_per_case("pc", "crop_sales", _SOLD, "WHERE crop_id >= 12")},
{_per_case("pr", "products", _SOLD, "WHERE product_id < 3")},
{_per_case("ot", "products", _SOLD, "WHERE product_id >= 3")},
{_per_case("lv", "livestock", {
    "alive": some("n_sold_live > 0"), "killed": some("slaughtered = 1"),
    "poultry_alive": some("n_poultry_live > 0"), "poultry_dead": some("poultry_killed = 1"),
    "milked": some("milk = 1"), "egged": some("eggs = 1")})}
SELECT cases.{{g}} AS {{g}}, COUNT(*) AS n_hholds, {_ANY_AG} AS n_any_ag,
  {", ".join(f"{share(expr, _ANY_AG)} AS {name}" for name, expr in _SALE_SHARES.items())}
FROM cases LEFT JOIN hhold ON cases.interview__id = hhold.interview__id
  {" ".join(f"LEFT JOIN {t} ON cases.interview__id = {t}.interview__id"
            for t in ("tc", "pc", "pr", "ot", "lv"))}
GROUP BY cases.{{g}}
"""

REPORT_SQL: dict[str, ReportSql] = {
    "parcels_per_hhold": _one(
        "parcels",
        {
            "interviews": "COUNT(DISTINCT cases.interview__id)",
            "parcels": N,
            "ag": share(yes("use__1 = 1 OR use__n98 = 1"), N),
            "non_ag": share(f"{N} - " + yes("use__1 = 1 OR use__n98 = 1"), N),
        },
    ),
    "parcels_per_hhold_no_use": _one(
        "parcels",
        {"interviews": "COUNT(DISTINCT cases.interview__id)", "parcels": N},
    ),
    "parcel_gps": _gps("parcels", "parcels", _GPS),
    "parcel_gps_no_reason": _gps("parcels", "parcels", _GPS, reasons=False),
    "plots_per_parcel": _one(
        "plots",
        {
            "n_parcels": "COUNT(DISTINCT CASE WHEN parcel_id IS NOT NULL "
            "THEN (cases.interview__id, parcel_id) END)",
            "n_plots": N,
            "mean_plots": share(
                N,
                "COUNT(DISTINCT CASE WHEN parcel_id IS NOT NULL "
                "THEN (cases.interview__id, parcel_id) END)",
            ),
        },
    ),
    "plot_use": _one(
        "plots",
        {
            "plots": N,
            **{f"plot_use__{v}": share(yes(f"plot_use = {v}"), N) for v in (1, 2, 3, 4)},
        },
    ),
    "plot_gps": _gps("plots", "plots", f"gps_area IS NULL OR {_GPS}"),
    "crops_per_plot": _one(
        "crops",
        {
            "n_plots": "COUNT(DISTINCT (cases.interview__id, parcel_id, plot_id))",
            "n_crops": N,
            "mean_crops": share(
                N, "COUNT(DISTINCT (cases.interview__id, parcel_id, plot_id))"
            ),
        },
    ),
    "crop_types": _one(
        "crops",
        {
            "n_crops": N,
            "crop_temp": share(yes("crop_type = 1"), N),
            "crop_perm": share(yes("crop_type = 2"), N),
        },
    ),
    "temp_crop_harvest": _one(
        "crops",
        {
            "planted": N,
            "harvested": share(yes("harvested = 1"), N),
            **{c: share(added(c), added(_plus(_WHY_NOT))) for c in _WHY_NOT},
        },
        "WHERE crop_id BETWEEN 0 AND 11",
    ),
    "temp_crop_sales": _sales(_MISS2, _DK2, "WHERE crop_id IS NOT NULL"),
    "temp_crop_sales_one_amount": _sales(
        "natag__amt_total IS NOT NULL", "amt_total = -98", "WHERE crop_id IS NOT NULL"
    ),
    "perm_crop_harvest": _one(
        "crops",
        {
            "planted": N,
            "produced": share(yes("n_produce > 0"), N),
            "harvested": share(yes("harvested = 1"), N),
        },
        "WHERE crop_id BETWEEN 12 AND 19",
    ),
    "perm_crop_sales": _sales(_MISS2, _DK2, "WHERE crop_id IS NOT NULL"),
    "perm_crop_sales_filtered": _sales(_MISS2, _DK2, "WHERE crop_id BETWEEN 12 AND 19"),
    "livestock_ownership": _one(
        "hhold",
        {
            "n_hholds": N,
            "owns_animals": yes(f"{_plus(_ANIMALS)} > 0"),
            "avg_animals": share(added(_plus(_ANIMALS)), yes(f"{_plus(_ANIMALS)} > 0")),
        },
    ),
    "cow_displacement": _mix(
        "n_own_cattle",
        {
            "bull": "animal__10",
            "cow": "animal__12",
            "steer_heifer": "animal__13",
            "calf": "animal__14",
        },
    ),
    "hen_displacement": _mix(
        "n_own_chicken",
        {"cock": "animal__51", "hen": "animal__52", "pullet": "animal__53"},
    ),
    "anim_prod_sales": _one(
        "livestock",
        {
            "n_anim": yes("anim_id IN (1, 2, 3)"),
            "produced": share(yes("produced = 1"), yes("anim_id IN (1, 2, 3)")),
            "sold": share(yes("sold = 1"), yes("produced = 1")),
            "sales_miss": share(yes("natag__amt_total IS NOT NULL"), yes("sold = 1")),
            "sales_dk": share(yes("amt_total = -98"), yes("sold = 1")),
        },
    ),
    "other_prod_sales": ReportSql(("cases", "hhold", "products"), _OTHER_PROD),
    "process_crop_prod": ReportSql(("cases", "hhold", "products"), _PROCESS),
    "crop_labor": ReportSql(("cases", "hhold", "members"), _CROP_LABOR),
    "livestock_labor": ReportSql(("cases", "hhold", "anim_labor"), _LIVESTOCK_LABOR),
    "sector_labor": _one(
        "hhold",
        {
            "produce": _SECTOR_DEN,
            "hhold_only": share(
                yes(f"{_HH} AND NOT labor__4 = 1 AND NOT labor__5 = 1"), _SECTOR_DEN
            ),
            "external_only": share(
                yes(f"NOT {_HH} AND (labor__4 = 1 OR labor__5 = 1)"), _SECTOR_DEN
            ),
            "hhold_labor": share(yes(_HH), _SECTOR_DEN),
            "free_labor": share(yes("labor__4 = 1"), _SECTOR_DEN),
            "paid_labor": share(yes("labor__5 = 1"), _SECTOR_DEN),
        },
    ),
    "income_sources": ReportSql(
        ("cases", "hhold", "crop_sales", "products", "livestock"), _INCOME
    ),
}
