"""The 21 reports bound to the survey frames."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import fieldtally as ft
from fieldtally.catalog.frames import survey_frame

TEMPORARY_CROPS = list(range(12))
PERMANENT_CROPS = list(range(12, 20))
USE_VALS = [1, -98]
ANIM_VALS = [1, 2, 3]
DK = -98
AMOUNTS = ["amt_total", "amt_unit"]

Frame = Callable[[str], DataFrame]


def _parcels_per_hhold(f: Frame, g: str, with_use: bool = True) -> ft.MonitoringTable:
    use = {"use_var": "use", "use_vals": USE_VALS} if with_use else {}
    return ft.parcels_per_hhold(f("parcels"), f("cases"), group_var=g, **use)


def _parcel_gps(f: Frame, g: str, with_reason: bool = True) -> ft.MonitoringTable:
    reason = {"why_no_gps_var": "why_no_gps"} if with_reason else {}
    return ft.parcel_gps(f("parcels"), f("cases"), "gps_area", group_var=g, **reason)


def _plots_per_parcel(f: Frame, g: str) -> ft.MonitoringTable:
    return ft.plots_per_parcel(f("plots"), f("cases"), "parcel_id", g)


def _plot_use(f: Frame, g: str) -> ft.MonitoringTable:
    return ft.plot_use(f("plots"), f("cases"), "plot_use", g)


def _plot_gps(f: Frame, g: str) -> ft.MonitoringTable:
    return ft.plot_gps(
        f("plots"), f("cases"), "gps_area", why_no_gps_var="why_no_gps", group_var=g
    )


def _crops_per_plot(f: Frame, g: str) -> ft.MonitoringTable:
    return ft.crops_per_plot(f("crops"), f("cases"), "parcel_id", "plot_id", g)


def _crop_types(f: Frame, g: str) -> ft.MonitoringTable:
    return ft.crop_types(f("crops"), f("cases"), "crop_type", group_var=g)


def temp_crop_harvest_report(
    f: Frame, g: str, json_qnr_path: str | None = None
) -> ft.MonitoringTable:
    return ft.temp_crop_harvest(
        f("crops"),
        f("cases"),
        "crop_id",
        TEMPORARY_CROPS,
        "harvested",
        why_not_harvest_var="why_not",
        group_var=g,
        json_qnr_path=json_qnr_path,
    )


def _temp_crop_sales(
    f: Frame, g: str, amounts: list[str] = AMOUNTS
) -> ft.MonitoringTable:
    return ft.temp_crop_sales(
        f("crop_sales"),
        f("cases"),
        "crop_id",
        "sold",
        amt_sold_vars=amounts,
        amt_sold_dk_val=DK,
        group_var=g,
    )


def _perm_crop_harvest(f: Frame, g: str) -> ft.MonitoringTable:
    return ft.perm_crop_harvest(
        f("crops"),
        f("cases"),
        "crop_id",
        PERMANENT_CROPS,
        "n_produce",
        "harvested",
        group_var=g,
    )


def _perm_crop_sales(
    f: Frame, g: str, filter_crops: bool = False
) -> ft.MonitoringTable:
    return ft.perm_crop_sales(
        f("crop_sales"),
        f("cases"),
        "crop_id",
        PERMANENT_CROPS,
        "sold",
        amt_sold_vars=AMOUNTS,
        amt_sold_dk_val=DK,
        group_var=g,
        filter_crops=filter_crops,
    )


def _livestock_ownership(f: Frame, g: str) -> ft.MonitoringTable:
    return ft.livestock_ownership(f("hhold"), "animal", f("cases"), g)


def _cow_displacement(f: Frame, g: str) -> ft.MonitoringTable:
    return ft.cow_displacement(f("hhold"), f("cases"), "animal", group_var=g)


def _hen_displacement(f: Frame, g: str) -> ft.MonitoringTable:
    return ft.hen_displacement(f("hhold"), f("cases"), "animal", group_var=g)


def _anim_prod_sales(f: Frame, g: str) -> ft.MonitoringTable:
    return ft.anim_prod_sales(
        f("livestock"),
        f("cases"),
        "anim_id",
        ANIM_VALS,
        "produced",
        sold_var="sold",
        amt_sold_vars="amt_total",
        amt_sold_dk_val=DK,
        group_var=g,
        table_title="Milk production and sales",
        anim_type_label="Dairy animals",
    )


def _other_prod_sales(f: Frame, g: str) -> ft.MonitoringTable:
    return ft.other_prod_sales(
        f("hhold"),
        f("products"),
        f("cases"),
        "practice",
        products_var="products",
        sold_var="sold",
        amt_sold_vars=AMOUNTS,
        amt_sold_dk_val=DK,
        group_var=g,
        table_title="Fishery production and sales",
    )


def _process_crop_prod(f: Frame, g: str) -> ft.MonitoringTable:
    return ft.process_crop_prod(
        f("hhold"),
        "temp_any",
        "perm_any",
        "processed_any",
        products_var="proc",
        cases=f("cases"),
        product_df=f("products"),
        sold_var="sold",
        amt_sold_vars=AMOUNTS,
        amt_sold_dk_val=DK,
        group_var=g,
    )


def _crop_labor(f: Frame, g: str) -> ft.MonitoringTable:
    return ft.crop_labor(
        f("hhold"),
        f("cases"),
        "grew_crops",
        paid_var="paid",
        free_var="free",
        members_df=f("members"),
        member_worked_var="worked",
        group_var=g,
    )


def _livestock_labor(f: Frame, g: str) -> ft.MonitoringTable:
    return ft.livestock_labor_tbl(
        f("hhold"),
        f("cases"),
        "have_anim",
        anim_labor_df=f("anim_labor"),
        anim_labor_id_var="labor_id",
        anim_labor_var="n_workers",
        group_var=g,
    )


def _sector_labor(f: Frame, g: str) -> ft.MonitoringTable:
    return ft.sector_labor(
        f("hhold"),
        "raise_anim",
        cases=f("cases"),
        labor_var="labor",
        group_var=g,
        table_title="Fishery labor",
        sector_label="Fish",
    )


def _income_sources(f: Frame, g: str) -> ft.MonitoringTable:
    # One frame per source with a column per use: each source is read once. Sales
    # without a crop id are neither temporary nor permanent.
    crop, product, sold = F.col("crop_id"), F.col("product_id"), F.col("sold")
    crop_sales = f("crop_sales").withColumns(
        {"temp_sold": F.when(crop < 12, sold), "perm_sold": F.when(crop >= 12, sold)}
    )
    products = f("products").withColumns(
        {"processed_sold": F.when(product < 3, sold), "other_sold": F.when(product >= 3, sold)}
    )
    return ft.income_sources(
        f("hhold"),
        "grew_crops",
        "raise_anim",
        crop_sales,
        "temp_sold",
        perm_crop_df=crop_sales,
        perm_crop_var="perm_sold",
        processed_df=products,
        processed_var="processed_sold",
        anim_df=f("livestock"),
        sold_live_anim_var="n_sold_live",
        slaughter_anim_var="slaughtered",
        sold_live_poultry_var="n_poultry_live",
        slaughter_poultry_var="poultry_killed",
        milk_var="milk",
        eggs_var="eggs",
        oth_anim_prod_df=products,
        oth_anim_var="other_sold",
        cases=f("cases"),
        group_var=g,
    )


REPORTS: dict[str, Callable[[Frame, str], ft.MonitoringTable]] = {
    "parcels_per_hhold": _parcels_per_hhold,
    "parcel_gps": _parcel_gps,
    "plots_per_parcel": _plots_per_parcel,
    "plot_use": _plot_use,
    "plot_gps": _plot_gps,
    "crops_per_plot": _crops_per_plot,
    "crop_types": _crop_types,
    "temp_crop_harvest": temp_crop_harvest_report,
    "temp_crop_sales": _temp_crop_sales,
    "perm_crop_harvest": _perm_crop_harvest,
    "perm_crop_sales": _perm_crop_sales,
    "livestock_ownership": _livestock_ownership,
    "cow_displacement": _cow_displacement,
    "hen_displacement": _hen_displacement,
    "anim_prod_sales": _anim_prod_sales,
    "other_prod_sales": _other_prod_sales,
    "process_crop_prod": _process_crop_prod,
    "crop_labor": _crop_labor,
    "livestock_labor": _livestock_labor,
    "sector_labor": _sector_labor,
    "income_sources": _income_sources,
}

#: Optional parameters of the reports, each registered as a query of its own.
VARIANTS: dict[str, Callable[[Frame, str], ft.MonitoringTable]] = {
    "parcels_per_hhold_no_use": partial(_parcels_per_hhold, with_use=False),
    "parcel_gps_no_reason": partial(_parcel_gps, with_reason=False),
    "temp_crop_sales_one_amount": partial(_temp_crop_sales, amounts=["amt_total"]),
    "perm_crop_sales_filtered": partial(_perm_crop_sales, filter_crops=True),
}


def report_table(
    spark: SparkSession, sf_dir: str, key: str, group_var: str = "team"
) -> ft.MonitoringTable:
    """Run one report over the survey frames in ``sf_dir``."""
    build = REPORTS.get(key) or VARIANTS[key]
    return build(lambda name: survey_frame(spark, sf_dir, name), group_var)
