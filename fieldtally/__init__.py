"""Monitoring tables for agricultural surveys, computed with Spark DataFrames.

The public surface is the 21 report functions plus the small building blocks
they are made of.  A report takes DataFrames and column names and returns a
:class:`~fieldtally.plans.table.MonitoringTable`, whose ``stats`` is a lazy
DataFrame with one row per group.
"""

from fieldtally.functions.labels import with_value_labels
from fieldtally.operators.joins import restrict_to_cases
from fieldtally.operators.rollup import declare_unique
from fieldtally.plans.post_harvest import (
    anim_prod_sales,
    cow_displacement,
    crop_labor,
    hen_displacement,
    income_sources,
    livestock_labor_tbl,
    livestock_ownership,
    other_prod_sales,
    perm_crop_harvest,
    perm_crop_sales,
    process_crop_prod,
    sector_labor,
    temp_crop_harvest,
    temp_crop_sales,
)
from fieldtally.plans.post_planting import (
    crop_types,
    crops_per_plot,
    parcel_gps,
    parcels_per_hhold,
    plot_gps,
    plot_use,
    plots_per_parcel,
)
from fieldtally.plans.table import MonitoringTable, read_report
from fieldtally.sources.exports import read_export
from fieldtally.sources.frames import (
    assert_cases,
    assert_unique,
    check_cases,
    load_frame,
    normalize_missing,
)
from fieldtally.sources.questionnaire import option_labels, questionnaire_labels

__all__ = [
    "MonitoringTable",
    "anim_prod_sales",
    "assert_cases",
    "assert_unique",
    "check_cases",
    "cow_displacement",
    "crop_labor",
    "crop_types",
    "crops_per_plot",
    "declare_unique",
    "hen_displacement",
    "income_sources",
    "livestock_labor_tbl",
    "livestock_ownership",
    "load_frame",
    "normalize_missing",
    "option_labels",
    "other_prod_sales",
    "parcel_gps",
    "parcels_per_hhold",
    "perm_crop_harvest",
    "perm_crop_sales",
    "plot_gps",
    "plot_use",
    "plots_per_parcel",
    "process_crop_prod",
    "questionnaire_labels",
    "read_export",
    "read_report",
    "restrict_to_cases",
    "sector_labor",
    "temp_crop_harvest",
    "temp_crop_sales",
    "with_value_labels",
]
