"""Titles, column labels, spanners and footnotes of the reports."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

COUNT, SHARE, AVERAGE = "N", "%", "AVG"


@dataclass(frozen=True)
class Layout:
    """How a report is shown.

    ``columns`` maps a statistic to its label and kind, ``spanners`` a spanner
    label to the columns below it, ``footnotes`` a column name or spanner label
    to its note.  ``options`` is the spanner (if any) of columns that depend on
    a question's answer options.
    """

    title: str | None
    columns: Mapping[str, tuple[str, str]]
    spanners: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    footnotes: Mapping[str, str] = field(default_factory=dict)
    options: str | None = None


# The wording the monitoring tables are known by.

_SALES = ("sales_miss", "sales_dk")
_LABOR = ("hhold_labor", "paid_labor", "free_labor")
_LABOR_COLUMNS = {
    "hhold_only": ("Household labor only (%)", SHARE),
    "external_only": ("External labor only (%)", SHARE),
    "hhold_labor": ("Household", SHARE),
    "paid_labor": ("Paid", SHARE),
    "free_labor": ("Free/exchange", SHARE),
}
_CROP_SALES_COLUMNS = {
    "harvested": ("Harvested (N)", COUNT),
    "sold": ("Sold (%)", SHARE),
    "sales_miss": ("Missing", SHARE),
    "sales_dk": ("DK", SHARE),
}
_CROP_SALES_NOTE = (
    "Percentage is computed as (number of values / number parcel-plot-crop sales)."
)
_CROP_LABOR_NOTE = (
    "Percentages may not sum to 100. "
    "Households may have multiple sources of crop labor."
)
_LIVESTOCK_LABOR_NOTE = (
    "Percentages may not sum to 100. "
    "Households may have multiple sources of livestock labor."
)
_SECTOR_LABOR_NOTE = (
    "Percentages may not sum to 100. "
    "Households may have multiple sources of labor inputs."
)

LAYOUTS: dict[str, Layout] = {
    "parcels_per_hhold": Layout(
        title="Parcels per household, by {group}",
        columns={
            "interviews": ("Interviews (N)", COUNT),
            "parcels": ("Total parcels (N)", COUNT),
            "ag": ("Agricultural", SHARE),
            "non_ag": ("Non-agricultural", SHARE),
        },
        spanners={"Parcels (%)": ("ag", "non_ag")},
    ),
    "parcel_gps": Layout(
        title="Parcel GPS area measurement, by {group}",
        columns={
            "parcels": ("Parcels (N)", COUNT),
            "not_measured": ("Not measured (N)", COUNT),
        },
        options="Why not measured (%)",
    ),
    "plots_per_parcel": Layout(
        title="Number of plots per parcel, by {group}",
        columns={
            "n_parcels": ("Parcels (N)", COUNT),
            "n_plots": ("Plots (N)", COUNT),
            "mean_plots": ("Plots per parcel (AVG)", AVERAGE),
        },
    ),
    "plot_use": Layout(
        title="Plot use, by {group}",
        columns={"plots": ("Plots (N)", COUNT)},
        options="Use (%)",
    ),
    "plot_gps": Layout(
        title="Plot GPS area measurement, by {group}",
        columns={
            "plots": ("Plots (N)", COUNT),
            "not_measured": ("Not measured (N)", COUNT),
        },
        options="Why not measured (%)",
    ),
    "crops_per_plot": Layout(
        title="Number of crops per plot, by {group}",
        columns={
            "n_plots": ("Plots (N)", COUNT),
            "n_crops": ("Crops (N)", COUNT),
            "mean_crops": ("Crops per plot (AVG)", AVERAGE),
        },
    ),
    "crop_types": Layout(
        title="Crop types, by {group}",
        columns={
            "n_crops": ("Crops (N)", COUNT),
            "crop_temp": ("Temporary", SHARE),
            "crop_perm": ("Permanent", SHARE),
        },
        spanners={"Type (%)": ("crop_temp", "crop_perm")},
    ),
    "temp_crop_harvest": Layout(
        title="Prevalence of temporary crop harvest",
        columns={
            "planted": ("Planted (N)", COUNT),
            "harvested": ("Harvested (%)", SHARE),
        },
        options="Why not harvested (%)",
    ),
    "temp_crop_sales": Layout(
        title="Temporary crop sales",
        columns=_CROP_SALES_COLUMNS,
        spanners={"Values (%)": _SALES},
        footnotes={"Values (%)": _CROP_SALES_NOTE},
    ),
    "perm_crop_harvest": Layout(
        title="Prevalence of tree/permanent crop harvest",
        columns={
            "planted": ("Planted (N)", COUNT),
            "produced": ("Produced (%)", SHARE),
            "harvested": ("Harvested (%)", SHARE),
        },
        footnotes={"harvested": "Percentage of all crops planted"},
    ),
    "perm_crop_sales": Layout(
        title="Tree/permanent crop sales",
        columns=_CROP_SALES_COLUMNS,
        spanners={"Values (%)": _SALES},
        footnotes={"Values (%)": _CROP_SALES_NOTE},
    ),
    "livestock_ownership": Layout(
        title="Livestock ownership",
        columns={
            "n_hholds": ("Households (N)", COUNT),
            "owns_animals": ("Raises livestock (N)", COUNT),
            "avg_animals": ("Types of livestock (AVG)", AVERAGE),
        },
        footnotes={
            "avg_animals": "Average computed as "
            "(number of animals owned / number who own animals)"
        },
    ),
    "cow_displacement": Layout(
        title="Cow displacement",
        columns={
            "n_own_cattle": ("Have cattle (N)", COUNT),
            "n_types": ("Cattle types (N)", COUNT),
            "bull": ("Bulls", SHARE),
            "cow": ("Cows", SHARE),
            "steer_heifer": ("Steers/Heifers", SHARE),
            "calf": ("Calves", SHARE),
        },
        spanners={"Types (%)": ("bull", "cow", "steer_heifer", "calf")},
    ),
    "hen_displacement": Layout(
        title="Hen displacement",
        columns={
            "n_own_chicken": ("Have chickens (N)", COUNT),
            "n_types": ("Chicken types (N)", COUNT),
            "cock": ("Cocks/broilers", SHARE),
            "hen": ("Hens", SHARE),
            "pullet": ("Pullets", SHARE),
        },
        spanners={"Types (%)": ("cock", "hen", "pullet")},
    ),
    "anim_prod_sales": Layout(
        title=None,
        columns={
            "n_anim": ("{label} (N)", COUNT),
            "produced": ("Produced (%)", SHARE),
            "sold": ("Sold (%)", SHARE),
            "sales_miss": ("Missing", SHARE),
            "sales_dk": ("DK", SHARE),
        },
        spanners={"Sales value (%)": _SALES},
        footnotes={
            "sold": "Percentage computed as (number sold / number produced)",
            "Sales value (%)": "Percentage computed as "
            "(number values / number sales observations)",
        },
    ),
    "other_prod_sales": Layout(
        title=None,
        columns={
            "n_hholds": ("Total household (N)", COUNT),
            "practice": ("Practice (%)", SHARE),
            "n_products": ("Products (N)", COUNT),
            "sold": ("Sell (%)", SHARE),
            "sales_miss": ("Missing", SHARE),
            "sales_dk": ("DK", SHARE),
        },
        spanners={"Sales value (%)": _SALES},
        footnotes={
            "n_products": "Total over all households.",
            "sold": "Percentage of households that produce.",
            "Sales value (%)": "Percentage of households that sell.",
        },
    ),
    "process_crop_prod": Layout(
        title="Processing of crop production",
        columns={
            "produced": ("Produce crops (N)", COUNT),
            "processed": ("Process (%)", SHARE),
            "n_products": ("Items produced (AVG)", AVERAGE),
            "any_sales": ("Sell (%)", SHARE),
            "sales_miss": ("Missing", SHARE),
            "sales_dk": ("DK", SHARE),
        },
        spanners={"Sales values (%)": _SALES},
        footnotes={
            "processed": "Percentage of those that produce",
            "n_products": "Average number for those that produce",
            "any_sales": "Percentage of those that produce with any sales",
        },
    ),
    "crop_labor": Layout(
        title="Crop labor inputs",
        columns={"grew_crops": ("Grew crops (N)", COUNT), **_LABOR_COLUMNS},
        spanners={"Labor types (%)": _LABOR},
        footnotes={"Labor types (%)": _CROP_LABOR_NOTE},
    ),
    "livestock_labor_tbl": Layout(
        title="Livestock labor",
        columns={"have_anim": ("Own livestock (N)", COUNT), **_LABOR_COLUMNS},
        spanners={"Labor types (%)": _LABOR},
        footnotes={"Labor types (%)": _LIVESTOCK_LABOR_NOTE},
    ),
    "sector_labor": Layout(
        title=None,
        columns={"produce": ("{label} (N)", COUNT), **_LABOR_COLUMNS},
        spanners={"Labor types (%)": _LABOR},
        footnotes={"Labor types (%)": _SECTOR_LABOR_NOTE},
    ),
    "income_sources": Layout(
        title="Sources of income",
        columns={
            "n_hholds": ("Total households (N)", COUNT),
            "n_any_ag": ("Practice agriculture (N)", COUNT),
            "temp_crop": ("Temporary crop", SHARE),
            "perm_crop": ("Tree/permanent crop", SHARE),
            "processed": ("Processed crop", SHARE),
            "anim_sold": ("Live animal", SHARE),
            "anim_killed": ("Slaughter", SHARE),
            "milk_sold": ("Milk", SHARE),
            "eggs_sold": ("Eggs", SHARE),
            "anim_prod_sold": ("Other animal products", SHARE),
        },
        spanners={
            "Crop sales (%)": ("temp_crop", "perm_crop", "processed"),
            "Livestock sales (%)": (
                "anim_sold",
                "anim_killed",
                "milk_sold",
                "eggs_sold",
                "anim_prod_sold",
            ),
        },
        footnotes={
            spanner: "Percentage computed as (number with sales / "
            "number of households engaged in any agriculture)"
            for spanner in ("Crop sales (%)", "Livestock sales (%)")
        },
    ),
}
