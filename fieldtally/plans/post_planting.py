"""Post-planting reports: parcels, plots and crops.

All reports take DataFrames and column names.  ``cases`` holds one row per
interview with ``interview__id`` and the group column; rosters hold
``interview__id`` plus their own columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtally.functions.labels import heading, label_values, value_labels
from fieldtally.functions.options import any_option, option_column, option_counts
from fieldtally.functions.semantics import coded, is_tagged, safe_ratio
from fieldtally.operators.rollup import (
    CASE_KEY,
    attach,
    roll_up,
    sum_by_group,
    tally,
    tally_codes,
)
from fieldtally.plans.table import MonitoringTable, monitoring_table
from fieldtally.sources.frames import EXPORT_NUMERIC_MISSING

# Answer codes of the survey software and of the questionnaires.
AREA_NOT_MEASURED = -9999
TEMPORARY_CROP = 1
PERMANENT_CROP = 2

#: Questions with more options are counted in long form, which is faster from about
#: eighty options on; the plan changes, not the result.
MANY_OPTIONS = 80


def parcels_per_hhold(
    parcel_df: DataFrame,
    cases: DataFrame,
    use_var: str | None = None,
    use_vals: Sequence[int] | None = None,
    *,
    group_var: str,
) -> MonitoringTable:
    """Interviews, parcels and, if a use question is given, agricultural shares."""
    if (use_var is None) != (use_vals is None):
        raise ValueError("use_var and use_vals go together")
    measures = {"parcels": F.count(F.lit(1))}
    sums = {
        "interviews": F.count_distinct(CASE_KEY),
        "parcels": F.sum("parcels"),
    }
    shares: list[Column] = []
    if use_var is not None:
        measures["ag_parcels"] = F.count_if(any_option(parcel_df, use_var, use_vals))
        sums["ag_parcels"] = F.sum("ag_parcels")
        # Whatever is not agricultural, the row of an unmatched case included.
        parcels, ag = F.col("parcels"), F.col("ag_parcels")
        shares = [
            safe_ratio(ag, parcels).alias("ag"),
            safe_ratio(parcels - ag, parcels).alias("non_ag"),
        ]
    joined = attach(cases, roll_up(parcel_df, measures), group_var, {"parcels": 1})
    stats = sum_by_group(joined, group_var, sums).select(
        group_var, "interviews", "parcels", *shares
    )
    return monitoring_table("parcels_per_hhold", group_var, stats)


def _area_not_measured(df: DataFrame, gps_var: str, not_measured_val: float) -> Column:
    area = F.col(gps_var)
    return (
        (area == not_measured_val)
        | (area == EXPORT_NUMERIC_MISSING)
        | is_tagged(df, gps_var)
    )


def _code_headings(df: DataFrame, variable: str) -> list[tuple[str, str]]:
    return [
        (option_column(variable, code), heading(text, code))
        for code, text in value_labels(df, variable)
    ]


def _shares_of(names: Sequence[str], denominator: str) -> list[Column]:
    return [safe_ratio(F.col(n), F.col(denominator)).alias(n) for n in names]


def _gps_report(
    report: str,
    unit: str,
    df: DataFrame,
    cases: DataFrame,
    not_measured: Column,
    why_no_gps_var: str | None,
    group_var: str,
    unmatched_is_unmeasured: bool,
) -> MonitoringTable:
    reasons = option_counts(df, why_no_gps_var) if why_no_gps_var else {}
    sums = tally(
        cases,
        df,
        group_var,
        {unit: F.count(F.lit(1)), "not_measured": F.count_if(not_measured), **reasons},
        unmatched={unit: 1, "not_measured": int(unmatched_is_unmeasured)},
    )
    stats = sums.select(
        group_var, unit, "not_measured", *_shares_of(list(reasons), "not_measured")
    )
    options = _code_headings(df, why_no_gps_var) if why_no_gps_var else ()
    return monitoring_table(report, group_var, stats, options)


def parcel_gps(
    parcel_df: DataFrame,
    cases: DataFrame,
    gps_var: str,
    not_measured_val: float = AREA_NOT_MEASURED,
    why_no_gps_var: str | None = None,
    *,
    group_var: str,
) -> MonitoringTable:
    """Parcels without a GPS area, by reason; a plain NULL area does not count."""
    return _gps_report(
        "parcel_gps",
        "parcels",
        parcel_df,
        cases,
        _area_not_measured(parcel_df, gps_var, not_measured_val),
        why_no_gps_var,
        group_var,
        unmatched_is_unmeasured=False,
    )


def plots_per_parcel(
    parcel_plot_df: DataFrame,
    cases: DataFrame,
    parcel_id_var: str,
    group_var: str,
) -> MonitoringTable:
    """Parcels with a known id, plots, and plots per parcel.

    The interview is part of every parcel's identity, so the distinct parcels
    of a group are the sum of the distinct parcels of its interviews.
    """
    sums = tally(
        cases,
        parcel_plot_df,
        group_var,
        {
            "n_parcels": F.count_distinct(F.col(parcel_id_var)),
            "n_plots": F.count(F.lit(1)),
        },
        unmatched={"n_plots": 1},
    )
    stats = sums.select(
        group_var,
        "n_parcels",
        "n_plots",
        safe_ratio(F.col("n_plots"), F.col("n_parcels")).alias("mean_plots"),
    )
    return monitoring_table("plots_per_parcel", group_var, stats)


def plot_use(
    plot_df: DataFrame,
    cases: DataFrame,
    plot_use_var: str,
    group_var: str,
) -> MonitoringTable:
    """Share of plots by labelled use."""
    uses = option_counts(plot_df, plot_use_var)
    if len(uses) > MANY_OPTIONS:
        names = dict(zip(label_values(plot_df, plot_use_var), uses, strict=True))
        use = coded(plot_df, plot_use_var)
        sums = tally_codes(cases, plot_df, group_var, use, names, rows="plots")
    else:
        sums = tally(
            cases,
            plot_df,
            group_var,
            {"plots": F.count(F.lit(1)), **uses},
            unmatched={"plots": 1},
        )
    stats = sums.select(group_var, "plots", *_shares_of(list(uses), "plots"))
    return monitoring_table(
        "plot_use", group_var, stats, _code_headings(plot_df, plot_use_var)
    )


def plot_gps(
    plot_df: DataFrame,
    cases: DataFrame,
    gps_var: str,
    not_measured_val: float = AREA_NOT_MEASURED,
    *,
    why_no_gps_var: str,
    group_var: str,
) -> MonitoringTable:
    """Plots without a GPS area, by reason; a plain NULL area counts too.

    An interview without plots therefore counts as one plot not measured.
    """
    return _gps_report(
        "plot_gps",
        "plots",
        plot_df,
        cases,
        F.col(gps_var).isNull() | _area_not_measured(plot_df, gps_var, not_measured_val),
        why_no_gps_var,
        group_var,
        unmatched_is_unmeasured=True,
    )


def crops_per_plot(
    crop_df: DataFrame,
    cases: DataFrame,
    parcel_id_var: str,
    plot_id_var: str,
    group_var: str,
) -> MonitoringTable:
    """Plots, crops and crops per plot; an unknown plot id is a plot of its own."""
    sums = tally(
        cases,
        crop_df,
        group_var,
        {
            "n_plots": F.count_distinct(F.struct(parcel_id_var, plot_id_var)),
            "n_crops": F.count(F.lit(1)),
        },
        unmatched={"n_plots": 1, "n_crops": 1},
    )
    stats = sums.select(
        group_var,
        "n_plots",
        "n_crops",
        safe_ratio(F.col("n_crops"), F.col("n_plots")).alias("mean_crops"),
    )
    return monitoring_table("crops_per_plot", group_var, stats)


def crop_types(
    crop_df: DataFrame,
    cases: DataFrame,
    crop_type_var: str,
    temp_crop_val: int = TEMPORARY_CROP,
    perm_crop_val: int = PERMANENT_CROP,
    *,
    group_var: str,
) -> MonitoringTable:
    """Share of temporary and permanent crops."""
    crop_type = coded(crop_df, crop_type_var)
    sums = tally(
        cases,
        crop_df,
        group_var,
        {
            "n_crops": F.count(F.lit(1)),
            "crop_temp": F.count_if(crop_type == temp_crop_val),
            "crop_perm": F.count_if(crop_type == perm_crop_val),
        },
        unmatched={"n_crops": 1},
    )
    stats = sums.select(
        group_var, "n_crops", *_shares_of(["crop_temp", "crop_perm"], "n_crops")
    )
    return monitoring_table("crop_types", group_var, stats)
