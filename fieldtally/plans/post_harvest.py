"""Post-harvest reports: harvest, sales, livestock, labor and income.

Reports over several frames stack the row-level measures of all of them, roll
the stack up once per interview and join it to the cases once.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtally.functions.options import (
    amount_missing,
    amount_unknown,
    any_option,
    option_column,
    option_columns,
    option_selected,
)
from fieldtally.functions.semantics import (
    any_from_counts,
    coded,
    flag,
    is_in,
    row_total,
    safe_ratio,
    total,
)
from fieldtally.operators.rollup import (
    attach,
    padded,
    roll_up,
    stack,
    sum_by_group,
    tally,
    tally_rows,
)
from fieldtally.plans.table import MonitoringTable, monitoring_table
from fieldtally.sources.questionnaire import option_labels

# Answer codes the questionnaires use by default.
YES = 1
BULL, COW, STEER_HEIFER, CALF = 10, 12, 13, 14
COCK, HEN, PULLET = 51, 52, 53
HOUSEHOLD_LABOR = (1, 2, 3)
FREE_LABOR = 4
PAID_LABOR = 5
NO_WORKERS = 0


def _share(name: str, numerator: str, denominator: str) -> Column:
    return safe_ratio(F.col(numerator), F.col(denominator)).alias(name)


def _stored(df: DataFrame, names: Iterable[str]) -> list[Column]:
    return [coded(df, n) for n in names]


# Harvest and crop sales


def temp_crop_harvest(
    parcel_plot_crop_df: DataFrame,
    cases: DataFrame,
    crop_id_var: str,
    crop_vals: Sequence[int],
    harvest_var: str,
    harvest_val: int = YES,
    *,
    why_not_harvest_var: str,
    group_var: str,
    json_qnr_path: str | None = None,
) -> MonitoringTable:
    """Temporary crops planted and harvested, and reasons for not harvesting.

    Reason labels come from the questionnaire file; without one the column
    names are shown.
    """
    reasons = option_columns(parcel_plot_crop_df, why_not_harvest_var)
    sums = tally(
        cases,
        parcel_plot_crop_df.filter(F.col(crop_id_var).isin(list(crop_vals))),
        group_var,
        {
            "planted": F.count(F.lit(1)),
            "harvested": F.count_if(coded(parcel_plot_crop_df, harvest_var) == harvest_val),
            **{name: total(coded(parcel_plot_crop_df, name)) for name in reasons},
        },
        keep_unmatched=False,
    )
    all_reasons = reduce(add, map(F.col, reasons)) if reasons else F.lit(0)
    stats = sums.select(
        group_var,
        "planted",
        _share("harvested", "harvested", "planted"),
        *(safe_ratio(F.col(name), all_reasons).alias(name) for name in reasons),
    )
    labels: dict[str, str] = {}
    if json_qnr_path is not None:
        found = option_labels(cases.sparkSession, json_qnr_path, why_not_harvest_var)
        labels = {
            option_column(why_not_harvest_var, code).lower(): text for code, text in found
        }
    options = [(name, labels.get(name.lower(), name)) for name in reasons]
    return monitoring_table("temp_crop_harvest", group_var, stats, options)


def _crop_sales(
    report: str,
    crops_sales_df: DataFrame,
    cases: DataFrame,
    crop_id_var: str,
    sold_var: str,
    sold_val: int,
    amt_sold_vars: str | Sequence[str],
    amt_sold_dk_val: float,
    group_var: str,
    crop_vals: Sequence[int] | None,
) -> MonitoringTable:
    crop_id = F.col(crop_id_var)
    kept = crop_id.isNotNull() if crop_vals is None else crop_id.isin(list(crop_vals))
    sums = tally(
        cases,
        crops_sales_df.filter(kept),
        group_var,
        {
            "harvested": F.count(F.lit(1)),
            "sold": F.count_if(coded(crops_sales_df, sold_var) == sold_val),
            "sales_miss": F.count_if(amount_missing(crops_sales_df, amt_sold_vars)),
            "sales_dk": F.count_if(amount_unknown(amt_sold_vars, amt_sold_dk_val)),
        },
        keep_unmatched=False,
    )
    stats = sums.select(
        group_var,
        "harvested",
        _share("sold", "sold", "harvested"),
        _share("sales_miss", "sales_miss", "sold"),
        _share("sales_dk", "sales_dk", "sold"),
    )
    return monitoring_table(report, group_var, stats)


def temp_crop_sales(
    crops_sales_df: DataFrame,
    cases: DataFrame,
    crop_id_var: str,
    sold_var: str,
    sold_val: int = YES,
    *,
    amt_sold_vars: str | Sequence[str],
    amt_sold_dk_val: float,
    group_var: str,
) -> MonitoringTable:
    """Temporary crops harvested and sold, and quality of the sales values."""
    return _crop_sales(
        "temp_crop_sales",
        crops_sales_df,
        cases,
        crop_id_var,
        sold_var,
        sold_val,
        amt_sold_vars,
        amt_sold_dk_val,
        group_var,
        crop_vals=None,
    )


def perm_crop_harvest(
    parcel_plot_crop_df: DataFrame,
    cases: DataFrame,
    crop_id_var: str,
    crop_vals: Sequence[int],
    produce_var: str,
    harvest_var: str,
    harvest_val: int = YES,
    *,
    group_var: str,
) -> MonitoringTable:
    """Permanent crops planted, producing and harvested."""
    sums = tally(
        cases,
        parcel_plot_crop_df.filter(F.col(crop_id_var).isin(list(crop_vals))),
        group_var,
        {
            "planted": F.count(F.lit(1)),
            "produced": F.count_if(coded(parcel_plot_crop_df, produce_var) > 0),
            "harvested": F.count_if(coded(parcel_plot_crop_df, harvest_var) == harvest_val),
        },
        keep_unmatched=False,
    )
    stats = sums.select(
        group_var,
        "planted",
        _share("produced", "produced", "planted"),
        _share("harvested", "harvested", "planted"),
    )
    return monitoring_table("perm_crop_harvest", group_var, stats)


def perm_crop_sales(
    crops_sales_df: DataFrame,
    cases: DataFrame,
    crop_id_var: str,
    crop_vals: Sequence[int],
    sold_var: str,
    sold_val: int = YES,
    *,
    amt_sold_vars: str | Sequence[str],
    amt_sold_dk_val: float,
    group_var: str,
    filter_crops: bool = False,
) -> MonitoringTable:
    """Permanent crops harvested and sold, and quality of the sales values.

    By default every row with a known crop counts, whatever ``crop_vals`` says;
    ``filter_crops=True`` restricts the report to ``crop_vals``.
    """
    return _crop_sales(
        "perm_crop_sales",
        crops_sales_df,
        cases,
        crop_id_var,
        sold_var,
        sold_val,
        amt_sold_vars,
        amt_sold_dk_val,
        group_var,
        crop_vals=crop_vals if filter_crops else None,
    )


# Livestock


def livestock_ownership(
    hhold_df: DataFrame,
    animal_var: str,
    cases: DataFrame,
    group_var: str,
) -> MonitoringTable:
    """Households, livestock owners, and types of livestock per owner."""
    animals = row_total(_stored(hhold_df, option_columns(hhold_df, animal_var)))
    sums = tally_rows(
        cases,
        hhold_df,
        group_var,
        {"n_hholds": F.lit(1), "n_animals": animals, "owns_animals": flag(animals > 0)},
        unmatched={"n_hholds": 1},
    )
    stats = sums.select(
        group_var,
        "n_hholds",
        "owns_animals",
        _share("avg_animals", "n_animals", "owns_animals"),
    )
    return monitoring_table("livestock_ownership", group_var, stats)


def _option_mix(
    report: str,
    hhold_df: DataFrame,
    cases: DataFrame,
    question: str,
    owners: str,
    options: Mapping[str, int],
    group_var: str,
) -> MonitoringTable:
    """Owners of any of the options and the mix of options among them."""
    names = [option_column(question, code) for code in options.values()]
    sums = tally_rows(
        cases,
        hhold_df,
        group_var,
        {
            owners: flag(any_option(hhold_df, question, options.values())),
            "n_types": row_total(_stored(hhold_df, names)),
            **{
                name: flag(option_selected(hhold_df, question, code))
                for name, code in options.items()
            },
        },
    )
    stats = sums.select(
        group_var, owners, "n_types", *(_share(name, name, "n_types") for name in options)
    )
    return monitoring_table(report, group_var, stats)


def cow_displacement(
    hhold_df: DataFrame,
    cases: DataFrame,
    animal_var: str,
    bull_val: int = BULL,
    cow_val: int = COW,
    steer_heifer_val: int = STEER_HEIFER,
    calf_val: int = CALF,
    *,
    group_var: str,
) -> MonitoringTable:
    """Cattle owners and their mix of cattle types."""
    return _option_mix(
        "cow_displacement",
        hhold_df,
        cases,
        animal_var,
        "n_own_cattle",
        {
            "bull": bull_val,
            "cow": cow_val,
            "steer_heifer": steer_heifer_val,
            "calf": calf_val,
        },
        group_var,
    )


def hen_displacement(
    hhold_df: DataFrame,
    cases: DataFrame,
    animal_var: str,
    cock_val: int = COCK,
    hen_val: int = HEN,
    pullet_val: int = PULLET,
    *,
    group_var: str,
) -> MonitoringTable:
    """Chicken owners and their mix of chicken types."""
    return _option_mix(
        "hen_displacement",
        hhold_df,
        cases,
        animal_var,
        "n_own_chicken",
        {"cock": cock_val, "hen": hen_val, "pullet": pullet_val},
        group_var,
    )


def anim_prod_sales(
    livestock_df: DataFrame,
    cases: DataFrame,
    anim_id_var: str,
    anim_vals: Sequence[int],
    produced_var: str,
    produced_val: int = YES,
    *,
    sold_var: str,
    sold_val: int = YES,
    amt_sold_vars: str | Sequence[str],
    amt_sold_dk_val: float,
    group_var: str,
    table_title: str,
    anim_type_label: str,
) -> MonitoringTable:
    """Milk or egg production and sales.

    Only the animal count looks at ``anim_vals``; production and sales count
    over the whole roster.
    """
    sums = tally(
        cases,
        livestock_df,
        group_var,
        {
            "n_anim": F.count_if(is_in(F.col(anim_id_var), anim_vals)),
            "produced": F.count_if(coded(livestock_df, produced_var) == produced_val),
            "sold": F.count_if(coded(livestock_df, sold_var) == sold_val),
            "sales_miss": F.count_if(amount_missing(livestock_df, amt_sold_vars)),
            "sales_dk": F.count_if(amount_unknown(amt_sold_vars, amt_sold_dk_val)),
        },
    )
    stats = sums.select(
        group_var,
        "n_anim",
        _share("produced", "produced", "n_anim"),
        _share("sold", "sold", "produced"),
        _share("sales_miss", "sales_miss", "sold"),
        _share("sales_dk", "sales_dk", "sold"),
    )
    return monitoring_table(
        "anim_prod_sales",
        group_var,
        stats,
        title=table_title,
        fill={"label": anim_type_label},
    )


# Household and product rosters together


def _sales_rows(
    product_df: DataFrame,
    sold_var: str,
    sold_val: int,
    amt_sold_vars: str | Sequence[str],
    amt_sold_dk_val: float,
) -> dict[str, Column]:
    return {
        "sold": coded(product_df, sold_var) == sold_val,
        "sales_miss": amount_missing(product_df, amt_sold_vars),
        "sales_dk": amount_unknown(amt_sold_vars, amt_sold_dk_val),
    }


def other_prod_sales(
    hhold_df: DataFrame,
    product_df: DataFrame,
    cases: DataFrame,
    practice_var: str,
    practice_val: int = YES,
    *,
    products_var: str,
    sold_var: str,
    sold_val: int = YES,
    amt_sold_vars: str | Sequence[str],
    amt_sold_dk_val: float,
    group_var: str,
    table_title: str,
) -> MonitoringTable:
    """Fishery, aquaculture or forestry: practice, products and sales.

    Sales flags say whether *any* product of the group was sold (or had a
    missing or unknown value), so ``sold`` is 0 or 1 before it is divided.
    """
    products = row_total(_stored(hhold_df, option_columns(hhold_df, products_var)))
    rows = stack(
        (
            hhold_df,
            {
                "hholds": F.lit(1),
                "practice": coded(hhold_df, practice_var) == practice_val,
                "n_products": products,
            },
        ),
        (
            product_df,
            _sales_rows(product_df, sold_var, sold_val, amt_sold_vars, amt_sold_dk_val),
        ),
    )
    sales = ("sold", "sales_miss", "sales_dk")
    rolled = roll_up(
        rows,
        {
            "hholds": F.count("hholds"),
            "practice": F.count_if(F.col("practice")),
            "n_products": total(F.col("n_products")),
            **{name: F.count_if(F.col(name)) for name in sales},
        },
    )
    sums = sum_by_group(
        attach(cases, rolled, group_var),
        group_var,
        {
            "n_hholds": F.sum(padded(F.col("hholds"))),
            "practice": F.sum("practice"),
            "n_products": F.sum("n_products"),
            **{name: F.max(flag(F.col(name) > 0)) for name in sales},
        },
    )
    stats = sums.select(
        group_var,
        "n_hholds",
        _share("practice", "practice", "n_hholds"),
        "n_products",
        _share("sold", "sold", "practice"),
        _share("sales_miss", "sales_miss", "sold"),
        _share("sales_dk", "sales_dk", "sold"),
    )
    return monitoring_table("other_prod_sales", group_var, stats, title=table_title)


def process_crop_prod(
    hhold_df: DataFrame,
    temp_crops_var: str,
    perm_crops_var: str,
    processed_var: str,
    processed_val: int = YES,
    *,
    products_var: str,
    cases: DataFrame,
    product_df: DataFrame,
    sold_var: str,
    sold_val: int = YES,
    amt_sold_vars: str | Sequence[str],
    amt_sold_dk_val: float,
    group_var: str,
) -> MonitoringTable:
    """Crop producers, processing, processed items and their sales."""
    products = row_total(_stored(hhold_df, option_columns(hhold_df, products_var)))
    rows = stack(
        (
            hhold_df,
            {
                "produced": (coded(hhold_df, temp_crops_var) == YES)
                | (coded(hhold_df, perm_crops_var) == YES),
                "processed": coded(hhold_df, processed_var) == processed_val,
                "n_products": products,
            },
        ),
        (
            product_df,
            _sales_rows(product_df, sold_var, sold_val, amt_sold_vars, amt_sold_dk_val),
        ),
    )
    counted = ("produced", "processed", "sold", "sales_miss", "sales_dk")
    rolled = roll_up(
        rows,
        {
            **{name: F.count_if(F.col(name)) for name in counted},
            "n_products": total(F.col("n_products")),
        },
    )
    sums = sum_by_group(
        attach(cases, rolled, group_var),
        group_var,
        {
            **{name: F.sum(name) for name in (*counted, "n_products")},
            "any_sales": F.max(flag(F.col("sold") > 0)),
        },
    )
    stats = sums.select(
        group_var,
        "produced",
        _share("processed", "processed", "produced"),
        _share("n_products", "n_products", "produced"),
        _share("any_sales", "any_sales", "produced"),
        _share("sales_miss", "sales_miss", "sold"),
        _share("sales_dk", "sales_dk", "sold"),
    )
    return monitoring_table("process_crop_prod", group_var, stats)


# Labor

LABOR_KINDS = ("hhold_only", "external_only", "hhold_labor", "paid_labor", "free_labor")


def _only_household(hhold: Column, paid: Column, free: Column) -> Column:
    return hhold & (paid == 0) & (free == 0)


def _only_external(hhold: Column, paid: Column, free: Column) -> Column:
    return ~hhold & ((paid == 1) | (free == 1))


def crop_labor(
    hhold_df: DataFrame,
    cases: DataFrame,
    grew_crops_var: str,
    grew_crops_val: int = YES,
    *,
    paid_var: str,
    free_var: str,
    members_df: DataFrame,
    member_worked_var: str,
    member_worked_val: int = YES,
    group_var: str,
) -> MonitoringTable:
    """Crop growers and the kinds of labor they use.

    Household labor is unknown for an interview when no member is known to have
    worked and for some member (or for all, if the roster is empty) the answer
    is missing.
    """

    def used(question: str) -> Column:
        stored = _stored(hhold_df, option_columns(hhold_df, question))
        return row_total(stored, skip_missing=False) >= 1

    rows = stack(
        (
            hhold_df,
            {
                "grew_crops": coded(hhold_df, grew_crops_var) == grew_crops_val,
                "paid_labor": used(paid_var),
                "free_labor": used(free_var),
            },
        ),
        (
            members_df,
            {
                "members": F.lit(1),
                "worked": coded(members_df, member_worked_var) == member_worked_val,
            },
        ),
    )
    rolled = roll_up(
        rows,
        {
            "grew_crops": F.count_if(F.col("grew_crops")),
            "paid_labor": F.count_if(F.col("paid_labor")),
            "free_labor": F.count_if(F.col("free_labor")),
            "members": F.count("members"),
            "answered": F.count("worked"),
            "worked": F.count_if(F.col("worked")),
        },
    )
    unknown = padded(F.col("members")) - F.col("answered")
    hhold = any_from_counts(F.col("worked"), unknown)
    paid, free = F.col("paid_labor"), F.col("free_labor")
    sums = sum_by_group(
        attach(cases, rolled, group_var),
        group_var,
        {
            "grew_crops": F.sum("grew_crops"),
            "hhold_only": F.count_if(_only_household(hhold, paid, free)),
            "external_only": F.count_if(_only_external(hhold, paid, free)),
            "hhold_labor": F.count_if(hhold),
            "paid_labor": F.sum(paid),
            "free_labor": F.sum(free),
        },
    )
    stats = sums.select(
        group_var,
        "grew_crops",
        *(_share(name, name, "grew_crops") for name in LABOR_KINDS),
    )
    return monitoring_table("crop_labor", group_var, stats)


def livestock_labor_tbl(
    hhold_df: DataFrame,
    cases: DataFrame,
    have_anim_var: str,
    have_anim_val: int = YES,
    *,
    anim_labor_df: DataFrame,
    anim_labor_id_var: str,
    anim_labor_var: str,
    anim_labor_none_val: int = NO_WORKERS,
    hhold_labor_vals: Sequence[int] = HOUSEHOLD_LABOR,
    free_labor_val: int = FREE_LABOR,
    paid_labor_val: int = PAID_LABOR,
    group_var: str,
) -> MonitoringTable:
    """Livestock owners and the kinds of labor they use, from a labor roster.

    Type shares divide by the labor rows in use, the "only" shares by owners.
    A kind listed twice in one interview counts twice and is then neither 0 nor
    1 for the "only" flags.
    """
    labor_id = F.col(anim_labor_id_var)
    any_workers = coded(anim_labor_df, anim_labor_var) > anim_labor_none_val
    hhold_row = is_in(labor_id, hhold_labor_vals) & any_workers
    free_row = (labor_id == free_labor_val) & any_workers
    paid_row = (labor_id == paid_labor_val) & any_workers
    rows = stack(
        (hhold_df, {"have_anim": coded(hhold_df, have_anim_var) == have_anim_val}),
        (
            anim_labor_df,
            {
                "hhold_labor": hhold_row,
                "free_labor": free_row,
                "paid_labor": paid_row,
                "n_labor": hhold_row | free_row | paid_row,
            },
        ),
    )
    counted = ("have_anim", "hhold_labor", "free_labor", "paid_labor", "n_labor")
    rolled = roll_up(rows, {name: F.count_if(F.col(name)) for name in counted})
    hhold = F.col("hhold_labor") > 0
    paid, free = F.col("paid_labor"), F.col("free_labor")
    sums = sum_by_group(
        attach(cases, rolled, group_var),
        group_var,
        {
            "have_anim": F.sum("have_anim"),
            "n_labor": F.sum("n_labor"),
            "hhold_only": F.count_if(_only_household(hhold, paid, free)),
            "external_only": F.count_if(_only_external(hhold, paid, free)),
            "hhold_labor": F.count_if(hhold),
            "paid_labor": F.sum(paid),
            "free_labor": F.sum(free),
        },
    )
    stats = sums.select(
        group_var,
        "have_anim",
        _share("hhold_only", "hhold_only", "have_anim"),
        _share("external_only", "external_only", "have_anim"),
        _share("hhold_labor", "hhold_labor", "n_labor"),
        _share("paid_labor", "paid_labor", "n_labor"),
        _share("free_labor", "free_labor", "n_labor"),
    )
    return monitoring_table("livestock_labor_tbl", group_var, stats)


def sector_labor(
    hhold_df: DataFrame,
    produce_var: str,
    produce_val: int = YES,
    *,
    cases: DataFrame,
    labor_var: str,
    hhold_labor_vals: Sequence[int] = HOUSEHOLD_LABOR,
    free_labor_val: int = FREE_LABOR,
    paid_labor_val: int = PAID_LABOR,
    group_var: str,
    table_title: str,
    sector_label: str,
) -> MonitoringTable:
    """Households in a sector and the kinds of labor they use, multi-select form."""
    hhold = any_option(hhold_df, labor_var, hhold_labor_vals)
    free = option_selected(hhold_df, labor_var, free_labor_val)
    paid = option_selected(hhold_df, labor_var, paid_labor_val)
    sums = tally_rows(
        cases,
        hhold_df,
        group_var,
        {
            "produce": flag(coded(hhold_df, produce_var) == produce_val),
            "hhold_only": flag(hhold & ~free & ~paid),
            "external_only": flag(~hhold & (free | paid)),
            "hhold_labor": flag(hhold),
            "paid_labor": flag(paid),
            "free_labor": flag(free),
        },
    )
    stats = sums.select(
        group_var, "produce", *(_share(name, name, "produce") for name in LABOR_KINDS)
    )
    return monitoring_table(
        "sector_labor", group_var, stats, title=table_title, fill={"label": sector_label}
    )


# Income


def income_sources(
    hhold_df: DataFrame,
    crop_var: str,
    livestock_var: str,
    temp_crop_df: DataFrame,
    temp_crop_var: str,
    temp_crop_val: int = YES,
    *,
    perm_crop_df: DataFrame,
    perm_crop_var: str,
    perm_crop_val: int = YES,
    processed_df: DataFrame,
    processed_var: str,
    processed_val: int = YES,
    anim_df: DataFrame,
    sold_live_anim_var: str,
    slaughter_anim_var: str,
    slaughter_anim_val: int = YES,
    sold_live_poultry_var: str,
    slaughter_poultry_var: str,
    slaughter_poultry_val: int = YES,
    milk_var: str,
    milk_val: int = YES,
    eggs_var: str,
    eggs_val: int = YES,
    oth_anim_prod_df: DataFrame,
    oth_anim_var: str,
    oth_anim_val: int = YES,
    cases: DataFrame,
    group_var: str,
) -> MonitoringTable:
    """Households engaged in agriculture and what they sell.

    Crops and processed crops count every sale, animal products count the
    households with any sale.
    """
    rows = stack(
        (
            hhold_df,
            {
                "hholds": F.lit(1),
                "any_ag": (coded(hhold_df, crop_var) == YES)
                | (coded(hhold_df, livestock_var) == YES),
            },
        ),
        (temp_crop_df, {"temp_crop": coded(temp_crop_df, temp_crop_var) == temp_crop_val}),
        (perm_crop_df, {"perm_crop": coded(perm_crop_df, perm_crop_var) == perm_crop_val}),
        (processed_df, {"processed": coded(processed_df, processed_var) == processed_val}),
        (
            anim_df,
            {
                "anim_sold": (coded(anim_df, sold_live_anim_var) > 0)
                | (coded(anim_df, sold_live_poultry_var) > 0),
                "anim_killed": (coded(anim_df, slaughter_anim_var) == slaughter_anim_val)
                | (coded(anim_df, slaughter_poultry_var) == slaughter_poultry_val),
                "milk_sold": coded(anim_df, milk_var) == milk_val,
                "eggs_sold": coded(anim_df, eggs_var) == eggs_val,
            },
        ),
        (
            oth_anim_prod_df,
            {"anim_prod_sold": coded(oth_anim_prod_df, oth_anim_var) == oth_anim_val},
        ),
    )
    crops = ("temp_crop", "perm_crop", "processed")
    animals = ("anim_sold", "anim_killed", "milk_sold", "eggs_sold", "anim_prod_sold")
    rolled = roll_up(
        rows,
        {
            "hholds": F.count("hholds"),
            **{name: F.count_if(F.col(name)) for name in ("any_ag", *crops, *animals)},
        },
    )
    sums = sum_by_group(
        attach(cases, rolled, group_var),
        group_var,
        {
            "n_hholds": F.sum(padded(F.col("hholds"))),
            "n_any_ag": F.sum("any_ag"),
            **{name: F.sum(name) for name in crops},
            **{name: F.count_if(F.col(name) > 0) for name in animals},
        },
    )
    stats = sums.select(
        group_var,
        "n_hholds",
        "n_any_ag",
        *(_share(name, name, "n_any_ag") for name in (*crops, *animals)),
    )
    return monitoring_table("income_sources", group_var, stats)
