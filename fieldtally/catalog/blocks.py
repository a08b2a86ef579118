"""The building blocks as queries of their own, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtally.catalog.frames import LABELS, survey_cte, survey_frame
from fieldtally.catalog.report_sql import REPORT_SQL, share
from fieldtally.catalog.reports import (
    DK,
    TEMPORARY_CROPS,
    USE_VALS,
    report_table,
    temp_crop_harvest_report,
)
from fieldtally.functions.labels import decode, value_label_frame
from fieldtally.functions.options import (
    any_option,
    option_columns,
    option_counts,
    option_dummies,
)
from fieldtally.functions.semantics import (
    any_true,
    any_true_or_unknown,
    flag,
    null_for_nan,
    row_total,
    safe_ratio,
    total,
)
from fieldtally.operators.joins import (
    case_roster_join,
    multiway_case_join,
    null_safe_left_join,
)
from fieldtally.operators.rollup import (
    CASE_KEY,
    attach,
    roll_up,
    stack,
    sum_by_group,
    tally,
    tally_codes,
)
from fieldtally.plans.table import format_cell, read_report
from fieldtally.sources.exports import read_export
from fieldtally.sources.frames import check_cases, load_frame, normalize_missing
from fieldtally.sources.questionnaire import questionnaire_labels, questions
from fieldtally.sources.shared import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Block:
    query: Query
    sql: str


BLOCKS: dict[str, Block] = {}


def _block(key: str, sql: str) -> Callable[[Query], Query]:
    """Register the decorated query under ``key``, with the SQL to check it."""

    def register(query: Query) -> Query:
        BLOCKS[key] = Block(query, sql)
        return query

    return register


def _codes(codes: list[int]) -> str:
    return ", ".join(str(c) for c in codes)


def _label_values_sql(frame: str, variable: str) -> str:
    quote = "'"
    rows = ", ".join(
        f"({code}, '{text.replace(quote, quote * 2)}')"
        for code, text in LABELS[frame, variable]
    )
    return f"(SELECT * FROM (VALUES {rows}) v(value, label))"


# Labels


@_block(
    "label_values",
    survey_cte("plots")
    + f"""SELECT 'plot_use' AS var, v.value AS value, COUNT(plot_use) AS n
    FROM {_label_values_sql("plots", "plot_use")} v LEFT JOIN plots ON plot_use = v.value
    GROUP BY v.value""",
)
def label_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each labelled code was chosen, unused codes included."""
    plots = survey_frame(spark, sf_dir, "plots")
    chosen = plots.groupBy("plot_use").agg(F.count("plot_use").alias("n"))
    labels = value_label_frame(spark, plots, ["plot_use"])
    return labels.join(chosen, F.col("value") == F.col("plot_use"), "left").select(
        "var", "value", F.coalesce("n", F.lit(0)).alias("n")
    )


@_block(
    "label_texts",
    survey_cte("plots")
    + f"""SELECT COALESCE(v.label, 'no answer') AS answer, COUNT(*) AS n
    FROM plots LEFT JOIN {_label_values_sql("plots", "plot_use")} v ON plot_use = v.value
    GROUP BY 1""",
)
def label_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plots by decoded use, counted by code before the codes are decoded."""
    plots = survey_frame(spark, sf_dir, "plots")
    labels = value_label_frame(spark, plots, ["plot_use"])
    counted = plots.groupBy("plot_use").agg(F.count(F.lit(1)).alias("n"))
    return decode(counted, "plot_use", labels, "answer").select(
        F.coalesce("answer", F.lit("no answer")).alias("answer"), "n"
    )


@_block(
    "column_labels",
    survey_cte("plots")
    + f"""SELECT concat('plot_use__', CAST(v.value AS STRING)) AS statistic,
      concat(v.label, ' (', CAST(v.value AS STRING), ')') AS label, COUNT(plot_use) AS n
    FROM {_label_values_sql("plots", "plot_use")} v LEFT JOIN plots ON plot_use = v.value
    GROUP BY v.value, v.label""",
)
def column_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headings of the option columns, with how often each option was chosen."""
    plots = survey_frame(spark, sf_dir, "plots")
    options = report_table(spark, sf_dir, "plot_use").dictionary().filter("spanner IS NOT NULL")
    names = [c for c in option_dummies(plots, "plot_use").columns if c not in plots.columns]
    counts = (
        option_dummies(plots, "plot_use")
        .agg(*(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names))
        .unpivot([], names, "statistic", "n")
    )
    return options.join(counts, "statistic").select("statistic", "label", "n")


@_block(
    "option_dummies",
    survey_cte("plots")
    + """SELECT interview__id,
      """
    + ",\n      ".join(
        f"CAST(SUM(CASE WHEN plot_use = {v} THEN 1 ELSE 0 END) AS BIGINT) AS plot_use__{v}"
        for v in (1, 2, 3, 4)
    )
    + """, COUNT(*) - COUNT(plot_use) AS no_answer
    FROM plots GROUP BY interview__id""",
)
def option_dummy_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dummies of a single-select answer, summed per interview."""
    plots = option_dummies(survey_frame(spark, sf_dir, "plots"), "plot_use")
    names = [f"plot_use__{v}" for v in (1, 2, 3, 4)]
    return plots.groupBy(CASE_KEY).agg(
        *(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names),
        F.count_if(F.col(names[0]).isNull()).alias("no_answer"),
    )


# Missing values and options


@_block(
    "null_ratio",
    survey_cte("livestock")
    + """SELECT interview__id, CASE WHEN SUM(p) > 0 THEN CAST(SUM(s) AS DOUBLE) / SUM(p) END AS sold
    FROM (SELECT interview__id, CASE WHEN produced = 1 THEN 1 ELSE 0 END AS p,
            CASE WHEN sold = 1 THEN 1 ELSE 0 END AS s FROM livestock) r
    GROUP BY interview__id""",
)
def null_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares that arrive as NaN turned into NULL."""
    counts = roll_up(
        survey_frame(spark, sf_dir, "livestock"),
        {
            "n": F.count_if(F.col("sold") == 1),
            "d": F.count_if(F.col("produced") == 1),
        },
    )
    with_nan = counts.select(
        CASE_KEY,
        F.when(F.col("d") == 0, F.lit(float("nan")))
        .otherwise(F.col("n").cast("double") / F.col("d"))
        .alias("sold"),
    )
    return null_for_nan(with_nan)


@_block(
    "any_option",
    survey_cte("parcels")
    + """SELECT CASE WHEN use__1 = 1 OR use__n98 = 1 THEN 'yes'
           WHEN NOT (use__1 = 1 OR use__n98 = 1) THEN 'no' ELSE 'unknown' END AS agricultural,
      COUNT(*) AS n FROM parcels GROUP BY 1""",
)
def any_option_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parcels by whether any of two options is selected."""
    parcels = survey_frame(spark, sf_dir, "parcels")
    chosen = any_option(parcels, "use", USE_VALS)
    answer = F.when(chosen, "yes").when(~chosen, "no").otherwise("unknown")
    return parcels.groupBy(answer.alias("agricultural")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _cell_sql(value: str, scale: str = "") -> str:
    return (
        f"CASE WHEN {value} = CAST('infinity' AS DOUBLE) THEN 'Inf' "
        f"ELSE COALESCE(format('{{:,.1f}}', {value}{scale}), '---') END"
    )


def _report_cte(key: str, group_var: str) -> str:
    report = REPORT_SQL[key]
    return f"{survey_cte(*report.frames)}, report AS ({report.text(group_var)})\n"


_GPS_REASONS = ["why_no_gps__1", "why_no_gps__2", "why_no_gps__3", "why_no_gps__4",
                "why_no_gps__5", "why_no_gps__6", "why_no_gps__n98"]


@_block(
    "missing_text",
    _report_cte("parcel_gps", "enumerator")
    + """SELECT enumerator, CAST(parcels AS STRING) AS parcels,
      CAST(not_measured AS STRING) AS not_measured, """
    + ", ".join(f"{_cell_sql(c, ' * 100')} AS {c}" for c in _GPS_REASONS)
    + " FROM report",
)
def missing_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Display cells of a report with empty denominators."""
    return report_table(spark, sf_dir, "parcel_gps", "enumerator").display()


# Joins and filters


@_block(
    "case_roster_join",
    survey_cte("cases", "parcels")
    + """SELECT cases.interview__id, COALESCE(parcel_id, -1) AS parcel_id
    FROM cases LEFT JOIN parcels ON cases.interview__id = parcels.interview__id""",
)
def case_roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row-level join: every case keeps at least one row."""
    cases = survey_frame(spark, sf_dir, "cases").select(CASE_KEY)
    parcels = survey_frame(spark, sf_dir, "parcels").select(CASE_KEY, "parcel_id")
    return case_roster_join(cases, parcels).select(
        CASE_KEY, F.coalesce("parcel_id", F.lit(-1)).alias("parcel_id")
    )


@_block(
    "group_key_join",
    survey_cte("cases", "hhold", "products")
    + """, a AS (SELECT team, CAST(SUM(CASE WHEN practice = 1 THEN 1 ELSE 0 END) AS BIGINT) AS practice
       FROM cases LEFT JOIN hhold ON cases.interview__id = hhold.interview__id GROUP BY team),
    b AS (SELECT team, CAST(SUM(CASE WHEN sold = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_sold
       FROM cases JOIN products ON cases.interview__id = products.interview__id GROUP BY team)
    SELECT a.team, practice, COALESCE(n_sold, -1) AS n_sold
    FROM a LEFT JOIN b ON a.team IS NOT DISTINCT FROM b.team""",
)
def group_key_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two statistics frames joined on the group, NULL group included."""
    cases = survey_frame(spark, sf_dir, "cases")

    def counted(frame: str, variable: str, name: str, keep: bool) -> DataFrame:
        rolled = roll_up(
            survey_frame(spark, sf_dir, frame), {name: F.count_if(F.col(variable) == 1)}
        )
        joined = attach(cases, rolled, "team", keep_unmatched=keep)
        return sum_by_group(joined, "team", {name: F.sum(name)})

    return null_safe_left_join(
        counted("hhold", "practice", "practice", True),
        counted("products", "sold", "n_sold", False),
        "team",
    ).select("team", "practice", F.coalesce("n_sold", F.lit(-1)).alias("n_sold"))


@_block(
    "composite_key_join",
    survey_cte("cases", "hhold")
    + """SELECT cases.interview__id, cases.team,
      CASE WHEN grew_crops = 1 THEN 1 ELSE 0 END AS grew
    FROM cases LEFT JOIN hhold ON cases.interview__id = hhold.interview__id""",
)
def composite_key_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Join on interview and team, where a NULL team matches a NULL team."""
    cases = survey_frame(spark, sf_dir, "cases").select(CASE_KEY, "team")
    hhold = survey_frame(spark, sf_dir, "hhold").select(CASE_KEY, "grew_crops")
    flags = multiway_case_join(cases, hhold).select(
        CASE_KEY, "team", flag(F.col("grew_crops") == 1).alias("grew")
    )
    return null_safe_left_join(cases, flags, [CASE_KEY, "team"])


@_block(
    "multiway_case_join",
    survey_cte("cases", "parcels", "crop_sales", "livestock")
    + """, p AS (SELECT interview__id, COUNT(*) AS n FROM parcels GROUP BY 1),
    s AS (SELECT interview__id, COUNT(*) AS n FROM crop_sales WHERE sold = 1 GROUP BY 1),
    l AS (SELECT interview__id, COUNT(*) AS n FROM livestock WHERE milk = 1 GROUP BY 1)
    SELECT cases.interview__id, COALESCE(p.n, 0) AS n_parcels, COALESCE(s.n, 0) AS n_sales,
      COALESCE(l.n, 0) AS n_milk
    FROM cases LEFT JOIN p ON cases.interview__id = p.interview__id
      LEFT JOIN s ON cases.interview__id = s.interview__id
      LEFT JOIN l ON cases.interview__id = l.interview__id""",
)
def multiway_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several rolled-up rosters joined to the cases on one key."""
    rolled = {
        "n_parcels": ("parcels", F.count(F.lit(1))),
        "n_sales": ("crop_sales", F.count_if(F.col("sold") == 1)),
        "n_milk": ("livestock", F.count_if(F.col("milk") == 1)),
    }
    frames = [
        roll_up(survey_frame(spark, sf_dir, frame), {name: expr})
        for name, (frame, expr) in rolled.items()
    ]
    cases = survey_frame(spark, sf_dir, "cases").select(CASE_KEY)
    return multiway_case_join(cases, *frames).fillna(0)


@_block(
    "filter_in",
    survey_cte("crops")
    + f"""SELECT crop_id, COUNT(*) AS n FROM crops
    WHERE crop_id IN ({_codes(TEMPORARY_CROPS)}) GROUP BY crop_id""",
)
def filter_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose code is in a list."""
    crops = survey_frame(spark, sf_dir, "crops")
    kept = crops.filter(F.col("crop_id").isin(TEMPORARY_CROPS))
    return kept.groupBy("crop_id").agg(F.count(F.lit(1)).alias("n"))


@_block(
    "filter_not_missing",
    survey_cte("crop_sales")
    + f"""SELECT crop_id, COUNT(*) AS n,
      CAST(SUM(CASE WHEN amt_total = {DK} THEN 1 ELSE 0 END) AS BIGINT) AS n_dk
    FROM crop_sales WHERE crop_id IS NOT NULL GROUP BY crop_id""",
)
def filter_not_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose key is present."""
    sales = survey_frame(spark, sf_dir, "crop_sales")
    return (
        sales.filter(F.col("crop_id").isNotNull())
        .groupBy("crop_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("amt_total") == DK).alias("n_dk"),
        )
    )


@_block(
    "row_sum",
    survey_cte("hhold")
    + """SELECT interview__id, COALESCE(animal__10, 0) + COALESCE(animal__12, 0)
      + COALESCE(animal__13, 0) + COALESCE(animal__14, 0) + COALESCE(animal__51, 0)
      + COALESCE(animal__52, 0) + COALESCE(animal__53, 0) AS n_animals,
      CASE WHEN paid__1 + paid__2 IS NULL THEN 'unknown'
           ELSE CAST(paid__1 + paid__2 AS STRING) END AS paid
    FROM hhold""",
)
def row_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Horizontal sums over option columns, skipping missing answers or not."""
    hhold = survey_frame(spark, sf_dir, "hhold")
    animals = [F.col(c) for c in option_columns(hhold, "animal")]
    paid = [F.col(c) for c in option_columns(hhold, "paid")]
    strict = row_total(paid, skip_missing=False).cast("string")
    return hhold.select(
        CASE_KEY,
        row_total(animals).alias("n_animals"),
        F.coalesce(strict, F.lit("unknown")).alias("paid"),
    )


# Aggregates


@_block(
    "two_level_agg",
    survey_cte("cases", "members")
    + """, w AS (SELECT interview__id, MAX(CASE WHEN worked = 1 THEN 1 ELSE 0 END) AS w
       FROM members GROUP BY interview__id)
    SELECT team, COUNT(*) AS n_cases, CAST(SUM(COALESCE(w, 0)) AS BIGINT) AS n_worked
    FROM cases LEFT JOIN w ON cases.interview__id = w.interview__id GROUP BY team""",
)
def two_level_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members to interviews, interviews to teams."""
    rolled = roll_up(
        survey_frame(spark, sf_dir, "members"),
        {"worked": F.count_if(F.col("worked") == 1)},
    )
    joined = attach(survey_frame(spark, sf_dir, "cases"), rolled, "team")
    return sum_by_group(
        joined,
        "team",
        {
            "n_cases": F.count(F.lit(1)),
            "n_worked": F.count_if(F.col("worked") > 0),
        },
    )


@_block(
    "distinct_keys",
    survey_cte("cases", "plots")
    + """SELECT team, COUNT(DISTINCT cases.interview__id) AS n_interviews,
      COUNT(DISTINCT CASE WHEN parcel_id IS NOT NULL THEN (cases.interview__id, parcel_id) END)
        AS n_parcels,
      COUNT(DISTINCT (cases.interview__id, parcel_id, plot_id)) AS n_plots
    FROM cases LEFT JOIN plots ON cases.interview__id = plots.interview__id GROUP BY team""",
)
def distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct interviews, tuples without missing parts, tuples with them.

    The tuples are narrowed level by level, which needs no row expansion.
    """
    plots = survey_frame(spark, sf_dir, "plots")
    per_parcel = (
        plots.groupBy(CASE_KEY, "parcel_id", "plot_id")
        .agg(F.lit(1).alias("one"))
        .groupBy(CASE_KEY, "parcel_id")
        .agg(F.count("one").alias("plots"))
    )
    rolled = roll_up(
        per_parcel, {"n_parcels": F.count("parcel_id"), "n_plots": F.sum("plots")}
    )
    cases = survey_frame(spark, sf_dir, "cases")
    return sum_by_group(
        attach(cases, rolled, "team", unmatched={"n_plots": 1}),
        "team",
        {
            "n_interviews": F.count_distinct(CASE_KEY),
            "n_parcels": F.sum("n_parcels"),
            "n_plots": F.sum("n_plots"),
        },
    )


@_block(
    "any_flags",
    survey_cte("cases", "members")
    + """SELECT cases.interview__id, MAX(CASE WHEN worked = 1 THEN 1 ELSE 0 END) AS skipping,
      CASE WHEN MAX(CASE WHEN worked = 1 THEN 1 ELSE 0 END) = 1 THEN 'yes'
           WHEN COUNT(*) > COUNT(worked) THEN 'unknown' ELSE 'no' END AS strict
    FROM cases LEFT JOIN members ON cases.interview__id = members.interview__id
    GROUP BY cases.interview__id""",
)
def any_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """'Any member worked' with missing answers skipped, and with them respected."""
    worked = F.col("worked") == 1
    cases = survey_frame(spark, sf_dir, "cases").select(CASE_KEY)
    members = survey_frame(spark, sf_dir, "members")
    flags = roll_up(
        members, {"skipping": any_true(worked), "strict": any_true_or_unknown(worked)}
    )
    strict = F.col("strict")
    return multiway_case_join(cases, flags).select(
        CASE_KEY,
        flag(F.col("skipping")).alias("skipping"),
        F.when(strict, "yes").when(~strict, "no").otherwise("unknown").alias("strict"),
    )


@_block(
    "option_pivot",
    survey_cte("cases", "plots")
    + "SELECT team, "
    + ", ".join(
        f"CAST(SUM(CASE WHEN plot_use = {v} THEN 1 ELSE 0 END) AS BIGINT) AS plot_use__{v}"
        for v in (1, 2, 3, 4)
    )
    + """ FROM cases LEFT JOIN plots ON cases.interview__id = plots.interview__id GROUP BY team""",
)
def option_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per code as columns."""
    plots = survey_frame(spark, sf_dir, "plots")
    cases = survey_frame(spark, sf_dir, "cases")
    return tally(cases, plots, "team", option_counts(plots, "plot_use"))


_MANY = 1000
_ITEMS = """SELECT concat('C', CAST(o_custkey AS STRING)) AS interview__id,
      CASE WHEN l_partkey % 77 = 0 THEN NULL ELSE CAST(l_partkey % 1100 AS INT) END AS item
    FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey"""


@_block(
    "option_pivot_many",
    survey_cte("cases")
    + f", items AS ({_ITEMS.format(lineitem='lineitem', orders='orders')})\n"
    + "SELECT team, COUNT(*) AS n_items, "
    + ", ".join(
        f"CAST(SUM(CASE WHEN item = {v} THEN 1 ELSE 0 END) AS BIGINT) AS item__{v}"
        for v in range(_MANY)
    )
    + " FROM cases LEFT JOIN items ON cases.interview__id = items.interview__id GROUP BY team",
)
def option_pivot_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per code as columns for a question with a thousand options."""
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("lineitem", "orders")}
    items = spark.sql(_ITEMS, **tables)
    names = {v: f"item__{v}" for v in range(_MANY)}
    cases = survey_frame(spark, sf_dir, "cases")
    return tally_codes(cases, items, "team", F.col("item"), names, rows="n_items")


@_block(
    "derived_flags",
    survey_cte("hhold")
    + """SELECT interview__id, CASE WHEN grew_crops = 1 THEN 1 ELSE 0 END AS grew,
      CASE WHEN labor__4 = 1 OR labor__5 = 1 THEN 'yes'
           WHEN NOT (labor__4 = 1 OR labor__5 = 1) THEN 'no' ELSE 'unknown' END AS outside,
      CASE WHEN labor__1 = 1 AND NOT labor__5 = 1 THEN 'yes'
           WHEN NOT (labor__1 = 1 AND NOT labor__5 = 1) THEN 'no' ELSE 'unknown' END AS unpaid
    FROM hhold""",
)
def derived_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived columns: a flag with a missing branch, and three-valued conditions."""

    def answer(condition: Column) -> Column:
        return F.when(condition, "yes").when(~condition, "no").otherwise("unknown")

    hhold = survey_frame(spark, sf_dir, "hhold")
    own, paid = F.col("labor__1") == 1, F.col("labor__5") == 1
    return hhold.select(
        CASE_KEY,
        flag(F.col("grew_crops") == 1).alias("grew"),
        answer(any_option(hhold, "labor", [4, 5])).alias("outside"),
        answer(own & ~paid).alias("unpaid"),
    )


@_block(
    "group_count",
    survey_cte("cases") + "SELECT team, COUNT(*) AS n FROM cases GROUP BY team",
)
def group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per group; a missing group is a group."""
    cases = survey_frame(spark, sf_dir, "cases")
    return sum_by_group(cases, "team", {"n": F.count(F.lit(1))})


@_block(
    "null_skipping_sum",
    survey_cte("livestock")
    + """SELECT interview__id, CAST(COALESCE(SUM(n_poultry_live), 0) AS BIGINT) AS n_poultry,
      CAST(SUM(CASE WHEN eggs = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_eggs
    FROM livestock GROUP BY interview__id""",
)
def null_skipping_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of a number and of a condition; all missing adds up to 0."""
    return roll_up(
        survey_frame(spark, sf_dir, "livestock"),
        {
            "n_poultry": total(F.col("n_poultry_live")),
            "n_eggs": F.count_if(F.col("eggs") == 1),
        },
    )


@_block(
    "first_value",
    survey_cte("cases", "parcels")
    + """SELECT cases.interview__id, MIN(team) AS team, COUNT(parcel_id) AS n_parcels
    FROM cases LEFT JOIN parcels ON cases.interview__id = parcels.interview__id
    GROUP BY cases.interview__id""",
)
def first_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of an interview taken from its rows, of which one is the case.

    The roster is reduced to a count per interview first, so that the first value,
    for which Spark sorts, is taken over two rows per interview. No join is needed.
    """
    counts = roll_up(
        survey_frame(spark, sf_dir, "parcels"), {"n_parcels": F.count("parcel_id")}
    )
    rows = stack(
        (survey_frame(spark, sf_dir, "cases"), {"case": F.lit(1), "team": F.col("team")}),
        (counts, {"n_parcels": F.col("n_parcels")}),
    )
    rolled = roll_up(
        rows,
        {
            "cases": F.count("case"),
            "team": F.first("team", ignorenulls=True),
            "n_parcels": total(F.col("n_parcels")),
        },
    )
    return rolled.filter("cases > 0").drop("cases")


@_block(
    "ratio_of_sums",
    survey_cte("livestock")
    + f"""SELECT interview__id, {share("d", "s")} AS dk_per_sale,
      {share("s", "p")} AS sales_per_product FROM (
      SELECT interview__id, SUM(CASE WHEN produced = 1 THEN 1 ELSE 0 END) AS p,
        SUM(CASE WHEN sold = 1 THEN 1 ELSE 0 END) AS s,
        SUM(CASE WHEN amt_total = {DK} THEN 1 ELSE 0 END) AS d
      FROM livestock GROUP BY interview__id) r""",
)
def ratio_of_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chained ratios, each from the sums themselves."""
    sums = roll_up(
        survey_frame(spark, sf_dir, "livestock"),
        {
            "p": F.count_if(F.col("produced") == 1),
            "s": F.count_if(F.col("sold") == 1),
            "d": F.count_if(F.col("amt_total") == DK),
        },
    )
    return sums.select(
        CASE_KEY,
        safe_ratio(F.col("d"), F.col("s")).alias("dk_per_sale"),
        safe_ratio(F.col("s"), F.col("p")).alias("sales_per_product"),
    )


@_block(
    "columns_by_prefix",
    survey_cte("cases", "hhold")
    + "SELECT team, "
    + ", ".join(
        f"CAST(COALESCE(SUM(animal__{c}), 0) AS BIGINT) AS animal__{c}"
        for c in (10, 12, 13, 14, 51, 52, 53)
    )
    + " FROM cases LEFT JOIN hhold ON cases.interview__id = hhold.interview__id GROUP BY team",
)
def columns_by_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One function over all columns of a question, found by prefix."""
    hhold = survey_frame(spark, sf_dir, "hhold")
    return tally(
        survey_frame(spark, sf_dir, "cases"),
        hhold,
        "team",
        {name: total(F.col(name)) for name in option_columns(hhold, "animal")},
    )


# Sources


@_block(
    "load_frame",
    "SELECT c_custkey, c_mktsegment, c_nationkey FROM customer")
def load_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A frame read with an explicit schema and only the needed columns."""
    return load_frame(
        spark,
        f"{sf_dir}/customer.parquet",
        schema="c_custkey bigint, c_nationkey int, c_acctbal double, c_mktsegment string",
        columns=["c_custkey", "c_mktsegment", "c_nationkey"],
    )


@_block(
    "check_cases_repeated",
    survey_cte("parcels")
    + """, per_id AS (SELECT interview__id, COUNT(*) AS n FROM parcels GROUP BY interview__id)
    SELECT CAST(SUM(n) AS BIGINT) AS n_cases,
      CAST(SUM(CASE WHEN interview__id IS NULL THEN n ELSE 0 END) AS BIGINT) AS n_null_ids,
      COUNT(CASE WHEN interview__id IS NOT NULL AND n > 1 THEN 1 END) AS n_repeated_ids
    FROM per_id""",
)
def check_roster_as_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cases check on a frame that fails it: a roster with repeated ids."""
    return check_cases(survey_frame(spark, sf_dir, "parcels"), "parcel_id")


@_block(
    "check_cases",
    survey_cte("cases")
    + """, per_id AS (SELECT interview__id, COUNT(*) AS n FROM cases GROUP BY interview__id)
    SELECT CAST(SUM(n) AS BIGINT) AS n_cases,
      CAST(SUM(CASE WHEN interview__id IS NULL THEN n ELSE 0 END) AS BIGINT) AS n_null_ids,
      COUNT(CASE WHEN interview__id IS NOT NULL AND n > 1 THEN 1 END) AS n_repeated_ids
    FROM per_id""",
)
def check_case_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of cases, missing ids and repeated ids."""
    return check_cases(survey_frame(spark, sf_dir, "cases"), "team")



@_block(
    "normalize_missing",
    survey_cte("parcels")
    + """SELECT interview__id,
      COUNT(CASE WHEN gps_area <> -999999999 THEN 1 END) AS n_areas,
      COUNT(CASE WHEN natag__gps_area IS NOT NULL OR gps_area = -999999999 THEN 1 END) AS n_tagged
    FROM parcels GROUP BY interview__id""",
)
def normalize_gps_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exported missing codes turned into NULL plus tag, counted per interview."""
    parcels = normalize_missing(survey_frame(spark, sf_dir, "parcels"), ["gps_area"])
    return roll_up(
        parcels,
        {"n_areas": F.count("gps_area"), "n_tagged": F.count("natag__gps_area")},
    )


def _written_questions(spark: SparkSession, answers: DataFrame, kind: str) -> str:
    """Path of a JSON-lines questionnaire from rows (variable, value, label)."""
    answer = F.struct(F.col("value").cast("int").alias("value"), "label")
    questions = answers.groupBy("variable").agg(
        F.first(F.lit(kind)).alias("type"), F.sort_array(F.collect_list(answer)).alias("answers")
    )
    path = scratch_path(spark)
    questions.select(F.to_json(F.struct("variable", "type", "answers"))).write.text(path)
    return path


@_block(
    "questionnaire_labels",
    """SELECT concat('item_', CAST(p_partkey AS STRING)) AS var, p_size AS value, p_brand AS label FROM part
    UNION ALL
    SELECT concat('item_', CAST(p_partkey AS STRING)), -98, concat(p_type, ' "other"') FROM part""",
)
def part_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answer labels read from a questionnaire file."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    variable = F.concat(F.lit("item_"), F.col("p_partkey").cast("string")).alias("variable")
    answers = part.select(
        variable, F.col("p_size").alias("value"), F.col("p_brand").alias("label")
    ).unionByName(
        part.select(
            variable,
            F.lit(-98).alias("value"),
            F.concat(F.col("p_type"), F.lit(' "other"')).alias("label"),
        )
    )
    return questionnaire_labels(spark, _written_questions(spark, answers, "multi-select"))


#: Cells of an exported line; some lines have a cell too many or too few.
_EXPORT_CELLS = """SELECT o_orderkey AS key, concat('C', CAST(o_custkey AS STRING)) AS id,
      CASE WHEN o_orderkey % 13 = 0 THEN '.a' WHEN o_orderkey % 11 = 0 THEN '.'
           WHEN o_orderkey % 7 = 0 THEN ' .z' WHEN o_orderkey % 5 = 0 THEN ''
           WHEN o_orderkey % 37 = 0 THEN 'about 2' ELSE concat(CAST(o_custkey AS STRING), '.5') END AS area,
      CASE WHEN o_orderkey % 41 = 0 THEN concat(o_orderpriority, '{tab}', 'more')
           ELSE o_orderpriority END AS note
    FROM {orders}"""
_EXPORT_LINES = f"""SELECT key, id, area, note, CASE WHEN key % 43 = 0 THEN id
      ELSE concat(id, '{{tab}}', CAST(key AS STRING), '{{tab}}', area, '{{tab}}', note) END AS line
    FROM ({_EXPORT_CELLS}) c"""


def _export_sql() -> str:
    lines = _EXPORT_LINES.replace("{tab}", "\t").format(orders="orders")
    return f"""WITH lines AS ({lines}), judged AS (
      SELECT *, CASE WHEN key % 41 = 0 OR key % 43 = 0 THEN 'the line does not have 4 cells'
        WHEN area = 'about 2' THEN 'area is no double: about 2' END AS reason FROM lines)
    SELECT id AS interview__id, key AS parcel_id, TRY_CAST(area AS DOUBLE) AS area,
      CASE WHEN area LIKE '%.a' THEN 'a' WHEN area LIKE '%.z' THEN 'z' ELSE '-' END AS tag,
      note, '-' AS line, '-' AS reason FROM judged WHERE reason IS NULL
    UNION ALL
    SELECT '-', -1, NULL, '-', '-', line, reason FROM judged WHERE reason IS NOT NULL"""


@_block("read_export", _export_sql())
def read_written_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tab-separated export with missing codes and broken lines, written and read."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    lines = spark.sql(_EXPORT_LINES.replace("{tab}", "\t"), orders=orders)
    path = scratch_path(spark)
    # one cell per line, its name the header line that each file starts with
    header = "\t".join(("interview__id", "parcel_id", "area", "note"))
    lines.select(F.col("line").alias(header)).write.csv(path, sep="\x01", header=True)
    schema = "interview__id string, parcel_id bigint, area double, note string"
    export = read_export(spark, path, schema)
    columns = ["interview__id", "parcel_id", "area", "tag", "note", "line", "reason"]
    rows = export.rows.withColumnRenamed("natag__area", "tag").drop("natag__parcel_id")
    both = rows.unionByName(export.rejected, allowMissingColumns=True).select(columns)
    text = {c: "-" for c in ("interview__id", "tag", "note", "line", "reason")}
    return both.fillna({**text, "parcel_id": -1})


@_block(
    "questionnaire_document",
    """SELECT concat('Questionnaire ', CAST(p_partkey // 100 AS STRING)) AS document,
      concat('Section ', CAST(p_size % 3 AS STRING), '/', p_brand) AS sections,
      replace(lower(p_brand), '#', '_') AS rosters,
      concat('item_', CAST(p_partkey AS STRING)) AS variable, p_name AS text,
      CAST(value AS INTEGER) AS value, label
    FROM part, LATERAL (SELECT p_size AS value, p_brand AS label
      UNION ALL SELECT -98, concat(p_type, ' "other"')) a""",
)
def questionnaire_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answer labels read from nested questionnaire documents, three levels deep."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")

    def answer(value: Column, label: Column) -> Column:
        return F.struct(value.cast("string").alias("AnswerValue"), label.alias("AnswerText"))

    question = F.struct(
        F.lit("MultyOptionsQuestion").alias("$type"),
        F.concat(F.lit("item_"), F.col("p_partkey").cast("string")).alias("VariableName"),
        F.col("p_name").alias("QuestionText"),
        F.array(
            answer(F.col("p_size"), F.col("p_brand")),
            answer(F.lit(-98), F.concat("p_type", F.lit(' "other"'))),
        ).alias("Answers"),
    )

    def group(title: Column, roster: bool, name: Column) -> Column:
        return F.struct(
            F.lit("Group").alias("$type"),
            title.alias("Title"),
            F.lit(roster).alias("IsRoster"),
            name.alias("VariableName"),
            F.col("children").alias("Children"),
        )

    # a document has a hundred questions
    number = F.floor(F.col("p_partkey") / 100).alias("number")
    section = F.concat(F.lit("Section "), (F.col("p_size") % 3).cast("string")).alias("section")
    rosters = part.groupBy(number, section, "p_brand").agg(F.collect_list(question).alias("children"))
    name = F.replace(F.lower("p_brand"), F.lit("#"), F.lit("_"))
    sections = rosters.groupBy("number", "section").agg(
        F.collect_list(group(F.col("p_brand"), True, name)).alias("children")
    )
    documents = sections.groupBy("number").agg(
        F.collect_list(group(F.col("section"), False, F.lit(""))).alias("children")
    )
    title = F.concat(F.lit("Questionnaire "), F.col("number").cast("string"))
    whole = F.struct(title.alias("Title"), F.col("children").alias("Children"))
    path = scratch_path(spark)
    documents.select(F.to_json(whole)).write.text(path)
    found = questions(spark, path, "documents")
    return found.select(
        "document",
        F.array_join("sections", "/").alias("sections"),
        F.array_join("rosters", "/").alias("rosters"),
        "variable",
        "text",
        F.inline("answers"),
    )


# Display


@_block(
    "format_share",
    _report_cte("crops_per_plot", "enumerator").replace("report AS", "plots_report AS")
    + f"""SELECT enumerator, CAST(n_crops AS STRING) AS n_crops,
      {_cell_sql("mean_crops")} AS mean_crops,
      {_cell_sql("n_plots / CAST(n_crops AS DOUBLE)", " * 100")} AS plots_per_crop
    FROM plots_report""",
)
def format_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, averages and percentages as text."""
    stats = report_table(spark, sf_dir, "crops_per_plot", "enumerator").stats
    ratio = F.col("n_plots").cast("double") / F.col("n_crops")
    return stats.select(
        "enumerator",
        format_cell(F.col("n_crops"), "N").alias("n_crops"),
        format_cell(F.col("mean_crops"), "AVG").alias("mean_crops"),
        format_cell(ratio, "%").alias("plots_per_crop"),
    )


@_block(
    "display_table",
    _report_cte("parcels_per_hhold", "team")
    + f"""SELECT COALESCE(team, '---') AS team, CAST(interviews AS STRING) AS interviews,
      CAST(parcels AS STRING) AS parcels, {_cell_sql("ag", " * 100")} AS ag,
      {_cell_sql("non_ag", " * 100")} AS non_ag FROM report""",
)
def display_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report as formatted text, groups in order."""
    return report_table(spark, sf_dir, "parcels_per_hhold").display()


def _cells_sql(
    key: str, title: str, columns: Sequence[tuple[str, str, str, str, str]], n_of: str = "team"
) -> str:
    """One row per cell with what the dictionary says of its column.

    ``columns`` are (statistic, label, spanner, kind, footnote); labels in braces
    are SQL.
    """

    def text(value: str) -> str:
        return value[1:-1] if value.startswith("{") else "'" + value.replace("'", "''") + "'"

    cells = (
        f"SELECT {n_of}, '{title}' AS title, CAST({i} AS INTEGER) AS position, "
        f"'{name}' AS statistic, {text(label)} AS label, {text(spanner)} AS spanner, "
        f"'{kind}' AS kind, {text(note)} AS footnote, CAST({name} AS DOUBLE) AS value FROM report"
        for i, (name, label, spanner, kind, note) in enumerate(columns, start=1)
    )
    report = REPORT_SQL[key]
    whole = survey_cte(*report.frames) + report.text(n_of)
    return f"WITH report AS ({whole})\n" + " UNION ALL ".join(cells)


def _cells(stats: DataFrame, dictionary: DataFrame, group_var: str) -> DataFrame:
    """Cells of a report joined to its dictionary."""
    names = [c for c in stats.columns if c != group_var]
    values = F.array(
        *(F.struct(F.lit(n).alias("statistic"), F.col(n).cast("double").alias("value")) for n in names)
    )
    return (
        stats.select(group_var, F.inline(values))
        .join(dictionary, "statistic")
        .select(
            group_var, "title", "position", "statistic", "label", "spanner", "kind", "footnote", "value"
        )
        .fillna({"spanner": "-", "footnote": "-"})
    )


_TYPES = "Labor types (%)"
_LABOR_NOTE = (
    "Percentages may not sum to 100. Households may have multiple sources of crop labor."
)


@_block(
    "table_dictionary",
    _cells_sql(
        "crop_labor",
        "Crop labor inputs",
        (
            ("grew_crops", "Grew crops (N)", "-", "N", "-"),
            ("hhold_only", "Household labor only (%)", "-", "%", "-"),
            ("external_only", "External labor only (%)", "-", "%", "-"),
            ("hhold_labor", "Household", _TYPES, "%", _LABOR_NOTE),
            ("paid_labor", "Paid", _TYPES, "%", _LABOR_NOTE),
            ("free_labor", "Free/exchange", _TYPES, "%", _LABOR_NOTE),
        ),
        "enumerator",
    ),
)
def table_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dictionary of a report, joined to its cells."""
    table = report_table(spark, sf_dir, "crop_labor", "enumerator")
    return _cells(table.stats, table.dictionary(), "enumerator")


@_block(
    "labelled_cells",
    _report_cte("parcels_per_hhold", "enumerator")
    + " UNION ALL ".join(
        f"SELECT enumerator, '{name}' AS statistic, '{label}' AS label, "
        f"{spanner} AS spanner, '{kind}' AS kind, CAST({name} AS DOUBLE) AS value, "
        f"{text} AS text FROM report"
        for name, label, spanner, kind, text in (
            ("interviews", "Interviews (N)", "'-'", "N", "CAST(interviews AS STRING)"),
            ("parcels", "Total parcels (N)", "'-'", "N", "CAST(parcels AS STRING)"),
            ("ag", "Agricultural", "'Parcels (%)'", "%", _cell_sql("ag", " * 100")),
            (
                "non_ag",
                "Non-agricultural",
                "'Parcels (%)'",
                "%",
                _cell_sql("non_ag", " * 100"),
            ),
        )
    ),
)
def labelled_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of a report with their labels, spanners and kinds."""
    table = report_table(spark, sf_dir, "parcels_per_hhold", "enumerator")
    return table.labelled_cells().fillna({"spanner": "-"})


_REASON = "Why not harvested (%)"


@_block(
    "temp_crop_harvest_labelled",
    _cells_sql(
        "temp_crop_harvest",
        "Prevalence of temporary crop harvest",
        (
            ("planted", "Planted (N)", "-", "N", "-"),
            ("harvested", "Harvested (%)", "-", "%", "-"),
            *(
                (name, "{(SELECT r_name FROM region WHERE r_regionkey = " + key + ")}", _REASON, "%", "-")
                for name, key in (("why_not__1", "1"), ("why_not__2", "2"), ("why_not__n98", "0"))
            ),
        ),
    ),
)
def temp_crop_harvest_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report whose headings come from a questionnaire file."""
    region = spark.read.parquet(f"{sf_dir}/region.parquet")
    code = F.when(F.col("r_regionkey") == 0, -98).otherwise(F.col("r_regionkey"))
    answers = region.select(
        F.lit("why_not").alias("variable"), code.alias("value"), F.col("r_name").alias("label")
    )
    path = _written_questions(spark, answers, "multi-select")
    table = temp_crop_harvest_report(
        lambda name: survey_frame(spark, sf_dir, name), "team", json_qnr_path=path
    )
    return _cells(table.stats, table.dictionary(), "team")


@_block(
    "write_report",
    _cells_sql(
        "crop_types",
        "Crop types, by enumerator",
        (
            ("n_crops", "Crops (N)", "-", "N", "-"),
            ("crop_temp", "Temporary", "Type (%)", "%", "-"),
            ("crop_perm", "Permanent", "Type (%)", "%", "-"),
        ),
        "enumerator",
    ),
)
def write_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report written over a former one; its numbers and its dictionary read back."""
    path = scratch_path(spark)
    report_table(spark, sf_dir, "crop_types", "team").write(path)
    report_table(spark, sf_dir, "crop_types", "enumerator").write(path, "overwrite")
    return _cells(*read_report(spark, path), "enumerator")
