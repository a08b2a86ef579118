"""All registered queries and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fieldtally.catalog.blocks import BLOCKS
from fieldtally.catalog.frames import survey_cte
from fieldtally.catalog.report_sql import REPORT_SQL
from fieldtally.catalog.reports import REPORTS, VARIANTS, report_table

#: Query name suffix for each group column the reports run with.
GROUPS = {"": "team", "_by_enumerator": "enumerator"}


def _report_query(key: str, group_var: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: report_table(spark, sf_dir, key, group_var).stats


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    reports = {
        key + suffix: _report_query(key, group_var)
        for suffix, group_var in GROUPS.items()
        for key in (*REPORTS, *VARIANTS)
    }
    return {**reports, **{name: block.query for name, block in BLOCKS.items()}}


def all_sql() -> dict[str, str]:
    reports = {
        key + suffix: survey_cte(*sql.frames) + sql.text(group_var)
        for suffix, group_var in GROUPS.items()
        for key, sql in REPORT_SQL.items()
    }
    return {**reports, **{name: block.sql for name, block in BLOCKS.items()}}
