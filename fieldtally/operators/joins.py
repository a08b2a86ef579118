"""Joins between cases, rosters and statistics frames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtally.operators.rollup import CASE_KEY


def case_roster_join(cases: DataFrame, roster: DataFrame) -> DataFrame:
    """Row-level left join; a case without roster rows keeps one row of NULLs.

    Written as an inner join plus the cases the roster lacks.  Adaptive
    execution can split an interview that holds a large part of the roster in an
    inner join, but not on the right side of an outer join.
    """
    matched = cases.join(roster, CASE_KEY)
    lacking = cases.join(roster.select(CASE_KEY).distinct(), CASE_KEY, "left_anti")
    return matched.unionByName(lacking, allowMissingColumns=True)


def multiway_case_join(cases: DataFrame, *rolled: DataFrame) -> DataFrame:
    """Left joins to frames with at most one row per interview, on one shuffle key."""
    return reduce(lambda left, right: left.join(right, CASE_KEY, "left"), rolled, cases)


def null_safe_left_join(
    left: DataFrame, right: DataFrame, on: list[str] | str
) -> DataFrame:
    """Left join in which NULL keys match NULL keys; keys appear once."""
    keys = [on] if isinstance(on, str) else list(on)
    renamed = right.select(
        *(F.col(c).alias(f"__right_{c}") if c in keys else F.col(c) for c in right.columns)
    )
    condition = reduce(
        lambda a, b: a & b,
        (F.col(k).eqNullSafe(F.col(f"__right_{k}")) for k in keys),
    )
    return left.join(renamed, condition, "left").drop(*(f"__right_{k}" for k in keys))


def restrict_to_cases(roster: DataFrame, cases: DataFrame) -> DataFrame:
    """Keep only the roster rows of the given cases.

    Worth calling on a big roster when the cases are a small selection of all
    interviews, for example those of last week: Spark broadcasts the ids when
    they are below its size threshold, so most roster rows are dropped before
    the shuffle.  Reports give the same result with and without it.
    """
    return roster.join(cases.select(CASE_KEY), CASE_KEY, "left_semi")
