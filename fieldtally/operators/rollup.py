"""Roll rosters up per interview, attach them to the cases, sum per group.

Every report is a left join from the cases to one or more rosters followed by
sums per group.  The sums are additive, so rosters are first reduced to one row
per interview and only then joined:

* the roll-up combines on the map side, so what is shuffled is narrow counts,
  and an interview holding a large part of a roster arrives as one partial row
  per map task instead of as one huge join key;
* both join sides are then unique on the interview id, so the join cannot
  explode or skew, and it reuses the partitioning the roll-up produced;
* the sum per group again combines on the map side, so a group holding most of
  the cases costs no more than any other.

A left join must keep cases without roster rows, where the plain join would
show one all-NULL row.  ``attach`` fills in what that row would have added.

A roster with one row per interview has nothing to roll up.  ``declare_unique``
says so, and ``tally_rows`` then joins its rows as they are.  Sums come out the
same either way, so a wrong declaration costs time and never changes a result.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Key shared by the cases and all rosters.
CASE_KEY = "interview__id"

#: Mark in the metadata of the key column: one row per interview.
UNIQUE = "one_row_per_interview"


def stack(*parts: tuple[DataFrame, Mapping[str, Column]]) -> DataFrame:
    """Put row-level measures of several rosters into one long frame.

    Each part keeps the interview id and its own measures; measures of the
    other parts are NULL.  One roll-up over the stack replaces a shuffle and a
    join per roster.  Parts that hold the same DataFrame object are one part, so
    their roster is read once.
    """
    merged: dict[int, tuple[DataFrame, dict[str, Column]]] = {}
    for frame, measures in parts:
        merged.setdefault(id(frame), (frame, {}))[1].update(measures)
    frames = [
        frame.select(CASE_KEY, *(expr.alias(name) for name, expr in measures.items()))
        for frame, measures in merged.values()
    ]
    return reduce(
        lambda left, right: left.unionByName(right, allowMissingColumns=True), frames
    )


def roll_up(frame: DataFrame, measures: Mapping[str, Column]) -> DataFrame:
    """One row per interview, holding the given aggregates."""
    return frame.groupBy(CASE_KEY).agg(
        *(expr.alias(name) for name, expr in measures.items())
    )


def declare_unique(frame: DataFrame) -> DataFrame:
    """The same frame, declared to hold at most one row per interview.

    The mark is part of the schema and survives ``filter``, ``select`` and parquet.
    ``sources.frames.assert_unique`` declares it too and lets the job fail where it
    does not hold.
    """
    known = frame.schema[CASE_KEY].metadata
    return frame.withMetadata(CASE_KEY, {**known, UNIQUE: True})


def declared_unique(frame: DataFrame) -> bool:
    return bool(frame.schema[CASE_KEY].metadata.get(UNIQUE))


def attach(
    cases: DataFrame,
    rolled: DataFrame,
    group_var: str,
    unmatched: Mapping[str, int] | None = None,
    keep_unmatched: bool = True,
) -> DataFrame:
    """Cases with their group and their rolled-up measures.

    ``unmatched`` gives the measures of a case without roster rows where they
    differ from 0.  With ``keep_unmatched=False`` such cases are dropped, which
    is what a filter on a roster column does to the row of NULLs.

    Cases are meant to be one row per interview with an id. A repeated case counts
    once per row, and a case without an id meets no roster row, not even one
    without an id; ``sources.frames.assert_cases`` fails on either.
    """
    unmatched = unmatched or {}
    measures = [c for c in rolled.columns if c != CASE_KEY]
    if group_var in measures:
        raise ValueError(f"group column {group_var!r} collides with a measure name")
    # The interview itself may be the group.
    kept = list(dict.fromkeys((CASE_KEY, group_var)))
    joined = cases.select(*kept).join(
        rolled, CASE_KEY, "left" if keep_unmatched else "inner"
    )
    return joined.select(
        *kept,
        *(F.coalesce(F.col(m), F.lit(unmatched.get(m, 0))).alias(m) for m in measures),
    )


def sum_by_group(
    df: DataFrame, group_var: str, measures: Mapping[str, Column]
) -> DataFrame:
    """Aggregate per group; a NULL group is a group of its own."""
    return df.groupBy(group_var).agg(
        *(expr.alias(name) for name, expr in measures.items())
    )


def padded(rows: Column) -> Column:
    """Number of rows a left join shows for a case with ``rows`` roster rows."""
    return F.greatest(F.coalesce(rows, F.lit(0)), F.lit(1))


def tally(
    cases: DataFrame,
    roster: DataFrame,
    group_var: str,
    measures: Mapping[str, Column],
    unmatched: Mapping[str, int] | None = None,
    keep_unmatched: bool = True,
) -> DataFrame:
    """Group sums of one roster's additive measures.

    ``measures`` are per-interview aggregates (counts and sums) over the roster.
    """
    rolled = roll_up(roster, measures)
    joined = attach(cases, rolled, group_var, unmatched, keep_unmatched)
    return sum_by_group(joined, group_var, {m: F.sum(m) for m in measures})


def tally_rows(
    cases: DataFrame,
    roster: DataFrame,
    group_var: str,
    measures: Mapping[str, Column],
    unmatched: Mapping[str, int] | None = None,
) -> DataFrame:
    """Group sums of what each roster row adds.

    ``measures`` are numbers per row, never NULL.  The rows of a roster that is
    declared unique go to the join without an aggregate; any other roster is rolled
    up per interview first.
    """
    if declared_unique(roster):
        rolled = roster.select(
            CASE_KEY, *(expr.alias(name) for name, expr in measures.items())
        )
    else:
        rolled = roll_up(roster, {name: F.sum(expr) for name, expr in measures.items()})
    joined = attach(cases, rolled, group_var, unmatched)
    return sum_by_group(joined, group_var, {m: F.sum(m) for m in measures})


def tally_codes(
    cases: DataFrame,
    roster: DataFrame,
    group_var: str,
    code: Column,
    names: Mapping[int, str],
    rows: str | None = None,
) -> DataFrame:
    """Group counts of each listed code as columns, from counts in long form.

    For questions with very many options: rows are counted per interview and code,
    the counts summed per group and code, and only that small frame becomes wide.
    ``names`` gives the column of each code.  ``rows``, if given, names a column with
    the number of rows, where a case without roster rows counts as one.
    """
    # codes are whole numbers, however they are stored
    whole = F.when(code == code.cast("long"), code.cast("long"))
    counted = roster.groupBy(CASE_KEY, whole.alias("__code")).agg(
        F.count(F.lit(1)).alias("__n")
    )
    kept = list(dict.fromkeys((CASE_KEY, group_var)))
    joined = cases.select(*kept).join(counted, CASE_KEY, "left")
    sums = joined.groupBy(group_var, "__code").agg(
        F.sum("__n").alias("__n"), F.sum(padded(F.col("__n"))).alias("__rows")
    )
    cells = F.array(
        F.struct(F.lit("rows").alias("__cell"), F.col("__rows").alias("__value")),
        F.struct(
            F.col("__code").cast("string").alias("__cell"), F.col("__n").alias("__value")
        ),
    )
    wide = (
        sums.select(group_var, F.inline(cells))
        .groupBy(group_var)
        .pivot("__cell", ["rows", *map(str, names)])
        .agg(F.sum("__value"))
    )
    total = [] if rows is None else [F.col("rows").alias(rows)]
    return wide.select(
        group_var,
        *total,
        *(
            F.coalesce(F.col(f"`{value}`"), F.lit(0)).alias(name)
            for value, name in names.items()
        ),
    )
