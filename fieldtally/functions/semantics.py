"""Missing-value and zero-denominator rules, as Column expressions.

Conditions are three-valued like SQL: a NULL comparison counts as neither yes
nor no.  All helpers stay inside built-in expressions, so they take part in
whole-stage code generation and in partial aggregation.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INFINITY = float("inf")

#: Prefix of the string column that carries the tag of an extended missing value.
TAG_PREFIX = "natag__"


def _field_type(df: DataFrame, name: str) -> T.DataType | None:
    """Type of a column, found as Spark resolves names: ignoring case."""
    types = {f.name.lower(): f.dataType for f in df.schema.fields}
    return types.get(name.lower())


def coded(df: DataFrame, name: str) -> Column:
    """A coded answer as a number; a true/false column counts as 1/0.

    Spark does not compare booleans with numbers, so the cast is explicit.
    """
    column = F.col(name)
    if isinstance(_field_type(df, name), T.BooleanType):
        return column.cast("int")
    return column


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false *or* NULL."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def total(values: Column) -> Column:
    """Sum that skips NULLs and is 0 when there is nothing to add."""
    return F.coalesce(F.sum(values), F.lit(0))


def any_true(condition: Column) -> Column:
    """Aggregate: true if one row is true, false otherwise (NULLs skipped)."""
    return F.coalesce(F.bool_or(condition), F.lit(False))


def any_true_or_unknown(condition: Column) -> Column:
    """Aggregate: true if one row is true, else NULL if one is NULL, else false."""
    return any_from_counts(
        F.count_if(condition), F.count_if(condition.isNull())
    )


def any_from_counts(n_true: Column, n_unknown: Column) -> Column:
    """The same three-valued 'any', rebuilt from additive counts."""
    return (
        F.when(n_true > 0, F.lit(True))
        .when(n_unknown > 0, F.lit(None).cast("boolean"))
        .otherwise(F.lit(False))
    )


def is_in(value: Column, codes: Iterable[float]) -> Column:
    """Membership test that is never NULL."""
    return F.coalesce(value.isin(list(codes)), F.lit(False))


def any_of(conditions: Sequence[Column]) -> Column:
    """Three-valued OR over one or more conditions."""
    if not conditions:
        raise ValueError("any_of needs at least one condition")
    return reduce(or_, conditions)


def row_total(columns: Sequence[Column], skip_missing: bool = True) -> Column:
    """Horizontal sum of stored values.

    With ``skip_missing`` a NULL adds nothing; without it one NULL makes the
    whole row NULL.  No columns at all add up to 0.
    """
    if not columns:
        return F.lit(0)
    if skip_missing:
        columns = [F.coalesce(c, F.lit(0)) for c in columns]
    return reduce(add, columns)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Division with 0/0 -> NULL and x/0 -> signed infinity; NULL stays NULL."""
    top, bottom = numerator.cast("double"), denominator.cast("double")
    at_zero = F.when(top > 0, F.lit(INFINITY)).when(top < 0, F.lit(-INFINITY))
    return F.when(bottom == 0, at_zero).otherwise(top / bottom)


def is_tagged(df: DataFrame, name: str) -> Column:
    """Whether ``name`` holds an extended (tagged) missing value; never NULL.

    A frame without the companion column has no tagged values.
    """
    companion = TAG_PREFIX + name
    if _field_type(df, companion) is None:
        return F.lit(False)
    return F.col(companion).isNotNull()


def null_for_nan(df: DataFrame) -> DataFrame:
    """Replace NaN by NULL in every floating-point column."""
    floating = {
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.select(
        *(
            F.when(~F.isnan(c), F.col(c)).alias(c) if c in floating else F.col(c)
            for c in df.columns
        )
    )
