"""Multi-select questions: one 0/1 column per answer option."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldtally.functions.labels import value_labels
from fieldtally.functions.semantics import any_of, coded, is_tagged


def option_column(question: str, code: float) -> str:
    """Name of the column of one answer option; a minus sign is written ``n``."""
    if int(code) != code:
        raise ValueError(f"option codes are whole numbers, got {code!r}")
    code = int(code)
    return f"{question}__n{-code}" if code < 0 else f"{question}__{code}"


def option_selected(df: DataFrame, question: str, code: float) -> Column:
    """Whether the option is selected (three-valued)."""
    return coded(df, option_column(question, code)) == 1


def any_option(df: DataFrame, question: str, codes: Iterable[float]) -> Column:
    """Whether at least one of the options is selected (three-valued)."""
    return any_of([option_selected(df, question, code) for code in codes])


def option_columns(df: DataFrame, question: str) -> list[str]:
    """Names of a question's option columns, found by prefix, ignoring case.

    Text companions of a question are not options and are left out.
    """
    prefix = f"{question}__".lower()
    return [
        f.name
        for f in df.schema.fields
        if f.name.lower().startswith(prefix)
        and isinstance(f.dataType, (T.NumericType, T.BooleanType))
    ]


def option_dummies(df: DataFrame, variable: str) -> DataFrame:
    """Add one 0/1 column per value label of a single-select variable.

    NULL answers give NULL dummies; labels nobody chose get a column too.
    """
    dummies = [
        (coded(df, variable) == code).cast("int").alias(option_column(variable, code))
        for code, _ in value_labels(df, variable)
    ]
    return df.select("*", *dummies)


def option_counts(df: DataFrame, variable: str) -> dict[str, Column]:
    """Aggregates that count each labelled code, codes nobody chose included.

    The codes are known from the labels, so this is a pivot without a job to
    find its columns and with a single aggregation.
    """
    return {
        option_column(variable, code): F.count_if(coded(df, variable) == code)
        for code, _ in value_labels(df, variable)
    }


def _amount_variables(variables: str | Sequence[str]) -> list[str]:
    names = [variables] if isinstance(variables, str) else list(variables)
    if len(names) not in (1, 2):
        raise ValueError(f"expected one or two amount variables, got {names}")
    return names


def amount_missing(df: DataFrame, variables: str | Sequence[str]) -> Column:
    """Whether any amount holds a tagged missing value."""
    return any_of([is_tagged(df, name) for name in _amount_variables(variables)])


def amount_unknown(variables: str | Sequence[str], dk_code: float) -> Column:
    """Whether any amount holds the "don't know" code (three-valued)."""
    return any_of([F.col(name) == dk_code for name in _amount_variables(variables)])
