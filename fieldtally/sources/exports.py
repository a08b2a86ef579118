"""Delimited text exports with extended missing codes, read line by line.

The export writes a missing number as ``.`` and its extended forms as ``.a`` to ``.z``.
A number column becomes a typed value plus a companion ``natag__x`` with the letter; a
line that does not fit the schema goes to a frame of rejected lines with its text and
the reason, and costs no other line. Everything is one expression over the raw lines:
one scan, no shuffle, no inference of types.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldtally.functions.semantics import TAG_PREFIX

#: An extended missing code, with its letter, or the plain one without.
MISSING_CODE = r"^\.([a-z]?)$"

_LINE, _CELLS, _BROKEN, _REASON = "__line", "__cells", "__broken", "__reason"


@dataclass(frozen=True)
class Export:
    """Typed rows and the lines that were refused; both are lazy and read the same scan."""

    parsed: DataFrame

    @property
    def rows(self) -> DataFrame:
        """Typed columns in schema order, each number followed by its tag."""
        return self.parsed.where(F.col(_REASON).isNull()).drop(_LINE, _REASON)

    @property
    def rejected(self) -> DataFrame:
        """Rows (line, reason) of the lines that do not fit."""
        return self.parsed.where(F.col(_REASON).isNotNull()).select(
            F.col(_LINE).alias("line"), F.col(_REASON).alias("reason")
        )


def _schema(schema: T.StructType | str) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def _value(cell: Column, kind: T.DataType) -> Column:
    """The typed value; missing codes, empty cells and unreadable ones are NULL."""
    if isinstance(kind, T.StringType):
        return cell
    trimmed = F.trim(cell)
    return F.when(~trimmed.rlike(MISSING_CODE), trimmed.try_cast(kind))


def _tag(cell: Column) -> Column:
    """The letter of an extended missing code, else NULL."""
    return F.nullif(F.regexp_extract(F.trim(cell), MISSING_CODE, 1), F.lit(""))


def _unreadable(name: str, cell: Column, kind: T.DataType) -> Column:
    """The reason to refuse a line because of one cell, else NULL."""
    trimmed = F.trim(cell)
    bad = (trimmed != "") & ~trimmed.rlike(MISSING_CODE) & trimmed.try_cast(kind).isNull()
    return F.when(bad, F.concat(F.lit(f"{name} is no {kind.simpleString()}: "), cell))


def parse_lines(
    lines: DataFrame, names: Sequence[str], schema: T.StructType | str, sep: str = "\t"
) -> Export:
    """Rows and rejected lines of a one-column frame of text lines.

    ``names`` are the cells of a line in order; cells that the schema does not list
    are read past. Cells are not quoted unless they start with a double quote.
    """
    fields = _schema(schema)
    absent = [f.name for f in fields if f.name not in names]
    if absent:
        raise ValueError(f"the export lacks the columns {absent}")
    every = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
    every.add(_BROKEN, T.StringType())
    options = {
        "sep": sep,
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": _BROKEN,
        "maxCharsPerColumn": "-1",
        "maxColumns": str(max(len(names) + 1, 20480)),
    }
    line = F.col(lines.columns[0])
    ddl = ", ".join(f"`{f.name}` string" for f in every)
    cells = lines.where(line != "").select(
        line.alias(_LINE), F.from_csv(line, ddl, options).alias(_CELLS)
    )
    at = {name: F.col(_CELLS)[f"c{i}"] for i, name in enumerate(names)}
    columns: list[Column] = []
    reasons = [
        F.when(
            F.col(_CELLS)[_BROKEN].isNotNull(), F.lit(f"the line does not have {len(names)} cells")
        )
    ]
    for field in fields:
        cell = at[field.name]
        columns.append(_value(cell, field.dataType).alias(field.name))
        if isinstance(field.dataType, T.NumericType):
            columns.append(_tag(cell).alias(TAG_PREFIX + field.name))
        if not isinstance(field.dataType, T.StringType):
            reasons.append(_unreadable(field.name, cell, field.dataType))
    return Export(cells.select(_LINE, *columns, F.coalesce(*reasons).alias(_REASON)))


def read_export(
    spark: SparkSession, path: str, schema: T.StructType | str, sep: str = "\t"
) -> Export:
    """A text export of one or many files, each with the same header line.

    The header of the first file gives the order of the columns (a job that reads one
    line); equal lines are left out of the data wherever they stand.
    """
    lines = spark.read.text(path)
    first = lines.first()
    header = "" if first is None else first["value"]
    names = [name.strip().strip('"') for name in header.lstrip("\ufeff").split(sep)]
    if first is None:
        names = [f.name for f in _schema(schema)]
    return parse_lines(lines.where(F.col("value") != header), names, schema, sep)
