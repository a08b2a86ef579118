"""Load survey frames, check the cases, normalise exported missing codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldtally.functions.semantics import TAG_PREFIX
from fieldtally.operators.rollup import CASE_KEY, declare_unique

# The survey software's numeric missing code and its default tag.
EXPORT_NUMERIC_MISSING = -999999999
DEFAULT_TAG = "a"


def load_frame(
    spark: SparkSession,
    path: str,
    file_format: str = "parquet",
    schema: T.StructType | str | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Read a frame from parquet or from a tab-separated export.

    Text exports need a schema: inferring one would read the data twice and
    could change types from one export to the next.
    """
    if file_format == "parquet":
        reader = spark.read if schema is None else spark.read.schema(schema)
        df = reader.parquet(path)
    elif file_format in ("csv", "tsv"):
        if schema is None:
            raise ValueError("text exports need an explicit schema")
        df = spark.read.schema(schema).csv(
            path, sep="\t" if file_format == "tsv" else ",", header=True
        )
    else:
        raise ValueError(f"unsupported format {file_format!r}")
    return df if columns is None else df.select(*columns)


def check_cases(cases: DataFrame, group_var: str) -> DataFrame:
    """Data-quality counts of the cases frame, one row.

    ``n_cases`` rows, ``n_null_ids`` rows without id, ``n_repeated_ids`` ids that
    occur more than once.  Missing columns raise at once.
    """
    absent = [c for c in (CASE_KEY, group_var) if c not in cases.columns]
    if absent:
        raise ValueError(f"cases frame lacks columns {absent}")
    per_id = cases.groupBy(CASE_KEY).agg(F.count(F.lit(1)).alias("n"))
    known = F.col(CASE_KEY).isNotNull()
    return per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_cases"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("n_null_ids"),
        F.count_if(known & (F.col("n") > 1)).alias("n_repeated_ids"),
    )


def _holds_ids_once(frame: DataFrame, what: str) -> Column:
    """Condition that is true, or an error, for the whole frame.

    Ids are counted with a map-side combine, so an id that holds many rows costs no
    task more than another, and what comes of it is one value, a scalar subquery of
    the query that reads the frame. Nothing runs when this is called.
    """
    key = F.col(CASE_KEY)
    problem = F.when(key.isNull(), F.lit(f"{what} has no interview id")).when(
        F.col("__rows") > 1, F.concat(F.lit("repeated interview id: "), key.cast("string"))
    )
    found = (
        frame.groupBy(CASE_KEY)
        .agg(F.count(F.lit(1)).alias("__rows"))
        .where(key.isNull() | (F.col("__rows") > 1))
        .agg(F.min(problem).alias("__problem"))
    )
    error = F.raise_error(F.col("__problem")).cast("boolean")
    return found.select(F.when(F.col("__problem").isNull(), True).otherwise(error)).scalar()


def assert_cases(cases: DataFrame, group_var: str) -> DataFrame:
    """The same cases; the job that reads them fails on missing or repeated ids.

    Pass the result to a report in place of the cases.
    """
    absent = [c for c in (CASE_KEY, group_var) if c not in cases.columns]
    if absent:
        raise ValueError(f"cases frame lacks columns {absent}")
    return cases.where(_holds_ids_once(cases, "a case"))


def assert_unique(roster: DataFrame) -> DataFrame:
    """The same roster, declared to hold one row per interview.

    The job that reads it fails on a missing or repeated id. ``declare_unique``
    makes the same declaration without the check.
    """
    return declare_unique(roster.where(_holds_ids_once(roster, "a row")))


def normalize_missing(
    df: DataFrame,
    columns: Sequence[str],
    sentinel: float = EXPORT_NUMERIC_MISSING,
    tag: str = DEFAULT_TAG,
) -> DataFrame:
    """Turn the export's missing code into NULL plus a tag column.

    Tags already present are kept.  Off by default in the reports, because the
    GPS reports test the code themselves.
    """
    present = {c.lower() for c in df.columns}
    replaced = {}
    for name in columns:
        companion = TAG_PREFIX + name
        hit = F.col(name) == sentinel
        tagged = F.when(hit, F.lit(tag))
        if companion.lower() in present:
            tagged = F.coalesce(F.col(companion), tagged)
        replaced[companion] = tagged
        replaced[name] = F.when(F.coalesce(~hit, F.lit(True)), F.col(name))
    return df.withColumns(replaced)
