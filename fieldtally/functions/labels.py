"""Value labels of coded answers.

Labels live in the column metadata under ``labels`` as a list of
``{"value": int, "label": str}``, in questionnaire order.  Metadata is part of
the schema: it is read on the driver without starting a job, follows the column
through ``select``/``filter``/``join`` and is stored by ``write.parquet``.
Computed columns lose it, so labels are read from the source frame.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LABELS = "labels"

LABEL_SCHEMA = T.StructType(
    [
        T.StructField("var", T.StringType(), False),
        T.StructField("value", T.IntegerType(), False),
        T.StructField("label", T.StringType(), True),
    ]
)


def with_value_labels(
    df: DataFrame, variable: str, labels: Iterable[tuple[int, str]]
) -> DataFrame:
    """Attach value labels to a column."""
    entries = [{"value": int(code), "label": text} for code, text in labels]
    kept = {k: v for k, v in df.schema[variable].metadata.items() if k != LABELS}
    return df.withMetadata(variable, {**kept, LABELS: entries})


def value_labels(df: DataFrame, variable: str) -> list[tuple[int, str]]:
    """(code, label) pairs of a labelled column, in stored order."""
    entries = df.schema[variable].metadata.get(LABELS)
    if not entries:
        raise ValueError(
            f"column {variable!r} has no value labels; attach them with with_value_labels()"
        )
    return [(int(e["value"]), e["label"]) for e in entries]


def label_values(df: DataFrame, variable: str) -> list[int]:
    """Codes of a labelled column."""
    return [code for code, _ in value_labels(df, variable)]


def label_texts(df: DataFrame, variable: str) -> list[str]:
    """Label texts of a labelled column, in the order of its codes."""
    return [text for _, text in value_labels(df, variable)]


def heading(label: str, code: int) -> str:
    """Column heading of one answer option."""
    return f"{label} ({code})"


def value_label_frame(
    spark: SparkSession, df: DataFrame, variables: Iterable[str]
) -> DataFrame:
    """All labels of the given columns as a (var, value, label) DataFrame."""
    rows = [(v, code, text) for v in variables for code, text in value_labels(df, v)]
    return spark.createDataFrame(rows, LABEL_SCHEMA)


def decode(df: DataFrame, variable: str, labels: DataFrame, into: str) -> DataFrame:
    """Add the label text of a code column.

    ``labels`` is a (var, value, label) frame such as a questionnaire codebook.
    The join carries no broadcast hint: Spark broadcasts a codebook below its
    size threshold by itself and shuffles a larger one.
    """
    codebook = labels.filter(F.col("var") == variable).select(
        F.col("value").alias(f"__{into}_code"), F.col("label").alias(into)
    )
    return df.join(
        codebook, F.col(variable) == F.col(f"__{into}_code"), "left"
    ).drop(f"__{into}_code")
