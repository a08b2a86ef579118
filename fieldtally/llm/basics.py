"""Helpers that the corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtally.sources.shared import shared_folder

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """The rows stored in the shared checkpoint folder, so that no loss recomputes them."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def row_key(*columns: str) -> Column:
    """Two 64-bit hashes that stand for a row; equal rows share them.

    Joining on it brings what was found in a row back to it even when ids are
    missing or repeated.
    """
    return F.struct(
        F.xxhash64(*columns).alias("a"), F.xxhash64(F.lit("b"), *reversed(columns)).alias("b")
    )


def word_count(text: Column) -> Column:
    """Words of a text; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
