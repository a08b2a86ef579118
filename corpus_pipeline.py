"""From raw documents to packed training sequences, in five stages.

Each stage gets the documents that its predecessor kept and returns documents; the
last returns places in sequences. Decisions take effect: rejected documents and
copies go, personal data is replaced, documents appear as often as the mix takes
them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtally.llm import covering_simhash, langid, mixing, packing, pii
from fieldtally.sources.shared import scratch_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in no learned language go; a missing language is filled in."""
    rows = langid.predict(docs, langid.fit(docs), ("__lang", "__score"))
    kept = rows.where((F.col("__lang") != langid.UNKNOWN) & (F.col("__score") >= langid.REJECT))
    return kept.withColumn("lang", F.coalesce("lang", "__lang")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: fingerprints of three-word shingles within two bits."""
    return covering_simhash.deduplicate(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in brackets."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of bounded length."""
    return packing.pack(docs)


STAGES = [
    ("language ID", identify_language),
    ("near-dedup", drop_near_duplicates),
    ("PII", redact_personal_data),
    ("mixing to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]
#: The language model and the shingle hashes have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each stored in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        path = scratch_path(spark)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
