"""Folders that the driver and all executors see."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`, or one in the warehouse if unset.

    A cluster has to set one of the two to a folder that all its machines share: the
    warehouse that Spark takes by itself is a folder of the driver's machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    return folder or f"{warehouse}/_checkpoints"


def scratch_path(spark: SparkSession) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"
