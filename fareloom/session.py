"""The shared folder for intermediate tables."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir.

    A machine-local temporary folder stands in only for a local master with the setting unset, as in tests:
    on a cluster other machines could not read it, so there the setting is required.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="fareloom-"))
    return spark.sparkContext.getCheckpointDir()
