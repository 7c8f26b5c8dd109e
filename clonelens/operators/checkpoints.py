"""Cutting lineage in loops, in the folder that the session names."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def checkpoint_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where that is unset, a folder of this machine in local mode, and on a cluster one below the
    warehouse unless that lies on this machine's disk: then an error says what to set."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if spark.sparkContext.master.startswith("local"):
        return f"file://{tempfile.mkdtemp(prefix='clonelens-')}"
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if warehouse.startswith("file:"):
        raise ValueError(f"spark.checkpoint.dir is unset and the warehouse ({warehouse}) is local: set it to a folder that all machines share")
    return f"{warehouse}/_checkpoints"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder and read from there."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(checkpoint_folder(spark))
    return df.checkpoint()
