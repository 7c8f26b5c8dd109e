"""Helpers that every operator of this subpackage shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, a folder of this machine in
    local mode, and on a cluster one below the warehouse unless that lies on this machine's disk: then an error says what to
    set."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        local = spark.sparkContext.master.startswith("local")
        if not local and warehouse.startswith("file:"):
            raise ValueError(f"spark.checkpoint.dir is unset and the warehouse ({warehouse}) is local: set it to a folder that all machines share")
        base = f"file://{tempfile.mkdtemp(prefix='clonelens-')}" if local else f"{warehouse}/_checkpoints"
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/clonelens/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and reread it: lineage ends here and survives lost executors."""
    path = shared_path(df.sparkSession, label)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """The text column with null read as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def give_back() -> None:
    """Return memory that a task's Python worker no longer needs to the machine: workers live on for other stages."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def partitions(spark: SparkSession) -> int:
    """Tasks of a shuffle, as the session sets them."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def tasks_for(df: DataFrame, bytes_a_task: int) -> int:
    """Tasks of a shuffle of ``df``: as the session sets them, or more where the plan's size is known to need them."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(partitions(df.sparkSession), size // bytes_a_task if size < 1 << 60 else 0)
