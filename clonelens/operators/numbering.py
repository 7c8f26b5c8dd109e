"""Row numbers without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .checkpoints import checkpointed


def numbered(df: DataFrame, order: list[Column], name: str = "number", tasks: int | None = None, running: str | None = None) -> DataFrame:
    """``df`` with ``name`` counting from 1 in ``order``: range-partitioned sort, then an offset for each partition.

    Partition counts are one row a task, so their running sum is small whatever the size of ``df``. ``running`` names a
    column whose sum up to and with each row is added as ``<running>_sum``.
    """
    tasks = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(tasks, *order).sortWithinPartitions(*order).withColumn("_task", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id())
    # The checkpoint keeps counts and rows from two separate sorts of the same input apart.
    dealt = checkpointed(dealt)
    extra = [F.sum(running).alias("_sum")] if running else []
    counts = dealt.groupBy("_task").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"), *extra)
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    ahead = lambda c, to: F.coalesce(F.sum(c).over(before), F.lit(0)).alias(to)
    counts = counts.select("_task", "_first", ahead("_n", "_ahead"), *([ahead("_sum", "_below")] if running else []))
    if running:
        inside = Window.partitionBy("_task").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
        dealt = dealt.withColumn("_inside", F.sum(running).over(inside))
        dealt, counts = dealt.join(counts.select("_task", "_below"), "_task").withColumn(f"{running}_sum", F.col("_below") + F.col("_inside")).drop("_below", "_inside"), counts.drop("_below")
    return dealt.join(counts, "_task").withColumn(name, (F.col("_row") - F.col("_first") + F.col("_ahead") + 1).cast("long")).drop("_task", "_row", "_first", "_ahead")
