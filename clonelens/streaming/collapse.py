"""Collapsing of reads that keep arriving: an extension, the batch operators do not need it.

Counts per distinct line are kept as state by the engine; each batch's changed counts are upserted into a table of
numbered versions, so a repeated batch after a failure writes the same version again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def line_counts(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Streaming counts of equal lines, to be written in update mode."""
    return lines.groupBy(*keys).agg(F.count("*").alias("occurrence"))


def follow(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write each batch's changed counts below ``path``/batch=N, once per batch whatever is repeated."""

    def batch(df: DataFrame, number: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return counts.writeStream.outputMode("update").foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark, path: str, keys: list[str]) -> DataFrame:
    """The latest count of each line."""
    return spark.read.parquet(path).groupBy(*keys).agg(F.max_by("occurrence", "batch").alias("occurrence"))
