"""A session with the settings that the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str | None = None, partitions: int | None = None) -> SparkSession:
    b = SparkSession.builder.appName("clonelens").config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true")
    if master:
        b = b.master(master)
    if partitions:
        b = b.config("spark.sql.shuffle.partitions", str(partitions))
    return b.getOrCreate()
