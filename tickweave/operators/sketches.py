"""Distinct counts from stored sketches: built once a day, merged for any longer period.

A day's row holds a HyperLogLog sketch of some kilobytes instead of its members. Sketches
of days unite to those of weeks and months without reading the rows again, and what is
built once more replaces itself.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def error_bound(lg: int = 12) -> float:
    """Three relative standard errors of a sketch with ``2^lg`` registers."""
    return 3 * 1.04 / math.sqrt(2**lg)


def daily_sketches(df: DataFrame, by: list[str], member: str, at: str = "fetched_at", lg: int = 12) -> DataFrame:
    """``(*by, day, n_rows, sketch)``; members are combined before they are shuffled."""
    return df.groupBy(*by, F.to_date(at).alias("day")).agg(F.count("*").alias("n_rows"), F.hll_sketch_agg(member, lg).alias("sketch"))


def rolled_up(sketches: DataFrame, by: list[str], unit: str) -> DataFrame:
    """``(*by, unit, start, n_rows, estimate, sketch)`` of the days of each week, month, quarter or year."""
    start = F.date_trunc(unit, "day").cast("date").alias("start")
    merged = sketches.groupBy(*by, start).agg(F.sum("n_rows").alias("n_rows"), F.hll_union_agg("sketch").alias("sketch"))
    return merged.select(*by, F.lit(unit).alias("unit"), "start", "n_rows", F.hll_sketch_estimate("sketch").alias("estimate"), "sketch")


class SketchTable:
    """Daily sketches at ``folder``, in a partition per ``period`` (``day``, ``month``, ``year`` …)."""

    def __init__(self, folder: str, by: list[str], member: str, at: str = "fetched_at", lg: int = 12, period: str = "month"):
        self.folder, self.by, self.member, self.at, self.lg, self.period = folder, by, member, at, lg, period

    def put(self, df: DataFrame) -> None:
        """Build the days of ``df``, which must be whole periods; only their partitions are replaced."""
        days = daily_sketches(df, self.by, self.member, self.at, self.lg)
        days = days.withColumn("period", F.date_trunc(self.period, "day").cast("date")).repartition("period")
        days.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("period").parquet(self.folder)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.folder).drop("period")

    def counts(self, spark: SparkSession, unit: str) -> DataFrame:
        return rolled_up(self.read(spark), self.by, unit)
