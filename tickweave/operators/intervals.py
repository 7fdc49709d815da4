"""Validity intervals kept up to date batch by batch.

Two tables, both in buckets by a hash of the key: the observations, one folder per epoch, and
the intervals. A batch rewrites the intervals of the buckets its keys fall into and of no
others. They are computed from all observations of those buckets, so rows may arrive in any
order, and an epoch that is replayed overwrites its own observations and the same buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .history import hist_intervals


class IntervalTable:
    """Intervals of ``key`` over changes of ``values`` below ``folder``.

    ``buckets`` is fixed at the first batch. An epoch costs the history of its buckets, so
    more buckets suit batches of few keys.
    """

    def __init__(self, folder: str, key: list[str], values: list[str], order: tuple[str, str] = ("fetched_at", "id"), buckets: int = 64):
        self.folder, self.key, self.values, self.order, self.buckets = folder, key, values, order, buckets

    def apply(self, batch: DataFrame, epoch: int) -> list[int]:
        """Take in a batch; the buckets it changed (``buckets`` numbers at most)."""
        spark = batch.sparkSession
        at = f"{self.folder}/observations"
        bucket = F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")
        rows = batch.select(*self.key, *self.order, *self.values).withColumn("bucket", bucket)
        rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{at}/epoch={epoch}")
        touched = sorted(r["bucket"] for r in spark.read.schema(rows.schema).parquet(f"{at}/epoch={epoch}").select("bucket").distinct().collect())
        if not touched:
            return []
        known = spark.read.schema(f"{_ddl(rows)}, epoch bigint").option("basePath", at).parquet(at)
        # A row is known by its key and order; a batch that is repeated under another epoch changes nothing.
        table = hist_intervals(known.where(F.col("bucket").isin(touched)), self.key, self.values, self.order).withColumn("bucket", bucket)
        table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(f"{self.folder}/intervals")
        return touched

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.folder}/intervals")

    def current(self, spark: SparkSession) -> DataFrame:
        return self.read(spark).where("is_current")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{c.name}` {c.dataType.simpleString()}" for c in df.schema)
