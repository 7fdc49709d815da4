"""A stored order: pages and walks of a ranked table without ranking it again.

The rows are ranked once and laid down in parts of consecutive ranks. A rank names its part by
division, so a page reads the one part it lies in (two at a border), at any depth; beside the
rows stands a table of every part's rank range, row count and first key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .ranking import PAGE_SIZE, global_rank


@dataclass(frozen=True)
class RankIndex:
    """An index that has been built at ``folder``; opening it reads its bounds only."""

    spark: SparkSession
    folder: str
    part_rows: int
    total: int

    @classmethod
    def build(cls, df: DataFrame, keys: list[Column], folder: str, part_rows: int = 1_000_000) -> RankIndex:
        """Rank ``df`` under the total order ``keys`` and store it; the folder must be new.

        Tasks hold consecutive ranks already, so the rows are written where they are. The
        bounds are written last: without them an interrupted build is no index.
        """
        ranked = global_rank(df, keys)
        part = F.floor((F.col("rank") - 1) / part_rows).cast("bigint")
        ranked = ranked.withColumn("_part", part)
        ranked.write.mode("overwrite").partitionBy("_part").parquet(f"{folder}/rows")
        ranked.where("false").drop("_part").write.mode("overwrite").parquet(f"{folder}/none")
        stored = df.sparkSession.read.schema(ranked.schema).parquet(f"{folder}/rows")
        bounds = stored.groupBy(F.col("_part").cast("bigint").alias("part")).agg(
            F.min("rank").alias("low"), F.max("rank").alias("high"), F.count("*").alias("n"), F.min_by(F.to_json(F.struct(*df.columns)), "rank").alias("first")
        )
        bounds.withColumn("part_rows", F.lit(part_rows).cast("bigint")).write.mode("overwrite").parquet(f"{folder}/bounds")
        return cls.open(df.sparkSession, folder)

    @classmethod
    def open(cls, spark: SparkSession, folder: str) -> RankIndex:
        facts = spark.read.parquet(f"{folder}/bounds").agg(F.max("part_rows").alias("size"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")).first()
        return cls(spark, folder, facts["size"] or 1, facts["total"])

    def bounds(self) -> DataFrame:
        """One row per part: its ranks, its row count and its first row as JSON."""
        return self.spark.read.parquet(f"{self.folder}/bounds").drop("part_rows")

    def parts(self, offset: int, count: int) -> range:
        """The parts that hold ranks ``offset+1 … offset+count``."""
        last = min(offset + count, self.total)
        return range(offset // self.part_rows, (last - 1) // self.part_rows + 1) if offset < last else range(0)

    def rows(self, offset: int, count: int | None = None) -> DataFrame:
        """Rows of those ranks with ``rank``; files of other parts are neither listed nor opened."""
        if offset < 0 or (count is not None and count < 0):
            raise ValueError("offset and count must not be negative")
        count = self.total - offset if count is None else count
        parts = self.parts(offset, count)
        if not len(parts):
            return self.spark.read.parquet(f"{self.folder}/none")
        paths = [f"{self.folder}/rows/_part={p}" for p in parts] if len(parts) <= 100 else [f"{self.folder}/rows"]
        read = self.spark.read.option("basePath", f"{self.folder}/rows").parquet(*paths)
        return read.where(F.col("rank").between(offset + 1, offset + count)).drop("_part")

    def page(self, number: int, size: int = PAGE_SIZE) -> DataFrame:
        if number < 1:
            raise ValueError("page must be a positive integer")
        return self.rows((number - 1) * size, size)

    def walk(self, *, first_page: int = 1, max_pages: int | None = None, max_rows: int | None = None, size: int = PAGE_SIZE) -> tuple[DataFrame, dict]:
        """The rows of a page walk and its status, stops on page borders; nothing is counted again."""
        stops = [n for n in (max_pages, None if max_rows is None else -(-max_rows // size)) if n is not None]
        if first_page < 1 or any(n < 1 for n in stops):
            raise ValueError("pages and stops must be positive integers")
        offset = (first_page - 1) * size
        left = max(self.total - offset, 0)
        pages = -(-left // size)
        done = min([pages, *stops])
        status = "EMPTY" if not left else "PARTIAL" if done < pages else "COMPLETE"
        return self.rows(offset, done * size), {"status": status, "total_rows": self.total, "succeeded_units": done}
