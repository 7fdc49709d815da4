"""Stateful sinks: late rows diverted, changed rows appended.

Both run in ``foreachBatch`` on ordinary DataFrame plans and keep their state in
the shared folder, one directory per epoch. An epoch that is replayed after a
failure reads the state of the epoch before it and overwrites its own output, so
results are exactly once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.history import hist_change_feed


def _read_epoch(spark: SparkSession, path: str, epoch: int, schema: str) -> DataFrame:
    """The state written by ``epoch``; only before the first epoch it is empty.

    A state that should be there and is not fails the batch: starting over from
    nothing would silently append every row again.
    """
    if epoch < 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/epoch={epoch}")


class LateRows:
    """Splits each micro-batch by the watermark: on-time rows and late rows.

    Spark drops late rows silently inside a stateful operator. Here they are
    written beside the on-time rows instead: absence is not deletion. The
    watermark is the highest event time of all earlier batches minus the delay.
    """

    def __init__(self, folder: str, delay: str, at: str = "fetched_at"):
        self.folder, self.delay, self.at = folder, delay, at

    def __call__(self, batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        schema = "high timestamp"
        before = _read_epoch(spark, f"{self.folder}/watermark", epoch - 1, schema)
        # One row each: the state table never grows.
        high = before.agg(F.max("high").alias("_high"))
        marked = batch.crossJoin(F.broadcast(high)).withColumn(
            "late", F.coalesce(F.col(self.at) < F.col("_high") - F.expr(f"interval {self.delay}"), F.lit(False))
        )
        (
            marked.drop("_high")
            .write.mode("overwrite")
            .partitionBy("late")
            .parquet(f"{self.folder}/rows/epoch={epoch}")
        )
        batch.select(F.col(self.at).cast("timestamp").alias("high")).unionByName(before).agg(
            F.max("high").alias("high")
        ).write.mode("overwrite").parquet(f"{self.folder}/watermark/epoch={epoch}")

    def read(self, spark: SparkSession) -> DataFrame:
        rows = spark.read.option("basePath", f"{self.folder}/rows").parquet(f"{self.folder}/rows/epoch=*")
        return rows.withColumn("late", F.col("late").cast("boolean"))


class ChangeFeed:
    """Appends the rows whose values changed since the key's last row.

    The state is one ``(key, time, id, hash)`` row per key, in buckets by a hash of
    the key. An epoch reads only the buckets its rows fall into and writes only the
    keys it touched; every ``full_every``-th epoch writes the whole state, and what
    lies before the full state preceding it is deleted. Inside a batch the bucketed
    change feed does the work, so a hot key is spread like in batch. Rows older than
    their key's state are diverted as late, never compared.
    """

    def __init__(self, folder: str, key: list[str], values: list[str], order: tuple[str, str] = ("fetched_at", "id"), buckets: int = 64, full_every: int = 20):
        self.folder, self.key, self.values, self.order = folder, key, values, order
        self.buckets, self.full_every = buckets, full_every

    def _state_schema(self, batch: DataFrame) -> str:
        columns = [*self.key, *self.order]
        return ", ".join(f"{c} {batch.schema[c].dataType.simpleString()}" for c in columns) + ", row_hash string, bucket int"

    def _state(self, batch: DataFrame, epoch: int, touched: list[int] | None) -> DataFrame:
        """The newest row of every key before ``epoch``, of the touched buckets or all."""
        spark, schema = batch.sparkSession, self._state_schema(batch)
        if epoch == 0:
            return spark.createDataFrame([], schema)
        first = (epoch - 1) // self.full_every * self.full_every
        # A missing epoch fails the read: starting over would append every row again.
        paths = [f"{self.folder}/state/epoch={e}" for e in range(first, epoch)]
        rows = spark.read.schema(schema).option("basePath", f"{self.folder}/state").parquet(*paths)
        if touched is not None:
            rows = rows.where(F.col("bucket").isin(touched))
        newest = F.max_by(F.struct(*self.order, "row_hash"), F.struct(*self.order)).alias("n")
        return rows.groupBy("bucket", *self.key).agg(newest).select("bucket", *self.key, "n.*")

    def __call__(self, batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        at, tie = self.order
        bucket = F.pmod(F.hash(*self.key), F.lit(self.buckets)).alias("bucket")
        batch = batch.persist()
        full = epoch > 0 and epoch % self.full_every == 0
        touched = None if full else [r.bucket for r in batch.select(bucket).distinct().collect()]  # at most ``buckets``
        state = self._state(batch, epoch, touched)
        known = state.select(*self.key, F.struct(at, tie).alias("_seen"), F.col("row_hash").alias("_hash"))
        joined = batch.join(known, self.key, "left")
        late = joined.where(F.struct(at, tie) <= F.col("_seen"))
        fresh = joined.where(F.col("_seen").isNull() | (F.struct(at, tie) > F.col("_seen")))
        late.drop("_seen", "_hash").write.mode("overwrite").parquet(f"{self.folder}/late/epoch={epoch}")
        feed = hist_change_feed(fresh, self.key, self.values, self.order)
        # The first row of a key in this batch is compared with the state.
        first = F.col("previous_hash").isNull()
        feed = feed.where(~first | F.col("_hash").isNull() | (F.col("_hash") != F.col("row_hash")))
        feed = feed.withColumn("previous_hash", F.coalesce("previous_hash", "_hash")).drop("_seen", "_hash")
        feed.write.mode("overwrite").parquet(f"{self.folder}/feed/epoch={epoch}")
        written = spark.read.parquet(f"{self.folder}/feed/epoch={epoch}")
        # Unchanged rows advance the time of their key but not its hash.
        newest = fresh.groupBy(*self.key).agg(F.max(F.struct(at, tie)).alias("_s"), F.first("_hash").alias("_hash"))
        hashes = written.groupBy(*self.key).agg(F.max_by("row_hash", F.struct(at, tie)).alias("_new"))
        changed = newest.join(hashes, self.key, "left").select(
            *self.key, F.col(f"_s.{at}").alias(at), F.col(f"_s.{tie}").alias(tie), F.coalesce("_new", "_hash").alias("row_hash")
        )
        if full:
            changed = changed.unionByName(state.drop("bucket").join(changed.select(*self.key), self.key, "left_anti"))
        out = changed.withColumn("bucket", bucket).write.mode("overwrite").partitionBy("bucket")
        out.parquet(f"{self.folder}/state/epoch={epoch}")
        batch.unpersist()
        if full:
            self._forget(spark, epoch - self.full_every)

    def _forget(self, spark: SparkSession, before: int) -> None:
        """Delete the state of epochs before ``before``; a full state has taken their place."""
        jvm = spark.sparkContext._jvm
        for e in range(max(0, before - self.full_every), before):
            path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/state/epoch={e}")
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def read(self, spark: SparkSession, part: str = "feed") -> DataFrame:
        return spark.read.option("basePath", f"{self.folder}/{part}").parquet(f"{self.folder}/{part}/epoch=*")


def run_available(stream: DataFrame, sink, checkpoint: str) -> None:
    """Drive a stream through a sink until its present input is used up."""
    query = (
        stream.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
