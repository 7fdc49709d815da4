"""Session settings every plan in this package relies on, and lineage cutting."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Runtime settings that change results (time zone) or plan shape (AQE).
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Captured bodies are large: keep the Arrow batches handed to Python small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    # Parsed documents are tens of kilobytes a row: a cache packs them in few rows, too.
    "spark.sql.inMemoryColumnarStorage.batchSize": "256",
    # The JVM never compiles methods beyond 8000 bytecodes. Wide projections
    # (fifty typed fields) exceed that as one generated method; past this limit
    # Spark generates split methods instead, which do get compiled.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Projections wider than this do not fit one generated class at all: do not
    # spend seconds on a compilation that fails.
    "spark.sql.codegen.maxFields": "30",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build(app: str = "tickweave", master: str | None = None, **conf: str) -> SparkSession:
    """A configured session; ``master`` is only for local runs and tests."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a local session without ``spark.checkpoint.dir`` gets a folder of its
    own; on a cluster a missing setting is an error, because a machine-local
    folder is lost with its executor.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="tickweave-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably so that later passes all read the same rows."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(os.path.join(shared_folder(df.sparkSession), "checkpoints"))
    return df.checkpoint(eager=True)
