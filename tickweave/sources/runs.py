"""Idempotent appends: a history is the runs that its manifest names, and nothing else.

A run writes its rows to a folder of its own and then creates one manifest entry, which
cannot be created twice. A run that died in between left files that no reader sees and that
its repetition overwrites; a run that is repeated after its entry adds nothing. Compaction
writes the rows of many runs as one and commits it by an entry that names those it replaces.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _path(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


class RunLog:
    """Runs of one dataset below ``folder``."""

    def __init__(self, spark: SparkSession, folder: str, dataset: str):
        self.spark, self.folder, self.dataset = spark, f"{folder}/dataset={dataset}", dataset

    def _entry(self, run: str) -> str:
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", run):
            raise ValueError(f"run id {run!r} is no file name")
        return f"{self.folder}/_runs/{run}.json"

    def committed(self, run: str) -> bool:
        system, entry = _path(self.spark, self._entry(run))
        return system.exists(entry)

    def runs(self) -> list[str]:
        """Runs that readers see: committed and not replaced. One name per run reaches the driver."""
        system, entries = _path(self.spark, f"{self.folder}/_runs")
        if not system.exists(entries):
            return []
        read = self.spark.read.schema("run string, replaces array<string>").json(f"{self.folder}/_runs/[A-Za-z0-9]*.json").collect()
        gone = {name for row in read for name in row["replaces"]}
        return sorted({row["run"] for row in read} - gone)

    def _commit(self, run: str, replaces: list[str]) -> None:
        system, entry = _path(self.spark, self._entry(run))
        _, draft = _path(self.spark, f"{self.folder}/_runs/_{run}.draft")
        out = system.create(draft, True)
        try:
            out.write(bytearray(json.dumps({"run": run, "replaces": replaces}).encode()))
        finally:
            out.close()
        # A reader meets a whole entry or none.
        if not system.rename(draft, entry) and not system.exists(entry):
            raise OSError(f"run {run} could not be committed")

    def _write(self, df: DataFrame, run: str) -> None:
        df.write.mode("overwrite").partitionBy("capture_date").parquet(f"{self.folder}/run={run}")

    def append(self, df: DataFrame, run: str, fetched_at: str = "fetched_at") -> bool:
        """Add the rows of a run; False, and nothing done, where it is committed already."""
        if self.committed(run):
            return False
        self._write(df.withColumn("capture_date", F.to_date(fetched_at)), run)
        self._commit(run, [])
        return True

    def read(self) -> DataFrame | None:
        """Rows of all visible runs with ``run`` and ``capture_date``; None before the first run."""
        runs = self.runs()
        if not runs:
            return None
        return self.spark.read.option("basePath", self.folder).parquet(*[f"{self.folder}/run={r}" for r in runs])

    def compact(self, run: str) -> bool:
        """All visible runs as one; the replaced files stay for readers that have begun, see ``sweep``."""
        before = self.runs()
        if self.committed(run) or not before:
            return False
        rows = self.read().drop("run")
        spread = max(1, int(self.spark.conf.get("spark.sql.shuffle.partitions")) // 8)
        slot = F.pmod(F.xxhash64(*[c for c in rows.columns if c != "capture_date"]), F.lit(spread))
        self._write(rows.repartition("capture_date", slot), run)
        self._commit(run, before)
        return True

    def sweep(self) -> list[str]:
        """Delete the rows of runs that no reader sees any more: replaced, or never committed."""
        system, top = _path(self.spark, self.folder)
        keep = {f"run={r}" for r in self.runs()}
        gone = []
        for status in system.listStatus(top) if system.exists(top) else ():
            name = status.getPath().getName()
            if name.startswith("run=") and name not in keep:
                system.delete(status.getPath(), True)
                gone.append(name[4:])
        return sorted(gone)
