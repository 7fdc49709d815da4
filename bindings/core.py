"""Tables, views and the query register shared by the suites."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession

from tickweave.session import configure, shared_folder

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

VIEWS: dict[str, Callable[[Tables], DataFrame]] = {}
VIEW_SQL: dict[str, str] = {}
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Base tables and views of one data folder; ``t("orders")`` is a DataFrame."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = configure(spark), folder

    def path(self, name: str) -> str:
        return str(PurePosixPath(self.folder) / f"{name}.parquet")

    def __call__(self, name: str) -> DataFrame:
        if name in VIEWS:
            return VIEWS[name](self)
        return self.spark.read.parquet(self.path(name))

    def spread(self, name: str) -> DataFrame:
        """Rows of a base table from which a view makes far larger bodies, dealt out first.

        Only the few columns that a view uses are moved, never a body.
        """
        return self(name).repartition(int(self.spark.conf.get("spark.sql.shuffle.partitions")))


def scratch(t: Tables, name: str) -> str:
    """A fresh place in the shared folder for a query that writes."""
    return os.path.join(shared_folder(t.spark), f"{name}-{uuid.uuid4().hex[:12]}")


def view(name: str, sql: str | None = None):
    """Register a domain view; ``sql`` is its DuckDB form for the oracles."""

    def register(build: Callable[[Tables], DataFrame]):
        VIEWS[name] = build
        if sql is not None:
            VIEW_SQL[name] = sql
        return build

    return register


def query(name: str, oracle: str | None = None, *uses: str):
    """Register a query and its oracle; ``uses`` lists views in dependency order."""

    def register(run: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, folder: run(Tables(spark, folder))
        if oracle is not None:
            views = ", ".join(f"{v} AS ({VIEW_SQL[v]})" for v in uses)
            ORACLES[name] = f"WITH {views} {oracle}" if uses else oracle
        return run

    return register
