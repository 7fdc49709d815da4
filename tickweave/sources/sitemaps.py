"""Sitemaps split at their records: one file of any size is many tasks.

A sitemap is read as text whose lines end with ``</url>``, so Spark cuts a file at its block
size and each task finds the records of its range. Every piece is parsed as XML for itself:
a broken entry is one bad record, not a bad file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.nested import once
from ..operators.ranking import dedupe_first

ENTRY = "loc string, lastmod string, priority double, _bad string"

#: Where a record stands: its file, the begin of its split, and its turn there.
PLACE = ("file", "split", "turn")


def sitemap_records(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(*PLACE, loc, lastmod, priority)`` of every entry, and the broken ones with their text as ``problem``.

    An entry without ``loc`` is broken. What precedes the first entry and follows the
    last is no record. Order by ``PLACE`` for the order of the files.
    """
    pieces = spark.read.option("lineSep", "</url>").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("turn"),
        F.regexp_extract("value", r"(?s)<url\b[^>]*>.*\z", 0).alias("_entry"),
    )
    entry = F.from_xml(F.concat("_entry", F.lit("</url>")), ENTRY, {"columnNameOfCorruptRecord": "_bad", "mode": "PERMISSIVE"})
    parsed = once(pieces.where(F.col("_entry") != ""), [*PLACE, "_entry"], {"e": entry})
    good = F.col("e._bad").isNull() & (F.coalesce(F.trim("e.loc"), F.lit("")) != "")
    rows = parsed.where(F.coalesce(good, F.lit(False))).select(*PLACE, F.trim("e.loc").alias("loc"), "e.lastmod", "e.priority")
    bad = parsed.where(~F.coalesce(good, F.lit(False))).select(*PLACE, F.col("_entry").alias("problem"))
    return rows, bad


def sitemap_symbols(rows: DataFrame, host: str) -> tuple[DataFrame, DataFrame]:
    """Symbols at their first place, and the entries whose URL names none."""
    named = once(rows, [*PLACE, "loc"], {"symbol": X.sym_from_url(F.col("loc"), host)})
    first = dedupe_first(named.where(F.col("symbol").isNotNull()), ["symbol"], list(PLACE))
    return first, named.where(F.col("symbol").isNull()).drop("symbol")
