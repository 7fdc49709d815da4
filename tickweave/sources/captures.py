"""Captured documents as a table: readers, envelope facts, outcome split, sinks.

A capture is ``capture_id, endpoint, query, content_type, status_code, body,
fetched_at`` (plus what the collector adds). Nothing here fetches anything.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import canonical_map, hash_response

CAPTURE_SCHEMA = (
    "capture_id bigint, endpoint string, query map<string,string>, content_type string, "
    "status_code int, body string, fetched_at timestamp"
)
NOT_FOUND_TITLE = r"(?i)<title>[^<]*(?:page (?:was )?not found|404 error)[^<]*</title>"


def src_captures(
    spark: SparkSession, path: str, fmt: str = "parquet", schema=CAPTURE_SCHEMA, rename: dict[str, str] | None = None
) -> DataFrame:
    """Captures from files in any Spark format, with the response hash added.

    ``rename`` maps the file's column names to capture columns. ``binaryFile``
    gives one capture per file (body decoded as UTF-8).
    """
    if fmt == "binaryFile":
        files = spark.read.format("binaryFile").load(path)
        df = files.select(
            F.xxhash64("path").alias("capture_id"),
            F.col("path").alias("endpoint"),
            F.decode("content", "UTF-8").alias("body"),
            F.col("modificationTime").alias("fetched_at"),
            F.sha2("content", 256).alias("response_hash"),
        )
        return df
    reader = spark.read.format(fmt)
    if schema is not None and fmt != "parquet":
        reader = reader.schema(schema)
    return with_response_hash(reader.load(path).withColumnsRenamed(rename or {}))


def src_captures_stream(
    spark: SparkSession,
    path: str,
    schema=CAPTURE_SCHEMA,
    fmt: str = "parquet",
    files_per_trigger: int | None = None,
    rename: dict[str, str] | None = None,
) -> DataFrame:
    """The same captures, picked up incrementally as files arrive."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return with_response_hash(reader.load(path).withColumnsRenamed(rename or {}))


def with_response_hash(df: DataFrame) -> DataFrame:
    return df.withColumn("response_hash", hash_response(F.col("body")))


# ---------------------------------------------------------------- classification


def classify_kind(content_type: Column) -> Column:
    """Content type to ``json``, ``html``, ``xml`` or ``artifact``; unknown is null."""
    base = F.lower(F.trim(F.substring_index(content_type, ";", 1)))
    return (
        F.when(base == "", None)
        .when((base == "application/octet-stream") | base.startswith("image/"), F.lit("artifact"))
        .when((base == "application/json") | base.endswith("+json"), F.lit("json"))
        .when(base.contains("html"), F.lit("html"))
        .when(base.contains("xml"), F.lit("xml"))
        .when(base.startswith("text/"), F.lit("html"))
    )


def classify_outcome(status: Column, url: Column, body: Column, host: str) -> Column:
    """``ok``, ``entitlement``, ``cross_origin``, ``blocked``, ``rate_limited``,
    ``not_found`` or ``transport`` — evidence in this order of precedence.

    ``host`` is the provider's host; its ``elite.`` sub-host and the login and
    elite pages are entitlement walls.
    """
    name = re.escape(host)
    elite = url.rlike(rf"(?i)\Ahttps?://(?:[^/]*\.)?elite\.{name}(?:[:/?#]|\z)") | F.regexp_extract(
        url, r"\A[A-Za-z]+://[^/?#]*([^?#]*)", 1
    ).rlike(r"(?:^|/)(?:login|elite)\.aspx\z")
    ours = url.rlike(rf"(?i)\Ahttps?://(?:[^/@]*\.)?{name}(?:[:/?#]|\z)")
    return (
        F.when((status == 200) & elite, F.lit("entitlement"))
        .when(~ours | url.isNull(), F.lit("cross_origin"))
        .when(status == 403, F.lit("blocked"))
        .when(status == 429, F.lit("rate_limited"))
        .when(status == 404, F.lit("not_found"))
        .when((status == 200) & F.coalesce(body.rlike(NOT_FOUND_TITLE), F.lit(False)), F.lit("not_found"))
        .when((status != 200) | status.isNull(), F.lit("transport"))
        .otherwise(F.lit("ok"))
    )


def classify_tier(outcome: Column, authenticated: Column) -> Column:
    """The access tier the evidence supports; sign-in alone never proves more."""
    return (
        F.when(outcome != "ok", F.lit("UNKNOWN"))
        .when(authenticated, F.lit("AUTHENTICATED"))
        .otherwise(F.lit("PUBLIC"))
    )


def classify_response(df: DataFrame, host: str, url: str = "endpoint") -> DataFrame:
    """Envelope columns ``content_kind``, ``outcome``, ``access_tier``, ``response_hash``."""
    outcome = classify_outcome(F.col("status_code"), F.col(url), F.col("body"), host)
    signed_in = F.col("authenticated") if "authenticated" in df.columns else F.lit(False)
    return with_response_hash(df).withColumns(
        {"content_kind": classify_kind(F.col("content_type")), "outcome": outcome}
    ).withColumn("access_tier", classify_tier(F.col("outcome"), signed_in))


def split_outcomes(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable captures and the quarantined rest of a classified table."""
    good = (F.col("outcome") == "ok") & F.col("content_kind").isNotNull()
    return df.where(good), df.where(~good)


# ---------------------------------------------------------------- sinks


def sink_export(df: DataFrame, path: str, fmt: str, mode: str = "error", **options: str) -> None:
    """Write a result as Parquet, JSON or CSV; maps and arrays become JSON text for CSV."""
    if fmt == "csv":
        flat = []
        for f in df.schema:
            if isinstance(f.dataType, T.MapType):
                flat.append(canonical_map(F.col(f.name)).alias(f.name))
            elif isinstance(f.dataType, (T.ArrayType, T.StructType)):
                flat.append(F.to_json(f.name).alias(f.name))
            else:
                flat.append(F.col(f.name))
        df = df.select(*flat)
        # Every display must survive a round trip: quote all, double the quotes.
        options = {"header": "true", "quoteAll": "true", "escape": '"'} | options
    df.write.mode(mode).format(fmt).options(**options).save(path)


def hist_append(df: DataFrame, path: str, dataset: str, fetched_at: str = "fetched_at") -> None:
    """Append observations under ``dataset=…/capture_date=…``.

    Rows are clustered by capture date first, with a hash spread inside each
    date so that one busy day is still written by many tasks.
    """
    spread = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 8)
    stamped = df.withColumns(
        {"dataset": F.lit(dataset), "capture_date": F.to_date(fetched_at)}
    ).withColumn("_slot", F.pmod(F.xxhash64("symbol", fetched_at), F.lit(spread)))
    (
        stamped.repartition("capture_date", "_slot")
        .drop("_slot")
        .write.mode("append")
        .partitionBy("dataset", "capture_date")
        .parquet(path)
    )


def hist_append_stream(df: DataFrame, path: str, dataset: str, checkpoint: str, fetched_at: str = "fetched_at"):
    """The streaming form of :func:`hist_append`, exactly once per input file."""
    stamped = df.withColumns({"dataset": F.lit(dataset), "capture_date": F.to_date(fetched_at)})
    return (
        stamped.writeStream.format("parquet")
        .partitionBy("dataset", "capture_date")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(path)
    )
