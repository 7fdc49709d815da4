"""Completeness, warnings, drift and hygiene as ordinary aggregates and filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import numeric as N
from ..functions.hashing import hash_row
from ..functions.nested import array_rows, struct_rows


def batch_status(requested: Column, succeeded: Column) -> Column:
    """``EMPTY`` when nothing was asked, else by how many units succeeded."""
    return (
        F.when(requested == 0, F.lit("EMPTY"))
        .when(succeeded == 0, F.lit("FAILED"))
        .when(succeeded < requested, F.lit("PARTIAL"))
        .otherwise(F.lit("COMPLETE"))
    )


def completeness(units: DataFrame, by: list[str], ok: str = "ok") -> DataFrame:
    """Requested, succeeded and failed units per batch, and the batch's status."""
    requested, succeeded = F.count("*"), F.count_if(F.col(ok))
    return units.groupBy(*by).agg(
        requested.alias("requested_units"),
        succeeded.alias("succeeded_units"),
        (requested - succeeded).alias("failed_units"),
        batch_status(requested, succeeded).alias("status"),
    )


def status_fold(units: DataFrame, by: list[str]) -> DataFrame:
    """One envelope per batch over its succeeded units.

    Needs ``ok, position, fetched_at, cache_hit, attempts``. ``fetched_at`` is the
    first succeeded unit's, ``last_fetched_at`` the latest.
    """
    good = F.col("ok")
    place = F.when(good, F.col("position"))
    requested, succeeded = F.count("*"), F.count_if(good)
    return units.groupBy(*by).agg(
        batch_status(requested, succeeded).alias("status"),
        F.min_by("fetched_at", place).alias("fetched_at"),
        F.max(F.when(good, F.col("fetched_at"))).alias("last_fetched_at"),
        F.bool_and(F.when(good, F.col("cache_hit"))).alias("cache_hit"),
        F.max(F.when(good, F.col("attempts"))).alias("attempts"),
        requested.alias("requested_units"),
        succeeded.alias("succeeded_units"),
        (requested - succeeded).alias("failed_units"),
    )


def unit_errors(units: DataFrame, code: str, ok: str = "ok", problem: str = "problem") -> DataFrame:
    """Failed units as rows: a bad document is data, not an exception."""
    return units.where(~F.col(ok)).select("symbol", F.lit(code).alias("code"), F.col(problem).alias("message"))


def warning_rows(df: DataFrame, keys: list[str], column: str = "warnings") -> DataFrame:
    return struct_rows(df, keys, column)


def warning_counts(df: DataFrame, by: list[str] | None = None, column: str = "warnings") -> DataFrame:
    """Warnings by code and field (and further columns)."""
    rows = warning_rows(df, by or [], column)
    return rows.groupBy(*(by or []), "code", "field").agg(F.count("*").alias("n"))


def dq_required(df: DataFrame, required: list[str]) -> DataFrame:
    """One row per required field: how many rows lack it."""
    counts = F.array(
        *[
            F.struct(F.lit(f).alias("field"), F.col(f"_{i}").alias("n_missing"))
            for i, f in enumerate(required)
        ]
    )
    missing = [F.count_if(F.col(f).isNull() | N.is_null_display(F.col(f).cast("string"), key_symbol=f == "symbol")).alias(f"_{i}") for i, f in enumerate(required)]
    return struct_rows(df.agg(*missing), [], counts)


def dq_conversion(raw: Column, typed: Column) -> Column:
    """Whether a display that means something failed to convert."""
    return F.coalesce(raw.isNotNull() & ~N.is_null_display(raw) & typed.isNull(), F.lit(False))


def dq_unknown_field(df: DataFrame, bag: str, known: list[str]) -> DataFrame:
    """Keys outside the contract, with the number of rows that carry them."""
    keys = array_rows(df, [], F.map_keys(bag), "_at", "field")
    return keys.where(~F.col("field").isin(*known)).groupBy("field").agg(F.count("*").alias("n"))


def dq_strict(df: DataFrame, column: str = "warnings") -> DataFrame:
    """Rows unchanged, but drift fails the query: any warning other than missing data raises."""
    drift = F.filter(column, lambda w: w["code"] != "null_sentinel")
    message = F.concat(F.lit("strict schema: "), F.to_json(F.get(drift, F.lit(0))))
    return df.withColumn(column, F.when(F.size(drift) > 0, F.raise_error(message)).otherwise(F.col(column)))


MAX_BYTES = 256 * 1024


def dq_fixture_hygiene(df: DataFrame, key: str, text: str, forbidden: tuple[str, ...], max_bytes: int = MAX_BYTES) -> DataFrame:
    """Documents that break hygiene, with every reason: whole texts are scanned.

    ``forbidden`` are the strings that the publisher's rules rule out, in any case; a
    URL with user information before its host and an oversized text count besides.
    """
    lowered = F.lower(F.col(text))
    checks = [F.when(lowered.contains(word.lower()), F.lit(word)) for word in forbidden]
    checks.append(F.when(F.col(text).rlike(r"://[^/\s]*@"), F.lit("url credentials")))
    checks.append(F.when(F.octet_length(text) > max_bytes, F.lit("too large")))
    found = F.array_compact(F.array(*checks))
    return df.select(key, found.alias("reasons")).where(F.size("reasons") > 0)


def row_identity(df: DataFrame, volatile: tuple[str, ...] = ("fetched_at",)) -> DataFrame:
    """``row_hash`` over every column but the volatile collection metadata."""
    return df.withColumn("row_hash", hash_row(*[F.col(c) for c in df.columns if c not in volatile]))


def observed(df: DataFrame, column: str = "warnings") -> tuple[DataFrame, Observation]:
    """The rows unchanged, with row and warning counts gathered while they flow by.

    Progress without a second pass: read ``observation.get`` after the first action.
    """
    seen = Observation("progress")
    counts = [F.count("*").alias("rows"), F.sum(F.size(column)).alias("warnings")]
    return df.observe(seen, *counts), seen
