"""Orders, ranks, pages and limits.

No plan here moves a whole table into one task: limited results go through
``TakeOrderedAndProject``, a full-table rank is a range partitioning plus
per-partition offsets.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import cut_lineage

PAGE_SIZE = 20


def order_keys(column: str, descending: bool = False, tie: str = "symbol") -> list[Column]:
    """Sort keys with nulls last and a tie-break, so every order is total."""
    c = F.col(column)
    first = c.desc_nulls_last() if descending else c.asc_nulls_last()
    return [first] if column == tie else [first, F.col(tie).asc()]


def global_rank(df: DataFrame, keys: list[Column], name: str = "rank") -> DataFrame:
    """1-based rank of every row under a total order, at any size.

    Rows are range-partitioned and sorted, materialised once (the range bounds
    are sampled, so later passes must see the same rows), and each row's place
    inside its partition is lifted by the row counts of the partitions before.
    Only one count per partition is ever broadcast.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    # monotonically_increasing_id = partition number << 33 | row number.
    laid = laid.withColumn("_id", F.monotonically_increasing_id())
    laid = cut_lineage(
        laid.withColumns(
            {"_part": F.shiftright("_id", 33), "_row": F.col("_id").bitwiseAND((1 << 33) - 1)}
        ).drop("_id")
    )
    counts = laid.groupBy("_part").agg(F.count("*").alias("_n"))  # at most n rows
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return laid.join(F.broadcast(offsets), "_part").select(
        (F.col("_before") + F.col("_row") + 1).alias(name),
        *[c for c in df.columns],
    )


#: Rows that a sort in one task may have to hold; deeper pages are ranked in full.
ONE_TASK_ROWS = 100_000


def rank_limited(
    df: DataFrame, keys: list[Column], count: int | None, offset: int = 0, name: str = "rank", full: bool | None = None
) -> DataFrame:
    """Rows ``offset+1 … offset+count`` of an ordered table with their absolute rank.

    A top-k sort brings ``offset+count`` rows into one task. Beyond ``ONE_TASK_ROWS`` of
    them, or where the caller says ``full``, the table is ranked over ranges instead; so it is
    without ``count``, when every row behind the offset is wanted. The rows are the same.
    """
    if full is None:
        full = count is None or offset + count > ONE_TASK_ROWS
    if full or count is None:
        ranked = global_rank(df, keys, name)
        inside = F.col(name) > offset if count is None else F.col(name).between(offset + 1, offset + count)
        return ranked.where(inside)
    top = df.orderBy(*keys).offset(offset).limit(count) if offset else df.orderBy(*keys).limit(count)
    # The window sees at most ``count`` rows.
    return top.select((F.row_number().over(W.orderBy(*keys)) + offset).cast("bigint").alias(name), *df.columns)


def top_k(df: DataFrame, keys: list[Column], k: int, name: str = "rank") -> DataFrame:
    return rank_limited(df, keys, k, 0, name)


def page(df: DataFrame, keys: list[Column], number: int, size: int = PAGE_SIZE, full: bool | None = None) -> DataFrame:
    """The 1-based page ``number`` of an ordered result, ranked from its start."""
    if number < 1:
        raise ValueError("page must be a positive integer")
    return rank_limited(df, keys, size, (number - 1) * size, full=full)


def walk_limits(
    df: DataFrame,
    keys: list[Column],
    *,
    max_pages: int | None = None,
    max_rows: int | None = None,
    first_page: int = 1,
    size: int = PAGE_SIZE,
) -> tuple[DataFrame, DataFrame]:
    """A page walk: the rows, and one status row.

    It goes to the end unless the caller names a stop. Stops fall on page
    boundaries, so ``max_rows`` is rounded up to whole pages. The walk is
    ``PARTIAL`` when rows remain beyond the stop, and one failed unit stands for
    what was not walked.
    """
    for name, stop in (("max_pages", max_pages), ("max_rows", max_rows), ("first_page", first_page)):
        if stop is not None and stop < 1:
            raise ValueError(f"{name} must be a positive integer")
    offset = (first_page - 1) * size
    by_rows = None if max_rows is None else math.ceil(max_rows / size)
    stops = [n for n in (max_pages, by_rows) if n is not None]
    pages = min(stops) if stops else None
    rows = rank_limited(df, keys, None if pages is None else pages * size, offset)
    left = F.greatest(F.col("total_rows") - offset, F.lit(0))
    all_pages = F.ceil(left / size).cast("bigint")
    done = all_pages if pages is None else F.least(all_pages, F.lit(pages)).cast("bigint")
    partial = F.lit(False) if pages is None else left > pages * size
    status = (
        F.when(left == 0, F.lit("EMPTY")).when(partial, F.lit("PARTIAL")).otherwise(F.lit("COMPLETE"))
    )
    stop = F.when(partial, F.lit("max_rows_reached" if pages == by_rows else "max_pages_reached"))
    facts = df.agg(F.count("*").alias("total_rows")).select(
        "total_rows",
        status.alias("status"),
        stop.alias("stop_code"),
        (done + partial.cast("bigint")).alias("requested_units"),
        done.alias("succeeded_units"),
        partial.cast("bigint").alias("failed_units"),
    )
    return rows, facts


def rank_in_group(df: DataFrame, group: list[str], keys: list[Column], k: int, name: str = "rank") -> DataFrame:
    """The first ``k`` rows of every group, ranked.

    A salted first pass keeps ``k`` rows per group and salt, so the final window
    sees at most ``k * salts`` rows of even the largest group.
    """
    salts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salts))
    local = W.partitionBy(*group, "_salt").orderBy(*keys)
    # Spark turns the rank filter into a group limit ahead of the shuffle.
    kept = df.withColumn("_salt", salt).withColumn("_rn", F.row_number().over(local)).where(F.col("_rn") <= k)
    final = W.partitionBy(*group).orderBy(*keys)
    return (
        kept.drop("_salt", "_rn")
        .withColumn(name, F.row_number().over(final).cast("bigint"))
        .where(F.col(name) <= k)
    )


def rank_position(df: DataFrame, symbol: str, position: str, name: str = "rank") -> DataFrame:
    """Relation rank from a 0-based source position."""
    return df.withColumn(name, (F.col(position) + 1).cast("bigint"))


def dedupe_first(df: DataFrame, key: list[str], position: list[str]) -> DataFrame:
    """The first row of each key by ``position``, as one partial aggregation."""
    rest = [c for c in df.columns if c not in key]
    first = F.min_by(F.struct(*rest), F.struct(*position))
    return df.groupBy(*key).agg(first.alias("_first")).select(*key, *[F.col(f"_first.{c}").alias(c) for c in rest])


def dup_check(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > 1)
