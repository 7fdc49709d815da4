"""Observation history from repeated captures.

One symbol may hold a large share of all captures, so nothing here windows over a
whole key. Ordered operators cut every key into time buckets, work inside
``(key, bucket)``, and bring over what the earlier buckets contribute from a
table with one row per key and bucket. The rows of one bucket, not of one key,
bound a task; pass a finer ``unit`` where one key is busier still.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.hashing import hash_row
from ..functions.nested import array_rows

BUCKET = "hour"


def _bucket(at: str, unit: str) -> Column:
    return F.date_trunc(unit, F.col(at))


def _carried(df: DataFrame, key: list[str], order: list[str], value: Column) -> DataFrame:
    """Per key and bucket, the last non-null ``value`` of all earlier buckets.

    The aggregation combines on the map side; the window afterwards sees one row
    per bucket of a key, not one per observation.
    """
    last = F.max_by(value, F.when(value.isNotNull(), F.struct(*order)))
    ends = df.groupBy(*key, "_bucket").agg(last.alias("_last"))
    before = W.partitionBy(*key).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    return ends.select(*key, "_bucket", F.last("_last", ignorenulls=True).over(before).alias("_carry"))


def with_previous(df: DataFrame, key: list[str], order: list[str], value: Column, name: str, unit: str = BUCKET) -> DataFrame:
    """``value`` of the key's previous row under ``order`` (whose first column is a time)."""
    at = df.withColumns({"_bucket": _bucket(order[0], unit), "_value": F.struct(value.alias("v"))})
    inside = W.partitionBy(*key, "_bucket").orderBy(*order)
    carry = _carried(at, key, order, F.col("_value"))
    joined = at.withColumn("_prev", F.lag("_value").over(inside)).join(carry, [*key, "_bucket"], "left")
    # A struct around the value tells "no previous row" from "previous was null".
    picked = F.coalesce("_prev", "_carry")
    return joined.select(
        *df.columns,
        picked["v"].alias(name),
        picked.isNotNull().alias(f"has_{name}"),
    )


def hist_dedupe_response(df: DataFrame, key: list[str], digest: str = "response_hash", order: tuple[str, ...] = ("fetched_at", "id"), mode: str = "ever", unit: str = BUCKET) -> DataFrame:
    """Captures whose body hash is new: never seen (``ever``) or unlike the last (``changed``)."""
    if mode == "ever":
        first = df.groupBy(*key, digest).agg(
            F.min_by(F.struct(*[c for c in df.columns if c not in (*key, digest)]), F.struct(*order)).alias("_first")
        )
        return first.select(*key, digest, "_first.*").select(*df.columns)
    prev = with_previous(df, key, list(order), F.col(digest), "previous", unit)
    return prev.where(~F.col("has_previous") | ~F.col("previous").eqNullSafe(F.col(digest))).select(*df.columns)


def hist_change_feed(df: DataFrame, key: list[str], values: list[str], order: tuple[str, ...] = ("fetched_at", "id"), unit: str = BUCKET) -> DataFrame:
    """Rows whose normalised values differ from the key's previous row."""
    hashed = df.withColumn("row_hash", hash_row(*[F.col(v) for v in values]))
    prev = with_previous(hashed, key, list(order), F.col("row_hash"), "previous_hash", unit)
    changed = ~F.col("has_previous_hash") | (F.col("previous_hash") != F.col("row_hash"))
    return prev.where(changed).drop("has_previous_hash")


def hist_scd2(feed: DataFrame, key: list[str], order: tuple[str, ...] = ("fetched_at", "id"), unit: str = BUCKET) -> DataFrame:
    """Validity intervals of a change feed; the open interval is current.

    The end of an interval is the next change of the key: inside the bucket a
    ``lead``, for the last row of a bucket the first change of a later bucket.
    """
    at = order[0]
    base = feed.withColumn("_bucket", _bucket(at, unit))
    inside = W.partitionBy(*key, "_bucket").orderBy(*order)
    starts = base.groupBy(*key, "_bucket").agg(F.min(at).alias("_first"))
    later = W.partitionBy(*key).orderBy("_bucket")
    starts = starts.select(*key, "_bucket", F.lead("_first").over(later).alias("_next"))
    joined = base.withColumn("_lead", F.lead(at).over(inside)).join(starts, [*key, "_bucket"], "left")
    valid_to = F.coalesce("_lead", "_next")
    return joined.select(
        *feed.columns,
        F.col(at).alias("valid_from"),
        valid_to.alias("valid_to"),
        valid_to.isNull().alias("is_current"),
    )


def hist_intervals(df: DataFrame, key: list[str], values: list[str], order: tuple[str, ...] = ("fetched_at", "id"), unit: str = BUCKET) -> DataFrame:
    """``hist_scd2`` of the ``hist_change_feed`` of rows that may repeat: one row per key and ``order`` counts.

    The rows are dealt once, by key and bucket, before anything is added to them; repeats are
    dropped and rows compared where they lie. One row per bucket of a key, with the hashes at its ends and its
    first change, tells both what earlier buckets bring over and when a later one changes.
    """
    at, order = order[0], list(order)
    cell = [*key, "_bucket"]
    rows = df.select(*key, *order, *values, _bucket(at, unit).alias("_bucket")).repartition(*cell)
    rows = rows.dropDuplicates([*cell, *order]).withColumn("row_hash", hash_row(*[F.col(v) for v in values]))
    inside = W.partitionBy(*cell).orderBy(*order)
    rows = rows.withColumn("_prev", F.lag("row_hash").over(inside))
    place = F.struct(*order)
    ends = rows.groupBy(*cell).agg(
        F.unhex(F.min_by("row_hash", place)).alias("_begin"),
        F.unhex(F.max_by("row_hash", place)).alias("_end"),
        F.min(at).alias("_since"),
        F.min(F.when(F.col("_prev") != F.col("row_hash"), F.col(at))).alias("_turn"),
    )
    buckets = W.partitionBy(*key)
    ends = ends.withColumn("_carry", F.lag("_end").over(buckets.orderBy("_bucket")))
    first = F.when(F.col("_carry").isNull() | (F.col("_carry") != F.col("_begin")), F.col("_since")).otherwise(F.col("_turn"))
    later = buckets.orderBy(F.desc("_bucket")).rowsBetween(W.unboundedPreceding, -1)
    ends = ends.withColumn("_first", first).select(*cell, "_carry", F.last("_first", ignorenulls=True).over(later).alias("_next"))
    joined = rows.join(ends, cell, "left")
    before = F.coalesce(F.unhex("_prev"), "_carry")
    feed = joined.where(before.isNull() | (before != F.unhex("row_hash")))
    valid_to = F.coalesce(F.lead(at).over(inside), "_next")
    feed = feed.withColumn("valid_to", valid_to)
    return feed.select(*key, *order, *values, "row_hash", F.col(at).alias("valid_from"), "valid_to", F.col("valid_to").isNull().alias("is_current"))


def hist_current(df: DataFrame, key: list[str], order: tuple[str, ...] = ("fetched_at", "id")) -> DataFrame:
    """The latest row of every key, as one partial aggregation."""
    rest = [c for c in df.columns if c not in key]
    latest = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*key).agg(latest.alias("_latest")).select(*key, *[F.col(f"_latest.{c}").alias(c) for c in rest])


def hist_asof(df: DataFrame, key: list[str], at: Column, order: tuple[str, ...] = ("fetched_at", "id")) -> DataFrame:
    """The state known at one instant: nothing fetched later may enter."""
    return hist_current(df.where(F.col(order[0]) <= at), key, order)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    key: list[str],
    left_at: str,
    right_at: str,
    take: list[str],
    tie: str,
    unit: str = BUCKET,
) -> DataFrame:
    """Each left row with the key's latest right row at or before it.

    Both sides meet in one union per ``(key, bucket)``; right rows precede left
    rows of the same instant, ``tie`` orders right rows among themselves.
    """
    rest = [c for c in left.columns if c not in key]
    value = F.struct(F.col(right_at).alias("_seen_at"), *[F.col(c) for c in take])
    r = right.select(*key, F.col(right_at).alias("_at"), F.lit(0).alias("_side"), F.col(tie).cast("bigint").alias("_tie"), value.alias("_value"), F.lit(None).cast(left.select(F.struct(*rest)).schema[0].dataType).alias("_row"))
    l = left.select(*key, F.col(left_at).alias("_at"), F.lit(1).alias("_side"), F.lit(0).cast("bigint").alias("_tie"), F.lit(None).cast(r.schema["_value"].dataType).alias("_value"), F.struct(*rest).alias("_row"))
    both = r.unionByName(l).withColumn("_bucket", _bucket("_at", unit))
    order = ["_at", "_side", "_tie"]
    inside = W.partitionBy(*key, "_bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    carry = _carried(both, key, order, F.col("_value"))
    seen = both.withColumn("_here", F.last("_value", ignorenulls=True).over(inside)).where(F.col("_side") == 1)
    joined = seen.join(carry, [*key, "_bucket"], "left")
    found = F.coalesce("_here", "_carry")
    return joined.select(*key, "_row.*", found["_seen_at"].alias(f"asof_{right_at}"), *[found[c].alias(f"asof_{c}") for c in take])


def hist_revisions(df: DataFrame, key: list[str], value: str, order: tuple[str, ...] = ("fetched_at", "id"), unit: str = BUCKET) -> DataFrame:
    """Rows that revise an earlier value of the same key, with old and new value."""
    prev = with_previous(df, key, list(order), F.col(value), "old_value", unit)
    revised = F.col("has_old_value") & ~F.col("old_value").eqNullSafe(F.col(value))
    return prev.where(revised).select(*key, order[0], "old_value", F.col(value).alias("new_value"))


def hist_membership(df: DataFrame, group: list[str], capture: str, symbol: str = "symbol") -> DataFrame:
    """Enter, stay and exit of members between consecutive captures of a group.

    Captures are numbered from their distinct instants only; members then meet
    their own row of the previous capture by equality.
    """
    members = df.select(*group, capture, symbol).distinct()
    runs = members.select(*group, capture).distinct()
    numbered = runs.withColumn("_n", F.row_number().over(W.partitionBy(*group).orderBy(capture)))
    following = numbered.select(*group, F.col(capture).alias("_before"), (F.col("_n") + 1).alias("_n")).join(
        numbered, [*group, "_n"]
    )
    pairs = [*group, capture]
    now = members.join(numbered.where(F.col("_n") > 1).select(*pairs), pairs, "left_semi").withColumn("_now", F.lit(True))
    was = (
        members.withColumnRenamed(capture, "_before")
        .join(following.select(*group, "_before", capture), [*group, "_before"])
        .select(*group, capture, symbol)
        .withColumn("_was", F.lit(True))
    )
    both = now.join(was, [*group, capture, symbol], "full_outer")
    change = F.when(F.col("_was").isNull(), F.lit("enter")).when(F.col("_now").isNull(), F.lit("exit")).otherwise(F.lit("stay"))
    return both.select(*group, capture, symbol, change.alias("transition"))


def hist_sessions(
    df: DataFrame, key: list[str], gap_seconds: int, value: str, order: tuple[str, ...] = ("fetched_at", "id"), unit: str = BUCKET
) -> DataFrame:
    """Sessions of a key: runs of rows of which each is less than ``gap_seconds`` after the one before.

    Gaps are found inside ``(key, bucket)``, with the last instant of the earlier buckets
    carried in. A row without a gap before it belongs to the latest start at or before it,
    in its bucket or carried. Segments of a session that spans buckets are merged by that
    start, so a symbol with a large share of all rows is many tasks throughout.
    """
    at, order = order[0], list(order)
    gap = F.expr(f"interval {gap_seconds} seconds")
    seen = with_previous(df.select(*key, *order, value), key, order, F.col(at), "_before", unit)
    begins = ~F.col("has__before") | (F.col(at) >= F.col("_before") + gap)
    marked = seen.withColumns({"_bucket": _bucket(at, unit), "_begin": F.when(begins, F.col(at))})
    inside = W.partitionBy(*key, "_bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    carry = _carried(marked, key, order, F.col("_begin"))
    marked = marked.withColumn("_here", F.last("_begin", ignorenulls=True).over(inside)).join(carry, [*key, "_bucket"], "left")
    return marked.groupBy(*key, F.coalesce("_here", "_carry").alias("window_start")).agg(
        (F.max(at) + gap).alias("window_end"),
        F.count("*").alias("n"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
        F.avg(value).alias("mean_value"),
    )


def hist_range_stats(
    df: DataFrame, key: list[str], value: str, order: tuple[str, ...] = ("fetched_at", "id"), *, range_seconds: int, bucket_seconds: int = 3600
) -> DataFrame:
    """Mean, min, max and count of a value over the ``range_seconds`` up to each row, both ends included.

    A frame is three pieces: the rows of the row's own bucket up to it, whole buckets in
    between, which one row per bucket stands for, and the end of the bucket in which the
    frame begins. For the last piece every row is copied once, moved on by the range, so
    that it meets the rows whose frames begin in its bucket. Nothing windows over more than
    one bucket of rows, however long the range and however busy the key.
    """
    if range_seconds % bucket_seconds or range_seconds <= 0:
        raise ValueError("range_seconds must be a positive multiple of bucket_seconds")
    width, reach, span = bucket_seconds * 1_000_000, range_seconds * 1_000_000, range_seconds // bucket_seconds
    at = F.unix_micros(F.col(order[0]).cast("timestamp"))
    base = df.select(*key, *order, F.col(value).alias("_v"), at.alias("_t"))
    bucket = F.floor(F.col("_t") / width).cast("bigint")
    own = base.select(*key, bucket.alias("_bucket"), "_t", F.col("_v").alias("_own"), F.lit(None).cast("double").alias("_moved"), F.struct(*order, "_v").alias("_row"))
    moved = base.select(
        *key, (bucket + span).alias("_bucket"), (F.col("_t") + reach).alias("_t"), F.lit(None).cast("double").alias("_own"),
        F.col("_v").alias("_moved"), F.lit(None).cast(own.schema["_row"].dataType).alias("_row"),
    )
    within = W.partitionBy(*key, "_bucket").orderBy("_t")
    upto, onward = within.rangeBetween(W.unboundedPreceding, 0), within.rangeBetween(0, W.unboundedFollowing)

    def pieces(name: str, frame) -> dict[str, Column]:
        c = F.col(f"_{name}")
        return {f"_{name}_{f.__name__}": f(c).over(frame) for f in (F.count, F.sum, F.min, F.max)}

    rows = own.unionByName(moved).withColumns(pieces("own", upto) | pieces("moved", onward)).where(F.col("_row").isNotNull())
    whole = own.groupBy(*key, "_bucket").agg(*[f("_own").alias(f"_b_{f.__name__}") for f in (F.count, F.sum, F.min, F.max)])
    between = W.partitionBy(*key).orderBy("_bucket").rangeBetween(1 - span, -1)
    fold = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}
    whole = whole.select(*key, "_bucket", *[f(f"_b_{n}").over(between).alias(f"_mid_{n}") for n, f in fold.items()])
    joined = rows.join(whole, [*key, "_bucket"], "left")

    def all_of(n: str) -> list[Column]:
        return [F.col(f"_{piece}_{n}") for piece in ("own", "mid", "moved")]

    def total(n: str) -> Column:
        a, b, c = (F.coalesce(x, F.lit(0)) for x in all_of(n))
        return a + b + c

    return joined.select(
        *key,
        *[F.col(f"_row.{c}").alias(c) for c in order],
        F.col("_row._v").alias(value),
        (total("sum") / F.nullif(total("count"), F.lit(0))).alias("moving_mean"),
        F.least(*all_of("min")).alias("moving_min"),
        F.greatest(*all_of("max")).alias("moving_max"),
        total("count").cast("bigint").alias("n_rows"),
    )


def hist_window_stats(
    df: DataFrame, key: list[str], value: str, order: tuple[str, ...] = ("fetched_at", "id"), rows: int = 3, unit: str = BUCKET
) -> DataFrame:
    """Moving mean, min and max of a value over the last ``rows`` earlier rows and its own.

    The last rows before a bucket are copied into it, so the window never reaches
    beyond ``(key, bucket)``; at most ``rows`` copies per bucket.
    """
    order = list(order)
    base = df.withColumn("_bucket", _bucket(order[0], unit))
    item = F.struct(*order, F.col(value).alias("_v"))
    reverse = W.partitionBy(*key, "_bucket").orderBy(*[F.col(c).desc() for c in order])
    tails = (
        base.withColumn("_rn", F.row_number().over(reverse))
        .where(F.col("_rn") <= rows)
        .groupBy(*key, "_bucket")
        .agg(F.array_sort(F.collect_list(item)).alias("_tail"))  # at most ``rows`` items
    )
    recent = W.partitionBy(*key).orderBy("_bucket").rowsBetween(-rows, -1)
    before = tails.withColumn("_before", F.flatten(F.collect_list("_tail").over(recent)))
    latest = F.slice(F.reverse(F.array_sort("_before")), 1, rows)
    halo = array_rows(before, [*key, "_bucket"], latest, "_at", "h")
    halo = halo.select(*key, "_bucket", *[F.col(f"h.{c}").alias(c) for c in order], F.col("h._v").alias("_v"), F.lit(False).alias("_own"))
    own = base.select(*key, "_bucket", *order, F.col(value).alias("_v"), F.lit(True).alias("_own"))
    w = W.partitionBy(*key, "_bucket").orderBy(*order).rowsBetween(-rows, 0)
    both = own.unionByName(halo)
    return (
        both.withColumns(
            {
                "moving_mean": F.avg("_v").over(w),
                "moving_min": F.min("_v").over(w),
                "moving_max": F.max("_v").over(w),
                "n_rows": F.count("_v").over(w),
            }
        )
        .where("_own")
        .select(*key, *order, F.col("_v").alias(value), "moving_mean", "moving_min", "moving_max", "n_rows")
    )
