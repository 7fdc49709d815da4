"""Joins, set operations and reshapes of market relations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import canonical_map
from ..functions.nested import array_rows, struct_rows
from ..functions.text import sym_canonical
from ..plans.registry import STATEMENT_CODES, QueryError
from ..schemas import ContractError, empty_typed
from .ranking import dedupe_first

# ---------------------------------------------------------------- joins


def map_join_perf(leaves: DataFrame, perf: DataFrame) -> DataFrame:
    """Every hierarchy leaf with its ticker's performance, null when it has none.

    No broadcast hint: the optimizer broadcasts the side it can prove small and
    otherwise merges both sides on the symbol.
    """
    return leaves.join(perf.select("symbol", "perf"), "symbol", "left")


def map_unmapped(perf: DataFrame, leaves: DataFrame) -> DataFrame:
    """Symbols with a performance but no leaf."""
    return perf.join(leaves.select("symbol"), "symbol", "left_anti").select("symbol")


def map_bundle(leaves: DataFrame, perf: DataFrame) -> dict[str, DataFrame]:
    """Constituents with their place in the tree, unmapped symbols, and one row of facts."""
    joined = map_join_perf(leaves, perf)
    unmapped = map_unmapped(perf, leaves)
    facts = joined.agg(
        F.count("*").alias("n_constituents"),
        F.count("perf").alias("n_with_perf"),
        F.countDistinct("sector").alias("n_sectors"),
    ).crossJoin(unmapped.agg(F.count("*").alias("n_unmapped")))  # one row by one row
    return {"constituents": joined, "unmapped": unmapped, "facts": facts}


def futures_category(tiles: DataFrame, listed: DataFrame, order: Sequence[str] = ("g_no", "c_no")) -> DataFrame:
    """Tiles with the category of the first group that lists their contract."""
    by = [c for c in tiles.columns if c in listed.columns and c not in (*order, "category")]
    first = dedupe_first(listed.select(*by, *order, "category"), by, list(order))
    return tiles.join(first.select(*by, "category"), by, "left")


def sym_resolve(requests: DataFrame, column: str = "requested") -> DataFrame:
    """``position, requested, canonical``: one record per input spelling."""
    return requests.select("position", F.col(column).alias("requested"), sym_canonical(F.col(column)).alias("canonical"))


def sym_resolve_join(requests: DataFrame, results: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Results for every requested position, in request order of positions.

    Several spellings of one symbol share its result; a symbol without result
    keeps its record.
    """
    resolved = sym_resolve(requests)
    return resolved.join(results.withColumnRenamed(symbol, "canonical"), "canonical", "left")


def registry_diff(checked_in: DataFrame, observed: DataFrame, name: str = "name", namespace: str = "namespace") -> DataFrame:
    """Added, removed and changed entries per namespace, with old and new fields.

    Namespaces nobody observed are left out: absent evidence is not removal.
    """
    fields = [c for c in checked_in.columns if c not in (name, namespace)]
    seen = observed.select(namespace).distinct()
    old = checked_in.join(seen, namespace, "left_semi").select(
        namespace, name, F.struct(*fields).alias("old")
    )
    new = observed.select(namespace, name, F.struct(*fields).alias("new"))
    both = old.join(new, [namespace, name], "full_outer")
    differing = F.array_compact(
        F.array(*[F.when(~F.col(f"old.{f}").eqNullSafe(F.col(f"new.{f}")), F.lit(f)) for f in fields])
    )
    change = (
        F.when(F.col("old").isNull(), F.lit("added"))
        .when(F.col("new").isNull(), F.lit("removed"))
        .when(F.size(differing) > 0, F.lit("changed"))
    )
    return (
        both.select(
            namespace,
            name,
            change.alias("change"),
            F.when(change == "changed", differing).alias("fields"),
            *[F.col(f"old.{f}").alias(f"old_{f}") for f in fields],
            *[F.col(f"new.{f}").alias(f"new_{f}") for f in fields],
        )
        .where(F.col("change").isNotNull())
    )


def requested_served_rows(requested: DataFrame, served: DataFrame, on: list[str]) -> DataFrame:
    """Requested rows that were not served."""
    return requested.join(served, on, "left_anti")


def calendar_join_rows(calendar: DataFrame, detail: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Each calendar event beside every row of its release's history."""
    return calendar.join(detail, symbol, "left")


def calendar_join_detail(calendar: DataFrame, detail: DataFrame, tie: str = "actual") -> DataFrame:
    """Each calendar event with its release's earlier history, aggregated first.

    The history is folded to one row per release before the join, so a release
    with a very long history is never multiplied by its calendar rows. Of a last day
    with several rows that with the largest ``tie`` counts.
    """
    folded = detail.groupBy("symbol").agg(
        F.count("*").alias("n_history"),
        F.max("release_date").alias("last_release"),
        F.max_by("actual", F.struct("release_date", tie)).alias("last_actual"),
    )
    return calendar.join(folded, "symbol", "left")


# ---------------------------------------------------------------- sets


def same_shape(parts: Sequence[DataFrame]) -> None:
    first = [(f.name, f.dataType) for f in parts[0].schema]
    for at, df in enumerate(parts[1:], start=2):
        if [(f.name, f.dataType) for f in df.schema] != first:
            raise ContractError(f"columns of part {at} drifted from the first part")


def concat_strict(parts: Sequence[DataFrame]) -> DataFrame:
    """Concatenation of tables with one schema; any column drift is an error."""
    if not parts:
        raise ContractError("nothing to concatenate")
    same_shape(parts)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=False), parts)


def concat_projection(spark: SparkSession, name: str, parts: Sequence[DataFrame | None]) -> DataFrame:
    """Concatenation of one dataset's parts; absent parts leave the typed empty table."""
    present = [p for p in parts if p is not None]
    return concat_strict(present) if present else empty_typed(spark, name)


def _comparable(df: DataFrame) -> DataFrame:
    """Map columns as key-sorted JSON, so set operations accept them."""
    return df.select(
        *[
            canonical_map(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.MapType) else F.col(f.name)
            for f in df.schema
        ]
    )


def set_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows with ``side`` added, removed or common, as sets: one combined aggregation."""
    a = _comparable(old).withColumn("_o", F.lit(1))
    b = _comparable(new).withColumn("_n", F.lit(1))
    columns = old.columns
    both = a.unionByName(b, allowMissingColumns=True).groupBy(*columns).agg(
        F.max("_o").alias("_o"), F.max("_n").alias("_n")
    )
    side = (
        F.when(F.col("_o").isNull(), F.lit("added")).when(F.col("_n").isNull(), F.lit("removed")).otherwise(F.lit("common"))
    )
    return both.select(*columns, side.alias("side"))


# ---------------------------------------------------------------- statements


def stmt_codes(code: Column) -> Column:
    """``struct<kind, periodicity>`` of a statement code; null for an unknown one."""
    kinds = F.create_map(*[F.lit(x) for c, (kind, _) in STATEMENT_CODES.items() for x in (c, kind)])
    spans = F.create_map(*[F.lit(x) for c, (_, span) in STATEMENT_CODES.items() for x in (c, span)])
    known = code.isin(*STATEMENT_CODES)
    return F.when(
        known,
        F.struct(
            F.try_element_at(kinds, code).alias("kind"), F.try_element_at(spans, code).alias("periodicity")
        ),
    )


def statement_code(code: str) -> tuple[str, str]:
    if code not in STATEMENT_CODES:
        raise QueryError(f"statement must be one of {', '.join(sorted(STATEMENT_CODES))}; got {code!r}")
    return STATEMENT_CODES[code]


def period_lengths(ends: Column) -> Column:
    """Days from each period end to the next one in source order; last is null."""
    return F.transform(ends, lambda e, i: F.datediff(e, F.get(ends, i + 1)).cast("bigint"))


def stmt_long(df: DataFrame, keys: list[str], periods: str, ends: str, metrics: str, metric_order: str | None = None) -> DataFrame:
    """Period arrays to one row per metric and period; a pure explode, no shuffle.

    ``ends`` holds dates, ``metrics`` maps a metric to its array. Positions count
    in source order.
    """
    base = df.withColumns({"_lengths": period_lengths(F.col(ends))})
    entries = F.map_entries(metrics)
    frame = [*keys, periods, ends, "_lengths"]
    per_metric = array_rows(base, frame, entries, "metric_no", "m")
    frame = [*frame, "metric_no", F.col("m.key").alias("metric")]
    return (
        array_rows(per_metric, frame, "m.value", "position", "value")
        .select(
            *keys,
            "metric_no",
            "position",
            F.get(periods, F.col("position")).alias("period_label"),
            F.get(ends, F.col("position")).alias("period_end_date"),
            F.get("_lengths", F.col("position")).alias("period_length_days"),
            "metric",
            "value",
        )
    )


def long_to_wide(df: DataFrame, keys: list[str], metric: str, value: str, metrics: list[str]) -> DataFrame:
    """Metrics as columns. The names are given, so no job has to find them."""
    return df.groupBy(*keys).agg(
        *[F.max(F.when(F.col(metric) == m, F.col(value))).alias(m) for m in metrics]
    )


def wide_to_long(df: DataFrame, keys: list[str], columns: list[str], units: dict[str, str] | None = None) -> DataFrame:
    """Wide observations to ``metric, value_numeric, value_text, unit`` rows."""
    units = units or {}
    numeric = {f.name for f in df.schema if isinstance(f.dataType, T.NumericType)}
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("metric"),
                (F.col(c).cast("double") if c in numeric else F.lit(None).cast("double")).alias("value_numeric"),
                (F.lit(None).cast("string") if c in numeric else F.col(c).cast("string")).alias("value_text"),
                F.lit(units.get(c)).cast("string").alias("unit"),
            )
            for c in columns
        ]
    )
    return struct_rows(df, keys, entries)
