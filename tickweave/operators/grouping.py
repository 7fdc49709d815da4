"""Group aggregates over a snapshot: sectors, industries, countries, capitalization.

The provider does not publish its formulas. Ours: sizes are sums, every ratio
and performance figure is a market-cap-weighted mean over the members that have
it. All of it is one partial aggregation, so few and skewed groups are cheap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.text import label_to_field
from ..plans import registry as R


def weighted_mean(value: str, weight: str = "market_cap") -> Column:
    has = F.col(value).isNotNull()
    return F.try_divide(F.sum(F.col(value) * F.col(weight)), F.sum(F.when(has, F.col(weight))))


def aggregates(df: DataFrame) -> list[Column]:
    """Count plus every group measure the snapshot has an ingredient for."""
    measures = [label_to_field(x) for labels in R.GROUP_UNITS.values() for x in labels if x != "Stocks"]
    measures += [c for c in R.GROUP_ORDERS.values() if c not in ("name", "stocks")]  # what only orders show
    out = [F.count("*").cast("bigint").alias("stocks")]
    for name in dict.fromkeys(measures):
        if name in df.columns:
            c = F.sum(name) if name in R.GROUP_SUMS else weighted_mean(name)
            out.append(c.alias(name))
    return out


def dimension(df: DataFrame, name: str, cap_scale: float = 1.0) -> Column:
    if name not in R.GROUP_DIMENSIONS:
        raise R.QueryError(f"unknown dimension {name!r}")
    if name == "Capitalization":
        return R.capitalization(F.col("market_cap"), cap_scale)
    return F.col(R.GROUP_DIMENSIONS[name])


def group_aggregate(df: DataFrame, name: str, sector: str | None = None, cap_scale: float = 1.0) -> DataFrame:
    """One row per group; ``sector`` restricts an Industry grouping to one sector."""
    if sector is not None:
        if name != "Industry":
            raise R.QueryError("a sub-industry sector requires the Industry dimension")
        df = df.where(F.col("sector") == sector)
    by = dimension(df, name, cap_scale).alias("name")
    return df.groupBy(by).agg(*aggregates(df)).where(F.col("name").isNotNull())


def group_subindustry(df: DataFrame, sector: str) -> DataFrame:
    return group_aggregate(df, "Industry", sector)


def group_capitalization(df: DataFrame, cap_scale: float = 1.0) -> DataFrame:
    return group_aggregate(df, "Capitalization", cap_scale=cap_scale)


def group_rollup(df: DataFrame, *columns: str) -> DataFrame:
    """Subtotals along a path such as sector → industry; ``level`` 0 is the finest."""
    return df.rollup(*columns).agg(F.grouping_id().cast("bigint").alias("level"), *aggregates(df))


def group_cube(df: DataFrame, *columns: str) -> DataFrame:
    """Every combination of the dimensions, totals included."""
    return df.cube(*columns).agg(F.grouping_id().cast("bigint").alias("level"), *aggregates(df))


def order_group(df: DataFrame, name: str = "Name", descending: bool = False) -> DataFrame:
    """Groups under a named order, ranked from 1 (a vocabulary-sized result)."""
    if name not in R.GROUP_ORDERS:
        raise R.QueryError(f"unknown order {name!r}")
    column = R.GROUP_ORDERS[name]
    if column not in df.columns:
        raise R.QueryError(f"order {name!r} needs the column {column}")
    key = F.col(column).desc_nulls_last() if descending else F.col(column).asc_nulls_last()
    keys = [key] if column == "name" else [key, F.col("name").asc()]
    return df.withColumn("rank", F.row_number().over(W.orderBy(*keys)).cast("bigint"))


def group_views(df: DataFrame, view: str, columns: tuple[str, ...] | None = None) -> DataFrame:
    """A group view's columns; an aggregate the snapshot could not give is null."""
    if view == "custom":
        if not columns:
            raise R.QueryError("the custom view requires columns")
        for label in columns:
            if label not in R.GROUP_COLUMNS:
                raise R.QueryError(f"unknown column {label!r}")
        if len(set(columns)) != len(columns):
            raise R.QueryError("duplicate column")
        labels = columns
    elif columns:
        raise R.QueryError("columns are only valid with the custom view")
    elif view not in R.GROUP_VIEWS:
        raise R.QueryError(f"unknown view {view!r}")
    else:
        labels = R.GROUP_VIEWS[view]
    lead = [c for c in ("rank", "name") if c in df.columns]
    out = []
    for label in labels:
        name = label_to_field(label)
        kind = R.UNIT_TYPE[R.unit_of(label, "group")]
        c = F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)
        out.append(c.alias(name))
    return df.select(*lead, *out)


def requested_served(requested: list[str], served: list[str]) -> list[str]:
    """Requested columns a page did not serve, in request order."""
    have = set(served)
    return [label for label in requested if label not in have]
