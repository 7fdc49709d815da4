"""Arrays and maps to rows, and let-bindings for nested expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    Inside a lambda an ordinary column expression is computed again for every
    element; a lambda variable is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def array_rows(df: DataFrame, keep: Sequence, array: Column | str, pos: str, item: str) -> DataFrame:
    """One row per array element with its 0-based position.

    For a plain ``explode`` the optimizer infers ``size(array) > 0`` and pushes it
    to the scan with the whole array expression copied in, so a parsed or
    assembled array would be built several times per row. The outer form with a
    filter on the position builds it once.
    """
    return df.select(*keep, F.posexplode_outer(array).alias(pos, item)).where(F.col(pos).isNotNull())


def map_rows(df: DataFrame, keep: Sequence, entries: Column | str, key: str, value: str) -> DataFrame:
    """One row per map entry; see :func:`array_rows`."""
    return df.select(*keep, F.explode_outer(entries).alias(key, value)).where(F.col(key).isNotNull())


def struct_rows(df: DataFrame, keep: Sequence[str], array: Column | str) -> DataFrame:
    """One row per element of an array of structs, its fields as columns."""
    return array_rows(df, keep, array, "_pos", "_item").select(*keep, "_item.*")


def once(df: DataFrame, keep: Sequence[str], columns: dict[str, Column]) -> DataFrame:
    """``keep`` plus computed columns that are evaluated exactly once per row.

    A later filter on a computed column would be pushed below it with the whole
    computation copied in. One-element arrays of structs keep it above.
    """
    packed = F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))
    return df.select(*keep, F.explode_outer(packed).alias("_once")).select(*keep, "_once.*")
