"""JSON whose fields change type from page to page, as VARIANT.

A VARIANT keeps every value as it was written: a number here and a text there under one key
are both there, typed reads return null where the value is of another kind, and nothing
has to be declared before it is read. The text itself stays beside it, character by character.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nested import once
from ..plans import families as P


def kind_of(value: Column) -> Column:
    """``number``, ``text``, ``boolean``, ``null``, ``list`` or ``object``; null where there is no value."""
    name = F.regexp_extract(F.schema_of_variant(value), r"\A[A-Z]+", 0)
    kinds = {"STRING": "text", "BOOLEAN": "boolean", "VOID": "null", "ARRAY": "list", "OBJECT": "object", "BIGINT": "number", "DOUBLE": "number", "DECIMAL": "number", "FLOAT": "number"}
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair]), name)


def typed(value: Column, path: str, kind: str) -> Column:
    """A field as ``kind``, null where it is missing or does not convert; a list or object does not become text."""
    found = F.try_variant_get(value, path, "variant")
    return F.when(~F.coalesce(kind_of(found).isin("list", "object", "null"), F.lit(False)), F.try_variant_get(value, path, kind))


def disclosures(docs: DataFrame, kind: str) -> DataFrame:
    """``(*keys, source, page, report_dates)``: the embedded text as written, the portfolio's VARIANT, its dates as dates.

    A date that is none is left out of ``report_dates``; pages without a portfolio are left
    to ``families.page_errors``.
    """
    root, dates = P.DISCLOSURE_ROOTS[kind]
    keys = P.keys_of(docs)
    pages = once(docs, keys, {"source": P.disclosed(root)}).where(F.col("source").isNotNull())
    pages = once(pages, [*keys, "source"], {"_all": F.try_parse_json("source")})
    listed = F.try_variant_get("_all", f"$.{dates}", "array<string>")
    known = F.array_compact(F.transform(F.coalesce(listed, F.array().cast("array<string>")), lambda d: d.try_cast("date")))
    return pages.select(*keys, "source", F.try_variant_get("_all", f"$.{root}", "variant").alias("page"), known.alias("report_dates"))


def exploded(df: DataFrame, value: str, path: str, keep: list[str]) -> DataFrame:
    """``(*keep, pos, key, item)``: elements of a list (``key`` null) or fields of an object, one row each.

    Rows whose value is neither have none.
    """
    rows = df.select(*keep, F.try_variant_get(F.col(value), path, "variant").alias("_v"))
    rows = rows.where(kind_of(F.col("_v")).isin("list", "object"))
    parts = rows.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("_v").outer()))
    return parts.select(*keep, "pos", "key", F.col("value").alias("item"))


def suggestion_variants(df: DataFrame, body: str = "body") -> DataFrame:
    """Suggestions with their additional fields as VARIANT, so that numbers stay numbers."""
    keys = [c for c in df.columns if c != body]
    pages = df.select(*keys, F.try_parse_json(body).alias("_page"))
    items = exploded(pages, "_page", "$", keys)
    text = {n: typed(F.col("item"), f"$.{n}", "string") for n in ("ticker", "company", "exchange")}
    return items.select(*keys, (F.col("pos") + 1).cast("bigint").alias("rank"), F.upper(text["ticker"]).alias("symbol"), text["company"].alias("company"), text["exchange"].alias("exchange"), F.col("item").alias("fields"))
