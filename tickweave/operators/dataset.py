"""Source-near rows of displays to a registered dataset, as one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numeric as N
from ..functions import temporal as M
from ..functions.nested import let
from ..schemas import ContractError, dataset

WARNINGS = "warnings"
WARNING_TYPE = "struct<code string, field string, raw string>"

_SCALARS = {
    "text": lambda c: c,
    "count": N.norm_count,
    "number": N.norm_number,
    "compact": N.norm_compact,
    "percent": N.norm_percent,
    "date": M.norm_date_iso,
}


def _warning(code: str, field: str, raw: Column) -> Column:
    return F.struct(
        F.lit(code).alias("code"), F.lit(field).alias("field"), raw.cast("string").alias("raw")
    )


def build_dataset(
    df: DataFrame,
    name: str,
    *,
    fetched_at: str = "fetched_at",
    anchor: str | None = None,
    extra: str | None = None,
    on_error: str = "null",
    with_warnings: bool = False,
    passed: tuple[Column, ...] = (),
) -> DataFrame:
    """Project display columns onto dataset ``name``.

    ``df`` holds one column per source field (text, or already of the field's
    type). Columns outside the registry and the entries of the optional map
    column ``extra`` go to ``extra_fields`` in name order with an
    ``unknown_field`` warning. ``<field>__display`` supplies the exact display
    for a companion when the row carries a normalised shape. ``anchor`` is a
    date column for time-only displays; by default the New York date of
    ``fetched_at``.

    A display that does not convert is null with its raw display kept. Where a
    field has no raw companion or is required, ``on_error`` decides: "null" (and
    "raise", for every conversion) raises when the row is evaluated, "keep" leaves
    the field null and names it in an added ``problems`` array; ``split_dataset``
    parts the rows by it. ``with_warnings`` keeps the per-row ``warnings`` array.
    """
    if on_error not in ("null", "raise", "keep"):
        raise ContractError("on_error must be 'null', 'raise' or 'keep'")
    ds = dataset(name)
    known = ds.by_name
    sources = {f.name: f for f in ds.source_fields}
    control = {fetched_at, anchor, extra}
    given = [c for c in df.columns if c not in control and not c.endswith("__display")]
    clash = [c for c in given if c in known and c not in sources]
    if clash:
        raise ContractError(f"{name}: derived fields cannot be set: {', '.join(sorted(clash))}")
    for c in df.columns:
        base = c.removesuffix("__display")
        if c.endswith("__display") and not (base in known and known[base].raw):
            raise ContractError(f"{name}: {c} overrides no raw field")
    if "symbol" not in given:
        raise ContractError(f"{name}: missing required field symbol")
    types = dict(df.dtypes)
    anchor_col = F.col(anchor) if anchor else M.anchor_date(F.col(fetched_at))
    unknown = sorted(c for c in given if c not in known)

    # First projection: every display is converted once. The second one only
    # refers to the converted columns, so warnings cost no further parsing.
    first: dict[str, Column] = {}
    for f in ds.source_fields:
        if f.name not in given:
            continue
        source = F.col(f"`{f.name}`")
        if types[f.name] == f.struct_field().dataType.simpleString() and f.unit != "text":
            first[f"_missing_{f.name}"], first[f"_value_{f.name}"] = source.isNull(), source
            continue
        shown = source.cast("string")
        missing = shown.isNull() | N.is_null_display(shown, key_symbol=f.name == "symbol")
        first[f"_missing_{f.name}"] = missing
        if f.unit == "timestamp":
            first[f"_value_{f.name}"] = F.when(~missing, M.norm_ts_eastern(shown, anchor_col))
        else:
            first[f"_value_{f.name}"] = F.when(~missing, _SCALARS[f.unit](shown))
    df = df.withColumns(first)

    out: dict[str, Column] = {}
    notes: list[Column] = []
    faults: list[Column] = []
    for f in ds.source_fields:
        kind = f.struct_field().dataType.simpleString()
        override = f"{f.name}__display"
        shown_raw = F.col(override) if override in df.columns else None
        if f.name not in given:
            out[f.name] = F.lit(None).cast(kind)
            if not f.nullable:
                faults.append(F.lit(f"{f.name}: required value is null"))
            if f.raw:
                out[f"{f.name}_raw"] = (F.lit(None) if shown_raw is None else shown_raw).cast("string")
                if f.unit == "timestamp":
                    out[f"{f.name}_status"] = F.lit(None).cast("string")
            continue
        shown = F.col(f"`{f.name}`").cast("string")
        missing, value = F.col(f"_missing_{f.name}"), F.col(f"_value_{f.name}")
        status = None
        if f.unit == "timestamp" and types[f.name] != kind:
            value, status = value["instant"].cast("timestamp"), value["status"]
        failed = ~missing & value.isNull()
        ambiguous = F.lit(False) if status is None else F.coalesce(status == "ambiguous", F.lit(False))
        checked = value
        if f.unit != "text" and (on_error == "raise" or not f.raw):
            message = F.concat(F.lit(f"{f.name}: cannot convert "), shown)
            faults.append(F.when(failed, message))
            if on_error != "keep":
                checked = F.when(failed, F.raise_error(F.concat(F.lit(f"{name}."), message))).otherwise(checked)
        if not f.nullable:
            message = F.lit(f"{f.name}: required value is null")
            faults.append(F.when(missing, message))
            if on_error != "keep":
                checked = F.when(value.isNull(), F.raise_error(F.concat(F.lit(f"{name}."), message))).otherwise(checked)
        out[f.name] = checked
        if f.raw:
            out[f"{f.name}_raw"] = shown if shown_raw is None else shown_raw
            if f.unit == "timestamp":
                out[f"{f.name}_status"] = F.lit(None).cast("string") if status is None else status
        sentinel = missing & shown.isNotNull()
        notes.append(F.when(sentinel, _warning("null_sentinel", f.name, shown)))
        if f.unit != "text":
            notes.append(F.when(failed & ~ambiguous, _warning("conversion_failed", f.name, shown)))
            if f.unit == "timestamp":
                notes.append(F.when(ambiguous, _warning("ambiguous_time", f.name, shown)))

    bag = F.array(*[F.struct(F.lit(c).alias("key"), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias("value")) for c in unknown]).cast(
        "array<struct<key string, value string>>"
    )
    if extra:
        more = F.transform(
            F.coalesce(F.map_entries(F.col(extra)), F.array().cast("array<struct<key string, value string>>")),
            lambda e: F.struct(e["key"].alias("key"), F.coalesce(e["value"], F.lit("")).alias("value")),
        )
        # Of a key that stands in both places the first value in order counts.
        bag = let(
            F.array_sort(F.concat(bag, more)),
            lambda all_: F.filter(all_, lambda e, i: (i == 0) | (F.get(all_, i - 1)["key"] != e["key"])),
        )
    out["extra_fields"] = F.map_from_entries(bag)
    out["fetched_at"] = F.col(fetched_at).cast("timestamp")

    for f in ds.fields:
        if f.name not in out:
            raise ContractError(f"{name}: no expression for {f.name}")
    columns = [out[f.name].alias(f.name, metadata=f.struct_field().metadata) for f in ds.fields]
    if with_warnings:
        drift = F.transform(
            F.map_keys(out["extra_fields"]), lambda k: F.struct(F.lit("unknown_field").alias("code"), k.alias("field"), F.lit(None).cast("string").alias("raw"))
        )
        columns.append(F.concat(drift, F.array_compact(F.array(*notes))).alias(WARNINGS))
    if on_error == "keep":
        columns.append(F.array_compact(F.array(*faults).cast("array<string>")).alias("problems"))
    return df.select(*columns, *passed)


def split_dataset(df: DataFrame, name: str, **options) -> tuple[DataFrame, DataFrame]:
    """Rows of dataset ``name``, and the rows that do not fit it, as ``source`` JSON with their ``problems``.

    One bad cell costs its row, never the job; the two counts add up to the input's.
    """
    whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("source")
    built = build_dataset(df, name, on_error="keep", passed=(whole,), **options)
    good = built.where(F.size("problems") == 0).drop("problems", "source")
    return good, built.where(F.size("problems") > 0).select("source", "problems", "fetched_at")


def split_required(df: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Rows fit for ``build_dataset`` and the quarantined rest.

    A row is quarantined when a required source field is absent, null or a null
    display. Both sides read the same scan; neither shuffles.
    """
    gaps = required_gaps(df, name)
    flagged = df.withColumn("missing_fields", gaps)
    good = flagged.where(F.size("missing_fields") == 0).drop("missing_fields")
    return good, flagged.where(F.size("missing_fields") > 0)


def required_gaps(df: DataFrame, name: str) -> Column:
    """Names of the required fields a source row lacks."""
    checks = []
    for f in dataset(name).source_fields:
        if f.nullable:
            continue
        if f.name not in df.columns:
            checks.append(F.lit(f.name))
            continue
        shown = F.col(f.name).cast("string")
        absent = shown.isNull() | N.is_null_display(shown, key_symbol=f.name == "symbol")
        checks.append(F.when(absent, F.lit(f.name)))
    return F.array_compact(F.array(*checks).cast("array<string>"))


def extra_fields_split(df: DataFrame, bag: str, known: list[str]) -> DataFrame:
    """Known keys of a map column to columns, the rest name-sorted to ``extra_fields``."""
    entries = F.map_entries(F.map_filter(F.col(bag), lambda k, _: ~k.isin(*known)))
    filled = F.transform(
        F.array_sort(entries),
        lambda e: F.struct(e["key"].alias("key"), F.coalesce(e["value"], F.lit("")).alias("value")),
    )
    return df.select(
        *[c for c in df.columns if c != bag],
        *[F.try_element_at(F.col(bag), F.lit(k)).alias(k) for k in known],
        F.map_from_entries(filled).alias("extra_fields"),
    )


def provenance_cols(df: DataFrame, **facts: str | int | None) -> DataFrame:
    """Stamp constant provenance (query hash, versions, projected_from …) on rows."""
    return df.withColumns({name: F.lit(value) for name, value in facts.items()})
