"""Registered datasets: fixed, versioned schemas with units and provenance.

A dataset is an ordered list of fields. ``numeric``/``moment`` fields declared
with ``raw=True`` bring their lossless ``<name>_raw`` companion (and moments a
``<name>_status``); every dataset ends with ``extra_fields`` and ``fetched_at``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The unit fixes the type: each unit maps to exactly one Spark type.
UNIT_TYPES: dict[str, T.DataType] = {
    "text": T.StringType(),
    "raw": T.StringType(),
    "count": T.LongType(),
    "number": T.DoubleType(),
    "compact": T.DoubleType(),
    "percent": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "map": T.MapType(T.StringType(), T.StringType()),
}


class ContractError(ValueError):
    """A dataset or DataFrame breaks a schema contract."""


@dataclass(frozen=True)
class Field:
    name: str
    unit: str
    nullable: bool = True
    key: bool = False
    raw: bool = False

    def struct_field(self) -> T.StructField:
        meta = {"unit": self.unit, "key": self.key, "raw": self.raw}
        meta["temporal"] = self.unit in ("date", "timestamp")
        return T.StructField(self.name, UNIT_TYPES[self.unit], self.nullable, meta)


@dataclass(frozen=True)
class Dataset:
    name: str
    version: int
    fields: tuple[Field, ...]

    @property
    def by_name(self) -> dict[str, Field]:
        return {f.name: f for f in self.fields}

    @property
    def source_fields(self) -> tuple[Field, ...]:
        """Fields a source row may set; companions and provenance are derived."""
        derived = {"extra_fields", "fetched_at"}
        for f in self.fields:
            if f.raw:
                derived |= {f"{f.name}_raw", f"{f.name}_status"}
        return tuple(f for f in self.fields if f.name not in derived)

    def schema(self) -> T.StructType:
        return T.StructType([f.struct_field() for f in self.fields])


def key(name: str) -> list[Field]:
    return [Field(name, "text", nullable=False, key=True)]


def required(name: str, unit: str = "text") -> list[Field]:
    return [Field(name, unit, nullable=False)]


def plain(unit: str, *names: str) -> list[Field]:
    return [Field(n, unit) for n in names]


def text(*names: str) -> list[Field]:
    return plain("text", *names)


def raw(unit: str, *names: str) -> list[Field]:
    """Fields with a lossless display companion (moments also get a status)."""
    out: list[Field] = []
    for n in names:
        out += [Field(n, unit, raw=True), Field(f"{n}_raw", "raw")]
        if unit == "timestamp":
            out.append(Field(f"{n}_status", "text"))
    return out


def _dataset(name: str, *groups: list[Field], version: int = 1) -> Dataset:
    fields = [f for group in groups for f in group]
    fields += [Field("extra_fields", "map"), Field("fetched_at", "timestamp", nullable=False)]
    dataset = Dataset(name, version, tuple(fields))
    check_dataset(dataset)
    return dataset


def check_dataset(d: Dataset) -> None:
    """Registration invariants, checked once when the module loads."""
    names = [f.name for f in d.fields]
    known = d.by_name
    if len(set(names)) != len(names):
        raise ContractError(f"{d.name}: repeated field")
    if d.version < 1:
        raise ContractError(f"{d.name}: version must be positive")
    if "symbol" not in known or not known["symbol"].key:
        raise ContractError(f"{d.name}: needs the key field symbol")
    for f in d.fields:
        if f.unit not in UNIT_TYPES:
            raise ContractError(f"{d.name}.{f.name}: unknown unit {f.unit}")
        if f.key and f.nullable:
            raise ContractError(f"{d.name}.{f.name}: a key cannot be nullable")
        if f.raw and f"{f.name}_raw" not in known:
            raise ContractError(f"{d.name}.{f.name}: no raw companion")
        if f.unit == "raw":
            base = known.get(f.name.removesuffix("_raw"))
            if base is None or not base.raw or not base.nullable or base.unit == "text":
                raise ContractError(f"{d.name}.{f.name}: mirrors no raw field")
        if f.raw and f.unit == "timestamp" and f"{f.name}_status" not in known:
            raise ContractError(f"{d.name}.{f.name}: no status companion")
    if not (known.get("extra_fields") and known["extra_fields"].unit == "map"):
        raise ContractError(f"{d.name}: needs extra_fields")
    if not (known.get("fetched_at") and not known["fetched_at"].nullable):
        raise ContractError(f"{d.name}: needs a non-null fetched_at")


def _release_fields() -> list[list[Field]]:
    return [
        key("symbol"),
        required("event"),
        text("category"),
        raw("date", "release_date"),
        text("release_time"),
        raw("timestamp", "release_timestamp"),
        plain("count", "importance"),
        text("reference_period"),
        raw("date", "reference_date"),
        raw("compact", "actual", "forecast", "previous"),
    ]


# Dataset names, versions, field order and units.
DATASETS: dict[str, Dataset] = {
    d.name: d
    for d in (
        _dataset("symbol_universe", key("symbol")),
        _dataset(
            "symbol_search",
            key("symbol"),
            text("company", "exchange"),
            raw("compact", "market_cap"),
            raw("percent", "div_yield"),
        ),
        _dataset(
            "statements",
            key("symbol"),
            required("statement_kind"),
            required("periodicity"),
            required("period_label"),
            plain("date", "period_end_date"),
            plain("count", "period_length_days"),
            required("metric"),
            raw("number", "value"),
            text("currency"),
        ),
        _dataset(
            "quote_snapshot",
            key("symbol"),
            text("company", "exchange", "sector", "industry", "country", "index_membership"),
            raw("number", "price", "change"),
            raw("percent", "change_percent"),
            raw("compact", "market_cap"),
            raw("number", "pe_ratio", "eps_ttm"),
            raw("percent", "dividend_yield"),
            raw("count", "volume", "average_volume"),
            raw("compact", "shares_outstanding", "float_shares"),
            raw("number", "beta"),
            raw("percent", "sma20_percent", "sma50_percent", "sma200_percent"),
            raw("number", "week52_high", "week52_low"),
            raw("date", "ex_dividend_date"),
            text("earnings_date"),
            raw("count", "employees"),
            raw("date", "ipo_date"),
        ),
        _dataset("quote_description", key("symbol"), text("description")),
        _dataset(
            "quote_ratings",
            key("symbol"),
            raw("timestamp", "published_at"),
            text("status"),
            raw("number", "rating"),
            text("analyst"),
            raw("number", "price_target"),
        ),
        _dataset(
            "quote_news",
            key("symbol"),
            raw("timestamp", "published_at"),
            required("title"),
            required("url"),
            text("publisher"),
        ),
        _dataset(
            "quote_insider",
            key("symbol"),
            text("owner", "relationship"),
            plain("date", "transaction_date"),
            text("transaction_type"),
            raw("number", "cost"),
            raw("compact", "shares", "value", "shares_total"),
            text("sec_form_url"),
        ),
        _dataset(
            "quote_peers",
            key("symbol"),
            key("peer"),
            plain("count", "rank"),
            raw("compact", "market_cap"),
        ),
        _dataset(
            "quote_etf_holders",
            key("symbol"),
            key("etf"),
            plain("count", "rank"),
            raw("percent", "weight_percent"),
            raw("compact", "aum"),
            version=2,
        ),
        _dataset("quote_signals", key("symbol"), required("signal"), text("url")),
        _dataset(
            "earnings_screen",
            required("rank", "count"),
            key("symbol"),
            raw("date", "earnings_date"),
            text("earnings_session"),
        ),
        _dataset("economic_calendar", *_release_fields()),
        _dataset("economic_details", *_release_fields()),
        _dataset(
            "futures_tiles",
            key("symbol"),
            text("name", "category"),
            raw("number", "last"),
            raw("percent", "change_percent"),
            raw("number", "change_usd", "prev_close", "high", "low"),
            text("sparkline", "sparkline_date_changes"),
            plain("number", "delay_minutes"),
        ),
    )
}


def dataset(name: str) -> Dataset:
    if name not in DATASETS:
        raise ContractError(f"unknown dataset {name!r}")
    return DATASETS[name]


def dataset_names() -> tuple[str, ...]:
    return tuple(DATASETS)


def dataset_field_names(name: str) -> tuple[str, ...]:
    return tuple(f.name for f in dataset(name).fields)


def empty_typed(spark: SparkSession, name: str) -> DataFrame:
    """A dataset with no rows and its full registered schema."""
    return spark.createDataFrame([], dataset(name).schema())


def dq_contract(df: DataFrame, name: str) -> list[str]:
    """Differences between a DataFrame's schema and the registered one.

    Order, names and types are compared; nullability of computed columns is a
    property of the data, see ``dq_contract_nulls``.
    """
    want = [(f.name, f.dataType.simpleString()) for f in dataset(name).schema()]
    have = [(f.name, f.dataType.simpleString()) for f in df.schema]
    problems = [f"missing {n}: {t}" for n, t in want if (n, t) not in have]
    problems += [f"unexpected {n}: {t}" for n, t in have if (n, t) not in want]
    if not problems and want != have:
        problems.append("columns out of order")
    return problems


def dq_contract_nulls(df: DataFrame, name: str) -> DataFrame:
    """One row: how many nulls each non-nullable field holds (all must be 0)."""
    strict = [f.name for f in dataset(name).fields if not f.nullable]
    return df.agg(*[F.count_if(F.col(n).isNull()).alias(n) for n in strict])
