"""The public operations: each one composes operators over tables the user owns.

Captures operations take a captures DataFrame (``capture_id, body, fetched_at`` …)
and return DataFrames in registered schemas; snapshot operations take a snapshot
DataFrame with typed columns. Nothing is collected on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import temporal as M
from ..functions import text as X
from ..operators import grouping as G
from ..operators import quality as Q
from ..operators import relations as L
from ..operators import screening as S
from ..operators.dataset import build_dataset, provenance_cols, split_dataset
from ..operators.ranking import dedupe_first, order_keys, rank_limited, walk_limits
from ..schemas import dataset
from . import families as P
from . import registry as R
from .query import Filter, GroupQuery, Order, ScreenQuery

PARSER_VERSION = "1"


@dataclass(frozen=True)
class Result:
    """A result table with its one-row run metadata, both lazy."""

    data: DataFrame
    metadata: DataFrame


def _documents(captures: DataFrame, **reads) -> DataFrame:
    """Parsed captures; those that hold ``nodes`` are parsed already and stay as they are."""
    return captures if "nodes" in captures.columns else P.documents(captures, carry=("fetched_at",), **reads)


# ---------------------------------------------------------------- screens


def screen_rows(snapshot: DataFrame, query: ScreenQuery, as_of: Column | None = None) -> DataFrame:
    """Every row of a screen: the whole result, unranked and unlimited."""
    tests = [S.filter_predicate(f.name, f.option, as_of) for f in query.filters]
    rows = snapshot.where(S.filter_conjunction(tests))
    if query.signal:
        rows = S.signal_rows(rows, query.signal)
    return S.filter_ticker(rows, query.ticker) if query.ticker else rows


def _keys(query: ScreenQuery) -> list[Column]:
    if query.order:
        return order_keys(R.ORDERS[query.order.name], query.order.descending)
    if query.signal:
        spec = R.SIGNALS[query.signal]
        return order_keys(spec.order, spec.descending)
    return order_keys("symbol")


def _viewed(rows: DataFrame, query: ScreenQuery) -> DataFrame:
    if query.view == "custom":
        return S.view_custom(rows, query.columns)
    return S.view_ticker(rows) if query.view == "ticker" else S.view_fixed(rows, query.view)


def screen(
    snapshot: DataFrame,
    query: ScreenQuery,
    *,
    as_of: Column | None = None,
    max_pages: int | None = None,
    max_rows: int | None = None,
) -> Result:
    """Filters, order, page walk (to the end, or to the stops given), absolute rank, view."""
    rows = screen_rows(snapshot, query, as_of)
    walked, facts = walk_limits(rows, _keys(query), max_pages=max_pages, max_rows=max_rows, first_page=query.page)
    meta = provenance_cols(facts, query=query.to_json(), query_hash=query.hash(), parser_version=PARSER_VERSION)
    return Result(_viewed(walked, query), meta)


def screen_page(snapshot: DataFrame, query: ScreenQuery, as_of: Column | None = None) -> DataFrame:
    """One page of a screen, stamped with the query's identity."""
    rows = screen_rows(snapshot, query, as_of)
    ranked = rank_limited(rows, _keys(query), R.PAGE_SIZE, (query.page - 1) * R.PAGE_SIZE)
    return provenance_cols(_viewed(ranked, query), query_hash=query.hash(), schema_version=1)


def signal(snapshot: DataFrame, name: str, **stops) -> Result:
    """A named signal in the fixed six-column projection."""
    spec = R.SIGNALS.get(name)
    rows = S.signal_rows(snapshot, name)
    walked, facts = walk_limits(rows, order_keys(spec.order, spec.descending), **stops)
    return Result(S.signal_columns(walked), facts)


def earnings(
    snapshot: DataFrame,
    *,
    as_of: Column,
    when: str | None = None,
    session: str | None = None,
    names: str | tuple[str, ...] | list[str] | None = None,
    filters: Filter | tuple[Filter, ...] | list[Filter] = (),
    order: Order | None = None,
    max_pages: int | None = None,
    max_rows: int | None = None,
) -> Result:
    """An earnings screen over a snapshot whose ``earnings`` column is a display."""
    if when is None and session is None and names is None:
        raise R.QueryError("earnings screens need a when window or explicit names")
    if when is None and session is not None:
        raise R.QueryError("earnings session requires a when window")
    typed = snapshot.withColumns(
        {
            "earnings_date": M.norm_date_earnings(F.col("earnings"), as_of),
            "earnings_session": M.norm_session(F.col("earnings")),
        }
    )
    chosen = (filters,) if isinstance(filters, Filter) else tuple(filters)
    tests = [S.filter_predicate(f.name, f.option, as_of) for f in chosen]
    if when is not None:
        tests.append(S.earnings_window(when, as_of, session=session))
    rows = typed.where(S.filter_conjunction(tests))
    if names is not None:
        one = [names] if isinstance(names, str) else list(names)
        if len(one) != 1:
            raise R.QueryError("earnings queries take one ticker")
        rows = S.filter_ticker(rows, one[0])
    keys = order_keys(R.ORDERS[order.name], order.descending) if order else order_keys("symbol")
    walked, facts = walk_limits(rows, keys, max_pages=max_pages, max_rows=max_rows)
    table = S.earnings_project(
        walked.select("rank", "symbol", "earnings", *[c for c in ("fetched_at", "extra_fields") if c in walked.columns]),
        as_of,
    )
    return Result(table, provenance_cols(facts, projected_from="screener"))


def group(snapshot: DataFrame, query: GroupQuery) -> DataFrame:
    """Group aggregates, ordered, in a view, stamped with the query's identity."""
    grouped = G.group_aggregate(snapshot, query.dimension, query.sector)
    viewed = G.group_views(G.order_group(grouped, query.order, query.descending), query.view, query.columns)
    return provenance_cols(viewed, query_hash=query.hash(), schema_version=1)


def screen_captures(captures: DataFrame, labels: list[str]) -> tuple[DataFrame, DataFrame]:
    """Captured screener pages, table or JSON form, to typed rows and quarantine."""
    docs = _documents(captures)
    rows = P.x_screener_table(docs).unionByName(P.x_screener_json(docs))
    return P.screener_table(rows, labels), rows.where(~F.col("row_ok"))


def group_captures(captures: DataFrame, labels: list[str]) -> DataFrame:
    return P.groups_table(P.x_groups_table(_documents(captures)), labels)


def spectrum(captures: DataFrame, dimension: str) -> DataFrame:
    """Spectrum image descriptors; no image is ever fetched."""
    return P.x_spectrum_ref(_documents(captures), R.GROUP_DIMENSIONS[dimension])


# ---------------------------------------------------------------- symbols


def symbols(captures: DataFrame, host: str) -> tuple[DataFrame, DataFrame]:
    """The symbol universe in first-seen order, and the URLs that name no symbol."""
    rows, unexpected = P.x_universe(captures.select("capture_id", "fetched_at", "body"), host)
    unique = dedupe_first(rows, ["symbol"], ["fetched_at", "capture_id", "position"])
    return build_dataset(unique.select("symbol", "fetched_at"), "symbol_universe"), unexpected


def search_symbols(universe: DataFrame, query: str) -> DataFrame:
    return S.symbol_search(universe, query)


def suggestions(captures: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Captured suggestion bodies to ``symbol_search`` rows and malformed records."""
    rows = P.x_suggestions(captures.select("capture_id", "fetched_at", "body"))
    good = rows.where("row_ok").select("symbol", "company", "exchange", "extra", "fetched_at")
    return build_dataset(good, "symbol_search", extra="extra"), rows.where(~F.col("row_ok"))


# ---------------------------------------------------------------- statements


def statements(captures: DataFrame) -> DataFrame:
    """Captured statement bodies to the long ``statements`` dataset.

    Needs ``symbol`` and ``statement`` (a code such as ``IA``) on each capture.
    """
    return statement_rows(statement_documents(captures))


def statement_documents(captures: DataFrame) -> DataFrame:
    return P.x_statement(captures.select("symbol", "statement", "fetched_at", "body"))


def _side(rows: DataFrame, name: str, quarantine: bool, **options) -> DataFrame:
    """The rows of a dataset, or with ``quarantine`` those that do not fit it."""
    return split_dataset(rows, name, **options)[int(quarantine)]


def statement_rows(parsed: DataFrame, quarantine: bool = False) -> DataFrame:
    code = L.stmt_codes(F.col("statement"))
    usable = parsed.where(F.col("problem").isNull() & code.isNotNull()).withColumns(
        {
            "statement_kind": code["kind"],
            "periodicity": code["periodicity"],
            "end_dates": F.transform("ends", M.norm_date_us),
        }
    )
    long = L.stmt_long(
        usable, ["symbol", "statement_kind", "periodicity", "currency", "fetched_at"], "periods", "end_dates", "metrics"
    )
    return _side(long.drop("metric_no", "position"), "statements", quarantine)


def statements_batch(captures: DataFrame, requests: DataFrame, statement: str) -> dict[str, DataFrame]:
    """Statements for requested symbols, with failures and status as rows.

    ``requests`` holds ``position, requested``. Of several captures of a symbol the
    latest counts (of equal times the one with the largest digest). A refused, missing or invalid
    request is a row of ``unit_errors``; the status is an aggregate over the
    requested units: one per symbol, and one per spelling that is none.
    """
    L.statement_code(statement)
    resolved = L.sym_resolve(requests)
    valid = F.col("canonical").isNotNull()
    wanted = dedupe_first(
        resolved.where(valid).select(F.col("canonical").alias("symbol"), "position"), ["symbol"], ["position"]
    )
    latest = latest_captures(captures.where(F.col("statement") == statement), ["symbol", "statement"])
    parsed = statement_documents(latest.join(wanted.select("symbol"), "symbol", "left_semi"))
    found = wanted.join(parsed.select("symbol", "problem", "fetched_at"), "symbol", "left").withColumn(
        "problem", F.when(F.col("fetched_at").isNull(), F.lit("no capture")).otherwise(F.col("problem"))
    )
    invalid = resolved.where(~valid).select(
        F.col("requested").alias("symbol"),
        "position",
        F.lit("invalid symbol").alias("problem"),
        F.lit(None).cast("timestamp").alias("fetched_at"),
    )
    outcome = found.unionByName(invalid).withColumns({"cache_hit": F.lit(False), "attempts": F.lit(1)})
    outcome = outcome.withColumn("ok", F.col("problem").isNull() | (F.col("problem") == "no data"))
    return {
        "data": statement_rows(parsed),
        "resolution": resolved,
        "unit_errors": Q.unit_errors(outcome, "unit_failed"),
        "metadata": Q.status_fold(outcome, []),
    }


def latest_captures(captures: DataFrame, key: list[str]) -> DataFrame:
    """One capture per key: the latest, of equal times that with the largest digest."""
    rest = [c for c in captures.columns if c not in key]
    newest = F.max_by(F.struct(*rest), F.struct("fetched_at", F.sha2("body", 256)))
    return captures.groupBy(*key).agg(newest.alias("_newest")).select(*key, *[F.col(f"_newest.{c}").alias(c) for c in rest])


# ---------------------------------------------------------------- quotes


def quote(captures: DataFrame) -> dict[str, DataFrame]:
    """All relations of captured stock pages in registered schemas.

    The parse is persisted once and shared by the relations; unpersist
    ``documents`` when done.
    """
    docs = _documents(captures).persist()
    raw = P.bundle_fanout(docs)
    snapshot, bad = split_dataset(raw["snapshot"], "quote_snapshot", extra="extra", with_warnings=True)
    out = {
        "snapshot": snapshot,
        "snapshot_quarantine": bad,
        "charts": raw["charts"],
        "snapshot_tables": raw["snapshot_tables"],
        "regions": raw["regions"],
        "documents": docs,
    }
    for name in ("description", "ratings", "news", "insider", "peers", "etf_holders", "signals"):
        out[name], out[f"{name}_quarantine"] = split_dataset(raw[name], f"quote_{name}")
    return out


def quote_projection(bundle: dict[str, DataFrame], region: str, requests: DataFrame) -> DataFrame:
    """One relation for requested symbols; join ``requests`` again for their order.

    Joined by merge: the size of a parsed relation is estimated from the captures' files, which
    may hold far less than is parsed of them, so its estimate must not get it broadcast.
    """
    resolved = L.sym_resolve(requests).where(F.col("canonical").isNotNull())
    wanted = dedupe_first(
        resolved.select(F.col("canonical").alias("symbol"), "position"), ["symbol"], ["position"]
    )
    rows = bundle[region].join(wanted.hint("merge"), "symbol").drop("position")
    return provenance_cols(rows, projected_from="quote")


# ---------------------------------------------------------------- maps, markets, futures


def map_(pages: DataFrame, assets: DataFrame) -> dict[str, DataFrame]:
    """Map pages and hierarchy assets (one of each) to the map bundle."""
    perf = P.x_map_perf(pages.select("body"))
    return L.map_bundle(P.x_hierarchy(assets.select("body")), perf)


def market_performance(captures: DataFrame, identity: str, labels: list[str]) -> DataFrame:
    """Forex (``Pair``) or crypto (``Ticker``) performance tables."""
    return P.perf_table(P.x_market_table(_documents(captures)), identity, labels)


def market_tiles(captures: DataFrame, anchor: str) -> tuple[DataFrame, DataFrame]:
    """Market tiles and the malformed ones."""
    rows = P.x_tiles(captures.select("capture_id", "fetched_at", "body"), anchor)
    return rows.where("tile_ok"), rows.where(~F.col("tile_ok"))


def market_chart(captures: DataFrame, symbol: str, timeframe: str) -> DataFrame:
    """The chart descriptor of one symbol on gallery pages."""
    if timeframe not in X.MARKET_TIMEFRAMES:
        raise R.QueryError(f"timeframe must be one of {sorted(X.MARKET_TIMEFRAMES)}")
    rows = P.x_gallery_charts(_documents(captures)).where(F.col("symbol") == symbol.upper())
    return provenance_cols(rows, timeframe=timeframe, kind="chart")


def futures(captures: DataFrame, quarantine: bool = False) -> DataFrame:
    """Futures tiles with their category in the ``futures_tiles`` schema."""
    tiles, listed = P.x_futures(captures.select("capture_id", "fetched_at", "body"))
    joined = L.futures_category(tiles, listed.drop("fetched_at"))
    return _side(joined.drop("capture_id"), "futures_tiles", quarantine, extra="extra")


def chart_descriptor(df: DataFrame, origin: str, timeframe: str = "d") -> DataFrame:
    """Chart descriptors for a column of symbols; pure construction."""
    code = X.timeframe_code(F.lit(timeframe))
    return df.select(
        X.url_chart(F.col("symbol"), F.lit(timeframe), origin).alias("source_url"),
        F.lit("chart").alias("kind"),
        F.lit("image/png").alias("media_type"),
        X.sym_canonical(F.col("symbol")).alias("symbol"),
        code.alias("timeframe"),
        F.lit("candle_stick").alias("chart_type"),
    )


# ---------------------------------------------------------------- events


def _news(rows: DataFrame, origin: str) -> DataFrame:
    anchor = M.anchor_date(F.col("fetched_at"))
    when = F.col("published_at_raw")
    lead = [c for c in ("category",) if c in rows.columns]
    return rows.where(F.col("published_at_status").isNotNull()).select(
        *lead,
        "title",
        X.url_absolute(F.col("url"), origin).alias("url"),
        "publisher",
        M.norm_ts_relative(when, F.col("fetched_at"), anchor).cast("timestamp").alias("published_at"),
        "published_at_raw",
        "published_at_status",
        "fetched_at",
    )


def page_errors(captures: DataFrame, family: str) -> DataFrame:
    """Documents and rows that a page family refuses, each with its ``problem``.

    Together with the family's own rows they are all rows of the pages; see ``families.page_errors``.
    """
    docs = _documents(captures)
    regions = ("ratings", "stock_news", "stock_insider")
    return P.page_errors(P.quote_documents(docs).where(F.col("symbol").isNotNull()) if family in regions else docs, family)


def global_news(captures: DataFrame, origin: str) -> DataFrame:
    return _news(P.x_global_news(_documents(captures)), origin)


def publisher_news(captures: DataFrame, slug: str, origin: str) -> DataFrame:
    return _news(P.x_publisher_news(_documents(captures), F.lit(slug)), origin)


def global_insider(captures: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Insider transactions in ``quote_insider``, and the ticker-less rows.

    Rows that do not fit the dataset: ``insider_quarantine``.
    """
    rows, skipped = P.x_global_insider(_documents(captures, **P.INSIDER_READS))
    return _side(rows.drop("capture_id", "row_no"), "quote_insider", False), skipped


def insider_quarantine(captures: DataFrame) -> DataFrame:
    rows, _ = P.x_global_insider(_documents(captures, **P.INSIDER_READS))
    return _side(rows.drop("capture_id", "row_no"), "quote_insider", True)


def disclosure(captures: DataFrame, kind: str) -> DataFrame:
    """Fund or manager portfolios: JSON kept verbatim plus report dates."""
    return P.x_disclosure(_documents(captures), kind)


def calendar(captures: DataFrame, name: str = "economic_calendar", quarantine: bool = False) -> DataFrame:
    """Calendar entries, or with ``quarantine`` the entries that break the dataset's contract."""
    rows = P.x_calendar(captures.select("fetched_at", "body"))
    return _side(rows.drop("position"), name, quarantine)


def calendar_detail(captures: DataFrame, quarantine: bool = False) -> DataFrame:
    rows = P.x_calendar_detail(captures.select("fetched_at", "body"))
    return _side(rows.drop("position"), "economic_details", quarantine)


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], dataset(name).schema())
