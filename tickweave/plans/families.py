"""Page families: relational plans over documents and JSON bodies.

Every plan here is a projection, filter or explode of a document row. None of
them shuffles; all of them leave displays as text for ``build_dataset``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numeric as N
from ..functions import temporal as M
from ..functions import text as X
from ..functions.nested import array_rows, let, map_rows, once, struct_rows
from ..sources.embedded import after, json_between, x_js_literal
from ..sources.html import first_text, has_class, html_documents, nodes_of, within
from . import registry as R

# Classes and ids that mark the regions of the page families.
CLASSES = (
    "quote-header", "quote-header_ticker-wrapper_company", "quote-header_category",
    "quote_profile-bio", "snapshot-td2", "news-link-right", "news_date-cell", "news_link-cell",
    "news-calendar_heading", "js-quote-correlation-links-container",
)
IDS = ("screener-total",)
OPTIONAL_REGIONS = (
    "description", "ratings", "news", "insider", "peers", "etf_holders", "signals",
)


def documents(df: DataFrame, key: str = "capture_id", **options) -> DataFrame:
    """Parsed bodies with every node the page families look at."""
    return html_documents(df, key, classes=CLASSES, ids=IDS, **options)


# The table that a region of a stock page stands in, and the node fields its plan reads.
REGION_TABLES = {"ratings": "js-table-ratings", "news": "news-table", "insider": "body-table"}
REGION_FIELDS = ("pos", "tag", "classes", "last", "attrs", "text", "href", "table_id", "table_classes", "row_no", "cells", "heads", "items")


def region_reads(region: str) -> dict[str, tuple[str, ...]]:
    """Options of ``documents`` for a plan that reads the page's header and one region."""
    return {"tables": (REGION_TABLES[region],), "fields": REGION_FIELDS}


# Options of ``documents`` for plans that read stock pages: every region, none of their table cells one by one.
QUOTE_READS = {
    "rows": tuple(REGION_TABLES.values()),
    "fields": (
        "pos", "tag", "id", "classes", "parent", "last", "parent_last", "table_no", "table_id", "table_classes",
        "row_no", "text", "href", "attrs", "heads", "cells", "items",
    ),
}
# Options for plans that read the tables of groups or markets, news tables, spectra, or portfolios only.
GROUP_READS = {"rows": ("groups_table",), "fields": ("tag", "table_no", "table_id", "table_classes", "row_no", "heads", "cells")}
NEWS_READS = {
    "rows": ("table-fixed",),
    "fields": ("tag", "classes", "table_no", "table_id", "table_classes", "row_no", "text", "cells", "items"),
}
SPECTRUM_READS = {"rows": (), "fields": ("tag", "classes", "href")}
DISCLOSURE_READS = {"rows": (), "fields": ("tag", "text")}
# The columns nodes stand in: all of them in ``nodes`` or, after ``quote_parts``, rows and snapshot cells apart.
NODE_COLUMNS = ("nodes", "row_nodes", "cell_nodes")


# ---------------------------------------------------------------- shared pieces


def keys_of(docs: DataFrame) -> list[str]:
    return [c for c in docs.columns if c not in NODE_COLUMNS]


def _held(docs: DataFrame, part: str) -> Column:
    """The array to look for ``part``, a column of ``quote_parts``, in."""
    return F.col(part if part in docs.columns else "nodes")


def cell(label: str) -> Column:
    """The display under header ``label`` of a row node; null without that header."""
    at = F.nullif(F.array_position("heads", label), F.lit(0))
    return F.get(F.col("cells"), (at - 1).cast("int"))


def item(test) -> Column:
    """The first inner element of a row node passing ``test``."""
    return F.get(F.filter("items", test), F.lit(0))


def column_of(label: str) -> Column:
    return F.array_position("heads", label) - 1


def table_rows(docs: DataFrame, css: str | None = None, table_id: str | None = None) -> DataFrame:
    """Data rows of the tables with a class or id: one row per ``tr`` with cells."""

    def is_row(n: Column) -> Column:
        test = (n["tag"] == "tr") & (F.size(n["cells"]) > 0)
        if css:
            test &= has_class(n["table_classes"], css)
        return test & (n["table_id"] == table_id) if table_id else test

    return struct_rows(docs, keys_of(docs), F.filter(_held(docs, "row_nodes"), is_row))


def dq_arity(rows: DataFrame) -> DataFrame:
    """Rows whose cell count differs from their table's header count."""
    keys = [c for c in rows.columns if c in ("capture_id", "page_id")]
    return rows.where(F.size("cells") != F.size("heads")).select(
        *keys, "table_no", "row_no", F.size("cells").alias("n_cells"), F.size("heads").alias("n_heads")
    )


def dq_header(docs: DataFrame, css: str, required: list[str]) -> DataFrame:
    """Required header labels a family's table lacks, per document."""
    heads = F.get(
        F.filter(
            "nodes", lambda n: (n["tag"] == "tr") & has_class(n["table_classes"], css)
        ),
        F.lit(0),
    )["heads"]
    want = F.array(*[F.lit(r) for r in required])
    found = F.coalesce(heads, F.array().cast("array<string>"))
    return docs.select(*keys_of(docs), F.array_except(want, found).alias("missing_headers"))


def is_rank(c: Column) -> Column:
    return c.rlike(r"\A[0-9]+\z")


def page_facts(marker: Column) -> Column:
    """``#start / total Total`` to ``struct<page_start, total_rows>``."""
    pattern = r"#([0-9]+)\s*/\s*([0-9,]+)\s*Total"
    start, total = (F.nullif(F.regexp_extract(marker, pattern, i), F.lit("")) for i in (1, 2))
    return F.struct(
        start.try_cast("bigint").alias("page_start"), N.norm_int(total).alias("total_rows")
    )


def is_final_page(n_rows: Column, start: Column, total: Column, page_size: int = R.PAGE_SIZE) -> Column:
    """A page is final when it is short or the next one would start past the total."""
    return (n_rows < page_size) | F.coalesce(start + page_size > total, F.lit(False))


# ---------------------------------------------------------------- screens and groups


def x_screener_table(docs: DataFrame) -> DataFrame:
    """Screen rows: rank, symbol, header labels, displays and the page's facts.

    ``row_ok`` is false for rows whose rank is no number or whose cell count
    differs from the header: they are kept for quarantine, never dropped here.
    """
    marker = page_facts(first_text(F.col("nodes"), lambda n: n["id"] == "screener-total"))
    rows = table_rows(docs.withColumn("facts", marker), "screener_table")
    ticker = item(lambda i: (i["col_no"] == 1) & (i["tag"] == "td"))["attrs"]
    anchor = item(lambda i: (i["col_no"] == 1) & (i["tag"] == "a"))["text"]
    symbol = F.coalesce(
        F.nullif(F.try_element_at(ticker, F.lit("data-boxover-ticker")), F.lit("")),
        anchor,
        F.get("cells", F.lit(1)),
    )
    return rows.select(
        *keys_of(docs),
        F.get("cells", F.lit(0)).try_cast("bigint").alias("rank"),
        F.upper(X.strip_space(symbol)).alias("symbol"),
        "heads",
        "cells",
        "facts.page_start",
        "facts.total_rows",
        (is_rank(F.get("cells", F.lit(0))) & (F.size("cells") == F.size("heads"))).alias("row_ok"),
    )


def screener_is_empty(docs: DataFrame) -> DataFrame:
    """Documents with the positively recognised no-results table."""
    empty = F.exists("nodes", lambda n: (n["tag"] == "table") & (n["id"] == "js-screener-body-empty"))
    return docs.select(*keys_of(docs), F.coalesce(empty, F.lit(False)).alias("is_empty"))


def header_table(rows: DataFrame, labels: list[str], family: str, skip: tuple[str, ...], raw: bool) -> DataFrame:
    """Header-driven rows to typed columns, ``_raw`` companions where asked."""
    names = {label: X.label_to_field(label) for label in labels if label not in skip}
    rest = [c for c in rows.columns if c not in ("heads", "cells", "row_ok")]
    # Look every cell up once, then convert.
    shown = rows.select(*rest, *[cell(label).alias(f"{name}_raw") for label, name in names.items()])
    columns = []
    for label, name in names.items():
        display = F.col(f"{name}_raw")
        columns.append(R.typed_cell(label, display, family).alias(name))
        if raw and R.unit_of(label, family) != "text":
            columns.append(display)
    return shown.select(*rest, *columns)


def screener_table(rows: DataFrame, labels: list[str]) -> DataFrame:
    """Accepted screen rows with one typed column per header label."""
    return header_table(rows.where("row_ok"), labels, "screen", ("No.", "Ticker"), raw=False)


def _numbered(*identity: str) -> Column:
    """Whether a row's table counts its rows and then names them by one of ``identity``."""
    return F.coalesce((F.get("heads", F.lit(0)) == "No.") & F.get("heads", F.lit(1)).isin(*identity), F.lit(False))


def x_groups_table(docs: DataFrame) -> DataFrame:
    """Group rows: the provider's index, the name, labels and displays."""
    return table_rows(docs, "groups_table").where(_numbered("Name")).select(
        *keys_of(docs),
        F.get("cells", F.lit(0)).try_cast("bigint").alias("rank"),
        F.get("cells", F.lit(1)).alias("name"),
        "heads",
        "cells",
        (is_rank(F.get("cells", F.lit(0))) & (F.size("cells") == F.size("heads"))).alias("row_ok"),
    )


def groups_table(rows: DataFrame, labels: list[str]) -> DataFrame:
    return header_table(rows.where("row_ok"), labels, "group", ("No.", "Name"), raw=True)


def x_market_table(docs: DataFrame) -> DataFrame:
    """Market performance rows; the identity column is ``Pair`` or ``Ticker``."""
    return table_rows(docs, "groups_table").where(_numbered("Pair", "Ticker")).select(
        *keys_of(docs),
        F.get("cells", F.lit(0)).try_cast("bigint").alias("rank"),
        F.get("cells", F.lit(1)).alias("identity"),
        cell("Name").alias("name"),
        "heads",
        "cells",
        (is_rank(F.get("cells", F.lit(0))) & (F.size("cells") == F.size("heads"))).alias("row_ok"),
    )


def perf_table(rows: DataFrame, identity: str, labels: list[str]) -> DataFrame:
    """Typed performance columns in header order, then every raw display."""
    unknown = [x for x in labels if x not in R.MARKET_FIELDS and x not in ("No.", identity, "Name")]
    if unknown:
        raise R.QueryError(f"unexpected performance column {unknown[0]!r}")
    known = [x for x in labels if x in R.MARKET_FIELDS]
    names = ["name"] if "Name" in labels else []
    rest = [c for c in rows.columns if c not in ("rank", "identity", "name", "heads", "cells", "row_ok")]
    raws = {x: f"{R.MARKET_FIELDS[x]}_raw" for x in known}
    shown = rows.where("row_ok").select(
        "rank", F.col("identity").alias(identity.lower()), *names, *rest, *[cell(x).alias(r) for x, r in raws.items()]
    )
    return shown.select(
        "rank",
        identity.lower(),
        *names,
        *[R.typed_cell(x, F.col(raws[x]), "market").alias(R.MARKET_FIELDS[x]) for x in known],
        *raws.values(),
        *rest,
    )


def _spectra() -> Column:
    return F.filter("nodes", lambda n: (n["tag"] == "img") & has_class(n["classes"], "groups_spectrum-image"))


def x_spectrum_ref(docs: DataFrame, dimension: str = "sector") -> DataFrame:
    """The one spectrum image of a group page; pages with another count drop out."""
    images = _spectra()
    src = F.trim(F.get(images, F.lit(0))["href"])
    url = F.when(src.startswith("//"), F.concat(F.lit("https:"), src)).otherwise(src)
    return docs.where(F.size(images) == 1).select(
        *keys_of(docs),
        url.alias("source_url"),
        F.lit("image").alias("kind"),
        X.media_type(url).alias("media_type"),
        F.lit(dimension).alias("group"),
        F.lit("spectrum").alias("chart_type"),
    )


def x_chart_refs(docs: DataFrame) -> DataFrame:
    """Chart images with the timeframe their URL names (``d`` when it names none)."""
    frame = F.nullif(F.regexp_extract("href", r"[?&]p=([a-z]+)", 1), F.lit(""))
    return (
        nodes_of(docs, *keys_of(docs), test=lambda n: (n["tag"] == "img") & n["href"].contains("chart.ashx"))
        .select(
            *keys_of(docs),
            "pos",
            F.col("href").alias("source_url"),
            F.lit("chart").alias("kind"),
            F.lit("image/png").alias("media_type"),
            F.coalesce(frame, F.lit("d")).alias("timeframe"),
        )
    )


def x_gallery_charts(docs: DataFrame) -> DataFrame:
    """Gallery charts: the first ``srcset`` entry and the symbol after ``t=@``."""
    attrs = F.col("attrs")
    srcset = F.try_element_at(attrs, F.lit("srcset"))
    first = F.regexp_extract(srcset, r"\A\s*([^\s,]+)", 1)
    url = F.coalesce(F.nullif(first, F.lit("")), F.col("href"))
    symbol = F.upper(F.regexp_extract(url, r"(?i)[?&]t=@([a-z0-9]+)", 1))
    return (
        nodes_of(docs, test=lambda n: (n["tag"] == "img") & has_class(n["classes"], "charts-gal"))
        .select(*keys_of(docs), symbol.alias("symbol"), url.alias("source_url"), X.media_type(url).alias("media_type"))
        .where(F.col("symbol") != "")
    )


# ---------------------------------------------------------------- quote pages


def quote_documents(docs: DataFrame) -> DataFrame:
    """Documents with the header's identity columns, ``symbol`` first of all; those of ``quote_parts`` have them."""
    if "row_nodes" in docs.columns:
        return docs
    header = F.get(F.filter("nodes", lambda n: has_class(n["classes"], "quote-header")), F.lit(0))
    inside = let(header, lambda h: F.filter("nodes", lambda n: F.coalesce(within(n, h), F.lit(False))))
    ticker = F.get(F.filter("_inside", lambda n: n["attrs"]["data-ticker"].isNotNull()), F.lit(0))["attrs"]["data-ticker"]
    company = first_text(F.col("_inside"), lambda n: has_class(n["classes"], "quote-header_ticker-wrapper_company"))
    links = F.transform(
        F.filter("_inside", lambda n: (n["tag"] == "a") & has_class(n["classes"], "quote-header_category")),
        lambda n: F.struct(
            F.regexp_extract(n["href"], r"f=([a-z]+)_[a-z0-9]+", 1).alias("kind"), n["text"].alias("text")
        ),
    )

    def category(kind: str) -> Column:
        return F.get(F.filter("_links", lambda x: x["kind"] == kind), F.lit(0))["text"]

    exchange = category("exch")
    base = docs.withColumn("_inside", inside).withColumn("_links", links)
    identity = {
        "symbol": ticker,
        "company": F.nullif(company, F.lit("")),
        "sector": category("sec"),
        "industry": category("ind"),
        "country": category("geo"),
        "exchange": F.when(exchange == "NASD", F.lit("NASDAQ")).otherwise(exchange),
    }
    return once(base, [*keys_of(docs), "nodes"], identity).select(*keys_of(docs), *identity, "nodes")


def _is_snapshot(n: Column) -> Column:
    return (n["tag"] == "td") & has_class(n["classes"], "snapshot-td2")


def quote_parts(quotes: DataFrame) -> DataFrame:
    """Documents of ``quote_documents`` with ``row_nodes`` and ``cell_nodes``, the snapshot's, beside the other regions' nodes.

    Every relation of a stock page reads one or two of the three, so that a table of them is
    read column by column. Each part holds the nodes and fields that are read of it; those of
    the header are left out, as its identity is known.
    """

    def part(test, *fields: str) -> Column:
        return F.transform(F.filter("nodes", test), lambda n: F.struct(*[n[f].alias(f) for f in fields]))

    def other(n: Column) -> Column:
        link = (n["tag"] == "a") & (has_class(n["classes"], "tab-link") | has_class(n["classes"], "sig-tab-link"))
        named = has_class(n["classes"], "quote_profile-bio") | has_class(n["classes"], "js-quote-correlation-links-container")
        return n["tag"].isin("img", "span", "table") | link | named

    return quotes.select(
        *keys_of(quotes),
        part(other, "pos", "tag", "id", "classes", "parent", "last", "parent_last", "text", "href", "attrs").alias("nodes"),
        part(lambda n: n["tag"] == "tr", "tag", "table_no", "table_id", "table_classes", "row_no", "heads", "cells", "items").alias("row_nodes"),
        part(_is_snapshot, "table_no", "text").alias("cell_nodes"),
    )


def x_quote_header(quotes: DataFrame) -> DataFrame:
    return quotes.drop(*NODE_COLUMNS)


def snapshot_pairs(quotes: DataFrame) -> DataFrame:
    """Documents with ``pairs``: table ordinal, label and value in page order.

    Only the first pair of a label counts, whatever table it stands in.
    """
    cells = F.col("cell_nodes") if "cell_nodes" in quotes.columns else F.filter("nodes", _is_snapshot)
    base = quotes.withColumn("_cells", cells)
    tables = F.array_distinct(F.transform("_cells", lambda n: n["table_no"]))
    pair = F.transform(
        F.filter("_cells", lambda n, i: i % 2 == 0),
        lambda n, i: F.struct(
            F.array_position("_tables", n["table_no"]).cast("int").alias("table"),
            (i + 1).alias("pos"),
            n["text"].alias("label"),
            F.get(F.col("_cells"), i * 2 + 1)["text"].alias("value"),
        ),
    )
    base = base.withColumn("_tables", tables).withColumn("_all", F.filter(pair, lambda p: p["label"] != ""))
    first = let(
        F.transform("_all", lambda p: p["label"]),
        lambda labels: F.filter("_all", lambda p, i: F.array_position(labels, p["label"]) == i + 1),
    )
    return base.withColumn("pairs", first).drop("_cells", "_tables", "_all")


def snapshot_label_value(quotes: DataFrame) -> DataFrame:
    """The label/value rows of each snapshot region."""
    return struct_rows(snapshot_pairs(quotes), ["symbol"], "pairs").select(
        "symbol", F.col("table").alias("table_no"), "pos", "label", "value"
    )


# Snapshot labels and the field each one fills as it stands.
SNAPSHOT_LABELS = {
    "Index": "index_membership",
    "Market Cap": "market_cap",
    "P/E": "pe_ratio",
    "EPS (ttm)": "eps_ttm",
    "Earnings": "earnings_date",
    "Employees": "employees",
    "SMA20": "sma20_percent",
    "SMA50": "sma50_percent",
    "SMA200": "sma200_percent",
    "Shs Outstand": "shares_outstanding",
    "Shs Float": "float_shares",
    "Beta": "beta",
    "Avg Volume": "average_volume",
    "Volume": "volume",
    "Price": "price",
}
# Snapshot labels whose display is reshaped before it is typed.
RESHAPED_LABELS = ("Change", "Dividend TTM", "Dividend Ex-Date", "IPO Date")


def x_quote_snapshot(quotes: DataFrame) -> DataFrame:
    """One source-near ``quote_snapshot`` row per page; unknown labels stay in ``extra``."""
    base = snapshot_pairs(quotes).withColumn(
        "_values", F.map_from_entries(F.transform("pairs", lambda p: F.struct(p["label"], p["value"])))
    )

    def value(label: str) -> Column:
        return F.try_element_at("_values", F.lit(label))

    change, dividend = X.split_paired(value("Change")), X.split_paired(value("Dividend TTM"))
    known = [*SNAPSHOT_LABELS, *RESHAPED_LABELS]
    out = {name: value(label) for label, name in SNAPSHOT_LABELS.items()}
    out["change"] = change["value"]
    out["change_percent"] = change["percent"]
    out["dividend_yield"] = F.coalesce(F.nullif(dividend["percent"], F.lit("")), value("Dividend TTM"))
    for label, name in (("Dividend Ex-Date", "ex_dividend_date"), ("IPO Date", "ipo_date")):
        iso = F.date_format(M.norm_date_mon(value(label)), "yyyy-MM-dd")
        out[name] = F.coalesce(iso, value(label))
        out[f"{name}__display"] = value(label)
    extra = F.map_filter("_values", lambda k, _: ~k.isin(*known))
    return base.select(
        *[c for c in base.columns if c not in (*NODE_COLUMNS, "pairs", "_values")],
        *[c.alias(name) for name, c in out.items()],
        extra.alias("extra"),
    )


def x_quote_description(quotes: DataFrame) -> DataFrame:
    """One row per page with a non-empty description."""
    bio = first_text(F.col("nodes"), lambda n: has_class(n["classes"], "quote_profile-bio"))
    keys = [c for c in keys_of(quotes) if c in ("symbol", "fetched_at")]
    return quotes.select(*keys, bio.alias("description")).where(F.col("description") != "")


def _whole() -> Column:
    """Whether a row has a cell for every header."""
    return F.size("cells") >= F.size("heads")


def _linked_news() -> Column:
    return item(lambda i: (i["tag"] == "a") & has_class(i["classes"], "tab-link-news"))


def _with_form() -> Column:
    return F.array_contains("heads", "SEC Form 4")


def _quote_keys(quotes: DataFrame) -> list[str]:
    return [c for c in keys_of(quotes) if c in ("symbol", "fetched_at")]


def x_quote_ratings(quotes: DataFrame) -> DataFrame:
    day = M.norm_date_rating(cell("Date"))
    return table_rows(quotes, "js-table-ratings").where(_whole()).select(
        *_quote_keys(quotes),
        F.date_format(day, "yyyy-MM-dd 00:00").alias("published_at"),
        cell("Date").alias("published_at__display"),
        F.nullif(cell("Action"), F.lit("")).alias("status"),
        F.lit(None).cast("string").alias("rating"),
        cell("Rating Change").alias("rating__display"),
        F.nullif(cell("Analyst"), F.lit("")).alias("analyst"),
        X.strip_dollar(cell("Price Target Change")).alias("price_target"),
        cell("Price Target Change").alias("price_target__display"),
    )


def x_quote_news(quotes: DataFrame) -> DataFrame:
    link = _linked_news()
    right = item(lambda i: has_class(i["classes"], "news-link-right"))
    rows = table_rows(quotes, table_id="news-table").where((F.size("cells") >= 2) & link.isNotNull())
    when = F.get("cells", F.lit(0))
    anchor = M.anchor_date(F.col("fetched_at"))
    return rows.select(
        *_quote_keys(quotes),
        M.norm_ts_news_display(when, anchor).alias("published_at"),
        when.alias("published_at__display"),
        link["text"].alias("title"),
        F.coalesce(link["href"], F.lit("")).alias("url"),
        X.strip_parens(right["text"]).alias("publisher"),
    )


def _insider_columns() -> list[Column]:
    form = item(lambda i: (i["tag"] == "a") & (i["col_no"] == column_of("SEC Form 4")) & (i["href"] != ""))
    day = F.date_format(M.norm_date_insider(cell("Date")), "yyyy-MM-dd")

    def text_of(label: str) -> Column:
        return F.nullif(cell(label), F.lit(""))

    return [
        text_of("Relationship").alias("relationship"),
        day.alias("transaction_date"),
        text_of("Transaction").alias("transaction_type"),
        text_of("Cost").alias("cost"),
        text_of("#Shares").alias("shares"),
        text_of("Value ($)").alias("value"),
        text_of("#Shares Total").alias("shares_total"),
        form["href"].alias("sec_form_url"),
    ]


def x_quote_insider(quotes: DataFrame) -> DataFrame:
    rows = table_rows(quotes, "body-table").where(_whole() & _with_form())
    return rows.select(*_quote_keys(quotes), cell("Insider Trading").alias("owner"), *_insider_columns())


def _ticker_links(quotes: DataFrame, label: str, name: str) -> DataFrame:
    """Tagged spans beside the link called ``label``, in page order."""
    link = F.get(
        F.filter("nodes", lambda n: (n["tag"] == "a") & has_class(n["classes"], "tab-link") & (n["text"] == label)),
        F.lit(0),
    )
    spans = let(
        link,
        lambda a: F.filter(
            "nodes",
            lambda n: (n["tag"] == "span")
            & (F.coalesce(n["attrs"]["data-boxover-ticker"], F.lit("")) != "")
            & (n["pos"] > a["parent"])
            & (n["pos"] <= a["parent_last"]),
        ),
    )
    return array_rows(quotes, _quote_keys(quotes), spans, "_at", "n").select(
        *_quote_keys(quotes),
        F.col("n.attrs")["data-boxover-ticker"].alias(name),
        (F.col("_at") + 1).cast("bigint").alias("rank"),
        F.col("n.attrs")["data-boxover-value"].alias("_value"),
    )


def x_quote_peers(quotes: DataFrame) -> DataFrame:
    return _ticker_links(quotes, "Peers", "peer").withColumnRenamed("_value", "market_cap")


def x_quote_etf_holders(quotes: DataFrame) -> DataFrame:
    rows = _ticker_links(quotes, "Held by", "etf")
    return rows.withColumns(
        {"aum": X.strip_aum(F.col("_value")), "aum__display": F.coalesce("_value", F.lit(""))}
    ).drop("_value")


def x_quote_signals(quotes: DataFrame) -> DataFrame:
    links = nodes_of(
        quotes,
        *_quote_keys(quotes),
        test=lambda n: (n["tag"] == "a") & has_class(n["classes"], "sig-tab-link") & n["href"].contains("screener"),
    )
    return links.select(*_quote_keys(quotes), F.col("text").alias("signal"), F.col("href").alias("url"))


def missing_region(quotes: DataFrame) -> DataFrame:
    """Per page, the optional regions whose structure is absent, and the status."""

    def found(test, part: str = "nodes") -> Column:
        return F.exists(_held(quotes, part), test)

    def linked(label: str) -> Column:
        return found(lambda n: (n["tag"] == "a") & has_class(n["classes"], "tab-link") & (n["text"] == label))

    present = {
        "description": found(lambda n: has_class(n["classes"], "quote_profile-bio")),
        "ratings": found(lambda n: (n["tag"] == "table") & has_class(n["classes"], "js-table-ratings")),
        "news": found(lambda n: (n["tag"] == "table") & (n["id"] == "news-table")),
        "insider": found(
            lambda n: (n["tag"] == "tr") & has_class(n["table_classes"], "body-table") & F.array_contains(n["heads"], "SEC Form 4"),
            "row_nodes",
        ),
        "peers": linked("Peers"),
        "etf_holders": linked("Held by"),
        "signals": found(lambda n: has_class(n["classes"], "js-quote-correlation-links-container")),
    }
    gaps = F.array_compact(
        F.array(*[F.when(~F.coalesce(present[r], F.lit(False)), F.lit(r)) for r in OPTIONAL_REGIONS])
    )
    status = F.when(F.size(gaps) == 0, F.lit("COMPLETE")).otherwise(F.lit("PARTIAL"))
    return quotes.select(*_quote_keys(quotes), gaps.alias("missing_regions"), status.alias("status"))


def bundle_fanout(docs: DataFrame) -> dict[str, DataFrame]:
    """Every relation of the quote pages, lazily, over one set of documents.

    Write ``docs`` to a table when several relations are read: they all share its parse, and
    a table holds its nodes in far less room than a cache. Documents of ``quote_parts`` are
    read part by part.
    """
    quotes = quote_documents(docs).where(F.col("symbol").isNotNull())
    return {
        "header": x_quote_header(quotes),
        "snapshot": x_quote_snapshot(quotes),
        "snapshot_tables": snapshot_label_value(quotes),
        "description": x_quote_description(quotes),
        "ratings": x_quote_ratings(quotes),
        "news": x_quote_news(quotes),
        "insider": x_quote_insider(quotes),
        "peers": x_quote_peers(quotes),
        "etf_holders": x_quote_etf_holders(quotes),
        "signals": x_quote_signals(quotes),
        "charts": x_chart_refs(quotes),
        "regions": missing_region(quotes),
    }


# ---------------------------------------------------------------- news


def _news_cells() -> tuple[Column, Column]:
    """A news row's time display and its link."""
    link_col = item(lambda i: has_class(i["classes"], "news_link-cell"))["col_no"]
    when = item(lambda i: has_class(i["classes"], "news_date-cell"))["text"]

    def link(css: str) -> Column:
        return item(lambda i: (i["tag"] == "a") & (i["col_no"] == link_col) & has_class(i["classes"], css))

    return when, F.coalesce(link("nn-tab-link"), link("tab-link"))


def _news_rows(rows: DataFrame, default: Column, *columns) -> DataFrame:
    when, anchor = _news_cells()
    icon = item(lambda i: (i["tag"] == "use") & F.coalesce(i["href"].rlike(r"(?i)#[a-z0-9-]+-light\z"), F.lit(False)))
    publisher = F.coalesce(F.nullif(F.regexp_extract(icon["href"], r"(?i)#([a-z0-9-]+)-light\z", 1), F.lit("")), default)
    return rows.where(when.isNotNull() & anchor.isNotNull()).select(
        *columns,
        anchor["text"].alias("title"),
        F.coalesce(anchor["href"], F.lit("")).alias("url"),
        publisher.alias("publisher"),
        when.alias("published_at_raw"),
        M.norm_ts_news_kind(when).alias("published_at_status"),
    )


def _listed_news(docs: DataFrame) -> DataFrame:
    """Rows of the first two news tables, each with its category."""

    def listing(n: Column) -> Column:
        return (n["tag"] == "table") & has_class(n["classes"], "styled-table-new") & has_class(n["classes"], "table-fixed")

    tables = F.transform(F.filter("nodes", listing), lambda n: n["table_no"])
    headings = F.transform(
        F.filter("nodes", lambda n: has_class(n["classes"], "news-calendar_heading")),
        lambda n: F.lower(n["text"]),
    )
    base = docs.withColumns({"_tables": tables, "_headings": headings})
    ordinal = F.array_position("_tables", F.col("table_no"))
    rows = nodes_of(base, test=lambda n: (n["tag"] == "tr") & (F.size(n["cells"]) > 0)).where(ordinal.between(1, 2))
    return rows.withColumn("category", F.get("_headings", (ordinal - 1).cast("int")))


def x_global_news(docs: DataFrame) -> DataFrame:
    """Global news rows with their category: first table News, second Blogs."""
    return _news_rows(_listed_news(docs), F.lit(None).cast("string"), *keys_of(docs), "category", "row_no")


def x_publisher_news(docs: DataFrame, slug: Column) -> DataFrame:
    """One publisher's news; rows without an icon belong to ``slug``."""
    return _news_rows(table_rows(docs, "table-fixed"), slug, *keys_of(docs), "row_no")


# ---------------------------------------------------------------- insider and disclosure

# Headers the global insider table must have.
INSIDER_HEADS = (
    "Ticker", "Owner", "Relationship", "Date", "Transaction", "Cost", "#Shares", "Value ($)",
    "#Shares Total", "SEC Form 4",
)

# Options of ``documents`` for a plan that reads the global insider table only.
INSIDER_READS = {"tables": ("insider-table",), "rows": ("insider-table",), "fields": ("tag", "table_id", "table_classes", "row_no", "heads", "cells", "items")}


def _insider_contract() -> Column:
    return F.size(F.array_except(F.array(*[F.lit(h) for h in INSIDER_HEADS]), "heads")) == 0


def x_global_insider(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Insider rows and the quarantined rows that name no ticker."""
    rows = table_rows(docs, table_id="insider-table").where(_insider_contract())
    anchor = item(lambda i: (i["tag"] == "a") & (i["col_no"] == column_of("Ticker")))["text"]
    symbol = F.coalesce(F.nullif(anchor, F.lit("")), F.nullif(cell("Ticker"), F.lit("")))
    out = rows.select(
        *keys_of(docs), "row_no", symbol.alias("symbol"), F.nullif(cell("Owner"), F.lit("")).alias("owner"), *_insider_columns()
    )
    return out.where(F.col("symbol").isNotNull()), out.where(F.col("symbol").isNull())


# The embedded roots of fund and manager pages.
DISCLOSURE_ROOTS = {
    "fund": ("initialFundDetailsData", "initialFundReportDates"),
    "manager": ("initialManagerDetailsData", "initialManagerReportDates"),
}


def disclosed(root: str) -> Column:
    return first_text(
        F.col("nodes"),
        lambda n: (n["tag"] == "script")
        & n["text"].startswith("{")
        & F.get_json_object(n["text"], f"$.{root}").startswith("{"),
    )


def x_disclosure(docs: DataFrame, kind: str) -> DataFrame:
    """The portfolio JSON of a disclosure page, verbatim, with its report dates."""
    root, dates = DISCLOSURE_ROOTS[kind]
    script = disclosed(root)
    base = docs.withColumn("_json", script).where(F.col("_json").isNotNull())
    return base.select(
        *keys_of(docs),
        F.get_json_object("_json", f"$.{root}").alias("details"),
        F.coalesce(
            F.from_json(F.get_json_object("_json", f"$.{dates}"), "array<string>"), F.array().cast("array<string>")
        ).alias("report_dates"),
    )


# ---------------------------------------------------------------- what the families refuse


def _refused(docs: DataFrame, rows: DataFrame, problem: Column) -> DataFrame:
    keys = keys_of(docs)
    return rows.withColumn("problem", problem).where(F.col("problem").isNotNull()).select(*keys, "row_no", "problem")


def _without(docs: DataFrame, missing: Column, problem: str) -> DataFrame:
    """Whole documents that a family cannot read: their ``row_no`` is null."""
    return docs.where(F.coalesce(missing, F.lit(True))).select(*keys_of(docs), F.lit(None).cast("int").alias("row_no"), F.lit(problem).alias("problem"))


def _no_table(css: str | None = None, table_id: str | None = None) -> Column:
    def fits(n: Column) -> Column:
        named = n["table_id"] == table_id if table_id else has_class(n["table_classes"], css)
        return (n["tag"] == "tr") & (F.size(n["cells"]) > 0) & F.coalesce(named, F.lit(False))

    return ~F.exists("nodes", fits)


def _first_problem(**checks: Column) -> Column:
    """The name of the first check that does not hold, spelled with blanks; null when all hold."""
    return F.coalesce(*[F.when(~F.coalesce(held, F.lit(False)), F.lit(name.replace("_", " "))) for name, held in checks.items()])


def page_errors(docs: DataFrame, family: str) -> DataFrame:
    """``(*keys, row_no, problem)`` of every document and row that a family's relation leaves out.

    Each test is the one that the family's own plan keeps rows by, so accepted and refused
    rows add up to the rows that are there. A document without the structure is one row with
    a null ``row_no``. ``docs`` are parsed documents; for the regions of a stock page
    (``ratings``, ``stock_news``, ``stock_insider``) those of ``quote_documents`` or ``quote_parts``.
    """
    whole = is_rank(F.get("cells", F.lit(0))) & (F.size("cells") == F.size("heads"))
    if family in ("groups", "market"):
        identity = ("Name",) if family == "groups" else ("Pair", "Ticker")
        rows = table_rows(docs, "groups_table")
        refused = _refused(docs, rows, _first_problem(unexpected_header=_numbered(*identity), rank_or_cell_count=whole))
        return _without(docs, _no_table("groups_table"), "no table").unionByName(refused)
    if family == "spectrum":
        return _without(docs, F.size(_spectra()) != 1, "not one spectrum image")
    if family == "stock":
        quotes = quote_documents(docs)
        keys = [c for c in keys_of(docs) if c != "symbol"]
        return _without(quotes.select(*keys, "symbol"), F.col("symbol").isNull(), "no symbol").drop("symbol")
    if family == "ratings":
        return _refused(docs, table_rows(docs, "js-table-ratings"), _first_problem(short_row=_whole()))
    if family == "stock_news":
        checks = {"short_row": F.size("cells") >= 2, "no_link": _linked_news().isNotNull()}
        return _refused(docs, table_rows(docs, table_id="news-table"), _first_problem(**checks))
    if family == "stock_insider":
        return _refused(docs, table_rows(docs, "body-table").where(_with_form()), _first_problem(short_row=_whole()))
    if family in ("global_news", "publisher_news"):
        when, anchor = _news_cells()
        rows = _listed_news(docs) if family == "global_news" else table_rows(docs, "table-fixed")
        checks = {"no_time": when.isNotNull(), "no_link": anchor.isNotNull(), "unknown_time": M.norm_ts_news_kind(when).isNotNull()}
        return _without(docs, _no_table("table-fixed"), "no table").unionByName(_refused(docs, rows, _first_problem(**checks)))
    if family == "global_insider":
        rows = table_rows(docs, table_id="insider-table")
        anchor = item(lambda i: (i["tag"] == "a") & (i["col_no"] == column_of("Ticker")))["text"]
        named = F.coalesce(F.nullif(anchor, F.lit("")), F.nullif(cell("Ticker"), F.lit(""))).isNotNull()
        refused = _refused(docs, rows, _first_problem(unexpected_header=_insider_contract(), no_ticker=named))
        return _without(docs, _no_table(table_id="insider-table"), "no table").unionByName(refused)
    if family in DISCLOSURE_ROOTS:
        return _without(docs, disclosed(DISCLOSURE_ROOTS[family][0]).isNull(), "no portfolio")
    raise R.QueryError(f"unknown page family {family!r}")


# ---------------------------------------------------------------- JSON bodies

_ENTRY = (
    "struct<ticker string, event string, category string, date string, reference string, "
    "referenceDate string, actual string, previous string, forecast string, importance string>"
)


def _release_rows(df: DataFrame, body: str, section: str, field: str) -> DataFrame:
    tag = r'(?:id="route-init-data" type="application/json"|type="application/json" data-ssr-props="[^"]*")'
    payload = json_between(F.col(body), rf"(?s)<script {tag}>\s*(.*?)\s*</script>")
    # Both generations of the payload in one parse.
    holder = f"struct<{field} array<{_ENTRY}>>"
    keys = [c for c in df.columns if c != body]
    parsed = once(df, keys, {"_json": F.from_json(payload, f"struct<{section} {holder}, data {holder}>")})
    entries = F.coalesce(F.col(f"_json.{section}.{field}"), F.col(f"_json.data.{field}"))
    base = array_rows(parsed, keys, entries, "position", "e")
    split = M.norm_ts_calendar(F.col("e.date"))
    return base.select(
        *keys,
        "position",
        F.coalesce("e.ticker", F.lit("")).alias("symbol"),
        F.coalesce("e.event", F.lit("")).alias("event"),
        F.col("e.category").alias("category"),
        split["release_date"].alias("release_date"),
        F.col("e.date").alias("release_date__display"),
        split["release_time"].alias("release_time"),
        split["release_timestamp"].alias("release_timestamp"),
        F.col("e.importance").alias("importance"),
        F.col("e.reference").alias("reference_period"),
        F.col("e.referenceDate").alias("reference_date"),
        F.col("e.actual").alias("actual"),
        F.col("e.forecast").alias("forecast"),
        F.col("e.previous").alias("previous"),
    )


def x_calendar(df: DataFrame, body: str = "body") -> DataFrame:
    """Release rows of a calendar page, in either payload generation."""
    return _release_rows(df, body, "economic", "entries")


def x_calendar_detail(df: DataFrame, body: str = "body") -> DataFrame:
    """History rows of one release's detail page."""
    return _release_rows(df, body, "economicDetail", "table")


# Tile keys with a column of their own.
TILE_KEYS = ("label", "ticker", "last", "change", "changeUsd", "prevClose", "high", "low", "sparkline")
_TILE = "map<string,string>"


def x_tiles(df: DataFrame, anchor: str, body: str = "body") -> DataFrame:
    """Market tiles after ``anchor``: typed facts and the sparkline as it came.

    ``tile_ok`` is false where a required key is missing, a number is no number
    or the sparkline is not a numeric array. Sparklines carry no timestamps and
    are never turned into a series.
    """
    keys = [c for c in df.columns if c != body]
    payload = F.from_json(after(F.col(body), anchor), f"map<string,{_TILE}>")
    base = map_rows(df, keys, payload, "key", "t")
    t = F.col("t")

    def number(name: str) -> Column:
        return N.to_finite(F.try_element_at(t, F.lit(name)))

    spark_text = F.try_element_at(t, F.lit("sparkline"))
    line = F.from_json(spark_text, "array<double>")
    numbers = {k: number(k) for k in ("last", "change", "changeUsd", "prevClose", "high", "low")}
    ok = F.try_element_at(t, F.lit("label")).isNotNull() & sparkline_verbatim(spark_text)
    for value in numbers.values():
        ok = ok & value.isNotNull()
    return base.select(
        *keys,
        F.coalesce(F.try_element_at(t, F.lit("ticker")), F.col("key")).alias("ticker"),
        F.try_element_at(t, F.lit("label")).alias("label"),
        numbers["last"].alias("last"),
        (numbers["change"] / 100.0).alias("change"),
        numbers["changeUsd"].alias("change_usd"),
        numbers["prevClose"].alias("prev_close"),
        numbers["high"].alias("high"),
        numbers["low"].alias("low"),
        line.alias("sparkline"),
        F.map_filter(t, lambda k, v: ~k.isin(*TILE_KEYS) & ~v.rlike(r"\A[\[{]") & v.isNotNull()).alias("extra_fields"),
        ok.alias("tile_ok"),
    )


def sparkline_verbatim(payload: Column) -> Column:
    """Whether a JSON text is an array of nothing but numbers."""
    parts = F.from_json(payload, "array<string>")
    numeric = F.forall(parts, lambda p: F.coalesce(p.rlike(N.PLAIN_FLOAT), F.lit(False)))
    plain = ~payload.contains('"')
    return F.coalesce(numeric & plain, F.lit(False))


def x_futures(df: DataFrame, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """Futures tiles (one row per ticker, displays verbatim) and category rows."""
    keys = [c for c in df.columns if c != body]
    delay = F.regexp_extract(body, r"Futures and options delayed by ([0-9]+) minute", 1)
    tiles = F.from_json(json_between(F.col(body), r"(?s)var tiles = (\{.*?\});"), f"map<string,{_TILE}>")
    groups = F.from_json(
        json_between(F.col(body), r"(?s)var groups = (\[.*?\]);"),
        "array<struct<label string, contracts array<struct<ticker string>>>>",
    )
    base = df.withColumn("delay_minutes", F.nullif(delay, F.lit("")))
    known = ("label", "ticker", "last", "change", "changeUsd", "prevClose", "high", "low", "sparkline", "sparklineDateChanges")
    t = F.col("t")

    def value(name: str) -> Column:
        return F.try_element_at(t, F.lit(name))

    rows = map_rows(base, [*keys, "delay_minutes"], tiles, "symbol", "t").select(
        *keys,
        "symbol",
        value("label").alias("name"),
        value("last").alias("last"),
        value("change").alias("change_percent"),
        value("changeUsd").alias("change_usd"),
        value("prevClose").alias("prev_close"),
        value("high").alias("high"),
        value("low").alias("low"),
        F.coalesce(value("sparkline"), F.lit("[]")).alias("sparkline"),
        F.coalesce(value("sparklineDateChanges"), F.lit("{}")).alias("sparkline_date_changes"),
        "delay_minutes",
        F.map_filter(t, lambda k, _: ~k.isin(*known)).alias("extra"),
    )
    labelled = array_rows(base, keys, groups, "g_no", "g")
    labelled = labelled.select(*keys, "g_no", F.col("g.label").alias("category"), "g.contracts")
    listed = (
        array_rows(labelled, [*keys, "g_no", "category"], "contracts", "c_no", "c")
        .select(*keys, "g_no", "c_no", "category", F.col("c.ticker").alias("symbol"))
        .where(F.col("symbol").isNotNull())
    )
    return rows, listed


def x_map_perf(df: DataFrame, body: str = "body") -> DataFrame:
    """Ticker performance of a map page with subtype, version, hash and delay."""
    keys = [c for c in df.columns if c != body]
    payload = F.from_json(
        after(F.col(body), r"initialPerf\s*:\s*"),
        "struct<nodes map<string,string>, subtype string, version bigint, hash string>",
    )
    delay = F.regexp_extract(body, r"Stock quotes delayed by ([0-9]+) minute", 1).try_cast("double")
    base = df.select(*keys, payload.alias("p"), delay.alias("delay_minutes"))
    facts = ["p.subtype", "p.version", F.col("p.hash").alias("payload_hash"), "delay_minutes"]
    return map_rows(base, [*keys, *facts], "p.nodes", "symbol", "_v").select(
        *keys, "subtype", "version", "payload_hash", "delay_minutes", "symbol", N.to_finite(F.col("_v")).alias("perf")
    )


_LEAF = "struct<name string, description string, value variant>"
_TREE = (
    "struct<name string, children array<struct<name string, children array<struct<name string, "
    f"children array<{_LEAF}>>>>>>"
)


def x_hierarchy(df: DataFrame, body: str = "body") -> DataFrame:
    """A hierarchy asset to its leaves in tree order; a leaf without value counts 0.

    Assets of another shape have no leaves here; ``hierarchy_problems`` names them.
    """
    keys = [c for c in df.columns if c != body]
    good = _hierarchies(df, body).where(F.col("problem").isNull())
    return leaves_of(good.select(*keys, "root"), keys)


def _hierarchies(df: DataFrame, body: str) -> DataFrame:
    keys = [c for c in df.columns if c != body]
    written = x_js_literal(after(F.col(body), r"e\.exports\s*=\s*(?=\{)"))
    parsed = once(df, keys, {"_tree": F.struct(F.from_json(written, _TREE).alias("root"), F.get_json_object(written, "$.children").alias("children"))})
    parsed = parsed.select(*keys, F.col("_tree.root").alias("root"), F.col("_tree.children").alias("_children"))
    return parsed.withColumn("problem", hierarchy_problem(F.col("root"), F.col("_children"))).drop("_children")


def is_number(value: Column) -> Column:
    """Whether a VARIANT is a JSON number; texts and booleans that would convert are none."""
    return F.schema_of_variant(value).rlike(r"\A(?:BIGINT|DOUBLE|FLOAT|DECIMAL.*)\z")


def hierarchy_problem(root: Column, children: Column) -> Column:
    """The first way in which a tree is not sectors of industries of named leaves; null if it is.

    ``children`` is the root's field as written: a named root that has none, or an
    empty list, is an export without leaves and no problem. A leaf's value is absent,
    null or a number.
    """

    def nameless(x: Column) -> Column:
        return F.coalesce(x["name"], F.lit("")) == ""

    def lacks(level: Column) -> Column:
        return F.exists(level, lambda x: nameless(x) | (F.coalesce(F.size(x["children"]), F.lit(0)) <= 0))

    def odd(x: Column) -> Column:
        return x["value"].isNotNull() & (F.schema_of_variant(x["value"]) != "VOID") & ~is_number(x["value"])

    sectors = root["children"]
    industries = F.flatten(F.transform(sectors, lambda s: s["children"]))
    leaves = F.flatten(F.transform(industries, lambda i: i["children"]))
    return (
        F.when(root.isNull() | nameless(root), F.lit("no hierarchy"))
        .when(children.isNull() | (children == "[]"), F.lit(None).cast("string"))
        .when(F.coalesce(F.size(sectors), F.lit(0)) <= 0, F.lit("no sectors"))
        .when(lacks(sectors), F.lit("sector without name or industries"))
        .when(lacks(industries), F.lit("industry without name or leaves"))
        .when(F.exists(leaves, nameless), F.lit("leaf without name"))
        .when(F.exists(leaves, odd), F.concat(F.lit("value of leaf "), F.get(F.filter(leaves, odd), F.lit(0))["name"], F.lit(" is no number")))
    )


def hierarchy_problems(df: DataFrame, body: str = "body") -> DataFrame:
    """Assets that are no hierarchy, each with its ``problem``."""
    keys = [c for c in df.columns if c != body]
    return _hierarchies(df, body).where(F.col("problem").isNotNull()).select(*keys, "problem")


def leaves_of(df: DataFrame, keys: list[str]) -> DataFrame:
    """Leaves of a ``root`` struct with their sector/industry path and position."""
    sectors = array_rows(df, keys, "root.children", "sector_no", "s")
    path = [*keys, "sector_no", F.col("s.name").alias("sector")]
    industries = array_rows(sectors, path, "s.children", "industry_no", "i")
    path = [*keys, "sector_no", "sector", "industry_no", F.col("i.name").alias("industry")]
    return (
        array_rows(industries, path, "i.children", "leaf_no", "leaf")
        .select(
            *keys, "sector_no", "industry_no", "leaf_no", "sector", "industry",
            F.col("leaf.name").alias("symbol"),
            F.col("leaf.description").alias("description"),
            F.coalesce(F.try_variant_get("leaf.value", "$", "double"), F.lit(0.0)).alias("value"),
        )
    )


def hierarchy_preload(docs: DataFrame) -> DataFrame:
    """The page's own hierarchy asset URL."""
    link = F.get(
        F.filter("nodes", lambda n: (n["tag"] == "link") & (n["attrs"]["data-chunk-id"] == "map_base_sec")), F.lit(0)
    )
    return docs.select(*keys_of(docs), link["href"].alias("hierarchy_url"))


# ---------------------------------------------------------------- screener JSON

_SCREEN_JSON = (
    "struct<url string, selectedColumns array<string>, data struct<totalCount bigint, firstRow bigint, "
    "pageSize bigint, rows array<struct<text map<string,string>, numbers map<string,string>>>>>"
)


def _literal_map(pairs) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs for x in pair])


def json_display(key: Column, text: Column, number: Column) -> Column:
    """One JSON cell as the display the table form of the page would show."""
    is_int = number.rlike(r"\A-?[0-9]+\z")
    value = N.to_finite(number)
    shown = (
        F.when(number.isNull(), F.lit("-"))
        .when(is_int & (key == "volume"), N.fmt_volume(number.try_cast("bigint")))
        .when(is_int, number)
        .when(key.isin(*R.JSON_COMPACT), N.fmt_compact_millions(value))
        .when(key.isin(*R.JSON_PERCENT), N.fmt_percent_points(value))
        .otherwise(N.fmt_general(value, 6))
    )
    words = F.coalesce(F.nullif(X.strip_space(text), F.lit("")), F.lit("-"))
    return (
        F.when(text.isNotNull() & (key == "earningsDate"), M.fmt_earnings_date(text))
        .when(text.isNotNull(), words)
        .otherwise(shown)
    )


def x_screener_json(docs: DataFrame) -> DataFrame:
    """Screen rows from the embedded JSON form, shaped like ``x_screener_table``.

    The column order comes from the request's ``c=`` codes or ``selectedColumns``,
    never from the keys present, so sparse rows cannot change the schema.
    """
    script = first_text(
        F.col("nodes"),
        lambda n: (n["tag"] == "script")
        & n["text"].startswith("{")
        & F.get_json_object(n["text"], "$.data.totalCount").isNotNull(),
    )
    base = docs.select(*keys_of(docs), F.from_json(script, _SCREEN_JSON).alias("p")).where(F.col("p.data").isNotNull())
    key_of_code = _literal_map([(code, key) for code, key, _ in R.JSON_FIELDS])
    label_of_key = _literal_map([(key, label) for _, key, label in R.JSON_FIELDS])
    codes = F.split(F.regexp_extract("p.url", r"[?&]c=([^&]+)", 1), r"\s*,\s*")
    asked = F.when(
        F.col("p.url").rlike(r"[?&]c=[^&]+"), F.transform(codes, lambda c: F.try_element_at(key_of_code, c))
    ).otherwise(F.col("p.selectedColumns"))
    order = F.array_distinct(F.filter(asked, lambda k: F.try_element_at(label_of_key, k).isNotNull()))
    base = base.withColumn("field_keys", order)
    facts = [*keys_of(docs), "p.data.totalCount", "p.data.firstRow", "field_keys"]
    rows = array_rows(base, facts, "p.data.rows", "i", "row")
    given = F.try_element_at("row.numbers", F.lit("order"))
    rank = F.when(given.rlike(r"\A[0-9]+\z"), given.try_cast("bigint") + 1).otherwise(F.col("firstRow") + F.col("i") + 1)
    symbol = F.upper(X.strip_space(F.try_element_at("row.text", F.lit("ticker"))))
    shown = F.transform(
        "field_keys",
        lambda k: json_display(k, F.try_element_at(F.col("row.text"), k), F.try_element_at(F.col("row.numbers"), k)),
    )
    labels = F.transform("field_keys", lambda k: F.try_element_at(label_of_key, k))
    lead = F.array(rank.cast("string"), symbol)
    return rows.select(
        *keys_of(docs),
        rank.alias("rank"),
        symbol.alias("symbol"),
        F.concat(F.array(F.lit("No."), F.lit("Ticker")), labels).alias("heads"),
        F.concat(lead, shown).alias("cells"),
        (F.col("firstRow") + 1).alias("page_start"),
        F.col("totalCount").alias("total_rows"),
        F.coalesce(symbol != "", F.lit(False)).alias("row_ok"),
    )


def screener_json_typed(docs: DataFrame, fields: list[str]) -> DataFrame:
    """The same rows with numbers kept typed: no display is made and re-read."""
    script = first_text(
        F.col("nodes"),
        lambda n: (n["tag"] == "script")
        & n["text"].startswith("{")
        & F.get_json_object(n["text"], "$.data.totalCount").isNotNull(),
    )
    base = docs.select(*keys_of(docs), F.from_json(script, _SCREEN_JSON).alias("p"))
    rows = struct_rows(base, keys_of(docs), "p.data.rows")
    labels = {key: label for _, key, label in R.JSON_FIELDS}
    return rows.select(
        *keys_of(docs),
        F.upper(F.try_element_at("text", F.lit("ticker"))).alias("symbol"),
        *[
            (
                F.try_element_at("text", F.lit(k))
                if k in R.JSON_TEXT or k == "earningsDate"
                else N.to_finite(F.try_element_at("numbers", F.lit(k)))
            ).alias(X.label_to_field(labels[k]))
            for k in fields
        ],
    )


# ---------------------------------------------------------------- symbols


def x_universe(df: DataFrame, host: str, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """Sitemap bodies to symbol rows (with first-seen order) and unexpected URLs."""
    keys = [c for c in df.columns if c != body]
    locs = F.regexp_extract_all(F.col(body), F.lit(r"(?s)<loc>\s*(.*?)\s*</loc>"), F.lit(1))
    rows = array_rows(df, keys, locs, "position", "loc")
    plain = F.replace(F.regexp_replace("loc", r"(?s)<!--.*?-->", ""), F.lit("&amp;"), F.lit("&"))
    rows = once(rows, [*keys, "position", "loc"], {"symbol": X.sym_from_url(plain, host)})
    return rows.where(F.col("symbol").isNotNull()), rows.where(F.col("symbol").isNull())


# Names a suggestion's additional fields may not take.
RESERVED_SUGGESTION_FIELDS = ("symbol", "extra_fields", "fetched_at", "market_cap_raw", "div_yield_raw")


def x_suggestions(df: DataFrame, body: str = "body") -> DataFrame:
    """Ranked suggestions; additional fields stay in ``extra`` under safe names.

    ``row_ok`` is false for a malformed ticker or a blank company or exchange.
    """
    keys = [c for c in df.columns if c != body]
    rows = array_rows(df, keys, F.from_json(body, "array<map<string,string>>"), "position", "m")
    ticker, company, exchange = (F.try_element_at("m", F.lit(k)) for k in ("ticker", "company", "exchange"))
    taken = (*RESERVED_SUGGESTION_FIELDS, "company", "exchange")
    rest = F.map_filter("m", lambda k, _: ~k.isin("ticker", "company", "exchange"))
    safe = F.transform_keys(rest, lambda k, _: F.when(k.isin(*taken), F.concat(F.lit("provider_"), k)).otherwise(k))

    def named(c: Column) -> Column:
        return c.isNotNull() & (X.strip_space(c) != "") & ~N.is_null_display(c)

    ok = F.coalesce(ticker.rlike(r"\A[A-Za-z0-9-]+\z"), F.lit(False)) & named(company) & named(exchange)
    return rows.select(
        *keys,
        (F.col("position") + 1).alias("rank"),
        F.upper(ticker).alias("symbol"),
        company.alias("company"),
        exchange.alias("exchange"),
        safe.alias("extra"),
        ok.alias("row_ok"),
    )


# ---------------------------------------------------------------- statements

PERIOD_KEYS = ("Period", "Period End Date", "Period Length")


def x_statement(df: DataFrame, body: str = "body") -> DataFrame:
    """Statement bodies with their parsed arrays, and why a body is refused.

    ``problem`` is null for a usable body, ``no data`` for the recognised empty
    envelope, else the contract it breaks. A refused body is a row, never an
    exception, so one bad document cannot fail a batch.
    """
    keys = [c for c in df.columns if c != body]
    shape = "error string, currency string, data map<string,array<string>>"
    base = once(df, df.columns, {"_json": F.from_json(body, shape)})
    # Only a body with this very error is looked at a second time.
    others = F.when(F.col("_json.error") == "no data", F.size(F.json_object_keys(body)))
    base = base.select(
        *keys, F.col("_json.error").alias("_error"), others.alias("_n_keys"), F.col("_json.currency").alias("currency"), F.col("_json.data").alias("data")
    )
    periods = F.try_element_at("data", F.lit("Period"))
    ends = F.try_element_at("data", F.lit("Period End Date"))
    lengths = F.try_element_at("data", F.lit("Period Length"))
    metrics = F.map_filter("data", lambda k, _: ~k.isin(*PERIOD_KEYS))
    base = base.withColumns({"periods": periods, "ends": ends, "lengths": lengths, "metrics": metrics})
    aligned = arrays_align(F.col("periods"), F.map_values("metrics"))
    bad_end = F.exists("ends", lambda e: (X.strip_space(e) != "") & M.norm_date_us(e).isNull())
    problem = (
        F.when((F.col("_error") == "no data") & (F.col("_n_keys") == 1), F.lit("no data"))
        .when(F.col("_error").isNotNull(), F.lit("unrecognized error envelope"))
        .when(F.col("data").isNull() | (F.size("data") == 0), F.lit("no statement data"))
        .when(F.coalesce(F.col("currency"), F.lit("")) == "", F.lit("no currency"))
        .when(F.coalesce(F.size("periods"), F.lit(0)) <= 0, F.lit("no periods"))
        .when(F.coalesce(F.size("ends") != F.size("periods"), F.lit(True)), F.lit("period ends misaligned"))
        .when(F.size("lengths") != F.size("periods"), F.lit("period lengths misaligned"))
        .when(bad_end, F.lit("bad period end"))
        .when(F.size("metrics") == 0, F.lit("no metrics"))
        .when(~aligned, F.lit("metric misaligned"))
    )
    return base.withColumn("problem", problem).drop("_error", "_n_keys", "data", "lengths")


def arrays_align(periods: Column, values: Column) -> Column:
    """Whether every metric array has exactly one entry per period."""
    return F.coalesce(F.forall(values, lambda v: F.size(v) == F.size(periods)), F.lit(False))
