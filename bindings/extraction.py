"""Captured-document operators: sources, classification, page families, sinks.

The benchmark's pages hold no tables and no JSON, so most documents here are
spelled by Spark from table rows; the oracle reads the same rows directly and
never sees the markup.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tickweave.functions import hashing as H
from tickweave.operators import ranking as K
from tickweave.operators.dataset import build_dataset
from tickweave.plans import api as A
from tickweave.plans import families as P
from tickweave.sources import captures as C
from tickweave.sources import html as D
from tickweave.sources import sitemaps as M
from tickweave.sources import variant as V
from tickweave.sources.embedded import x_embedded_json
from tickweave.sources.runs import RunLog

from .core import query, scratch
from .screens import plain
from .scalars import HOST, ORIGIN
from .views import FETCHED, quote_pages

PAGE_NAMES = {"page_id": "capture_id", "url": "endpoint", "html": "body"}


def stored(t, pages, name: str, **reads):
    """Pages parsed once, in the shared folder, from where every relation reads them."""
    return _written(t, P.documents(pages, carry=("fetched_at",), **reads), name)


def stored_quotes(t, pages):
    """Stock pages parsed once and stored in the parts that their relations read."""
    return _written(t, P.quote_parts(P.quote_documents(P.documents(pages, carry=("fetched_at",), **P.QUOTE_READS))), "quotes")


def _written(t, docs, name: str):
    folder = scratch(t, name)
    docs.write.option("compression", "zstd").parquet(folder)
    return t.spark.read.schema(docs.schema).parquet(folder)


def stamped():
    return F.lit(FETCHED).cast("timestamp").alias("fetched_at")


# ---------------------------------------------------------------- sources and sinks

_CAPTURED = "SELECT page_id AS capture_id, url AS endpoint, sha256(html) AS response_hash, CAST(length(html) AS BIGINT) AS n FROM pages"


def _captured(df):
    return df.select("capture_id", "endpoint", "response_hash", F.length("body").cast("bigint").alias("n"))


@query("src_captures", _CAPTURED)
def src_captures(t):
    return _captured(C.src_captures(t.spark, t.path("pages"), rename=PAGE_NAMES))


@query("src_captures_stream", _CAPTURED)
def src_captures_stream(t):
    """The pages read as a stream, until the present files are used up."""
    folder = scratch(t, "stream")
    schema = t("pages").schema
    stream = C.src_captures_stream(t.spark, t.path("pages*"), schema, rename=PAGE_NAMES)
    out = _captured(stream).writeStream.format("parquet").option("checkpointLocation", f"{folder}/ckpt")
    out.outputMode("append").trigger(availableNow=True).start(f"{folder}/rows").awaitTermination()
    return t.spark.read.parquet(f"{folder}/rows")


@query("sink_export", "SELECT symbol, company, '{\"country\":\"' || country || '\",\"sector\":\"' || sector || '\"}' AS extra_fields, volume FROM securities", "securities")
def sink_export(t):
    """A CSV export with a map column, read back."""
    folder = scratch(t, "export")
    bag = F.create_map(F.lit("sector"), F.col("sector"), F.lit("country"), F.col("country")).alias("extra_fields")
    C.sink_export(t("securities").select("symbol", "company", bag, "volume"), folder, "csv")
    reader = t.spark.read.option("header", True).option("escape", '"')
    return reader.schema("symbol string, company string, extra_fields string, volume bigint").csv(folder)


@query("hist_append", "SELECT capture_date, count(*) AS n, count(DISTINCT symbol) AS symbols FROM (SELECT CAST(fetched_at AS DATE) AS capture_date, symbol FROM observations) GROUP BY capture_date", "observations")
def hist_append(t):
    """Two appends to a partitioned history, then one partition-pruned summary."""
    folder = scratch(t, "history")
    rows = t("observations").select("id", "symbol", "metric", "value", "fetched_at")
    C.hist_append(rows.where(F.col("metric") == "click"), folder, "observations")
    C.hist_append(rows.where(F.col("metric") != "click"), folder, "observations")
    history = t.spark.read.parquet(folder).where(F.col("dataset") == "observations")
    return history.groupBy("capture_date").agg(F.count("*").alias("n"), F.countDistinct("symbol").alias("symbols"))


@query(
    "hist_append_runs",
    "SELECT capture_date, count(*) AS n, count(DISTINCT symbol) AS symbols FROM (SELECT CAST(fetched_at AS DATE) AS capture_date, symbol FROM observations) GROUP BY capture_date",
    "observations",
)
def hist_append_runs(t):
    """Three runs, one of them repeated and one after a crash that left files, compacted: each row once."""
    log = RunLog(t.spark, scratch(t, "runs"), "observations")
    rows = t("observations").select("id", "symbol", "metric", "value", "fetched_at")
    kinds = {"clicks": F.col("metric") == "click", "views": F.col("metric") == "view", "rest": ~F.col("metric").isin("click", "view")}
    rows.withColumn("capture_date", F.to_date("fetched_at")).write.partitionBy("capture_date").parquet(f"{log.folder}/run=views")  # never committed
    for run in ("clicks", "views", "clicks", "rest"):
        log.append(rows.where(kinds[run]), run)
    log.compact("all")
    log.sweep()
    return log.read().groupBy("capture_date").agg(F.count("*").alias("n"), F.countDistinct("symbol").alias("symbols"))


# ---------------------------------------------------------------- classification


@query(
    "classify_kind",
    """SELECT capture_id, content_type, CASE capture_id % 8 WHEN 0 THEN 'html' WHEN 1 THEN 'json' WHEN 2 THEN 'json' WHEN 3 THEN 'artifact'
        WHEN 4 THEN 'xml' WHEN 5 THEN 'html' END AS kind FROM captures""",
    "captures",
)
def classify_kind(t):
    return t("captures").select("capture_id", "content_type", C.classify_kind(F.col("content_type")).alias("kind"))


_OUTCOME = r"""CASE WHEN regexp_matches(regexp_extract(endpoint, '^https?://([^/]*)', 1), '(^|\.)example\.com$') THEN
    CASE status_code WHEN 403 THEN 'blocked' WHEN 429 THEN 'rate_limited' WHEN 404 THEN 'not_found' WHEN 503 THEN 'transport'
    ELSE CASE WHEN regexp_matches(body, '(?i)<title>[^<]*(page (was )?not found|404 error)[^<]*</title>') THEN 'not_found' ELSE 'ok' END END
    ELSE 'cross_origin' END"""
_SOFT = "SELECT capture_id, endpoint, status_code, CASE WHEN length(body) % 3 = 0 THEN replace(body, '<title>', '<title>404 Error ') ELSE body END AS body FROM captures"


def _soft(t):
    soft = F.replace("body", F.lit("<title>"), F.lit("<title>404 Error "))
    return t("captures").withColumn("body", F.when(F.length("body") % 3 == 0, soft).otherwise(F.col("body")))


@query("classify_outcome", f"SELECT capture_id, {_OUTCOME} AS outcome FROM ({_SOFT})", "captures")
def classify_outcome(t):
    rows = C.classify_response(_soft(t), "example.com")
    return rows.select("capture_id", "outcome")


@query(
    "classify_tier",
    f"SELECT capture_id, CASE WHEN {_OUTCOME} <> 'ok' THEN 'UNKNOWN' WHEN status_code = 200 AND capture_id % 2 = 0 THEN 'AUTHENTICATED' ELSE 'PUBLIC' END AS access_tier FROM ({_SOFT})",
    "captures",
)
def classify_tier(t):
    rows = _soft(t).withColumn("authenticated", F.col("capture_id") % 2 == 0)
    return C.classify_response(rows, "example.com").select("capture_id", "access_tier")


# ---------------------------------------------------------------- nodes


@query(
    "x_html_links",
    r"""SELECT page_id, r.href AS href, r.label AS label FROM (SELECT page_id, unnest(list_transform(
        regexp_extract_all(html, '<a href="[^"]*">[^<]*</a>'), lambda x: {'href': regexp_extract(x, 'href="([^"]*)"', 1), 'label': regexp_extract(x, '>([^<]*)<', 1)})) AS r FROM pages)""",
)
def x_html_links(t):
    docs = D.html_documents(t("pages"), "page_id", "html")
    links = D.x_html_links(docs).where(F.col("tag") == "a")
    return links.select("page_id", "href", F.col("text").alias("label"))


@query(
    "x_links_fast",
    r"""SELECT page_id, r.href AS href, r.label AS label FROM (SELECT page_id, unnest(list_transform(
        regexp_extract_all(html, '<a href="[^"]*">[^<]*</a>'), lambda x: {'href': regexp_extract(x, 'href="([^"]*)"', 1), 'label': regexp_extract(x, '>([^<]*)<', 1)})) AS r FROM pages)""",
)
def x_links_fast(t):
    return D.x_links_fast(t("pages"), "page_id", "html").select("page_id", "href", F.col("text").alias("label"))


@query(
    "x_html_cells",
    """SELECT CAST(floor(k / 20) AS BIGINT) AS capture_id, u.head, u.display FROM securities, LATERAL (VALUES ('No.', CAST(k + 1 AS VARCHAR)), ('Ticker', symbol), ('Company', company),
        ('Sector', sector), ('Market Cap', volume * 7 || '.25M'), ('Change %', volume || '.5%'), ('Volume', format('{:,}', volume * 1234))) AS u(head, display)""",
    "securities",
)
def x_html_cells(t):
    docs = P.documents(t("screen_docs"))
    cells = D.x_html_cells(docs).where(F.col("tag") == "td")
    return cells.select("capture_id", "head", F.col("text").alias("display"))


@query(
    "header_cell_join",
    "SELECT CAST(floor(k / 20) AS BIGINT) AS capture_id, symbol, sector, volume * 7 || '.25M' AS cap FROM securities",
    "securities",
)
def header_cell_join(t):
    """Cells beside their header labels: a lookup inside the row, no join at all."""
    rows = P.table_rows(P.documents(t("screen_docs")), "screener_table")
    return rows.select("capture_id", P.cell("Ticker").alias("symbol"), P.cell("Sector").alias("sector"), P.cell("Market Cap").alias("cap"))


@query(
    "x_fingerprint",
    r"""SELECT page_id, sha256(array_to_string(list_transform(regexp_extract_all(regexp_replace(regexp_replace(html, '(?s)<script[^>]*>.*?</script>', '<script>', 'g'), '(?s)<!--.*?-->', '', 'g'),
        '<[a-zA-Z][^>]*>'), lambda x: lower(regexp_extract(x, '<([a-zA-Z0-9]+)', 1)) || '.' || regexp_extract(x, 'class="([^"]*)"', 1)), chr(10))) AS fingerprint FROM pages""",
)
def x_fingerprint(t):
    return D.x_fingerprint(D.html_documents(t("pages"), "page_id", "html", skeleton=True))


def _script_docs(t):
    payload = F.concat(
        F.lit('{"key":'), "p_partkey", F.lit(',"name":"a } b \\" '), "p_name", F.lit('","list":[1,{"size":'), "p_size", F.lit("}]}"),
    )
    return t("part").select("p_partkey", F.concat(F.lit("<script>window.init( "), payload, F.lit(", {}); }</script>")).alias("body"))


@query("x_embedded_json", "SELECT p_partkey, p_partkey AS key, 'a } b \" ' || p_name AS name, p_size AS size FROM part")
def x_embedded_json_(t):
    found = _script_docs(t).select("p_partkey", x_embedded_json(F.col("body"), r"window\.init\(").alias("j"))
    return found.select(
        "p_partkey",
        F.get_json_object("j", "$.key").cast("bigint").alias("key"),
        F.get_json_object("j", "$.name").alias("name"),
        F.get_json_object("j", "$.list[1].size").cast("int").alias("size"),
    )


# ---------------------------------------------------------------- screens, groups, markets


@query(
    "x_screener_table",
    f"""SELECT CAST(floor(k / 20) AS BIGINT) AS capture_id, k + 1 AS rank, symbol, company, sector, CAST(volume * 7 || '.25e6' AS DOUBLE) AS market_cap,
        CAST(volume || '.5' AS DOUBLE) / 100 AS change_percent, volume * 1234 AS volume, CAST(floor(k / 20) AS BIGINT) * 20 + 1 AS page_start, CAST(1234 AS BIGINT) AS total_rows, TIMESTAMP '{FETCHED}' AS fetched_at FROM securities""",
    "securities",
)
def x_screener_table(t):
    rows = P.x_screener_table(P.documents(t("screen_docs"), carry=("fetched_at",)))
    return plain(P.screener_table(rows, ["No.", "Ticker", "Company", "Sector", "Market Cap", "Change %", "Volume"]))


_CAP = "CASE WHEN market_cap >= 1e6 THEN format('{:.2f}T', market_cap / 1e6) WHEN market_cap >= 1000 THEN format('{:.2f}B', market_cap / 1000) ELSE format('{:.2f}M', market_cap) END"


@query(
    "x_screener_json",
    f"""SELECT CAST(floor(k / 20) AS BIGINT) AS capture_id, k + 1 AS rank, symbol, company || '|' || sector || '|' || {_CAP} || '|' || format('{{:.4g}}%', rsi) || '|'
        || format('{{:,}}', volume * 1234) || '|' || strftime(earnings_date, '%b %-d, %Y AMC') AS displays, CAST(floor(k / 20) AS BIGINT) * 20 + 1 AS page_start,
        'No.|Ticker|Company|Sector|Market Cap|Change %|Volume|Earnings Date' AS heads FROM securities""",
    "securities",
)
def x_screener_json(t):
    rows = P.x_screener_json(P.documents(t("json_docs")))
    shown = F.transform(F.slice("cells", 3, F.size("cells")), lambda c: c)
    return rows.select(
        "capture_id", "rank", "symbol", F.array_join(shown, "|").alias("displays"), "page_start", F.array_join("heads", "|").alias("heads")
    )


@query("x_screener_json_typed", "SELECT symbol, sector, market_cap, CAST(volume * 1234 AS DOUBLE) AS volume FROM securities", "securities")
def x_screener_json_typed(t):
    return P.screener_json_typed(P.documents(t("json_docs")), ["sector", "marketCap", "volume"]).drop("capture_id")


def _group_docs(t):
    """Group tables in chunks of ten parts, header and rows from the part's fields."""
    row = F.struct(
        "p_partkey",
        F.concat(
            F.lit("<tr><td>"), F.col("p_partkey") + 2, F.lit("<td>"), "p_name", F.lit("<td>"), "p_size", F.lit("<td>"), "p_size",
            F.lit(".50B<td>-<td>"), "p_size", F.lit(".25%<td>+"), "p_size", F.lit("</tr>"),
        ).alias("html"),
    )
    chunks = t("part").groupBy(F.floor(F.col("p_partkey") / 10).cast("bigint").alias("capture_id"))
    rows = chunks.agg(F.array_sort(F.collect_list(row)).alias("rows"))  # ten unique keys at most
    head = '<table class="groups_table"><thead><tr><th>No.<th>{}<th>{}<th>{}<th>P/E<th>{}<th>{}</tr></thead>'
    return rows, head


@query(
    "x_groups_table",
    "SELECT p_partkey + 2 AS rank, p_name AS name, CAST(p_size AS BIGINT) AS stocks, CAST(p_size AS VARCHAR) AS stocks_raw, p_size * 1e9 + 5e8 AS market_cap, p_size || '.50B' AS market_cap_raw, CAST(NULL AS DOUBLE) AS p_per_e, '-' AS p_per_e_raw, CAST(p_size || '.25' AS DOUBLE) / 100 AS dividend, p_size || '.25%' AS dividend_raw, '+' || p_size AS odd FROM part",
)
def x_groups_table(t):
    rows, head = _group_docs(t)
    body = F.concat(F.lit(head.format("Name", "Stocks", "Market Cap", "Dividend", "Odd")), F.array_join("rows.html", ""), F.lit("</table>"))
    docs = P.documents(rows.select("capture_id", body.alias("body")))
    labels = ["No.", "Name", "Stocks", "Market Cap", "P/E", "Dividend", "Odd"]
    return P.groups_table(P.x_groups_table(docs), labels).drop("capture_id")


_MARKET = "SELECT p_partkey + 2 AS rank, CAST(p_size AS VARCHAR) AS name, p_name AS ticker, CAST(NULL AS DOUBLE) AS price, CAST(p_size || '.25' AS DOUBLE) / 100 AS perf_day, CAST(p_size AS DOUBLE) AS perf_week, '-' AS price_raw, p_size || '.25%' AS perf_day_raw, '+' || p_size AS perf_week_raw FROM part"


def _market_docs(t):
    rows, head = _group_docs(t)
    body = F.concat(
        F.lit(head.replace("<th>P/E", "<th>Price").format("Ticker", "Name", "Cap", "Perf Day", "Perf Week").replace("<th>Cap", "")),
        F.regexp_replace(F.array_join("rows.html", ""), r"<td>[0-9]+\.50B", ""),
        F.lit("</table>"),
    )
    return P.documents(rows.select("capture_id", body.alias("body")))


@query("x_market_table", "SELECT rank, ticker AS identity, name, CAST(6 AS INTEGER) AS n_cells FROM (" + _MARKET + ")")
def x_market_table(t):
    rows = P.x_market_table(_market_docs(t)).where("row_ok")
    return rows.select("rank", "identity", "name", F.size("cells").alias("n_cells"))


@query("perf_table", _MARKET)
def perf_table(t):
    labels = ["No.", "Ticker", "Name", "Price", "Perf Day", "Perf Week"]
    return P.perf_table(P.x_market_table(_market_docs(t)), "Ticker", labels).drop("capture_id")


@query("dq_arity", "SELECT p_partkey AS capture_id, CAST(2 AS INTEGER) AS n_cells, CAST(3 AS INTEGER) AS n_heads FROM part WHERE p_size % 2 = 0")
def dq_arity(t):
    short = F.when(F.col("p_size") % 2 == 0, F.lit("")).otherwise(F.lit("<td>c"))
    body = F.concat(F.lit("<table class='screener_table'><tr><th>A<th>B<th>C</tr><tr><td>a<td>b"), short, F.lit("</tr></table>"))
    docs = P.documents(t.spread("part").select(F.col("p_partkey").alias("capture_id"), body.alias("body")))
    return P.dq_arity(P.table_rows(docs, "screener_table")).select("capture_id", "n_cells", "n_heads")


@query("dq_header", "SELECT p_partkey AS capture_id, CASE WHEN p_size % 2 = 0 THEN 'Name' ELSE 'No.|Name' END AS missing FROM part")
def dq_header(t):
    label = F.when(F.col("p_size") % 2 == 0, F.lit("No.")).otherwise(F.lit("Nr"))
    body = F.concat(F.lit("<table class=groups_table><thead><tr><th>"), label, F.lit("<th>Title</tr></thead></table>"))
    docs = P.documents(t.spread("part").select(F.col("p_partkey").alias("capture_id"), body.alias("body")))
    return P.dq_header(docs, "groups_table", ["No.", "Name"]).select("capture_id", F.array_join("missing_headers", "|").alias("missing"))


@query(
    "x_spectrum_ref",
    "SELECT p_partkey AS capture_id, 'https://img.example/s' || p_partkey || CASE WHEN p_size % 3 = 1 THEN '.PNG' ELSE '.gif' END AS source_url, CASE WHEN p_size % 3 = 1 THEN 'image/png' ELSE 'image' END AS media_type FROM part WHERE p_size % 3 > 0",
)
def x_spectrum_ref(t):
    size = F.col("p_size") % 3
    image = F.concat(
        F.lit('<img class="big groups_spectrum-image" src="//img.example/s'), "p_partkey", F.when(size == 1, F.lit('.PNG">')).otherwise(F.lit('.gif">'))
    )
    body = F.concat(image, F.when(size == 0, image).otherwise(F.lit("")))
    docs = P.documents(t.spread("part").select(F.col("p_partkey").alias("capture_id"), body.alias("body")))
    return P.x_spectrum_ref(docs).select("capture_id", "source_url", "media_type")


# ---------------------------------------------------------------- quote pages


def _quotes(t, region: str | None = None):
    return P.quote_documents(P.documents(t("quote_docs"), carry=("fetched_at",), **(P.region_reads(region) if region else {})))


_Q = "'P' || p_partkey AS symbol"
_DAY = "(DATE '2000-01-01' + p_size)"


@query("x_quote_header", f"SELECT {_Q}, p_name AS company, p_type AS sector, p_brand AS industry, CAST(NULL AS VARCHAR) AS country, 'NASDAQ' AS exchange FROM part")
def x_quote_header(t):
    return P.x_quote_header(_quotes(t)).drop("capture_id", "fetched_at")


@query(
    "x_quote_snapshot",
    f"""SELECT {_Q}, CASE WHEN p_size > 25 THEN 'DJIA, S&P 500' END AS index_membership, CAST(p_partkey || '.50e9' AS DOUBLE) AS market_cap, CAST(p_size || '.25' AS DOUBLE) AS pe_ratio,
        CAST(p_size || '.5' AS DOUBLE) AS change, CAST(0.0125 AS DOUBLE) AS change_percent, CAST(p_size || '.75' AS DOUBLE) / 100 AS dividend_yield, {_DAY} AS ex_dividend_date,
        strftime({_DAY}, '%b %-d, %Y') AS ex_dividend_date_raw, p_partkey * 1000 AS volume, CAST(p_size || '.50' AS DOUBLE) AS price, CAST(NULL AS DOUBLE) AS beta, CAST(p_size AS BIGINT) AS employees,
        '{{"Odd Ratio":"' || p_size || 'x"}}' AS extra FROM part""",
)
def x_quote_snapshot(t):
    built = build_dataset(P.x_quote_snapshot(_quotes(t)).drop("capture_id"), "quote_snapshot", extra="extra")
    return built.select(
        "symbol", "index_membership", "market_cap", "pe_ratio", "change", "change_percent", "dividend_yield", "ex_dividend_date",
        "ex_dividend_date_raw", "volume", "price", "beta", "employees", H.canonical_map(F.col("extra_fields")).alias("extra"),
    )


@query(
    "snapshot_label_value",
    f"""SELECT {_Q}, CAST(u.t AS INTEGER) AS table_no, u.label, u.value FROM part, LATERAL (VALUES (1, 'Index', CASE WHEN p_size > 25 THEN 'DJIA, S&P 500' ELSE '-' END), (1, 'Market Cap', p_partkey || '.50B'),
        (2, 'P/E', p_size || '.25'), (2, 'Change', p_size || '.5 (1.25%)'), (3, 'Dividend TTM', '1.5 (' || p_size || '.75%)'), (3, 'Dividend Ex-Date', strftime({_DAY}, '%b %-d, %Y')),
        (4, 'Volume', format('{{:,}}', p_partkey * 1000)), (4, 'Price', p_size || '.50'), (5, 'Odd Ratio', p_size || 'x'), (6, 'Beta', '-'), (6, 'Employees', CAST(p_size AS VARCHAR))) AS u(t, label, value)""",
)
def snapshot_label_value(t):
    return P.snapshot_label_value(_quotes(t)).drop("pos")


@query("x_quote_description", f"SELECT {_Q}, 'About ' || p_name || ' & co' AS description FROM part")
def x_quote_description(t):
    return P.x_quote_description(_quotes(t)).drop("fetched_at")


@query(
    "x_quote_ratings",
    f"SELECT {_Q}, timezone('UTC', timezone('America/New_York', CAST({_DAY} AS TIMESTAMP))) AS published_at, 'Upgrade' AS status, 'Desk ' || p_size AS analyst, 'Hold' AS rating_raw, CAST(p_size AS DOUBLE) AS price_target, '$' || p_size AS price_target_raw, strftime({_DAY}, '%b-%d-%y') AS published_at_raw FROM part",
)
def x_quote_ratings(t):
    built = build_dataset(P.x_quote_ratings(_quotes(t, "ratings")), "quote_ratings")
    return plain(built.select("symbol", "published_at", "status", "analyst", "rating_raw", "price_target", "price_target_raw", "published_at_raw"))


@query(
    "x_quote_news",
    f"SELECT {_Q}, timezone('UTC', timezone('America/New_York', CAST({_DAY} AS TIMESTAMP) + INTERVAL 975 MINUTE)) AS published_at, 'exact' AS published_at_status, 'News of P' || p_partkey AS title, '/n/' || p_partkey AS url, 'Wire' AS publisher FROM part",
)
def x_quote_news(t):
    built = build_dataset(P.x_quote_news(_quotes(t, "news")), "quote_news")
    return plain(built.select("symbol", "published_at", "published_at_status", "title", "url", "publisher"))


@query(
    "x_quote_insider",
    f"SELECT {_Q}, 'Owner ' || p_size AS owner, 'CEO' AS relationship, {_DAY} AS transaction_date, 'Sale' AS transaction_type, CAST(p_size || '.50' AS DOUBLE) AS cost, p_partkey * 1000.0::DOUBLE AS shares, CAST(p_partkey || '.50e9' AS DOUBLE) AS value, 1000.0::DOUBLE AS shares_total, '/f4/' || p_partkey AS sec_form_url FROM part",
)
def x_quote_insider(t):
    built = build_dataset(P.x_quote_insider(_quotes(t, "insider")), "quote_insider")
    return built.select("symbol", "owner", "relationship", "transaction_date", "transaction_type", "cost", "shares", "value", "shares_total", "sec_form_url")


@query(
    "x_quote_peers",
    f"SELECT {_Q}, 'X' || p_partkey AS peer, CAST(1 AS BIGINT) AS rank, CAST(p_partkey || '.50e9' AS DOUBLE) AS market_cap FROM part UNION ALL SELECT {_Q}, 'Y' || p_partkey, 2, NULL FROM part",
)
def x_quote_peers(t):
    return build_dataset(P.x_quote_peers(_quotes(t)), "quote_peers").select("symbol", "peer", "rank", "market_cap")


@query(
    "x_quote_etf_holders",
    f"SELECT {_Q}, 'E' || p_partkey AS etf, CAST(1 AS BIGINT) AS rank, CAST(p_partkey || '.50e9' AS DOUBLE) AS aum, 'AUM: ' || p_partkey || '.50B' AS aum_raw FROM part",
)
def x_quote_etf_holders(t):
    return build_dataset(P.x_quote_etf_holders(_quotes(t)), "quote_etf_holders").select("symbol", "etf", "rank", "aum", "aum_raw")


@query("x_quote_signals", f"SELECT {_Q}, 'Signal ' || p_size AS signal, '/screener?s=x' || p_size AS url FROM part")
def x_quote_signals(t):
    return build_dataset(P.x_quote_signals(_quotes(t)), "quote_signals").select("symbol", "signal", "url")


@query("x_chart_refs", f"SELECT {_Q}, CASE WHEN p_size > 25 THEN 'w' ELSE 'd' END AS timeframe, 'image/png' AS media_type FROM part")
def x_chart_refs(t):
    return P.x_chart_refs(_quotes(t)).select("symbol", "timeframe", "media_type")


@query("missing_region", f"SELECT {_Q}, CASE WHEN p_size % 2 = 0 THEN 'news|peers' ELSE '' END AS missing, CASE WHEN p_size % 2 = 0 THEN 'PARTIAL' ELSE 'COMPLETE' END AS status FROM part")
def missing_region(t):
    """Pages of even-sized parts lose their news table and their peers link."""
    cut = F.replace(F.replace("body", F.lit("news-table"), F.lit("old-table")), F.lit(">Peers<"), F.lit(">Pears<"))
    docs = t("quote_docs").join(t("part").select(F.col("p_partkey").alias("capture_id"), "p_size"), "capture_id")
    docs = docs.withColumn("body", F.when(F.col("p_size") % 2 == 0, cut).otherwise(F.col("body")))
    quotes = P.quote_documents(P.documents(docs, carry=("fetched_at",)))
    return P.missing_region(quotes).select("symbol", F.array_join("missing_regions", "|").alias("missing"), "status")


@query(
    "bundle_fanout",
    """SELECT 'charts' AS relation, count(*) AS n FROM part UNION ALL SELECT 'description', count(*) FROM part UNION ALL SELECT 'etf_holders', count(*) FROM part UNION ALL SELECT 'header', count(*) FROM part
    UNION ALL SELECT 'insider', count(*) FROM part UNION ALL SELECT 'news', count(*) FROM part UNION ALL SELECT 'peers', 2 * count(*) FROM part UNION ALL SELECT 'ratings', count(*) FROM part
    UNION ALL SELECT 'regions', count(*) FROM part UNION ALL SELECT 'signals', count(*) FROM part UNION ALL SELECT 'snapshot', count(*) FROM part UNION ALL SELECT 'snapshot_tables', 11 * count(*) FROM part""",
)
def bundle_fanout(t):
    """Row counts of every relation over one stored parse."""
    docs = stored_quotes(t, t("quote_docs"))
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("relation"), "n") for name, df in P.bundle_fanout(docs).items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query(
    "quote_projections",
    f"SELECT {_Q}, 'X' || p_partkey AS peer, CAST(1 AS BIGINT) AS rank, 'quote' AS projected_from FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R') UNION ALL SELECT {_Q}, 'Y' || p_partkey, 2, 'quote' FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R')",
)
def quote_projections(t):
    """Peers of the symbols requested by returned lines, first requests first."""
    requests = t("lineitem").where(F.col("l_returnflag") == "R").select(
        F.col("l_orderkey").alias("position"), F.concat(F.lit(" p"), "l_partkey").alias("requested")
    )
    quotes = P.quote_documents(P.documents(t("quote_docs"), carry=("fetched_at",), **P.QUOTE_READS))
    bundle = {"peers": build_dataset(P.x_quote_peers(quotes), "quote_peers")}
    return A.quote_projection(bundle, "peers", requests).select("symbol", "peer", "rank", "projected_from")


# ---------------------------------------------------------------- news, insider, disclosure


def _news_table(css: str, *rows) -> list:
    out: list = [f'<table class="{css}">']
    for when, key, icon in rows:
        out += ['<tr><td class="news_date-cell">', when, '<td class="news_link-cell"><a class="nn-tab-link" href="/n/', key, '">T ', key, "</a>"]
        out += [f'<svg><use href="/i.svg#{icon}-light"></use></svg>'] if icon else []
        out.append("</tr>")
    return [*out, "</table>"]


def _concat(parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _news_docs(t):
    key = F.col("s_suppkey").cast("string")
    minutes, days = F.concat(F.col("s_nationkey"), F.lit(" min")), F.concat(F.col("s_nationkey"), F.lit(" days"))
    heads = '<span class="news-calendar_heading">{}</span>'
    body = _concat(
        ['<div id="news">', heads.format("News"), heads.format("Blogs")]
        + _news_table("styled-table-new table-fixed", (minutes, key, "wire"), ("05:25AM", key, None))
        + _news_table("styled-table-new table-fixed", (days, key, "blog"))
        + ["</div>"]
    )
    return t.spread("supplier").select(F.col("s_suppkey").alias("capture_id"), stamped(), body.alias("body"))


_F = f"TIMESTAMP '{FETCHED}'"


@query(
    "x_global_news",
    f"""SELECT 'news' AS category, 'T ' || s_suppkey AS title, '{ORIGIN}/n/' || s_suppkey AS url, 'wire' AS publisher, {_F} - to_minutes(s_nationkey) AS published_at, s_nationkey || ' min' AS published_at_raw, 'relative' AS published_at_status FROM supplier
    UNION ALL SELECT 'news', 'T ' || s_suppkey, '{ORIGIN}/n/' || s_suppkey, NULL, TIMESTAMP '2001-08-02 09:25:00', '05:25AM', 'anchored' FROM supplier
    UNION ALL SELECT 'blogs', 'T ' || s_suppkey, '{ORIGIN}/n/' || s_suppkey, 'blog', {_F} - to_days(s_nationkey), s_nationkey || ' days', 'relative' FROM supplier""",
)
def x_global_news(t):
    return plain(A.global_news(_news_docs(t), ORIGIN), "fetched_at")


@query("x_publisher_news", f"SELECT 'T ' || s_suppkey AS title, '{ORIGIN}/n/' || s_suppkey AS url, 'slug-x' AS publisher, 'Aug-' || (s_nationkey + 1) AS published_at_raw, 'date_only' AS published_at_status, CAST(NULL AS TIMESTAMP) AS published_at FROM supplier")
def x_publisher_news(t):
    key = F.col("s_suppkey").cast("string")
    day = F.concat(F.lit("Aug-"), F.col("s_nationkey") + 1)
    body = _concat(_news_table("table-fixed", (day, key, None)))
    docs = t.spread("supplier").select(F.col("s_suppkey").alias("capture_id"), stamped(), body.alias("body"))
    return plain(A.publisher_news(docs, "slug-x", ORIGIN), "fetched_at")


def _insider_docs(t):
    return _insider_pages(t.spread("part"))


def _insider_pages(parts, *keep: str):
    ticker = F.when(F.col("p_size") % 5 == 0, F.lit("")).otherwise(F.concat(F.lit('<a href="/q">P'), "p_partkey", F.lit("</a>")))
    day = F.date_format(F.date_add(F.lit("2000-01-01").cast("date"), F.col("p_size")), "MMM dd ''yy")
    heads = "".join(f"<th>{h}" for h in P.INSIDER_HEADS)
    body = _concat(
        [f'<table id="insider-table"><thead><tr>{heads}</tr></thead><tr><td>', ticker, "<td>", F.col("p_brand"), "<td>Dir<td>", day,
         "<td>Buy<td>", F.col("p_size").cast("string"), ".50<td>1,000<td>", F.col("p_size").cast("string"), "K<td>2,000<td><a href='/f/",
         F.col("p_partkey").cast("string"), "'>f</a></tr></table>"]
    )
    return parts.select(F.col("p_partkey").alias("capture_id"), stamped(), body.alias("body"), *keep)


@query(
    "x_global_insider",
    f"SELECT {_Q}, p_brand AS owner, {_DAY} AS transaction_date, 'Buy' AS transaction_type, CAST(p_size || '.50' AS DOUBLE) AS cost, p_size * 1000.0::DOUBLE AS value, '/f/' || p_partkey AS sec_form_url FROM part WHERE p_size % 5 <> 0",
)
def x_global_insider(t):
    rows, _ = A.global_insider(_insider_docs(t))
    return rows.select("symbol", "owner", "transaction_date", "transaction_type", "cost", "value", "sec_form_url")


@query("x_global_insider_skipped", "SELECT p_partkey AS capture_id, p_brand AS owner FROM part WHERE p_size % 5 = 0")
def x_global_insider_skipped(t):
    _, skipped = A.global_insider(_insider_docs(t))
    return skipped.select("capture_id", "owner")


@query("x_disclosure", "SELECT p_partkey AS capture_id, '{\"name\":\"' || p_name || '\",\"holdings\":[{\"size\":' || p_size || '}]}' AS details, '2001-03-31|2001-06-30' AS report_dates FROM part")
def x_disclosure(t):
    body = F.concat(
        F.lit('<script>{"initialFundDetailsData":{"name":"'), "p_name", F.lit('","holdings":[{"size":'), "p_size",
        F.lit('}]},"initialFundReportDates":["2001-03-31","2001-06-30"]}</script>'),
    )
    docs = t.spread("part").select(F.col("p_partkey").alias("capture_id"), stamped(), body.alias("body"))
    return A.disclosure(docs, "fund").select("capture_id", "details", F.array_join("report_dates", "|").alias("report_dates"))


# ---------------------------------------------------------------- what the families refuse


def _broken_table(t, css: str, second: str):
    """A page per part: sound, with another header, with a rank that is none, or without the table."""
    kind = F.col("p_size") % 4
    body = _concat(
        [F.when(kind == 3, F.lit("<table class=other>")).otherwise(F.lit(f"<table class={css}>")), "<thead><tr><th>",
         F.when(kind == 1, F.lit("Nr")).otherwise(F.lit("No.")), f"<th>{second}</thead><tr><td>", F.when(kind == 2, F.lit("first")).otherwise(F.lit("7")),
         "<td>", F.col("p_name"), "</table>"]
    )
    return t.spread("part").select(F.col("p_partkey").alias("capture_id"), stamped(), body.alias("body"))


def _with_sizes(t):
    """Parts with the sizes of their key, joined before bodies are spelled and dealt out like ``Tables.spread``."""
    sizes = t("part").select("p_partkey", F.col("p_size").alias("_kind"))
    return t("part").join(sizes.hint("merge"), "p_partkey").repartition(int(t.spark.conf.get("spark.sql.shuffle.partitions")))


def _broken_quotes(t):
    """Stock pages that lack a rating's cell, a news link, an insider cell or their symbol, by size."""
    kind, body = F.col("_kind") % 4, F.col("body")
    changes = {0: ("<td>Hold", ""), 1: ("tab-link-news", "tab-link-old"), 2: ("<td>CEO", ""), 3: ("data-ticker=", "data-other=")}
    for k, (old, new) in changes.items():
        body = F.when(kind == k, F.replace("body", F.lit(old), F.lit(new))).otherwise(body)
    return quote_pages(_with_sizes(t), "_kind").select("capture_id", "fetched_at", body.alias("body"))


def _broken_insider(t):
    body = F.when(F.col("_kind") % 5 == 1, F.replace("body", F.lit("<th>Cost"), F.lit("<th>Price"))).otherwise(F.col("body"))
    return _insider_pages(_with_sizes(t), "_kind").select("capture_id", "fetched_at", body.alias("body"))


def _broken_news(t):
    at = F.col("capture_id") % 3
    changed = F.when(at == 1, F.replace("body", F.lit("05:25AM"), F.lit("some day"))).when(at == 2, F.replace("body", F.lit("nn-tab-link"), F.lit("other")))
    return _news_docs(t).withColumn("body", changed.otherwise(F.col("body")))


def _broken_funds(t):
    root = F.when(F.col("p_size") % 2 == 0, F.lit("initialFundDetailsData")).otherwise(F.lit("details"))
    body = F.concat(F.lit('<script>{"'), root, F.lit('":{"name":"'), "p_name", F.lit('"}}</script>'))
    return t.spread("part").select(F.col("p_partkey").alias("capture_id"), stamped(), body.alias("body"))


def _broken_spectra(t):
    image = '<img class="groups_spectrum-image" src="//img.example/s.png">'
    body = F.repeat(F.lit(image), (F.col("p_size") % 3).cast("int"))
    return t.spread("part").select(F.col("p_partkey").alias("capture_id"), stamped(), body.alias("body"))


_TABLE_ERRORS = """SELECT '{0}' AS family, CASE p_size % 4 WHEN 1 THEN 'unexpected header' WHEN 2 THEN 'rank or cell count' WHEN 3 THEN 'no table' END AS problem, count(*) AS n FROM part GROUP BY ALL"""
_QUOTE_ERRORS = "SELECT '{0}', CASE WHEN p_size % 4 = {1} THEN '{2}' END, count(*) FROM part WHERE {3} GROUP BY ALL"


@query(
    "page_errors",
    " UNION ALL ".join(
        [
            _TABLE_ERRORS.format("groups"),
            _TABLE_ERRORS.format("market"),
            "SELECT 'spectrum', CASE WHEN p_size % 3 <> 1 THEN 'not one spectrum image' END, count(*) FROM part GROUP BY ALL",
            _QUOTE_ERRORS.format("stock", 3, "no symbol", "true"),
            _QUOTE_ERRORS.format("ratings", 0, "short row", "p_size % 4 <> 3"),
            _QUOTE_ERRORS.format("stock_news", 1, "no link", "p_size % 4 <> 3"),
            _QUOTE_ERRORS.format("stock_insider", 2, "short row", "p_size % 4 <> 3"),
            "SELECT 'global_news', CASE s_suppkey % 3 WHEN 1 THEN CASE WHEN i = 1 THEN 'unknown time' END WHEN 2 THEN 'no link' END, count(*) FROM supplier, range(3) r(i) GROUP BY ALL",
            "SELECT 'publisher_news', CASE s_suppkey % 3 WHEN 1 THEN CASE WHEN i = 1 THEN 'unknown time' END WHEN 2 THEN 'no link' END, count(*) FROM supplier, range(3) r(i) GROUP BY ALL",
            "SELECT 'global_insider', CASE p_size % 5 WHEN 0 THEN 'no ticker' WHEN 1 THEN 'unexpected header' END, count(*) FROM part GROUP BY ALL",
            "SELECT 'fund', CASE WHEN p_size % 2 = 1 THEN 'no portfolio' END, count(*) FROM part GROUP BY ALL",
        ]
    ),
)
def page_errors(t):
    """Accepted rows (null problem) and refused ones of eleven families: both halves are all rows."""
    quotes, news = stored_quotes(t, _broken_quotes(t)), stored(t, _broken_news(t), "news", **P.NEWS_READS)
    groups, market = (stored(t, _broken_table(t, "groups_table", second), name, **P.GROUP_READS) for second, name in (("Name", "groups"), ("Ticker", "market")))
    sources = {
        "groups": groups, "market": market, "spectrum": stored(t, _broken_spectra(t), "spectra", **P.SPECTRUM_READS),
        "stock": quotes, "ratings": quotes, "stock_news": quotes, "stock_insider": quotes, "global_news": news, "publisher_news": news,
        "global_insider": stored(t, _broken_insider(t), "insider", **P.INSIDER_READS), "fund": stored(t, _broken_funds(t), "funds", **P.DISCLOSURE_READS),
    }
    named = lambda df: P.quote_documents(df).where(F.col("symbol").isNotNull())
    kept = {
        "groups": lambda df: P.x_groups_table(df).where("row_ok"), "market": lambda df: P.x_market_table(df).where("row_ok"),
        "spectrum": P.x_spectrum_ref, "stock": named, "ratings": lambda df: P.x_quote_ratings(named(df)),
        "stock_news": lambda df: P.x_quote_news(named(df)), "stock_insider": lambda df: P.x_quote_insider(named(df)),
        "global_news": lambda df: A.global_news(df, ORIGIN), "publisher_news": lambda df: A.publisher_news(df, "slug-x", ORIGIN),
        "global_insider": lambda df: A.global_insider(df)[0], "fund": lambda df: A.disclosure(df, "fund"),
    }
    parts = []
    for family, pages in sources.items():
        parts.append(A.page_errors(pages, family).select(F.lit(family).alias("family"), "problem"))
        parts.append(kept[family](pages).select(F.lit(family).alias("family"), F.lit(None).cast("string").alias("problem")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.groupBy("family", "problem").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- calendar, tiles, futures, maps


def _release_docs(t, section: str, field: str):
    """Two payload generations by key parity; one entry per order."""
    entry = F.concat(
        F.lit('{"ticker":"O'), "o_orderkey", F.lit('","event":"E'), "o_custkey", F.lit('","category":null,"date":"'),
        F.date_format("o_orderdate", "yyyy-MM-dd"), F.when(F.col("o_orderkey") % 3 > 0, F.lit("T08:30:00")).otherwise(F.lit("")),
        F.lit('","reference":"Jul","referenceDate":"2001-07-31","actual":"'), F.col("o_custkey") % 9, F.lit('.2%","previous":"'),
        "o_custkey", F.lit('K","forecast":null,"importance":3,"allDay":false}'),
    )
    new = F.concat(F.lit(f'<script type="application/json" data-ssr-props="x"> {{"{section}":{{"{field}":['), entry, F.lit("]}} </script>"))
    old = F.concat(F.lit(f'<script id="route-init-data" type="application/json">{{"data":{{"{field}":['), entry, F.lit("]}}</script>"))
    body = F.when(F.col("o_orderkey") % 2 == 0, new).otherwise(old)
    return t.spread("orders").select(F.col("o_orderkey").alias("capture_id"), stamped(), body.alias("body"))


_RELEASE = f"""SELECT 'O' || o_orderkey AS symbol, 'E' || o_custkey AS event, CAST(o_orderdate AS DATE) AS release_date,
    strftime(o_orderdate, '%Y-%m-%d') || CASE WHEN o_orderkey % 3 > 0 THEN 'T08:30:00' ELSE '' END AS release_date_raw,
    CASE WHEN o_orderkey % 3 > 0 THEN '08:30' END AS release_time,
    CASE WHEN o_orderkey % 3 > 0 THEN timezone('UTC', timezone('America/New_York', date_trunc('day', o_orderdate) + INTERVAL 510 MINUTE)) END AS release_timestamp,
    CAST(3 AS BIGINT) AS importance, DATE '2001-07-31' AS reference_date, CAST((o_custkey % 9) || '.2' AS DOUBLE) AS actual, CAST(o_custkey || 'e3' AS DOUBLE) AS previous FROM orders"""
_RELEASE_COLUMNS = ("symbol", "event", "release_date", "release_date_raw", "release_time", "release_timestamp", "importance", "reference_date", "actual", "previous")


@query("x_calendar", _RELEASE)
def x_calendar(t):
    return plain(A.calendar(_release_docs(t, "economic", "entries")).select(*_RELEASE_COLUMNS))


@query("x_calendar_detail", _RELEASE)
def x_calendar_detail(t):
    return plain(A.calendar_detail(_release_docs(t, "economicDetail", "table")).select(*_RELEASE_COLUMNS))


@query(
    "x_tiles",
    "SELECT 'V' || vec_id AS ticker, 'L' || label AS label, label + 0.5::DOUBLE AS last, (vec_id % 100) / 100 AS change, CAST(len(embedding) AS INTEGER) AS n_points, list_sum(list_transform(embedding, lambda x: CAST(trunc(CAST(x AS DOUBLE) * 1000) AS INTEGER)))::DOUBLE AS points, 'odd' AS extra FROM embeddings",
)
def x_tiles(t):
    ints = F.transform("embedding", lambda x: (x.cast("double") * 1000).cast("int"))
    tile = F.concat(
        F.lit('{"V'), "vec_id", F.lit('":{"label":"L'), "label", F.lit('","ticker":"V'), "vec_id", F.lit('","last":'), "label", F.lit('.5,"change":'),
        F.col("vec_id") % 100, F.lit(',"changeUsd":0.1,"prevClose":1,"high":2,"low":0,"sparkline":'), F.to_json(ints), F.lit(',"brandNew":"odd"}}'),
    )
    body = F.concat(F.lit("<script>window.addEventListener('init', () => window.InitTiles("), tile, F.lit("));</script>"))
    docs = t("embeddings").select(F.col("vec_id").alias("capture_id"), stamped(), body.alias("body"))
    rows, _ = A.market_tiles(docs, r"InitTiles\(")
    return rows.select(
        "ticker",
        "label",
        F.col("last").cast("double").alias("last"),
        "change",
        F.size("sparkline").alias("n_points"),
        F.aggregate("sparkline", F.lit(0.0), lambda a, x: a + x).alias("points"),
        F.col("extra_fields")["brandNew"].alias("extra"),
    )


@query(
    "x_futures",
    "SELECT 'S' || s_suppkey AS symbol, s_name AS name, n_name AS category, CAST(s_suppkey || '.5' AS DOUBLE) AS last, CAST(s_nationkey AS DOUBLE) / 100 AS change_percent, '[1,2]' AS sparkline, CAST(15 AS DOUBLE) AS delay_minutes, '{\"cot\":\"x\"}' AS extra FROM supplier JOIN nation ON s_nationkey = n_nationkey",
)
def x_futures(t):
    rows = t("supplier").join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    body = F.concat(
        F.lit('<script>var groups = [{"label":"'), "n_name", F.lit('","contracts":[{"ticker":"S'), "s_suppkey",
        F.lit('"}]},{"label":"Later","contracts":[{"ticker":"S'), "s_suppkey", F.lit('"}]}];\nvar tiles = {"S'), "s_suppkey",
        F.lit('":{"label":"'), "s_name", F.lit('","last":'), "s_suppkey", F.lit('.5,"change":'), "s_nationkey",
        F.lit(',"sparkline":[1,2],"cot":"x"}};</script>Futures and options delayed by 15 minutes.'),
    )
    built = A.futures(rows.select(F.col("s_suppkey").alias("capture_id"), stamped(), body.alias("body")))
    return built.select("symbol", "name", "category", "last", "change_percent", "sparkline", "delay_minutes", H.canonical_map(F.col("extra_fields")).alias("extra"))


def _map_docs(t):
    nodes = F.concat(F.lit('{"S'), "s_suppkey", F.lit('":'), "s_nationkey", F.lit('.25,"S'), "s_suppkey", F.lit('-P":-1}'))
    body = F.concat(F.lit('<script>x({initialPerf: {"nodes":'), nodes, F.lit(',"subtype":"d1","version":7,"hash":"h}"}, y:1})</script>Stock quotes delayed by 1 minute.'))
    return t("supplier").select(F.col("s_suppkey").alias("capture_id"), body.alias("body"))


@query(
    "x_map_perf",
    "SELECT 'S' || s_suppkey AS symbol, s_nationkey + 0.25::DOUBLE AS perf, 'd1' AS subtype, CAST(7 AS BIGINT) AS version, 'h}' AS payload_hash, CAST(1 AS DOUBLE) AS delay_minutes FROM supplier UNION ALL SELECT 'S' || s_suppkey || '-P', -1, 'd1', 7, 'h}', 1 FROM supplier",
)
def x_map_perf(t):
    return P.x_map_perf(_map_docs(t)).drop("capture_id")


@query(
    "x_hierarchy",
    "SELECT sector, industry, symbol, CASE WHEN leaf_no % 4 = 0 THEN 0 ELSE leaf_no + 0.5::DOUBLE END AS value FROM leaves",
    "leaves",
)
def x_hierarchy(t):
    """One hierarchy asset per supplier: a path of its own sector and industry."""
    value = F.when(F.col("leaf_no") % 4 == 0, F.lit("")).otherwise(F.concat(F.lit(",value:"), "leaf_no", F.lit(".5")))
    body = F.concat(
        F.lit('(self.x=[]).push([{e.exports = {name:"Root",children:[{name:"'), "sector", F.lit('",children:[{name:"'), "industry",
        F.lit('",children:[{name:"'), "symbol", F.lit('",description:"d}"'), value, F.lit("}]}]}]}},1]);"),
    )
    docs = t("leaves").select(F.col("leaf_no").alias("capture_id"), body.alias("body"))
    return P.x_hierarchy(docs).select("sector", "industry", "symbol", "value")


@query(
    "hierarchy_problems",
    "SELECT leaf_no AS capture_id, CASE leaf_no % 4 WHEN 1 THEN 'value of leaf ' || symbol || ' is no number' WHEN 2 THEN 'industry without name or leaves' ELSE 'no hierarchy' END AS problem FROM leaves WHERE leaf_no % 4 > 0",
    "leaves",
)
def hierarchy_problems(t):
    """Assets with a text for a value, without a level or of no shape; every fourth has no children and is sound."""
    kind = F.col("leaf_no") % 4
    leaf = F.concat(F.lit('{name:"'), "symbol", F.lit('",value:"9"}'))
    inner = F.when(kind == 1, F.concat(F.lit('{name:"I",children:['), leaf, F.lit("]}"))).otherwise(leaf)
    tree = F.concat(F.lit('{name:"Root",children:[{name:"S",children:['), inner, F.lit("]}]}"))
    body = F.when(kind == 0, F.lit('e.exports={name:"Root",children:[]};')).when(kind == 3, F.lit("e.exports=null;")).otherwise(F.concat(F.lit("e.exports = "), tree, F.lit(";")))
    return P.hierarchy_problems(t("leaves").select(F.col("leaf_no").alias("capture_id"), body.alias("body")))


@query(
    "map_",
    f"""SELECT 'constituent' AS part, l.sector, l.industry, l.symbol, CASE WHEN leaf_no % 4 = 0 THEN 0 ELSE leaf_no + 0.5::DOUBLE END AS value, p.perf
        FROM leaves l LEFT JOIN (SELECT l2.symbol, s.s_nationkey + 0.25::DOUBLE AS perf FROM leaves l2 JOIN supplier s ON s.s_suppkey = l2.leaf_no) p ON p.symbol = l.symbol
        UNION ALL SELECT 'unmapped', NULL, NULL, 'Z' || s_suppkey, NULL, NULL FROM supplier""",
    "leaves",
)
def map_(t):
    """The public map: performance pages and hierarchy assets, one per supplier, joined, with the symbols it lacks."""
    value = F.when(F.col("leaf_no") % 4 == 0, F.lit("")).otherwise(F.concat(F.lit(",value:"), "leaf_no", F.lit(".5")))
    suppliers = t("supplier").join(t("leaves"), F.col("leaf_no") == F.col("s_suppkey"), "left")
    own = F.coalesce(F.concat(F.lit('"'), "symbol", F.lit('":'), "s_nationkey", F.lit(".25,")), F.lit(""))
    page = F.concat(F.lit('<script>x({initialPerf: {"nodes":{'), own, F.lit('"Z'), "s_suppkey", F.lit('":'), "s_nationkey", F.lit('},"subtype":"d1","version":7,"hash":"h"}, y:1})</script>Stock quotes delayed by 1 minute.'))
    asset = F.concat(
        F.lit('e.exports = {name:"Root",children:[{name:"'), "sector", F.lit('",children:[{name:"'), "industry", F.lit('",children:[{name:"'), "symbol", F.lit('"'), value, F.lit("}]}]}]};")
    )
    bundle = A.map_(suppliers.select(page.alias("body")), t("leaves").select(asset.alias("body")))
    none = F.lit(None)
    inside = bundle["constituents"].select(F.lit("constituent").alias("part"), "sector", "industry", "symbol", "value", "perf")
    outside = bundle["unmapped"].select(F.lit("unmapped").alias("part"), none.cast("string").alias("sector"), none.cast("string").alias("industry"), "symbol", none.cast("double").alias("value"), none.cast("double").alias("perf"))
    return inside.unionByName(outside)


@query(
    "spectrum",
    "SELECT p_partkey AS capture_id, 'https://img.example/s' || p_partkey || '.png' AS source_url, 'image/png' AS media_type, 'industry' AS dimension FROM part",
)
def spectrum(t):
    image = F.concat(F.lit('<img class="groups_spectrum-image" src="//img.example/s'), "p_partkey", F.lit('.png">'))
    docs = t("part").select(F.col("p_partkey").alias("capture_id"), stamped(), image.alias("body"))
    return A.spectrum(docs, "Industry").select("capture_id", "source_url", "media_type", F.col("group").alias("dimension"))


@query(
    "market_chart",
    "SELECT p_partkey AS capture_id, 'EURUSD' AS symbol, 'https://img.example/c?t=@eurusd&k=' || p_partkey AS source_url, 'd' AS timeframe, 'chart' AS kind FROM part",
)
def market_chart(t):
    """One pair's chart on gallery pages that show three."""
    image = lambda pair: F.concat(F.lit(f'<img class="charts-gal" srcset="https://img.example/c?t=@{pair}&amp;k='), "p_partkey", F.lit(' 1x, https://img.example/big 2x" src="/x">'))
    body = F.concat(image("gbpusd"), image("eurusd"), image("usdjpy"))
    docs = t.spread("part").select(F.col("p_partkey").alias("capture_id"), stamped(), body.alias("body"))
    return A.market_chart(docs, "eurusd", "d").select("capture_id", "symbol", "source_url", "timeframe", "kind")


# ---------------------------------------------------------------- statements and symbols


@query(
    "x_statement",
    "SELECT 'C' || o_custkey AS symbol, CASE WHEN o_custkey % 7 > 0 THEN string_agg(y || 'FY', '|' ORDER BY y DESC) END AS periods, CASE WHEN o_custkey % 7 > 0 THEN string_agg(month(end_date) || '/' || day(end_date) || '/' || year(end_date), '|' ORDER BY y DESC) END AS ends, CASE o_custkey % 7 WHEN 0 THEN NULL WHEN 2 THEN '' ELSE 'USD' END AS currency, CASE WHEN o_custkey % 7 > 0 THEN CAST(2 AS INTEGER) END AS n_metrics, CASE WHEN o_custkey % 7 = 0 THEN 'no data' WHEN o_custkey % 7 = 1 THEN 'metric misaligned' WHEN o_custkey % 7 = 2 THEN 'no currency' END AS problem FROM periods GROUP BY o_custkey",
    "periods",
)
def x_statement(t):
    k = F.substring("symbol", F.lit(2), F.lit(20)).cast("bigint") % 7
    body = (
        F.when(k == 0, F.lit('{"error":"no data"}'))
        .when(k == 1, F.regexp_replace("body", r'"Orders":\["[^"]*"', '"Orders":["1","2"'))
        .when(k == 2, F.replace("body", F.lit('"USD"'), F.lit('""')))
        .otherwise(F.col("body"))
    )
    parsed = P.x_statement(t("statement_docs").withColumn("body", body))
    return parsed.select(
        "symbol", F.array_join("periods", "|").alias("periods"), F.array_join("ends", "|").alias("ends"), "currency", F.size("metrics").alias("n_metrics"), "problem"
    )


def _sitemaps(t):
    """Sitemaps of a hundred customers: each a plain and an option URL, one foreign."""
    k = F.col("c_custkey")
    entry = F.concat(
        F.lit(f"<url><loc>https://{HOST}/stock?t=C"), k, F.lit(f"</loc><lastmod>x</lastmod></url><url><loc>https://{HOST}/stock?t=C"), k,
        F.lit("&amp;ty=oc</loc></url><url><loc>https://other.example/stock?t=C"), k, F.lit("</loc></url>"),
    )
    chunks = t("customer").groupBy(F.floor(k / 100).cast("bigint").alias("capture_id"))
    rows = chunks.agg(F.array_sort(F.collect_list(F.struct(k.alias("k"), entry.alias("x")))).alias("rows"))  # a hundred unique keys
    body = F.concat(F.lit("<urlset>"), F.array_join("rows.x", ""), F.lit("</urlset>"))
    return rows.select("capture_id", stamped(), body.alias("body"))


@query("x_universe", "SELECT 'C' || c_custkey AS symbol FROM customer")
def x_universe(t):
    return A.symbols(_sitemaps(t), HOST)[0].select("symbol")


@query("x_universe_unexpected", "SELECT CAST(floor(c_custkey / 100) AS BIGINT) AS capture_id, count(*) AS n FROM customer GROUP BY ALL")
def x_universe_unexpected(t):
    return A.symbols(_sitemaps(t), HOST)[1].groupBy("capture_id").agg(F.count("*").alias("n"))


@query("x_universe_split", "SELECT 'C' || c_custkey AS symbol, row_number() OVER (ORDER BY c_custkey) AS at, (SELECT count(*) FROM customer WHERE c_custkey % 10 = 0) AS n_bad FROM customer WHERE c_custkey % 10 > 0")
def x_universe_split(t):
    """Sitemaps written as XML files and read record by record: first-seen order, every tenth entry broken."""
    folder = scratch(t, "sitemaps")
    loc = F.concat(F.lit(f"<url>\n<loc>https://{HOST}/stock?t=C"), "c_custkey", F.when(F.col("c_custkey") % 10 == 0, F.lit("</lock>")).otherwise(F.lit("</loc>")))
    twin = F.concat(F.lit(f"<url><loc>https://{HOST}/stock?t=C"), "c_custkey", F.lit("&amp;ty=oc</loc></url>"))
    entry = F.concat(loc, F.lit("<lastmod>2001-08-01</lastmod>\n</url>\n"), F.when(F.col("c_custkey") % 10 > 0, twin).otherwise(F.lit("")))
    # A sorted file per range of keys, so that the files' order is the keys'.
    rows = t("customer").select("c_custkey", entry.alias("value")).repartitionByRange(4, "c_custkey").sortWithinPartitions("c_custkey")
    rows.select("value").write.text(folder)
    records, bad = M.sitemap_records(t.spark, folder)
    first, _ = M.sitemap_symbols(records, HOST)
    placed = K.global_rank(first.select("symbol", *M.PLACE), [F.col(c) for c in M.PLACE], "at").select("symbol", "at")
    return placed.crossJoin(bad.agg(F.count("*").alias("n_bad")))  # by one row


@query(
    "x_disclosure_variant",
    """SELECT p_partkey AS capture_id, '{"initialFundDetailsData":{"name":"' || p_name || '","holdings":[{"size":' || CASE p_size % 3 WHEN 0 THEN CAST(p_size AS VARCHAR) WHEN 1 THEN '"n/a"' ELSE 'null' END || ', "since":"2001-0' || (p_size % 9 + 1) || '-15"},7]},"initialFundReportDates":["soon","2001-06-30"]}' AS source,
    p_name AS name, CAST(i AS INTEGER) AS pos, CASE WHEN i = 1 THEN 'number' ELSE 'object' END AS kind, CASE WHEN i = 0 AND p_size % 3 = 0 THEN p_size::DOUBLE END AS size,
    CASE WHEN i = 0 THEN make_date(2001, CAST(p_size % 9 + 1 AS INTEGER), 15) END AS since, DATE '2001-06-30' AS last_report, CAST(1 AS INTEGER) AS n_reports FROM part, range(2) r(i)""",
)
def x_disclosure_variant(t):
    """Holdings whose fields change type, from VARIANT: the page's text as written, typed dates, other types as null."""
    size = F.when(F.col("p_size") % 3 == 0, F.col("p_size").cast("string")).when(F.col("p_size") % 3 == 1, F.lit('"n/a"')).otherwise(F.lit("null"))
    body = F.concat(
        F.lit('<script>{"initialFundDetailsData":{"name":"'), "p_name", F.lit('","holdings":[{"size":'), size, F.lit(', "since":"2001-0'), F.col("p_size") % 9 + 1,
        F.lit('-15"},7]},"initialFundReportDates":["soon","2001-06-30"]}</script>'),
    )
    docs = P.documents(t("part").select(F.col("p_partkey").alias("capture_id"), body.alias("body")))
    pages = V.disclosures(docs, "fund").withColumn("name", V.typed(F.col("page"), "$.name", "string"))
    keep = ["capture_id", "source", "name", "report_dates"]
    items = V.exploded(pages, "page", "$.holdings", keep)
    return items.select(
        "capture_id", "source", "name", "pos", V.kind_of(F.col("item")).alias("kind"), V.typed(F.col("item"), "$.size", "double").alias("size"),
        V.typed(F.col("item"), "$.since", "date").alias("since"), F.element_at("report_dates", -1).alias("last_report"), F.size("report_dates").alias("n_reports"),
    )


@query(
    "x_suggestions_variant",
    "SELECT 'P' || p_partkey AS symbol, p_name AS company, CAST(p_size AS BIGINT) AS score, CASE WHEN p_size % 2 = 0 THEN 'number' ELSE 'text' END AS kind FROM part",
)
def x_suggestions_variant(t):
    """Additional fields of suggestions keep the type they were written in."""
    quote = F.when(F.col("p_size") % 2 == 0, F.lit("")).otherwise(F.lit('"'))
    body = F.concat(F.lit('[{"ticker":"p'), "p_partkey", F.lit('","company":"'), "p_name", F.lit('","score":'), quote, "p_size", quote, F.lit("}]"))
    rows = V.suggestion_variants(t("part").select(F.col("p_partkey").alias("capture_id"), body.alias("body")))
    score = F.try_variant_get("fields", "$.score", "variant")
    return rows.select("symbol", "company", F.try_variant_get("fields", "$.score", "bigint").alias("score"), V.kind_of(score).alias("kind"))


@query(
    "x_suggestions",
    "SELECT 'P' || p_partkey AS symbol, p_name AS company, p_brand AS exchange, '{\"provider_symbol\":\"' || p_size || '\",\"score\":\"' || p_size || '\"}' AS extra FROM part WHERE p_size % 5 <> 0",
)
def x_suggestions(t):
    company = F.when(F.col("p_size") % 5 == 0, F.lit("N/A")).otherwise(F.col("p_name"))
    body = F.concat(
        F.lit('[{"ticker":"p'), "p_partkey", F.lit('","company":"'), company, F.lit('","exchange":"'), "p_brand", F.lit('","symbol":"'), "p_size",
        F.lit('","score":'), "p_size", F.lit("}]"),
    )
    rows, _ = A.suggestions(t("part").select(F.col("p_partkey").alias("capture_id"), stamped(), body.alias("body")))
    return rows.select("symbol", "company", "exchange", H.canonical_map(F.col("extra_fields")).alias("extra"))

