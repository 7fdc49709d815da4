"""Domain views over the benchmark tables, in Spark and in DuckDB SQL.

Sums that later feed comparisons are taken over integer cents, so that both
engines agree to the last bit whatever the summation order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .core import Tables, view

AS_OF = "2001-08-01"
FETCHED = "2001-08-02 18:00:00"


@view(
    "securities",
    f"""
    SELECT 'C' || c_custkey AS symbol, c_name AS company, c_mktsegment AS sector,
           c_mktsegment || ' - ' || n_name AS industry, n_name AS country, r_name AS exchange,
           CAST(cents AS DOUBLE) / 100 AS market_cap, volume, price,
           price / first_price - 1 AS change_percent, price / (volume + 1) AS p_per_e,
           high_52w, low_52w, (high_52w - low_52w) / price AS volatility,
           CAST(volume AS DOUBLE) / 10 AS rel_volume, 100.0 * filled / volume AS rsi,
           CAST(net_cents AS DOUBLE) / 100 AS insider_net, c_acctbal / 10000 AS dividend,
           last_day AS earnings_date,
           CASE c_custkey % 4 WHEN 0 THEN strftime(last_day, '%b %-d') || '/a'
                WHEN 1 THEN strftime(last_day, '%b %-d, %Y')
                WHEN 2 THEN strftime(last_day, '%b %-d') || ' BMO'
                ELSE strftime(last_day, '%b %-d') END AS earnings,
           CASE c_custkey % 4 WHEN 0 THEN 'AMC' WHEN 2 THEN 'BMO' END AS earnings_session,
           TIMESTAMP '{FETCHED}' AS fetched_at, c_custkey AS k
    FROM customer
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    JOIN (SELECT o_custkey,
                 CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents,
                 count(*) AS volume,
                 arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS price,
                 arg_min(o_totalprice, (o_orderdate, o_orderkey)) AS first_price,
                 max(o_totalprice) AS high_52w, min(o_totalprice) AS low_52w,
                 count(*) FILTER (o_orderstatus = 'F') AS filled,
                 CAST(sum(CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN -1 ELSE 0 END
                          * CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS net_cents,
                 CAST(max(o_orderdate) AS DATE) AS last_day
          FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey
    """,
)
def securities(t: Tables):
    """One security per customer with orders: sizes, prices, earnings display."""
    at = F.struct("o_orderdate", "o_orderkey")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    side = F.when(F.col("o_orderstatus") == "O", 1).when(F.col("o_orderstatus") == "F", -1).otherwise(0)
    trades = (
        t("orders")
        .groupBy("o_custkey")
        .agg(
            F.sum(cents).alias("cents"),
            F.count("*").alias("volume"),
            F.max_by("o_totalprice", at).alias("price"),
            F.min_by("o_totalprice", at).alias("first_price"),
            F.max("o_totalprice").alias("high_52w"),
            F.min("o_totalprice").alias("low_52w"),
            F.count_if(F.col("o_orderstatus") == "F").alias("filled"),
            F.sum(side * cents).alias("net_cents"),
            F.max("o_orderdate").cast("date").alias("last_day"),
        )
    )
    k, day = F.col("c_custkey") % 4, F.date_format("last_day", "MMM d")
    return (
        t("customer")
        .join(trades, F.col("o_custkey") == F.col("c_custkey"))
        .join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.concat(F.lit("C"), "c_custkey").alias("symbol"),
            F.col("c_name").alias("company"),
            F.col("c_mktsegment").alias("sector"),
            F.concat("c_mktsegment", F.lit(" - "), "n_name").alias("industry"),
            F.col("n_name").alias("country"),
            F.col("r_name").alias("exchange"),
            (F.col("cents") / 100).alias("market_cap"),
            "volume",
            "price",
            (F.col("price") / F.col("first_price") - 1).alias("change_percent"),
            (F.col("price") / (F.col("volume") + 1)).alias("p_per_e"),
            "high_52w",
            "low_52w",
            ((F.col("high_52w") - F.col("low_52w")) / F.col("price")).alias("volatility"),
            (F.col("volume").cast("double") / 10).alias("rel_volume"),
            (F.lit(100.0) * F.col("filled") / F.col("volume")).alias("rsi"),
            (F.col("net_cents") / 100).alias("insider_net"),
            (F.col("c_acctbal") / 10000).alias("dividend"),
            F.col("last_day").alias("earnings_date"),
            F.when(k == 0, F.concat(day, F.lit("/a")))
            .when(k == 1, F.date_format("last_day", "MMM d, yyyy"))
            .when(k == 2, F.concat(day, F.lit(" BMO")))
            .otherwise(day)
            .alias("earnings"),
            F.when(k == 0, F.lit("AMC")).when(k == 2, F.lit("BMO")).alias("earnings_session"),
            F.lit(FETCHED).cast("timestamp").alias("fetched_at"),
            F.col("c_custkey").alias("k"),
        )
    )


@view(
    "instruments",
    """
    SELECT 'P' || p_partkey AS symbol, p_type AS sector, p_brand AS industry, p_name AS company,
           p_retailprice AS price, CAST(qty AS BIGINT) AS volume,
           CAST(CAST(round(p_retailprice * 100) AS BIGINT) * CAST(qty AS BIGINT) AS DOUBLE) / 100 AS market_cap,
           CAST(p_size AS DOUBLE) / 100 AS roa, p_partkey AS k
    FROM part JOIN (SELECT l_partkey, sum(CAST(l_quantity AS BIGINT)) AS qty
                    FROM lineitem GROUP BY l_partkey) ON l_partkey = p_partkey
    """,
)
def instruments(t: Tables):
    """One instrument per traded part: sector/industry pairs and sizes."""
    traded = t("lineitem").groupBy("l_partkey").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("qty"))
    return (
        t("part")
        .join(traded, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.concat(F.lit("P"), "p_partkey").alias("symbol"),
            F.col("p_type").alias("sector"),
            F.col("p_brand").alias("industry"),
            F.col("p_name").alias("company"),
            F.col("p_retailprice").alias("price"),
            F.col("qty").alias("volume"),
            ((F.round(F.col("p_retailprice") * 100).cast("bigint") * F.col("qty")) / 100).alias("market_cap"),
            (F.col("p_size").cast("double") / 100).alias("roa"),
            F.col("p_partkey").alias("k"),
        )
    )


@view(
    "displays",
    """
    SELECT k, CASE k % 13
        WHEN 0 THEN k || '.25K' WHEN 1 THEN k || 'B' WHEN 2 THEN '-' || k || '.5%'
        WHEN 3 THEN '1,' || lpad(CAST(k % 1000 AS VARCHAR), 3, '0') WHEN 4 THEN '-'
        WHEN 5 THEN 'N/A' WHEN 6 THEN k || '.75' WHEN 7 THEN '+' || k WHEN 8 THEN 'bad' || k
        WHEN 9 THEN k || '.1234m' WHEN 10 THEN '' WHEN 11 THEN k || '.500T' ELSE ' - ' END AS display
    FROM (SELECT l_orderkey * 8 + l_linenumber AS k FROM lineitem)
    """,
)
def displays(t: Tables):
    """Thirteen shapes of numeric displays, spelled from integers."""
    k = F.col("k").cast("string")
    lit = F.lit
    shapes = [
        F.concat(k, lit(".25K")),
        F.concat(k, lit("B")),
        F.concat(lit("-"), k, lit(".5%")),
        F.concat(lit("1,"), F.lpad((F.col("k") % 1000).cast("string"), 3, "0")),
        lit("-"),
        lit("N/A"),
        F.concat(k, lit(".75")),
        F.concat(lit("+"), k),
        F.concat(lit("bad"), k),
        F.concat(k, lit(".1234m")),
        lit(""),
        F.concat(k, lit(".500T")),
        lit(" - "),
    ]
    chosen = F.when(F.lit(False), lit(""))
    for i, s in enumerate(shapes):
        chosen = chosen.when(F.col("k") % 13 == i, s)
    base = t.spread("lineitem").select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("k"))
    return base.select("k", chosen.alias("display"))


@view(
    "days",
    """
    SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS d,
           CAST(o_orderdate AS DATE) + CAST(o_custkey % 400 AS INTEGER) AS anchor,
           o_custkey % 24 AS h, o_orderkey % 60 AS m
    FROM orders
    """,
)
def days(t: Tables):
    """Order days with an anchor up to 400 days later and a clock time."""
    day = F.col("o_orderdate").cast("date")
    return t("orders").select(
        F.col("o_orderkey").alias("k"),
        day.alias("d"),
        F.date_add(day, (F.col("o_custkey") % 400).cast("int")).alias("anchor"),
        (F.col("o_custkey") % 24).alias("h"),
        (F.col("o_orderkey") % 60).alias("m"),
    )


@view(
    "observations",
    """
    SELECT event_id AS id, user_id AS uid, 'U' || user_id AS symbol, event_type AS metric, value,
           ts AS fetched_at, props, sha256(CAST(CAST(round(value) AS BIGINT) % 7 AS VARCHAR)) AS response_hash
    FROM events
    """,
)
def observations(t: Tables):
    """Events as observations: symbol = user, metric = event type."""
    return t("events").select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("uid"),
        F.concat(F.lit("U"), "user_id").alias("symbol"),
        F.col("event_type").alias("metric"),
        "value",
        F.col("ts").cast("timestamp").alias("fetched_at"),
        "props",
        F.sha2((F.round("value").cast("bigint") % 7).cast("string"), 256).alias("response_hash"),
    )


@view(
    "captures",
    """
    SELECT page_id AS capture_id, url AS endpoint, html AS body,
           CASE page_id % 8 WHEN 0 THEN 'text/html; charset=utf-8' WHEN 1 THEN 'application/json'
                WHEN 2 THEN 'application/ld+json' WHEN 3 THEN 'image/png' WHEN 4 THEN 'application/xml'
                WHEN 5 THEN ' TEXT/Plain ' WHEN 6 THEN '' ELSE 'audio/ogg' END AS content_type,
           CAST(CASE page_id % 7 WHEN 1 THEN 403 WHEN 2 THEN 429 WHEN 3 THEN 404 WHEN 4 THEN 503
                ELSE 200 END AS INTEGER) AS status_code
    FROM pages
    """,
)
def captures(t: Tables):
    """Pages as captured documents with content types and status codes."""
    p = F.col("page_id")
    kinds = ["text/html; charset=utf-8", "application/json", "application/ld+json", "image/png",
             "application/xml", " TEXT/Plain ", ""]
    kind = F.when(F.lit(False), F.lit(""))
    for i, k in enumerate(kinds):
        kind = kind.when(p % 8 == i, F.lit(k))
    status = F.when(p % 7 == 1, 403).when(p % 7 == 2, 429).when(p % 7 == 3, 404).when(p % 7 == 4, 503)
    return t("pages").select(
        p.alias("capture_id"),
        F.col("url").alias("endpoint"),
        F.col("html").alias("body"),
        kind.otherwise(F.lit("audio/ogg")).alias("content_type"),
        status.otherwise(200).alias("status_code"),
    )


@view(
    "leaves",
    """
    SELECT r_name AS sector, n_name AS industry, 'S' || s_suppkey AS symbol, s_acctbal AS value,
           r_regionkey AS sector_no, n_nationkey AS industry_no, s_suppkey AS leaf_no
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    """,
)
def leaves(t: Tables):
    """Region → nation → supplier as sector → industry → leaf."""
    return (
        t("supplier")
        .join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("r_name").alias("sector"),
            F.col("n_name").alias("industry"),
            F.concat(F.lit("S"), "s_suppkey").alias("symbol"),
            F.col("s_acctbal").alias("value"),
            F.col("r_regionkey").alias("sector_no"),
            F.col("n_nationkey").alias("industry_no"),
            F.col("s_suppkey").alias("leaf_no"),
        )
    )


@view(
    "perf",
    """
    SELECT CASE WHEN min(l_discount) = 0 AND max(l_tax) > 0.07 AND count(*) % 3 = 0
                THEN 'S' || l_suppkey || '-P' ELSE 'S' || l_suppkey END AS symbol,
           CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) / 100 AS perf
    FROM lineitem GROUP BY l_suppkey
    """,
)
def perf(t: Tables):
    """Supplier performance; some suppliers trade under a share class no leaf has."""
    other = (F.min("l_discount") == 0) & (F.max("l_tax") > 0.07) & (F.count("*") % 3 == 0)
    name = F.concat(F.lit("S"), "l_suppkey")
    return (
        t("lineitem")
        .groupBy("l_suppkey")
        .agg(other.alias("other"), (F.sum(F.col("l_quantity").cast("bigint")).cast("double") / 100).alias("perf"))
        .select(F.when(F.col("other"), F.concat(name, F.lit("-P"))).otherwise(name).alias("symbol"), "perf")
    )


@view(
    "periods",
    """
    SELECT o_custkey, year(o_orderdate) AS y, count(*) AS n,
           CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents,
           CAST(max(o_orderdate) AS DATE) AS end_date
    FROM orders GROUP BY o_custkey, year(o_orderdate)
    """,
)
def periods(t: Tables):
    """Yearly figures per customer, the raw material of statements."""
    return (
        t("orders")
        .groupBy("o_custkey", F.year("o_orderdate").alias("y"))
        .agg(
            F.count("*").alias("n"),
            F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"),
            F.max("o_orderdate").cast("date").alias("end_date"),
        )
    )


@view("statement_docs")
def statement_docs(t: Tables):
    """Statement bodies: one JSON document per customer, a period per order year.

    The years of the table bound the periods of a document, so the collected
    arrays stay small whatever a customer's share of the orders is.
    """
    item = F.struct((-F.col("y")).alias("o"), "y", "n", "cents", "end_date")
    docs = t("periods").groupBy("o_custkey").agg(F.array_sort(F.collect_list(item)).alias("p"))

    def texts(f):
        return F.transform("p", f)

    end = texts(lambda p: F.concat(F.month(p["end_date"]), F.lit("/"), F.dayofmonth(p["end_date"]), F.lit("/"), F.year(p["end_date"])))
    data = F.struct(
        texts(lambda p: F.concat(p["y"].cast("string"), F.lit("FY"))).alias("Period"),
        end.alias("Period End Date"),
        texts(lambda p: F.lit("12 Months")).alias("Period Length"),
        texts(lambda p: F.format_number(p["n"], 0)).alias("Orders"),
        texts(lambda p: F.concat((p["cents"] / 100).cast("bigint").cast("string"), F.lit("."), F.lpad((p["cents"] % 100).cast("string"), 2, "0"))).alias("Total Revenue"),
    )
    return docs.select(
        F.concat(F.lit("C"), "o_custkey").alias("symbol"),
        F.lit("IA").alias("statement"),
        F.lit(FETCHED).cast("timestamp").alias("fetched_at"),
        F.to_json(F.struct(F.lit("USD").alias("currency"), data.alias("data"))).alias("body"),
    )


@view("screen_docs")
def screen_docs(t: Tables):
    """Screener pages in table form: twenty consecutive customer keys a page."""
    row = F.struct(
        F.col("k"),
        F.concat(
            F.lit("<tr><td>"), F.col("k") + 1, F.lit('<td data-boxover-ticker="'), F.lower("symbol"),
            F.lit('"><a href="/q?t='), F.col("symbol"), F.lit('">'), F.col("symbol"), F.lit("</a><td>"),
            F.col("company"), F.lit("<td>"), F.col("sector"), F.lit("<td>"),
            F.col("volume") * 7, F.lit(".25M<td>"), F.col("volume"), F.lit(".5%<td>"),
            F.format_number(F.col("volume") * 1234, 0), F.lit("</tr>"),
        ).alias("html"),
    )
    head = (
        '<html><body><div id="screener-total">#{} / 1,234 Total</div><table class="styled screener_table">'
        "<thead><tr><th>No.<th>Ticker<th>Company<th>Sector<th>Market Cap<th>Change %<th>Volume</tr></thead>"
    )
    pages = (
        t("securities")
        .groupBy(F.floor(F.col("k") / 20).cast("bigint").alias("capture_id"))
        .agg(F.array_sort(F.collect_list(row)).alias("rows"))  # twenty unique keys at most
    )
    start = (F.col("capture_id") * 20 + 1).cast("string")
    before, after = head.split("{}")
    body = F.concat(F.lit(before), start, F.lit(after), F.array_join("rows.html", ""), F.lit("</table></body></html>"))
    return pages.select("capture_id", F.lit(FETCHED).cast("timestamp").alias("fetched_at"), body.alias("body"))


@view("json_docs")
def json_docs(t: Tables):
    """Screener pages in JSON form over the same customers."""
    text = F.create_map(
        F.lit("ticker"), F.lower("symbol"), F.lit("company"), F.col("company"), F.lit("sector"), F.col("sector"),
        F.lit("earningsDate"), F.concat(F.date_format("earnings_date", "yyyy-MM-dd"), F.lit("T16:30:00")),
    )
    item = F.struct(
        F.col("k"),
        F.concat(
            F.lit('{"text":'), F.to_json(text), F.lit(',"numbers":{"order":'), F.col("k"), F.lit(',"volume":'),
            F.col("volume") * 1234, F.lit(',"marketCap":'), F.col("market_cap"), F.lit(',"change":'), F.col("rsi"), F.lit("}}"),
        ).alias("json"),
    )
    pages = (
        t("securities")
        .groupBy(F.floor(F.col("k") / 20).cast("bigint").alias("capture_id"))
        .agg(F.array_sort(F.collect_list(item)).alias("rows"))  # twenty unique keys at most
    )
    body = F.concat(
        F.lit('<html><body><script>{"url":"/s?v=152&c=0,1,2,3,6,66,67,68","data":{"totalCount":1234,"pageSize":20,"firstRow":'),
        F.col("capture_id") * 20,
        F.lit(',"rows":['),
        F.array_join("rows.json", ","),
        F.lit("]}}</script></body></html>"),
    )
    return pages.select("capture_id", F.lit(FETCHED).cast("timestamp").alias("fetched_at"), body.alias("body"))


@view("quote_docs")
def quote_docs(t: Tables):
    return quote_pages(t.spread("part"))


def quote_pages(parts: DataFrame, *keep: str) -> DataFrame:
    """Stock pages: one per part, every region spelled from the part's own fields."""
    k = F.col("p_partkey")
    part = [
        '<html><head><title>Quote</title></head><body><div class="quote-header"><h1 data-ticker="', "@symbol", '">',
        "@symbol", '</h1><h2 class="quote-header_ticker-wrapper_company">', "@p_name",
        '</h2><a class="quote-header_category" href="/s?v=111&f=sec_', "@sec", '">', "@p_type",
        '</a><a class="quote-header_category" href="/s?f=ind_x1">', "@p_brand",
        '</a><a class="quote-header_category" href="/s?f=exch_nasd">NASD</a></div>',
        '<div class="quote_profile-bio"> About ', "@p_name", " &amp; co </div>",
    ]
    cells = [
        ("Index", "@index"), ("Market Cap", "@cap"), ("P/E", "@pe"), ("Change", "@change"),
        ("Dividend TTM", "@dividend"), ("Dividend Ex-Date", "@exdate"), ("Volume", "@volume"),
        ("Price", "@price"), ("Price", "ignored"), ("Odd Ratio", "@odd"), ("Beta", "-"), ("Employees", "@size"),
    ]
    for i in range(6):
        part.append('<table class="snapshot-table2"><tr>')
        for label, shown in cells[2 * i : 2 * i + 2]:
            part += [f'<td class="snapshot-td2">{label}</td><td class="snapshot-td2"><b>', shown, "</b></td>"]
        part.append("</tr></table>")
    part += [
        '<table class="js-table-ratings"><thead><tr><th>Date<th>Action<th>Analyst<th>Rating Change<th>Price Target Change</tr></thead>',
        "<tr><td>", "@ratingdate", "<td>Upgrade<td>Desk ", "@size", "<td>Hold<td>$", "@size", "</tr></table>",
        '<table id="news-table"><tr><td>', "@newstime", '<td><a class="tab-link-news" href="/n/', "@key", '">News of ',
        "@symbol", '</a><div class="news-link-right"><span>(Wire)</span></div></tr></table>',
        '<table class="body-table"><tr><th>Insider Trading<th>Relationship<th>Date<th>Transaction<th>Cost<th>#Shares<th>Value ($)<th>#Shares Total<th>SEC Form 4</tr>',
        "<tr><td>Owner ", "@size", "<td>CEO<td>", "@insiderdate", "<td>Sale<td>", "@price", "<td>", "@volume", "<td>",
        "@cap", '<td>1,000<td><a href="/f4/', "@key", '">form</a></tr></table>',
        '<div><a class="tab-link">Peers</a><span data-boxover-ticker="X', "@key", '" data-boxover-value="', "@cap",
        '">x</span><span data-boxover-ticker="Y', "@key", '">y</span></div>',
        '<div><a class="tab-link">Held by</a><span data-boxover-ticker="E', "@key", '" data-boxover-value="AUM: ', "@cap", '">e</span></div>',
        '<table><tr><td class="js-quote-correlation-links-container"><a class="sig-tab-link" href="/screener?s=x', "@size",
        '">Signal ', "@size", '</a><a class="sig-tab-link" href="/other">no</a></table>',
        '<img src="/chart.ashx?t=', "@symbol", "@chart", '"></body></html>',
    ]
    day = F.date_add(F.lit("2000-01-01").cast("date"), F.col("p_size"))
    values = {
        "@symbol": F.concat(F.lit("P"), k),
        "@key": k.cast("string"),
        "@p_name": F.col("p_name"),
        "@sec": F.lower("p_type"),
        "@p_type": F.col("p_type"),
        "@p_brand": F.col("p_brand"),
        "@index": F.when(F.col("p_size") > 25, F.lit("DJIA, S&amp;P 500")).otherwise(F.lit("-")),
        "@cap": F.concat(k, F.lit(".50B")),
        "@pe": F.concat("p_size", F.lit(".25")),
        "@change": F.concat("p_size", F.lit(".5 (1.25%)")),
        "@dividend": F.concat(F.lit("1.5 ("), F.col("p_size"), F.lit(".75%)")),
        "@exdate": F.date_format(day, "MMM d, yyyy"),
        "@volume": F.format_number(k * 1000, 0),
        "@price": F.concat("p_size", F.lit(".50")),
        "@odd": F.concat("p_size", F.lit("x")),
        "@size": F.col("p_size").cast("string"),
        "@ratingdate": F.date_format(day, "MMM-dd-yy"),
        "@newstime": F.concat(F.date_format(day, "MMM-dd-yy"), F.lit(" 04:15PM")),
        "@insiderdate": F.date_format(day, "MMM dd ''yy"),
        "@chart": F.when(F.col("p_size") > 25, F.lit("&amp;p=w")).otherwise(F.lit("")),
    }
    body = F.concat(*[values[x] if x.startswith("@") else F.lit(x) for x in part])
    return parts.select(
        k.alias("capture_id"), F.lit(FETCHED).cast("timestamp").alias("fetched_at"), body.alias("body"), *keep
    )
