"""Projections, filters, joins, aggregates, ranks and set operations on domain views."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickweave.functions import hashing as H
from tickweave.functions import numeric as N
from tickweave.operators import event_signals as E
from tickweave.operators import grouping as G
from tickweave.operators import quality as Q
from tickweave.operators import ranking as K
from tickweave.operators import relations as L
from tickweave.operators import screening as S
from tickweave.operators.rank_index import RankIndex
from tickweave.operators.sketches import SketchTable, error_bound
from tickweave.operators.dataset import build_dataset, provenance_cols, split_required, split_dataset
from tickweave.plans import api as A
from tickweave.plans import families as P
from tickweave.plans import registry as R
from tickweave.plans.query import Filter, GroupQuery, Order, ScreenQuery
from tickweave.schemas import dataset, dq_contract, dq_contract_nulls, empty_typed

from .core import query, scratch
from .views import AS_OF, FETCHED

BIG_CAP = "market_cap >= 1000000"
FLAGSHIP = ScreenQuery(
    view="custom",
    columns=("Company", "Sector", "Country", "Market Cap", "Price", "Change %"),
    filters=(Filter("Sector", "BUILDING"), Filter("Market Cap.", "Over 1000000")),
    order=Order("Market Cap.", True),
)


def as_of():
    return F.lit(AS_OF).cast("date")


def plain(df, *drop: str):
    """Comparable output: no map columns, timestamps without zone."""
    out = []
    for f in df.schema:
        kind = f.dataType.simpleString()
        if f.name in drop or kind.startswith("map"):
            continue
        out.append(F.col(f.name).cast("timestamp_ntz").alias(f.name) if kind == "timestamp" else F.col(f.name))
    return df.select(*out)


# ---------------------------------------------------------------- projections


@query(
    "build_dataset",
    r"""SELECT 'K' || k AS symbol, 'Co' AS company, CAST(NULL AS VARCHAR) AS exchange,
        CASE WHEN regexp_full_match(c, '[+-]?[0-9]+(\.[0-9]+)?[KMBTkmbt]') THEN
             TRY_CAST(substr(c, 1, length(c) - 1) || 'e' || CASE upper(right(c, 1)) WHEN 'K' THEN '3' WHEN 'M' THEN '6'
             WHEN 'B' THEN '9' ELSE '12' END AS DOUBLE) ELSE TRY_CAST(c AS DOUBLE) END AS market_cap,
        display AS market_cap_raw, TRY_CAST(c AS DOUBLE) / 100 AS div_yield, display AS div_yield_raw,
        '{"brand_new":"' || (k % 5) || '"}' AS extra, TIMESTAMP '2001-08-02 18:00:00' AS fetched_at,
        CAST(1 + CASE WHEN display IN ('', '-', 'N/A') THEN 2 ELSE 0 END
          + CASE WHEN k % 13 IN (8, 12) THEN 2 WHEN k % 13 IN (0, 1, 9, 11) THEN 1 ELSE 0 END AS INTEGER) AS n_warnings
    FROM (SELECT k, display, regexp_replace(replace(display, ',', ''), '%$', '') AS c FROM displays)""",
    "displays",
)
def build_dataset_(t):
    rows = t("displays").select(
        F.concat(F.lit("K"), "k").alias("symbol"),
        F.lit("Co").alias("company"),
        F.col("display").alias("market_cap"),
        F.col("display").alias("div_yield"),
        (F.col("k") % 5).cast("string").alias("brand_new"),
        F.lit(FETCHED).cast("timestamp").alias("fetched_at"),
    )
    built = build_dataset(rows, "symbol_search", with_warnings=True)
    return plain(
        built.withColumns({"extra": H.canonical_map(F.col("extra_fields")), "n_warnings": F.size("warnings")}), "warnings"
    )


@query(
    "view_fixed",
    """SELECT symbol, company, sector, industry, country, market_cap, p_per_e, price, change_percent, volume, fetched_at FROM securities""",
    "securities",
)
def view_fixed(t):
    return plain(S.view_fixed(t("securities"), "overview"))


@query("view_ticker", "SELECT symbol FROM securities", "securities")
def view_ticker(t):
    return S.view_ticker(t("securities"))


@query("view_custom", "SELECT symbol, price, country, market_cap, fetched_at FROM securities", "securities")
def view_custom(t):
    return plain(S.view_custom(t("securities"), ["Price", "Country", "Market Cap"]))


@query(
    "signal_columns",
    "SELECT symbol, company, sector, industry, country, market_cap, price, fetched_at FROM securities WHERE change_percent > 0",
    "securities",
)
def signal_columns(t):
    return plain(S.signal_columns(S.signal_rows(t("securities"), "Top Gainers")))


_EARN_DAY = """CASE WHEN k % 4 = 1 THEN earnings_date ELSE (SELECT CASE WHEN c - DATE '2001-08-01' > 180 THEN
    TRY_CAST('2000' || strftime(earnings_date, '-%m-%d') AS DATE) WHEN DATE '2001-08-01' - c > 180
    THEN TRY_CAST('2002' || strftime(earnings_date, '-%m-%d') AS DATE) ELSE c END
    FROM (SELECT TRY_CAST('2001' || strftime(earnings_date, '-%m-%d') AS DATE) AS c)) END"""


@query(
    "earnings_project",
    f"SELECT symbol, {_EARN_DAY} AS earnings_date, earnings AS earnings_date_raw, earnings_session, price, fetched_at FROM securities",
    "securities",
)
def earnings_project(t):
    return plain(S.earnings_project(t("securities").select("symbol", "earnings", "price", "fetched_at"), as_of()))


@query(
    "futures_project",
    """SELECT 'S' || s_suppkey AS symbol, s_name AS name, n_name AS category, CAST(s_suppkey AS DOUBLE) AS last, CAST(s_suppkey AS VARCHAR) AS last_raw,
        CAST(s_nationkey AS DOUBLE) / 100 AS change_percent, CAST(s_nationkey AS VARCHAR) AS change_percent_raw, 15.0::DOUBLE AS delay_minutes
    FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)
def futures_project(t):
    tiles = t("supplier").join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("S"), "s_suppkey").alias("symbol"),
        F.col("s_name").alias("name"),
        F.col("n_name").alias("category"),
        F.col("s_suppkey").cast("string").alias("last"),
        F.col("s_nationkey").cast("string").alias("change_percent"),
        F.lit("15").alias("delay_minutes"),
        F.lit(FETCHED).cast("timestamp").alias("fetched_at"),
    )
    built = build_dataset(tiles, "futures_tiles")
    return built.select("symbol", "name", "category", "last", "last_raw", "change_percent", "change_percent_raw", "delay_minutes")


@query(
    "provenance_cols",
    f"SELECT symbol, price, '{FLAGSHIP.hash()}' AS query_hash, CAST(1 AS INTEGER) AS schema_version, 'screener' AS projected_from FROM securities",
    "securities",
)
def provenance_cols_(t):
    rows = t("securities").select("symbol", "price")
    return provenance_cols(rows, query_hash=FLAGSHIP.hash(), schema_version=1, projected_from="screener")


# ---------------------------------------------------------------- filters and screens


@query("filter_categorical", "SELECT symbol, sector FROM securities WHERE sector = 'BUILDING'", "securities")
def filter_categorical(t):
    return t("securities").where(S.filter_predicate("Sector", "BUILDING")).select("symbol", "sector")


@query("filter_numeric", "SELECT symbol, price FROM securities WHERE price < 100000.5", "securities")
def filter_numeric(t):
    return t("securities").where(S.filter_predicate("Price", "Under 100000.5")).select("symbol", "price")


_MEASURES = ", ".join(f"({i}, '{label}')" for i, label in enumerate(R.MEASURES, 1))


@query(
    "filter_measures",
    f"""SELECT label, CAST(count_if(volume * i % 1000 > 500 AND volume * i % 1000 BETWEEN 100 AND 900 AND NOT volume * i % 1000 < 300) AS BIGINT) AS n
    FROM securities, (VALUES {_MEASURES}) AS m(i, label) GROUP BY label""",
    "securities",
)
def filter_measures(t):
    """All three forms of option of every measure's filter, counted in one pass."""
    shown = {c: (F.col("volume") * i % 1000).cast("double") for i, c in enumerate(R.MEASURES.values(), 1)}

    def passes(label):
        over, inside, under = (S.filter_predicate(label, o) for o in ("Over 500", "100 to 900", "Under 300"))
        return F.count_if(S.filter_conjunction([over, inside, ~under]))

    counts = F.array(*[F.struct(F.lit(x).alias("label"), passes(x).alias("n")) for x in R.MEASURES])
    return t("securities").select("volume").withColumns(shown).agg(counts.alias("c")).select(F.inline("c"))


@query(
    "filter_date",
    "SELECT symbol, earnings_date FROM securities WHERE earnings_date BETWEEN DATE '2001-08-01' AND DATE '2001-08-31'",
    "securities",
)
def filter_date(t):
    return t("securities").where(S.filter_predicate("Earnings Date", "This Month", as_of())).select("symbol", "earnings_date")


@query(
    "filter_conjunction",
    "SELECT symbol, sector, price FROM securities WHERE sector = 'MACHINERY' AND price > 200000 AND change_percent > 0",
    "securities",
)
def filter_conjunction(t):
    q = ScreenQuery(
        filters=(Filter("Sector", "MACHINERY"), Filter("Price", "Over 200000"), Filter("Change", "Up"), Filter("Country", "Any"))
    )
    return A.screen_rows(t("securities"), q).select("symbol", "sector", "price")


@query("filter_ticker", "SELECT symbol, price FROM securities WHERE symbol IN ('C1', 'C7')", "securities")
def filter_ticker(t):
    return S.filter_ticker(t("securities"), "c1", "C7").select("symbol", "price")


@query(
    "signal_screen",
    """SELECT row_number() OVER (ORDER BY rsi DESC, symbol) AS rank, symbol, rsi FROM securities WHERE rsi > 70
""",
    "securities",
)
def signal_screen(t):
    return S.signal_screen(t("securities"), "Overbought").select("rank", "symbol", "rsi")


_CHANGES = """SELECT *, level - old AS step FROM (SELECT 'C' || o_custkey AS symbol, o_orderdate AS ts, 6 - CAST(o_orderpriority[1] AS INTEGER) AS level,
    lag(6 - CAST(o_orderpriority[1] AS INTEGER)) OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate, o_orderkey) AS old FROM orders) WHERE level <> old"""
_RECENT = "SELECT symbol, {1} AS {0}, max(ts) AS latest FROM ({2}) JOIN securities USING (symbol) WHERE CAST(ts AS DATE) > CAST(fetched_at AS DATE) - 400 AND ts <= fetched_at GROUP BY symbol HAVING {3}"


def _event_signal(name: str, measure: str, total: str, events: str, test: str, direction: str = "DESC") -> str:
    rows = _RECENT.format(measure, total, events, test)
    return f"SELECT '{name}' AS signal, row_number() OVER (ORDER BY {measure} {direction}, symbol) AS rank, symbol, CAST({measure} AS BIGINT) AS measure, CAST(latest AS DATE) AS latest FROM ({rows})"


_DEALS = "SELECT 'C' || o_custkey AS symbol, o_orderdate AS ts, CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN -1 END * CAST(round(o_totalprice * 100) AS BIGINT) AS v FROM orders"
_STORIES = "SELECT 'C' || o_custkey AS symbol, o_orderdate AS ts FROM orders"


@query(
    "signal_events",
    " UNION ALL ".join(
        [
            _event_signal("Upgrades", "upgrades", "count(*)", f"SELECT * FROM ({_CHANGES}) WHERE step > 0", "count(*) >= 1"),
            _event_signal("Downgrades", "downgrades", "count(*)", f"SELECT * FROM ({_CHANGES}) WHERE step < 0", "count(*) >= 1"),
            _event_signal("Recent Insider Buying", "net_value", "sum(v)", _DEALS, "sum(v) > 0"),
            _event_signal("Recent Insider Selling", "net_value", "sum(v)", _DEALS, "sum(v) < 0", "ASC"),
            _event_signal("Major News", "stories", "count(*)", _STORIES, "count(*) >= 3"),
        ]
    ),
    "securities",
)
def signal_events(t):
    """Five signals from relations of events, as of each snapshot row: priorities stand for ratings, orders for dealings and stories."""
    orders = t("orders").select(
        F.concat(F.lit("C"), "o_custkey").alias("symbol"), F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("desk"),
        F.col("o_orderdate").cast("timestamp").alias("published_at"), F.col("o_orderdate").cast("timestamp").alias("transaction_date"), "o_orderpriority",
        F.when(F.col("o_orderstatus") == "O", "buy").when(F.col("o_orderstatus") == "F", "sell").alias("side"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("value"),
    )
    changes = E.rating_changes(orders, 6 - F.substring("o_orderpriority", 1, 1).try_cast("int"), ["desk"])
    events = {"ratings": changes, "insider": orders, "news": orders}
    snapshot, out = t("securities").select("symbol", "fetched_at"), None
    for name, (kind, measure, _) in E.EVENT_SIGNALS.items():
        rows = E.event_signal(name, snapshot, events[kind], days=400, least=3 if name == "Major News" else 1)
        rows = rows.select(F.lit(name).alias("signal"), "rank", "symbol", F.col(measure).cast("bigint").alias("measure"), F.col("latest").cast("date").alias("latest"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("signal_membership", "SELECT symbol, rel_volume > 2 AS in_signal FROM securities", "securities")
def signal_membership(t):
    return S.signal_membership(t("securities"), "Unusual Volume")


@query(
    "earnings_window",
    "SELECT symbol, earnings_date FROM securities WHERE earnings_date BETWEEN DATE '2001-07-30' AND DATE '2001-08-05'",
    "securities",
)
def earnings_window(t):
    return t("securities").where(S.earnings_window("This Week", as_of())).select("symbol", "earnings_date")


_TRADES = """SELECT 'U' || user_id AS symbol, event_id AS transaction_id, CAST(ts AS DATE) AS transaction_date, value * 10000 AS value,
    CASE event_type WHEN 'purchase' THEN 1 WHEN 'error' THEN 2 END AS side FROM events"""


def _trades(t):
    kind = F.col("event_type")
    return t("events").select(
        F.concat(F.lit("U"), "user_id").alias("symbol"),
        F.col("event_id").alias("transaction_id"),
        F.col("ts").cast("date").alias("transaction_date"),
        (F.col("value") * 10000).alias("value"),
        F.when(kind == "purchase", 1).when(kind == "error", 2).alias("side"),
        (F.col("user_id") % 10 == 0).alias("ten_percent_owner"),
    )


@query(
    "insider_feed",
    f"""SELECT row_number() OVER (ORDER BY value DESC, symbol, transaction_id) AS rank, symbol, transaction_id, transaction_date, value
    FROM ({_TRADES}) WHERE side = 1 AND value >= 100000 AND transaction_date > DATE '2024-01-23' AND transaction_date <= DATE '2024-01-30'
""",
)
def insider_feed(t):
    rows = S.insider_feed(_trades(t), "top_week_buys", F.lit("2024-01-30").cast("date"))
    return rows.select("rank", "symbol", "transaction_id", "transaction_date", "value")


@query(
    "compare_peers",
    """SELECT p.symbol, p.sector, p.country FROM securities p JOIN securities s ON s.symbol = 'C1' AND p.sector = s.sector
    AND p.country = s.country WHERE p.symbol <> 'C1'""",
    "securities",
)
def compare_peers(t):
    return S.compare_peers(t("securities"), "C1", "sector", "country").select("symbol", "sector", "country")


@query(
    "symbol_search",
    """SELECT row_number() OVER (ORDER BY score, symbol) AS rank, symbol, company, score FROM (SELECT symbol, company,
        CAST(CASE WHEN upper(symbol) = 'C1' THEN 0 WHEN starts_with(upper(symbol), 'C1') THEN 1 WHEN starts_with(upper(company), 'C1') THEN 2
        WHEN contains(upper(company), 'C1') OR contains(upper(symbol), 'C1') THEN 3 END AS INTEGER) AS score FROM securities)
    WHERE score IS NOT NULL ORDER BY score, symbol LIMIT 10""",
    "securities",
)
def symbol_search(t):
    return S.symbol_search(t("securities"), "c1").select("rank", "symbol", "company", "score")


def _releases(t):
    return t("orders").select(
        F.lower(F.regexp_replace("o_orderpriority", r"[^A-Za-z]+", "-")).alias("raw_slug"),
        F.col("o_orderdate").cast("date").alias("release_date"),
        "o_orderkey",
    ).select(F.btrim("raw_slug", F.lit("-")).alias("slug"), "release_date", "o_orderkey")


@query(
    "release_detail",
    "SELECT 'not-specified' AS slug, CAST(o_orderdate AS DATE) AS release_date, o_orderkey FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED'",
)
def release_detail(t):
    return S.release_detail(_releases(t), "not-specified")


@query("publisher_filter", "SELECT doc_id, source AS publisher FROM documents WHERE source = 'src3'")
def publisher_filter(t):
    return S.publisher_filter(t("documents").select("doc_id", F.col("source").alias("publisher")), "src3")


# ---------------------------------------------------------------- joins


@query(
    "map_join_perf",
    "SELECT l.symbol, sector, industry, value, perf FROM leaves l LEFT JOIN perf p ON l.symbol = p.symbol",
    "leaves",
    "perf",
)
def map_join_perf(t):
    return L.map_join_perf(t("leaves"), t("perf")).select("symbol", "sector", "industry", "value", "perf")


@query("map_unmapped", "SELECT symbol FROM perf WHERE symbol NOT IN (SELECT symbol FROM leaves)", "leaves", "perf")
def map_unmapped(t):
    return L.map_unmapped(t("perf"), t("leaves"))


@query(
    "futures_category",
    """SELECT s_suppkey, category FROM supplier LEFT JOIN (SELECT l_suppkey, arg_min(l_returnflag, (l_shipdate, l_orderkey, l_linenumber, l_returnflag)) AS category
    FROM lineitem GROUP BY l_suppkey) ON l_suppkey = s_suppkey""",
)
def futures_category(t):
    listed = t("lineitem").select(
        F.col("l_suppkey").alias("s_suppkey"), F.col("l_returnflag").alias("category"), "l_shipdate", "l_orderkey", "l_linenumber",
        F.col("l_returnflag").alias("flag"),
    )
    tiles = t("supplier").select("s_suppkey")
    return L.futures_category(tiles, listed, ("l_shipdate", "l_orderkey", "l_linenumber", "flag"))


@query(
    "sym_resolve_join",
    """SELECT r.position, requested, canonical, price FROM (SELECT c_custkey AS position, CASE WHEN c_custkey % 2 = 0 THEN ' c' || c_custkey
        ELSE 'C' || (c_custkey - 1) END AS requested, CASE WHEN c_custkey % 2 = 0 THEN 'C' || c_custkey ELSE 'C' || (c_custkey - 1) END AS canonical
        FROM customer) r LEFT JOIN securities s ON s.symbol = canonical""",
    "securities",
)
def sym_resolve_join(t):
    k = F.col("c_custkey")
    spelled = F.when(k % 2 == 0, F.concat(F.lit(" c"), k)).otherwise(F.concat(F.lit("C"), k - 1))
    requests = t("customer").select(k.alias("position"), spelled.alias("requested"))
    return L.sym_resolve_join(requests, t("securities").select("symbol", "price")).select("position", "requested", "canonical", "price")


_TURN = "1998-04-01"


def _registry(t, later: bool):
    """The registry of the orders before or from a day on: priorities as entries, statuses as namespaces."""
    side = F.col("o_orderdate") >= _TURN if later else F.col("o_orderdate") < _TURN
    name = F.concat("o_orderpriority", F.lit("/"), F.col("o_custkey") % 700)
    return t("orders").where(side).groupBy(F.col("o_orderstatus").alias("namespace"), name.alias("name")).agg(
        F.count("*").alias("code"), (F.count("*") % 2).alias("kind")
    )


_REG = """SELECT o_orderstatus AS namespace, o_orderpriority || '/' || o_custkey % 700 AS name, count(*) AS code, count(*) % 2 AS kind
    FROM orders WHERE o_orderdate {0} TIMESTAMP '1998-04-01' GROUP BY ALL"""
_DIFF = f"""SELECT coalesce(a.namespace, b.namespace) AS namespace, coalesce(a.name, b.name) AS name,
        CASE WHEN a.name IS NULL THEN 'added' WHEN b.name IS NULL THEN 'removed' ELSE 'changed' END AS change,
        a.code AS old_code, b.code AS new_code, a.kind AS old_kind, b.kind AS new_kind
    FROM (SELECT * FROM ({_REG.format('<')}) WHERE namespace IN (SELECT o_orderstatus FROM orders WHERE o_orderdate >= TIMESTAMP '1998-04-01')) a
    FULL JOIN ({_REG.format('>=')}) b ON a.namespace = b.namespace AND a.name = b.name
    WHERE a.name IS NULL OR b.name IS NULL OR a.code <> b.code OR a.kind <> b.kind"""


@query("registry_diff_join", _DIFF)
def registry_diff_join(t):
    return L.registry_diff(_registry(t, False), _registry(t, True)).drop("fields")


@query("registry_diff", f"SELECT namespace, change, count(*) AS n FROM ({_DIFF}) GROUP BY namespace, change")
def registry_diff(t):
    return L.registry_diff(_registry(t, False), _registry(t, True)).groupBy("namespace", "change").agg(F.count("*").alias("n"))


@query(
    "requested_served",
    "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R' AND (l_partkey, l_suppkey) NOT IN (SELECT (l_partkey, l_suppkey) FROM lineitem WHERE l_returnflag <> 'R')",
)
def requested_served(t):
    pairs = t("lineitem").select("l_partkey", "l_suppkey", "l_returnflag")
    requested = pairs.where(F.col("l_returnflag") == "R").select("l_partkey", "l_suppkey").distinct()
    return L.requested_served_rows(requested, pairs.where(F.col("l_returnflag") != "R"), ["l_partkey", "l_suppkey"])


_RELEASES = "SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS release_date, o_totalprice AS actual FROM orders"


def _calendar_releases(t):
    calendar = t("customer").select(F.col("c_custkey").alias("symbol"), "c_name")
    detail = t("orders").select(F.col("o_custkey").alias("symbol"), F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("date").alias("release_date"), F.col("o_totalprice").alias("actual"))
    return calendar, detail


@query(
    "calendar_join_detail",
    f"""SELECT c_custkey, c_name, n_history, last_release, last_actual FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n_history,
        max(release_date) AS last_release, last(actual ORDER BY release_date, o_orderkey) AS last_actual FROM ({_RELEASES}) GROUP BY o_custkey) ON o_custkey = c_custkey""",
)
def calendar_join_detail(t):
    joined = L.calendar_join_detail(*_calendar_releases(t), tie="id")
    return joined.select(F.col("symbol").alias("c_custkey"), "c_name", "n_history", "last_release", "last_actual")


@query("calendar_join_rows", f"SELECT c_custkey, c_name, o_orderkey, release_date, actual FROM customer LEFT JOIN ({_RELEASES}) ON o_custkey = c_custkey")
def calendar_join_rows(t):
    joined = L.calendar_join_rows(*_calendar_releases(t))
    return joined.select(F.col("symbol").alias("c_custkey"), "c_name", F.col("id").alias("o_orderkey"), "release_date", "actual")


# ---------------------------------------------------------------- groups


def _rounded(df, *names: str):
    return df.withColumns({n: F.round(n, 6) for n in names if n in df.columns})


_W = "round(sum({0} * market_cap) / sum(market_cap), 6)"


@query(
    "group_aggregate",
    f"""SELECT sector AS name, count(*) AS stocks, round(sum(market_cap), 2) AS market_cap, CAST(sum(volume) AS BIGINT) AS volume,
        {_W.format('p_per_e')} AS p_per_e, {_W.format('dividend')} AS dividend, {_W.format('change_percent')} AS change_percent,
        {_W.format('rel_volume')} AS rel_volume FROM securities GROUP BY sector""",
    "securities",
)
def group_aggregate(t):
    rows = G.group_aggregate(t("securities"), "Sector")
    return _rounded(rows, "p_per_e", "dividend", "change_percent", "rel_volume").withColumn("market_cap", F.round("market_cap", 2))


@query(
    "group_subindustry",
    "SELECT industry AS name, count(*) AS stocks, round(sum(market_cap), 2) AS market_cap FROM securities WHERE sector = 'FURNITURE' GROUP BY industry",
    "securities",
)
def group_subindustry(t):
    rows = G.group_subindustry(t("securities"), "FURNITURE").select("name", "stocks", "market_cap")
    return rows.withColumn("market_cap", F.round("market_cap", 2))


@query(
    "group_capitalization",
    """SELECT CASE WHEN market_cap >= 20e6 THEN 'Mega' WHEN market_cap >= 1e6 THEN 'Large' WHEN market_cap >= 2e5 THEN 'Mid'
        WHEN market_cap >= 3e4 THEN 'Small' WHEN market_cap >= 5e3 THEN 'Micro' ELSE 'Nano' END AS name, count(*) AS stocks,
        CAST(sum(volume) AS BIGINT) AS volume FROM securities GROUP BY name""",
    "securities",
)
def group_capitalization(t):
    return G.group_capitalization(t("securities"), 1e-4).select("name", "stocks", "volume")


@query(
    "group_rollup",
    """SELECT sector, industry, CAST(CASE WHEN sector IS NULL THEN 3 WHEN industry IS NULL THEN 1 ELSE 0 END AS BIGINT) AS level, count(*) AS stocks,
        CAST(sum(volume) AS BIGINT) AS volume FROM instruments GROUP BY ROLLUP (sector, industry)""",
    "instruments",
)
def group_rollup(t):
    return G.group_rollup(t("instruments"), "sector", "industry").select("sector", "industry", "level", "stocks", "volume")


@query(
    "group_cube",
    """SELECT sector, exchange, CAST(grouping(sector) * 2 + grouping(exchange) AS BIGINT) AS level, count(*) AS stocks,
        CAST(sum(volume) AS BIGINT) AS volume FROM securities GROUP BY CUBE (sector, exchange)""",
    "securities",
)
def group_cube(t):
    return G.group_cube(t("securities"), "sector", "exchange").select("sector", "exchange", "level", "stocks", "volume")


@query(
    "group_views",
    f"""SELECT row_number() OVER (ORDER BY stocks DESC, name) AS rank, name, stocks, p_per_e, change_percent, '{GroupQuery('Country', 'custom', 'Number of Stocks', True, ('Stocks', 'P/E', 'Change %')).hash()}' AS query_hash,
        CAST(1 AS INTEGER) AS schema_version FROM (SELECT country AS name, count(*) AS stocks, {_W.format('p_per_e')} AS p_per_e, {_W.format('change_percent')} AS change_percent FROM securities GROUP BY country)""",
    "securities",
)
def group_views(t):
    q = GroupQuery("Country", "custom", "Number of Stocks", True, ("Stocks", "P/E", "Change %"))
    return _rounded(A.group(t("securities"), q), "p_per_e", "change_percent")


@query(
    "order_group",
    """SELECT row_number() OVER (ORDER BY volume DESC, name) AS rank, name, volume FROM (SELECT exchange AS name,
        CAST(sum(volume) AS BIGINT) AS volume FROM securities GROUP BY exchange)""",
    "securities",
)
def order_group(t):
    by_exchange = t("securities").groupBy(F.col("exchange").alias("name")).agg(*G.aggregates(t("securities")))
    return G.order_group(by_exchange, "Volume", True).select("rank", "name", "volume")


@query(
    "order_group_margin",
    """SELECT row_number() OVER (ORDER BY gross_margin DESC, name) AS rank, name, gross_margin FROM (SELECT exchange AS name,
        sum(rsi / 100 * market_cap) / sum(market_cap) AS gross_margin FROM securities GROUP BY exchange)""",
    "securities",
)
def order_group_margin(t):
    """An order whose measure is no column of the group table."""
    rows = t("securities").withColumn(R.GROUP_ORDERS["Gross Margin"], F.col("rsi") / 100)
    by_exchange = rows.groupBy(F.col("exchange").alias("name")).agg(*G.aggregates(rows))
    return G.order_group(by_exchange, "Gross Margin", True).select("rank", "name", F.col(R.GROUP_ORDERS["Gross Margin"]).alias("gross_margin"))


# ---------------------------------------------------------------- batch envelopes


def _units(t):
    """One unit per customer in a batch per nation; no orders means failure."""
    trades = t("orders").groupBy("o_custkey").agg(F.max("o_orderdate").alias("last"), F.count("*").alias("n"))
    joined = t("customer").join(trades, F.col("o_custkey") == F.col("c_custkey"), "left")
    return joined.select(
        F.col("c_nationkey").alias("batch"),
        F.concat(F.lit("C"), "c_custkey").alias("symbol"),
        F.col("c_custkey").alias("position"),
        F.col("n").isNotNull().alias("ok"),
        F.col("last").cast("timestamp").alias("fetched_at"),
        (F.col("n") > 5).alias("cache_hit"),
        F.col("n").alias("attempts"),
    )


_UNITS = """SELECT c_nationkey AS batch, c_custkey AS position, n IS NOT NULL AS ok, last AS fetched_at, n > 5 AS cache_hit, n AS attempts
    FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS last, count(*) AS n FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey"""
_STATUS = "CASE WHEN count(*) FILTER (ok) = 0 THEN 'FAILED' WHEN count(*) FILTER (ok) < count(*) THEN 'PARTIAL' ELSE 'COMPLETE' END"
_COUNTS = "count(*) AS requested_units, count(*) FILTER (ok) AS succeeded_units, count(*) FILTER (NOT ok) AS failed_units"


@query("completeness", f"SELECT batch, {_COUNTS}, {_STATUS} AS status FROM ({_UNITS}) GROUP BY batch")
def completeness(t):
    return Q.completeness(_units(t), ["batch"])


@query(
    "status_fold",
    f"""SELECT batch, {_STATUS} AS status, arg_min(fetched_at, position) FILTER (ok) AS fetched_at, max(fetched_at) FILTER (ok) AS last_fetched_at,
        bool_and(cache_hit) FILTER (ok) AS cache_hit, max(attempts) FILTER (ok) AS attempts, {_COUNTS} FROM ({_UNITS}) GROUP BY batch""",
)
def status_fold(t):
    return plain(Q.status_fold(_units(t), ["batch"]))


def _warned(t):
    rows = t("displays").select(
        F.concat(F.lit("K"), "k").alias("symbol"),
        F.col("display").alias("market_cap"),
        (F.col("k") % 3).cast("string").alias("odd_field"),
        F.lit(FETCHED).cast("timestamp").alias("fetched_at"),
    )
    return build_dataset(rows, "symbol_search", with_warnings=True)


@query(
    "warning_counts",
    """SELECT 'unknown_field' AS code, 'odd_field' AS field, count(*) AS n FROM displays UNION ALL
    SELECT 'null_sentinel', 'market_cap', count(*) FROM displays WHERE display IN ('-', 'N/A', '') UNION ALL
    SELECT 'conversion_failed', 'market_cap', count(*) FROM displays WHERE k % 13 IN (8, 12)""",
    "displays",
)
def warning_counts(t):
    return Q.warning_counts(_warned(t))


@query(
    "long_to_wide",
    """SELECT symbol, period_label, max(value) FILTER (metric = 'Orders') AS orders, max(value) FILTER (metric = 'Total Revenue') AS revenue
    FROM (SELECT 'C' || o_custkey AS symbol, y || 'FY' AS period_label, 'Orders' AS metric, CAST(n AS DOUBLE) AS value FROM periods
        UNION ALL SELECT 'C' || o_custkey, y || 'FY', 'Total Revenue', CAST(cents AS DOUBLE) / 100 FROM periods) GROUP BY symbol, period_label""",
    "periods",
)
def long_to_wide(t):
    wide = L.long_to_wide(A.statements(t("statement_docs")), ["symbol", "period_label"], "metric", "value", ["Orders", "Total Revenue"])
    return wide.select("symbol", "period_label", F.col("Orders").alias("orders"), F.col("Total Revenue").alias("revenue"))


@query(
    "distinct_count",
    "SELECT l_returnflag, count(DISTINCT l_partkey) AS symbols, true AS close FROM lineitem GROUP BY l_returnflag",
)
def distinct_count(t):
    """Exact and approximate universe sizes; the sketch must stay within 10 %."""
    grouped = t("lineitem").groupBy("l_returnflag").agg(
        F.countDistinct("l_partkey").alias("symbols"), F.approx_count_distinct("l_partkey", 0.02).alias("sketch")
    )
    near = F.abs(F.col("sketch") - F.col("symbols")) <= F.col("symbols") * 0.1
    return grouped.select("l_returnflag", "symbols", near.alias("close"))


# ---------------------------------------------------------------- ranks, pages, order


@query(
    "rank_screen",
    "SELECT row_number() OVER (ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity) AS rank, l_orderkey, l_linenumber, l_extendedprice FROM lineitem",
)
def rank_screen(t):
    """The rank of every row of the largest table, without a one-task window."""
    keys = [F.col("l_extendedprice").desc_nulls_last()] + [F.col(c).asc() for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")]
    rows = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    return K.global_rank(rows, keys).select("rank", "l_orderkey", "l_linenumber", "l_extendedprice")


@query(
    "rank_in_group",
    "SELECT sector, symbol, market_cap, rank FROM (SELECT *, row_number() OVER (PARTITION BY sector ORDER BY market_cap DESC, symbol) AS rank FROM securities) WHERE rank <= 5",
    "securities",
)
def rank_in_group(t):
    rows = t("securities").select("sector", "symbol", "market_cap")
    return K.rank_in_group(rows, ["sector"], K.order_keys("market_cap", True), 5)


_UNITS = "SELECT u.unit, CAST(date_trunc(u.unit, l_shipdate) AS DATE) AS start, l_returnflag, count(*) AS n_rows, count(DISTINCT l_partkey) AS symbols, true AS close FROM lineitem, (VALUES ('day'), ('week'), ('month'), ('year')) u(unit) GROUP BY ALL"


@query("distinct_rollup", _UNITS)
def distinct_rollup(t):
    """Universe sizes of days, weeks, months and years from one table of daily sketches, beside the exact counts."""
    lines = t("lineitem").select("l_returnflag", "l_partkey", "l_shipdate")
    table = SketchTable(scratch(t, "sketches"), ["l_returnflag"], "l_partkey", "l_shipdate", period="year")
    table.put(lines)
    out = None
    for unit in ("day", "week", "month", "year"):
        start = F.date_trunc(unit, "l_shipdate").cast("date").alias("start")
        exact = lines.groupBy("l_returnflag", start).agg(F.countDistinct("l_partkey").alias("symbols"))
        both = table.counts(t.spark, unit).join(exact, ["l_returnflag", "start"])
        near = F.abs(F.col("estimate") - F.col("symbols")) <= F.greatest(F.lit(1), F.col("symbols") * error_bound())
        part = both.select("unit", "start", "l_returnflag", "n_rows", "symbols", near.alias("close"))
        out = part if out is None else out.unionByName(part)
    return out


@query("rank_position", "SELECT l_orderkey, CAST(l_linenumber + 1 AS BIGINT) AS rank FROM lineitem")
def rank_position(t):
    return K.rank_position(t("lineitem").select("l_orderkey", "l_linenumber"), "l_orderkey", "l_linenumber").select("l_orderkey", "rank")


@query(
    "period_length",
    """SELECT 'C' || o_custkey AS symbol, metric, y || 'FY' AS period_label, end_date - lead(end_date) OVER (PARTITION BY o_custkey, metric ORDER BY y DESC) AS days FROM periods, (VALUES ('Orders'), ('Total Revenue')) m(metric)""",
    "periods",
)
def period_length(t):
    rows = A.statements(t("statement_docs"))
    return rows.select("symbol", "metric", "period_label", F.col("period_length_days").alias("days"))


@query(
    "dedupe_first",
    "SELECT user_id, event_type, min(event_id) AS event_id, arg_min(value, event_id) AS value FROM events GROUP BY user_id, event_type",
)
def dedupe_first(t):
    rows = t("events").select("user_id", "event_type", "event_id", "value")
    return K.dedupe_first(rows, ["user_id", "event_type"], ["event_id"])


@query("dup_check", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def dup_check(t):
    return K.dup_check(t("lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "order_screen",
    "SELECT symbol, p_per_e, row_number() OVER (ORDER BY p_per_e ASC NULLS LAST, symbol) AS at FROM securities",
    "securities",
)
def order_screen(t):
    """A full named order, numbered so that the order itself is compared."""
    rows = t("securities").select("symbol", "p_per_e")
    return K.global_rank(rows, K.order_keys(R.ORDERS["Price/Earnings"]), "at")


@query(
    "page",
    "SELECT rank, symbol, market_cap FROM (SELECT *, row_number() OVER (ORDER BY market_cap DESC, symbol) AS rank FROM securities) WHERE rank BETWEEN 21 AND 40",
    "securities",
)
def page(t):
    return K.page(t("securities").select("symbol", "market_cap"), K.order_keys("market_cap", True), 2)


_PRICED = "SELECT *, row_number() OVER (ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity) AS rank, count(*) OVER () AS n FROM lineitem"


@query(
    "page_indexed",
    f"""SELECT p.name, rank, l_orderkey, l_linenumber, l_extendedprice FROM ({_PRICED})
    JOIN (VALUES ('first', 1), ('middle', 2), ('last', 3)) p(name, k) ON (rank - 1) // 20 = CASE k WHEN 1 THEN 0 WHEN 2 THEN n // 40 ELSE (n - 1) // 20 END""",
)
def page_indexed(t):
    """Three pages of the largest table from one stored order: the first, a middle one, the last."""
    keys = [F.col("l_extendedprice").desc_nulls_last()] + [F.col(c).asc() for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")]
    rows = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    index = RankIndex.build(rows, keys, scratch(t, "order"), part_rows=10_000)
    at = {"first": 1, "middle": index.total // 40 + 1, "last": (index.total - 1) // 20 + 1}
    pages = [index.page(n).withColumn("name", F.lit(name)) for name, n in at.items()]
    out = pages[0].unionByName(pages[1]).unionByName(pages[2])
    return out.select("name", "rank", "l_orderkey", "l_linenumber", "l_extendedprice")


@query(
    "walk_limits",
    "SELECT count(*) AS total_rows, CASE WHEN count(*) > 60 THEN 'PARTIAL' ELSE 'COMPLETE' END AS status, CASE WHEN count(*) > 60 THEN 'max_rows_reached' END AS stop_code, CAST(4 AS BIGINT) AS requested_units, CAST(3 AS BIGINT) AS succeeded_units, CAST(1 AS BIGINT) AS failed_units, CAST(60 AS BIGINT) AS n_rows FROM securities",
    "securities",
)
def walk_limits(t):
    rows, facts = K.walk_limits(t("securities").select("symbol", "market_cap"), K.order_keys("market_cap", True), max_rows=45)
    return facts.crossJoin(rows.agg(F.count("*").alias("n_rows")))  # one row by one row


@query(
    "top_k",
    "SELECT row_number() OVER (ORDER BY change_percent DESC, symbol) AS rank, symbol, change_percent FROM securities ORDER BY change_percent DESC, symbol LIMIT 25",
    "securities",
)
def top_k(t):
    return K.top_k(t("securities").select("symbol", "change_percent"), K.order_keys("change_percent", True), 25)


@query(
    "is_final_page",
    "SELECT o_orderkey, (o_custkey % 25 < 20) OR (o_orderkey + 20 > o_custkey * 10) AS final FROM orders",
)
def is_final_page(t):
    rows = F.col("o_custkey") % 25
    return t("orders").select("o_orderkey", P.is_final_page(rows, F.col("o_orderkey"), F.col("o_custkey") * 10).alias("final"))


@query(
    "page_facts",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN o_custkey + 1 END AS page_start, CASE WHEN o_orderkey % 3 > 0 THEN 1000000 + o_orderkey END AS total_rows FROM orders",
)
def page_facts(t):
    k = F.col("o_orderkey")
    marker = F.concat(F.lit("#"), F.col("o_custkey") + 1, F.lit(" / "), F.format_number(k + 1000000, 0), F.lit(" Total"))
    facts = P.page_facts(F.when(k % 3 > 0, marker).otherwise(F.lit("Total")))
    return t("orders").select("o_orderkey", facts.alias("f")).select("o_orderkey", "f.*")


# ---------------------------------------------------------------- sets and composition


@query(
    "concat_strict",
    "SELECT symbol, sector, industry, price FROM instruments UNION ALL SELECT symbol, sector, industry, price FROM securities",
    "instruments",
    "securities",
)
def concat_strict(t):
    columns = ["symbol", "sector", "industry", "price"]
    return L.concat_strict([t("instruments").select(*columns), t("securities").select(*columns)])


@query(
    "concat_projection",
    "SELECT 'P' || p_partkey AS symbol, 'Signal ' || p_size AS signal, p_name AS url FROM part UNION ALL SELECT 'S' || s_suppkey, 'Supplier', s_name FROM supplier",
)
def concat_projection(t):
    stamp = F.lit(FETCHED).cast("timestamp").alias("fetched_at")
    part = t("part").select(
        F.concat(F.lit("P"), "p_partkey").alias("symbol"), F.concat(F.lit("Signal "), "p_size").alias("signal"), F.col("p_name").alias("url"), stamp
    )
    supplier = t("supplier").select(F.concat(F.lit("S"), "s_suppkey").alias("symbol"), F.lit("Supplier").alias("signal"), F.col("s_name").alias("url"), stamp)
    built = [build_dataset(x, "quote_signals") for x in (part, supplier)]
    return L.concat_projection(t.spark, "quote_signals", [built[0], None, built[1]]).select("symbol", "signal", "url")


@query("empty_typed", "SELECT symbol, sector, price, CAST(count(*) AS BIGINT) AS n FROM securities GROUP BY ALL", "securities")
def empty_typed_(t):
    """The registered empty table unites with a populated one of the same schema."""
    rows = t("securities").select("symbol", "sector", F.col("price").cast("string").alias("price"), F.col("fetched_at"))
    built = build_dataset(rows, "quote_snapshot")
    both = L.concat_strict([built, empty_typed(t.spark, "quote_snapshot")])
    return both.groupBy("symbol", "sector", "price").agg(F.count("*").alias("n"))


@query(
    "set_diff",
    """SELECT l_partkey, CASE WHEN o IS NULL THEN 'added' WHEN n IS NULL THEN 'removed' ELSE 'common' END AS side FROM
    (SELECT l_partkey, max(CASE WHEN l_linestatus = 'F' THEN 1 END) AS o, max(CASE WHEN l_linestatus = 'O' THEN 1 END) AS n FROM lineitem GROUP BY l_partkey)""",
)
def set_diff(t):
    rows = t("lineitem").select("l_partkey", "l_linestatus")
    return L.set_diff(rows.where(F.col("l_linestatus") == "F").select("l_partkey"), rows.where(F.col("l_linestatus") == "O").select("l_partkey"))


_LONG = """SELECT 'C' || o_custkey AS symbol, y || 'FY' AS period_label, end_date AS period_end_date, 'Orders' AS metric, CAST(n AS DOUBLE) AS value FROM periods
    UNION ALL SELECT 'C' || o_custkey, y || 'FY', end_date, 'Total Revenue', CAST(cents AS DOUBLE) / 100 FROM periods"""


@query("stmt_long", f"SELECT *, 'income' AS statement_kind, 'annual' AS periodicity, 'USD' AS currency FROM ({_LONG})", "periods")
def stmt_long(t):
    rows = A.statements(t("statement_docs"))
    return rows.select("symbol", "period_label", "period_end_date", "metric", "value", "statement_kind", "periodicity", "currency")


@query(
    "stmt_codes",
    """SELECT p_partkey, code, CASE code WHEN 'IA' THEN 'income' WHEN 'BQ' THEN 'balance' WHEN 'CA' THEN 'cashflow' END AS kind,
        CASE code WHEN 'BQ' THEN 'quarterly' WHEN 'XX' THEN NULL ELSE 'annual' END AS periodicity
    FROM (SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'IA' WHEN 1 THEN 'BQ' WHEN 2 THEN 'CA' ELSE 'XX' END AS code FROM part)""",
)
def stmt_codes(t):
    s = F.col("p_size") % 4
    code = F.when(s == 0, F.lit("IA")).when(s == 1, F.lit("BQ")).when(s == 2, F.lit("CA")).otherwise(F.lit("XX"))
    return t("part").select("p_partkey", code.alias("code"), L.stmt_codes(code).alias("c")).select("p_partkey", "code", "c.kind", "c.periodicity")


def _batch(t):
    k = F.col("c_custkey")
    requests = t("customer").select(k.alias("position"), F.concat(F.when(k % 2 == 0, F.lit("c")).otherwise(F.lit(" C")), k).alias("requested"))
    return A.statements_batch(t("statement_docs"), requests, "IA")


@query(
    "stmt_batch",
    "SELECT CASE WHEN count(o_custkey) < count(*) THEN 'PARTIAL' ELSE 'COMPLETE' END AS status, count(*) AS requested_units, count(o_custkey) AS succeeded_units, count(*) - count(o_custkey) AS failed_units FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders) ON o_custkey = c_custkey",
)
def stmt_batch(t):
    return _batch(t)["metadata"].select("status", "requested_units", "succeeded_units", "failed_units")


def _mixed_batch(t):
    """Two captures per customer (the older one empty), and spellings that are no symbol."""
    k = F.col("c_custkey")
    spelled = F.when(k % 10 == 0, F.concat(F.lit("bad symbol "), k)).otherwise(F.concat(F.lit("c"), k))
    docs = t("statement_docs")
    older = docs.withColumns({"fetched_at": F.col("fetched_at") - F.expr("interval 1 day"), "body": F.lit('{"error":"no data"}')})
    return A.statements_batch(docs.unionByName(older), t("customer").select(k.alias("position"), spelled.alias("requested")), "IA")


@query(
    "stmt_batch_mixed",
    "SELECT CASE WHEN c_custkey % 10 = 0 THEN 'bad symbol ' || c_custkey ELSE 'C' || c_custkey END AS symbol, 'unit_failed' AS code, CASE WHEN c_custkey % 10 = 0 THEN 'invalid symbol' ELSE 'no capture' END AS message FROM customer WHERE c_custkey % 10 = 0 OR c_custkey NOT IN (SELECT o_custkey FROM orders)",
)
def stmt_batch_mixed(t):
    return _mixed_batch(t)["unit_errors"]


@query(
    "stmt_batch_mixed_status",
    """SELECT CASE WHEN count_if(ok) < count(*) THEN 'PARTIAL' ELSE 'COMPLETE' END AS status, count(*) AS requested_units, CAST(count_if(ok) AS BIGINT) AS succeeded_units,
        CAST(count(*) - count_if(ok) AS BIGINT) AS failed_units FROM (SELECT c_custkey % 10 > 0 AND c_custkey IN (SELECT o_custkey FROM orders) AS ok FROM customer)""",
)
def stmt_batch_mixed_status(t):
    return _mixed_batch(t)["metadata"].select("status", "requested_units", "succeeded_units", "failed_units")


@query(
    "stmt_batch_mixed_data",
    "SELECT 'C' || o_custkey AS symbol, 2 * count(*) AS n FROM periods WHERE o_custkey % 10 > 0 AND o_custkey IN (SELECT c_custkey FROM customer) GROUP BY o_custkey",
    "periods",
)
def stmt_batch_mixed_data(t):
    return _mixed_batch(t)["data"].groupBy("symbol").agg(F.count("*").alias("n"))


@query(
    "map_bundle",
    """SELECT (SELECT count(*) FROM leaves) AS n_constituents, (SELECT count(perf) FROM leaves l JOIN perf p ON l.symbol = p.symbol) AS n_with_perf,
        (SELECT count(DISTINCT sector) FROM leaves) AS n_sectors, (SELECT count(*) FROM perf WHERE symbol NOT IN (SELECT symbol FROM leaves)) AS n_unmapped""",
    "leaves",
    "perf",
)
def map_bundle(t):
    return L.map_bundle(t("leaves"), t("perf"))["facts"]


# ---------------------------------------------------------------- quality


@query(
    "dq_contract",
    "SELECT 'quote_snapshot' AS dataset, CAST(0 AS BIGINT) AS problems, CAST(0 AS BIGINT) AS null_keys, count(*) AS n FROM securities",
    "securities",
)
def dq_contract_(t):
    rows = t("securities").select("symbol", "sector", F.col("price").cast("string").alias("price"), "fetched_at")
    built = build_dataset(rows, "quote_snapshot")
    gaps = dq_contract_nulls(built, "quote_snapshot")
    total = sum((F.col(c) for c in gaps.columns), F.lit(0)).cast("bigint")
    problems = len(dq_contract(built, "quote_snapshot"))
    counted = built.agg(F.count("*").alias("n"))
    return gaps.select(
        F.lit(dataset("quote_snapshot").name).alias("dataset"), F.lit(problems).cast("bigint").alias("problems"), total.alias("null_keys")
    ).crossJoin(counted)  # one row by one row


@query(
    "dq_required",
    "SELECT 'symbol' AS field, count(*) FILTER (display IN ('-', 'N/A', '')) AS n_missing FROM displays UNION ALL SELECT 'k', CAST(0 AS BIGINT) FROM (SELECT 1)",
    "displays",
)
def dq_required(t):
    return Q.dq_required(t("displays").select(F.col("display").alias("symbol"), "k"), ["symbol", "k"])


@query(
    "dq_quarantine",
    "SELECT k, 'symbol' AS missing FROM displays WHERE display IN ('-', 'N/A', '')",
    "displays",
)
def dq_quarantine(t):
    rows = t("displays").select("k", F.col("display").alias("symbol"), F.lit(FETCHED).cast("timestamp").alias("fetched_at"))
    _, bad = split_required(rows, "symbol_universe")
    return bad.select("k", F.array_join("missing_fields", ",").alias("missing"))


def _mixed_rows(t):
    rank = F.when(F.col("k") % 5 == 0, F.lit("x")).when(F.col("k") % 7 == 0, F.lit("-")).otherwise(F.col("k").cast("string"))
    return t("displays").select(F.concat(F.lit("S"), "k").alias("symbol"), rank.alias("rank"), F.lit(FETCHED).cast("timestamp").alias("fetched_at"))


@query("dq_split_good", "SELECT 'S' || k AS symbol, CAST(k AS BIGINT) AS rank FROM displays WHERE k % 5 > 0 AND k % 7 > 0", "displays")
def dq_split_good(t):
    """Rows that fit a dataset come through whatever their neighbours hold."""
    return split_dataset(_mixed_rows(t), "earnings_screen")[0].select("symbol", "rank")


@query(
    "dq_split_bad",
    "SELECT CASE WHEN k % 5 = 0 THEN 'rank: cannot convert x' ELSE 'rank: required value is null' END AS problem, count(*) AS n FROM displays WHERE k % 5 = 0 OR k % 7 = 0 GROUP BY ALL",
    "displays",
)
def dq_split_bad(t):
    bad = split_dataset(_mixed_rows(t), "earnings_screen")[1]
    return bad.select(F.array_join("problems", ",").alias("problem")).groupBy("problem").agg(F.count("*").alias("n"))


@query(
    "dq_strict",
    "SELECT symbol, earnings_date, CAST(0 AS INTEGER) AS n_warnings FROM securities",
    "securities",
)
def dq_strict(t):
    rows = t("securities").select("symbol", "earnings_date", F.lit(1).cast("bigint").alias("rank"), "fetched_at")
    built = Q.dq_strict(build_dataset(rows, "earnings_screen", with_warnings=True))
    return built.select("symbol", "earnings_date", F.size("warnings").alias("n_warnings"))


@query(
    "dq_conversion",
    "SELECT k, k % 13 IN (8, 12) AS failed FROM displays",
    "displays",
)
def dq_conversion(t):
    shown = F.col("display")
    return t("displays").select("k", Q.dq_conversion(shown, N.norm_compact(shown)).alias("failed"))


@query(
    "dq_unknown_field",
    "SELECT event_type AS field, count(*) AS n FROM events WHERE event_type NOT IN ('click', 'view') GROUP BY event_type",
)
def dq_unknown_field(t):
    bag = F.create_map(F.col("event_type"), F.col("props"))
    return Q.dq_unknown_field(t("events").select(bag.alias("bag")), "bag", ["click", "view"])


@query(
    "dq_fixture_hygiene",
    r"""SELECT doc_id, reasons FROM (SELECT doc_id, rtrim(CASE WHEN contains(lower(text), 'password=') THEN 'password=|' ELSE '' END || CASE WHEN contains(lower(text), 'token = "') THEN 'token = "|' ELSE '' END
        || CASE WHEN contains(lower(text), 'akia') THEN 'AKIA|' ELSE '' END || CASE WHEN regexp_matches(text, '://[^/\s]*@') THEN 'url credentials|' ELSE '' END
        || CASE WHEN strlen(text) > 20000 THEN 'too large|' ELSE '' END, '|') AS reasons FROM documents) WHERE reasons <> ''""",
)
def dq_fixture_hygiene(t):
    bad = Q.dq_fixture_hygiene(t("documents"), "doc_id", "text", ("password=", 'token = "', "AKIA"), 20000)
    return bad.select("doc_id", F.array_join("reasons", "|").alias("reasons"))


# ---------------------------------------------------------------- entry points


@query(
    "entry_screen",
    f"""SELECT rank, symbol, company, sector, country, market_cap, price, change_percent, fetched_at, '{FLAGSHIP.hash()}' AS query_hash, CAST(1 AS INTEGER) AS schema_version
    FROM (SELECT *, row_number() OVER (ORDER BY market_cap DESC, symbol) AS rank FROM securities WHERE sector = 'BUILDING' AND market_cap > 1000000)
    WHERE rank <= 20""",
    "securities",
)
def entry_screen(t):
    """The flagship: one sector, large caps, by market cap, first page."""
    return plain(A.screen_page(t("securities"), FLAGSHIP))


@query(
    "screen",
    """SELECT rank, symbol, company, sector, country, market_cap, price, change_percent, status, total_rows, succeeded_units FROM (
        SELECT *, row_number() OVER (ORDER BY market_cap DESC, symbol) AS rank, count(*) OVER () AS total_rows,
               CASE WHEN count(*) OVER () > 40 THEN 'PARTIAL' ELSE 'COMPLETE' END AS status, CAST(least(2, ceil(count(*) OVER () / 20.0)) AS BIGINT) AS succeeded_units
        FROM securities WHERE sector = 'BUILDING' AND market_cap > 1000000) WHERE rank <= 40""",
    "securities",
)
def screen(t):
    """The public screen: a walk of two pages, each row beside the walk's status."""
    result = A.screen(t("securities"), FLAGSHIP, max_pages=2)
    facts = result.metadata.select("status", "total_rows", "succeeded_units")
    return plain(result.data.drop("fetched_at", "extra_fields").crossJoin(facts))  # one row


@query(
    "entry_earnings",
    f"""SELECT row_number() OVER (ORDER BY symbol) AS rank, symbol, {_EARN_DAY} AS earnings_date, earnings AS earnings_date_raw, earnings_session, fetched_at
    FROM securities WHERE {_EARN_DAY} BETWEEN DATE '2001-08-01' AND DATE '2001-08-31'""",
    "securities",
)
def entry_earnings(t):
    rows = t("securities").drop("earnings_date", "earnings_session")
    return plain(A.earnings(rows, as_of=as_of(), when="This Month").data)


@query(
    "entry_statements_batch",
    """SELECT 'C' || c_custkey AS symbol, 'unit_failed' AS code, 'no capture' AS message FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
    UNION ALL SELECT 'S' || s_suppkey, 'unit_failed', 'no capture' FROM supplier""",
)
def entry_statements_batch(t):
    """Unit errors when suppliers, who publish no statements, are asked for too."""
    asked = t("customer").select(F.col("c_custkey").alias("position"), F.concat(F.lit("c"), "c_custkey").alias("requested"))
    more = t("supplier").select((F.col("s_suppkey") + 10**9).alias("position"), F.concat(F.lit("s"), "s_suppkey").alias("requested"))
    return A.statements_batch(t("statement_docs"), asked.unionByName(more), "IA")["unit_errors"]


@query(
    "entry_signal",
    "SELECT row_number() OVER (ORDER BY volume DESC, symbol) AS rank, symbol, company, sector, industry, country, market_cap, price, fetched_at FROM securities WHERE volume > 0",
    "securities",
)
def entry_signal(t):
    return plain(A.signal(t("securities"), "Most Active").data)

