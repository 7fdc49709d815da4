"""Scalar, array, map and JSON operators against the benchmark tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickweave.functions import hashing as H
from tickweave.functions import numeric as N
from tickweave.functions import temporal as M
from tickweave.functions import text as X
from tickweave.operators.dataset import extra_fields_split
from tickweave.operators.quality import row_identity
from tickweave.plans import families as P
from tickweave.plans import registry as R
from tickweave.plans.query import Filter, Order, ScreenQuery
from tickweave.sources.embedded import x_js_literal

from .core import query

HOST = "market.example"
ORIGIN = "https://market.example"

# ---------------------------------------------------------------- numbers

_CLEAN = "regexp_replace(replace(display, ',', ''), '%\\s*$', '')"
_COMPACT = "'[+-]?[0-9]+(\\.[0-9]+)?[KMBTkmbt]'"


def _sql_scaled(text: str) -> str:
    return (
        f"TRY_CAST(substr({text}, 1, length({text}) - 1) || 'e' || CASE upper(right({text}, 1)) "
        "WHEN 'K' THEN '3' WHEN 'M' THEN '6' WHEN 'B' THEN '9' ELSE '12' END AS DOUBLE)"
    )


def _numbers(name: str, expression, sql: str):
    @query(name, f"SELECT k, display, {sql} AS value FROM displays", "displays")
    def run(t):
        return t("displays").select("k", "display", expression(F.col("display")).alias("value"))


_SENTINELS = "display IN ('', '-', '--', '---', '—', '–', 'n/a', 'N/A', 'NA', 'None', 'null')"
_numbers("norm_sentinel", N.norm_sentinel, f"CASE WHEN NOT {_SENTINELS} THEN display END")
_numbers(
    "norm_compact",
    N.norm_compact,
    f"CASE WHEN regexp_full_match({_CLEAN}, {_COMPACT}) THEN {_sql_scaled(_CLEAN)} ELSE TRY_CAST({_CLEAN} AS DOUBLE) END",
)
_numbers("norm_percent", N.norm_percent, f"TRY_CAST({_CLEAN} AS DOUBLE) / 100")
_numbers("norm_number", N.norm_number, "TRY_CAST(replace(display, ',', '') AS DOUBLE)")
_numbers(
    "norm_int",
    N.norm_int,
    "CASE WHEN regexp_full_match(replace(display, ',', ''), '[+-]?[0-9]+') THEN TRY_CAST(replace(display, ',', '') AS BIGINT) END",
)
_numbers(
    "norm_count",
    N.norm_count,
    # Exact decimals stand in for the digit arithmetic: every display here fits.
    f"""CASE WHEN regexp_full_match(replace(display, ',', ''), '[+-]?[0-9]+(\\.[0-9]+)?[KMBTkmbt]?') THEN
        (SELECT CASE WHEN v = trunc(v) THEN TRY_CAST(v AS BIGINT) END FROM (SELECT
          TRY_CAST(regexp_replace(replace(display, ',', ''), '[KMBTkmbt]$', '') AS DECIMAL(20, 4))
          * CASE upper(right(display, 1)) WHEN 'K' THEN 1000::BIGINT WHEN 'M' THEN 1000000::BIGINT
            WHEN 'B' THEN 1000000000::BIGINT WHEN 'T' THEN 1000000000000::BIGINT ELSE 1::BIGINT END AS v)) END""",
)
_numbers(
    "norm_ragged",
    N.norm_ragged,
    f"""CASE WHEN display IN ('', '-') THEN NULL WHEN right(display, 1) = '%' THEN TRY_CAST({_CLEAN} AS DOUBLE) / 100
        WHEN regexp_full_match(display, '-?[0-9]+(\\.[0-9]+)?[KMBT]') THEN {_sql_scaled('display')}
        ELSE TRY_CAST(replace(display, ',', '') AS DOUBLE) END""",
)
_numbers(
    "norm_market_pct",
    N.norm_market_pct,
    f"""CASE WHEN display IN ('', '-') THEN NULL WHEN right(display, 1) = '%' THEN TRY_CAST({_CLEAN} AS DOUBLE) / 100
        ELSE TRY_CAST(replace(display, ',', '') AS DOUBLE) END""",
)


@query(
    "fmt_compact",
    """SELECT l_orderkey, l_extendedprice,
        CASE WHEN l_extendedprice >= 1000 THEN format('{:.2f}B', l_extendedprice / 1000)
             WHEN l_extendedprice >= 1 THEN format('{:.2f}M', l_extendedprice)
             ELSE format('{:.2f}K', l_extendedprice * 1000) END AS cap,
        format('{:.4g}%', l_extendedprice / 100) AS points,
        format('{:,}', CAST(floor(l_extendedprice) AS BIGINT)) AS volume,
        strftime(l_shipdate, '%b %-d, %Y') || CASE WHEN l_linenumber % 2 = 0 THEN ' AMC' ELSE '' END AS earnings
    FROM lineitem""",
)
def fmt_compact(t):
    price = F.col("l_extendedprice")
    clock = F.when(F.col("l_linenumber") % 2 == 0, F.lit("T16:30:00Z")).otherwise(F.lit(""))
    return t("lineitem").select(
        "l_orderkey",
        "l_extendedprice",
        N.fmt_compact_millions(price).alias("cap"),
        N.fmt_percent_points(price / 100).alias("points"),
        N.fmt_volume(F.floor(price)).alias("volume"),
        M.fmt_earnings_date(F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), clock)).alias("earnings"),
    )


# ---------------------------------------------------------------- dates


def _dates(name: str, shown, expression, sql: str, sql_shown: str):
    @query(name, f"SELECT k, {sql_shown} AS display, {sql} AS value FROM days", "days")
    def run(t):
        base = t("days").withColumn("display", shown())
        return base.select("k", "display", expression(F.col("display")).alias("value"))


def _iso(day: str = "d") -> str:
    return f"strftime({day}, '%Y-%m-%d')"


def _k():
    return F.col("k")


_dates(
    "norm_date_iso",
    lambda: F.when(_k() % 5 == 0, F.date_format("d", "yyyy/MM/dd")).otherwise(F.date_format("d", "yyyy-MM-dd")),
    M.norm_date_iso,
    "CASE WHEN k % 5 <> 0 THEN d END",
    f"CASE WHEN k % 5 = 0 THEN strftime(d, '%Y/%m/%d') ELSE {_iso()} END",
)
_dates(
    "norm_date_us",
    lambda: F.when(_k() % 5 == 0, F.lit("2/30/2001")).when(_k() % 5 == 1, F.lit("")).otherwise(F.date_format("d", "M/d/yyyy")),
    M.norm_date_us,
    "CASE WHEN k % 5 > 1 THEN d END",
    "CASE k % 5 WHEN 0 THEN '2/30/2001' WHEN 1 THEN '' ELSE strftime(d, '%-m/%-d/%Y') END",
)
_dates(
    "norm_date_mon",
    lambda: F.when(_k() % 5 == 0, F.lit("soon")).otherwise(F.date_format("d", "MMM d, yyyy")),
    M.norm_date_mon,
    "CASE WHEN k % 5 <> 0 THEN d END",
    "CASE WHEN k % 5 = 0 THEN 'soon' ELSE strftime(d, '%b %-d, %Y') END",
)
_dates(
    "norm_date_rating",
    lambda: F.date_format("d", "MMM-dd-yy"),
    M.norm_date_rating,
    "CAST(make_date(2000 + (year(d) % 100), month(d), day(d)) AS DATE)",
    "strftime(d, '%b-%d-%y')",
)
_dates(
    "norm_date_insider",
    lambda: F.date_format("d", "MMM dd ''yy"),
    M.norm_date_insider,
    "CAST(make_date(2000 + (year(d) % 100), month(d), day(d)) AS DATE)",
    "strftime(d, '%b %d ''%y')",
)


_EARN = """CASE k % 5 WHEN 0 THEN strftime(d, '%b %-d, %Y') WHEN 1 THEN strftime(d, '%b %-d') || '/b'
    WHEN 2 THEN strftime(d, '%B %-d') || ' AMC' WHEN 3 THEN strftime(d, '%b %-d') ELSE 'TBD' END"""


def _earnings_display():
    return (
        F.when(_k() % 5 == 0, F.date_format("d", "MMM d, yyyy"))
        .when(_k() % 5 == 1, F.concat(F.date_format("d", "MMM d"), F.lit("/b")))
        .when(_k() % 5 == 2, F.concat(F.date_format("d", "MMMM d"), F.lit(" AMC")))
        .when(_k() % 5 == 3, F.date_format("d", "MMM d"))
        .otherwise(F.lit("TBD"))
    )


@query(
    "norm_date_earnings",
    f"""SELECT k, {_EARN} AS display, anchor, CASE WHEN k % 5 = 4 THEN NULL WHEN k % 5 = 0 THEN d
        ELSE (SELECT CASE WHEN c IS NULL THEN NULL
               WHEN c - anchor > 180 THEN TRY_CAST((year(anchor) - 1) || strftime(d, '-%m-%d') AS DATE)
               WHEN anchor - c > 180 THEN TRY_CAST((year(anchor) + 1) || strftime(d, '-%m-%d') AS DATE) ELSE c END
              FROM (SELECT TRY_CAST(year(anchor) || strftime(d, '-%m-%d') AS DATE) AS c)) END AS value
    FROM days""",
    "days",
)
def norm_date_earnings(t):
    shown = _earnings_display()
    return t("days").select("k", shown.alias("display"), "anchor", M.norm_date_earnings(shown, F.col("anchor")).alias("value"))


@query(
    "norm_session",
    f"SELECT k, {_EARN} AS display, CASE k % 5 WHEN 1 THEN 'BMO' WHEN 2 THEN 'AMC' END AS value FROM days",
    "days",
)
def norm_session(t):
    shown = _earnings_display()
    return t("days").select("k", shown.alias("display"), M.norm_session(shown).alias("value"))


_UTC = "timezone('UTC', timezone('America/New_York', {0}))"
_WALL = "timezone('America/New_York', timezone('UTC', {0}))"
_AMBIG = (
    f"({_WALL.format('u')} <> n OR {_WALL.format('u + INTERVAL 1 HOUR')} = n OR {_WALL.format('u - INTERVAL 1 HOUR')} = n)"
)


@query(
    "norm_ts_eastern",
    f"""SELECT k, display, CASE WHEN n IS NOT NULL AND NOT {_AMBIG} THEN u END AS value,
        CASE WHEN n IS NULL THEN NULL WHEN {_AMBIG} THEN 'ambiguous' WHEN k % 3 = 0 THEN 'anchored' ELSE 'exact' END AS status
    FROM (SELECT *, {_UTC.format('n')} AS u FROM (SELECT k, CASE k % 3
            WHEN 0 THEN h || ':' || lpad(CAST(m AS VARCHAR), 2, '0')
            WHEN 1 THEN {_iso()} || 'T' || lpad(CAST(h AS VARCHAR), 2, '0') || ':30:00'
            ELSE CASE WHEN h % 2 = 0 THEN '2001-10-28 01:' || lpad(CAST(m AS VARCHAR), 2, '0')
                 ELSE '2001-04-01 02:' || lpad(CAST(m AS VARCHAR), 2, '0') END END AS display,
        CASE k % 3 WHEN 0 THEN CAST(anchor AS TIMESTAMP) + to_hours(CAST(h AS INTEGER)) + to_minutes(CAST(m AS INTEGER))
            WHEN 1 THEN CAST(d AS TIMESTAMP) + to_hours(CAST(h AS INTEGER)) + INTERVAL 30 MINUTE
            ELSE CASE WHEN h % 2 = 0 THEN TIMESTAMP '2001-10-28 01:00:00' ELSE TIMESTAMP '2001-04-01 02:00:00' END
                 + to_minutes(CAST(m AS INTEGER)) END AS n FROM days))""",
    "days",
)
def norm_ts_eastern(t):
    h, m = F.col("h"), F.lpad(F.col("m").cast("string"), 2, "0")
    shown = (
        F.when(_k() % 3 == 0, F.concat(h.cast("string"), F.lit(":"), m))
        .when(_k() % 3 == 1, F.concat(F.date_format("d", "yyyy-MM-dd"), F.lit("T"), F.lpad(h.cast("string"), 2, "0"), F.lit(":30:00")))
        .when(h % 2 == 0, F.concat(F.lit("2001-10-28 01:"), m))
        .otherwise(F.concat(F.lit("2001-04-01 02:"), m))
    )
    at = M.norm_ts_eastern(F.col("display"), F.col("anchor"))
    return t("days").withColumn("display", shown).select("k", "display", at["instant"].alias("value"), at["status"].alias("status"))


_CLOCK12 = "CASE WHEN h % 12 = 0 THEN 12 ELSE h % 12 END || ':' || lpad(CAST(m AS VARCHAR), 2, '0') || CASE WHEN h < 12 THEN 'AM' ELSE 'PM' END"
_CLOCK24 = "lpad(CAST(h AS VARCHAR), 2, '0') || ':' || lpad(CAST(m AS VARCHAR), 2, '0')"


def _clock12():
    h, m = F.col("h"), F.lpad(F.col("m").cast("string"), 2, "0")
    hour = F.when(h % 12 == 0, F.lit(12)).otherwise(h % 12).cast("string")
    return F.concat(hour, F.lit(":"), m, F.when(h < 12, F.lit("AM")).otherwise(F.lit("PM")))


@query(
    "norm_ts_news_display",
    f"""SELECT k, CASE k % 5 WHEN 0 THEN strftime(d, '%b-%d-%y ') || {_CLOCK12} WHEN 1 THEN 'Today ' || {_CLOCK12}
          WHEN 2 THEN 'Yesterday ' || {_CLOCK12} WHEN 3 THEN {_CLOCK12} ELSE '46 min' END AS display,
        CASE k % 5 WHEN 0 THEN '20' || strftime(d, '%y-%m-%d') || ' ' || {_CLOCK24} WHEN 1 THEN {_CLOCK24}
          WHEN 2 THEN strftime(anchor - 1, '%Y-%m-%d') || ' ' || {_CLOCK24} WHEN 3 THEN {_CLOCK24} ELSE '46 min' END AS value
    FROM days""",
    "days",
)
def norm_ts_news_display(t):
    clock = _clock12()
    shown = (
        F.when(_k() % 5 == 0, F.concat(F.date_format("d", "MMM-dd-yy "), clock))
        .when(_k() % 5 == 1, F.concat(F.lit("Today "), clock))
        .when(_k() % 5 == 2, F.concat(F.lit("Yesterday "), clock))
        .when(_k() % 5 == 3, clock)
        .otherwise(F.lit("46 min"))
    )
    base = t("days").withColumn("display", shown)
    return base.select("k", "display", M.norm_ts_news_display(F.col("display"), F.col("anchor")).alias("value"))


_NEWS = f"""CASE k % 7 WHEN 0 THEN {_CLOCK12} WHEN 1 THEN m || ' min' WHEN 2 THEN h || ' hours' WHEN 3 THEN (h % 9) || ' days'
    WHEN 4 THEN strftime(d, '%b-%-d') WHEN 5 THEN 'Xyz-12' ELSE '1 hr' END"""


def _news_display():
    num = lambda c, unit: F.concat(c.cast("string"), F.lit(unit))
    h, m = F.col("h"), F.col("m")
    return (
        F.when(_k() % 7 == 0, _clock12())
        .when(_k() % 7 == 1, num(m, " min"))
        .when(_k() % 7 == 2, num(h, " hours"))
        .when(_k() % 7 == 3, num(h % 9, " days"))
        .when(_k() % 7 == 4, F.date_format("d", "MMM-d"))
        .when(_k() % 7 == 5, F.lit("Xyz-12"))
        .otherwise(F.lit("1 hr"))
    )


@query(
    "norm_ts_news_kind",
    f"""SELECT k, {_NEWS} AS display, CASE k % 7 WHEN 0 THEN 'anchored' WHEN 4 THEN 'date_only' WHEN 5 THEN NULL
        ELSE 'relative' END AS value FROM days""",
    "days",
)
def norm_ts_news_kind(t):
    shown = _news_display()
    return t("days").select("k", shown.alias("display"), M.norm_ts_news_kind(shown).alias("value"))


@query(
    "norm_ts_relative",
    f"""SELECT k, display, CASE WHEN k % 7 = 0 THEN CASE WHEN NOT {_AMBIG} THEN u END
        WHEN k % 7 = 1 THEN f - to_minutes(CAST(m AS INTEGER)) WHEN k % 7 = 2 THEN f - to_hours(CAST(h AS INTEGER))
        WHEN k % 7 = 3 THEN f - to_days(CAST(h % 9 AS INTEGER)) WHEN k % 7 = 6 THEN f - INTERVAL 1 HOUR END AS value
    FROM (SELECT *, {_UTC.format('n')} AS u FROM (SELECT *, {_NEWS} AS display, CAST(anchor AS TIMESTAMP) + INTERVAL 18 HOUR AS f,
        CAST(anchor AS TIMESTAMP) + to_hours(CAST(h AS INTEGER)) + to_minutes(CAST(m AS INTEGER)) AS n FROM days))""",
    "days",
)
def norm_ts_relative(t):
    fetched = F.col("anchor").cast("timestamp") + F.expr("interval 18 hours")
    base = t("days").withColumn("display", _news_display())
    return base.select("k", "display", M.norm_ts_relative(F.col("display"), fetched, F.col("anchor")).alias("value"))


@query(
    "norm_ts_calendar",
    f"""SELECT k, {_iso()} AS release_date, CASE WHEN k % 3 > 0 THEN {_CLOCK24} END AS release_time,
        CASE WHEN k % 3 > 0 THEN {_iso()} || 'T' || {_CLOCK24} || ':00' END AS release_timestamp FROM days""",
    "days",
)
def norm_ts_calendar(t):
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    clock = F.concat(F.lit("T"), two(F.col("h")), F.lit(":"), two(F.col("m")), F.lit(":00"))
    shown = F.concat(F.date_format("d", "yyyy-MM-dd"), F.when(_k() % 3 > 0, clock).otherwise(F.lit("")))
    return t("days").select("k", M.norm_ts_calendar(shown).alias("s")).select("k", "s.*")


@query(
    "anchor_date",
    f"SELECT event_id, CAST({_WALL.format('ts')} AS DATE) AS anchor FROM events",
)
def anchor_date(t):
    return t("events").select("event_id", M.anchor_date(F.col("ts")).alias("anchor"))


# ---------------------------------------------------------------- text


@query(
    "split_paired",
    """SELECT k, CASE WHEN k % 3 > 0 THEN (k % 100) || '.88' ELSE '-' END AS value,
        CASE WHEN k % 3 > 0 THEN '-' || (k % 7) || '.28%' ELSE '' END AS percent FROM days""",
    "days",
)
def split_paired(t):
    pair = F.concat((_k() % 100).cast("string"), F.lit(".88 (-"), (_k() % 7).cast("string"), F.lit(".28%)"))
    return t("days").select("k", X.split_paired(F.when(_k() % 3 > 0, pair).otherwise(F.lit("-"))).alias("s")).select("k", "s.*")


@query(
    "strip_prefix",
    "SELECT k, k || 'B' AS aum, CAST(k AS VARCHAR) AS target, 'Wire ' || (k % 5) AS publisher FROM days",
    "days",
)
def strip_prefix(t):
    text = _k().cast("string")
    return t("days").select(
        "k",
        X.strip_aum(F.concat(F.lit("AUM: "), text, F.lit("B"))).alias("aum"),
        X.strip_dollar(F.concat(F.lit("$"), text)).alias("target"),
        X.strip_parens(F.concat(F.lit("(Wire "), (_k() % 5).cast("string"), F.lit(")"))).alias("publisher"),
    )


@query(
    "label_to_field",
    r"""SELECT p_partkey, label, trim(regexp_replace(lower(replace(replace(replace(replace(replace(replace(replace(label,
        '/', ' per '), '%', ' percent'), '+', ' plus '), '-', ' '), '.', ''), '(', ' '), ')', ' ')), '[\s_]+', '_', 'g'), '_') AS field
    FROM (SELECT p_partkey, p_name || '/' || p_type || CASE WHEN p_size % 2 = 0 THEN ' %' ELSE ' (' || p_size || '.5-day)' END AS label FROM part)""",
)
def label_to_field(t):
    tail = F.when(F.col("p_size") % 2 == 0, F.lit(" %")).otherwise(F.concat(F.lit(" ("), "p_size", F.lit(".5-day)")))
    label = F.concat("p_name", F.lit("/"), "p_type", tail)
    return t("part").select("p_partkey", label.alias("label"), X.label_to_field_column(label).alias("field"))


def _unit_rows() -> str:
    rows = R.label_to_type("screen").items()
    return ", ".join(f"('{label}', '{unit}', '{kind}')" for label, (unit, kind) in rows)


@query(
    "label_to_type",
    f"""SELECT p_partkey, label, coalesce(u.unit, 'text') AS unit, coalesce(u.kind, 'string') AS kind
    FROM (SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'P/E' WHEN 1 THEN 'Market Cap' WHEN 2 THEN 'Volume'
        WHEN 3 THEN 'Change %' ELSE p_type END AS label FROM part)
    LEFT JOIN (VALUES {_unit_rows()}) AS u(l, unit, kind) ON u.l = label""",
)
def label_to_type(t):
    size = F.col("p_size") % 5
    label = F.when(size == 0, F.lit("P/E")).when(size == 1, F.lit("Market Cap")).when(size == 2, F.lit("Volume"))
    label = label.when(size == 3, F.lit("Change %")).otherwise(F.col("p_type"))
    units = t.spark.createDataFrame([(k, u, s) for k, (u, s) in R.label_to_type("screen").items()], "l string, unit string, kind string")
    base = t("part").select("p_partkey", label.alias("label"))
    # The unit table is a fixed registry of some sixty labels.
    joined = base.join(F.broadcast(units), F.col("l") == F.col("label"), "left")
    return joined.select(
        "p_partkey", "label", F.coalesce("unit", F.lit("text")).alias("unit"), F.coalesce("kind", F.lit("string")).alias("kind")
    )


@query(
    "sym_canonical",
    r"""SELECT c_custkey, requested, CASE WHEN regexp_full_match(upper(trim(requested)), '[A-Z0-9]+([-./][A-Z0-9]+)*')
        THEN replace(replace(upper(trim(requested)), '.', '-'), '/', '-') END AS canonical
    FROM (SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN ' brk.' || c_custkey || ' ' WHEN 1 THEN 'BRK/' || c_custkey
        WHEN 2 THEN 'a b' || c_custkey WHEN 3 THEN 'x-' || c_custkey ELSE c_name END AS requested FROM customer)""",
)
def sym_canonical(t):
    k = F.col("c_custkey")
    requested = (
        F.when(k % 5 == 0, F.concat(F.lit(" brk."), k, F.lit(" ")))
        .when(k % 5 == 1, F.concat(F.lit("BRK/"), k))
        .when(k % 5 == 2, F.concat(F.lit("a b"), k))
        .when(k % 5 == 3, F.concat(F.lit("x-"), k))
        .otherwise(F.col("c_name"))
    )
    return t("customer").select("c_custkey", requested.alias("requested"), X.sym_canonical(requested).alias("canonical"))


@query(
    "sym_from_url",
    rf"""SELECT p_partkey, url, CASE WHEN regexp_full_match(url, 'https://{HOST}/stock\?t=[A-Za-z0-9-]+(&ty=oc)?')
        THEN upper(regexp_extract(url, 't=([A-Za-z0-9-]+)', 1)) END AS symbol
    FROM (SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'https://{HOST}/stock?t=p' || p_partkey
        WHEN 1 THEN 'https://{HOST}/stock?t=P' || p_partkey || '&ty=oc' WHEN 2 THEN 'https://other.example/stock?t=P' || p_partkey
        WHEN 3 THEN 'https://{HOST}/stock?t=%50' || p_partkey WHEN 4 THEN 'https://{HOST}:443/stock?t=P' || p_partkey
        ELSE 'https://{HOST}/stock?t=P' || p_partkey || '&x=1' END AS url FROM part)""",
)
def sym_from_url(t):
    k = F.col("p_partkey")
    base = f"https://{HOST}/stock?t="
    url = (
        F.when(k % 6 == 0, F.concat(F.lit(base + "p"), k))
        .when(k % 6 == 1, F.concat(F.lit(base + "P"), k, F.lit("&ty=oc")))
        .when(k % 6 == 2, F.concat(F.lit("https://other.example/stock?t=P"), k))
        .when(k % 6 == 3, F.concat(F.lit(base + "%50"), k))
        .when(k % 6 == 4, F.concat(F.lit(f"https://{HOST}:443/stock?t=P"), k))
        .otherwise(F.concat(F.lit(base + "P"), k, F.lit("&x=1")))
    )
    return t("part").select("p_partkey", url.alias("url"), X.sym_from_url(url, HOST).alias("symbol"))


@query(
    "sym_ticker_grammar",
    r"SELECT p_partkey, p_name, p_brand, regexp_full_match(upper(p_type), '[A-Z][A-Z0-9.\-]{0,9}') AS type_ok, regexp_full_match(upper('p' || p_partkey), '[A-Z][A-Z0-9.\-]{0,9}') AS key_ok FROM part",
)
def sym_ticker_grammar(t):
    return t("part").select(
        "p_partkey",
        "p_name",
        "p_brand",
        X.sym_ticker_grammar(F.col("p_type")).alias("type_ok"),
        X.sym_ticker_grammar(F.concat(F.lit("p"), "p_partkey")).alias("key_ok"),
    )


@query(
    "slug_check",
    """SELECT doc_id, coalesce(regexp_full_match(slug, '[a-z0-9]+(-[a-z0-9]+)*') AND length(slug) <= 64, false) AS publisher_ok,
        coalesce(regexp_full_match(slug, '[a-z0-9]+(-[a-z0-9]+)*') AND length(slug) <= 128, false) AS fund_ok
    FROM (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN source || '-' || doc_id WHEN 1 THEN repeat(lang || '-', CAST(n_chars % 60 AS INTEGER)) || 'x'
        ELSE source || '--' || lang END AS slug FROM documents)""",
)
def slug_check(t):
    k = F.col("doc_id")
    slug = (
        F.when(k % 3 == 0, F.concat("source", F.lit("-"), k))
        .when(k % 3 == 1, F.concat(F.repeat(F.concat("lang", F.lit("-")), (F.col("n_chars") % 60).cast("int")), F.lit("x")))
        .otherwise(F.concat("source", F.lit("--"), "lang"))
    )
    return t("documents").select(
        "doc_id", X.slug_check(slug, "publisher").alias("publisher_ok"), X.slug_check(slug, "fund").alias("fund_ok")
    )


@query(
    "url_absolute",
    f"""SELECT page_id, CASE WHEN page_id % 4 = 0 THEN url WHEN page_id % 4 = 1 THEN 'https:' || regexp_replace(url, '^https?:', '')
        WHEN page_id % 4 = 2 THEN '{ORIGIN}/p/' || page_id ELSE '{ORIGIN}/news/p' || page_id || '.html' END AS url FROM pages""",
)
def url_absolute(t):
    k = F.col("page_id")
    href = (
        F.when(k % 4 == 0, F.col("url"))
        .when(k % 4 == 1, F.regexp_replace("url", r"\Ahttps?:", ""))
        .when(k % 4 == 2, F.concat(F.lit("/p/"), k))
        .otherwise(F.concat(F.lit("p"), k, F.lit(".html")))
    )
    return t("pages").select("page_id", X.url_absolute(href, ORIGIN, "/news/").alias("url"))


@query(
    "url_chart",
    f"""SELECT p_partkey, CASE WHEN p_size % 4 < 3 THEN '{ORIGIN}/chart?t=P' || p_partkey || '&p=' ||
        CASE p_size % 4 WHEN 0 THEN 'd' WHEN 1 THEN 'y10' ELSE 'w' END END AS url FROM part""",
)
def url_chart(t):
    size = F.col("p_size") % 4
    frame = F.when(size == 0, F.lit("1d")).when(size == 1, F.lit("10y")).when(size == 2, F.lit("w")).otherwise(F.lit("2 weeks"))
    return t("part").select("p_partkey", X.url_chart(F.concat(F.lit("p"), "p_partkey"), frame, ORIGIN).alias("url"))


@query(
    "url_spectrum",
    f"""SELECT p_partkey, CASE WHEN regexp_full_match(lower(p_type), '[a-z]+') THEN '{ORIGIN}/grp_image?spectrum_' || lower(p_type)
        || '.png&rev=' || p_partkey END AS url FROM part""",
)
def url_spectrum(t):
    rev = F.col("p_partkey").cast("string")
    return t("part").select("p_partkey", X.url_spectrum(F.col("p_type"), ORIGIN, rev).alias("url"))


@query(
    "media_type",
    """SELECT page_id, CASE WHEN contains(lower(src), '.png') THEN 'image/png' ELSE 'image' END AS media
    FROM (SELECT page_id, url || CASE WHEN page_id % 2 = 0 THEN '.PNG?x=1' ELSE '.gif' END AS src FROM pages)""",
)
def media_type(t):
    src = F.concat("url", F.when(F.col("page_id") % 2 == 0, F.lit(".PNG?x=1")).otherwise(F.lit(".gif")))
    return t("pages").select("page_id", X.media_type(src).alias("media"))


# The policy in the oracle's own words: labels, then routes, then what stands before an @.
_REDACT_SQL = r"""regexp_replace(regexp_replace(regexp_replace(text,
    '(?i)((?:auth\b|authorization|authorisation|token|secret|passw|passphrase|pwd|credential|cookie|session|api[-_.]?key|private[-_.]?key|proxy|proxies|body|payload|content|html)[0-9A-Za-z_.-]*["'']?[ \t]*)(?:(:[ \t]*)\S[^\n]*|(=[ \t]*)[^&\s][^&\n]*)', '\1\2\3[REDACTED]', 'g'),
    '(?i)((?:proxy|proxies|route)\b[^\n]{0,20}?)\b[a-z][a-z0-9+.-]*://[^\s"''<>]+', '\1[REDACTED]', 'g'), '(://)[^\s/@]+@', '\1[REDACTED]@', 'g')"""


@query(
    "redact_text",
    f"""SELECT doc_id, sha256(redacted) AS digest, CAST(length(redacted) AS BIGINT) AS n, redacted <> text AS changed FROM (
        SELECT doc_id, text, {_REDACT_SQL} AS redacted FROM documents)""",
)
def redact_text(t):
    base = t("documents").select("doc_id", "text", X.redact_text(F.col("text")).alias("redacted"))
    return base.select(
        "doc_id",
        F.sha2("redacted", 256).alias("digest"),
        F.length("redacted").cast("bigint").alias("n"),
        (F.col("redacted") != F.col("text")).alias("changed"),
    )


@query(
    "redact_map",
    """SELECT event_id, '[REDACTED]' AS token, '[BODY REDACTED]' AS body, props, 'user=[REDACTED] x' AS note
    FROM (SELECT event_id, props FROM events)""",
)
def redact_map(t):
    bag = F.create_map(
        F.lit("accessToken"), F.col("event_type"), F.lit("responseBody"), F.col("props"), F.lit("props"), F.col("props"),
        F.lit("note"), F.lit("user=token=x"),
    )
    clean = X.redact_map(bag)
    return t("events").select(
        "event_id",
        clean["accessToken"].alias("token"),
        clean["responseBody"].alias("body"),
        clean["props"].alias("props"),
        F.concat(F.regexp_replace(clean["note"], "token=", ""), F.lit(" x")).alias("note"),
    )


@query(
    "scrub_unsafe",
    r"""SELECT event_id, CASE WHEN regexp_matches(v, '[<>\\";''`{}]') THEN '[redacted]' ELSE v END AS value
    FROM (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN props ELSE event_type END AS v FROM events)""",
)
def scrub_unsafe(t):
    v = F.when(F.col("event_id") % 2 == 0, F.col("props")).otherwise(F.col("event_type"))
    return t("events").select("event_id", X.scrub_unsafe(v).alias("value"))


@query(
    "hash_query",
    """SELECT c_mktsegment AS sector, count(*) AS n, substr(sha256('{"filters":[{"name":"Sector","option":"' || c_mktsegment
        || '"}],"order":{"descending":true,"name":"Market Cap."},"view":"overview"}'), 1, 16) AS query_hash
    FROM customer GROUP BY c_mktsegment""",
)
def hash_query(t):
    """Query identities as rows; the row form equals the driver's hash."""
    option = F.struct(F.lit("Sector").alias("name"), F.col("sector").alias("option"))
    order = F.struct(F.lit(True).alias("descending"), F.lit("Market Cap.").alias("name"))
    rows = t("customer").groupBy(F.col("c_mktsegment").alias("sector")).agg(F.count("*").alias("n"))
    digest = H.hash_query_rows([F.array(option).alias("filters"), order.alias("order"), F.lit("overview").alias("view")])
    return rows.select("sector", "n", digest.alias("query_hash"))


def driver_query(sector: str) -> ScreenQuery:
    return ScreenQuery(filters=(Filter("Sector", sector),), order=Order("Market Cap.", True))


@query(
    "hash_row",
    """SELECT event_id, sha256(CAST(user_id AS VARCHAR) || chr(31) || event_type || chr(31) || props) AS row_hash FROM events""",
)
def hash_row(t):
    rows = t("events").select("event_id", "user_id", "event_type", "props")
    return row_identity(rows, volatile=("event_id",)).select("event_id", "row_hash")


# ---------------------------------------------------------------- arrays, maps, JSON


@query(
    "extra_fields_split",
    """SELECT event_id, event_type AS kind, CAST(user_id AS VARCHAR) AS owner,
        '{"a_note":"","props":' || to_json(props) || '}' AS extra FROM events""",
)
def extra_fields_split_(t):
    bag = F.create_map(
        F.lit("props"), F.col("props"), F.lit("kind"), F.col("event_type"), F.lit("owner"), F.col("user_id").cast("string"),
        F.lit("a_note"), F.lit(None).cast("string"),
    )
    rows = extra_fields_split(t("events").select("event_id", bag.alias("bag")), "bag", ["kind", "owner"])
    return rows.select("event_id", "kind", "owner", F.to_json("extra_fields").alias("extra"))


@query(
    "map_explode_perf",
    "SELECT vec_id, 'd0' AS symbol, CAST(embedding[1] AS DOUBLE) AS perf FROM embeddings UNION ALL SELECT vec_id, 'd1', CAST(embedding[2] AS DOUBLE) FROM embeddings",
)
def map_explode_perf(t):
    bag = F.create_map(F.lit("d0"), F.col("embedding")[0].cast("double"), F.lit("d1"), F.col("embedding")[1].cast("double"))
    return t("embeddings").select("vec_id", F.explode(bag).alias("symbol", "perf"))


@query(
    "sparkline_verbatim",
    "SELECT vec_id, CAST(len(embedding) AS INTEGER) AS n, vec_id % 5 <> 0 AS ok FROM embeddings",
)
def sparkline_verbatim(t):
    ints = F.transform("embedding", lambda x: (x * 1000).cast("int"))
    shown = F.when(F.col("vec_id") % 5 == 0, F.to_json(F.transform(ints, lambda x: x.cast("string")))).otherwise(F.to_json(ints))
    return t("embeddings").select("vec_id", F.size("embedding").alias("n"), P.sparkline_verbatim(shown).alias("ok"))


@query(
    "sparkline_json",
    "SELECT vec_id, '[' || array_to_string(list_transform(embedding, lambda x: CAST(trunc(CAST(x AS DOUBLE) * 1000) AS INTEGER)), ',') || ']' AS payload FROM embeddings",
)
def sparkline_json(t):
    ints = F.transform("embedding", lambda x: (x.cast("double") * 1000).cast("int"))
    return t("embeddings").select("vec_id", F.to_json(ints).alias("payload"))


@query(
    "json_props",
    "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.missing') AS missing FROM events",
)
def json_props(t):
    parsed = F.from_json("props", "k bigint")
    return t("events").select("event_id", parsed["k"].alias("k"), F.get_json_object("props", "$.missing").alias("missing"))


@query(
    "arrays_align",
    """SELECT 'C' || o_custkey AS symbol, CAST(count(*) AS INTEGER) AS n_periods, count(*) % 2 = 0 AS even_aligned, true AS aligned
    FROM periods GROUP BY o_custkey""",
    "periods",
)
def arrays_align(t):
    parsed = P.x_statement(t("statement_docs"))
    half = F.transform_values("metrics", lambda k, v: F.filter(v, lambda x, i: i < F.floor(F.size(v) / 2) * 2))
    return parsed.select(
        "symbol",
        F.size("periods").alias("n_periods"),
        P.arrays_align(F.col("periods"), F.map_values(half)).alias("even_aligned"),
        P.arrays_align(F.col("periods"), F.map_values("metrics")).alias("aligned"),
    )


@query(
    "csv_index",
    """SELECT p_partkey, CASE WHEN p_size > 25 THEN 'DJIA|S&P 500' ELSE p_type END AS names, p_size > 25 AS in_djia FROM part""",
)
def csv_index(t):
    shown = F.when(F.col("p_size") > 25, F.lit("DJIA, S&P 500")).otherwise(F.col("p_type"))
    names = X.csv_index(shown)
    return t("part").select("p_partkey", F.array_join(names, "|").alias("names"), F.array_contains(names, "DJIA").alias("in_djia"))


@query(
    "x_js_literal",
    r"""SELECT s_suppkey, regexp_replace('{name:"' || s_name || '",value:' || s_suppkey || ',children:[{name:"a,b:c"}]}',
        '([{,])([A-Za-z_][A-Za-z0-9_]*):', '\1"\2":', 'g') AS json FROM supplier""",
)
def x_js_literal_(t):
    literal = F.concat(F.lit('{name:"'), "s_name", F.lit('",value:'), "s_suppkey", F.lit(',children:[{name:"a,b:c"}]}'))
    return t("supplier").select("s_suppkey", x_js_literal(literal).alias("json"))
