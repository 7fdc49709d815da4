"""Registries: column units per family, JSON field names, group and screen vocabularies.

The provider's own filter list is not public in machine-readable form, so the
filters, signals and orders here are this package's own: every option carries
the predicate it stands for, evaluated on a snapshot DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import numeric as N
from ..functions.text import label_to_field

PAGE_SIZE = 20
MAX_PAGES = 250
MAX_ROWS = 20_000


class QueryError(ValueError):
    """A query names something the registry does not have."""


# ---------------------------------------------------------------- header units

# Screener header labels by unit; other labels are text.
SCREEN_UNITS = {
    "int64": ("No.", "Volume", "Employees"),
    "compact": (
        "Market Cap", "Sales", "Income", "Shares Outstand", "Shares Float", "Avg Volume",
    ),
    "float64": (
        "P/E", "Forward P/E", "PEG", "P/S", "P/B", "P/Cash", "P/FCF", "EPS", "Price", "Beta",
        "ATR", "RSI", "Quick Ratio", "Current Ratio", "Debt/Eq", "LT Debt/Eq", "Earnigs",
        "Target Price", "Short Ratio", "Recom", "Rel Volume",
    ),
    "percent": (
        "Change %", "Dividend %", "Volatility W", "Volatility M", "Gap %", "Perf Week",
        "Perf Month", "Perf Quart", "Perf Half Y", "Perf Year", "Perf YTD", "Float Short",
        "Inst Own", "Insider Own", "Sales growth quarter", "EPS growth quarter", "EPS this Y",
        "EPS next Y", "EPS past 5Y", "EPS next 5Y", "Sales past 5Y", "ROA", "ROE", "ROI",
        "Gross Margin", "Oper. Margin", "Profit Margin", "SMA20", "SMA50", "SMA200",
        "Sales Surprise %", "EPS Surprise %",
    ),
}
# Group header labels by unit; other labels are text.
GROUP_UNITS = {
    "int64": ("Stocks", "Employees"),
    "compact": ("Market Cap", "Avg Volume", "Volume"),
    "float64": (
        "P/E", "Fwd P/E", "PEG", "P/S", "P/B", "P/C", "P/FCF", "Recom", "Rel Volume",
        "LTDebt/Eq", "Debt/Eq",
    ),
    "percent": (
        "Dividend", "EPS past 5Y", "EPS next 5Y", "Sales past 5Y", "Float Short", "Perf Week",
        "Perf Month", "Perf Quart", "Perf Half", "Perf Year", "Perf YTD", "Change %", "ROA",
        "ROE", "ROIC",
    ),
}
# Market performance labels and their fields.
MARKET_FIELDS = {
    "Price": "price",
    "Perf 5Min": "perf_5min",
    "Perf Hour": "perf_hour",
    "Perf Day": "perf_day",
    "Perf Week": "perf_week",
    "Perf Month": "perf_month",
    "Perf Quart": "perf_quart",
    "Perf Half": "perf_half",
    "Perf YTD": "perf_ytd",
    "Perf Year": "perf_year",
}

UNIT_TYPE = {"int64": "bigint", "compact": "double", "float64": "double", "percent": "double"}


def unit_of(label: str, family: str) -> str:
    """The unit of a header label in ``screen``, ``group`` or ``market`` tables."""
    if family == "market":
        return "market" if label in MARKET_FIELDS else "text"
    table = {"screen": SCREEN_UNITS, "group": GROUP_UNITS}[family]
    return next((unit for unit, labels in table.items() if label in labels), "text")


def label_to_type(family: str) -> dict[str, tuple[str, str]]:
    """``label -> (unit, Spark type)`` for every label a family types."""
    if family == "market":
        return {label: ("market", "double") for label in MARKET_FIELDS}
    table = {"screen": SCREEN_UNITS, "group": GROUP_UNITS}[family]
    return {label: (unit, UNIT_TYPE[unit]) for unit, labels in table.items() for label in labels}


def typed_cell(label: str, display: Column, family: str) -> Column:
    """A display cell converted by its label's unit; blank and bad cells are null."""
    unit = unit_of(label, family)
    blank = display.isin("", "-")
    if unit == "text":
        return F.when(~blank, display)
    if unit == "market":
        return N.norm_market_pct(display)
    if unit == "float64" and family == "screen":
        return N.norm_ragged(display)
    convert = {
        "int64": N.norm_int,
        "compact": N.norm_compact,
        "float64": N.norm_number,
        "percent": N.norm_percent,
    }[unit]
    return F.when(~blank, convert(display))


# Screener JSON fields as (column code, JSON key, header label).
JSON_FIELDS = (
    ("2", "company", "Company"), ("3", "sector", "Sector"), ("4", "industry", "Industry"),
    ("5", "country", "Country"), ("6", "marketCap", "Market Cap"), ("7", "PE", "P/E"),
    ("8", "forwardPE", "Forward P/E"), ("9", "PEG", "PEG"), ("10", "PS", "P/S"),
    ("11", "PB", "P/B"), ("12", "PC", "P/Cash"), ("13", "PFCF", "P/FCF"),
    ("14", "dividendYield", "Dividend %"), ("15", "payoutRatio", "Payout Ratio"),
    ("16", "eps", "EPS"), ("17", "epsYoY", "EPS this Y"), ("18", "epsYoY1", "EPS next Y"),
    ("19", "eps5Years", "EPS past 5Y"), ("20", "estLTGrowth", "EPS next 5Y"),
    ("21", "sales5Years", "Sales past 5Y"), ("22", "epsQoQ", "EPS growth quarter"),
    ("23", "salesQoQ", "Sales growth quarter"),
    ("24", "sharesOutstanding2", "Shares Outstanding"), ("25", "sharesFloat", "Shares Float"),
    ("26", "insiderOwn", "Insider Own"), ("27", "insiderTrans", "Insider Trans"),
    ("28", "instOwn", "Inst Own"), ("29", "instTrans", "Inst Trans"),
    ("30", "shortInterestShare", "Float Short"), ("31", "shortInterestRatio", "Short Ratio"),
    ("32", "roa", "ROA"), ("33", "roe", "ROE"), ("34", "roi", "ROI"),
    ("35", "curRatio", "Curr R"), ("36", "quickRatio", "Quick R"),
    ("37", "ltdebtEq", "LTDebt/Eq"), ("38", "debtEq", "Debt/Eq"),
    ("39", "grossMargin", "Gross M"), ("40", "operMargin", "Oper M"),
    ("41", "netMargin", "Profit M"), ("42", "perf1w", "Perf Week"),
    ("43", "perf4w", "Perf Month"), ("44", "perf13w", "Perf Quart"),
    ("45", "perf26w", "Perf Half Y"), ("46", "perf52w", "Perf Year"),
    ("47", "perfYtd", "Perf YTD"), ("48", "beta", "Beta"), ("49", "averageTrueRange", "ATR"),
    ("50", "volatility1w", "Volatility W"), ("51", "volatility4w", "Volatility M"),
    ("52", "sma20", "SMA20"), ("53", "sma50", "SMA50"), ("54", "sma200", "SMA200"),
    ("55", "high50d", "50-Day High"), ("56", "low50d", "50-Day Low"),
    ("57", "high52w", "52W High"), ("58", "low52w", "52W Low"), ("59", "rsi", "RSI"),
    ("60", "changeopen", "Change from Open %"), ("61", "gap", "Gap"), ("62", "recom", "Recom"),
    ("63", "averageVolume", "Avg Volume"), ("64", "relativeVolume", "Rel Volume"),
    ("65", "price", "Price"), ("66", "change", "Change %"), ("67", "volume", "Volume"),
    ("68", "earningsDate", "Earnings Date"), ("69", "targetPrice", "Target Price"),
    ("70", "ipoDate", "IPO Date"), ("73", "book", "Book value per share"),
    ("74", "cashPerShare", "Cash per share"), ("75", "dividend", "Dividend"),
    ("76", "employees", "Employees"), ("77", "estQ1", "EPS estimate next quarter"),
    ("78", "income", "Income"), ("79", "index", "Index"), ("80", "optionable", "Optionable"),
    ("81", "prevClose", "Previous Close"), ("82", "sales", "Sales"),
    ("83", "shortable", "Shortable"), ("84", "shortInterest", "Short Interest"),
    ("85", "floatoutstandingpct", "Float/Outstanding"), ("86", "open", "Open"),
    ("87", "high", "High"), ("88", "low", "Low"),
)
# JSON keys shown as percent points, as compact millions, as text.
JSON_PERCENT = (
    "change", "dividendYield", "payoutRatio", "insiderOwn", "insiderTrans", "instOwn",
    "instTrans", "shortInterestShare", "roa", "roe", "roi", "grossMargin", "operMargin",
    "profitMargin", "epsYoY", "epsYoY1", "eps5Years", "estLTGrowth", "sales5Years", "epsQoQ",
    "salesQoQ", "floatoutstandingpct", "sma20", "sma50", "sma200", "high52w", "low52w", "gap",
)
JSON_COMPACT = ("marketCap", "sales", "income")
JSON_TEXT = ("company", "sector", "industry", "country", "index", "optionable", "shortable")

# ---------------------------------------------------------------- groups

# Group dimensions, sub-industry sectors, views.
GROUP_DIMENSIONS = {
    "Sector": "sector",
    "Industry": "industry",
    "Country": "country",
    "Capitalization": "capitalization",
}
SUB_INDUSTRY_SECTORS = (
    "Basic Materials", "Communication Services", "Consumer Cyclical", "Consumer Defensive",
    "Energy", "Financial", "Healthcare", "Industrials", "Real Estate", "Technology", "Utilities",
)
# Group order names and the aggregate column each sorts by.
GROUP_ORDERS = {
    "Name": "name",
    "Market Capitalization": "market_cap",
    "Price/Earnings": "p_per_e",
    "Forward Price/Earnings": "fwd_p_per_e",
    "PEG": "peg",
    "Price/Sales": "p_per_s",
    "Price/Book": "p_per_b",
    "Price/Cash": "p_per_c",
    "Price/Free Cash Flow": "p_per_fcf",
    "Enterprise Value": "enterprise_value",
    "EV/EBITDA": "ev_per_ebitda",
    "EV/Sales": "ev_per_sales",
    "Dividend Yield": "dividend",
    "EPS growth past 3 years": "eps_past_3y",
    "EPS growth past 5 years": "eps_past_5y",
    "EPS growth next 5 years": "eps_next_5y",
    "Sales growth past 3 years": "sales_past_3y",
    "Sales growth past 5 years": "sales_past_5y",
    "Short Interest Share": "float_short",
    "Return on Assets": "roa",
    "Return on Equity": "roe",
    "Return on Invested Capital": "roic",
    "Current Ratio": "current_ratio",
    "Quick Ratio": "quick_ratio",
    "LT Debt/Equity": "ltdebt_per_eq",
    "Total Debt/Equity": "debt_per_eq",
    "Gross Margin": "gross_margin",
    "Operating Margin": "oper_margin",
    "Net Profit Margin": "profit_margin",
    "Analyst Recommendation": "recom",
    "Performance (Week)": "perf_week",
    "Performance (Month)": "perf_month",
    "Performance (Quarter)": "perf_quart",
    "Performance (Half Year)": "perf_half",
    "Performance (Year)": "perf_year",
    "Performance (Year To Date)": "perf_ytd",
    "Average Volume (3 Month)": "avg_volume",
    "Relative Volume": "rel_volume",
    "Change %": "change_percent",
    "Volume": "volume",
    "Number of Stocks": "stocks",
    "Employees": "employees",
}
# Custom group view columns, in their code order.
GROUP_COLUMNS = (
    "Market Cap", "P/E", "Fwd P/E", "PEG", "P/S", "P/B", "P/C", "P/FCF", "Dividend",
    "EPS past 5Y", "EPS next 5Y", "Sales past 5Y", "Float Short", "Perf Week", "Perf Month",
    "Perf Quart", "Perf Half", "Perf Year", "Perf YTD", "Recom", "Avg Volume", "Rel Volume",
    "Change %", "Volume", "Stocks", "LTDebt/Eq", "Debt/Eq", "ROA", "ROE", "ROIC",
)
GROUP_VIEWS = {
    "overview": (
        "Stocks", "Market Cap", "Dividend", "P/E", "Fwd P/E", "PEG", "LTDebt/Eq", "Debt/Eq",
        "Float Short", "Recom", "Change %", "Volume",
    ),
    "valuation": (
        "Market Cap", "P/E", "Fwd P/E", "PEG", "P/S", "P/B", "P/C", "P/FCF", "EPS past 5Y",
        "EPS next 5Y", "Sales past 5Y", "Change %", "Volume",
    ),
    "performance": (
        "Perf Week", "Perf Month", "Perf Quart", "Perf Half", "Perf Year", "Perf YTD", "Recom",
        "Avg Volume", "Rel Volume", "Change %", "Volume",
    ),
}
# Sizes add up over a group; every other number is a market-cap-weighted mean.
GROUP_SUMS = ("market_cap", "volume", "avg_volume", "employees")

# Our documented capitalization buckets: lower bound and name, largest first.
CAP_BUCKETS = (
    (200e9, "Mega"),
    (10e9, "Large"),
    (2e9, "Mid"),
    (300e6, "Small"),
    (50e6, "Micro"),
    (0.0, "Nano"),
)


def capitalization(market_cap: Column, scale: float = 1.0) -> Column:
    """The capitalization bucket of a market cap; ``scale`` shrinks the bounds."""
    chain = F.when(market_cap.isNull(), None)
    for floor, name in CAP_BUCKETS:
        chain = chain.when(market_cap >= floor * scale, F.lit(name))
    return chain


# ---------------------------------------------------------------- screens


@dataclass(frozen=True)
class FilterSpec:
    """A filter: its kind and the snapshot column it tests.

    Categorical filters take any value of the column. Numeric options are named
    predicates; ``Under x``, ``Over x`` and ``x to y`` are accepted for any number.
    """

    name: str
    kind: str
    column: str
    options: dict[str, Callable[[Column], Column]] | None = None

    def predicate(self, option: str) -> Column:
        c = F.col(self.column)
        if self.kind == "categorical":
            return c == option
        if self.options and option in self.options:
            return self.options[option](c)
        words = option.split()
        try:
            if len(words) == 2 and words[0] in ("Under", "Over"):
                bound = float(words[1])
                return c < bound if words[0] == "Under" else c > bound
            if len(words) == 3 and words[1] == "to":
                return c.between(float(words[0]), float(words[2]))
        except ValueError:
            pass
        raise QueryError(f"unknown option {option!r} for filter {self.name!r}")


def _over(x: float) -> Callable[[Column], Column]:
    return lambda c: c >= x


def _between(low: float, high: float) -> Callable[[Column], Column]:
    return lambda c: (c >= low) & (c < high)


_CAPS = {
    "Mega ($200bln and more)": _over(200e9),
    "Large ($10bln to $200bln)": _between(10e9, 200e9),
    "Mid ($2bln to $10bln)": _between(2e9, 10e9),
    "Small ($300mln to $2bln)": _between(300e6, 2e9),
    "Micro ($50mln to $300mln)": _between(50e6, 300e6),
    "Nano (under $50mln)": lambda c: c < 50e6,
    "+Large (over $10bln)": _over(10e9),
    "+Mid (over $2bln)": _over(2e9),
    "+Small (over $300mln)": _over(300e6),
    "+Micro (over $50mln)": _over(50e6),
}
_CHANGES = {"Up": lambda c: c > 0, "Down": lambda c: c < 0}

FILTERS = {
    f.name: f
    for f in (
        FilterSpec("Sector", "categorical", "sector"),
        FilterSpec("Industry", "categorical", "industry"),
        FilterSpec("Country", "categorical", "country"),
        FilterSpec("Exchange", "categorical", "exchange"),
        FilterSpec("Market Cap.", "numeric", "market_cap", _CAPS),
        FilterSpec("P/E", "numeric", "p_per_e", {"Profitable (>0)": lambda c: c > 0}),
        FilterSpec("Price", "numeric", "price"),
        FilterSpec("Change", "numeric", "change_percent", _CHANGES),
        FilterSpec("Current Volume", "numeric", "volume"),
        FilterSpec("Average Volume", "numeric", "avg_volume"),
        FilterSpec("Relative Volume", "numeric", "rel_volume"),
        FilterSpec("RSI", "numeric", "rsi"),
        FilterSpec("Earnings Date", "date", "earnings_date"),
    )
}

# Every other measure of the units table has a filter and an order under its own label.
_COVERED = {f.column for f in FILTERS.values()}
MEASURES = {
    label: label_to_field(label)
    for labels in SCREEN_UNITS.values()
    for label in labels
    if label not in ("No.", *FILTERS) and label_to_field(label) not in _COVERED and UNIT_TYPE.get(unit_of(label, "screen")) in ("double", "bigint")
}
FILTERS |= {label: FilterSpec(label, "numeric", column) for label, column in MEASURES.items()}

ORDERS = {
    **MEASURES,
    "Ticker": "symbol",
    "Company": "company",
    "Sector": "sector",
    "Industry": "industry",
    "Country": "country",
    "Exchange": "exchange",
    "Market Cap.": "market_cap",
    "Price/Earnings": "p_per_e",
    "Price": "price",
    "Change": "change_percent",
    "Volume": "volume",
    "Average Volume": "avg_volume",
    "Relative Volume": "rel_volume",
    "Earnings Date": "earnings_date",
    "Relative Strength Index": "rsi",
}


@dataclass(frozen=True)
class SignalSpec:
    """A signal: which rows belong, how they rank, which columns it needs."""

    name: str
    predicate: Callable[[], Column]
    order: str
    descending: bool
    needs: tuple[str, ...]


SIGNALS = {
    s.name: s
    for s in (
        SignalSpec("Top Gainers", lambda: F.col("change_percent") > 0, "change_percent", True, ("change_percent",)),
        SignalSpec("Top Losers", lambda: F.col("change_percent") < 0, "change_percent", False, ("change_percent",)),
        SignalSpec("New High", lambda: F.col("price") >= F.col("high_52w"), "change_percent", True, ("price", "high_52w", "change_percent")),
        SignalSpec("New Low", lambda: F.col("price") <= F.col("low_52w"), "change_percent", False, ("price", "low_52w", "change_percent")),
        SignalSpec("Most Active", lambda: F.col("volume") > 0, "volume", True, ("volume",)),
        SignalSpec("Most Volatile", lambda: F.col("volatility").isNotNull(), "volatility", True, ("volatility",)),
        SignalSpec("Unusual Volume", lambda: F.col("rel_volume") > 2, "rel_volume", True, ("rel_volume",)),
        SignalSpec("Overbought", lambda: F.col("rsi") > 70, "rsi", True, ("rsi",)),
        SignalSpec("Oversold", lambda: F.col("rsi") < 30, "rsi", False, ("rsi",)),
        SignalSpec("Earnings Before", lambda: F.col("earnings_session") == "BMO", "symbol", False, ("earnings_session",)),
        SignalSpec("Earnings After", lambda: F.col("earnings_session") == "AMC", "symbol", False, ("earnings_session",)),
        SignalSpec("Insider Buying", lambda: F.col("insider_net") > 0, "insider_net", True, ("insider_net",)),
        SignalSpec("Insider Selling", lambda: F.col("insider_net") < 0, "insider_net", False, ("insider_net",)),
    )
}

SIGNAL_COLUMNS = ("company", "sector", "industry", "country", "market_cap", "price")
VIEWS = {
    "overview": (
        "company", "sector", "industry", "country", "market_cap", "p_per_e", "price",
        "change_percent", "volume",
    ),
    "valuation": (
        "market_cap", "p_per_e", "forward_p_per_e", "peg", "p_per_s", "p_per_b", "p_per_cash",
        "p_per_fcf", "price", "change_percent", "volume",
    ),
    "financial": (
        "market_cap", "dividend_percent", "roa", "roe", "roi", "current_ratio", "quick_ratio",
        "debt_per_eq", "gross_margin", "profit_margin", "price", "change_percent", "volume",
    ),
    "ownership": (
        "market_cap", "shares_outstand", "shares_float", "insider_own", "inst_own",
        "float_short", "short_ratio", "avg_volume", "price", "change_percent", "volume",
    ),
    "performance": (
        "perf_week", "perf_month", "perf_quart", "perf_half_y", "perf_year", "perf_ytd",
        "volatility_w", "volatility_m", "recom", "avg_volume", "rel_volume", "price",
        "change_percent", "volume",
    ),
    "technical": (
        "beta", "atr", "sma20", "sma50", "sma200", "52w_high", "52w_low", "rsi", "price",
        "change_percent", "volume",
    ),
    "ticker": (),
}
# Columns a custom view may name: every header the units know plus the text ones.
SCREEN_COLUMNS = {
    **{label: label_to_field(label) for label in ("Company", "Sector", "Industry", "Country", "Exchange", "Index", "Earnings Date", "IPO Date")},
    **{label: label_to_field(label) for labels in SCREEN_UNITS.values() for label in labels if label != "No."},
    **{label: label_to_field(label) for _, _, label in JSON_FIELDS},
}
# View columns no header label maps to: nullable text when a snapshot lacks them.
VIEW_TYPES = {
    field: kind
    for label, field in SCREEN_COLUMNS.items()
    for kind in [UNIT_TYPE.get(unit_of(label, "screen"), "string")]
}

EARNINGS_WINDOWS = ("Today", "Tomorrow", "Yesterday", "This Week", "Next Week", "This Month")
EARNINGS_DAY_WINDOWS = ("Today", "Tomorrow", "Yesterday")
SESSIONS = {"Before Market Open": "BMO", "After Market Close": "AMC"}

# Insider feeds as (owner threshold, minimum value, side, by value).
# The sides are 1 buys, 2 sales, 7 both; -10 means the past week, 10 a ten percent owner.
INSIDER_FEEDS = {
    "latest": (None, None, None, False),
    "latest_buys": (None, None, 1, False),
    "latest_sales": (None, None, 2, False),
    "top_week": (-10, 100_000, 7, True),
    "top_week_buys": (-10, 100_000, 1, True),
    "top_week_sales": (-10, 100_000, 2, True),
    "top_owner_trade": (10, 1_000_000, 7, True),
    "top_owner_buys": (10, 1_000_000, 1, True),
    "top_owner_sales": (10, 1_000_000, 2, True),
}

# Statement codes as (kind, periodicity).
STATEMENT_CODES = {
    "IA": ("income", "annual"),
    "IQ": ("income", "quarterly"),
    "BA": ("balance", "annual"),
    "BQ": ("balance", "quarterly"),
    "CA": ("cashflow", "annual"),
    "CQ": ("cashflow", "quarterly"),
}
