"""The screen surface, evaluated on a snapshot DataFrame the user owns."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import temporal as M
from ..functions import text as X
from ..plans import registry as R
from .ranking import order_keys, rank_limited

# ---------------------------------------------------------------- predicates


def filter_predicate(name: str, option: str, as_of: Column | None = None) -> Column | None:
    """The predicate of one filter option; ``Any`` filters nothing."""
    spec = R.FILTERS.get(name)
    if spec is None:
        raise R.QueryError(f"unknown filter {name!r}")
    if option == "Any":
        return None
    if spec.kind == "date":
        return earnings_option(option, as_of, spec.column)
    return spec.predicate(option)


def filter_conjunction(predicates: Iterable[Column | None]) -> Column:
    """All predicates together; none at all keeps every row."""
    return reduce(and_, [p for p in predicates if p is not None], F.lit(True))


def filter_ticker(df: DataFrame, *symbols: str) -> DataFrame:
    for s in symbols:
        import re

        if not re.match(X.TICKER.replace(r"\z", r"\Z"), s.upper()):
            raise R.QueryError("ticker must be 1-10 letters/digits with optional '.' or '-'")
    return df.where(F.col("symbol").isin(*[s.upper() for s in symbols]))


def date_bounds(window: str, as_of: Column) -> tuple[Column, Column]:
    """First and last day of a named window; weeks start on Monday."""
    week = F.date_trunc("week", as_of).cast("date")
    bounds = {
        "Today": (as_of, as_of),
        "Tomorrow": (F.date_add(as_of, 1), F.date_add(as_of, 1)),
        "Yesterday": (F.date_sub(as_of, 1), F.date_sub(as_of, 1)),
        "This Week": (week, F.date_add(week, 6)),
        "Next Week": (F.date_add(week, 7), F.date_add(week, 13)),
        "This Month": (F.trunc(as_of, "month"), F.last_day(as_of)),
    }
    if window not in bounds:
        raise R.QueryError(f"when must be one of {', '.join(bounds)}; got {window!r}")
    return bounds[window]


def earnings_window(window: str, as_of: Column, column: str = "earnings_date", session: str | None = None) -> Column:
    """Earnings inside a window; a session needs a one-day window."""
    low, high = date_bounds(window, as_of)
    inside = F.col(column).between(low, high)
    if session is None:
        return inside
    if session not in R.SESSIONS:
        raise R.QueryError(f"session must be one of {sorted(R.SESSIONS)}; got {session!r}")
    if window not in R.EARNINGS_DAY_WINDOWS:
        raise R.QueryError("session screens require a day window")
    return inside & (F.col("earnings_session") == R.SESSIONS[session])


def earnings_option(option: str, as_of: Column | None, column: str) -> Column:
    if as_of is None:
        raise R.QueryError("date filters need an explicit as_of date")
    for session in R.SESSIONS:
        if option.endswith(session):
            return earnings_window(option.removesuffix(session).strip(), as_of, column, session)
    return earnings_window(option, as_of, column)


# ---------------------------------------------------------------- projections


def _present(df: DataFrame, name: str) -> Column:
    if name in df.columns:
        return F.col(name)
    return F.lit(None).cast(R.VIEW_TYPES.get(name, "string")).alias(name)


def _framed(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Identity first, provenance last; a column the snapshot lacks is a typed null."""
    lead = [c for c in ("rank", "symbol") if c in df.columns]
    tail = [c for c in ("fetched_at", "extra_fields") if c in df.columns]
    return df.select(*lead, *[_present(df, c) for c in columns if c not in lead], *tail)


def view_fixed(df: DataFrame, name: str) -> DataFrame:
    if name not in R.VIEWS:
        raise R.QueryError(f"unknown view {name!r}")
    return _framed(df, R.VIEWS[name])


def view_ticker(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in ("rank", "symbol") if c in df.columns])


def view_custom(df: DataFrame, labels: Iterable[str]) -> DataFrame:
    """Registered columns in the caller's order, no repeats."""
    labels = [x for x in labels if x not in ("Ticker", "No.")]
    for label in labels:
        if label not in R.SCREEN_COLUMNS:
            raise R.QueryError(f"unknown column {label!r}")
    if len(set(labels)) != len(labels):
        raise R.QueryError("duplicate column")
    return _framed(df, [R.SCREEN_COLUMNS[x] for x in labels])


def signal_columns(df: DataFrame) -> DataFrame:
    return _framed(df, R.SIGNAL_COLUMNS)


# ---------------------------------------------------------------- screens


def _signal(name: str, df: DataFrame) -> R.SignalSpec:
    spec = R.SIGNALS.get(name)
    if spec is None:
        raise R.QueryError(f"unknown signal {name!r}")
    lacking = [c for c in spec.needs if c not in df.columns]
    if lacking:
        raise R.QueryError(f"signal {name!r} needs the columns {', '.join(lacking)}")
    return spec


def signal_rows(df: DataFrame, name: str) -> DataFrame:
    """Every row of a signal, unranked and unlimited."""
    return df.where(_signal(name, df).predicate())


def signal_screen(df: DataFrame, name: str, limit: int | None = None) -> DataFrame:
    """A signal's rows in its own order with their rank: all, or the first ``limit``."""
    spec = _signal(name, df)
    return rank_limited(df.where(spec.predicate()), order_keys(spec.order, spec.descending), limit)


def signal_membership(df: DataFrame, name: str) -> DataFrame:
    """``symbol, in_signal`` for the whole snapshot: one pass, no join."""
    return df.select("symbol", F.coalesce(_signal(name, df).predicate(), F.lit(False)).alias("in_signal"))


def earnings_project(df: DataFrame, as_of: Column, date_column: str = "earnings") -> DataFrame:
    """Screen rows to typed earnings dates, raw displays and sessions.

    A missing display keeps an empty raw text and a null date.
    """
    shown = F.coalesce(F.col(date_column), F.lit(""))
    lead = [c for c in ("rank", "symbol") if c in df.columns]
    tail = [c for c in ("fetched_at", "extra_fields") if c in df.columns]
    carried = [c for c in df.columns if c not in (*lead, *tail, date_column)]
    return df.select(
        *lead,
        M.norm_date_earnings(shown, as_of).alias("earnings_date"),
        shown.alias("earnings_date_raw"),
        M.norm_session(shown).alias("earnings_session"),
        *carried,
        *tail,
    )


def insider_feed(df: DataFrame, feed: str, as_of: Column, limit: int | None = None) -> DataFrame:
    """One of the nine insider feeds over transactions the user holds.

    Needs ``transaction_date, side`` (1 buy, 2 sale), ``value``, ``ten_percent_owner``
    and ``symbol``; latest feeds sort by date, top feeds by value.
    """
    if feed not in R.INSIDER_FEEDS:
        raise R.QueryError(f"feed must be one of {', '.join(sorted(R.INSIDER_FEEDS))}")
    owner, minimum, side, by_value = R.INSIDER_FEEDS[feed]
    tests = []
    if owner == 10:
        tests.append(F.col("ten_percent_owner"))
    if owner == -10:
        tests.append(F.col("transaction_date") > F.date_sub(as_of, 7))
    tests.append(F.col("transaction_date") <= as_of)
    if minimum is not None:
        tests.append(F.col("value") >= minimum)
    if side in (1, 2):
        tests.append(F.col("side") == side)
    elif side == 7:
        tests.append(F.col("side").isin(1, 2))
    first = F.col("value").desc_nulls_last() if by_value else F.col("transaction_date").desc_nulls_last()
    keys = [first, F.col("symbol").asc(), F.col("transaction_id").asc()]
    return rank_limited(df.where(reduce(and_, tests)), keys, limit)


def compare_peers(df: DataFrame, symbol: str, *same: str) -> DataFrame:
    """Other symbols that share ``same`` (sector, industry, country …) with one.

    A symbol with several classifications has the peers of each, once.
    """
    columns = list(same) or ["sector", "industry", "country"]
    subject = df.where(F.col("symbol") == symbol).select(*columns).distinct()
    return df.where(F.col("symbol") != symbol).join(subject, columns, "left_semi")


def symbol_search(df: DataFrame, query: str, limit: int = 10) -> DataFrame:
    """At most ten symbols: exact match, then prefix, then a company that contains it."""
    if not query.strip():
        raise R.QueryError("query must be a nonblank string")
    if len(query) > 64:
        raise R.QueryError("query must be at most 64 characters")
    q = query.strip().upper()
    score = (
        F.when(F.upper("symbol") == q, 0)
        .when(F.upper("symbol").startswith(q), 1)
        .when(F.upper("company").startswith(q), 2)
        .when(F.upper("company").contains(q) | F.upper("symbol").contains(q), 3)
    )
    hits = df.withColumn("score", score).where(F.col("score").isNotNull())
    return rank_limited(hits, [F.col("score").asc(), F.col("symbol").asc()], limit)


def release_detail(df: DataFrame, slug: str, limit: int | None = None) -> DataFrame:
    """The history of one release, newest last."""
    import re

    if not re.match(X.SLUG.replace(r"\z", r"\Z"), slug) or len(slug) > X.SLUG_MAX["release"]:
        raise R.QueryError(f"bad release slug {slug!r}")
    rows = df.where(F.col("slug") == slug)
    order = [F.col("release_date").asc(), F.xxhash64(*df.columns).asc()]
    return rows.orderBy(*order) if limit is None else rows.orderBy(*order).limit(limit)


def publisher_filter(df: DataFrame, slug: str) -> DataFrame:
    import re

    if not re.match(X.SLUG.replace(r"\z", r"\Z"), slug) or len(slug) > X.SLUG_MAX["publisher"]:
        raise R.QueryError(f"bad publisher slug {slug!r}")
    return df.where(F.col("publisher") == slug)
