"""Signals that need events, not a snapshot's columns: rating changes, insider dealing, news.

Events are reduced to one row per symbol and day before they meet the snapshot, and only days up
to a symbol's ``fetched_at`` and within the window before it count, so a signal says what could
be known then. A symbol with many events is spread by day until then.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans import registry as R
from .history import with_previous
from .ranking import global_rank, order_keys


def rating_changes(ratings: DataFrame, level: Column, source: list[str], order: tuple[str, str] = ("published_at", "id")) -> DataFrame:
    """Ratings that differ from the same source's last one for the symbol, with ``step`` = new level - old.

    ``level`` is a number, higher for better; ratings without one are passed over.
    """
    leveled = ratings.withColumn("level", level).where(F.col("level").isNotNull())
    key = ["symbol", *source]
    before = with_previous(leveled, key, list(order), F.col("level"), "old_level", "day")
    step = F.col("level") - F.col("old_level")
    return before.where(F.col("has_old_level") & (step != 0)).withColumn("step", step).drop("has_old_level")


def _daily(events: DataFrame, at: str, **sums: Column) -> DataFrame:
    return events.groupBy("symbol", F.to_date(at).alias("day")).agg(F.max(at).alias("latest"), *[F.sum(c).alias(name) for name, c in sums.items()])


def _known(snapshot: DataFrame, daily: DataFrame, days: int, *totals: str) -> DataFrame:
    """Snapshot rows with the totals of the ``days`` whole days before the day they were fetched, and that day up to then."""
    seen = snapshot.select("symbol", "fetched_at").distinct()
    day = F.to_date("fetched_at")
    near = daily.join(seen, "symbol").where((F.col("day") > F.date_sub(day, days)) & (F.col("latest") <= F.col("fetched_at")))
    sums = near.groupBy("symbol", "fetched_at").agg(F.max("latest").alias("latest"), *[F.sum(t).alias(t) for t in totals])
    return snapshot.join(sums, ["symbol", "fetched_at"])


#: Name -> (which events it reads, the measure it orders by, whether large comes first).
EVENT_SIGNALS = {
    "Upgrades": ("ratings", "upgrades", True),
    "Downgrades": ("ratings", "downgrades", True),
    "Recent Insider Buying": ("insider", "net_value", True),
    "Recent Insider Selling": ("insider", "net_value", False),
    "Major News": ("news", "stories", True),
}


def event_signal(name: str, snapshot: DataFrame, events: DataFrame, *, days: int = 30, least: int = 1) -> DataFrame:
    """Rows of the snapshot in the signal with its measure, ``latest`` and ``rank``.

    ``events`` are, by signal: the rows of ``rating_changes``; insider transactions with
    ``transaction_date, side`` (``buy`` or ``sell``) and ``value``; news with ``published_at``.
    ``least`` is the number of changes or stories that it takes.
    The last day of a symbol counts whole or, if it holds an event after ``fetched_at``, not at all,
    so cut events off at that instant where snapshots are taken during a day.
    """
    spec = EVENT_SIGNALS.get(name)
    if spec is None:
        raise R.QueryError(f"unknown event signal {name!r}; there are {', '.join(EVENT_SIGNALS)}")
    if days < 1 or least < 1:
        raise R.QueryError("days and least must be positive")
    _, measure, descending = spec
    if measure in ("upgrades", "downgrades"):
        up = F.col("step") > 0 if measure == "upgrades" else F.col("step") < 0
        rows = _known(snapshot, _daily(events.where(up), "published_at", **{measure: F.lit(1)}), days, measure).where(F.col(measure) >= least)
    elif measure == "net_value":
        signed = F.when(F.col("side") == "buy", F.col("value")).when(F.col("side") == "sell", -F.col("value"))
        rows = _known(snapshot, _daily(events, "transaction_date", net_value=signed), days, measure)
        rows = rows.where(F.col(measure) > 0 if descending else F.col(measure) < 0)
    else:
        rows = _known(snapshot, _daily(events, "published_at", stories=F.lit(1)), days, measure).where(F.col(measure) >= least)
    return global_rank(rows, order_keys(measure, descending))
