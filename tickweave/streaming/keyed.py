"""The change feed as a keyed state machine: one state row per key in the state store.

``transformWithState`` keeps, per key, the order and hash of its newest row in the RocksDB
store. State leaves in one of two ways: by event time, when a key has been silent for ``idle``
as the watermark sees it (a timer per key), or by a ``ttl`` of the wall clock. A key that
comes back afterwards is new. Without either, keys stay for ever.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.hashing import hash_row

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def rocksdb(spark: SparkSession):
    """Streams started inside the block keep their state in RocksDB; the session's setting returns afterwards."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


class _Feed(StatefulProcessor):
    """Rows of a key in order, each compared with the one before; the newest is remembered."""

    def __init__(self, columns: list[str], order: tuple[str, str], idle_ms: int | None, ttl_ms: int | None):
        self.columns, self.order, self.idle_ms, self.ttl_ms = columns, order, idle_ms, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", "at long, tie long, hash string", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        # Plain rows: most keys have few of them a batch, and every call to the state costs a round trip.
        known = self.newest.get()
        ordered = sorted(rows, key=lambda r: (r["at_micros"] is None, r["at_micros"] or 0, r["tie_break"] is None, r["tie_break"] or 0))
        before, last, late = known[2] if known is not None else None, None, []
        for row in ordered:
            if known is not None and self._behind(row, known):
                late.append(row)
                continue
            if before is None or before != row["row_hash"]:
                yield self._said(row, before, False)
            before, last = row["row_hash"], row
        for row in late:
            yield self._said(row, None, True)
        if last is not None:
            self.newest.update((int(last["at_micros"]), int(last["tie_break"]), last["row_hash"]))
            if self.idle_ms is not None:
                due = int(last["at_micros"]) // 1000 + self.idle_ms
                old = None if known is None else known[0] // 1000 + self.idle_ms  # a key with state has this one timer
                if due != old:
                    if old is not None:
                        self.handle.deleteTimer(old)
                    self.handle.registerTimer(due)

    @staticmethod
    def _behind(row: Row, known: tuple) -> bool:
        """Whether a row is not newer than its key's state."""
        at, tie = row["at_micros"], row["tie_break"]
        return at is not None and (at < known[0] or (at == known[0] and tie is not None and tie <= known[1]))

    def _said(self, row: Row, previous: str | None, late: bool) -> Row:
        return Row(**{c: row[c] for c in self.columns}, previous_hash=previous, late=late)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.newest.clear()
        return iter(())

    def close(self) -> None:
        pass


def keyed_change_feed(
    stream: DataFrame,
    key: list[str],
    values: list[str],
    order: tuple[str, str] = ("fetched_at", "id"),
    *,
    lateness: str | None = None,
    idle_seconds: int | None = None,
    ttl_seconds: int | None = None,
) -> DataFrame:
    """Changed rows of a stream with ``previous_hash``, and rows older than their key's state as ``late``.

    ``order`` is a timestamp and an integer. ``idle_seconds`` needs ``lateness``, the
    watermark's delay; keys without a row for that long lose their state. ``ttl_seconds``
    does the same by the clock and is refused beside it; such a stream has a next batch for
    ever, so an ``availableNow`` trigger does not end it. Start the stream inside
    ``rocksdb(spark)``. The rows of one key and micro-batch are in one task: limit the batch
    at the source (``maxFilesPerTrigger``, ``maxBytesPerTrigger``) where one key is most of it.
    """
    if idle_seconds is not None and (ttl_seconds is not None or lateness is None):
        raise ValueError("idle_seconds needs lateness and excludes ttl_seconds")
    at, tie = order
    if lateness is not None:
        stream = stream.withWatermark(at, lateness)
    rows = stream.withColumns(
        {"row_hash": hash_row(*[F.col(v) for v in values]), "at_micros": F.unix_micros(F.col(at).cast("timestamp")), "tie_break": F.col(tie).cast("bigint")}
    )
    said = rows.drop("at_micros", "tie_break")
    # Timestamps cross as microseconds: rows in Python know no session time zone.
    times = [c.name for c in said.schema if c.dataType.simpleString() == "timestamp"]
    rows = rows.withColumns({f"_micros_{c}": F.unix_micros(c) for c in times})
    out = [(f"_micros_{c.name}", "bigint") if c.name in times else (c.name, c.dataType.simpleString()) for c in said.schema]
    mode = "EventTime" if idle_seconds is not None else "ProcessingTime" if ttl_seconds is not None else "None"
    feed = _Feed([name for name, _ in out], order, None if idle_seconds is None else idle_seconds * 1000, None if ttl_seconds is None else ttl_seconds * 1000)
    schema = ", ".join(f"`{name}` {kind}" for name, kind in out) + ", previous_hash string, late boolean"
    found = rows.groupBy(*key).transformWithState(feed, schema, "Append", mode)
    columns = [F.timestamp_micros(f"_micros_{c}").alias(c) if c in times else F.col(f"`{c}`") for c in said.columns]
    return found.select(*columns, "previous_hash", "late")
