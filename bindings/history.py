"""History and streaming operators over events as observations.

Streaming queries replay the files of a table to the end and return what the
stream wrote; where the batch plan of the same operator has an exact answer, the
stream is held to it.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tickweave.operators import history as H
from tickweave.operators.intervals import IntervalTable
from tickweave.operators import relations as L
from tickweave.streaming import keyed as K
from tickweave.streaming import progress as G
from tickweave.streaming import sinks as S
from tickweave.streaming import windows as W

from .core import VIEW_SQL, query, scratch
from .screens import plain

VIEW_SQL["m"] = "SELECT DISTINCT metric, CAST(fetched_at AS DATE) AS capture, symbol FROM observations"
VIEW_SQL["r"] = (
    "SELECT metric, capture, row_number() OVER (PARTITION BY metric ORDER BY capture) AS n "
    "FROM (SELECT DISTINCT metric, capture FROM m)"
)
KEY = ["symbol", "metric"]


def _obs(t):
    return t("observations")


@query(
    "hist_dedupe_response",
    "SELECT symbol, response_hash, min(id) AS id, min(fetched_at) AS fetched_at FROM observations GROUP BY symbol, response_hash",
    "observations",
)
def hist_dedupe_response(t):
    return plain(H.hist_dedupe_response(_obs(t).select("symbol", "response_hash", "id", "fetched_at"), ["symbol"]))


@query(
    "hist_dedupe_changed",
    "SELECT symbol, response_hash, id FROM (SELECT *, lag(response_hash) OVER (PARTITION BY symbol ORDER BY fetched_at, id) AS p FROM observations) WHERE p IS NULL OR p <> response_hash",
    "observations",
)
def hist_dedupe_changed(t):
    rows = _obs(t).select("symbol", "response_hash", "id", "fetched_at")
    return H.hist_dedupe_response(rows, ["symbol"], mode="changed").select("symbol", "response_hash", "id")


_FEED = """SELECT symbol, metric, id, fetched_at, props FROM (SELECT *, lag(props) OVER (PARTITION BY symbol ORDER BY fetched_at, id) AS p,
    row_number() OVER (PARTITION BY symbol ORDER BY fetched_at, id) AS rn FROM observations) WHERE rn = 1 OR p <> props"""


@query("hist_change_feed", _FEED, "observations")
def hist_change_feed(t):
    feed = H.hist_change_feed(_obs(t), ["symbol"], ["props"])
    return plain(feed.select("symbol", "metric", "id", "fetched_at", "props"))


@query(
    "hist_scd2",
    f"""SELECT symbol, id, fetched_at AS valid_from, lead(fetched_at) OVER w AS valid_to, lead(fetched_at) OVER w IS NULL AS is_current
    FROM ({_FEED}) WINDOW w AS (PARTITION BY symbol ORDER BY fetched_at, id)""",
    "observations",
)
def hist_scd2(t):
    feed = H.hist_change_feed(_obs(t), ["symbol"], ["props"])
    return plain(H.hist_scd2(feed, ["symbol"]).select("symbol", "id", "valid_from", "valid_to", "is_current"))


@query(
    "hist_scd2_incremental",
    f"""SELECT symbol, id, fetched_at AS valid_from, lead(fetched_at) OVER w AS valid_to, lead(fetched_at) OVER w IS NULL AS is_current
    FROM ({_FEED}) WINDOW w AS (PARTITION BY symbol ORDER BY fetched_at, id)""",
    "observations",
)
def hist_scd2_incremental(t):
    """The same table from three batches out of order, one of them delivered twice."""
    table = IntervalTable(scratch(t, "intervals"), ["symbol"], ["props"], buckets=16)
    part = F.pmod(F.xxhash64("id"), F.lit(3))
    for epoch, number in enumerate((2, 0, 0, 1)):
        table.apply(_obs(t).where(part == number), 1 if number == 0 else epoch)
    return plain(table.read(t.spark).select("symbol", "id", "valid_from", "valid_to", "is_current"))


@query(
    "hist_current",
    "SELECT symbol, metric, max(fetched_at) AS fetched_at, arg_max(id, (fetched_at, id)) AS id, arg_max(value, (fetched_at, id)) AS value FROM observations GROUP BY symbol, metric",
    "observations",
)
def hist_current(t):
    return plain(H.hist_current(_obs(t).select(*KEY, "id", "value", "fetched_at"), KEY))


@query(
    "hist_asof",
    "SELECT symbol, metric, max(fetched_at) AS fetched_at, arg_max(id, (fetched_at, id)) AS id, arg_max(value, (fetched_at, id)) AS value FROM observations WHERE fetched_at <= TIMESTAMP '2024-01-15 12:00:00' GROUP BY symbol, metric",
    "observations",
)
def hist_asof(t):
    at = F.lit("2024-01-15 12:00:00").cast("timestamp")
    return plain(H.hist_asof(_obs(t).select(*KEY, "id", "value", "fetched_at"), KEY, at))


@query(
    "hist_asof_join",
    """SELECT e.symbol, e.id, o.fetched_at AS asof_fetched_at, o.value AS asof_value FROM (SELECT * FROM observations WHERE metric = 'purchase') e
    ASOF LEFT JOIN (SELECT * FROM observations WHERE metric = 'view') o ON e.symbol = o.symbol AND e.fetched_at >= o.fetched_at""",
    "observations",
)
def hist_asof_join(t):
    """Each purchase with its user's latest earlier view."""
    rows = _obs(t)
    left = rows.where(F.col("metric") == "purchase").select("symbol", "id", "fetched_at")
    right = rows.where(F.col("metric") == "view").select("symbol", "id", "fetched_at", "value")
    joined = H.asof_join(left, right, ["symbol"], "fetched_at", "fetched_at", ["value"], "id")
    return plain(joined.select("symbol", "id", "asof_fetched_at", "asof_value"))


@query(
    "hist_revisions",
    """SELECT symbol, metric, fetched_at, old_value, value AS new_value FROM (SELECT *, lag(value) OVER w AS old_value, row_number() OVER w AS rn FROM observations
    WINDOW w AS (PARTITION BY symbol, metric ORDER BY fetched_at, id)) WHERE rn > 1 AND old_value <> value""",
    "observations",
)
def hist_revisions(t):
    return plain(H.hist_revisions(_obs(t), KEY, "value"))


@query(
    "hist_membership",
    """SELECT metric, capture, symbol, CASE WHEN was IS NULL THEN 'enter' WHEN now IS NULL THEN 'exit' ELSE 'stay' END AS transition FROM (
        SELECT coalesce(n.metric, w.metric) AS metric, coalesce(n.capture, w.capture) AS capture, coalesce(n.symbol, w.symbol) AS symbol, n.symbol AS now, w.symbol AS was
        FROM (SELECT m.* FROM m JOIN r ON m.metric = r.metric AND m.capture = r.capture WHERE r.n > 1) n
        FULL JOIN (SELECT m.metric, b.capture, m.symbol FROM m JOIN r a ON m.metric = a.metric AND m.capture = a.capture JOIN r b ON b.metric = a.metric AND b.n = a.n + 1) w
        ON n.metric = w.metric AND n.capture = w.capture AND n.symbol = w.symbol)""",
    "observations",
    "m",
    "r",
)
def hist_membership(t):
    """Daily sets of the users seen per event type."""
    rows = _obs(t).withColumn("capture", F.col("fetched_at").cast("date"))
    return H.hist_membership(rows, ["metric"], "capture")


@query(
    "hist_long_observations",
    """SELECT symbol, u.metric, u.value_numeric, u.value_text, u.unit FROM securities, LATERAL (VALUES ('price', price, NULL, 'number'), ('volume', CAST(volume AS DOUBLE), NULL, 'count'),
        ('country', NULL, country, 'text')) AS u(metric, value_numeric, value_text, unit)""",
    "securities",
)
def hist_long_observations(t):
    units = {"price": "number", "volume": "count", "country": "text"}
    return L.wide_to_long(t("securities"), ["symbol"], ["price", "volume", "country"], units)


@query(
    "hist_window_stats",
    """SELECT symbol, metric, id, round(avg(value) OVER w, 6) AS moving_mean, min(value) OVER w AS moving_min, max(value) OVER w AS moving_max, count(value) OVER w AS n_rows
    FROM observations WINDOW w AS (PARTITION BY symbol, metric ORDER BY fetched_at, id ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)""",
    "observations",
)
def hist_window_stats(t):
    stats = H.hist_window_stats(_obs(t), KEY, "value")
    return stats.select(*KEY, "id", F.round("moving_mean", 6).alias("moving_mean"), "moving_min", "moving_max", "n_rows")


@query(
    "hist_range_stats",
    """SELECT symbol, metric, id, round(avg(value) OVER w, 6) AS moving_mean, min(value) OVER w AS moving_min, max(value) OVER w AS moving_max, count(value) OVER w AS n_rows
    FROM observations WINDOW w AS (PARTITION BY symbol, metric ORDER BY fetched_at RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND CURRENT ROW)""",
    "observations",
)
def hist_range_stats(t):
    """The same over the seven days up to each observation."""
    stats = H.hist_range_stats(_obs(t), KEY, "value", range_seconds=7 * 86400)
    return stats.select(*KEY, "id", F.round("moving_mean", 6).alias("moving_mean"), "moving_min", "moving_max", "n_rows")


# ---------------------------------------------------------------- streaming


def _events(raw):
    return W.timed(
        raw.select(
            F.col("event_id").alias("id"),
            F.concat(F.lit("U"), "user_id").alias("symbol"),
            F.col("event_type").alias("metric"),
            "value",
            F.col("ts").alias("fetched_at"),
            "props",
        )
    )


def _delivery():
    """Ten days a delivery; every 17th event comes one delivery late."""
    days = F.floor(F.datediff(F.col("ts"), F.lit("2024-01-01").cast("date")) / 10)
    return (days + F.when(F.col("event_id") % 17 == 0, 1).otherwise(0)).cast("int")


_DELIVERED = "(SELECT *, date_diff('day', DATE '2024-01-01', CAST(fetched_at AS DATE)) // 10 + CASE WHEN id % 17 = 0 THEN 1 ELSE 0 END AS d FROM observations)"


def _in_deliveries(t, name: str, start, closing=None) -> str:
    """Lay the events down delivery by delivery and run a stream over each; the folder all runs share.

    ``start(stream, folder)`` starts a query until the present files are used up. ``closing``
    adds columns of a last row, far in the future, which moves the watermark over everything.
    """
    folder = scratch(t, name)
    events = t("events").withColumn("_delivery", _delivery())
    last = events.agg(F.max("_delivery")).first()[0]
    batches = [events.where(F.col("_delivery") == d).drop("_delivery") for d in range((last or 0) + 1)]
    if closing is not None:
        batches.append(closing)
    for batch in batches:
        batch.select(*t("events").columns).write.mode("append").parquet(f"{folder}/in")
        stream = _events(t.spark.readStream.schema(t("events").schema).parquet(f"{folder}/in"))
        start(stream, folder).awaitTermination()
    return folder


def _flush(t):
    """One event in another year: sessions end when time has passed them."""
    row = t("events").agg(F.max("ts").alias("ts"))
    return row.select(
        F.lit(-1).cast("bigint").alias("event_id"), (F.col("ts") + F.expr("interval 365 days")).alias("ts"), F.lit(-1).cast("bigint").alias("user_id"),
        F.lit("flush").alias("event_type"), F.lit(0.0).alias("value"), F.lit("{}").alias("props"),
    )


def _sink(df, folder: str, mode: str = "append"):
    out = df.writeStream.format("parquet").option("checkpointLocation", f"{folder}/ckpt").outputMode(mode)
    return out.trigger(availableNow=True).start(f"{folder}/rows")


def _stream(t):
    """The events table as a stream of observations."""
    return _events(t.spark.readStream.schema(t("events").schema).parquet(t.path("events*")))


def _replayed(t, df, name: str, mode: str = "append"):
    """Run a stream until its files are used up; its result as a batch table."""
    folder = scratch(t, name)
    if mode == "append":
        out = df.writeStream.format("parquet").option("checkpointLocation", f"{folder}/ckpt").outputMode("append")
        out.trigger(availableNow=True).start(f"{folder}/rows").awaitTermination()
        return t.spark.read.schema(df.schema).parquet(f"{folder}/rows")

    def keep(batch, epoch):
        # An epoch that is replayed overwrites its own folder.
        batch.write.mode("overwrite").parquet(f"{folder}/rows/epoch={epoch}")

    out = df.writeStream.foreachBatch(keep).option("checkpointLocation", f"{folder}/ckpt").outputMode(mode)
    out.trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.schema(df.schema).option("recursiveFileLookup", "true").parquet(f"{folder}/rows")


def _finished(t, stream, name: str, by: list[str]):
    """A window of an ``update`` stream is what its last, largest emission says."""
    rows = _replayed(t, stream, name, "update")
    keys = ["window_start", "window_end", *by]
    rest = [c for c in rows.columns if c not in keys]
    last = F.max_by(F.struct(*rest), "n").alias("last")
    return rows.groupBy(*keys).agg(last).select(*keys, "last.*")


def _windowed(df):
    return plain(df.withColumn("mean_value", F.round("mean_value", 6)))


_DAILY = """SELECT date_trunc('day', fetched_at) AS window_start, date_trunc('day', fetched_at) + INTERVAL 1 DAY AS window_end, metric, count(*) AS n,
    min(value) AS min_value, max(value) AS max_value, round(avg(value), 6) AS mean_value FROM observations GROUP BY ALL"""


@query("st_tumbling", _DAILY, "observations")
def st_tumbling(t):
    stream = W.st_tumbling(_stream(t), "1 day", ["metric"], "value", lateness="1 day")
    return _windowed(_finished(t, stream, "tumbling", ["metric"]))


@query("st_tumbling_batch", _DAILY, "observations")
def st_tumbling_batch(t):
    return _windowed(W.st_tumbling(_obs(t), "1 day", ["metric"], "value"))


_SLIDING = """SELECT s AS window_start, s + INTERVAL 1 DAY AS window_end, metric, count(*) AS n, min(value) AS min_value, max(value) AS max_value, round(avg(value), 6) AS mean_value
    FROM (SELECT metric, value, time_bucket(INTERVAL 6 HOUR, fetched_at) - to_hours(CAST(6 * i AS INTEGER)) AS s FROM observations, range(4) r(i)) GROUP BY ALL"""


@query("st_sliding", _SLIDING, "observations")
def st_sliding(t):
    stream = W.st_sliding(_stream(t), "1 day", "6 hours", ["metric"], "value", lateness="1 day")
    return _windowed(_finished(t, stream, "sliding", ["metric"]))


_SESSIONS = """SELECT min(fetched_at) AS window_start, max(fetched_at) + INTERVAL 2 HOUR AS window_end, symbol, count(*) AS n, min(value) AS min_value, max(value) AS max_value, round(avg(value), 6) AS mean_value
    FROM (SELECT *, sum(CASE WHEN p IS NULL OR fetched_at >= p + INTERVAL 2 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY symbol ORDER BY fetched_at, id) AS s
        FROM (SELECT *, lag(fetched_at) OVER (PARTITION BY symbol ORDER BY fetched_at, id) AS p FROM observations)) GROUP BY symbol, s"""


@query("st_session_batch", _SESSIONS, "observations")
def st_session_batch(t):
    return _windowed(W.st_session(_obs(t), "2 hours", ["symbol"], "value"))


@query("st_session", _SESSIONS, "observations")
def st_session(t):
    """All sessions: a last row far in the future closes those that are open at the end."""
    sessions = []

    def start(stream, folder):
        out = W.st_session(stream, "2 hours", ["symbol"], "value", lateness="12 days")
        sessions.append(out.schema)
        return _sink(out, folder)

    folder = _in_deliveries(t, "session", start, _flush(t))
    closed = t.spark.read.schema(sessions[0]).parquet(f"{folder}/rows")
    return _windowed(closed.where(F.col("symbol") != "U-1"))


@query("hist_sessions", _SESSIONS, "observations")
def hist_sessions(t):
    """The same from pieces per hour, merged by the start that reaches them."""
    return _windowed(H.hist_sessions(_obs(t), ["symbol"], 7200, "value"))


@query("st_dedupe", "SELECT DISTINCT symbol, metric FROM observations", "observations")
def st_dedupe(t):
    """Distinct keys; state is kept longer than the data last, so no key comes twice."""
    stream = _stream(t).select(*KEY, "fetched_at")
    return _replayed(t, W.st_dedupe(stream, KEY, lateness="400 days"), "dedupe").select("symbol", "metric")


_LATE = f"""SELECT *, coalesce(fetched_at < max(fetched_at) OVER (ORDER BY d GROUPS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 1 HOUR, false) AS late FROM {_DELIVERED}"""


@query("st_late", f"SELECT metric, late, count(*) AS n FROM ({_LATE}) GROUP BY ALL", "observations")
def st_late(t):
    """Every row arrives on time or late, none is lost; some come a delivery late."""
    sinks = {}

    def start(stream, folder):
        sinks["rows"] = S.LateRows(f"{folder}/split", "1 hour")
        return stream.writeStream.foreachBatch(sinks["rows"]).option("checkpointLocation", f"{folder}/ckpt").trigger(availableNow=True).start()

    _in_deliveries(t, "late", start)
    return sinks["rows"].read(t.spark).groupBy("metric", "late").agg(F.count("*").alias("n"))


@query(
    "on_progress",
    f"SELECT CAST(d AS BIGINT) AS delivery, count(*) AS input_rows, count(*) FILTER (late) AS dropped_rows FROM ({_LATE}) GROUP BY d",
    "observations",
)
def on_progress(t):
    """Rows that a stream read and rows it dropped behind its watermark, by delivery, as it reported them."""
    reports, runs = scratch(t, "progress"), []
    with G.ProgressTable(t.spark, reports) as table:

        def start(stream, folder):
            seen = W.st_dedupe(stream.select("id", "fetched_at"), ["id"], lateness="1 hour")
            runs.append(_sink(seen, folder))
            return runs[-1]

        _in_deliveries(t, "dropped", start)
        for run in runs:
            table.wait(run.runId)
    order = F.create_map(*[F.lit(x) for i, run in enumerate(runs) for x in (str(run.runId), i)])  # one entry per delivery
    seen = table.read().withColumn("delivery", F.try_element_at(order, F.col("run_id")).cast("bigint"))
    sums = seen.groupBy("delivery").agg(F.sum("input_rows").alias("input_rows"), F.sum("dropped_rows").alias("dropped_rows"))
    return sums.where(F.col("input_rows") > 0)


@query("st_change_feed", _FEED, "observations")
def st_change_feed(t):
    folder = scratch(t, "feed")
    sink = S.ChangeFeed(folder, ["symbol"], ["props"])
    S.run_available(_stream(t), sink, f"{folder}/ckpt")
    return plain(sink.read(t.spark).select("symbol", "metric", "id", "fetched_at", "props"))


_KEYED = f"""SELECT *, fetched_at <= high AS late FROM (SELECT *, max(fetched_at) OVER (PARTITION BY symbol ORDER BY d GROUPS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS high FROM {_DELIVERED})"""
_KEYED_FEED = f"""SELECT symbol, metric, id, fetched_at, props, false AS late FROM (SELECT *, lag(props) OVER (PARTITION BY symbol ORDER BY fetched_at, id) AS p,
    row_number() OVER (PARTITION BY symbol ORDER BY fetched_at, id) AS rn FROM ({_KEYED}) WHERE late IS NOT TRUE) WHERE rn = 1 OR p <> props
    UNION ALL SELECT symbol, metric, id, fetched_at, props, true FROM ({_KEYED}) WHERE late"""


def _keyed(t, name: str, **options):
    schemas = []

    def start(stream, folder):
        feed = K.keyed_change_feed(stream, ["symbol"], ["props"], **options).select("symbol", "metric", "id", "fetched_at", "props", "late")
        schemas.append(feed.schema)
        return _sink(feed, folder)

    with K.rocksdb(t.spark):
        folder = _in_deliveries(t, name, start)
    return plain(t.spark.read.schema(schemas[0]).parquet(f"{folder}/rows"))


@query("st_keyed_feed", _KEYED_FEED, "observations")
def st_keyed_feed(t):
    """The change feed from keyed state; rows older than their key's state are marked late, never compared."""
    return _keyed(t, "keyed")


_SEEN = f"SELECT *, date_trunc('milliseconds', max(fetched_at) OVER (ORDER BY d GROUPS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) - INTERVAL 1 HOUR AS mark FROM {_DELIVERED}"
_IN_TIME = f"SELECT *, max(fetched_at) OVER (PARTITION BY symbol ORDER BY d GROUPS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS high FROM ({_SEEN}) WHERE mark IS NULL OR fetched_at > mark"
_EXPIRING = f"""SELECT symbol, id, fetched_at FROM (SELECT *, lag(props) OVER w AS p, lag(d) OVER w AS before, lag(fetched_at) OVER w AS since
    FROM ({_IN_TIME}) WHERE high IS NULL OR fetched_at > high WINDOW w AS (PARTITION BY symbol ORDER BY fetched_at, id))
    WHERE p IS NULL OR p <> props OR (before < d AND date_trunc('milliseconds', since) + INTERVAL 3 HOUR < mark)"""


@query("st_keyed_expiry", _EXPIRING, "observations")
def st_keyed_expiry(t):
    """The same where keys are forgotten three hours after their last row, as the watermark sees it: they come back as new."""
    rows = _keyed(t, "expiring", lateness="1 hour", idle_seconds=3 * 3600)
    return rows.where(~F.col("late")).select("symbol", "id", "fetched_at")


@query(
    "st_join_calendar",
    "SELECT o.id, o.symbol, c_name, c_mktsegment FROM observations o LEFT JOIN customer ON c_custkey = o.uid",
    "observations",
)
def st_join_calendar(t):
    dimension = t("customer").select(F.concat(F.lit("U"), "c_custkey").alias("symbol"), "c_name", "c_mktsegment")
    joined = W.st_join_calendar(_stream(t).select("id", "symbol"), dimension, ["symbol"])
    return _replayed(t, joined, "joined").select("id", "symbol", "c_name", "c_mktsegment")
