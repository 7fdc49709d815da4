"""Keyed state, progress tables, sessions and range frames of busy keys."""

import time

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tickweave.operators import history as H
from tickweave.streaming import keyed as K
from tickweave.streaming import progress as G

SCHEMA = "id long, symbol string, fetched_at timestamp, v long"


def rows(spark, *items):
    return spark.createDataFrame([(i, s, None, v, str(at)) for i, s, at, v in items], SCHEMA + ", at string").withColumn("fetched_at", F.to_timestamp("at")).drop("at")


def deliver(spark, folder, batch, **options):
    """One more batch of files, and what the feed says about it."""
    batch.write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(SCHEMA).parquet(f"{folder}/in")
    feed = K.keyed_change_feed(stream, ["symbol"], ["v"], **options)
    with K.rocksdb(spark):
        run = feed.writeStream.format("parquet").option("checkpointLocation", f"{folder}/ckpt").trigger(availableNow=True).start(f"{folder}/out")
        run.awaitTermination()
    return run, sorted((r.id, r.late) for r in spark.read.parquet(f"{folder}/out").collect())


def test_keyed_feed_survives_restarts_and_marks_late_rows(spark, tmp_path):
    folder = str(tmp_path)
    _, out = deliver(spark, folder, rows(spark, (1, "A", "2024-01-02 00:00:00", 5), (2, "A", "2024-01-02 01:00:00", 5), (3, "B", "2024-01-02 00:00:00", 5)))
    assert out == [(1, False), (3, False)]
    _, out = deliver(spark, folder, rows(spark, (4, "A", "2024-01-02 02:00:00", 5), (5, "A", "2024-01-01 00:00:00", 9), (6, "A", "2024-01-02 03:00:00", 6)))
    assert out == [(1, False), (3, False), (5, True), (6, False)]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_idle_keys_leave_the_state(spark, tmp_path):
    options = {"lateness": "1 hour", "idle_seconds": 3600}
    with G.ProgressTable(spark, str(tmp_path / "progress")) as table:
        first = rows(spark, *[(i, f"S{i}", "2024-01-01 00:00:00", 1) for i in range(50)])
        deliver(spark, str(tmp_path / "s"), first, **options)
        run, out = deliver(spark, str(tmp_path / "s"), rows(spark, (100, "Z", "2024-01-03 00:00:00", 1)), **options)
        table.wait(run.runId)
        again, out = deliver(spark, str(tmp_path / "s"), rows(spark, (101, "S7", "2024-01-03 00:30:00", 1)), **options)
        table.wait(again.runId)
    assert (101, False) in out  # its state had gone, so the same value is new
    seen = {r.batch_id: r.state_rows for r in table.read().collect()}
    assert max(seen.values()) >= 50 and seen[max(seen)] <= 6


def test_state_can_live_by_the_clock(spark, tmp_path):
    """A stream that counts time never runs out of batches, so it is stopped once it has said enough."""
    folder = str(tmp_path)
    rows(spark, (1, "A", "2024-01-01 00:00:00", 5)).write.mode("append").parquet(f"{folder}/in")
    feed = K.keyed_change_feed(spark.readStream.schema(SCHEMA).parquet(f"{folder}/in"), ["symbol"], ["v"], ttl_seconds=1)
    said = []
    with K.rocksdb(spark):
        run = feed.writeStream.foreachBatch(lambda df, _: said.extend(r.id for r in df.collect())).option("checkpointLocation", f"{folder}/ckpt").start()
    try:
        for number in (1, 2):
            deadline = time.time() + 60
            while number not in said and time.time() < deadline:
                time.sleep(0.3)
            if number == 1:
                time.sleep(1.5)
                rows(spark, (2, "A", "2024-01-01 01:00:00", 5)).write.mode("append").parquet(f"{folder}/in")
    finally:
        run.stop()
    assert said == [1, 2]


def test_expiry_needs_a_watermark(spark):
    for options in ({"idle_seconds": 5}, {"idle_seconds": 5, "lateness": "1 hour", "ttl_seconds": 5}):
        with pytest.raises(ValueError):
            K.keyed_change_feed(rows(spark), ["symbol"], ["v"], **options)


def busy(spark, n=6000):
    """A third of all rows are one symbol's."""
    df = spark.range(n).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("S"), (F.col("id") % 97).cast("string"))).alias("symbol"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.pmod(F.xxhash64("id"), F.lit(40 * 86400))).alias("fetched_at"),
        F.when(F.col("id") % 11 > 0, F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)).cast("double")).alias("value"),
    )
    return df.unionByName(df.where("id % 50 = 0").withColumn("id", F.col("id") + n))  # equal instants


def largest_task(df, keys):
    """Rows of the largest group that a window of the plan has to hold."""
    return df.groupBy(*keys, F.date_trunc("hour", "fetched_at")).count().agg(F.max("count")).first()[0]


def test_sessions_of_a_busy_symbol(spark):
    df = busy(spark)
    got = {tuple(r) for r in H.hist_sessions(df, ["symbol"], 1800, "value").select("symbol", "window_start", "window_end", "n", "min_value", "max_value").collect()}
    want, by = set(), {}
    for r in df.collect():
        by.setdefault(r.symbol, []).append((r.fetched_at, r.id, r.value))
    for symbol, items in by.items():
        items.sort(key=lambda x: x[:2])
        runs = [[items[0]]]
        for item in items[1:]:
            runs[-1].append(item) if (item[0] - runs[-1][-1][0]).total_seconds() < 1800 else runs.append([item])
        for run in runs:
            values = [v for _, _, v in run if v is not None]
            want.add((symbol, run[0][0], run[-1][0] + __import__("datetime").timedelta(seconds=1800), len(run), min(values, default=None), max(values, default=None)))
    assert got == want
    assert largest_task(df, ["symbol"]) < df.where("symbol = 'HOT'").count() / 50


@pytest.mark.parametrize(("reach", "bucket"), [(3600, 3600), (86400, 3600), (86400, 21600)])
def test_range_frames_equal_a_plain_window(spark, reach, bucket):
    from pyspark.sql import Window as W

    df = busy(spark, 3000)
    w = W.partitionBy("symbol").orderBy(F.unix_micros("fetched_at")).rangeBetween(-reach * 1_000_000, 0)
    plain = df.select("id", F.round(F.avg("value").over(w), 6).alias("m"), F.min("value").over(w).alias("lo"), F.max("value").over(w).alias("hi"), F.count("value").over(w).alias("n"))
    mine = H.hist_range_stats(df, ["symbol"], "value", range_seconds=reach, bucket_seconds=bucket)
    mine = mine.select("id", F.round("moving_mean", 6), "moving_min", "moving_max", "n_rows")
    assert sorted(map(tuple, mine.collect())) == sorted(map(tuple, plain.collect()))


def test_range_must_be_whole_buckets(spark):
    with pytest.raises(ValueError):
        H.hist_range_stats(busy(spark, 10), ["symbol"], "value", range_seconds=100, bucket_seconds=60)


class Calls:
    """A state store that remembers what was asked of it."""

    def __init__(self, known=None):
        self.known, self.asked = known, []

    def getValueState(self, *_):
        return self

    def get(self):
        self.asked.append("get")
        return self.known

    def update(self, value):
        self.asked.append("update")
        self.known = value

    def deleteTimer(self, at):
        self.asked.append(f"delete {at}")

    def registerTimer(self, at):
        self.asked.append(f"register {at}")


def test_a_key_asks_the_store_four_times_a_batch_at_most():
    feed, store = K._Feed(["id", "row_hash"], ("at", "id"), 1000, None), Calls((5_000_000, 1, "a"))
    feed.init(store)
    rows = [Row(id=i, at_micros=at, tie_break=i, row_hash=h) for i, at, h in [(3, 9_000_000, "b"), (2, 6_000_000, "a"), (0, 5_000_000, "z"), (4, 9_000_000, "b")]]
    got = [(r.id, r.previous_hash, r.late) for r in feed.handleInputRows(("A",), iter(rows), None)]
    assert got == [(3, "a", False), (0, None, True)] and store.known == (9_000_000, 4, "b")
    assert store.asked == ["get", "update", "delete 6000", "register 10000"]
