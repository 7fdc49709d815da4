"""History operators against brute force, with a hot key; streams in many batches."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tickweave.operators import history as H
from tickweave.streaming import sinks as S
from tickweave.streaming import windows as W

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def data():
    """Half of all rows belong to one symbol; gaps skip whole days; equal instants occur."""
    rng = random.Random(11)
    rows = []
    for i in range(1200):
        symbol = "HOT" if rng.random() < 0.5 else f"S{rng.randrange(9)}"
        at = T0 + dt.timedelta(hours=rng.randrange(24 * 40) if rng.random() < 0.7 else rng.randrange(24))
        rows.append((i, symbol, rng.choice([1.0, 2.0, None]), at))
    return rows


@pytest.fixture
def df(spark, data):
    return spark.createDataFrame(data, "id int, symbol string, value double, fetched_at timestamp")


def by_key(data):
    out = {}
    for row in sorted(data, key=lambda r: (r[3], r[0])):
        out.setdefault(row[1], []).append(row)
    return out


def test_change_feed_and_intervals(df, data):
    feed = H.hist_change_feed(df, ["symbol"], ["value"])
    want_feed, want_intervals = set(), set()
    for rows in by_key(data).values():
        kept = [r for i, r in enumerate(rows) if i == 0 or rows[i - 1][2] != r[2]]
        want_feed |= {r[0] for r in kept}
        for a, b in zip(kept, [*kept[1:], None], strict=True):
            want_intervals.add((a[0], a[3], b[3] if b else None, b is None))
    assert {r.id for r in feed.collect()} == want_feed
    got = H.hist_scd2(feed, ["symbol"])
    assert {(r.id, r.valid_from, r.valid_to, r.is_current) for r in got.collect()} == want_intervals


def test_revisions(df, data):
    want = []
    for rows in by_key(data).values():
        want += [(b[3], a[2], b[2]) for a, b in zip(rows, rows[1:], strict=False) if a[2] != b[2]]
    got = [(r.fetched_at, r.old_value, r.new_value) for r in H.hist_revisions(df, ["symbol"], "value").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_asof_join(df, spark, data):
    left = df.where("id % 5 = 0").select("symbol", "id", F.col("fetched_at").alias("at"))
    right = df.where("id % 5 <> 0 and value is not null")
    got = H.asof_join(left, right, ["symbol"], "at", "fetched_at", ["value", "id"], "id")
    found = {r.id: (r.asof_id, r.asof_value) for r in got.select("id", "asof_id", "asof_value").collect()}
    keyed = by_key([r for r in data if r[0] % 5 and r[2] is not None])
    for row in (r for r in data if r[0] % 5 == 0):
        earlier = [r for r in keyed.get(row[1], []) if r[3] <= row[3]]
        assert found[row[0]] == ((earlier[-1][0], earlier[-1][2]) if earlier else (None, None))


@pytest.mark.parametrize("rows", [1, 3, 7])
def test_moving_stats(df, data, rows):
    got = {r.id: (r.moving_min, r.moving_max, r.n_rows) for r in H.hist_window_stats(df, ["symbol"], "value", rows=rows).collect()}
    for group in by_key(data).values():
        for i, row in enumerate(group):
            seen = [r[2] for r in group[max(0, i - rows) : i + 1] if r[2] is not None]
            assert got[row[0]] == (min(seen, default=None), max(seen, default=None), len(seen))


def test_current_and_asof_state(df, data):
    at = T0 + dt.timedelta(days=10)
    current = {r.symbol: r.id for r in H.hist_current(df, ["symbol"]).collect()}
    assert current == {s: rows[-1][0] for s, rows in by_key(data).items()}
    state = {r.symbol: r.id for r in H.hist_asof(df, ["symbol"], F.lit(at)).collect()}
    assert state == {s: rows[-1][0] for s, rows in by_key([r for r in data if r[3] <= at]).items()}


def test_membership(spark):
    rows = [("g", 1, "A"), ("g", 1, "B"), ("g", 3, "B"), ("g", 3, "C"), ("g", 7, "C"), ("h", 1, "A")]
    df = spark.createDataFrame(rows, "grp string, run int, symbol string")
    got = {(r.run, r.symbol, r.transition) for r in H.hist_membership(df, ["grp"], "run").collect()}
    assert got == {(3, "A", "exit"), (3, "B", "stay"), (3, "C", "enter"), (7, "B", "exit"), (7, "C", "stay")}


def batches(spark, tmp_path, rows, size):
    """Files in arrival order, read as a stream one file per micro-batch."""
    folder = tmp_path / "in"
    for i in range(0, len(rows), size):
        part = spark.createDataFrame(rows[i : i + size], "id int, symbol string, value double, fetched_at timestamp")
        part.coalesce(1).write.mode("append").parquet(str(folder))
    return spark.readStream.schema("id int, symbol string, value double, fetched_at timestamp").option("maxFilesPerTrigger", 1).parquet(str(folder))


def test_streaming_change_feed_equals_batch(spark, tmp_path, df, data):
    ordered = sorted(data, key=lambda r: (r[3], r[0]))
    sink = S.ChangeFeed(str(tmp_path / "out"), ["symbol"], ["value"])
    S.run_available(batches(spark, tmp_path, ordered, 300), sink, str(tmp_path / "ckpt"))
    assert {r.id for r in sink.read(spark).collect()} == {r.id for r in H.hist_change_feed(df, ["symbol"], ["value"]).collect()}
    assert sink.read(spark, "late").count() == 0


def test_streaming_change_feed_is_the_same_when_an_epoch_is_replayed(spark, tmp_path, data):
    ordered = sorted(data, key=lambda r: (r[3], r[0]))
    sink = S.ChangeFeed(str(tmp_path / "out"), ["symbol"], ["value"])
    for epoch, i in enumerate(range(0, 1200, 400)):
        part = spark.createDataFrame(ordered[i : i + 400], "id int, symbol string, value double, fetched_at timestamp")
        sink(part, epoch)
        before = sorted(r.id for r in sink.read(spark).collect())
        sink(part, epoch)
        assert sorted(r.id for r in sink.read(spark).collect()) == before


def test_state_is_compacted_and_old_epochs_go(spark, tmp_path, df, data):
    ordered = sorted(data, key=lambda r: (r[3], r[0]))
    sink = S.ChangeFeed(str(tmp_path / "out"), ["symbol"], ["value"], buckets=4, full_every=2)
    for epoch, i in enumerate(range(0, 1200, 150)):
        sink(spark.createDataFrame(ordered[i : i + 150], "id int, symbol string, value double, fetched_at timestamp"), epoch)
    assert {r.id for r in sink.read(spark).collect()} == {r.id for r in H.hist_change_feed(df, ["symbol"], ["value"]).collect()}
    assert sorted(p.name for p in (tmp_path / "out" / "state").glob("epoch=*")) == [f"epoch={e}" for e in range(4, 8)]


def test_a_lost_state_stops_the_stream(spark, tmp_path, data):
    sink = S.ChangeFeed(str(tmp_path / "out"), ["symbol"], ["value"])
    part = spark.createDataFrame(data[:50], "id int, symbol string, value double, fetched_at timestamp")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        sink(part, 3)


def test_late_rows_are_diverted_never_lost(spark, tmp_path):
    on_time = [(1, "A", 1.0, T0 + dt.timedelta(hours=10))]
    mixed = [(2, "A", 1.0, T0 + dt.timedelta(hours=9, minutes=30)), (3, "A", 1.0, T0), (4, "A", 1.0, T0 + dt.timedelta(hours=12))]
    sink = S.LateRows(str(tmp_path / "out"), "1 hour")
    for epoch, rows in enumerate((on_time, mixed)):
        sink(spark.createDataFrame(rows, "id int, symbol string, value double, fetched_at timestamp"), epoch)
    assert {(r.id, r.late) for r in sink.read(spark).collect()} == {(1, False), (2, False), (3, True), (4, False)}


def test_streaming_dedupe(spark, tmp_path, data):
    ordered = sorted(data, key=lambda r: (r[3], r[0]))
    stream = W.st_dedupe(batches(spark, tmp_path, ordered, 400), ["id"], lateness="60 days")
    query = stream.writeStream.format("memory").queryName("deduped").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("deduped").count() == 1200
