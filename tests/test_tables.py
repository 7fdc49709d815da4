"""Stored tables: rank index, run log, interval table, sketches."""

import os

import pytest
from pyspark.sql import functions as F

from tickweave.operators import history as H
from tickweave.operators.intervals import IntervalTable
from tickweave.operators.rank_index import RankIndex
from tickweave.operators.ranking import order_keys, rank_limited
from tickweave.operators.sketches import SketchTable, error_bound
from tickweave.sources.runs import RunLog


def numbered(spark, n):
    return spark.range(n).select(F.concat(F.lit("S"), "id").alias("symbol"), F.pmod(F.xxhash64("id"), F.lit(50)).alias("v"))


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    return RankIndex.build(numbered(spark, 5003), order_keys("v", True), str(tmp_path_factory.mktemp("rank") / "i"), part_rows=500)


def test_a_page_reads_one_part_at_any_depth(spark, index):
    plain = {r.symbol: r["rank"] for r in rank_limited(numbered(spark, 5003), order_keys("v", True), None).collect()}
    for number in (1, 2, 125, 250, 251):
        page = index.page(number)
        assert sorted((r["rank"], r.symbol) for r in page.collect()) == sorted((k, s) for s, k in plain.items() if (number - 1) * 20 < k <= number * 20)
        assert {os.path.basename(os.path.dirname(f)) for f in page.inputFiles()} == {f"_part={(number - 1) * 20 // 500}"}
    assert index.page(252).count() == 0 and index.total == 5003
    assert len({os.path.dirname(f) for f in index.rows(490, 20).inputFiles()}) == 2


def test_index_walks_know_their_status(index):
    rows, facts = index.walk(max_rows=45)
    assert rows.count() == 60 and facts == {"status": "PARTIAL", "total_rows": 5003, "succeeded_units": 3}
    rows, facts = index.walk(first_page=250)
    assert rows.count() == 23 and facts["status"] == "COMPLETE"
    assert index.walk(first_page=9999)[1]["status"] == "EMPTY"
    bounds = index.bounds().orderBy("part").collect()
    assert [b.n for b in bounds] == [500] * 10 + [3] and bounds[3].low == 1501
    assert RankIndex.open(index.spark, index.folder) == index
    for bad in (lambda: index.page(0), lambda: index.walk(max_pages=0), lambda: index.rows(-1, 2)):
        with pytest.raises(ValueError):
            bad()


def test_an_empty_table_has_an_index(spark, tmp_path):
    empty = RankIndex.build(numbered(spark, 0), order_keys("v"), str(tmp_path / "e"))
    assert empty.page(1).count() == 0 and empty.total == 0


def test_deep_pages_are_not_one_task(spark):
    near = rank_limited(numbered(spark, 1000), order_keys("v"), 20)
    deep = rank_limited(numbered(spark, 1000), order_keys("v"), 20, 10_000_000)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert any(x in plan(near) for x in ("TakeOrdered", "GlobalLimit")) and not any(x in plan(deep) for x in ("TakeOrdered", "GlobalLimit"))


def captured(spark, lo, hi):
    return spark.range(lo, hi).select("id", F.concat(F.lit("S"), F.col("id") % 7).alias("symbol"), F.timestamp_seconds(1_700_000_000 + F.col("id") * 3000).alias("fetched_at"))


def ids(df):
    return sorted(r.id for r in df.collect())


def test_a_repeated_run_adds_nothing(spark, tmp_path):
    log = RunLog(spark, str(tmp_path), "d")
    assert log.read() is None and not log.compact("c0")
    assert log.append(captured(spark, 0, 50), "r1") and not log.append(captured(spark, 0, 50), "r1")
    # A crash after the files and before the entry: nobody sees them, the repetition replaces them.
    captured(spark, 50, 70).withColumn("capture_date", F.to_date("fetched_at")).write.partitionBy("capture_date").parquet(f"{log.folder}/run=r2")
    assert ids(log.read()) == list(range(50))
    assert log.append(captured(spark, 50, 90), "r2") and ids(log.read()) == list(range(90))
    assert log.compact("c1") and not log.compact("c1") and log.runs() == ["c1"] and ids(log.read()) == list(range(90))
    assert not log.append(captured(spark, 0, 50), "r1")  # replaced, and still done
    assert log.sweep() == ["r1", "r2"] and ids(log.read()) == list(range(90))
    assert log.append(captured(spark, 90, 95), "r3") and log.compact("c2") and log.runs() == ["c2"] and ids(log.read()) == list(range(95))
    with pytest.raises(ValueError):
        log.append(captured(spark, 0, 1), "../x")


def observed(spark):
    return spark.range(400).select(
        "id", F.concat(F.lit("S"), F.pmod(F.xxhash64("id"), F.lit(9))).alias("symbol"),
        F.timestamp_seconds(1_700_000_000 + F.pmod(F.xxhash64("id", F.lit(3)), F.lit(900_000))).alias("fetched_at"), (F.pmod(F.xxhash64("id", F.lit(5)), F.lit(3))).alias("v"),
    )


@pytest.mark.parametrize("batches", [1, 4])
def test_any_split_gives_the_same_intervals(spark, tmp_path, batches):
    df = observed(spark)
    table = IntervalTable(str(tmp_path), ["symbol"], ["v"], buckets=8)
    for epoch in range(batches):
        table.apply(df.where(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(batches)) == epoch), epoch)
    table.apply(df.where(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(batches)) == 0), 0)  # replayed
    pick = lambda rows: sorted((r.symbol, r.id, r.valid_from, str(r.valid_to), r.is_current) for r in rows.collect())
    assert pick(table.read(spark)) == pick(H.hist_scd2(H.hist_change_feed(df, ["symbol"], ["v"]), ["symbol"]))
    assert table.current(spark).count() == 9


def test_a_batch_rewrites_only_its_buckets(spark, tmp_path):
    df = observed(spark)
    table = IntervalTable(str(tmp_path), ["symbol"], ["v"], buckets=8)
    table.apply(df, 0)
    files = lambda: {str(p): p.stat().st_mtime_ns for p in (tmp_path / "intervals").rglob("*.parquet")}
    before = files()
    touched = table.apply(df.where("symbol = 'S3'").withColumn("id", F.col("id") + 1000).withColumn("fetched_at", F.col("fetched_at") + F.expr("interval 90 days")), 1)
    changed = {p for p in before.keys() ^ files().keys()} | {p for p, at in files().items() if before.get(p, at) != at}
    assert len(touched) == 1 and {p.split("bucket=")[1].split("/")[0] for p in changed} == {str(touched[0])}
    assert table.apply(df.where("false"), 2) == []


def test_sketches_merge_within_their_bound(spark, tmp_path):
    df = spark.range(60_000).select(
        (F.pmod(F.xxhash64("id"), F.lit(20_000))).alias("member"), F.lit("x").alias("kind"), F.timestamp_seconds(1_700_000_000 + (F.col("id") % 60) * 86400).alias("fetched_at")
    )
    table = SketchTable(str(tmp_path / "s"), ["kind"], "member")
    table.put(df)
    table.put(df.where("fetched_at < timestamp '2023-12-01'"))  # a month once more
    for unit in ("day", "week", "month", "quarter"):
        exact = {r.s: r.n for r in df.groupBy(F.date_trunc(unit, "fetched_at").cast("date").alias("s")).agg(F.countDistinct("member").alias("n")).collect()}
        rows = table.counts(spark, unit).collect()
        assert len(rows) == len(exact) and sum(r.n_rows for r in rows) == 60_000
        assert all(abs(r.estimate - exact[r.start]) <= exact[r.start] * error_bound() for r in rows)


def test_intervals_deal_their_rows_once(spark):
    """The feed's intervals from one deal of the rows; nulls and repeats as in feed and intervals after each other."""
    df = observed(spark).withColumns({
        "symbol": F.when(F.col("id") % 41 != 0, F.col("symbol")), "fetched_at": F.when(F.col("id") % 37 != 0, F.col("fetched_at")), "v": F.when(F.col("id") % 11 != 0, F.col("v")),
    })
    got = H.hist_intervals(df.unionByName(df), ["symbol"], ["v"])
    want = H.hist_scd2(H.hist_change_feed(df, ["symbol"], ["v"]), ["symbol"]).select(*got.columns)
    # Rows for either side of the join (one deal, used twice), the ends by key, and at most the ends back to their rows.
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") == 2 and plan.count("Exchange hashpartitioning(") <= 4
    pick = lambda rows: sorted(map(str, rows.collect()))
    assert pick(got) == pick(want)


def test_every_batch_makes_its_intervals_in_one_pass(spark, tmp_path, monkeypatch):
    """The stored table is made by the operator above, at every batch."""
    made = []
    monkeypatch.setattr("tickweave.operators.intervals.hist_intervals", lambda *a: made.append(H.hist_intervals(*a)) or made[-1])
    table = IntervalTable(str(tmp_path), ["symbol"], ["v"], buckets=4)
    for epoch in range(2):
        table.apply(observed(spark).where(F.col("id") % 2 == epoch), epoch)
    assert len(made) == 2 and table.read(spark).columns == ["symbol", "fetched_at", "id", "v", "row_hash", "valid_from", "valid_to", "is_current", "bucket"]
