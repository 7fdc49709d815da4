"""Sitemaps by record, VARIANT pages, signals from events."""

import pytest
from pyspark.sql import functions as F

from tickweave.operators import event_signals as E
from tickweave.plans import families as P
from tickweave.sources import sitemaps as M
from tickweave.sources import variant as V


def test_one_sitemap_is_many_tasks_in_file_order(spark, tmp_path):
    body = ['<?xml version="1.0"?>\n<urlset xmlns="http://x">']
    for i in range(3000):
        body.append(f"\n<url>\n  <loc> https://h.example/stock?t=S{i % 1500} </loc>\n  <priority>0.{i % 10}</priority>\n</url>")
    body.insert(1200, "<url><loc>cut</url>")
    body.insert(10, "<url><lastmod>2001-01-01</lastmod></url>")
    (tmp_path / "s.xml").write_text("".join(body) + "\n</urlset>\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        rows, bad = M.sitemap_records(spark, str(tmp_path))
        assert rows.rdd.getNumPartitions() >= 8
        read = rows.orderBy(*M.PLACE).collect()
        assert [r.loc for r in read] == [f"https://h.example/stock?t=S{i % 1500}" for i in range(3000)] and read[7].priority == pytest.approx(0.7)
        assert sorted(b.problem[:12] for b in bad.collect()) == ["<url><lastmo", "<url><loc>cu"]
        first, other = M.sitemap_symbols(rows, "h.example")
        assert [r.symbol for r in first.orderBy(*M.PLACE).collect()] == [f"S{i}" for i in range(1500)] and other.count() == 0
        assert M.sitemap_symbols(rows, "other.example")[1].count() == 3000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_variants_keep_types_and_text(spark):
    text = '{"initialFundDetailsData": {"name": 5, "holdings": {"a": 1, "b": [2], "c": "3.5", "d": true}}, "initialFundReportDates": ["2001-03-31", "x"]}'
    docs = P.documents(spark.createDataFrame([(1, f"<script>{text}</script>"), (2, "<script>{}</script>"), (3, "<script>{broken</script>")], "capture_id long, body string"))
    pages = V.disclosures(docs, "fund")
    page = pages.withColumn("name", V.typed(F.col("page"), "$.name", "string")).withColumn("none", V.typed(F.col("page"), "$.holdings", "string")).collect()
    assert [(p.capture_id, p.source, p.name, p.none, [str(d) for d in p.report_dates]) for p in page] == [(1, text, "5", None, ["2001-03-31"])]
    items = V.exploded(pages, "page", "$.holdings", ["capture_id"])
    got = items.select("key", V.kind_of(F.col("item")).alias("k"), V.typed(F.col("item"), "$", "double").alias("v")).collect()
    assert sorted((r.key, r.k, r.v) for r in got) == [("a", "number", 1.0), ("b", "list", None), ("c", "text", 3.5), ("d", "boolean", 1.0)]
    assert V.exploded(pages, "page", "$.name", ["capture_id"]).count() == 0


@pytest.fixture
def snapshot(spark):
    return spark.createDataFrame([("A", "2024-03-10 12:00:00"), ("B", "2024-03-10 12:00:00"), ("C", "2024-01-01 00:00:00")], "symbol string, at string").select("symbol", F.to_timestamp("at").alias("fetched_at"))


def rated(spark, *rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, symbol string, desk string, rating string, at string")
    ratings = df.withColumn("published_at", F.to_timestamp("at"))
    levels = F.create_map(*[F.lit(x) for pair in {"Sell": 1, "Hold": 2, "Buy": 3}.items() for x in pair])
    return E.rating_changes(ratings, F.try_element_at(levels, F.col("rating")), ["desk"])


def test_rating_changes_are_a_desks_own(spark, snapshot):
    changes = rated(
        spark, ("A", "x", "Hold", "2024-02-01 00:00:00"), ("A", "y", "Buy", "2024-02-02 00:00:00"), ("A", "x", "unknown", "2024-02-20 00:00:00"), ("A", "x", "Buy", "2024-03-01 00:00:00"),
        ("A", "y", "Buy", "2024-03-02 00:00:00"), ("B", "x", "Buy", "2024-01-01 00:00:00"), ("B", "x", "Sell", "2024-03-09 00:00:00"), ("C", "x", "Sell", "2023-12-01 00:00:00"), ("C", "x", "Buy", "2024-03-01 00:00:00"),
    )
    assert sorted((c.symbol, c.desk, c.step) for c in changes.collect()) == [("A", "x", 1), ("B", "x", -2), ("C", "x", 2)]
    assert [(r.symbol, r.upgrades, r["rank"]) for r in E.event_signal("Upgrades", snapshot, changes).collect()] == [("A", 1, 1)]  # C's came after its snapshot
    assert [r.symbol for r in E.event_signal("Downgrades", snapshot, changes).collect()] == ["B"]
    assert E.event_signal("Upgrades", snapshot, changes, days=5).count() == 0


def test_dealings_and_news_of_the_window(spark, snapshot):
    deals = spark.createDataFrame(
        [("A", "2024-03-01 00:00:00", "buy", 10), ("A", "2024-03-02 00:00:00", "sell", 4), ("A", "2023-03-02 00:00:00", "sell", 400), ("B", "2024-03-10 00:00:00", "sell", 4), ("B", "2024-03-01 00:00:00", "gift", 9)],
        "symbol string, at string, side string, value long",
    ).withColumn("transaction_date", F.to_timestamp("at"))
    assert [(r.symbol, r.net_value) for r in E.event_signal("Recent Insider Buying", snapshot, deals).collect()] == [("A", 6)]
    assert [(r.symbol, r.net_value) for r in E.event_signal("Recent Insider Selling", snapshot, deals).collect()] == [("B", -4)]
    news = deals.withColumnRenamed("transaction_date", "published_at")
    assert [(r.symbol, r.stories) for r in E.event_signal("Major News", snapshot, news, least=2).orderBy("rank").collect()] == [("A", 2), ("B", 2)]
    for bad in ({"name": "Wedge"}, {"name": "Upgrades", "days": 0}):
        with pytest.raises(ValueError):
            E.event_signal(**({"snapshot": snapshot, "events": news} | bad))
