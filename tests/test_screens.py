"""Typed queries, ranks and limits."""

import pytest
from pyspark.sql import functions as F

from bindings.scalars import driver_query
from tickweave.operators import ranking as K
from tickweave.operators import screening as S
from tickweave.plans import api as A
from tickweave.plans import registry as R
from tickweave.plans.query import Filter, GroupQuery, Order, ScreenQuery


def snapshot(spark, n=95):
    return spark.range(n).select(
        F.concat(F.lit("S"), "id").alias("symbol"),
        F.when(F.col("id") % 3 == 0, "A").otherwise("B").alias("sector"),
        (F.col("id") % 7).cast("double").alias("price"),
    )


def test_filters_are_order_free_and_any_is_dropped():
    a = ScreenQuery(filters=(Filter("Sector", "A"), Filter("P/E", "Under 5"), Filter("Country", "Any")))
    b = ScreenQuery(filters=[Filter("P/E", "Under 5"), Filter("Sector", "A")])
    assert a.hash() == b.hash() and len(a.filters) == 2
    assert ScreenQuery.from_json(a.to_json()).hash() == a.hash()
    assert len(a.hash()) == 16


@pytest.mark.parametrize(
    "build",
    [
        lambda: Filter("Nope", "x"),
        lambda: Filter("P/E", "cheap"),
        lambda: Filter("Earnings Date", "This Year"),
        lambda: ScreenQuery(view="nope"),
        lambda: ScreenQuery(view="custom"),
        lambda: ScreenQuery(columns=("Price",)),
        lambda: ScreenQuery(view="custom", columns=("Price", "Price")),
        lambda: ScreenQuery(view="custom", columns=("Nope",)),
        lambda: ScreenQuery(signal="Top Gainers"),
        lambda: ScreenQuery(filters=(Filter("Sector", "A"), Filter("Sector", "B"))),
        lambda: ScreenQuery(ticker="lower case"),
        lambda: ScreenQuery(page=0),
        lambda: ScreenQuery(page=True),
        lambda: Order("Nope"),
        lambda: GroupQuery("Sector", sector="Energy"),
        lambda: GroupQuery(view="custom"),
        lambda: GroupQuery(order="Nope"),
        lambda: S.date_bounds("Someday", F.current_date()),
        lambda: S.earnings_window("This Week", F.current_date(), session="Before Market Open"),
    ],
)
def test_bad_queries_are_refused_before_any_plan(spark, build):
    with pytest.raises(R.QueryError):
        build()


def test_row_hash_form_equals_driver_hash(spark):
    import __spark_entry__ as entry

    for r in entry.queries()["hash_query"](spark, "/root/testdata/sf0.001").collect():
        assert r.query_hash == driver_query(r.sector).hash()


@pytest.mark.parametrize(
    ("limits", "rows", "status"),
    [
        ({}, 95, "COMPLETE"),
        ({"max_rows": 45}, 60, "PARTIAL"),
        ({"max_rows": 81}, 95, "COMPLETE"),
        ({"max_pages": 2}, 40, "PARTIAL"),
        ({"max_pages": 5}, 95, "COMPLETE"),
        ({"first_page": 4, "max_pages": 1}, 20, "PARTIAL"),
        ({"first_page": 9}, 0, "EMPTY"),
    ],
)
def test_walks_stop_on_whole_pages(spark, limits, rows, status):
    data, facts = K.walk_limits(snapshot(spark), K.order_keys("price", True), **limits)
    assert data.count() == rows
    f = facts.first()
    assert f.status == status
    assert f.requested_units == f.succeeded_units + f.failed_units


def test_rank_of_every_row_equals_the_window(spark):
    df = snapshot(spark, 5000)
    keys = K.order_keys("price", True)
    got = {(r.symbol, r.rank) for r in K.global_rank(df, keys).collect()}
    ordered = sorted(df.collect(), key=lambda r: (-r.price, r.symbol))
    assert got == {(r.symbol, i + 1) for i, r in enumerate(ordered)}


def test_deep_pages_may_take_the_full_rank(spark):
    df, keys = snapshot(spark), K.order_keys("price", True)
    assert sorted(K.page(df, keys, 3, full=True).collect()) == sorted(K.page(df, keys, 3).collect())


def test_nothing_stops_a_walk_by_itself(spark):
    for n in (6_000, 21_000):
        data, facts = K.walk_limits(snapshot(spark, n), K.order_keys("price", True))
        assert data.count() == n and data.agg(F.max("rank")).first()[0] == n
        assert facts.first().status == "COMPLETE" and facts.first().requested_units == n // 20
    with pytest.raises(ValueError, match="positive"):
        K.walk_limits(snapshot(spark), K.order_keys("price"), max_rows=0)


def test_rank_in_group_with_a_hot_group(spark):
    df = snapshot(spark, 3000).withColumn("sector", F.when(F.col("price") < 6, "hot").otherwise("cold"))
    got = {(r.sector, r.symbol, r.rank) for r in K.rank_in_group(df, ["sector"], K.order_keys("price", True), 4).collect()}
    want = set()
    rows = df.collect()
    for g in ("hot", "cold"):
        best = sorted((r for r in rows if r.sector == g), key=lambda r: (-r.price, r.symbol))[:4]
        want |= {(g, r.symbol, i + 1) for i, r in enumerate(best)}
    assert got == want


def test_signals_need_their_ingredients(spark):
    with pytest.raises(R.QueryError, match="needs the columns"):
        A.signal(snapshot(spark), "Top Gainers")
    with pytest.raises(R.QueryError, match="unknown signal"):
        S.signal_rows(snapshot(spark), "Wedge Up")


def test_search_input_is_bounded(spark):
    df = snapshot(spark).withColumn("company", F.lit("Co"))
    for bad in ("", "  ", "x" * 65):
        with pytest.raises(R.QueryError):
            S.symbol_search(df, bad)
    assert S.symbol_search(df, "s1").first().symbol == "S1"


def test_registry_vocabulary():
    assert len(R.GROUP_ORDERS) == 42 and len(R.GROUP_COLUMNS) == 30 and len(R.INSIDER_FEEDS) == 9
    codes = [c for c, _, _ in R.JSON_FIELDS]
    assert len(set(codes)) == len(codes)
