"""Schema contracts and the dataset builder."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickweave import schemas as S
from tickweave.operators import dataset as D
from tickweave.operators import quality as Q
from tickweave.operators import relations as L

AT = dt.datetime(2026, 8, 27, 18, 0)


def rows(spark, data, ddl):
    return spark.createDataFrame(data, ddl).withColumn("fetched_at", F.lit("2026-08-27 18:00:00").cast("timestamp"))


def test_fifteen_datasets_with_versions():
    assert len(S.dataset_names()) == 15
    versions = {n: S.dataset(n).version for n in S.dataset_names()}
    assert versions.pop("quote_etf_holders") == 2
    assert set(versions.values()) == {1}


@pytest.mark.parametrize("name", S.dataset_names())
def test_empty_complete_and_partial_share_a_schema(spark, name):
    empty = S.empty_typed(spark, name)
    assert S.dq_contract(empty, name) == []
    required = [f for f in S.dataset(name).source_fields if not f.nullable]
    data = [tuple("7" if f.unit == "count" else "x" for f in required)]
    built = D.build_dataset(rows(spark, data, ", ".join(f"{f.name} string" for f in required)), name)
    assert S.dq_contract(built, name) == []
    assert L.concat_strict([built, empty]).count() == 1
    assert all(v == 0 for v in S.dq_contract_nulls(built, name).first())


def test_invariants_reject_bad_datasets():
    base = [S.Field("symbol", "text", False, True), S.Field("extra_fields", "map"), S.Field("fetched_at", "timestamp", False)]
    S.check_dataset(S.Dataset("ok", 1, tuple(base)))
    for bad in (
        [S.Field("symbol", "text", True, True), *base[1:]],
        base[:2],
        [*base, S.Field("price", "number", raw=True)],
        [*base, S.Field("price_raw", "raw")],
        [*base, S.Field("x", "odd")],
        [*base, S.Field("symbol", "text")],
    ):
        with pytest.raises(S.ContractError):
            S.check_dataset(S.Dataset("bad", 1, tuple(bad)))


def test_conversion_keeps_raw_and_warns(spark):
    df = rows(spark, [("NA", "1.2B", "bad"), ("B", "-", "3.5%")], "symbol string, market_cap string, div_yield string")
    a, b = D.build_dataset(df, "symbol_search", with_warnings=True).orderBy(F.col("symbol").desc()).collect()
    assert (a.symbol, a.market_cap, a.div_yield, a.div_yield_raw) == ("NA", 1.2e9, None, "bad")
    assert [(w.code, w.field) for w in a.warnings] == [("conversion_failed", "div_yield")]
    assert (b.market_cap, b.market_cap_raw, b.div_yield) == (None, "-", 0.035)
    assert [(w.code, w.field) for w in b.warnings] == [("null_sentinel", "market_cap")]


def test_unknown_fields_are_name_sorted(spark):
    df = rows(spark, [("A", "1", None, "2")], "symbol string, zeta string, beta string, alpha string")
    built = D.build_dataset(df, "symbol_universe", with_warnings=True)
    row = built.select("*", F.to_json("extra_fields").alias("bag")).first()
    assert row.bag == '{"alpha":"2","beta":"","zeta":"1"}'
    assert [w.field for w in row.warnings] == ["alpha", "beta", "zeta"]


def test_ambiguous_time_keeps_only_the_status(spark):
    df = rows(spark, [("A", "2026-11-01 01:30", "t", "u")], "symbol string, published_at string, title string, url string")
    row = D.build_dataset(df, "quote_news", with_warnings=True).first()
    assert (row.published_at, row.published_at_raw, row.published_at_status) == (None, "2026-11-01 01:30", "ambiguous")
    assert [w.code for w in row.warnings] == ["ambiguous_time"]


def test_display_override(spark):
    df = rows(spark, [("A", "2026-08-05", "Aug 5, 2026")], "symbol string, ipo_date string, ipo_date__display string")
    row = D.build_dataset(df, "quote_snapshot").first()
    assert (row.ipo_date, row.ipo_date_raw) == (dt.date(2026, 8, 5), "Aug 5, 2026")


@pytest.mark.parametrize(
    ("ddl", "name"),
    [
        ("symbol string, market_cap_raw string", "symbol_search"),
        ("symbol string, extra_fields string", "symbol_search"),
        ("company string", "symbol_search"),
        ("symbol string, company__display string", "symbol_search"),
        ("symbol string", "no_such_dataset"),
    ],
)
def test_derived_and_missing_fields_are_refused(spark, ddl, name):
    with pytest.raises(S.ContractError):
        D.build_dataset(rows(spark, [("x",) * len(ddl.split(","))], ddl), name)


def test_required_null_raises_and_can_be_quarantined(spark):
    df = rows(spark, [("A", "Sig"), ("-", "Sig"), ("C", None)], "symbol string, signal string")
    with pytest.raises(Exception, match="required value is null"):
        D.build_dataset(df, "quote_signals").collect()
    good, bad = D.split_required(df, "quote_signals")
    assert D.build_dataset(good, "quote_signals").count() == 1
    assert sorted(r.missing_fields[0] for r in bad.collect()) == ["signal", "symbol"]


def test_strict_modes_raise_on_drift_but_not_on_missing_data(spark):
    fine = rows(spark, [("A", "-")], "symbol string, market_cap string")
    assert Q.dq_strict(D.build_dataset(fine, "symbol_search", with_warnings=True)).count() == 1
    bad = rows(spark, [("A", "bad")], "symbol string, market_cap string")
    with pytest.raises(Exception, match="strict schema"):
        Q.dq_strict(D.build_dataset(bad, "symbol_search", with_warnings=True)).collect()
    with pytest.raises(Exception, match="cannot convert"):
        D.build_dataset(bad, "symbol_search", on_error="raise").collect()


def test_concat_refuses_drift(spark):
    a, b = spark.range(1), spark.range(1).select(F.col("id").cast("int"))
    with pytest.raises(S.ContractError):
        L.concat_strict([a, b])


def test_progress_is_observed_in_the_same_pass(spark):
    df = rows(spark, [("A", "bad"), ("B", "-"), ("C", "1")], "symbol string, market_cap string")
    watched, seen = Q.observed(D.build_dataset(df, "symbol_search", with_warnings=True))
    watched.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 3, "warnings": 2}
