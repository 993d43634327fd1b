"""Null and edge behaviour of the row expressions."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgermill.functions import market, money
from ledgermill.operators import gold, silver, warehouse


def payments(spark, rows):
    schema = (
        "transaction_id string, amount double, currency string, amount_eur double, sender_id string, sender_name string, sender_country string, "
        "receiver_id string, receiver_name string, receiver_country string, transaction_type string, status string, is_cross_border boolean, "
        "created_at timestamp_ntz"
    )
    return spark.createDataFrame(rows, schema)


def payment(key, amount=100.0, currency="EUR", eur=None, status="PENDING", cross=True, sender="fr", receiver="de"):
    return (key, amount, currency, eur, "a", "A", sender, "b", "B", receiver, "PAYMENT", status, cross, datetime(2024, 5, 6, 7, 8, 9))


def test_failed_and_unknown_status_are_dropped(spark):
    frame = payments(spark, [payment("a"), payment("b", status="FAILED"), payment("c", status=None)])
    assert [r.transaction_id for r in silver.silver_transactions(frame).collect()] == ["a"]


def test_euro_amount_and_risk(spark):
    frame = payments(
        spark,
        [payment("usd", 10800.0, "USD"), payment("gbp", 860.0, "GBP"), payment("chf", 50.0, "CHF"), payment("known", 10.0, "USD", 7.0)],
    )
    rows = {r.transaction_id: r for r in silver.silver_transactions(frame).collect()}
    assert rows["usd"].amount_eur == pytest.approx(10000.0)
    assert rows["gbp"].amount_eur == pytest.approx(1000.0)
    assert rows["chf"].amount_eur == 50.0
    assert rows["known"].amount_eur == 7.0
    # graded on 10800 dollars, although that is exactly 10000 euros
    assert rows["usd"].amount_risk_level == "HIGH"
    assert rows["usd"].sender_country == "FR"
    assert rows["usd"].tx_date == datetime(2024, 5, 6) and rows["usd"].tx_hour == datetime(2024, 5, 6, 7)


def test_aml_flag_is_false_on_missing_input(spark):
    frame = payments(spark, [payment("a", 6000.0, cross=None), payment("b", None), payment("c", 6000.0), payment("d", 5000.0)])
    rows = {r.transaction_id: r.requires_aml_check for r in silver.silver_transactions(frame).collect()}
    assert rows == {"a": False, "b": False, "c": True, "d": False}


def test_conversion_modes_differ(spark):
    row = spark.range(1).select(
        money.fx_normalize(F.lit(100.0), F.lit("USD")).alias("divided"),
        money.fx_normalize(F.lit(100.0), F.lit("CHF"), "multiply").alias("multiplied"),
        money.fx_normalize(F.lit(100.0), F.lit("GBp")).alias("minor"),
    ).first()
    assert row.divided == pytest.approx(100 / 1.08)
    assert row.multiplied == pytest.approx(106.0)
    assert row.minor == 100.0
    with pytest.raises(ValueError):
        money.fx_normalize(F.lit(1.0), F.lit("USD"), "add")


def test_stream_risk_has_a_fourth_level(spark):
    levels = spark.createDataFrame([(v,) for v in (1000.0, 1000.5, 10000.5, 50000.5, None)], "v double").select(
        money.risk_level(F.col("v"), True).alias("stream"), money.risk_level(F.col("v")).alias("batch")
    )
    assert [(r.stream, r.batch) for r in levels.collect()] == [
        ("LOW", "LOW"), ("MEDIUM", "MEDIUM"), ("HIGH", "HIGH"), ("CRITICAL", "HIGH"), ("LOW", "LOW")
    ]


def test_trend_of_missing_change_is_stable(spark):
    rows = spark.createDataFrame([(1.0,), (-1.0,), (0.0,), (None,)], "c double").select(market.trend(F.col("c")).alias("t"))
    assert [r.t for r in rows.collect()] == ["UP", "DOWN", "STABLE", "STABLE"]


def test_silver_stocks_filters_and_keeps_minor_units(spark):
    frame = spark.createDataFrame(
        [("A", "a", 86.0, 80.0, 6.0, 7.5, 10, 1, "GBP", "L", "t"), ("B", "b", 86.0, 80.0, None, None, 10, 1, "gbp", "L", "t"),
         ("C", "c", 0.0, 80.0, 1.0, 1.0, 10, 1, "USD", "L", "t"), ("D", "d", None, 80.0, 1.0, 1.0, 10, 1, "USD", "L", "t")],
        "symbol string, company_name string, current_price double, previous_close double, change double, change_percent double, "
        "volume long, market_cap long, currency string, exchange string, timestamp string",
    )
    rows = {r.symbol: r for r in silver.silver_stocks(frame).collect()}
    assert set(rows) == {"A", "B"}
    assert rows["A"].price_eur == pytest.approx(100.0)
    assert rows["B"].price_eur == 86.0 and rows["B"].currency == "GBP" and rows["B"].trend == "STABLE"
    assert rows["A"]._layer == "silver"


def test_market_normalisation_leaves_euros_alone(spark):
    frame = spark.createDataFrame([("EUR", 10.0), ("USD", 10.0), ("JPY", 10.0), (None, 10.0)], "currency string, current_price double")
    assert [r.price_eur for r in silver.normalize_market(frame).collect()] == [None, 9.2, 10.0, 10.0]


def test_flags_are_null_safe(spark):
    frame = spark.createDataFrame(
        [("fr", None, 20000.0), (None, None, None), ("fr", "fr", 10000.0)], "sender_country string, receiver_country string, amount_eur double"
    )
    rows = silver.flag_transactions(frame).collect()
    assert [r.is_cross_border for r in rows] == [True, False, False]
    assert [r.aml_flag for r in rows] == ["HIGH_VALUE_REVIEW", None, None]


def test_ratios_are_zero_without_equity(spark):
    frame = spark.createDataFrame(
        [(0.0, 5.0, 10.0, 2.0, 100.0, 4.0), (50.0, 5.0, 10.0, 2.0, 100.0, 4.0)],
        "total_equity_millions double, net_income_millions double, revenue_millions double, total_debt_millions double, "
        "total_assets_millions double, shares_millions double",
    )
    first, second = silver.financial_ratios(frame).collect()
    assert (first.roe_pct, first.debt_to_equity) == (0.0, 0.0)
    assert (second.roe_pct, second.eps, second.profit_margin_pct, second.total_liabilities_millions) == (10.0, 1.25, 50.0, 50.0)


def test_margins_are_clamped_and_nulls_filled(spark):
    frame = spark.createDataFrame([(150.0, None), (-150.0, 1.0), (None, 2.0)], "profit_margin_pct double, roe_pct double")
    rows = silver.validate_financials(frame, ["profit_margin_pct", "roe_pct"]).collect()
    assert [(r.profit_margin_pct, r.roe_pct) for r in rows] == [(100.0, 0.0), (-100.0, 1.0), (0.0, 2.0)]


def test_default_calendar(spark):
    calendar = gold.dim_date(gold.date_bounds(spark))
    assert calendar.count() == 1096
    sunday = calendar.filter(F.col("full_date") == date(2024, 1, 7)).first()
    assert (sunday.date_sk, sunday.day_of_week, sunday.is_business_day) == (20240107, 0, False)


def test_latest_per_key_keeps_ties(spark):
    frame = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("a", 2, 3), ("b", 1, 4)], "k string, ts int, id int")
    assert sorted(r.id for r in warehouse.latest_per_key(frame, "k", "ts").collect()) == [2, 3, 4]


def test_kpis_of_empty_tables(spark):
    empty = payments(spark, []).select("amount_eur", "is_cross_border")
    stocks = spark.createDataFrame([], "price_eur double, volume long")
    row = warehouse.kpis(empty, stocks).first()
    assert (row.total_transactions, row.cross_border_pct, row.stock_count) == (0, None, 0)


def test_label_count_is_zero_not_empty(spark):
    frame = spark.createDataFrame([("PRICE_SPIKE",), ("PRICE_SPIKE_X",)], "t string")
    assert warehouse.count_by_label(frame, "t", "PRICE_SPIKE").first().value == 1
    assert warehouse.count_by_label(frame.filter("false"), "t", "PRICE_SPIKE").first().value == 0
