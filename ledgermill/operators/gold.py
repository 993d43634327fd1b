"""Gold aggregates and the star schema."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions import market
from ledgermill.operators.ordered import dense_index


def daily_market(stocks: DataFrame) -> DataFrame:
    return stocks.groupBy(market.day_of(F.col("timestamp")).alias("market_date"), "exchange", "currency").agg(
        F.count(F.lit(1)).alias("quote_count"),
        F.avg("price").alias("avg_price"),
        F.avg("price_eur").alias("avg_price_eur"),
        F.sum("volume").alias("total_volume"),
        F.count_if(F.col("trend") == "UP").alias("stocks_up"),
        F.count_if(F.col("trend") == "DOWN").alias("stocks_down"),
    )


def tx_summary(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy(
        "tx_date", "sender_country", "receiver_country", "transaction_type", "is_cross_border"
    ).agg(
        F.count(F.lit(1)).alias("tx_count"),
        F.sum("amount_eur").alias("total_volume_eur"),
        F.avg("amount_eur").alias("avg_amount_eur"),
        F.count_if("requires_aml_check").alias("aml_flagged"),
    )


def date_key(day) -> Column:
    """yyyyMMdd as an integer, by arithmetic: no text is formatted per row."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.day(day)


def date_columns(day) -> dict:
    """Calendar attributes of a date column; Sunday is day 0."""
    weekday = F.dayofweek(day) - 1
    return {
        "date_sk": date_key(day),
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "day": F.day(day),
        "day_of_week": weekday,
        "week_of_year": F.weekofyear(day),
        "is_business_day": ~weekday.isin(0, 6),
    }


def dim_date(bounds: DataFrame) -> DataFrame:
    """One row per day between the ``start`` and ``end`` dates of the one-row ``bounds``."""
    days = bounds.select(F.explode(F.sequence("start", "end", F.expr("interval 1 day"))).alias("full_date"))
    return days.withColumns(date_columns(F.col("full_date")))


def date_bounds(spark, start: date = date(2024, 1, 1), end: date = date(2026, 12, 31)) -> DataFrame:
    return spark.range(1).select(F.lit(start).alias("start"), F.lit(end).alias("end"))


def covering_years(df: DataFrame, ts: str) -> DataFrame:
    """Bounds of the whole calendar years that contain every ``ts``."""
    span = df.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi"))
    return span.select(
        F.make_date(F.year("lo"), F.lit(1), F.lit(1)).alias("start"),
        F.make_date(F.year("hi"), F.lit(12), F.lit(31)).alias("end"),
    )


def dim_company(listings: DataFrame, index: str = "sp500") -> DataFrame:
    """Initial load of a type-2 company dimension, keyed by symbol order."""
    members = (
        listings.filter((F.col("_csv_source") == index) & F.col("symbol").isNotNull())
        .select("symbol", "name", "sector")
        .distinct()
    )
    keyed = dense_index(members, ["symbol", "name", "sector"], "company_sk", start=1)
    return keyed.select(
        "company_sk",
        F.col("symbol").alias("company_id"),
        F.col("name").alias("company_name"),
        "sector",
        F.lit("US").alias("country"),
        F.current_date().alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def dim_currency_history(forex: DataFrame) -> DataFrame:
    """Every rate row with a surrogate key, plus the base currency as key 0."""
    keyed = dense_index(
        forex.select("target_currency", "reference_date", "rate"),
        ["target_currency", "reference_date", "rate"],
        "currency_sk",
        start=1,
    ).select(
        F.col("currency_sk").cast("long").alias("currency_sk"),
        F.col("target_currency").alias("currency_code"),
        F.col("rate").alias("latest_rate_vs_eur"),
        F.col("reference_date").alias("rate_date"),
    )
    euro = forex.sparkSession.range(1).select(
        F.lit(0).cast("long").alias("currency_sk"),
        F.lit("EUR").alias("currency_code"),
        F.lit(1.0).alias("latest_rate_vs_eur"),
        F.current_date().alias("rate_date"),
    )
    return keyed.unionByName(euro)


def dim_currency_latest(forex: DataFrame) -> DataFrame:
    return forex.groupBy(F.col("target_currency").alias("currency_code")).agg(
        F.max_by("rate", "reference_date").alias("latest_rate_vs_eur"),
        F.max("reference_date").alias("rate_date"),
    )


def fact_transactions(transactions: DataFrame) -> DataFrame:
    return transactions.select(
        "transaction_id",
        date_key("tx_date").alias("date_sk"),
        "sender_country",
        "receiver_country",
        "transaction_type",
        "currency",
        "amount",
        "amount_eur",
        "is_cross_border",
        "amount_risk_level",
        "requires_aml_check",
        "status",
    )
