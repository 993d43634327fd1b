"""Canned warehouse queries, reporting views and profiles.

Joins carry no broadcast hint: Spark broadcasts a side whose size it has checked
(``spark.sql.autoBroadcastJoinThreshold``) and otherwise sort-merges with skew splitting.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def _rows() -> Column:
    return F.count(F.lit(1))


def _money(column: Column) -> Column:
    return F.round(column, 2)


def market_overview(stocks: DataFrame) -> DataFrame:
    return (
        stocks.groupBy("exchange")
        .agg(
            _rows().alias("stock_count"),
            _money(F.avg("price_eur")).alias("avg_price_eur"),
            F.sum("volume").alias("total_volume"),
            F.count_if(F.col("trend") == "UP").alias("stocks_up"),
            F.count_if(F.col("trend") == "DOWN").alias("stocks_down"),
        )
        .orderBy(F.col("total_volume").desc(), "exchange")
    )


def transaction_summary(transactions: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Daily totals of the ``days`` before ``as_of`` (a date or a date column)."""
    since = F.date_sub(as_of if isinstance(as_of, Column) else F.lit(as_of), days)
    return (
        transactions.filter(F.col("tx_date") >= since)
        .groupBy("tx_date")
        .agg(
            _rows().alias("tx_count"),
            _money(F.sum("amount_eur")).alias("total_volume_eur"),
            _money(F.avg("amount_eur")).alias("avg_amount_eur"),
            F.count_if("is_cross_border").alias("cross_border_count"),
            F.count_if("requires_aml_check").alias("aml_flagged"),
        )
        .orderBy(F.col("tx_date").desc())
    )


def cross_border_flows(transactions: DataFrame, limit: int = 20) -> DataFrame:
    return (
        transactions.filter("is_cross_border")
        .groupBy("sender_country", "receiver_country")
        .agg(
            _rows().alias("tx_count"),
            _money(F.sum("amount_eur")).alias("total_volume_eur"),
            _money(F.avg("amount_eur")).alias("avg_amount_eur"),
        )
        .orderBy(F.col("total_volume_eur").desc(), "sender_country", "receiver_country")
        .limit(limit)
    )


def kpis(transactions: DataFrame, stocks: DataFrame) -> DataFrame:
    crossing = F.count_if("is_cross_border")
    payments = transactions.agg(
        _rows().alias("total_transactions"),
        _money(F.sum("amount_eur")).alias("total_volume_eur"),
        _money(F.avg("amount_eur")).alias("avg_transaction_eur"),
        crossing.alias("cross_border_count"),
        F.round(F.try_divide(crossing * 100.0, _rows()), 1).alias("cross_border_pct"),
    )
    quotes = stocks.agg(
        _rows().alias("stock_count"),
        _money(F.avg("price_eur")).alias("avg_stock_price_eur"),
        F.sum("volume").alias("total_volume"),
    )
    # both sides are global aggregates: one row each
    return payments.crossJoin(quotes)


def company_performance(financials: DataFrame) -> DataFrame:
    turnover = F.try_divide(F.col("revenue_millions"), F.col("total_assets_millions"))
    return financials.select(
        "company_name",
        "ticker",
        "sector",
        "country",
        "fiscal_year",
        "fiscal_quarter",
        "revenue_millions",
        "net_income_millions",
        "profit_margin_pct",
        "roe_pct",
        F.round(turnover, 4).alias("asset_turnover"),
    ).orderBy(F.col("revenue_millions").desc(), "ticker", "fiscal_year", "fiscal_quarter")


def forex_rates(forex: DataFrame) -> DataFrame:
    return forex.select("currency_pair", "rate", "inverse_rate", "reference_date").orderBy(
        "currency_pair", "reference_date"
    )


def transactions_by_date(fact: DataFrame, dates: DataFrame, start=None, end=None, limit: int = 30) -> DataFrame:
    if start is not None:
        dates = dates.filter(F.col("full_date") >= F.lit(start))
    if end is not None:
        dates = dates.filter(F.col("full_date") <= F.lit(end))
    # aggregate before the join: one row per day reaches the dimension
    daily = fact.groupBy("date_sk").agg(
        F.count("transaction_id").alias("tx_count"), F.sum("amount_eur").alias("total_amount_eur")
    )
    return (
        daily.join(dates, "date_sk")
        .select("full_date", "year", "quarter", "month", "is_business_day", "tx_count", "total_amount_eur")
        .orderBy(F.col("full_date").desc())
        .limit(limit)
    )


def cross_border_view(transactions: DataFrame, banks: DataFrame) -> DataFrame:
    """Payments between different countries with both banks' codes where known."""

    def side(role: str) -> DataFrame:
        return banks.select(
            F.col("bank_name").alias(f"{role}_bank"),
            F.col("bank_name").alias(f"{role}_bank_name"),
            F.col("swift_code").alias(f"{role}_swift"),
        )

    crossing = transactions.filter(F.col("sender_country") != F.col("receiver_country"))
    return crossing.join(side("sender"), "sender_bank", "left").join(side("receiver"), "receiver_bank", "left")


def enrich_lookup(df: DataFrame, lookup: DataFrame, key: str, defaults: dict[str, Column]) -> DataFrame:
    """Left lookup on ``key``; a missing attribute takes its default expression."""
    joined = df.join(lookup, key, "left")
    return joined.withColumns({name: F.coalesce(F.col(name), value) for name, value in defaults.items()})


def latest_per_key(df: DataFrame, key: str, ts: str) -> DataFrame:
    """Rows carrying the newest ``ts`` of their key, ties kept.

    Aggregate plus two-column join instead of a per-key window: the maximum is
    combined map-side, and a hot key never has to be sorted in one task.
    """
    newest = df.groupBy(key).agg(F.max(ts).alias(ts))
    return df.join(newest, [key, ts], "left_semi")


def grouped_amounts(
    df: DataFrame,
    keys: list,
    amount: str,
    names: tuple[str, str, str] = ("tx_count", "total_volume_eur", "avg_amount_eur"),
    **extra: Column,
) -> DataFrame:
    """Count, sum and mean of ``amount`` per key: the shape of the reporting views."""
    count, total, mean = names
    return df.groupBy(*keys).agg(
        _rows().alias(count),
        F.sum(amount).alias(total),
        F.avg(amount).alias(mean),
        *[column.alias(name) for name, column in extra.items()],
    )


def transaction_analytics(transactions: DataFrame) -> DataFrame:
    keys = [F.to_date("created_at").alias("date"), "transaction_type", "category", "currency"]
    crossing = F.count_if(F.col("sender_country") != F.col("receiver_country"))
    return grouped_amounts(transactions, keys, "amount_eur", cross_border_count=crossing)


def transaction_stats(transactions: DataFrame) -> DataFrame:
    keys = [F.to_date("created_at").alias("tx_date"), "transaction_type", "sender_country"]
    return grouped_amounts(
        transactions,
        keys,
        "amount_eur",
        completed_count=F.count_if(F.col("status") == "COMPLETED"),
        failed_count=F.count_if(F.col("status") == "FAILED"),
    )


def transaction_summary_view(transactions: DataFrame) -> DataFrame:
    keys = [F.to_date("created_at").alias("date"), "transaction_type", "currency"]
    names = ("num_transactions", "total_amount", "avg_amount")
    return grouped_amounts(transactions, keys, "amount", names).orderBy(
        F.col("date").desc(), "transaction_type", "currency"
    )


def daily_alerts(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy(F.to_date("timestamp").alias("date"), "alert_type").agg(
        _rows().alias("alert_count"), F.avg("value").alias("avg_value")
    )


def transaction_profile(transactions: DataFrame) -> DataFrame:
    """Totals and value counts of four attributes in one grouping-sets pass."""
    attributes = ["transaction_type", "category", "currency", "status"]
    sets = [[F.col(a)] for a in attributes] + [[]]
    crossing = F.count_if(F.col("sender_country") != F.col("receiver_country"))
    grouped = transactions.groupingSets(sets, *[F.col(a) for a in attributes]).agg(
        F.grouping_id().alias("_gid"),
        _rows().alias("tx_count"),
        _money(F.sum("amount_eur")).alias("total_volume_eur"),
        _money(F.avg("amount_eur")).alias("avg_transaction_eur"),
        F.round(F.try_divide(crossing * 100.0, _rows()), 2).alias("cross_border_pct"),
    )
    # grouping_id has one bit per attribute, set when the attribute is rolled up
    full = (1 << len(attributes)) - 1
    name, value = F.lit("all"), F.lit("all")
    for bit, attribute in zip(reversed(range(len(attributes))), attributes):
        here = F.col("_gid") == full - (1 << bit)
        name = F.when(here, attribute).otherwise(name)
        value = F.when(here, F.col(attribute)).otherwise(value)
    return grouped.select(
        name.alias("attribute"),
        value.alias("value"),
        "tx_count",
        "total_volume_eur",
        "avg_transaction_eur",
        "cross_border_pct",
    )


def sector_summary(financials: DataFrame) -> DataFrame:
    return financials.groupBy("sector").agg(
        _money(F.sum("revenue_millions")).alias("total_revenue"),
        _money(F.avg("profit_margin_pct")).alias("avg_margin"),
        _money(F.avg("roe_pct")).alias("avg_roe"),
    )


def country_volume(transactions: DataFrame) -> DataFrame:
    return (
        transactions.groupBy("sender_country")
        .agg(F.sum("amount_eur").alias("total_volume"), _rows().alias("tx_count"))
        .orderBy(F.col("total_volume").desc(), "sender_country")
    )


def flow_matrix(transactions: DataFrame, limit: int = 20) -> DataFrame:
    return (
        transactions.filter("is_cross_border")
        .groupBy("sender_country", "receiver_country")
        .agg(F.sum("amount_eur").alias("total_amount"), _rows().alias("tx_count"))
        .orderBy("sender_country", "receiver_country")
        .limit(limit)
    )


def value_shares(df: DataFrame, attributes: list[str], flag: str) -> DataFrame:
    """Long table of value counts per attribute with the share of rows where ``flag`` holds."""
    pairs = F.array(*[F.struct(F.lit(a).alias("attribute"), F.col(a).alias("value")) for a in attributes])
    return (
        df.select(F.inline(pairs), F.col(flag))
        .groupBy("attribute", "value")
        .agg(_rows().alias("row_count"), F.round(F.avg(F.col(flag).cast("int")) * 100, 2).alias("flag_pct"))
    )


def distinct_profile(df: DataFrame, column: str, low_high: str) -> DataFrame:
    """Distinct count of ``column``, and the range of ``low_high``."""
    return df.agg(
        F.count_distinct(column).alias("distinct_count"),
        F.min(low_high).alias("min_value"),
        F.max(low_high).alias("max_value"),
    )


def daily_volume(transactions: DataFrame, ts: str = "timestamp", amount: str = "amount_eur") -> DataFrame:
    return (
        transactions.groupBy(F.to_date(ts).alias("date"))
        .agg(F.sum(amount).alias("daily_volume"), _rows().alias("tx_count"))
        .orderBy("date")
    )


def layer_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counted = [df.agg(_rows().alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, df in tables.items()]
    return reduce(DataFrame.unionByName, counted)


def transaction_metrics(transactions: DataFrame, interval: str = "1 day", ts: str = "created_at") -> DataFrame:
    return transactions.groupBy(F.window(ts, interval).alias("w")).agg(
        _rows().alias("total_count"),
        F.sum("amount").alias("total_amount"),
        F.avg("amount").alias("avg_amount"),
        F.count_if(F.col("status") == "COMPLETED").alias("completed_count"),
        F.count_if(F.col("status") == "PENDING").alias("pending_count"),
        F.count_if(F.col("status") == "FAILED").alias("failed_count"),
    ).select(F.col("w.start").alias("metric_time"), "*").drop("w")


def average_change(quotes: DataFrame) -> DataFrame:
    return quotes.agg(F.avg("change_percent").alias("avg_change"))


def threshold_count(df: DataFrame, column: str = "amount", threshold: float = 50000) -> DataFrame:
    return df.agg(F.count_if(F.col(column) > threshold).alias("high_value_count"))


def count_by_label(df: DataFrame, label: str, pattern: str) -> DataFrame:
    """Rows whose label matches the whole pattern; 0, not an empty result, when none do."""
    return df.agg(F.count_if(F.col(label).rlike(f"^(?:{pattern})$")).alias("value"))


# ---- top-k and latest ---------------------------------------------------------


def top_companies(listings: DataFrame, limit: int = 30) -> DataFrame:
    return (
        listings.filter(F.col("market_cap").isNotNull())
        .select("symbol", "name", "sector", "market_cap")
        .orderBy(F.col("market_cap").desc(), "name", "symbol")
        .limit(limit)
    )


def recent_n(df: DataFrame, ts: str, tie: str, limit: int) -> DataFrame:
    return df.orderBy(F.col(ts).desc(), F.col(tie).desc()).limit(limit)


def topk_metric(df: DataFrame, key: str, metric: str, ts: str, tie: str, k: int = 10) -> DataFrame:
    """Largest ``k`` keys by their newest ``metric`` sample.

    The newest moment per key comes first, by hash aggregation; ordering whole
    ``(ts, tie)`` structs would make the aggregate sort its input.
    """
    newest = latest_per_key(df.select(key, metric, ts, tie), key, ts)
    latest = newest.groupBy(key).agg(F.max_by(metric, tie).alias(metric))
    return latest.orderBy(F.col(metric).desc(), key).limit(k)


def latest_company_summary(financials: DataFrame, ticker: str | None = None) -> DataFrame:
    """Newest filing of each company with its filing count.

    With a ``ticker`` nobody files under, the result is one row whose ``error`` says so.
    """
    rows = financials if ticker is None else financials.filter(F.col("ticker") == ticker)
    period = F.struct("fiscal_year", "fiscal_quarter")
    facts = F.struct(
        "company_name",
        "sector",
        "country",
        F.concat_ws(" ", "fiscal_year", "fiscal_quarter").alias("latest_quarter"),
        "revenue_millions",
        "net_income_millions",
        "profit_margin_pct",
    )
    latest = rows.groupBy("ticker").agg(F.max_by(facts, period).alias("f"), _rows().alias("total_records"))
    latest = latest.select("ticker", "f.*", "total_records")
    if ticker is None:
        return latest
    asked = financials.sparkSession.range(1).select(F.lit(ticker).alias("ticker"))
    missing = F.when(F.col("total_records").isNull(), F.lit(f"Company {ticker} not found"))
    return asked.join(latest, "ticker", "left").withColumn("error", missing)


def all_listings(listings: DataFrame) -> DataFrame:
    return listings.orderBy("symbol", "name")
