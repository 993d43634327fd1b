"""Projections: staging to silver and row-level enrichment."""

from pyspark.sql import functions as F

from ledgermill.catalog.registry import query
from ledgermill.functions import market, money
from ledgermill.operators import silver
from ledgermill.plans.layers import rounded
from ledgermill.plans.oracle import view


def _euro(value):
    """Units of a currency per euro; a currency that is not listed passes through."""
    return f"CASE currency WHEN 'USD' THEN {value} / 1.08e0 WHEN 'GBP' THEN {value} / 0.86e0 ELSE {value} END"


view(
    "silver_stocks",
    f"""SELECT ts AS "timestamp", symbol, company_name, exchange, upper(currency) AS currency, current_price > 0 AS is_valid_price,
    CASE WHEN change_percent > 0 THEN 'UP' WHEN change_percent < 0 THEN 'DOWN' ELSE 'STABLE' END AS trend, current_price AS price,
    {_euro('current_price')} AS price_eur, previous_close, change AS price_change, change_percent AS change_pct, volume, market_cap
    FROM quotes WHERE current_price > 0""",
)
view(
    "silver_forex",
    """SELECT base_currency, target_currency, rate, reference_date, CAST(1 AS DOUBLE) / rate AS inverse_rate,
    concat(base_currency, '/', target_currency) AS currency_pair FROM forex WHERE rate > 0""",
)
view("silver_financials", "SELECT * FROM listings")
view(
    "silver_transactions",
    f"""SELECT transaction_id, created_at AS "timestamp", date_trunc('day', created_at) AS tx_date, date_trunc('hour', created_at) AS tx_hour,
    transaction_type, status, is_cross_border, coalesce(is_cross_border AND amount > 5000, FALSE) AS requires_aml_check,
    sender_id, sender_name, upper(sender_country) AS sender_country, receiver_id, receiver_name, upper(receiver_country) AS receiver_country,
    currency, amount, coalesce(amount_eur, {_euro('amount')}) AS amount_eur,
    CASE WHEN amount > 10000 THEN 'HIGH' WHEN amount > 1000 THEN 'MEDIUM' ELSE 'LOW' END AS amount_risk_level
    FROM transactions WHERE status <> 'FAILED'""",
)


@query(
    "prj_01_silver_stocks",
    """SELECT * REPLACE (round(price, 4) AS price, round(previous_close, 4) AS previous_close, round(price_change, 4) AS price_change,
    round(change_pct, 4) AS change_pct, round(price_eur, 4) AS price_eur) FROM silver_stocks""",
)
def _(d):
    return rounded(d.silver_stocks)


@query(
    "prj_02_silver_forex",
    "SELECT * REPLACE (round(rate, 4) AS rate, round(inverse_rate, 4) AS inverse_rate) FROM silver_forex",
)
def _(d):
    return rounded(d.silver_forex)


@query("prj_03_silver_financials", "SELECT *, 'silver' AS _layer FROM listings")
def _(d):
    return silver.silver_financials(d.listings).drop("_transformed_at")


@query(
    "prj_04_silver_transactions",
    "SELECT * REPLACE (round(amount, 4) AS amount, round(amount_eur, 4) AS amount_eur) FROM silver_transactions",
)
def _(d):
    return rounded(d.silver_transactions)


@query(
    "prj_05_amount_eur",
    """SELECT transaction_id, round(coalesce(amount_eur, CASE currency WHEN 'USD' THEN amount / 1.08e0 WHEN 'GBP' THEN amount / 0.86e0
    ELSE amount END), 4) AS eur_divided, round(CASE currency WHEN 'USD' THEN amount * 0.92e0 WHEN 'GBP' THEN amount * 1.16e0
    WHEN 'CHF' THEN amount * 1.06e0 ELSE amount END, 6) AS eur_multiplied FROM transactions""",
)
def _(d):
    amount, currency = F.col("amount"), F.col("currency")
    return d.transactions.select(
        "transaction_id",
        F.round(money.amount_eur(F.col("amount_eur"), amount, currency), 4).alias("eur_divided"),
        F.round(money.fx_normalize(amount, currency, "multiply"), 6).alias("eur_multiplied"),
    )


@query(
    "prj_06_risk_level_batch",
    """SELECT transaction_id, CASE WHEN amount > 10000 THEN 'HIGH' WHEN amount > 1000 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
    FROM transactions""",
)
def _(d):
    return d.transactions.select("transaction_id", money.risk_level(F.col("amount")).alias("risk_level"))


@query(
    "prj_07_risk_level_stream",
    """SELECT transaction_id, CASE WHEN amount > 50000 THEN 'CRITICAL' WHEN amount > 10000 THEN 'HIGH'
    WHEN amount > 1000 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level FROM transactions""",
)
def _(d):
    level = money.risk_level(F.col("amount"), with_critical=True)
    return d.transactions.select("transaction_id", level.alias("risk_level"))


@query(
    "prj_08_requires_aml_check",
    "SELECT transaction_id, coalesce(is_cross_border AND amount > 5000, FALSE) AS requires_aml_check FROM transactions",
)
def _(d):
    check = money.requires_aml_check(F.col("is_cross_border"), F.col("amount"))
    return d.transactions.select("transaction_id", check.alias("requires_aml_check"))


@query(
    "prj_09_tx_date_hour",
    "SELECT event_id, date_trunc('day', ts) AS tx_date, date_trunc('hour', ts) AS tx_hour FROM quotes",
)
def _(d):
    ts = F.col("ts")
    return d.quotes.select("event_id", market.day_of(ts).alias("tx_date"), market.hour_of(ts).alias("tx_hour"))


@query(
    "prj_10_trend",
    """SELECT event_id, CASE WHEN change_percent > 0 THEN 'UP' WHEN change_percent < 0 THEN 'DOWN' ELSE 'STABLE' END AS trend
    FROM quotes""",
)
def _(d):
    return d.quotes.select("event_id", market.trend(F.col("change_percent")).alias("trend"))


@query(
    "prj_11_normalize_market",
    """SELECT event_id, currency, 'validated' AS data_quality, CASE WHEN currency <> 'EUR' THEN round(current_price *
    CASE currency WHEN 'USD' THEN 0.92e0 WHEN 'GBP' THEN 1.16e0 WHEN 'CHF' THEN 1.06e0 ELSE 1e0 END, 2) END AS price_eur FROM quotes""",
)
def _(d):
    return silver.normalize_market(d.quotes).select("event_id", "currency", "data_quality", "price_eur")


@query(
    "prj_12_flag_transaction",
    """SELECT transaction_id, sender_country IS DISTINCT FROM receiver_country AS is_cross_border,
    CASE WHEN sender_country IS DISTINCT FROM receiver_country THEN 'CROSS_BORDER_CHECK' END AS regulatory_flag,
    CASE WHEN amount_eur > 10000 THEN 'HIGH_VALUE_REVIEW' END AS aml_flag FROM transactions""",
)
def _(d):
    flagged = silver.flag_transactions(d.transactions)
    return flagged.select("transaction_id", "is_cross_border", "regulatory_flag", "aml_flag")


@query(
    "prj_13_validate_financials",
    """SELECT ticker, fiscal_year, fiscal_quarter, greatest(least(profit_margin_pct * 20, 100), -100) AS profit_margin_pct,
    coalesce(roe_pct, 0) AS roe_pct FROM financials""",
)
def _(d):
    raw = d.financials.withColumn("profit_margin_pct", F.col("profit_margin_pct") * 20)
    clean = silver.validate_financials(raw, ["revenue_millions", "net_income_millions", "profit_margin_pct", "roe_pct"])
    return clean.select("ticker", "fiscal_year", "fiscal_quarter", "profit_margin_pct", "roe_pct")


@query(
    "prj_14_financial_ratios",
    """SELECT ticker, fiscal_year, fiscal_quarter, round(total_assets_millions - total_equity_millions, 2) AS total_liabilities_millions,
    CASE WHEN total_equity_millions > 0 THEN round(net_income_millions / total_equity_millions * 100, 2) ELSE 0 END AS roe_pct,
    CASE WHEN total_equity_millions > 0 THEN round(total_debt_millions / total_equity_millions, 2) ELSE 0 END AS debt_to_equity,
    CASE WHEN shares_millions > 0 THEN round(net_income_millions / shares_millions, 2) ELSE 0 END AS eps,
    CASE WHEN revenue_millions > 0 THEN round(net_income_millions / revenue_millions * 100, 2) ELSE 0 END AS profit_margin_pct
    FROM financials""",
)
def _(d):
    return silver.financial_ratios(d.financials).select(
        "ticker", "fiscal_year", "fiscal_quarter",
        "total_liabilities_millions", "roe_pct", "debt_to_equity", "eps", "profit_margin_pct",
    )


@query(
    "prj_15_simple_anomaly_flag",
    "SELECT event_id, abs(change_percent) > 5 OR volume > 100000000 AS is_anomaly FROM quotes",
)
def _(d):
    return d.quotes.select("event_id", market.is_anomaly(F.col("change_percent"), F.col("volume")).alias("is_anomaly"))


@query("prj_16_normalize_columns", "SELECT symbol, market_cap FROM listings")
def _(d):
    spaced = d.listings.select(F.col("symbol").alias("Symbol"), F.col("market_cap").alias("Market Cap"))
    return silver.normalize_columns(spaced)


@query(
    "prj_17_fee",
    """SELECT transaction_id, round(amount * CASE WHEN contains(transaction_type, 'INSTANT') THEN 0.002e0 ELSE 0.001e0 END, 2) AS fee
    FROM transactions""",
)
def _(d):
    return silver.payment_terms(d.transactions).select("transaction_id", "fee")


@query(
    "prj_18_value_date",
    """SELECT transaction_id, CAST(created_at AS DATE) + CASE WHEN is_cross_border THEN 1 ELSE 0 END AS value_date,
    contains(transaction_type, 'INSTANT') AS is_instant FROM transactions""",
)
def _(d):
    return silver.payment_terms(d.transactions).select("transaction_id", "value_date", "is_instant")


@query(
    "prj_19_in_list_filter",
    """SELECT target_currency, round(rate, 4) AS rate, reference_date FROM silver_forex
    WHERE target_currency IN ('USD','GBP','JPY','CHF','CAD','AUD','CNY') ORDER BY reference_date DESC, target_currency LIMIT 100""",
)
def _(d):
    return rounded(silver.major_rates(d.silver_forex)).select("target_currency", "rate", "reference_date")
