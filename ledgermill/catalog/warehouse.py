"""Joins, aggregates, dimensions, top-k and set operations."""

from pyspark.sql import functions as F

from ledgermill.catalog.registry import query
from ledgermill.operators import gold, matching, warehouse
from ledgermill.operators.ordered import dense_index
from ledgermill.plans.layers import rounded
from ledgermill.plans.oracle import view

view(
    "dim_date",
    """SELECT d AS full_date, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_sk, year(d) AS year, quarter(d) AS quarter,
    month(d) AS month, day(d) AS day, dayofweek(d) AS day_of_week, weekofyear(d) AS week_of_year,
    dayofweek(d) NOT IN (0, 6) AS is_business_day
    FROM (SELECT CAST(unnest(generate_series(make_date(year(min(o_orderdate)), 1, 1), make_date(year(max(o_orderdate)), 12, 31),
          INTERVAL 1 DAY)) AS DATE) AS d FROM orders) days""",
)
view(
    "fact_transactions",
    """SELECT transaction_id, CAST(strftime(tx_date, '%Y%m%d') AS INTEGER) AS date_sk, sender_country, receiver_country,
    transaction_type, currency, amount, amount_eur, is_cross_border, amount_risk_level, requires_aml_check, status
    FROM silver_transactions""",
)
view(
    "alert_rows",
    """SELECT event_id, CASE WHEN change_percent > 0 THEN 'PRICE_SPIKE' ELSE 'PRICE_DROP' END AS alert_type, symbol,
    change_percent AS value, ts AS "timestamp" FROM quotes WHERE abs(change_percent) > 2""",
)


# ---- gold and dimensions -------------------------------------------------------


@query(
    "agg_01_gold_daily_market",
    """SELECT date_trunc('day', "timestamp") AS market_date, exchange, currency, count(*) AS quote_count, round(avg(price), 4) AS avg_price,
    round(avg(price_eur), 4) AS avg_price_eur, CAST(sum(volume) AS BIGINT) AS total_volume,
    count(CASE WHEN trend = 'UP' THEN 1 END) AS stocks_up, count(CASE WHEN trend = 'DOWN' THEN 1 END) AS stocks_down
    FROM silver_stocks GROUP BY ALL""",
)
def _(d):
    return rounded(d.gold_daily_market)


@query(
    "agg_02_gold_tx_summary",
    """SELECT tx_date, sender_country, receiver_country, transaction_type, is_cross_border, count(*) AS tx_count,
    round(sum(amount_eur), 2) AS total_volume_eur, round(avg(amount_eur), 2) AS avg_amount_eur,
    count(CASE WHEN requires_aml_check THEN 1 END) AS aml_flagged FROM silver_transactions GROUP BY ALL""",
)
def _(d):
    return rounded(d.gold_tx_summary, 2)


@query("dim_01_dim_date", "SELECT * FROM dim_date")
def _(d):
    return d.dim_date


@query(
    "dim_02_dim_company",
    """SELECT row_number() OVER (ORDER BY symbol, name, sector) AS company_sk, symbol AS company_id, name AS company_name, sector,
    'US' AS country, CAST(NULL AS DATE) AS valid_to, TRUE AS is_current
    FROM (SELECT DISTINCT symbol, name, sector FROM silver_financials WHERE _csv_source = 'sp500' AND symbol IS NOT NULL) m""",
)
def _(d):
    return d.dim_company.drop("valid_from")


@query(
    "dim_03_dim_currency_history",
    """SELECT row_number() OVER (ORDER BY target_currency, reference_date, rate) AS currency_sk, target_currency AS currency_code,
    round(rate, 4) AS latest_rate_vs_eur, reference_date AS rate_date FROM silver_forex
    UNION ALL SELECT 0, 'EUR', 1.0, CAST(NULL AS DATE)""",
)
def _(d):
    dim = rounded(gold.dim_currency_history(d.silver_forex))
    # the base row is dated today; blank it so that the result is the same every day
    return dim.withColumn("rate_date", F.when(F.col("currency_sk") > 0, F.col("rate_date")))


@query(
    "dim_04_dim_currency_latest",
    """SELECT target_currency AS currency_code, round(arg_max(rate, reference_date), 4) AS latest_rate_vs_eur,
    max(reference_date) AS rate_date FROM silver_forex GROUP BY target_currency""",
)
def _(d):
    return rounded(gold.dim_currency_latest(d.silver_forex))


@query(
    "dim_05_fact_transactions",
    "SELECT * REPLACE (round(amount, 4) AS amount, round(amount_eur, 4) AS amount_eur) FROM fact_transactions",
)
def _(d):
    return rounded(d.fact_transactions)


@query(
    "dim_06_layered_build",
    """SELECT 'silver_stocks' AS table_name, 'success' AS status, count(*) AS record_count FROM silver_stocks
    UNION ALL SELECT 'silver_forex', 'success', count(*) FROM silver_forex
    UNION ALL SELECT 'silver_financials', 'success', count(*) FROM silver_financials
    UNION ALL SELECT 'silver_transactions', 'success', count(*) FROM silver_transactions
    UNION ALL SELECT 'gold_daily_market', 'success', count(*) FROM
        (SELECT DISTINCT date_trunc('day', "timestamp"), exchange, currency FROM silver_stocks) a
    UNION ALL SELECT 'gold_tx_summary', 'success', count(*) FROM (SELECT DISTINCT tx_date, sender_country, receiver_country,
        transaction_type, is_cross_border FROM silver_transactions) b
    UNION ALL SELECT 'dim_company', 'success', count(*) FROM (SELECT DISTINCT symbol, name, sector FROM silver_financials
        WHERE _csv_source = 'sp500' AND symbol IS NOT NULL) c
    UNION ALL SELECT 'dim_currency', 'success', count(*) + 1 FROM silver_forex
    UNION ALL SELECT 'dim_date', 'success', count(*) FROM dim_date
    UNION ALL SELECT 'fact_transactions', 'success', count(*) FROM fact_transactions""",
)
def _(d):
    from ledgermill.plans.build import build_tables

    return build_tables(d)


# ---- joins ---------------------------------------------------------------------


@query(
    "jon_01_transactions_by_date",
    """WITH days AS (SELECT date_sk, count(transaction_id) AS tx_count, round(sum(amount_eur), 2) AS total_amount_eur FROM fact_transactions GROUP BY date_sk)
    SELECT full_date, year, quarter, month, is_business_day, tx_count, total_amount_eur FROM days JOIN dim_date USING (date_sk)
    QUALIFY row_number() OVER (ORDER BY full_date DESC) <= 30""",
)
def _(d):
    return rounded(warehouse.transactions_by_date(d.fact_transactions, d.dim_date), 2)


@query(
    "jon_02_cross_border_view",
    """SELECT t.transaction_id, t.sender_country, t.receiver_country, round(t.amount, 4) AS amount, sb.bank_name AS sender_bank_name,
    sb.swift_code AS sender_swift, rb.bank_name AS receiver_bank_name, rb.swift_code AS receiver_swift
    FROM transactions t LEFT JOIN banks sb ON t.sender_bank = sb.bank_name LEFT JOIN banks rb ON t.receiver_bank = rb.bank_name
    WHERE t.sender_country <> t.receiver_country""",
)
def _(d):
    joined = warehouse.cross_border_view(d.transactions, d.banks)
    return rounded(
        joined.select(
            "transaction_id", "sender_country", "receiver_country", "amount",
            "sender_bank_name", "sender_swift", "receiver_bank_name", "receiver_swift",
        )
    )


@query(
    "jon_03_enrich_lookup",
    """SELECT t.transaction_id, t.sender_bank, coalesce(b.swift_code, t.sender_bank) AS swift_code, coalesce(b.country, 'Unknown') AS country
    FROM transactions t LEFT JOIN banks b ON t.sender_bank = b.bank_name""",
)
def _(d):
    lookup = d.banks.select(F.col("bank_name").alias("sender_bank"), "swift_code", "country")
    defaults = {"swift_code": F.col("sender_bank"), "country": F.lit("Unknown")}
    rows = d.transactions.select("transaction_id", "sender_bank")
    return warehouse.enrich_lookup(rows, lookup, "sender_bank", defaults)


_LATEST_FX = """SELECT target_currency AS currency, arg_max(rate, reference_date) AS rate FROM silver_forex GROUP BY target_currency"""


@query(
    "jon_04_transactions_with_fx",
    f"""SELECT t.transaction_id, t.currency, round(t.amount, 4) AS original_amount, round(t.amount_eur, 4) AS amount_eur,
    round(f.rate, 4) AS rate FROM silver_transactions t LEFT JOIN ({_LATEST_FX}) f ON t.currency = f.currency
    ORDER BY t.transaction_id LIMIT 20""",
)
def _(d):
    latest = gold.dim_currency_latest(d.silver_forex).select(
        F.col("currency_code").alias("currency"), F.col("latest_rate_vs_eur").alias("rate")
    )
    # the limit comes first: the lookup holds one row per currency, so the left join keeps the row count
    first = d.silver_transactions.orderBy("transaction_id").limit(20)
    joined = first.join(latest, "currency", "left")
    return rounded(
        joined.select("transaction_id", "currency", F.col("amount").alias("original_amount"), "amount_eur", "rate")
    )


@query(
    "jon_05_name_match_pairs",
    """SELECT a.id AS id1, a.name AS name1, b.id AS id2, b.name AS name2 FROM entity_names a JOIN entity_names b ON a.id <> b.id
    AND (contains(lower(a.name), lower(b.name)) OR contains(lower(b.name), lower(a.name)))""",
)
def _(d):
    return matching.name_match_pairs(d.entity_names)


@query(
    "jon_05_name_match_first",
    """SELECT a.id AS id1, a.name AS name1, b.id AS id2, b.name AS name2 FROM entity_names a JOIN entity_names b ON a.id <> b.id
    AND (contains(lower(a.name), lower(b.name)) OR contains(lower(b.name), lower(a.name))) ORDER BY id1, id2 LIMIT 20""",
)
def _(d):
    return matching.name_match_pairs(d.entity_names, first=20)


@query(
    "jon_06_latest_per_key",
    """SELECT q.event_id, q.symbol, round(q.current_price, 4) AS current_price, q.volume, q.ts FROM quotes q
    WHERE q.ts = (SELECT max(x.ts) FROM quotes x WHERE x.symbol = q.symbol)""",
)
def _(d):
    latest = warehouse.latest_per_key(d.quotes, "symbol", "ts")
    return rounded(latest.select("event_id", "symbol", "current_price", "volume", "ts"))


# ---- aggregates ----------------------------------------------------------------


@query(
    "agg_03_market_overview",
    """SELECT exchange, count(*) AS stock_count, count(*) FILTER (trend = 'UP') AS stocks_up, count(*) FILTER (trend = 'DOWN') AS stocks_down,
    CAST(sum(volume) AS BIGINT) AS total_volume, round(avg(price_eur), 2) AS avg_price_eur FROM silver_stocks GROUP BY exchange""",
)
def _(d):
    return warehouse.market_overview(d.silver_stocks)


@query(
    "agg_04_transaction_summary",
    """SELECT tx_date, count(*) AS tx_count, round(sum(amount_eur), 2) AS total_volume_eur, round(avg(amount_eur), 2) AS avg_amount_eur,
    count(*) FILTER (is_cross_border) AS cross_border_count, count(*) FILTER (requires_aml_check) AS aml_flagged
    FROM silver_transactions WHERE tx_date >= DATE '2001-08-01' - INTERVAL 7 DAY GROUP BY tx_date""",
)
def _(d):
    from datetime import date

    return warehouse.transaction_summary(d.silver_transactions, as_of=date(2001, 8, 1))


@query(
    "agg_05_cross_border_flows",
    """SELECT sender_country, receiver_country, count(*) AS tx_count, round(sum(amount_eur), 2) AS total_volume_eur, round(avg(amount_eur), 2) AS avg_amount_eur
    FROM silver_transactions WHERE is_cross_border GROUP BY sender_country, receiver_country
    ORDER BY total_volume_eur DESC, sender_country, receiver_country LIMIT 20""",
)
def _(d):
    return warehouse.cross_border_flows(d.silver_transactions)


@query(
    "agg_06_kpis",
    """SELECT count(*) AS total_transactions, round(sum(amount_eur), 2) AS total_volume_eur, round(avg(amount_eur), 2) AS avg_transaction_eur,
    count(*) FILTER (is_cross_border) AS cross_border_count, round(100.0 * count(*) FILTER (is_cross_border) / count(*), 1) AS cross_border_pct,
    (SELECT count(*) FROM silver_stocks) AS stock_count, (SELECT round(avg(price_eur), 2) FROM silver_stocks) AS avg_stock_price_eur,
    (SELECT CAST(sum(volume) AS BIGINT) FROM silver_stocks) AS total_volume FROM silver_transactions""",
)
def _(d):
    return warehouse.kpis(d.silver_transactions, d.silver_stocks)


@query(
    "agg_07_transaction_analytics",
    """SELECT CAST(created_at AS DATE) AS date, transaction_type, category, currency, count(*) AS tx_count,
    round(sum(amount_eur), 2) AS total_volume_eur, round(avg(amount_eur), 2) AS avg_amount_eur,
    count(CASE WHEN sender_country <> receiver_country THEN 1 END) AS cross_border_count FROM transactions GROUP BY ALL""",
)
def _(d):
    return rounded(warehouse.transaction_analytics(d.transactions), 2)


@query(
    "agg_08_transaction_stats",
    """SELECT CAST(created_at AS DATE) AS tx_date, transaction_type, sender_country, count(*) AS tx_count,
    round(sum(amount_eur), 2) AS total_volume_eur, round(avg(amount_eur), 2) AS avg_amount_eur,
    count(*) FILTER (WHERE status = 'COMPLETED') AS completed_count, count(*) FILTER (WHERE status = 'FAILED') AS failed_count
    FROM transactions GROUP BY ALL""",
)
def _(d):
    return rounded(warehouse.transaction_stats(d.transactions), 2)


@query(
    "agg_09_transaction_summary_view",
    """SELECT CAST(created_at AS DATE) AS date, transaction_type, currency, count(*) AS num_transactions,
    round(sum(amount), 2) AS total_amount, round(avg(amount), 2) AS avg_amount FROM transactions GROUP BY ALL""",
)
def _(d):
    return rounded(warehouse.transaction_summary_view(d.transactions), 2)


@query(
    "agg_10_daily_alerts",
    """SELECT CAST("timestamp" AS DATE) AS date, alert_type, count(*) AS alert_count, round(avg(value), 4) AS avg_value
    FROM alert_rows GROUP BY ALL""",
)
def _(d):
    from ledgermill.operators.anomaly import price_move_alerts

    return rounded(warehouse.daily_alerts(price_move_alerts(d.quotes.withColumnRenamed("ts", "timestamp"))))


@query(
    "agg_11_transaction_profile",
    """WITH base AS (SELECT *, sender_country <> receiver_country AS crossing FROM transactions),
    agg AS (SELECT unnest([{'attribute': 'transaction_type', 'value': transaction_type}, {'attribute': 'category', 'value': category},
      {'attribute': 'currency', 'value': currency}, {'attribute': 'status', 'value': status}, {'attribute': 'all', 'value': 'all'}]) AS u,
      amount_eur, crossing FROM base)
    SELECT u.attribute AS attribute, u.value AS value, count(*) AS tx_count, round(sum(amount_eur), 2) AS total_volume_eur,
    round(avg(amount_eur), 2) AS avg_transaction_eur, round(count(*) FILTER (WHERE crossing) * 100.0 / count(*), 2) AS cross_border_pct
    FROM agg GROUP BY 1, 2""",
)
def _(d):
    return warehouse.transaction_profile(d.transactions)


@query(
    "agg_12_sector_summary",
    """SELECT sector, round(sum(revenue_millions), 2) AS total_revenue, round(avg(profit_margin_pct), 2) AS avg_margin,
    round(avg(roe_pct), 2) AS avg_roe FROM financials GROUP BY sector""",
)
def _(d):
    return warehouse.sector_summary(d.financials)


@query(
    "agg_13_country_volume",
    "SELECT sender_country, round(sum(amount_eur), 2) AS total_volume, count(*) AS tx_count FROM silver_transactions GROUP BY sender_country",
)
def _(d):
    return rounded(warehouse.country_volume(d.silver_transactions), 2)


@query(
    "agg_14_flow_matrix",
    """SELECT sender_country, receiver_country, round(sum(amount_eur), 2) AS total_amount, count(*) AS tx_count
    FROM silver_transactions WHERE is_cross_border GROUP BY ALL ORDER BY sender_country, receiver_country LIMIT 20""",
)
def _(d):
    return rounded(warehouse.flow_matrix(d.silver_transactions), 2)


@query(
    "agg_15_status_share",
    """SELECT 'transaction_type' AS attribute, transaction_type AS value, count(*) AS row_count,
    round(avg(CAST(is_cross_border AS INTEGER)) * 100, 2) AS flag_pct FROM transactions GROUP BY transaction_type
    UNION ALL SELECT 'channel', channel, count(*), round(avg(CAST(is_cross_border AS INTEGER)) * 100, 2) FROM transactions GROUP BY channel
    UNION ALL SELECT 'status', status, count(*), round(avg(CAST(is_cross_border AS INTEGER)) * 100, 2) FROM transactions GROUP BY status""",
)
def _(d):
    return warehouse.value_shares(d.transactions, ["transaction_type", "channel", "status"], "is_cross_border")


@query(
    "agg_16_distinct_profile",
    """SELECT count(DISTINCT ticker) AS distinct_count, min(fiscal_year) AS min_value, max(fiscal_year) AS max_value FROM financials""",
)
def _(d):
    return warehouse.distinct_profile(d.financials, "ticker", "fiscal_year").select(
        "distinct_count", F.col("min_value").cast("long"), F.col("max_value").cast("long")
    )


@query("agg_16_distinct_values", "SELECT DISTINCT sector FROM financials")
def _(d):
    return d.financials.select("sector").distinct()


@query(
    "agg_17_daily_volume",
    """SELECT CAST("timestamp" AS DATE) AS date, round(sum(amount_eur), 2) AS daily_volume, count(*) AS tx_count
    FROM silver_transactions GROUP BY 1""",
)
def _(d):
    return rounded(warehouse.daily_volume(d.silver_transactions), 2)


@query(
    "agg_18_layer_counts",
    """SELECT 'silver_stocks' AS table_name, count(*) AS row_count FROM silver_stocks UNION ALL
    SELECT 'silver_forex', count(*) FROM silver_forex UNION ALL SELECT 'silver_financials', count(*) FROM silver_financials UNION ALL
    SELECT 'silver_transactions', count(*) FROM silver_transactions""",
)
def _(d):
    names = ["silver_stocks", "silver_forex", "silver_financials", "silver_transactions"]
    return warehouse.layer_counts({n: getattr(d, n) for n in names})


@query(
    "agg_19_transaction_metrics",
    """SELECT date_trunc('day', created_at) AS metric_time, count(*) AS total_count, round(sum(amount), 2) AS total_amount,
    round(avg(amount), 2) AS avg_amount, count(*) FILTER (WHERE status = 'COMPLETED') AS completed_count,
    count(*) FILTER (WHERE status = 'PENDING') AS pending_count, count(*) FILTER (WHERE status = 'FAILED') AS failed_count
    FROM transactions GROUP BY 1""",
)
def _(d):
    return rounded(warehouse.transaction_metrics(d.transactions), 2)


@query("agg_20_avg_change", "SELECT round(avg(change_percent), 4) AS avg_change FROM quotes")
def _(d):
    return rounded(warehouse.average_change(d.quotes))


@query("agg_21_threshold_count", "SELECT count(*) FILTER (WHERE amount > 50000) AS high_value_count FROM transactions")
def _(d):
    return warehouse.threshold_count(d.transactions)


@query(
    "agg_22_count_by_label",
    """SELECT 'PRICE_SPIKE' AS pattern, count(*) FILTER (WHERE regexp_full_match(alert_type, 'PRICE_SPIKE')) AS value FROM alert_rows
    UNION ALL SELECT 'VOLUME.*', count(*) FILTER (WHERE regexp_full_match(alert_type, 'VOLUME.*')) FROM alert_rows""",
)
def _(d):
    from ledgermill.operators.anomaly import price_move_alerts

    alerts = price_move_alerts(d.quotes.withColumnRenamed("ts", "timestamp"))

    def counted(pattern):
        return warehouse.count_by_label(alerts, "alert_type", pattern).select(F.lit(pattern).alias("pattern"), "value")

    return counted("PRICE_SPIKE").unionByName(counted("VOLUME.*"))


# ---- top-k and latest ----------------------------------------------------------


@query(
    "top_01_company_performance",
    """SELECT company_name, ticker, sector, country, fiscal_year, fiscal_quarter, round(revenue_millions, 4) AS revenue_millions,
    round(net_income_millions, 4) AS net_income_millions, profit_margin_pct, roe_pct,
    round(revenue_millions / total_assets_millions, 4) AS asset_turnover FROM financials""",
)
def _(d):
    return rounded(warehouse.company_performance(d.financials))


@query(
    "top_02_forex_rates",
    "SELECT currency_pair, round(rate, 4) AS rate, round(inverse_rate, 4) AS inverse_rate, reference_date FROM silver_forex",
)
def _(d):
    return rounded(warehouse.forex_rates(d.silver_forex))


@query(
    "top_03_top_companies",
    """SELECT symbol, name, sector, round(market_cap, 2) AS market_cap FROM listings WHERE market_cap IS NOT NULL
    ORDER BY market_cap DESC, name, symbol LIMIT 30""",
)
def _(d):
    return rounded(warehouse.top_companies(d.listings), 2)


@query(
    "top_04_recent_quotes",
    "SELECT event_id, symbol, ts FROM quotes ORDER BY ts DESC, event_id DESC LIMIT 20",
)
def _(d):
    return warehouse.recent_n(d.quotes.select("event_id", "symbol", "ts"), "ts", "event_id", 20)


@query(
    "top_04_recent_transactions",
    "SELECT tx_key, transaction_id, created_at FROM transactions ORDER BY created_at DESC, tx_key DESC LIMIT 30",
)
def _(d):
    rows = d.transactions.select("tx_key", "transaction_id", "created_at")
    return warehouse.recent_n(rows, "created_at", "tx_key", 30)


@query(
    "top_05_topk_metric",
    """SELECT symbol, volume FROM (SELECT symbol, arg_max(volume, (ts, event_id)) AS volume FROM quotes GROUP BY symbol) v
    ORDER BY volume DESC, symbol LIMIT 10""",
)
def _(d):
    return warehouse.topk_metric(d.quotes, "symbol", "volume", "ts", "event_id")


@query(
    "top_06_latest_company_summary",
    """SELECT ticker, arg_max(company_name, (fiscal_year, fiscal_quarter)) AS company_name, arg_max(sector, (fiscal_year, fiscal_quarter)) AS sector,
    arg_max(country, (fiscal_year, fiscal_quarter)) AS country,
    max(concat(CAST(fiscal_year AS STRING), ' ', fiscal_quarter)) AS latest_quarter,
    round(arg_max(revenue_millions, (fiscal_year, fiscal_quarter)), 4) AS revenue_millions,
    round(arg_max(net_income_millions, (fiscal_year, fiscal_quarter)), 4) AS net_income_millions,
    arg_max(profit_margin_pct, (fiscal_year, fiscal_quarter)) AS profit_margin_pct, count(*) AS total_records
    FROM financials GROUP BY ticker""",
)
def _(d):
    return rounded(warehouse.latest_company_summary(d.financials))


@query(
    "top_06_latest_company_missing",
    """SELECT 'TK-none' AS ticker, count(*) AS total_records, 'Company TK-none not found' AS error FROM financials
    WHERE ticker = 'TK-none'""",
)
def _(d):
    summary = warehouse.latest_company_summary(d.financials, "TK-none")
    return summary.select("ticker", F.coalesce("total_records", F.lit(0)).alias("total_records"), "error")


@query(
    "top_07_top_roe",
    """SELECT company_name, ticker, fiscal_year, fiscal_quarter, roe_pct, round(revenue_millions, 2) AS revenue_millions FROM financials
    WHERE roe_pct > 5 ORDER BY roe_pct DESC, ticker, fiscal_year, fiscal_quarter LIMIT 10""",
)
def _(d):
    best = d.financials.filter(F.col("roe_pct") > 5)
    ordered = best.orderBy(F.col("roe_pct").desc(), "ticker", "fiscal_year", "fiscal_quarter").limit(10)
    columns = ["company_name", "ticker", "fiscal_year", "fiscal_quarter", "roe_pct"]
    return ordered.select(*columns, F.round("revenue_millions", 2).alias("revenue_millions"))


@query("top_08_all_listings", "SELECT symbol, name, sector FROM listings")
def _(d):
    return warehouse.all_listings(d.listings).select("symbol", "name", "sector")


# ---- numbering and set operations ----------------------------------------------


@query("win_01_surrogate_key", "SELECT transaction_id, row_number() OVER (ORDER BY created_at, tx_key) AS row_key FROM transactions")
def _(d):
    rows = d.transactions.select("transaction_id", "tx_key", "created_at")
    return dense_index(rows, ["created_at", "tx_key"], "row_key", start=1).select("transaction_id", "row_key")


@query(
    "set_01_union_all",
    """SELECT target_currency AS currency_code, round(rate, 4) AS rate FROM silver_forex UNION ALL
    SELECT base_currency, 1.0 FROM silver_forex""",
)
def _(d):
    quoted = d.silver_forex.select(F.col("target_currency").alias("currency_code"), F.round("rate", 4).alias("rate"))
    base = d.silver_forex.select(F.col("base_currency").alias("currency_code"), F.lit(1.0).alias("rate"))
    return quoted.unionByName(base)


@query(
    "set_02_union_widening",
    """SELECT symbol, name, CAST(NULL AS STRING) AS ticker FROM listings UNION ALL
    SELECT NULL, company_name, ticker FROM financials""",
)
def _(d):
    left = d.listings.select("symbol", "name")
    right = d.financials.select(F.col("company_name").alias("name"), "ticker")
    return left.unionByName(right, allowMissingColumns=True)


@query("set_04_distinct", "SELECT DISTINCT sender_country, receiver_country, currency FROM transactions")
def _(d):
    return d.transactions.select("sender_country", "receiver_country", "currency").distinct()
