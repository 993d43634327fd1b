"""Financial inputs derived from the given tables.

Each text is portable SQL: ``{name}`` is a given table or another input. Spark reads
the parquet tables in place and DuckDB the views of the same name, so both engines
start from the same rows at any scale factor. Prices and amounts are divided by odd
constants so that no reported value sits exactly between two rounded ones.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession

GIVEN = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

INPUTS: dict[str, str] = {
    "transactions": """
SELECT concat('TX', CAST(o.o_orderkey AS STRING)) AS transaction_id, o.o_orderkey AS tx_key,
       CASE WHEN mod(o.o_orderkey, 10) = 0 THEN o.o_totalprice / CAST(1.01371 AS DOUBLE) ELSE o.o_totalprice / CAST(19.7371 AS DOUBLE) END AS amount,
       CASE mod(o.o_orderkey, 4) WHEN 0 THEN 'EUR' WHEN 1 THEN 'USD' WHEN 2 THEN 'GBP' ELSE 'CHF' END AS currency,
       CASE WHEN mod(o.o_orderkey, 7) = 0 THEN o.o_totalprice / CAST(24.7137 AS DOUBLE) END AS amount_eur,
       concat('C', CAST(c.c_custkey AS STRING)) AS sender_id, c.c_name AS sender_name,
       lower(sn.n_name) AS sender_country, concat('BANK_', sn.n_name) AS sender_bank,
       concat('R', CAST(rn.n_nationkey AS STRING)) AS receiver_id, concat('Receiver ', rn.n_name) AS receiver_name,
       lower(rn.n_name) AS receiver_country, concat('BANK_', rn.n_name) AS receiver_bank,
       CASE mod(o.o_custkey, 5) WHEN 0 THEN 'PAYMENT' WHEN 1 THEN 'TRANSFER' WHEN 2 THEN 'DEPOSIT'
            WHEN 3 THEN 'INSTANT_PAYMENT' ELSE 'REFUND' END AS transaction_type,
       c.c_mktsegment AS category, o.o_orderpriority AS channel,
       CASE WHEN mod(o.o_orderkey, 50) = 7 THEN NULL WHEN mod(o.o_orderkey, 20) = 3 THEN 'FAILED'
            WHEN o.o_orderstatus = 'F' THEN 'COMPLETED' WHEN o.o_orderstatus = 'O' THEN 'PENDING' ELSE 'PROCESSING' END AS status,
       sn.n_nationkey <> rn.n_nationkey AS is_cross_border,
       o.o_orderdate AS created_at
FROM {orders} o
JOIN {customer} c ON o.o_custkey = c.c_custkey
JOIN {nation} sn ON c.c_nationkey = sn.n_nationkey
JOIN {nation} rn ON mod(o.o_orderkey, 25) = rn.n_nationkey""",
    "quotes": """
SELECT event_id, concat('SYM', CAST(user_id AS STRING)) AS symbol,
       concat('Company ', CAST(user_id AS STRING)) AS company_name,
       CASE mod(user_id, 3) WHEN 0 THEN 'NASDAQ' WHEN 1 THEN 'NYSE' ELSE 'LSE' END AS exchange,
       CASE mod(user_id, 4) WHEN 0 THEN 'USD' WHEN 1 THEN 'gbp' WHEN 2 THEN 'EUR' ELSE 'GBP' END AS currency,
       CASE WHEN mod(event_id, 97) = 0 THEN CAST(0 AS DOUBLE) ELSE price END AS current_price,
       prior AS previous_close, price - prior AS change, (price - prior) * 100 / prior AS change_percent,
       CAST(floor(price * price * 1000) AS BIGINT) AS volume,
       CASE WHEN mod(user_id, 9) = 0 THEN NULL ELSE CAST(floor(price * 1000000) AS BIGINT) END AS market_cap, ts
FROM (SELECT e.*, value / CAST(1.07379 AS DOUBLE) AS price,
             nullif(CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE), 0) / CAST(1.03117 AS DOUBLE) AS prior FROM {events} e) p""",
    "forex": """
SELECT 'EUR' AS base_currency,
       CASE event_type WHEN 'click' THEN 'USD' WHEN 'view' THEN 'GBP' WHEN 'purchase' THEN 'JPY'
            WHEN 'signup' THEN 'CHF' ELSE 'CAD' END AS target_currency,
       CAST(ts AS DATE) AS reference_date, max(value) / CAST(107.379 AS DOUBLE) AS rate
FROM {events} GROUP BY event_type, CAST(ts AS DATE)""",
    "listings": """
SELECT CASE WHEN mod(p_partkey, 41) = 0 THEN NULL ELSE concat('P', CAST(p_partkey AS STRING)) END AS symbol,
       p_partkey AS listing_id, p_name AS name, p_type AS sector,
       CASE WHEN mod(p_partkey, 13) = 0 THEN NULL ELSE p_retailprice * 1000000 / CAST(1.07379 AS DOUBLE) END AS market_cap,
       CASE mod(p_partkey, 4) WHEN 0 THEN 'sp500' WHEN 1 THEN 'gdp' WHEN 2 THEN 'nasdaq' ELSE 'nyse' END AS _csv_source
FROM {part}""",
    "financials": """
SELECT concat('F', CAST(s.s_suppkey AS STRING)) AS company_id, s.s_name AS company_name,
       concat('TK', CAST(s.s_suppkey AS STRING)) AS ticker, r.r_name AS sector, n.n_name AS country,
       f.fiscal_year, f.fiscal_quarter, f.revenue AS revenue_millions, f.kept / CAST(8.3719 AS DOUBLE) AS net_income_millions,
       f.quantity * 20000 AS total_assets_millions, f.quantity * 2000 AS total_equity_millions,
       f.quantity * 9000 AS total_debt_millions, f.quantity AS shares_millions,
       round(f.kept * 100 / 8.3719 / f.revenue, 4) AS profit_margin_pct,
       CASE WHEN mod(s.s_suppkey, 6) = 5 THEN NULL ELSE round(f.kept / 166.37 / f.quantity, 4) END AS roe_pct
FROM (SELECT l_suppkey, year(l_shipdate) AS fiscal_year, concat('Q', CAST(quarter(l_shipdate) AS STRING)) AS fiscal_quarter,
             CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
             CAST(sum(CASE WHEN l_returnflag = 'R' THEN -CAST(l_extendedprice AS DECIMAL(18,2))
                           ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE) AS kept,
             CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
      FROM {lineitem} GROUP BY l_suppkey, year(l_shipdate), quarter(l_shipdate)) f
JOIN {supplier} s ON f.l_suppkey = s.s_suppkey
JOIN {nation} n ON s.s_nationkey = n.n_nationkey
JOIN {region} r ON n.n_regionkey = r.r_regionkey""",
    "banks": """
SELECT concat('BANK_', n_name) AS bank_name, concat('SW', CAST(n_nationkey AS STRING)) AS swift_code,
       lower(n_name) AS country, n_regionkey = 3 AS is_sepa_member
FROM {nation} WHERE n_nationkey <> 4""",
    "metric_points": "SELECT event_id, event_type AS metric, value / CAST(1.07379 AS DOUBLE) AS value, ts FROM {events}",
    "event_metrics": """
SELECT concat('e', CAST(event_id AS STRING)) AS point_id, 'forex' AS source, 'change_percent' AS metric,
       change_percent / 1000 AS value, CAST(NULL AS STRING) AS status, ts FROM {quotes}
UNION ALL SELECT concat('p', CAST(event_id AS STRING)), 'pipeline', 'stage', CAST(NULL AS DOUBLE),
       CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END, ts FROM {events}
UNION ALL SELECT concat('q', CAST(event_id AS STRING)), 'data_quality', 'age', value * 100, CAST(NULL AS STRING), ts FROM {events}""",
    "metrics": """
SELECT concat('t', CAST(o_orderkey AS STRING)) AS point_id, 'transactions' AS source, 'amount' AS metric,
       o_totalprice AS value, CAST(NULL AS STRING) AS status, o_orderdate AS ts FROM {orders}
UNION ALL SELECT point_id, source, metric, value, status, ts FROM {event_metrics}""",
    "lineage_edges": """
SELECT concat('customer:', CAST(o_custkey AS STRING)) AS source_asset, concat('order:', CAST(o_orderkey AS STRING)) AS target_asset FROM {orders}
UNION ALL SELECT concat('order:', CAST(l_orderkey AS STRING)), concat('part:', CAST(l_partkey AS STRING)) FROM {lineitem}
UNION ALL SELECT concat('part:', CAST(l_partkey AS STRING)), concat('supplier:', CAST(l_suppkey AS STRING)) FROM {lineitem}
UNION ALL SELECT concat('supplier:', CAST(s_suppkey AS STRING)), concat('nation:', CAST(s_nationkey AS STRING)) FROM {supplier}
UNION ALL SELECT concat('nation:', CAST(n_nationkey AS STRING)), concat('region:', CAST(n_regionkey AS STRING)) FROM {nation}
UNION ALL SELECT concat('region:', CAST(n_regionkey AS STRING)), concat('nation:', CAST(n_nationkey AS STRING)) FROM {nation}""",
    "entity_names": """
SELECT concat('N', CAST(n_nationkey AS STRING)) AS id, n_name AS name FROM {nation}
UNION ALL SELECT concat('B', p_brand), p_brand FROM (SELECT DISTINCT p_brand FROM {part}) b
UNION ALL SELECT concat('P', p_name), p_name FROM (SELECT DISTINCT p_name FROM {part}) p
UNION ALL SELECT concat('S', CAST(s_suppkey AS STRING)),
       CASE WHEN mod(s_suppkey, 2) = 0 THEN s_name ELSE concat(lower(s_name), ' ltd') END FROM {supplier}
UNION ALL SELECT concat('T', CAST(s_suppkey AS STRING)), concat('Trading ', s_name, ' Ltd') FROM {supplier}""",
    "cdc_before": """
SELECT c_custkey, c_name, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS STRING) AS c_acctbal
FROM {customer} WHERE mod(c_custkey, 10) <> 0""",
    "cdc_after": """
SELECT c_custkey, c_name, CAST(CASE WHEN mod(c_custkey, 10) = 2 THEN CAST(c_acctbal AS DECIMAL(18,2)) + 1
       ELSE CAST(c_acctbal AS DECIMAL(18,2)) END AS STRING) AS c_acctbal
FROM {customer} WHERE mod(c_custkey, 10) <> 1""",
}


def references(text: str) -> list[str]:
    return sorted({field for _, field, _, _ in string.Formatter().parse(text) if field})


class Inputs:
    """Given tables and derived inputs of one data folder, as lazy DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def frame(self, name: str, **replaced: DataFrame) -> DataFrame:
        """A derived input; ``replaced`` swaps a given table, e.g. for a stream of it."""
        if name in GIVEN:
            return replaced.get(name) or self.table(name)
        return derive(INPUTS[name], self, **replaced)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or (name not in INPUTS and name not in GIVEN):
            raise AttributeError(name)
        return self.frame(name)


def derive(text: str, inputs: Inputs, **replaced: DataFrame) -> DataFrame:
    frames = {n: replaced[n] if n in replaced else inputs.frame(n, **replaced) for n in references(text)}
    return inputs.spark.sql(text, **frames)
