"""Quality rules, profiles, metric tables, lineage and change logs."""

from datetime import datetime

from pyspark.sql import functions as F

from ledgermill.catalog.registry import query
from ledgermill.operators import closure, quality
from ledgermill.operators.quality import QualityRule
from ledgermill.plans.layers import rounded
from ledgermill.plans.oracle import view


def _tables(d):
    return {
        "stocks": d.quotes.withColumnRenamed("current_price", "price"),
        "transactions": d.transactions,
        "forex": d.forex,
        "companies": d.financials,
    }


def _rule_sql(rule, table, kind, passed, source):
    return f"""SELECT '{rule}' AS rule_id, '{table}' AS table_name, '{kind}' AS rule_type, count(*) AS total_records, {passed} AS passed_records,
    round(100.0 * {passed} / count(*), 2) AS score, CAST(100 AS DOUBLE) AS threshold, 100.0 * {passed} / count(*) >= 100 AS passed FROM {source}"""


view(
    "rule_scores",
    " UNION ALL ".join(
        [
            _rule_sql("price_positive", "stocks", "validity", "count(*) FILTER (WHERE current_price > 0)", "quotes"),
            _rule_sql("amount_not_null", "transactions", "completeness", "count(amount)", "transactions"),
            _rule_sql("currency_iso", "transactions", "validity", "count(*) FILTER (WHERE length(currency) = 3)", "transactions"),
            _rule_sql("rate_positive", "forex", "validity", "count(*) FILTER (WHERE rate > 0)", "forex"),
            _rule_sql("ticker_unique", "companies", "uniqueness", "count(DISTINCT ticker)", "financials"),
        ]
    ),
)


@query("dq_01_quality_rules", "SELECT * FROM rule_scores")
def _(d):
    return quality.run_quality_rules(_tables(d)).drop("error")


@query(
    "dq_01_quality_totals",
    """SELECT count(*) AS total_rules, count(*) FILTER (WHERE passed) AS passed_rules, count(*) FILTER (WHERE NOT passed) AS failed_rules,
    round(avg(score), 2) AS overall_score FROM rule_scores""",
)
def _(d):
    return quality.quality_totals(quality.run_quality_rules(_tables(d)))


@query(
    "dq_02_broken_rule",
    """SELECT 'amount_not_null' AS rule_id, count(*) AS total_records, count(amount) AS passed_records, TRUE AS passed FROM transactions
    UNION ALL SELECT 'no_such_column', 0, 0, FALSE""",
)
def _(d):
    rules = [quality.DEFAULT_RULES[1], QualityRule("no_such_column", "transactions", "validity", "missing_column > 0")]
    scored = quality.run_quality_rules(_tables(d), rules)
    return scored.select("rule_id", "total_records", "passed_records", "passed")


@query(
    "dq_03_uniqueness",
    """SELECT 'lineitem_key' AS rule_id, count(*) AS total_records, (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) k) AS passed_records
    FROM lineitem""",
)
def _(d):
    rule = QualityRule("lineitem_key", "lineitem", "uniqueness", "l_orderkey, l_linenumber")
    scored = quality.run_quality_rules({"lineitem": d.lineitem}, [rule])
    return scored.select("rule_id", "total_records", "passed_records")


_TX_COLUMNS = ["transaction_id", "amount", "amount_eur", "status", "sender_bank"]


@query(
    "dq_04_null_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM transactions" for c in _TX_COLUMNS
    ),
)
def _(d):
    return quality.null_profile(d.transactions.select(*_TX_COLUMNS))


@query(
    "dq_05_duplicate_count",
    "SELECT (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) k) AS duplicate_count",
)
def _(d):
    return quality.duplicate_count(d.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "dq_06_freshness",
    "SELECT CAST(floor(epoch(TIMESTAMP '2024-02-01') - epoch(max(ts))) AS BIGINT) AS seconds_since_update FROM events",
)
def _(d):
    return quality.freshness(d.events, "ts", F.lit(datetime(2024, 2, 1)))


@query(
    "dq_07_schema_violations",
    """SELECT 'p_name' AS column_name, 'int' AS expected_type, count(*) FILTER (WHERE TRY_CAST(p_name AS INTEGER) IS NULL) AS violations FROM part
    UNION ALL SELECT 'code', 'int', count(*) FILTER (WHERE mod(p_partkey, 7) = 0) FROM part""",
)
def _(d):
    code = F.when(F.col("p_partkey") % 7 == 0, F.lit("n/a")).otherwise(F.col("p_partkey").cast("string"))
    return quality.schema_violations(d.part.withColumn("code", code), {"p_name": "int", "code": "int"})


@query(
    "dq_08_duration_histogram",
    """SELECT event_type, le, count(*) FILTER (WHERE value <= CAST(replace(le, '+Inf', 'inf') AS DOUBLE)) AS cumulative_count,
    round(sum(value), 2) AS value_sum, count(value) AS value_count FROM events,
    (SELECT unnest(['0.1','0.5','1.0','2.5','5.0','10.0','30.0','60.0','+Inf']) AS le) b GROUP BY event_type, le""",
)
def _(d):
    return rounded(quality.duration_histogram(d.events, "value", by=["event_type"]), 2)


@query(
    "dq_09_business_gauges",
    """SELECT 'transaction_count' AS metric, concat('transaction_type=', transaction_type, ',status=', coalesce(status, '')) AS labels,
      CAST(count(*) AS DOUBLE) AS value FROM transactions GROUP BY transaction_type, status
    UNION ALL SELECT 'transaction_volume_eur', concat('transaction_type=', transaction_type, ',status=', coalesce(status, '')), round(sum(amount_eur), 2)
      FROM transactions GROUP BY transaction_type, status
    UNION ALL SELECT 'transaction_avg_eur', concat('transaction_type=', transaction_type, ',status=', coalesce(status, '')), round(avg(amount_eur), 2)
      FROM transactions GROUP BY transaction_type, status
    UNION ALL SELECT 'stock_price', concat('symbol=', symbol, ',exchange=', exchange), round(arg_max(price, ("timestamp", price)), 2)
      FROM silver_stocks GROUP BY symbol, exchange
    UNION ALL SELECT 'fx_rate', concat('currency_pair=', currency_pair), round(arg_max(rate, reference_date), 2) FROM silver_forex GROUP BY currency_pair
    UNION ALL SELECT 'company_count', concat('sector=', sector, ',country=', country), CAST(count(DISTINCT ticker) AS DOUBLE)
      FROM financials GROUP BY sector, country""",
)
def _(d):
    return rounded(quality.business_gauges(d.transactions, d.silver_stocks, d.silver_forex, d.financials), 2)


@query(
    "dq_10_stage_metrics",
    """SELECT event_type AS stage, concat('u', CAST(user_id AS STRING)) AS source, count(*) AS run_count, CAST(sum(event_id) AS BIGINT) AS total_records,
    round(sum(value), 2) AS total_duration_seconds, round(max(value), 2) AS max_duration_seconds, count(*) FILTER (WHERE value < 50) AS success_count,
    count(*) FILTER (WHERE value >= 50) AS failed_count FROM events GROUP BY event_type, user_id""",
)
def _(d):
    log = d.events.select(
        F.col("event_type").alias("stage"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("source"),
        F.col("event_id").alias("records"),
        F.col("value").alias("duration_seconds"),
        F.when(F.col("value") < 50, "success").otherwise("failed").alias("status"),
    )
    return rounded(quality.stage_metrics(log), 2)


@query("lin_01_upstream", "SELECT DISTINCT source_asset AS asset FROM lineage_edges WHERE target_asset = 'part:7'")
def _(d):
    return closure.direct_lineage(d.lineage_edges, "part:7")


@query("lin_01_downstream", "SELECT DISTINCT target_asset AS asset FROM lineage_edges WHERE source_asset = 'part:7'")
def _(d):
    return closure.direct_lineage(d.lineage_edges, "part:7", upstream=False)


@query(
    "lin_02_full_lineage",
    """WITH RECURSIVE up(asset) AS (SELECT source_asset FROM lineage_edges WHERE target_asset = 'part:7' UNION
      SELECT e.source_asset FROM up JOIN lineage_edges e ON e.target_asset = up.asset),
    down(asset) AS (SELECT target_asset FROM lineage_edges WHERE source_asset = 'part:7' UNION
      SELECT e.target_asset FROM down JOIN lineage_edges e ON e.source_asset = down.asset)
    SELECT 'upstream' AS direction, asset FROM up UNION ALL SELECT 'downstream', asset FROM down""",
)
def _(d):
    return closure.full_lineage(d.lineage_edges, "part:7")


@query(
    "cdc_01_change_log",
    """SELECT 'customer' AS table_name, CASE WHEN b.c_custkey IS NULL THEN 'INSERT' WHEN a.c_custkey IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS operation,
    CAST(coalesce(b.c_custkey, a.c_custkey) AS STRING) AS record_id,
    CASE WHEN b.c_custkey IS NOT NULL THEN concat('{"c_custkey":', b.c_custkey, ',"c_name":"', b.c_name, '","c_acctbal":"', b.c_acctbal, '"}') END AS old_values,
    CASE WHEN a.c_custkey IS NOT NULL THEN concat('{"c_custkey":', a.c_custkey, ',"c_name":"', a.c_name, '","c_acctbal":"', a.c_acctbal, '"}') END AS new_values
    FROM cdc_before b FULL OUTER JOIN cdc_after a ON a.c_custkey = b.c_custkey
    WHERE b.c_custkey IS NULL OR a.c_custkey IS NULL OR b.c_acctbal IS DISTINCT FROM a.c_acctbal OR b.c_name IS DISTINCT FROM a.c_name""",
)
def _(d):
    return quality.change_log(d.cdc_before, d.cdc_after, "c_custkey", "customer")


@query(
    "udf_03_quality_expression",
    """SELECT 'ship_after_1995' AS rule_id, count(*) AS total_records, count(*) FILTER (WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_discount < 0.1) AS passed_records,
    round(100.0 * count(*) FILTER (WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_discount < 0.1) / count(*), 2) AS score FROM lineitem""",
)
def _(d):
    rule = QualityRule("ship_after_1995", "lineitem", "validity", "l_shipdate >= TIMESTAMP_NTZ '1996-01-01' AND l_discount < 0.1D", 95.0)
    return quality.run_quality_rules({"lineitem": d.lineitem}, [rule]).select("rule_id", "total_records", "passed_records", "score")
