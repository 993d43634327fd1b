"""Rule evaluation, cooldown, ids, lifecycle and summaries."""

from pyspark.sql import functions as F

from ledgermill.catalog.registry import query
from ledgermill.operators import alerts, anomaly
from ledgermill.operators.cooldown import cooldown
from ledgermill.plans.inputs import INPUTS
from ledgermill.plans.layers import rounded
from ledgermill.plans.oracle import VIEWS, view
from ledgermill.plans.inputs import references

INPUTS["topic_messages"] = """
SELECT concat('T', CAST(o_orderkey AS STRING)) AS message_id, 'acme.transactions' AS topic,
       CASE WHEN mod(o_orderkey, 9) = 0 THEN NULL ELSE o_totalprice END AS amount, CAST(NULL AS DOUBLE) AS change_percent FROM {orders}
UNION ALL SELECT concat('F', CAST(event_id AS STRING)), 'acme.forex', CAST(NULL AS DOUBLE), change_percent FROM {quotes}
UNION ALL SELECT concat('P', CAST(event_id AS STRING)), CASE WHEN event_type = 'error' THEN 'acme.other' ELSE 'acme.pipeline' END,
       CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE) FROM {events}"""
INPUTS["alert_history"] = """
SELECT concat('A', CAST(user_id AS STRING), '-', CAST(CAST(ts AS DATE) AS STRING)) AS alert_id,
       CASE event_type WHEN 'error' THEN 'trigger' WHEN 'click' THEN 'trigger' WHEN 'view' THEN 'acknowledge' ELSE 'resolve' END AS action,
       concat('user', CAST(mod(event_id, 7) AS STRING)) AS actor, ts, event_id AS seq FROM {events}"""
for _name in ("topic_messages", "alert_history"):
    VIEWS[_name] = INPUTS[_name].format(**{r: r for r in references(INPUTS[_name])})

view(
    "rule_hits",
    """SELECT point_id, source, value, ts, 'high_transaction_volume' AS rule, 'WARNING' AS severity, 10000.0 AS threshold,
      concat('High transaction volume detected: ', CAST(value AS STRING), ' transactions') AS message
      FROM metrics WHERE source = 'transactions' AND value > 10000
    UNION ALL SELECT point_id, source, value, ts, 'large_transaction', 'CRITICAL', 100000.0, concat('Large transaction detected: €', CAST(value AS STRING))
      FROM metrics WHERE source = 'transactions' AND value > 100000
    UNION ALL SELECT point_id, source, value, ts, 'forex_volatility', 'WARNING', 0.05,
      concat('High forex volatility detected: ', printf('%.2f', value * 100), '% change') FROM metrics WHERE source = 'forex' AND abs(value) > 0.05e0
    UNION ALL SELECT point_id, source, value, ts, 'pipeline_failure', 'CRITICAL', NULL, concat('Pipeline ', metric, ' failed')
      FROM metrics WHERE source = 'pipeline' AND status = 'failed'
    UNION ALL SELECT point_id, source, value, ts, 'data_staleness', 'WARNING', 3600.0, concat('Data stale for ', CAST(value AS STRING), ' seconds')
      FROM metrics WHERE source = 'data_quality' AND value > 3600""",
)
view(
    "rule_times",
    """SELECT row_number() OVER (ORDER BY rule, ts) AS pos, * FROM (SELECT rule, ts, min(point_id) AS point_id FROM rule_hits GROUP BY rule, ts) g""",
)
view(
    "rule_next",
    """SELECT a.pos, a.rule, a.ts, a.point_id, b.pos AS next_pos FROM rule_times a
    ASOF LEFT JOIN rule_times b ON a.rule = b.rule AND a.ts + INTERVAL 5 MINUTE <= b.ts""",
)


def _hits(d):
    return alerts.evaluate_rules(d.metrics)


@query(
    "alr_01_evaluate_rules",
    "SELECT point_id, source, rule, severity, threshold, round(value, 4) AS value, ts FROM rule_hits",
)
def _(d):
    return rounded(_hits(d).select("point_id", "source", "rule", "severity", "threshold", "value", "ts"))


@query(
    "alr_02_cooldown",
    """WITH RECURSIVE fired AS (SELECT * FROM rule_next WHERE pos IN (SELECT min(pos) FROM rule_next GROUP BY rule)
    UNION ALL SELECT n.* FROM fired f JOIN rule_next n ON n.pos = f.next_pos) SELECT rule, ts, point_id FROM fired""",
)
def _(d):
    candidates = _hits(d).select("rule", "ts", "point_id")
    return cooldown(candidates, minutes=5, tie=["point_id"]).select("rule", "ts", "point_id")


@query(
    "alr_03_alert_id",
    """SELECT point_id, rule, substr(md5(concat(rule, ':', source, ':', strftime(ts, '%Y-%m-%d'))), 1, 12) AS alert_id FROM rule_hits""",
)
def _(d):
    return alerts.with_alert_id(_hits(d)).select("point_id", "rule", "alert_id")


@query(
    "alr_04_anomaly_alerts",
    """SELECT event_id, substr(md5(concat('anomaly:', metric, ':', strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'))), 1, 12) AS alert_id,
    concat('anomaly_', method) AS name, concat('Anomaly detected in ', metric, ' using ', method, ' method') AS message,
    'WARNING' AS severity, 'anomaly_detection' AS source, metric, round(value, 4) AS value, ts
    FROM (SELECT event_id, metric, value, ts, method FROM metric_z UNION ALL SELECT event_id, metric, value, ts, method FROM metric_q) h""",
)
def _(d):
    return rounded(alerts.anomaly_alerts(anomaly.metric_hits(anomaly.metric_statistics(d.metric_points))))


@query("alr_05_format_message", "SELECT point_id, rule, message FROM rule_hits")
def _(d):
    return _hits(d).select("point_id", "rule", "message")


@query(
    "alr_06_alert_lifecycle",
    """SELECT alert_id, CASE WHEN last_action = 'resolve' THEN 'RESOLVED' WHEN last_action = 'acknowledge' THEN 'ACKNOWLEDGED' ELSE 'ACTIVE' END AS status,
    opened AS triggered_at, CASE WHEN acked > opened THEN acked_by END AS acknowledged_by, CASE WHEN closed > opened THEN closed END AS resolved_at
    FROM (SELECT alert_id, arg_max(action, ts) AS last_action, max(ts) FILTER (WHERE action = 'trigger') AS opened,
          max(ts) FILTER (WHERE action = 'acknowledge') AS acked, arg_max(actor, ts) FILTER (WHERE action = 'acknowledge') AS acked_by,
          max(ts) FILTER (WHERE action = 'resolve') AS closed FROM alert_history GROUP BY alert_id) f WHERE opened IS NOT NULL""",
)
def _(d):
    return alerts.alert_lifecycle(d.alert_history)


@query(
    "alr_07_alert_summary",
    """SELECT 'severity' AS dimension, severity AS value, count(*) AS alert_count, count(*) FILTER (WHERE value <= 150000) AS active_count
    FROM rule_hits GROUP BY severity UNION ALL
    SELECT 'source', source, count(*), count(*) FILTER (WHERE value <= 150000) FROM rule_hits GROUP BY source UNION ALL
    SELECT 'total', 'all', count(*), count(*) FILTER (WHERE value <= 150000) FROM rule_hits""",
)
def _(d):
    state = F.when(F.col("value") > 150000, "RESOLVED").when(F.col("value").isNotNull(), "ACTIVE")
    return alerts.alert_summary(_hits(d).withColumn("status", state))


@query(
    "alr_08_topic_metrics",
    """SELECT message_id, CASE topic WHEN 'acme.transactions' THEN 'transaction_amount' WHEN 'acme.forex' THEN 'forex_rate_change'
    ELSE 'pipeline_status' END AS metric, CASE topic WHEN 'acme.transactions' THEN 'transactions' WHEN 'acme.forex' THEN 'forex'
    ELSE 'pipeline' END AS source, round(CASE topic WHEN 'acme.transactions' THEN coalesce(amount, 0) WHEN 'acme.forex' THEN coalesce(change_percent, 0)
    END, 4) AS value FROM topic_messages WHERE topic <> 'acme.other'""",
)
def _(d):
    return rounded(alerts.topic_metrics(d.topic_messages).select("message_id", "metric", "source", "value"))


@query(
    "udf_01_custom_rule",
    """SELECT point_id, 'weekend_amount' AS rule, 'INFO' AS severity, ts FROM metrics WHERE source = 'transactions' AND value > 250000
    AND dayofweek(ts) IN (0, 6)""",
)
def _(d):
    rule = alerts.AlertRule("weekend_amount", "transactions", "value > 250000 AND dayofweek(ts) IN (1, 7)", "INFO")
    return alerts.evaluate_rules(d.metrics, [rule]).select("point_id", "rule", "severity", "ts")
