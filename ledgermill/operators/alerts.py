"""Alert rules as Catalyst predicates, alert ids, lifecycle and summaries."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class AlertRule:
    """``condition`` is SQL over the point's columns; it must yield null, not fail, on a bad type."""

    name: str
    source: str
    condition: str
    severity: str = "WARNING"
    message: str = "concat(name, ': ', cast(value as string))"
    threshold: float | None = None
    cooldown_minutes: int = 5
    enabled: bool = True


# The default financial rules.
DEFAULT_RULES = (
    AlertRule(
        "high_transaction_volume", "transactions", "value > 10000", "WARNING",
        "concat('High transaction volume detected: ', cast(value as string), ' transactions')", 10000,
    ),
    AlertRule(
        "large_transaction", "transactions", "value > 100000", "CRITICAL",
        "concat('Large transaction detected: €', cast(value as string))", 100000,
    ),
    AlertRule(
        "forex_volatility", "forex", "abs(value) > 0.05D", "WARNING",
        "format_string('High forex volatility detected: %.2f%% change', value * 100)", 0.05,
    ),
    AlertRule(
        "pipeline_failure", "pipeline", "status = 'failed'", "CRITICAL",
        "concat('Pipeline ', metric, ' failed')",
    ),
    AlertRule(
        "data_staleness", "data_quality", "value > 3600", "WARNING",
        "concat('Data stale for ', cast(value as string), ' seconds')", 3600,
    ),
)


def alert_id(*parts: Column) -> Column:
    return F.substring(F.md5(F.concat_ws(":", *parts)), 1, 12)


def evaluate_rules(points: DataFrame, rules: Iterable[AlertRule] = DEFAULT_RULES) -> DataFrame:
    """One row per point and firing rule, in a single pass without a join."""
    outcomes = []
    for rule in rules:
        if not rule.enabled:
            continue
        applies = (F.col("source") == rule.source) | F.col("source").isNull()
        facts = F.struct(
            F.lit(rule.name).alias("rule"),
            F.lit(rule.severity).alias("severity"),
            F.lit(rule.threshold).cast("double").alias("threshold"),
            F.expr(rule.message.replace("(name,", f"('{rule.name}',")).alias("message"),
        )
        outcomes.append(F.when(applies & F.expr(rule.condition), facts))
    # outer generator: a plain one makes Spark evaluate all rules once more to skip quiet rows
    return points.select("*", F.inline_outer(F.array(*outcomes))).filter(F.col("rule").isNotNull())


def with_alert_id(alerts: DataFrame) -> DataFrame:
    day = F.date_format("ts", "yyyy-MM-dd")
    return alerts.withColumn("alert_id", alert_id(F.col("rule"), F.col("source"), day))


def anomaly_alerts(hits: DataFrame) -> DataFrame:
    """Detector hits as warnings; these are never held back by a cooldown."""
    moment = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return hits.select(
        "event_id",
        alert_id(F.lit("anomaly"), F.col("metric"), moment).alias("alert_id"),
        F.concat(F.lit("anomaly_"), "method").alias("name"),
        F.concat(F.lit("Anomaly detected in "), "metric", F.lit(" using "), "method", F.lit(" method")).alias("message"),
        F.lit("WARNING").alias("severity"),
        F.lit("anomaly_detection").alias("source"),
        "metric",
        "value",
        "ts",
    )


def alert_lifecycle(history: DataFrame) -> DataFrame:
    """Current state per alert from ``(alert_id, action, actor, ts, seq)`` rows.

    ``trigger`` (re)opens an alert, ``acknowledge`` and ``resolve`` change it; the
    last write wins. Acknowledgements and resolutions older than the last trigger
    belong to an earlier alert of the same id, actions without a trigger to none.
    """
    when = F.struct("ts", "seq")

    def last(action: str, *extra: str) -> Column:
        return F.max(F.when(F.col("action") == action, F.struct("ts", "seq", *extra)))

    folded = history.groupBy("alert_id").agg(
        F.max_by("action", when).alias("last_action"),
        last("trigger").alias("opened"),
        last("acknowledge", "actor").alias("acked"),
        last("resolve").alias("closed"),
    )

    def since_open(event: str) -> Column:
        return F.struct(f"{event}.ts", f"{event}.seq") > F.struct("opened.ts", "opened.seq")

    return folded.filter(F.col("opened").isNotNull()).select(
        "alert_id",
        F.when(F.col("last_action") == "resolve", "RESOLVED")
        .when(F.col("last_action") == "acknowledge", "ACKNOWLEDGED")
        .otherwise("ACTIVE")
        .alias("status"),
        F.col("opened.ts").alias("triggered_at"),
        F.when(F.col("acked").isNotNull() & since_open("acked"), F.col("acked.actor")).alias("acknowledged_by"),
        F.when(F.col("closed").isNotNull() & since_open("closed"), F.col("closed.ts")).alias("resolved_at"),
    )


def alert_summary(history: DataFrame) -> DataFrame:
    """Totals overall, by severity and by source in one grouping-sets pass."""
    sets = [[F.col("severity")], [F.col("source")], []]
    grouped = history.groupingSets(sets, F.col("severity"), F.col("source")).agg(
        F.grouping_id().alias("_gid"),
        F.count(F.lit(1)).alias("alert_count"),
        F.count_if(F.col("status") == "ACTIVE").alias("active_count"),
    )
    return grouped.select(
        F.when(F.col("_gid") == 1, "severity").when(F.col("_gid") == 2, "source").otherwise("total").alias("dimension"),
        F.when(F.col("_gid") == 1, F.col("severity")).when(F.col("_gid") == 2, F.col("source")).otherwise("all").alias("value"),
        "alert_count",
        "active_count",
    )


def topic_metrics(messages: DataFrame) -> DataFrame:
    """Metric name, source and value of a message by its topic; missing numbers count as 0."""
    topic = F.col("topic")

    def by_topic(transactions: Column, forex: Column, other: Column) -> Column:
        return (
            F.when(topic.contains("transactions"), transactions)
            .when(topic.contains("forex"), forex)
            .when(topic.contains("pipeline"), other)
        )

    number = F.lit(None).cast("double")
    return messages.select(
        "*",
        by_topic(F.lit("transaction_amount"), F.lit("forex_rate_change"), F.lit("pipeline_status")).alias("metric"),
        by_topic(F.lit("transactions"), F.lit("forex"), F.lit("pipeline")).alias("source"),
        by_topic(F.coalesce("amount", F.lit(0.0)), F.coalesce("change_percent", F.lit(0.0)), number).alias("value"),
    ).filter(F.col("metric").isNotNull())
