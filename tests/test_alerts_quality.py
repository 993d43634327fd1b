"""Detectors, rules, lifecycle, quality rules and change logs on literal rows."""

import statistics
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgermill.operators import alerts, anomaly, quality
from ledgermill.operators.quality import QualityRule

T0 = datetime(2024, 1, 1)


def quotes(spark, prices, volumes=None):
    rows = [("S", i, float(p), int((volumes or [100] * len(prices))[i]), T0 + timedelta(seconds=i)) for i, p in enumerate(prices)]
    return spark.createDataFrame(rows, "symbol string, event_id long, current_price double, volume long, ts timestamp_ntz")


def test_price_anomaly_excludes_the_current_row(spark):
    history = [100 + (i % 5) for i in range(12)]
    hit = anomaly.price_zscore(anomaly.quote_statistics(quotes(spark, [*history, 130]))).collect()
    assert len(hit) == 1
    mean, stdev = statistics.mean(history), statistics.stdev(history)
    assert hit[0].z_score == pytest.approx(round((130 - mean) / stdev, 2))
    assert hit[0].severity == "HIGH" and hit[0].message.startswith("S price 130.00 is ")


def test_flat_or_short_history_is_silent(spark):
    assert anomaly.price_zscore(anomaly.quote_statistics(quotes(spark, [5] * 20 + [500]))).count() == 0
    assert anomaly.price_zscore(anomaly.quote_statistics(quotes(spark, [1, 2, 3, 4, 5, 6, 7, 8, 9, 900]))).count() == 0


def test_volume_spike(spark):
    hit = anomaly.volume_spike(anomaly.quote_statistics(quotes(spark, [1] * 12, [100] * 11 + [1234567]))).collect()
    assert [(h.event_id, h.average_volume, h.ratio) for h in hit] == [(11, 100, 12345.67)]
    assert hit[0].message == "S volume 1,234,567 is 12345.7x average"


def test_metric_detectors_include_the_current_row(spark):
    values = [100.0 + (i * 7) % 10 for i in range(50)] + [200.0]
    points = spark.createDataFrame(
        [(i, "m", v, T0 + timedelta(seconds=i)) for i, v in enumerate(values)], "event_id long, metric string, value double, ts timestamp_ntz"
    )
    stats = anomaly.metric_statistics(points)
    z = anomaly.metric_zscore(stats).collect()
    assert [r.event_id for r in z] == [50]
    assert z[0].z_score == pytest.approx((200 - statistics.mean(values)) / statistics.stdev(values))
    last = stats.filter("event_id = 50").first()
    ordered = sorted(values)
    assert (last.q1, last.q3) == (ordered[51 // 4], ordered[3 * 51 // 4])
    assert [r.event_id for r in anomaly.metric_iqr(stats).collect()] == [50]


def points(spark, rows):
    return spark.createDataFrame(rows, "source string, metric string, value double, status string, ts timestamp_ntz")


def test_default_rules(spark):
    rows = [
        ("transactions", "amount", 5000.0, None, T0), ("transactions", "amount", 150000.0, None, T0), ("forex", "change", -0.08, None, T0),
        ("pipeline", "load", None, "failed", T0), ("pipeline", "load", None, None, T0), ("data_quality", "age", None, None, T0),
    ]
    fired = alerts.evaluate_rules(points(spark, rows)).collect()
    assert sorted((r.source, r.rule) for r in fired) == [
        ("forex", "forex_volatility"), ("pipeline", "pipeline_failure"),
        ("transactions", "high_transaction_volume"), ("transactions", "large_transaction"),
    ]
    assert next(r.message for r in fired if r.rule == "forex_volatility") == "High forex volatility detected: -8.00% change"


def test_a_point_without_source_meets_every_rule(spark):
    rows = [(None, "x", 200000.0, "failed", T0)]
    assert alerts.evaluate_rules(points(spark, rows)).count() == 5
    disabled = [alerts.AlertRule("off", "x", "value > 0", enabled=False), alerts.AlertRule("on", "x", "value > 0")]
    assert [r.message for r in alerts.evaluate_rules(points(spark, rows), disabled).collect()] == ["on: 200000.0"]


def test_alert_id_is_stable_within_a_day(spark):
    rows = points(spark, [("s", "m", 1.0, None, T0), ("s", "m", 1.0, None, T0 + timedelta(hours=5)), ("s", "m", 1.0, None, T0 + timedelta(days=1))])
    ids = [r.alert_id for r in alerts.with_alert_id(rows.withColumn("rule", F.lit("r"))).collect()]
    assert ids[0] == ids[1] != ids[2] and len(ids[0]) == 12


def test_lifecycle_restarts_on_a_new_trigger(spark):
    def row(alert, action, minute, actor="u"):
        return (alert, action, actor, T0 + timedelta(minutes=minute), minute)

    history = spark.createDataFrame(
        [row("a", "trigger", 0), row("a", "acknowledge", 1, "ann"), row("b", "trigger", 0), row("b", "acknowledge", 1, "ann"),
         row("b", "resolve", 2), row("b", "trigger", 3), row("c", "resolve", 1), row("d", "trigger", 0), row("d", "resolve", 4)],
        "alert_id string, action string, actor string, ts timestamp_ntz, seq long",
    )
    rows = {r.alert_id: (r.status, r.acknowledged_by, r.resolved_at) for r in alerts.alert_lifecycle(history).collect()}
    assert rows == {
        "a": ("ACKNOWLEDGED", "ann", None), "b": ("ACTIVE", None, None), "d": ("RESOLVED", None, T0 + timedelta(minutes=4))
    }


def test_quality_scores(spark):
    good = spark.createDataFrame([("a", 1.0), ("b", None), ("b", -1.0)], "ticker string, price double")
    rules = [
        QualityRule("p", "t", "validity", "price > 0", 30.0), QualityRule("u", "t", "uniqueness", "ticker"),
        QualityRule("bad", "t", "validity", "nope > 0"), QualityRule("gone", "missing", "validity", "x > 0"),
        QualityRule("off", "t", "validity", "price > 0", is_active=False),
    ]
    rows = {r.rule_id: r for r in quality.run_quality_rules({"t": good}, rules).collect()}
    assert (rows["p"].score, rows["p"].passed) == (33.33, True)
    assert (rows["u"].score, rows["u"].passed) == (66.67, False)
    assert not rows["bad"].passed and rows["bad"].error and not rows["gone"].passed
    assert "off" not in rows
    empty = quality.run_quality_rules({"t": good.filter("false")}, rules[:1]).first()
    assert (empty.score, empty.passed) == (100.0, True)


def test_profiles(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), (None, 2), ("b", 3)], "k string, v int")
    assert {r.column_name: r.null_count for r in quality.null_profile(frame).collect()} == {"k": 2, "v": 0}
    assert quality.duplicate_count(frame, ["k", "v"]).first().duplicate_count == 2
    assert quality.duplicate_count(frame.filter("false"), ["k"]).first().duplicate_count == 0


def test_histogram_is_cumulative(spark):
    frame = spark.createDataFrame([(0.05,), (0.5,), (61.0,)], "d double")
    rows = {r.le: r.cumulative_count for r in quality.duration_histogram(frame, "d").collect()}
    assert rows["0.1"] == 1 and rows["0.5"] == 2 and rows["60.0"] == 2 and rows["+Inf"] == 3


def test_change_log(spark):
    before = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id long, v string")
    after = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d")], "id long, v string")
    rows = {r.record_id: (r.operation, r.old_values, r.new_values) for r in quality.change_log(before, after, "id", "t").collect()}
    assert rows == {
        "2": ("UPDATE", '{"id":2,"v":"b"}', '{"id":2,"v":"B"}'), "3": ("DELETE", '{"id":3}', None), "4": ("INSERT", None, '{"id":4,"v":"d"}')
    }
