"""Rolling statistics and threshold detectors over quotes, payments and metrics."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from ledgermill.operators.ordered import bounded_frames, running_totals

ANOMALY_COLUMNS = (
    "type symbol value severity message z_score mean threshold detection_method timestamp".split()
)


def quote_frames(price: str = "current_price") -> Callable[[WindowSpec], dict[str, Column]]:
    """History count, mean and spread of price and volume; both detectors share this one frame, hence one sort."""

    def columns(w):
        return {
            "n_prev": F.count(price).over(w),
            "mean_price": F.avg(price).over(w),
            "stdev_price": F.stddev_samp(price).over(w),
            "mean_volume": F.avg("volume").over(w),
        }

    return columns


def quote_statistics(quotes: DataFrame, window: int = 50, price: str = "current_price", order: Sequence[str] = ("ts", "event_id")) -> DataFrame:
    """:func:`quote_frames` over the *previous* rows of the symbol."""
    slim = quotes.select("symbol", price, "volume", *dict.fromkeys([*order, "ts", "event_id"]))
    return bounded_frames(slim, ["symbol"], list(order), window, quote_frames(price), include_current=False)


def _price_hit(minimum: int, limit: float, price: str) -> tuple[Column, dict[str, Column]]:
    """Condition and columns of a price far from the mean of its frame."""
    z = (F.col(price) - F.col("mean_price")) / F.col("stdev_price")
    message = F.format_string(
        "%s price %.2f is %.1f std devs from mean %.2f", F.col("symbol"), F.col(price), F.abs(z), F.col("mean_price")
    )
    return (F.col("n_prev") >= minimum) & (F.col("stdev_price") > 0) & (F.abs(z) > limit), {
        "event_id": F.col("event_id"),
        "type": F.lit("PRICE_SPIKE"),
        "symbol": F.col("symbol"),
        "value": F.col(price),
        "z_score": F.round(z, 2),
        "mean": F.round("mean_price", 2),
        "stdev": F.round("stdev_price", 4),
        "severity": F.when(F.abs(z) > 3.5, "HIGH").otherwise("MEDIUM"),
        "message": message,
        "detection_method": F.lit("z-score"),
        "timestamp": F.col("ts"),
    }


def _volume_hit(minimum: int, times: float) -> tuple[Column, dict[str, Column]]:
    """Condition and columns of a volume that is a multiple of the mean of its frame."""
    mean, volume = F.col("mean_volume"), F.col("volume")
    return (F.col("n_prev") >= minimum) & (mean > 0) & (volume > mean * times), {
        "event_id": F.col("event_id"),
        "type": F.lit("VOLUME_SPIKE"),
        "symbol": F.col("symbol"),
        "value": volume.cast("double"),
        "average_volume": mean.cast("long"),
        "ratio": F.round(volume / mean, 2),
        "severity": F.lit("MEDIUM"),
        "message": F.format_string("%s volume %,d is %.1fx average", F.col("symbol"), volume, volume / mean),
        "detection_method": F.lit("threshold"),
        "timestamp": F.col("ts"),
    }


def _hits(stats: DataFrame, hit: tuple[Column, dict[str, Column]], keep: Sequence[str]) -> DataFrame:
    condition, columns = hit
    return stats.filter(condition).select(*keep, *[c.alias(name) for name, c in columns.items()])


def price_zscore(stats: DataFrame, minimum: int = 10, limit: float = 2.5, price: str = "current_price", keep: Sequence[str] = ()) -> DataFrame:
    return _hits(stats, _price_hit(minimum, limit, price), keep)


def volume_spike(stats: DataFrame, minimum: int = 10, times: float = 3, keep: Sequence[str] = ()) -> DataFrame:
    return _hits(stats, _volume_hit(minimum, times), keep)


def price_and_volume_hits(stats: DataFrame, minimum: int = 10, limit: float = 2.5, times: float = 3, price: str = "current_price") -> DataFrame:
    """The rows of both detectors, each with nulls for the other's columns, from one pass: a union would make the frames twice."""
    found = [_price_hit(minimum, limit, price), _volume_hit(minimum, times)]
    names = list(dict.fromkeys(n for _, columns in found for n in columns))
    rows = [F.when(hit, F.struct(*[columns.get(n, F.lit(None)).alias(n) for n in names])) for hit, columns in found]
    return stats.filter(found[0][0] | found[1][0]).select(F.inline(F.array_compact(F.array(*rows))))


def amount_frames(w: WindowSpec) -> dict[str, Column]:
    return {"n": F.count("amount").over(w), "mean": F.avg("amount").over(w), "stdev": F.stddev_samp("amount").over(w)}


def large_amounts(
    stats: DataFrame, minimum: int = 20, sigmas: float = 3, limit: float = 10000,
    order: Sequence[str] = ("created_at", "tx_key"), keep: Sequence[str] = (),
) -> DataFrame:
    """Amounts far above the mean of their frame, or above a fixed limit."""
    bar = F.col("mean") + F.lit(sigmas) * F.col("stdev")
    hits = stats.filter((F.col("n") >= minimum) & ((F.col("amount") > bar) | (F.col("amount") > limit)))
    return hits.select(
        *keep,
        order[-1],
        "transaction_id",
        F.lit("LARGE_TRANSACTION").alias("type"),
        F.col("amount").alias("value"),
        F.round("mean", 2).alias("mean"),
        F.round(bar, 2).alias("threshold"),
        F.when(F.col("amount") > 25000, "HIGH").otherwise("MEDIUM").alias("severity"),
        F.format_string("Large transaction: €%,.2f (avg: €%,.2f)", F.col("amount"), F.col("mean")).alias("message"),
        F.lit("z-score").alias("detection_method"),
        F.col(order[-2]).alias("timestamp"),
    )


def large_transactions(
    transactions: DataFrame,
    window: int = 200,
    minimum: int = 20,
    sigmas: float = 3,
    limit: float = 10000,
    partition_by: list[str] | None = None,
    order: Sequence[str] = ("created_at", "tx_key"),
    keep: Sequence[str] = (),
) -> DataFrame:
    """Amounts far above the last ``window`` payments, the current one included."""
    needed = dict.fromkeys([*(partition_by or []), *order, *keep, "transaction_id", "amount"])
    stats = bounded_frames(transactions.select(*needed), partition_by or [], list(order), window - 1, amount_frames, include_current=True)
    return large_amounts(stats, minimum, sigmas, limit, order, keep)


def metric_statistics(points: DataFrame, window: int = 100, quartiles: bool = True) -> DataFrame:
    """Count, mean, spread and index quartiles of the last ``window`` points, current included."""

    def columns(w):
        base = {"n": F.count("value").over(w), "mean": F.avg("value").over(w), "stdev": F.stddev_samp("value").over(w)}
        # the frame holds at most `window` values, so the collected list is bounded
        return {**base, "recent": F.array_sort(F.collect_list("value").over(w))} if quartiles else base

    stats = bounded_frames(points, ["metric"], ["ts", "event_id"], window - 1, columns, include_current=True)
    if not quartiles:
        return stats
    at = lambda position: F.try_element_at("recent", (position + 1).cast("int"))
    return stats.withColumns({"q1": at(F.expr("n div 4")), "q3": at(F.expr("(3 * n) div 4"))}).drop("recent")


def metric_hits(stats: DataFrame) -> DataFrame:
    """Hits of both metric detectors from one pass over the frames: event_id, metric, value, ts, method."""
    z = (F.col("value") - F.col("mean")) / F.col("stdev")
    spread = F.col("q3") - F.col("q1")
    outside = (F.col("value") < F.col("q1") - 1.5 * spread) | (F.col("value") > F.col("q3") + 1.5 * spread)
    methods = F.array(
        F.when((F.col("n") >= 10) & (F.col("stdev") != 0) & (F.abs(z) > 3.0), "z-score"), F.when((F.col("n") >= 10) & outside, "iqr")
    )
    return stats.select("event_id", "metric", "value", "ts", F.explode_outer(methods).alias("method")).filter(F.col("method").isNotNull())


def metric_zscore(stats: DataFrame, minimum: int = 10, limit: float = 3.0) -> DataFrame:
    z = (F.col("value") - F.col("mean")) / F.col("stdev")
    return (
        stats.filter((F.col("n") >= minimum) & (F.col("stdev") != 0))
        .withColumn("z_score", z)
        .filter(F.abs("z_score") > limit)
        .select("event_id", "metric", "value", "z_score", "mean", "stdev", "ts", F.lit("z-score").alias("method"))
    )


def metric_iqr(stats: DataFrame, minimum: int = 10, multiplier: float = 1.5) -> DataFrame:
    spread = F.col("q3") - F.col("q1")
    bounded = stats.filter(F.col("n") >= minimum).withColumns(
        {
            "iqr": spread,
            "lower_bound": F.col("q1") - multiplier * spread,
            "upper_bound": F.col("q3") + multiplier * spread,
        }
    )
    return bounded.filter((F.col("value") < F.col("lower_bound")) | (F.col("value") > F.col("upper_bound"))).select(
        "event_id", "metric", "value", "q1", "q3", "iqr", "lower_bound", "upper_bound", "ts", F.lit("iqr").alias("method")
    )


def _severity(measure: Column, high: float) -> Column:
    return F.when(measure > high, "HIGH").otherwise("MEDIUM")


def stock_threshold_alerts(quotes: DataFrame, threshold: float = 5) -> DataFrame:
    move = F.abs("change_percent")
    return quotes.filter(move > threshold).select(
        "event_id",
        F.lit("PRICE_SPIKE").alias("alert_type"),
        "symbol",
        move.alias("value"),
        F.lit(threshold).cast("double").alias("threshold"),
        _severity(move, 10).alias("severity"),
        F.format_string("Price change of %.2f%% detected", move).alias("message"),
        F.col("ts").alias("timestamp"),
    )


def tx_threshold_alerts(transactions: DataFrame, threshold: float = 10000) -> DataFrame:
    amount = F.col("amount")
    return transactions.filter(amount > threshold).select(
        "transaction_id",
        F.lit("LARGE_TRANSACTION").alias("alert_type"),
        amount.alias("value"),
        F.lit(threshold).cast("double").alias("threshold"),
        _severity(amount, 25000).alias("severity"),
        F.format_string("Large transaction of %.2f %s", amount, F.col("currency")).alias("message"),
        F.col("created_at").alias("timestamp"),
    )


def price_move_alerts(quotes: DataFrame, threshold: float = 2, high: float = 4) -> DataFrame:
    move = F.col("change_percent")
    return quotes.filter(F.abs(move) > threshold).select(
        "event_id",
        F.when(move > 0, "PRICE_SPIKE").otherwise("PRICE_DROP").alias("alert_type"),
        "symbol",
        move.alias("value"),
        _severity(F.abs(move), high).alias("severity"),
        "timestamp",
    )


def anomalies_union(*parts: DataFrame) -> DataFrame:
    """One anomaly table from detectors with different columns."""
    shaped = [p.select(*[c for c in ANOMALY_COLUMNS if c in p.columns]) for p in parts]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), shaped)
    return merged.select(*[c for c in ANOMALY_COLUMNS if c in merged.columns])


def alerts_view(anomalies: DataFrame) -> DataFrame:
    return anomalies.select(
        F.col("type").alias("alert_type"), "symbol", "message", "severity", "timestamp"
    ).orderBy(F.col("timestamp").desc(), "alert_type", "symbol")


def running_activity(transactions: DataFrame, limit: float = 10000) -> DataFrame:
    """Cumulative payment count, amount and large-payment count in booking order."""
    return running_totals(
        transactions,
        ["created_at", "tx_key"],
        {
            "total_transactions": F.lit(1).cast("long"),
            "total_amount": F.col("amount").cast("decimal(18,4)"),
            "total_anomalies": (F.col("amount") > limit).cast("long"),
        },
    )


def interval_rates(df: DataFrame, ts: str, amount: str, seconds: int = 10) -> DataFrame:
    """Count, amount and rate per second of each tumbling interval."""
    rows = F.count(F.lit(1))
    return (
        df.groupBy(F.window(ts, f"{seconds} seconds").alias("w"))
        .agg(
            rows.alias("tx_count"),
            F.round(F.sum(amount), 2).alias("total_amount"),
            F.round(rows / F.lit(float(seconds)), 4).alias("rate_per_second"),
        )
        .select(F.col("w.start").alias("window_start"), "tx_count", "total_amount", "rate_per_second")
    )
