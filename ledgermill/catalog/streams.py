"""Streams drained with availableNow; the reference SQL is the batch form."""

from pyspark.sql import functions as F

from ledgermill.catalog.registry import query
from ledgermill.operators import alerts, anomaly
from ledgermill.plans.layers import rounded
from ledgermill.plans.oracle import view
from ledgermill.session import scratch_path
from ledgermill.sources import writers
from ledgermill.streaming import flows, progress, stateful


def _quotes(d):
    return d.frame("quotes", events=flows.table_stream(d.spark, d.folder, "events"))


def _transactions(d):
    """Payments as a stream; customers and nations are looked up statically."""
    return d.frame("transactions", orders=flows.table_stream(d.spark, d.folder, "orders"))


def _json(df, *columns):
    return df.select(F.to_json(F.struct(*columns)).alias("value"))


def _quote_messages(d):
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp")
    return _json(
        _quotes(d), "symbol", "exchange", "currency", F.col("current_price").alias("price"), "change_percent", "volume",
        F.col("event_id").cast("string").alias("_source"), stamp,
    )


def _tx_messages(d):
    return _json(_transactions(d), "transaction_id", "amount", "currency", "transaction_type", "status", "is_cross_border")


@query(
    "str_01_stock_stream",
    """SELECT CAST(event_id AS STRING) AS event_id, symbol, round(current_price, 4) AS current_price, round(CASE currency WHEN 'USD' THEN current_price / 1.08e0
    WHEN 'GBP' THEN current_price / 0.86e0 ELSE current_price END, 4) AS price_eur,
    CASE WHEN change_percent > 0 THEN 'UP' WHEN change_percent < 0 THEN 'DOWN' ELSE 'STABLE' END AS trend,
    abs(change_percent) > 5 OR volume > 100000000 AS is_anomaly FROM quotes""",
)
def _(d):
    out = flows.stock_stream(_quote_messages(d)).select(
        F.col("_source").alias("event_id"), "symbol", "current_price", "price_eur", "trend", "is_anomaly"
    )
    return rounded(flows.drain(out, "stocks"))


@query(
    "str_02_transaction_stream",
    """SELECT transaction_id, round(CASE currency WHEN 'USD' THEN amount / 1.08e0 WHEN 'GBP' THEN amount / 0.86e0 ELSE amount END, 4) AS amount_eur,
    CASE WHEN amount > 50000 THEN 'CRITICAL' WHEN amount > 10000 THEN 'HIGH' WHEN amount > 1000 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
    is_cross_border AND amount > 5000 AS requires_aml_check FROM transactions""",
)
def _(d):
    out = flows.transaction_stream(_tx_messages(d)).select("transaction_id", "amount_eur", "risk_level", "requires_aml_check")
    return rounded(flows.drain(out, "payments"))


_CLOSED = "(SELECT max(ts) - INTERVAL 30 SECOND FROM events)"


def _window_sql(size, step="MINUTE"):
    return f"time_bucket(INTERVAL {size} {step}, ts)"


@query(
    "str_03_windowed_quotes",
    f"""SELECT {_window_sql(1)} AS window_start, symbol, exchange, round(avg(current_price), 4) AS avg_price, round(max(current_price), 4) AS high_price,
    round(min(current_price), 4) AS low_price, CAST(sum(volume) AS BIGINT) AS total_volume, count(*) AS quote_count,
    round(avg(change_percent), 4) AS avg_change_pct FROM quotes GROUP BY 1, 2, 3 HAVING {_window_sql(1).replace('ts', 'min(ts)')} + INTERVAL 1 MINUTE <= {_CLOSED}""",
)
def _(d):
    timed = _quotes(d).withColumn("event_time", F.col("ts").cast("timestamp"))
    out = flows.windowed_quotes(timed, "event_time")
    out = out.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"), *[c for c in out.columns if c != "window"])
    return rounded(flows.drain(out, "windows"))


@query(
    "str_04_late_rows",
    """WITH timely AS (SELECT ts FROM events WHERE mod(event_id, 10) <> 0), mark AS (SELECT max(ts) - INTERVAL 1 DAY AS passed FROM timely),
    late AS (SELECT ts FROM events, mark WHERE mod(event_id, 10) = 0 AND date_trunc('hour', ts) + INTERVAL 1 HOUR > passed)
    SELECT date_trunc('hour', ts) AS window_start, count(*) AS tx_count FROM (SELECT ts FROM timely UNION ALL SELECT ts FROM late) u
    GROUP BY 1 HAVING date_trunc('hour', min(ts)) + INTERVAL 1 HOUR <= (SELECT greatest(passed, (SELECT max(ts) FROM events) - INTERVAL 1 DAY) FROM mark)""",
)
def _(d):
    # one table in two deliveries: a tenth of the rows comes after the watermark has passed most of them
    source, checkpoint, sink = (scratch_path(d.spark, n) for n in ("late-in", "late-checkpoint", "late-out"))
    rows = d.events.select(F.col("ts").cast("timestamp").alias("ts"), "value", "event_id")
    late = F.col("event_id") % 10 == 0

    def deliver(part):
        part.write.mode("append").parquet(source)
        stream = d.spark.readStream.schema(rows.schema).parquet(source)
        return flows.drain(flows.throughput(stream, "ts", "value", 3600, "1 day"), "late", checkpoint, sink)

    deliver(rows.filter(~late))
    out = deliver(rows.filter(late))
    return out.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"), "tx_count")


@query(
    "str_04_dropped_rows",
    """WITH timely AS (SELECT ts FROM events WHERE mod(event_id, 10) <> 0), late AS (SELECT ts FROM events WHERE mod(event_id, 10) = 0),
    mark AS (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 DAY AS passed, max(ts) AS newest FROM timely)
    SELECT 'timely' AS delivery, (SELECT count(*) FROM timely) AS input_rows, CAST(0 AS BIGINT) AS late_rows, CAST(0 AS BIGINT) AS dropped_rows
    UNION ALL SELECT 'late', count(*), count(*) FILTER (ts < newest), count(*) FILTER (ts <= passed) FROM late, mark""",
)
def _(d):
    """Per delivery: rows that came, rows older than the newest one before them, and those the watermark had passed."""
    source, checkpoint, sink, reports = (scratch_path(d.spark, n) for n in ("late-in", "late-checkpoint", "late-out", "late-reports"))
    rows = d.events.select(F.col("ts").cast("timestamp").alias("ts"), "event_id")
    late = F.col("event_id") % 10 == 0
    newest = F.lit(rows.filter(~late).agg(F.max("ts")).first()[0])
    parts = {"timely": rows.filter(~late), "late": rows.filter(late)}
    with progress.reported(d.spark, reports) as listener:
        for name, part in parts.items():
            part.write.mode("append").parquet(source)
            stream = d.spark.readStream.schema(rows.schema).parquet(source)
            flows.drain(flows.unique_stream(stream, ["event_id"], "ts", "1 day"), "late", checkpoint, sink, name)
    behind = parts["late"].agg(F.count(F.when(F.col("ts") < newest, 1)).alias("late_rows")).withColumn("delivery", F.lit("late"))
    counts = listener.table().groupBy(F.col("query_name").alias("delivery")).agg(
        F.sum("input_rows").alias("input_rows"), F.sum("dropped_rows").alias("dropped_rows")
    )
    return counts.join(behind, "delivery", "left").select("delivery", "input_rows", F.coalesce("late_rows", F.lit(0)).alias("late_rows"), "dropped_rows")


@query(
    "str_05_throughput",
    f"""SELECT {_window_sql(10, 'SECOND')} AS window_start, count(*) AS tx_count, round(sum(current_price), 2) AS total_amount,
    round(count(*) / 10.0, 4) AS rate_per_second FROM quotes GROUP BY 1
    HAVING {_window_sql(10, 'SECOND').replace('ts', 'min(ts)')} + INTERVAL 10 SECOND <= {_CLOSED}""",
)
def _(d):
    timed = _quotes(d).withColumn("event_time", F.col("ts").cast("timestamp"))
    out = flows.throughput(timed, "event_time", "current_price")
    out = out.select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"), "tx_count",
        F.round("total_amount", 2).alias("total_amount"), F.round("rate_per_second", 4).alias("rate_per_second"),
    )
    return flows.drain(out, "throughput")


def _in_parts(d, action, build, parts=4, **time):
    """Deliver tables (name = time column) in time slices, one micro-batch each, to one running state; ``build(**streams)``."""
    tables = {name: d.table(name) for name in time}
    ends = [t.agg(F.min(time[n]), F.max(time[n])).first() for n, t in tables.items()]
    ends = [e for e in ends if e[0] is not None]
    low, high = min(e[0] for e in ends), max(e[1] for e in ends)
    folders = {name: scratch_path(d.spark, f"delivered-{name}") for name in tables}
    checkpoint = scratch_path(d.spark, "delivered-checkpoint")
    for part in range(parts):
        begin, end = low + part * (high - low) / parts, low + (part + 1) * (high - low) / parts
        for name, table in tables.items():
            at = F.col(time[name])
            table.filter((at >= begin) & ((at < end) | F.lit(part == parts - 1))).write.mode("append").parquet(folders[name])
        streams = {n: d.spark.readStream.schema(t.schema).parquet(folders[n]) for n, t in tables.items()}
        flows.for_each_batch(build(**streams), action, checkpoint, available_now=True).awaitTermination()
    return action.read(d.spark)


@query(
    "str_06_stateful_price_anomaly",
    """SELECT event_id, symbol, "type", round(value, 4) AS value, severity, message, z_score, mean, stdev, NULL AS average_volume, NULL AS ratio,
    detection_method, "timestamp" FROM price_anomalies UNION ALL SELECT event_id, symbol, "type", value, severity, message, NULL, NULL, NULL,
    average_volume, ratio, detection_method, "timestamp" FROM volume_anomalies""",
)
def _(d):
    detector = stateful.price_and_volume_anomalies(scratch_path(d.spark, "anomalies"))
    return rounded(_in_parts(d, detector, lambda events: d.frame("quotes", events=events), events="ts"))


@query(
    "str_07_stateful_tx_anomaly",
    """SELECT sender_country, tx_key, transaction_id, 'LARGE_TRANSACTION' AS "type", round(amount, 4) AS value, round(mean, 2) AS mean,
    round(mean + 3 * stdev, 2) AS threshold, CASE WHEN amount > 25000 THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
    concat('Large transaction: €', printf('%,.2f', amount), ' (avg: €', printf('%,.2f', mean), ')') AS message,
    'z-score' AS detection_method, created_at AS "timestamp"
    FROM (SELECT *, count(amount) OVER w AS n, avg(amount) OVER w AS mean, stddev_samp(amount) OVER w AS stdev FROM transactions
          WINDOW w AS (PARTITION BY sender_country ORDER BY created_at, tx_key ROWS BETWEEN 199 PRECEDING AND CURRENT ROW)) s
    WHERE n >= 20 AND (amount > mean + 3 * stdev OR amount > 10000)""",
)
def _(d):
    detector = stateful.transaction_anomalies(scratch_path(d.spark, "large"), "sender_country")
    columns = ["sender_country", "tx_key", "transaction_id", "amount", "created_at"]
    return rounded(_in_parts(d, detector, lambda orders: d.frame("transactions", orders=orders).select(*columns), orders="o_orderdate"))


@query(
    "str_08_stateful_rule_alerts",
    """WITH RECURSIVE fired AS (SELECT * FROM rule_next WHERE pos IN (SELECT min(pos) FROM rule_next GROUP BY rule)
    UNION ALL SELECT n.* FROM fired f JOIN rule_next n ON n.pos = f.next_pos) SELECT rule, ts, point_id FROM fired""",
)
def _(d):
    def hits(**streams):
        return alerts.evaluate_rules(d.frame("metrics", **streams))

    return _in_parts(d, stateful.CooledAlerts(scratch_path(d.spark, "cooled")), hits, events="ts", orders="o_orderdate")


@query("str_09_dedup_stream", "SELECT DISTINCT user_id, event_type, date_trunc('hour', ts) AS hour FROM events")
def _(d):
    rows = flows.table_stream(d.spark, d.folder, "events").select(
        "user_id", "event_type", F.date_trunc("hour", "ts").alias("hour"), F.col("ts").cast("timestamp").alias("at")
    )
    out = flows.drain(flows.unique_stream(rows, ["user_id", "event_type", "hour"], "at"), "unique")
    return out.select("user_id", "event_type", F.col("hour").cast("timestamp_ntz").alias("hour"))


view(
    "topic_counts",
    """SELECT CASE event_type WHEN 'click' THEN 'stocks' WHEN 'view' THEN 'anomalies' WHEN 'purchase' THEN 'transactions' WHEN 'signup' THEN 'forex'
    ELSE event_type END AS topic, * FROM events""",
)


def _topic_messages(d):
    names = {"click": "stocks", "view": "anomalies", "purchase": "transactions", "signup": "forex"}
    topic = F.col("event_type")
    for kind, name in names.items():
        topic = F.when(F.col("event_type") == kind, name).otherwise(topic)
    body = F.struct(
        F.concat(F.lit("SYM"), F.col("user_id").cast("string")).alias("symbol"), F.col("value").alias("price"), "value",
        F.col("event_id").cast("string").alias("transaction_id"), F.col("value").alias("amount"), F.lit("EUR").alias("currency"),
        F.lit(2.0).alias("mean"), F.lit("EUR").alias("base_currency"), F.col("value").alias("rate"),
    )
    return d.events.select(topic.alias("topic"), F.col("user_id").cast("string").alias("key"), F.to_json(body).alias("value"), "event_id")


def _dispatched(d):
    """The routes after two deliveries: all messages, then every payment message again, some of them broken, one of no topic."""
    sinks = flows.Dispatcher(scratch_path(d.spark, "routes"), default=lambda rest: rest.select("topic", "value"))
    for topic, route in (("stocks", flows.stock_route), ("transactions", flows.transaction_route), ("anomalies", flows.anomaly_route), ("forex", flows.forex_route)):
        sinks.on(topic, route)
    source, checkpoint = scratch_path(d.spark, "messages"), scratch_path(d.spark, "messages-checkpoint")
    messages = _topic_messages(d)
    broken = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("{broken "), "value")).otherwise(F.col("value"))
    again = messages.filter(F.col("topic") == "transactions").withColumn("value", broken)
    lost = messages.filter(F.col("event_id") % 50 == 0).withColumn("topic", F.lit(None).cast("string"))
    for delivery in (messages, again.unionByName(lost)):
        delivery.write.mode("append").parquet(source)
        stream = d.spark.readStream.schema(messages.schema).parquet(source)
        sinks.start(stream, checkpoint, available_now=True).awaitTermination()
    return sinks


@query(
    "str_10_topic_dispatch",
    """SELECT 'stocks' AS route, concat('SYM', CAST(user_id AS STRING)) AS id, value, 'kafka' AS source, TRUE AS is_real_data FROM topic_counts WHERE topic = 'stocks'
    UNION ALL SELECT 'transactions', CAST(event_id AS STRING), value, 'kafka', FALSE FROM topic_counts WHERE topic = 'transactions'
    UNION ALL SELECT 'anomalies', concat('SYM', CAST(user_id AS STRING)), value, 'mean 2.0', NULL FROM topic_counts WHERE topic = 'anomalies'
    UNION ALL SELECT 'forex', 'EUR', value, 'kafka', NULL FROM topic_counts WHERE topic = 'forex'
    UNION ALL SELECT 'other', NULL, NULL, topic, NULL FROM topic_counts WHERE topic = 'error'
    UNION ALL SELECT 'other', NULL, NULL, NULL, NULL FROM topic_counts WHERE mod(event_id, 50) = 0""",
)
def _(d):
    sinks = _dispatched(d)

    def rows(route, id, value, source, real):
        columns = {"route": F.lit(route), "id": id, "value": value.cast("double"), "source": source, "is_real_data": real.cast("boolean")}
        return sinks.read(d.spark, route).select(*[c.alias(n) for n, c in columns.items()])

    null = F.lit(None)
    parts = [
        rows("stocks", F.col("symbol"), F.col("price"), F.col("source"), F.col("is_real_data")),
        rows("transactions", F.col("transaction_id"), F.col("amount"), F.col("source"), F.col("is_real_data")),
        rows("anomalies", F.col("symbol"), F.col("value"), F.concat(F.lit("mean "), F.col("mean_value").cast("string")), null),
        rows("forex", F.col("base_currency"), F.col("rate"), F.col("source"), null),
        rows("other", null.cast("string"), null, F.col("topic"), null),
    ]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged


@query(
    "snk_09_route_counts",
    """SELECT topic, CAST(sum(n) AS BIGINT) AS messages, CAST(sum(bad) AS BIGINT) AS errors FROM (
      SELECT topic, 1 AS n, 0 AS bad FROM topic_counts
      UNION ALL SELECT topic, 1, CASE WHEN mod(event_id, 7) = 0 THEN 1 ELSE 0 END FROM topic_counts WHERE topic = 'transactions'
      UNION ALL SELECT NULL, 1, 0 FROM topic_counts WHERE mod(event_id, 50) = 0) m GROUP BY topic""",
)
def _(d):
    counts = _dispatched(d).read(d.spark, "counts").groupBy("topic")
    return counts.agg(F.sum("messages").alias("messages"), F.sum("errors").alias("errors"))


@query(
    "snk_09_dead_letters",
    "SELECT topic, '{broken ' AS head, event_id FROM topic_counts WHERE topic = 'transactions' AND mod(event_id, 7) = 0",
)
def _(d):
    number = F.regexp_extract("message", '"transaction_id":"([0-9]+)"', 1).cast("long")
    return _dispatched(d).read(d.spark, "dead").select("topic", F.left("message", F.lit(8)).alias("head"), number.alias("event_id"))


@query("snk_11_memory_sink", "SELECT symbol, count(*) AS quote_count, CAST(sum(volume) AS BIGINT) AS volume FROM quotes GROUP BY symbol ORDER BY symbol LIMIT 20")
def _(d):
    # the sink keeps its rows on the driver, so it is given a report of bounded size
    report, name = scratch_path(d.spark, "report"), f"shown_{scratch_path(d.spark, 'x').rsplit('-', 1)[1]}"
    per_symbol = d.quotes.groupBy("symbol").agg(F.count(F.lit(1)).alias("quote_count"), F.sum("volume").alias("volume"))
    per_symbol.orderBy("symbol").limit(20).write.parquet(report)
    flows.to_memory(d.spark.readStream.schema(per_symbol.schema).parquet(report), name).awaitTermination()
    return d.spark.table(name)


@query(
    "str_11_alert_fan_out",
    """SELECT 'quotes' AS output, event_id, round(change_percent, 4) AS value FROM quotes UNION ALL
    SELECT 'alerts', event_id, round(abs(change_percent), 4) FROM quotes WHERE abs(change_percent) > 5""",
)
def _(d):
    root = scratch_path(d.spark, "fan-out")
    outputs = {
        "quotes": lambda batch: batch.select("event_id", F.col("change_percent").alias("value")),
        "alerts": lambda batch: anomaly.stock_threshold_alerts(batch).select("event_id", "value"),
    }
    flows.drain_batches(_quotes(d), flows.fan_out(outputs, root), "fan-out")
    parts = [d.spark.read.parquet(f"{root}/{n}").select(F.lit(n).alias("output"), "event_id", "value") for n in outputs]
    return rounded(parts[0].unionByName(parts[1]))


@query("str_12_incremental_poll", "SELECT event_id, user_id, ts FROM events")
def _(d):
    # two deliveries into one folder, two runs over one checkpoint: every row arrives once
    source, checkpoint, sink = (scratch_path(d.spark, n) for n in ("poll-in", "poll-checkpoint", "poll-out"))
    rows = d.events.select("event_id", "user_id", "ts")
    for rest in (0, 1):
        rows.filter(F.col("event_id") % 2 == rest).write.mode("append").parquet(source)
        out = flows.drain(d.spark.readStream.schema(rows.schema).parquet(source), "poll", checkpoint, sink)
    return out


@query("snk_10_stream_to_parquet", "SELECT event_id, symbol, volume FROM quotes")
def _(d):
    return flows.drain(_quotes(d).select("event_id", "symbol", "volume"), "parquet")


@query("snk_12_foreach_batch", "SELECT symbol, round(current_price, 4) AS price, volume FROM quotes")
def _(d):
    path = scratch_path(d.spark, "export")

    def export(batch, batch_id):
        batch.select("symbol", F.col("current_price").alias("price"), "volume").write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    flows.drain_batches(_quotes(d), export, "export")
    return rounded(d.spark.read.parquet(path).drop("batch"))


@query(
    "snk_13_stream_records",
    """SELECT symbol AS "key", concat('{"symbol":"', symbol, '","volume":', volume, '}') AS value FROM quotes""",
)
def _(d):
    return flows.drain(writers.to_message_records(_quotes(d).select("symbol", "volume"), "symbol"), "records")
